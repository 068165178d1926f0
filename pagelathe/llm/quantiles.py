"""Percentiles of very large numeric columns with mergeable relative-error sketches.

A sketch is a stack of compactors: an item on level h stands for 2**h values. When a compactor is full, its
upper part, which is nearest to the protected tail, stays as it is; the lower part is sorted and every
second item of it moves up a level. Whether the even or the odd ones move is a coin of the sketch's own (its seed) for every first of two compactions, and the other
side for the second, so errors of sketches and of successive compactions cancel instead of adding up. How much is compacted follows the trailing ones of the number of
compactions so far, so the items next to the tail are touched exponentially seldom. The rank error is
therefore a fraction of the distance to the tail (1 - rank) instead of a fraction of all values: the 99.9th
percentile is as sound as the median. Levels of two sketches join level by level, so sketches of
partitions, hours or days combine in any order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.llm.codepoints import mix
from pagelathe.session import cut


class TailSketch:
    """Relative-rank compactors that protect the upper tail; ``section`` sets the accuracy."""

    def __init__(self, section: int = 64, sections: int = 4, seed: int = 0):
        self.section, self.start_sections, self.seed = section, sections, seed & 0xFFFFFFFFFFFF
        self.levels: list[np.ndarray] = [np.empty(0)]
        self.compactions: list[int] = [0]
        self.count, self.low, self.high = 0, np.inf, -np.inf

    def _sections(self, level: int) -> int:
        """More sections as a level compacts more often, so the error bound holds at every length."""
        return self.start_sections + int(np.log2(self.compactions[level] + 1))

    def _room(self, level: int) -> int:
        return 2 * self.section * self._sections(level)

    def add(self, values: np.ndarray) -> None:
        """Add finite values; long arrays go in runs, so the bottom level stays short."""
        for at in range(0, len(values), 1 << 16):
            part = values[at : at + (1 << 16)]
            self.count += len(part)
            self.low, self.high = min(self.low, part.min()), max(self.high, part.max())
            self.levels[0] = np.concatenate([self.levels[0], part])
            self._settle()

    def _settle(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self._room(level):
                self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        items = np.sort(self.levels[level])
        state = self.compactions[level]
        ones = (~state & (state + 1)).bit_length() - 1  # trailing ones: sections that join this time
        keep = self._room(level) // 2 + max(0, self._sections(level) - ones - 1) * self.section
        cut = max(2, len(items) - keep)
        cut -= cut % 2
        odd = self._coin(level, state // 2) ^ (state & 1)
        up, self.levels[level] = items[odd:cut:2], items[cut:]
        self.compactions[level] += 1
        if level + 1 == len(self.levels):
            self.levels.append(np.empty(0))
            self.compactions.append(0)
        self.levels[level + 1] = np.concatenate([self.levels[level + 1], up])

    def _coin(self, level: int, throw: int) -> int:
        x = (self.seed * 0x9E3779B97F4A7C15 + level * 0xBF58476D1CE4E5B9 + throw * 0x94D049BB133111EB + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) >> 40 & 1

    def merge(self, other: TailSketch) -> None:
        while len(self.levels) < len(other.levels):
            self.levels.append(np.empty(0))
            self.compactions.append(0)
        for h, items in enumerate(other.levels):
            self.levels[h] = np.concatenate([self.levels[h], items])
            self.compactions[h] |= other.compactions[h]
        self.seed = (self.seed * 31 + other.seed + 1) & 0xFFFFFFFFFFFF
        self.count += other.count
        self.low, self.high = min(self.low, other.low), max(self.high, other.high)
        self._settle()

    def quantiles(self, at: list[float]) -> list[float]:
        """Values at the ranks ``at``, interpolated between neighbours as ``percentile`` does; NaN if empty.

        Exact as long as nothing was compacted.
        """
        if not self.count:
            return [float("nan")] * len(at)
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(x), 1 << h, np.int64) for h, x in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        values, upto = values[order], np.cumsum(weights[order])
        out = []
        for q in at:
            place = q * (upto[-1] - 1)
            below = values[np.searchsorted(upto, np.floor(place), side="right")]
            above = values[np.searchsorted(upto, np.ceil(place), side="right")]
            out.append(float(min(max(below + (above - below) * (place - np.floor(place)), self.low), self.high)))
        return out

    def to_bytes(self) -> bytes:
        head = np.array([self.section, self.start_sections, len(self.levels), self.count, self.seed], np.int64)
        sizes = np.array([len(x) for x in self.levels] + self.compactions, np.int64)
        return b"".join([head.tobytes(), sizes.tobytes(), np.array([self.low, self.high]).tobytes(), np.concatenate(self.levels).astype(np.float64).tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> TailSketch:
        section, sections, levels, count, seed = np.frombuffer(raw, np.int64, 5).tolist()
        out = cls(section, sections, seed)
        sizes = np.frombuffer(raw, np.int64, 2 * levels, 40)
        out.count, out.compactions = count, sizes[levels:].tolist()
        at = 40 + 16 * levels
        out.low, out.high = np.frombuffer(raw, np.float64, 2, at).tolist()
        values = np.frombuffer(raw, np.float64, int(sizes[:levels].sum()), at + 16)
        out.levels = [x.copy() for x in np.split(values, np.cumsum(sizes[:levels])[:-1])]
        return out


_SKETCH = "sketch"


def _partial(keys: list[str], section: int, held_groups: int):
    """A sketch of each group in each task; when a task meets very many groups, what it holds goes out early."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, TailSketch] = {}
        # The task's number, not its attempt: a task run again makes the same sketches.
        task = TaskContext.get().partitionId() if TaskContext.get() else 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], pa.string()) for i in range(len(keys))]
            out = pa.RecordBatch.from_arrays([*columns, pa.array([s.to_bytes() for s in held.values()], pa.binary())], names=[*keys, _SKETCH])
            held.clear()
            return out

        for batch in batches:
            frame = batch.to_pandas()
            for key, values in frame.groupby(keys, dropna=False, sort=False)["__value"]:
                name = tuple(None if pd.isna(k) else k for k in key)
                if name not in held:
                    held[name] = TailSketch(section, seed=zlib.crc32(repr((task, name)).encode()))
                held[name].add(values.to_numpy(np.float64))
            if len(held) > held_groups:
                yield flush()
        if held:
            yield flush()

    return run


def _merge(keys: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        whole = TailSketch.from_bytes(group[_SKETCH].iloc[0])
        for raw in group[_SKETCH].iloc[1:]:
            whole.merge(TailSketch.from_bytes(raw))
        out = group[keys].iloc[:1].copy()
        out[_SKETCH] = [whole.to_bytes()]
        return out

    return run


def sketch_groups(df: DataFrame, keys: list[str], value: str, section: int = 64, held_groups: int = 20_000) -> DataFrame:
    """One sketch per group: columns ``keys`` (as strings) and sketch (binary).

    Null, NaN, infinite and negative values do not count; a group without a valid value is absent. Null keys form
    a group. Values never leave their task: what is shuffled is a sketch per group and task. These are first
    merged in 64 buckets of tasks, then the buckets, so no merge receives the sketches of all tasks of a hot group.
    """
    valid = df.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(value).cast("double").alias("__value")).where(
        F.col("__value").isNotNull() & ~F.isnan("__value") & (F.col("__value") >= 0) & (F.col("__value") < float("inf"))
    )
    fields = [T.StructField(k, T.StringType()) for k in keys] + [T.StructField(_SKETCH, T.BinaryType())]
    partial = valid.mapInArrow(_partial(keys, section, held_groups), T.StructType(fields))
    return merge_sketches(partial.withColumn("__bucket", F.pmod(F.spark_partition_id(), F.lit(64))), [*keys, "__bucket"], keys)


def merge_sketches(sketches: DataFrame, *steps: list[str]) -> DataFrame:
    """Combine sketches group by group, by each list of keys in turn (finest first)."""
    out = sketches
    for keys in steps:
        fields = [out.schema[k] for k in keys] + [T.StructField(_SKETCH, T.BinaryType())]
        out = out.select(*keys, _SKETCH).groupBy(*keys).applyInPandas(_merge(keys), T.StructType(fields))
    return out


def read_quantiles(sketches: DataFrame, at: list[float]) -> DataFrame:
    """The columns of ``sketches`` without the sketch, with n (values counted) and the array quantiles."""
    keys = [f for f in sketches.schema if f.name != _SKETCH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [TailSketch.from_bytes(x.as_py()) for x in batch.column(len(keys))]
            found = pa.array([s.quantiles(at) for s in sketches], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array([s.count for s in sketches], pa.int64()), found], names=[*(k.name for k in keys), "n", "quantiles"])

    fields = [*keys, T.StructField("n", T.LongType()), T.StructField("quantiles", T.ArrayType(T.DoubleType()))]
    return sketches.select(*[k.name for k in keys], _SKETCH).mapInArrow(run, T.StructType(fields))


#: Bits of the filter of repeated keys, at most (16 MB); beyond some ten million repeated keys more single rows pass it and are shuffled.
MOST_BITS = 1 << 27


def without_repeats(df: DataFrame, keys: list[str], most_bits: int = MOST_BITS) -> DataFrame:
    """One row of each ``keys`` (null equals null); which of several is not determined.

    Hashes of keys are counted first: eight bytes a row are shuffled. Those that repeat make a filter of bounded size; rows it does not hold
    stay where they are, and only those it holds are shuffled whole.
    """
    spark = df.sparkSession
    hashed = F.xxhash64(*keys)
    repeated = cut(df.groupBy(hashed.alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated-keys")
    count = repeated.count()
    if not count:
        return df
    bits = min(most_bits, 1 << max(10, (16 * count - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy(), bits):
                np.bitwise_or.at(held, place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(held.tobytes(), 1)], pa.binary())], names=["held"])

    parts = [np.frombuffer(zlib.decompress(r.held), np.uint8) for r in repeated.coalesce(4).mapInArrow(mark, "held binary").collect()]
    shared = spark.sparkContext.broadcast(np.bitwise_or.reduce(parts))

    @F.pandas_udf("boolean")
    def perhaps(h: pd.Series) -> pd.Series:
        held = shared.value
        out = np.ones(len(h), bool)
        for place in _places(h.to_numpy(), bits):
            out &= (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return pd.Series(out)

    marked = df.withColumn("__perhaps", perhaps(hashed))
    return marked.where("NOT __perhaps").drop("__perhaps").unionByName(marked.where("__perhaps").drop("__perhaps").dropDuplicates(keys))


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    h = hashes.astype(np.int64).view(np.uint64)
    return [(x % np.uint64(bits)).astype(np.int64) for x in (h, mix(h), mix(h + np.uint64(0x9E3779B97F4A7C15)))]


def metric_values(metrics: DataFrame) -> DataFrame:
    """Long form of page metrics: run_day, metric_field, metric_name, value; a page's run counts once.

    Null maps, and entries without seconds, yield nothing (or a null value, which no sketch counts). Rows are shuffled
    only if their key may be a repeated one.
    """
    seconds = F.transform_values("models", lambda _, m: m["seconds"]).alias("seconds")
    once = without_repeats(metrics.select("pdf_path", "page_index", "run_at", "timing_s", "models"), ["pdf_path", "page_index", "run_at"]).select("run_at", "timing_s", seconds)
    entry = lambda name: F.transform(F.map_entries(F.coalesce(F.col(name), F.expr("cast(map() as map<string,double>)"))), lambda e: F.struct(F.lit(name).alias("metric_field"), e["key"].alias("metric_name"), e["value"].alias("value")))
    each = once.select(F.date_format("run_at", "yyyy-MM-dd").alias("run_day"), F.explode(F.concat(entry("timing_s"), entry("seconds"))).alias("m"))
    return each.select("run_day", "m.metric_field", "m.metric_name", "m.value")
