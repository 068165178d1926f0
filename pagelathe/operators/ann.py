"""Approximate search with a stored index (V3, V5, V10, V11, K7, K15): inverted lists of quantised vectors.

``write_index`` fits cells on a bounded sample, assigns every row once and writes cells, codes (a byte per dimension) and vectors, sorted by cell, so a search
reads the cells it probes by the statistics of the files. ``search_index`` scores the probed cells by their codes, keeps a multiple of what is
wanted, and ranks these by the exact distance of their vectors. Index and search are separate calls; an index is opened by its path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelathe.operators.retrieval import _local_best, _matrix, _scores, _vectors

#: Rows the cells are fitted on, at most; rows of a cell one task scores; cells at most (32 MB of 64 dimensions).
MOST_SAMPLE, TASK_ROWS, MOST_CELLS = 65_536, 16_384, 65_536
#: Rows of a cell, in the mean, where no number of cells is given.
CELL_ROWS = 1024


@dataclass
class Index:
    """A stored index: rows (cell, id, code, v), centres, and lower end and step of each dimension's codes."""

    rows: DataFrame
    centres: np.ndarray
    low: np.ndarray
    step: np.ndarray


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 10, seed: int = 11) -> np.ndarray:
    """k-means centres (squared L2)."""
    cells = max(1, min(cells, len(sample)))
    centres = sample[np.random.default_rng(seed).choice(len(sample), cells, replace=False)].astype(np.float64)
    for _ in range(rounds):
        near = ((centres**2).sum(axis=1)[None] - 2 * sample @ centres.T).argmin(axis=1)
        size = np.bincount(near, minlength=cells)
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def write_index(corpus: DataFrame, path: str, key: str, vector: str, dimensions: int, cells: int | None = None, expected: int | None = None) -> int:
    """Write an index of every usable row of ``corpus`` to ``path``; the number of rows. The sample is a range of hashed ids.

    With ``expected`` (K7, K12) the number of rows read back must be it, else an error says how many are missing.
    """
    spark = corpus.sparkSession
    rows = _vectors(corpus, key, vector, dimensions)
    count = rows.count()
    cells = max(1, min(MOST_CELLS, -(-count // CELL_ROWS) if cells is None else cells))
    upto = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, MOST_SAMPLE / max(1, count)) * (1 << 64)))
    drawn = rows.where(F.xxhash64("id") <= F.lit(upto)).limit(2 * MOST_SAMPLE).orderBy("id").toArrow()
    sample = _matrix(drawn.column("v").combine_chunks()) if drawn.num_rows else np.zeros((1, dimensions))
    centres = fit_cells(sample, cells)
    low, high = sample.min(axis=0), sample.max(axis=0)
    step = np.where(high > low, (high - low) / 255, 1.0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            # Entries beyond the sample's range take its ends; the exact vectors beside the codes are not touched.
            codes = np.clip(np.rint((x - low) / step), 0, 255).astype(np.uint8)
            near = ((centres**2).sum(axis=1)[None] - 2 * x @ centres.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)], names=["cell", "id", "code", "v"])

    kind = rows.schema["v"].dataType.simpleString()
    placed = rows.mapInArrow(assign, f"cell int, id long, code binary, v {kind}")
    placed.repartitionByRange(max(1, -(-count // (64 * CELL_ROWS))), "cell", F.xxhash64("id")).sortWithinPartitions("cell").write.mode("overwrite").parquet(f"{path}/rows")
    meta = pa.table({"what": ["centre"] * len(centres) + ["low", "step"], "no": [*range(len(centres)), 0, 0], "values": [c.tolist() for c in (*centres, low, step)]})
    spark.createDataFrame(meta).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    held = spark.read.parquet(f"{path}/rows").count()
    if expected is not None and held != expected:
        raise ValueError(f"{held} of {expected} rows are in the index")
    return held


def open_index(spark: SparkSession, path: str) -> Index:
    meta = spark.read.parquet(f"{path}/meta").orderBy("what", "no").toArrow().to_pydict()
    of = lambda what: np.array([v for w, v in zip(meta["what"], meta["values"]) if w == what])
    return Index(spark.read.parquet(f"{path}/rows"), of("centre"), of("low")[0], of("step")[0])


def _probe(centres: np.ndarray, probes: int):
    probes = min(probes, len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            near = np.argpartition((centres**2).sum(axis=1)[None] - 2 * x @ centres.T, probes - 1, axis=1)[:, :probes]
            row = pa.array(np.repeat(np.arange(len(x)), probes))
            yield pa.RecordBatch.from_arrays([pa.array(near.reshape(-1).astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row)], names=["cell", "id", "v"])

    return run


def search_index(index: Index, queries: DataFrame, key: str, vector: str, dimensions: int, k: int = 10, probes: int = 4, metric: str = "l2_sq", skip_self: bool = False, widen: int = 4) -> DataFrame:
    """The ``k`` nearest rows in the ``probes`` nearest cells of each query: query_id, id, distance, rank.

    Of each part of a cell, the ``widen * k`` best by codes are ranked by their vectors. Cells longer than a task's rows are cut into parts, and queries visit every part.
    """
    asked = _vectors(queries, key, vector, dimensions)
    kind = asked.schema["v"].dataType.simpleString()
    asked = asked.mapInArrow(_probe(index.centres, probes), f"cell int, id long, v {kind}")
    wanted = [r.cell for r in asked.select("cell").distinct().collect()]  # one number for each cell
    rows = index.rows.where(F.col("cell").isin(wanted)) if len(wanted) <= len(index.centres) // 2 else index.rows
    parts = {r.cell: -(-r["count"] // TASK_ROWS) for r in rows.groupBy("cell").count().collect() if r["count"] > TASK_ROWS}
    many = F.coalesce(F.try_element_at(F.create_map(*[F.lit(int(x)) for pair in parts.items() for x in pair]), F.col("cell")), F.lit(1)).cast("long") if parts else F.lit(1).cast("long")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), many))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    low, step = index.low, index.step

    def scan(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        ids, vectors = c.column("id").to_numpy(), c.column("v").combine_chunks()
        codes = np.frombuffer(b"".join(c.column("code").to_pylist()), np.uint8).reshape(len(ids), -1) * step + low
        q_ids, q_rows = q.column("id").to_numpy(), _matrix(q.column("v").combine_chunks())
        exact, out = _matrix(vectors), []
        for i in range(len(q_ids)):
            rough = _scores(q_rows[i : i + 1], codes, metric)[0]
            # The query's own row does not take a place.
            few = np.argpartition(rough, widen * k)[: widen * k + 1] if len(rough) > widen * k + 1 else np.arange(len(rough))
            out.append(_local_best(q_ids[i : i + 1], q_rows[i : i + 1], ids[few], exact[few], k, metric, skip_self))
        return pa.Table.from_batches(out)

    met = asked.groupBy("cell", "part").cogroup(rows.groupBy("cell", "part")).applyInArrow(scan, "query_id long, id long, distance double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)
