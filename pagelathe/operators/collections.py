"""Collections of vectors as tables: create, append, overwrite, delete, scan, catalogue, re-embed, search."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.operators.retrieval import fuse, top_k
from pagelathe.session import cut
from pagelathe.sources.schemas import CATALOG


class VectorStore(Protocol):
    """What any store offers."""

    def create_index(self, name: str, rows: DataFrame) -> None: ...
    def write_to_index(self, name: str, rows: DataFrame) -> None: ...
    def retrieval(self, name: str, queries: DataFrame, k: int) -> DataFrame: ...
    def run(self, name: str, rows: DataFrame) -> None: ...
    def reindex(self, name: str, embed: Callable[[DataFrame], DataFrame]) -> None: ...


class TableStore:
    """Collections as Parquet folders under one root, with a catalogue table beside them.

    Rows have id, vector, text, metadata and source. Every write adds a folder of rows, and then a manifest that lists the folders of the new version with the
    sources removed from each; the newest manifest is the collection, so a failed write leaves the old one, and an append writes its own rows only.
    """

    def __init__(self, spark: SparkSession, root: str, dimensions: int):
        self.spark, self.root, self.dimensions = spark, root.rstrip("/"), dimensions

    def _file(self, path: str):  # noqa: ANN202
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target  # noqa: SLF001

    def _manifest(self, name: str) -> tuple[int, list[dict]]:
        """Number and parts of the newest version; -1 and none if there is no collection."""
        fs, path = self._file(f"{self.root}/{name}/_manifests")
        found = sorted(p.getPath().getName() for p in fs.listStatus(path) if p.getPath().getName().endswith(".json")) if fs.exists(path) else []
        if not found:
            return -1, []
        lines = self.spark.read.text(f"{self.root}/{name}/_manifests/{found[-1]}", wholetext=True).first().value
        return int(found[-1][1:-5]), json.loads(lines)

    def _publish(self, name: str, number: int, parts: list[dict]) -> None:
        """A manifest appears whole or not at all; of two writers of one version the second fails."""
        fs, draft = self._file(f"{self.root}/{name}/_manifests/.draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        target = self._file(f"{self.root}/{name}/_manifests/m{number:08d}.json")[1]
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"another write of {name} came first")

    def _write(self, name: str, rows: DataFrame, append: bool = False) -> None:
        number, parts = self._manifest(name)
        folder = f"rows-{uuid.uuid4().hex}"
        rows.write.mode("error").parquet(f"{self.root}/{name}/{folder}")
        self._publish(name, number + 1, [*(parts if append else []), {"folder": folder, "without": []}])

    def exists(self, name: str) -> bool:
        return self._manifest(name)[0] >= 0

    def scan(self, name: str, with_vector: bool = True) -> DataFrame:
        """All rows of a collection."""
        number, parts = self._manifest(name)
        if number < 0:
            raise ValueError(f"no collection {name}")
        # Folders with the same sources removed are read as one.
        alike: dict[tuple[str, ...], list[str]] = {}
        for part in parts:
            alike.setdefault(tuple(part["without"]), []).append(f"{self.root}/{name}/{part['folder']}")
        rows = None
        for without, folders in alike.items():
            some = self.spark.read.option("mergeSchema", "true").parquet(*folders)
            for source in without:
                some = without_source(some, "source", source)
            rows = some if rows is None else rows.unionByName(some, allowMissingColumns=True)
        return rows if with_vector else rows.drop("vector")

    def compact(self, name: str) -> None:
        """Rewrite a collection of many appends and removals as one folder."""
        self._write(name, self.scan(name))

    def create_index(self, name: str, rows: DataFrame, recreate: bool = True) -> None:
        """K6, K9: make the collection of ``rows``; without ``recreate`` an existing one stays."""
        if recreate or not self.exists(name):
            self._write(name, rows)
            self._record(name)

    def write_to_index(self, name: str, rows: DataFrame) -> None:
        """Append; rows without vector or of another length are refused by count, not dropped unseen."""
        wrong = rows.where(F.col("vector").isNull() | (F.size("vector") != self.dimensions)).count()
        if wrong:
            raise ValueError(f"{wrong} rows without a vector of {self.dimensions} entries")
        if self.exists(name):
            self._write(name, rows, append=True)
        else:
            self.create_index(name, rows)

    def ingest(self, name: str, rows: DataFrame, batch_rows: int = 1000) -> str:
        """Rows come by one append if they are fewer than ``batch_rows``, else by one bulk write that is published when all its files are there; which of the two."""
        few = rows.limit(batch_rows).count() < batch_rows
        self.write_to_index(name, rows.coalesce(1) if few else rows)
        return "stream" if few else "bulk"

    def wait_for_rows(self, name: str, expected: int, timeout: float = 600.0, stalled: float = 60.0, every: float = 2.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> int:
        """Wait until the collection holds ``expected`` rows; their number. No growth for ``stalled`` seconds, or ``timeout``, is an error that tells how many there are."""
        begin = grew = clock()
        held = 0
        while True:
            now = self.scan(name, with_vector=False).count() if self.exists(name) else 0
            if now >= expected:
                return now
            if now > held:
                held, grew = now, clock()
            if clock() - grew >= stalled or clock() - begin >= timeout:
                raise TimeoutError(f"{now} of {expected} rows after {clock() - begin:.0f} s")
            sleep(every)

    def run(self, name: str, rows: DataFrame) -> int:
        """Create and count; the count is the check that the index holds all rows."""
        self.create_index(name, rows)
        return self.scan(name, with_vector=False).count()

    def run_async(self, name: str, rows: DataFrame) -> Future[int]:
        """``run`` in a thread of its own; the future gives the count or raises."""
        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(self.run, name, rows)
        finally:
            pool.shutdown(wait=False)

    def split_run(self, rows: DataFrame, kinds: dict[str, list[str]], kind: str) -> None:
        """One collection for each list of document types."""
        kept = cut(rows, "split-run")
        for name, wanted in kinds.items():
            self.create_index(name, kept.where(F.col(kind).isin(*wanted)))

    def remove_source(self, name: str, source: str) -> None:
        """All rows but those of a source; rows without source stay. No row is rewritten."""
        number, parts = self._manifest(name)
        if number < 0:
            raise ValueError(f"no collection {name}")
        self._publish(name, number + 1, [{**p, "without": sorted({*p["without"], source})} for p in parts])

    def reindex(self, name: str, embed: Callable[[DataFrame], DataFrame], target: str | None = None) -> None:
        """The collection with new vectors (``embed``: rows without vector -> id, vector), under its own or another name."""
        rows = self.scan(name, with_vector=False)
        self.create_index(target or name, cut(rows.join(embed(rows).select("id", "vector"), "id"), "reindex"))

    def retrieval(self, name: str, queries: DataFrame, k: int = 10, where: Column | str | None = None, keywords: DataFrame | None = None, reranker: Callable[[DataFrame], DataFrame] | None = None, widen: int = 50) -> DataFrame:
        """Nearest rows of each query (id, vector), from those that pass ``where``; fused with ranked ``keywords``
        (query_id, id, rank) if given; reranked from ``widen`` candidates by ``reranker`` if given. The vector is not returned (P2)."""
        rows = self.scan(name)
        rows = rows.where(where) if where is not None else rows
        found = top_k(rows, queries, "id", "vector", self.dimensions, max(k, widen) if reranker else k)
        if keywords is not None:
            found = fuse([found, keywords], max(k, widen) if reranker else k)
        if reranker:
            found = reranker(found).where(F.col("rank") <= k)
        return found.join(rows.drop("vector"), "id", "left")

    def catalog(self) -> DataFrame:
        """The newest record of each collection."""
        try:
            rows = self.spark.read.schema(CATALOG).json(f"{self.root}/_catalog")
        except AnalysisException:
            return self.spark.createDataFrame([], CATALOG)
        return rows.groupBy("collection_name").agg(*[F.max_by(c, "timestamp").alias(c) for c in rows.columns if c not in ("collection_name", "timestamp")], F.max("timestamp").alias("timestamp"))

    def _record(self, name: str, model: str = "") -> None:
        """K13."""
        row = self.spark.range(1).select(F.lit(name).alias("collection_name"), F.current_timestamp().cast("string").alias("timestamp"), F.lit("flat").alias("dense_index"), F.lit(self.dimensions).alias("dense_dim"), F.lit(model).alias("embedding_model"))
        row.write.mode("append").json(f"{self.root}/_catalog")


def without_source(rows: DataFrame, column: str, source: str) -> DataFrame:
    """A null source is not the source."""
    return rows.where(F.col(column).isNull() | (F.col(column) != source))


def catalog_match(catalog: DataFrame, match: str = "contains", **wanted: str) -> DataFrame:
    """records whose columns contain (or with ``match="exact"`` equal) the wanted values; others do not matter."""
    for column, value in wanted.items():
        c = F.col(column).cast("string")
        catalog = catalog.where(c.contains(value) if match == "contains" else c == value)
    return catalog
