"""Keyword retrieval with BM25.

Documents are read and taken apart once: what is kept of each is its length and the counts of its terms, as hashes, and of these only the ones the
queries ask for. Every set of queries then reads that small table: a batch of documents meets all queries term by term, and what leaves a batch is k
rows per query. Nothing but those rows is shuffled for ranking.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.session import cut

#: Term-frequency saturation and length normalisation.
K1, B = 1.2, 0.75
#: Query terms that are broadcast to restrict what is kept of documents (32 MB; beyond, all terms are kept), queries scored in one pass, documents of a batch.
MOST_TERMS, MOST_QUERIES, BLOCK = 4_000_000, 1_000, 512
_TERM = r"[^\p{L}\p{N}]+"
_WORDS = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORDS.findall((text or "").lower())


def _hash(term: str) -> int:
    return int.from_bytes(blake2b(term.encode(), digest_size=8).digest(), "little", signed=True)


def corpus_statistics(docs: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """Documents that contain each term of ``vocabulary`` (column term): term, documents. Counted over all documents."""
    each = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text)), _TERM))).alias("term")).where("term <> ''")
    small = vocabulary.agg(F.sum(F.length("term") + 40)).first()[0] or 0
    return each.join(F.broadcast(vocabulary) if small <= 64 << 20 else vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


def postings(docs: DataFrame, key: str, text: str, asked: DataFrame) -> DataFrame:
    """One row per document with text: id, length (terms), terms (hashes of its distinct terms that ``asked``, a column q of queries, has), counts. Written once."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({_hash(t) for q in batch.column(0).to_pylist() for t in terms(q)}), pa.int64())], names=["h"])

    wanted = cut(asked.select("q").mapInArrow(hashed, "h long").distinct(), "query-terms")
    known = docs.sparkSession.sparkContext.broadcast(wanted.toArrow()["h"].to_numpy()) if wanted.count() <= MOST_TERMS else None

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_for = None if known is None else set(known.value.tolist())
        memory: dict[str, int] = {}
        for batch in batches:
            lengths, found, counts, upto = [], [], [], [0]
            for value in batch.column(1).to_pylist():
                words = terms(value)
                lengths.append(len(words))
                for term, n in Counter(words).items():
                    h = memory.get(term)
                    if h is None:
                        h = _hash(term)
                        if len(memory) < 500_000:
                            memory[term] = h
                    if asked_for is None or h in asked_for:
                        found.append(h)
                        counts.append(n)
                upto.append(len(found))
            lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(values, kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int32()), lists(found, pa.int64()), lists(counts, pa.int32())], names=["id", "length", "terms", "counts"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return cut(rows.mapInArrow(take_apart, "id long, length int, terms array<long>, counts array<int>"), "postings")


def _expanded(low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers low, low + 1, ... of each entry, and the entry of each."""
    which = np.repeat(np.arange(len(low)), many)
    return np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum()), which


def bm25_top_k(docs: DataFrame, key: str, text: str, queries: DataFrame, query_key: str, query: str, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each query: query_id, id, score (rounded to 6 decimals), rank.

    idf is ``ln(1 + (N - df + 0.5) / (df + 0.5))``; each distinct term of a query counts once. Documents without a common term are not
    listed; null texts are not part of the collection, rows without key count in its statistics only. Ties go to the smaller id. Query sets beyond the
    bound are scored in several passes over the postings.
    """
    spark = docs.sparkSession
    asked = queries.where(F.col(query_key).isNotNull() & F.col(query).isNotNull()).groupBy(F.col(query_key).cast("long").alias("query_id")).agg(F.min(query).alias("q"))
    asked = cut(asked, "bm25-queries")
    held = postings(docs, key, text, asked)
    size = held.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length")).first()
    if not size.length:
        return spark.createDataFrame([], "query_id long, id long, score double, rank int")
    n, mean = size.n, size.length / size.n
    documents = cut(held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
    passes = max(1, -(-asked.count() // MOST_QUERIES))
    scored = held.where("id IS NOT NULL AND size(terms) > 0")
    out = None
    for part in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == part).orderBy("query_id").collect()
        pairs = sorted({(_hash(t), j) for j, r in enumerate(rows) for t in terms(r.q)})
        mine = spark.createDataFrame(pa.table({"term": pa.array(sorted({h for h, _ in pairs}), pa.int64())}))
        df = documents.join(F.broadcast(mine), "term").orderBy("term").toArrow()  # terms of at most MOST_QUERIES queries
        hashes, counts = df["term"].to_numpy(), df["df"].to_numpy()
        # Queries of each term, in one array.
        q_term, q_no = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(q_term, hashes, "left")
        shared = spark.sparkContext.broadcast((hashes, np.log(1 + (n - counts + 0.5) / (counts + 0.5)), first, np.searchsorted(q_term, hashes, "right") - first, q_no, np.array([r.query_id for r in rows], np.int64)))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes, idf, first, many, q_no, q_ids = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows if len(hashes) else 0, BLOCK):
                    rows = batch.slice(at, BLOCK)
                    ids, length = rows.column(0).to_numpy(), rows.column(1).to_numpy()
                    term = rows.column(2).flatten().to_numpy()
                    count = rows.column(3).flatten().to_numpy()
                    doc = np.repeat(np.arange(len(ids)), np.diff(rows.column(2).offsets.to_numpy()))
                    place = np.minimum(np.searchsorted(hashes, term), len(hashes) - 1)
                    known = hashes[place] == term
                    place, count, doc = place[known], count[known], doc[known]
                    weight = idf[place] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[doc] / mean))
                    entry, which = _expanded(first[place], many[place])
                    s = np.bincount(q_no[entry] * len(ids) + doc[which], weight[which], len(q_ids) * len(ids)).reshape(len(q_ids), len(ids))
                    s = np.round(s, 6)
                    bound = np.partition(s, -k, axis=1)[:, -k][:, None] if s.shape[1] > k else np.zeros((len(s), 1))
                    q, d = np.nonzero((s >= bound) & (s > 0))
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(ids[d]), pa.array(s[q, d])], names=["query_id", "id", "score"])

        found = scored.mapInArrow(score, "query_id long, id long, score double")
        out = found if out is None else out.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)
