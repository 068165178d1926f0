"""Most similar vectors for every vector: inverted lists with an adaptive dimension scan.

Vectors are normalised and turned by one random rotation, which spreads every difference evenly over the
dimensions. Each is put on its few nearest lists; two vectors are compared where they share a list.
A list is scanned in blocks of columns: after each block, the partial squared distance, scaled up to all
dimensions, is tested against what may still be among the k best: the similarity floor, or the k-th best of what was scanned so far (the first
stretch of a list is short, to get one). A candidate whose estimate lies significantly beyond is abandoned. While many candidates of a stretch are alive, a
block's partial distances are one matrix product; once few are, they are computed pair by pair. Survivors get the exact similarity.

Identical vectors are represented by their smallest id during the search, so a vector that a third of all rows
share costs as much as one. Lists expected to be too long for one task are cut into blocks, and every
pair of blocks is a task of its own: nothing is capped. Only centroids, fitted on a bounded sample, are broadcast; where there are many they
have two levels, and a vector meets only the lists of its few nearest cells. How many partitions lists are spread over follows from their expected bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.session import cut

#: Vectors of a list, in the mean, and lists at most (beyond some 67 million vectors lists grow, and are cut into more blocks).
LIST_ROWS, MOST_LISTS = 2048, 32_768
#: The sample that lists are fitted on: rows per list, and in all at most (100 MB of 96 dimensions).
SAMPLE_PER_LIST, MOST_SAMPLE = 64, 262_144
#: Lists from which on centroids have two levels, and cells of the upper level a vector looks into.
TWO_LEVELS, CELLS = 512, 12
#: Rows of a list that one task compares; longer lists are cut into blocks of about this size.
TASK_ROWS = 16_384
#: Bytes of vectors that one partition of lists should hold.
PARTITION_BYTES = 8 << 20
#: Width of a column block, and standard deviations an estimate must exceed the bound by.
COLUMNS, SIGNIFICANCE = 32, 2.1
#: Members scanned before the first k-th best is known, and then at once; pairs whose exact similarity is computed at once.
FIRST, STRETCH, PAIRS = 256, 2048, 1 << 17


def rotation(dimensions: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same for every call."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _unit(values: np.ndarray) -> np.ndarray:
    wide = values.astype(np.float64)
    # First by the largest entry: tiny and huge vectors neither vanish nor overflow.
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids by k-means on unit vectors."""
    lists = min(lists, len(sample))
    if lists <= 1:
        return np.zeros((1, sample.shape[1]), np.float32)
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        where = (sample @ centroids.T).argmax(axis=1)
        order = np.argsort(where, kind="stable")
        found, first = np.unique(where[order], return_index=True)
        total = np.zeros_like(centroids)
        total[found] = np.add.reduceat(sample[order], first, axis=0)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(size > 0, total / np.maximum(size, 1e-12), centroids).astype(np.float32)
    return centroids


class Lists:
    """Centroids of lists; where there are many, in cells of an upper level."""

    def __init__(self, sample: np.ndarray, lists: int):
        if lists <= TWO_LEVELS:
            self.cells, self.first, self.centroids = None, None, fit_lists(sample, lists)
            return
        self.cells = fit_lists(sample, int(np.sqrt(lists)))
        where = (sample @ self.cells.T).argmax(axis=1)
        share = np.bincount(where, minlength=len(self.cells)) / len(sample)
        fine = [fit_lists(sample[where == c], max(2, round(lists * s))) if s > 0 else self.cells[c : c + 1] for c, s in enumerate(share)]
        # A cell of one sampled vector has no fitted centroid.
        fine = [f if np.any(f) else self.cells[c : c + 1] for c, f in enumerate(fine)]
        self.first = np.cumsum([0, *(len(f) for f in fine)])
        self.centroids = np.concatenate(fine)

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """Numbers of the ``probes`` nearest lists of each row."""
        probes = min(probes, len(self.centroids))
        if self.cells is None:
            return _best_columns(x @ self.centroids.T, probes)
        cells = _best_columns(x @ self.cells.T, min(CELLS, len(self.cells)))
        best = np.full((len(x), probes), -np.inf, np.float32)
        number = np.zeros((len(x), probes), np.int64)
        row, cell = np.repeat(np.arange(len(x)), cells.shape[1]), cells.reshape(-1)
        order = np.argsort(cell, kind="stable")
        bounds = np.searchsorted(cell[order], np.arange(len(self.cells) + 1))
        for c in range(len(self.cells)):
            mine = row[order[bounds[c] : bounds[c + 1]]]
            if not len(mine):
                continue
            low, high = self.first[c], self.first[c + 1]
            score = np.concatenate([best[mine], x[mine] @ self.centroids[low:high].T], axis=1)
            which = np.concatenate([number[mine], np.broadcast_to(np.arange(low, high), (len(mine), high - low))], axis=1)
            top = _best_columns(score, probes)
            best[mine], number[mine] = np.take_along_axis(score, top, 1), np.take_along_axis(which, top, 1)
        return number


def _best_columns(score: np.ndarray, few: int) -> np.ndarray:
    if few >= score.shape[1]:
        return np.broadcast_to(np.arange(score.shape[1]), score.shape)
    return np.argpartition(-score, few - 1, axis=1)[:, :few]


def _blocks(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Column blocks, each stored contiguously, with the squared length of every row within it."""
    parts = [np.ascontiguousarray(x[:, at : at + COLUMNS]) for at in range(0, x.shape[1], COLUMNS)]
    return [(p, np.einsum("ij,ij->i", p, p)) for p in parts]


def adaptive_scan(queries: np.ndarray, members: np.ndarray, query_ids: np.ndarray, member_ids: np.ndarray, k: int, floor: float = -1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k most similar members of each query with similarity of at least ``floor``: query id, member id, similarity.

    Rows are unit vectors under the common rotation; a member of the same id is no neighbour. Ties go to the
    smaller id. Without a floor the bound is the k-th best so far alone.
    """
    dims = queries.shape[1]
    cuts = [*range(COLUMNS, dims, COLUMNS), dims]
    bound = np.full(len(queries), 2 * (1 - floor) + 1e-6, np.float32)  # squared distance that may still matter
    best_q, best_m, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q_blocks, m_blocks = _blocks(queries), _blocks(members)
    slack = [np.float32((1 + SIGNIFICANCE / np.sqrt(d)) ** 2 * d / dims) if d < dims else np.float32(1.0) for d in cuts]
    at = 0
    while at < len(members):
        to = at + (FIRST if at == 0 else STRETCH)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row in range(0, len(queries), STRETCH):
            q, m = _alive(q_blocks, m_blocks, slice(row, row + STRETCH), slice(at, to), bound[row : row + STRETCH], slack, k)
            q, m = q + row, m + at
            other = query_ids[q] != member_ids[m]
            q, m = q[other], m[other]
            for begin in range(0, len(q), PAIRS):
                a, b = q[begin : begin + PAIRS], m[begin : begin + PAIRS]
                exact = np.einsum("ij,ij->i", queries[a].astype(np.float64), members[b].astype(np.float64))
                keep = exact >= floor
                found.append((a[keep], b[keep], exact[keep]))
        at = to
        if not found:
            continue
        best_q, best_m, best_s = (np.concatenate([b, *f]) for b, f in zip((best_q, best_m, best_s), zip(*found)))
        order = np.lexsort((member_ids[best_m], -best_s, best_q))
        best_q, best_m, best_s = best_q[order], best_m[order], best_s[order]
        new = np.ones(len(best_q), bool)
        new[1:] = best_q[1:] != best_q[:-1]
        start = np.flatnonzero(new)
        rank = np.arange(len(best_q)) - np.repeat(start, np.diff(np.append(start, len(best_q))))
        keep = rank < k
        best_q, best_m, best_s, rank = best_q[keep], best_m[keep], best_s[keep], rank[keep]
        full = rank == k - 1
        bound[best_q[full]] = np.minimum(bound[best_q[full]], 2 * (1 - best_s[full]) + 1e-6)
    return query_ids[best_q], member_ids[best_m], best_s


def _alive(q_blocks: list, m_blocks: list, rows: slice, columns: slice, bound: np.ndarray, slack: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a stretch that no column block's test abandons."""
    partial = near = q = m = rest = None
    for (qb, qn), (mb, mn), loose in zip(q_blocks, m_blocks, slack):
        if q is not None:
            gap = qb[rows][q] - mb[columns][m]
            rest = rest + np.einsum("ij,ij->i", gap, gap)
            keep = rest <= bound[q] * loose + np.float32(1e-5)
            q, m, rest = q[keep], m[keep], rest[keep]
            continue
        part = qb[rows] @ mb[columns].T
        part *= -2
        part += qn[rows][:, None]
        part += mn[columns][None]
        partial = part if partial is None else np.add(partial, part, out=partial)
        alive = partial <= (bound * loose + np.float32(1e-5))[:, None]
        near = alive if near is None else np.logical_and(near, alive, out=near)
        if np.count_nonzero(near) <= near.size // 16:
            q, m = np.nonzero(near)
            rest = partial[q, m]
    if q is None:
        # Many are within the bound still: of each query those that the stretch's own best leave (its own row may be among them).
        few = k + 1
        if partial.shape[1] > few:
            near &= partial <= np.partition(np.where(near, partial, np.inf), few - 1, axis=1)[:, few - 1 : few] + np.float32(1e-4)
        q, m = np.nonzero(near)
    return q, m


def _assign(known: Lists, turn: np.ndarray, probes: int, blocks: np.ndarray):
    """Rows (task, side, id, vector): a list of one block is task (list, 0, 0); else one task for each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _matrix(batch, turn)
            for at in range(0, len(ids), 4096):
                part, own = x[at : at + 4096], ids[at : at + 4096]
                lists = known.nearest(part, probes)
                row = np.repeat(np.arange(len(own)), lists.shape[1])
                where = lists.reshape(-1)
                many = blocks[where]
                mine = (own[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % many
                row, where, many, mine = (np.repeat(v, many) for v in (row, where, many, mine))
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (where[1:] != where[:-1])
                begins = np.flatnonzero(new)
                other = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                task = (where << 32) | (low << 16) | high
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(part.shape[1] * 4), len(row), [None, pa.py_buffer(np.ascontiguousarray(part[row]))])
                yield pa.RecordBatch.from_arrays([pa.array(task), pa.array((mine == high).astype(np.int8)), pa.array(own[row]), raw.cast(pa.binary())], names=["task", "side", "id", "unit"])

    return run


def _matrix(batch: pa.RecordBatch, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    vectors = batch.column(1)
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    return batch.column(0).to_numpy(), (_unit(values) @ turn if len(values) else values.reshape(0, len(turn)).astype(np.float32))


def _scan(dimensions: int, k: int, floor: float):
    def run(rows: pa.Table) -> pa.Table:
        task = rows.column("task")[0].as_py()
        rows = rows.combine_chunks()
        ids, side = rows.column("id").to_numpy(), rows.column("side").to_numpy()
        raw = rows.column("unit").combine_chunks()
        x = np.frombuffer(b"".join(raw.to_pylist()), np.float32).reshape(len(ids), dimensions)
        if (task >> 16) & 0xFFFF == task & 0xFFFF:
            parts = [adaptive_scan(x, x, ids, ids, k, floor)]
        else:
            a, b = side == 0, side == 1
            parts = [adaptive_scan(x[a], x[b], ids[a], ids[b], k, floor), adaptive_scan(x[b], x[a], ids[b], ids[a], k, floor)]
        q, m, s = (np.concatenate(c) for c in zip(*parts))
        return pa.table({"id": pa.array(q, pa.int64()), "other": pa.array(m, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return run


def usable_vectors(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """Columns id and vector of the rows with exactly ``dimensions`` finite numbers, not all zero, and a key."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & (F.size(vector) == dimensions) & finite & F.exists(F.col(vector), lambda x: x != 0)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector"))


def nearest(usable: DataFrame, dimensions: int, k: int, floor: float = -1.0, rows: int | None = None, probes: int = 3, list_rows: int = LIST_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Columns id, other, similarity, rank: the k most similar other vectors of each, as far as they share a list.

    ``usable`` has unique ids and the column vector. ``rows`` is their number if known; at most ``list_rows`` of them are compared exhaustively.
    Without a ``floor`` every vector gets its k nearest.
    """
    rows = usable.count() if rows is None else rows
    lists = max(1, min(MOST_LISTS, -(-rows // list_rows)))
    turn = rotation(dimensions)
    x = np.zeros((0, dimensions), np.float32)
    if lists > 1:
        take = min(MOST_SAMPLE, SAMPLE_PER_LIST * lists)
        # A range of hashes that holds about this many rows; no more leave a task than belong to the sample.
        upto = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, take / rows) * (1 << 64)))
        drawn = usable.where(F.xxhash64("id") <= F.lit(upto)).select("vector").limit(2 * take).toArrow()
        x = _unit(drawn.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dimensions)) @ turn
    known = Lists(x, lists)
    probes = min(probes, len(known.centroids))
    expected = np.bincount(known.nearest(x, probes).reshape(-1), minlength=len(known.centroids)) * rows / len(x) if len(x) else np.array([rows])
    blocks = np.maximum(1, np.ceil(expected / task_rows)).astype(np.int64)
    # A row goes to every pair of its list's blocks that its block is in.
    bytes_all = float((expected * blocks).sum()) * (4 * dimensions + 24)
    partitions = max(usable.sparkSession.sparkContext.defaultParallelism, min(int(blocks.sum()), -(-int(bytes_all) // PARTITION_BYTES)))
    spread = usable.mapInArrow(_assign(known, turn, probes, blocks), "task long, side byte, id long, unit binary").repartition(int(partitions), "task")
    found = spread.groupBy("task").applyInArrow(_scan(dimensions, k, floor), "id long, other long, similarity double")
    # A pair may share several lists; each gives the same similarity.
    once = found.groupBy("id", "other").agg(F.max("similarity").alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def similar_pairs(df: DataFrame, key: str, vector: str, dimensions: int = 96, k: int = 5, floor: float = 0.85, probes: int = 3, list_rows: int = LIST_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Pairs with cosine similarity of at least ``floor`` of which at least one is among the ``k`` most similar of the other.

    Columns: id_a < id_b. Ties go to the smaller id; a vector is not its own neighbour. Vectors that are null, of
    another length, or hold a null, NaN or infinite entry or only zeros take no part, nor do rows without key.
    Identical vectors are neighbours of similarity 1; rows that repeat an id count once. Copies are never expanded into all
    pairs: of a class of copies, each is paired with the ``k`` of smallest id. An empty table gives none.
    """
    usable = usable_vectors(df, key, vector, dimensions)
    marked = usable.groupBy("id", F.xxhash64("vector").alias("h1"), F.xxhash64(F.reverse("vector")).alias("h2")).agg(F.count(F.lit(1)).alias("times"))
    marked = cut(marked, "vector-classes")
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    counts = marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep"))
    several = cut(counts.where("copies > 1"), "vector-copies")
    members = cut(marked.join(several, ["h1", "h2"]).select("id", "rep", "copies", "h1", "h2"), "vector-members")
    first = members.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("rep", "copies").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    first = cut(first, "vector-first")
    repeats = members.where("id != rep").select("id")
    single = usable.join(repeats, "id", "left_anti")
    # Ids that occur in several rows are reduced to one row before the search.
    seen = marked.agg(F.sum("times").alias("rows"), F.countDistinct("id").alias("ids")).first()
    if seen.rows and seen.rows != seen.ids:
        single = single.dropDuplicates(["id"])
    near = nearest(single, dimensions, k, floor, counts.count(), probes, list_rows, task_rows)
    # Each class lists its own members first, then those of its neighbour classes, until k are found.
    wide = near.join(first.select(F.col("rep").alias("other"), F.col("ids").alias("other_ids")), "other", "left")
    wide = wide.join(first.select(F.col("rep").alias("id"), "copies", "ids"), "id", "left").where(F.coalesce("copies", F.lit(1)) <= k)
    reach = wide.select(
        "id", F.coalesce("ids", F.array("id")).alias("ids"), F.coalesce("copies", F.lit(1)).alias("copies"), "similarity",
        F.posexplode(F.slice(F.coalesce("other_ids", F.array("other")), 1, k)).alias("no", "neighbour"),
    )
    turn = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    across = reach.withColumn("turn", turn).where(F.col("turn") <= k - F.col("copies") + 1).select(F.explode("ids").alias("a"), F.col("neighbour").alias("b"))
    within = members.join(first.select("rep", "ids"), "rep").select(F.col("id").alias("a"), F.explode(F.slice(F.filter("ids", lambda x: x != F.col("id")), 1, k)).alias("b"))
    return across.unionByName(within).select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()
