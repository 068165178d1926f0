"""Repetition inside a document, by labelling its lines with a linear-chain conditional random field.

A document is cut into units: lines, and runs of 16 words within long lines. Each unit has a few features that say how
much of it stood earlier in the same document; a two-state chain (content, repeated) is decoded by Viterbi, so
an isolated echo inside content stays content and a short new line inside a repeated block stays
repeated. The share of words outside repeated units is the document's content share, which alone decides
retention. The exact share of repeated words is reported beside it.

The field's weights are learned here, by gradient ascent on the likelihood of a bounded sample of documents
whose units are labelled by the exact definition (a run of 8 words that stood earlier).
Decoding is vectorised over documents: step t handles the t-th unit of every document that has one.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.codepoints import decode, mix, slices, words

#: Words in a run that counts as repeated, and in the shorter run that the field's features look at.
RUN, FEATURE_RUN = 8, 6
#: Words of a unit, at most.
UNIT_WORDS = 8
#: Units of a chain the field is fitted on, at most (decoding takes whole documents).
FIT_UNITS = 32
#: Labelled documents the field is fitted on, at most, and units of each of them.
SAMPLE_DOCUMENTS, DRAWN_UNITS = 600, 256


def repeated_words(hashes: np.ndarray, owner: np.ndarray, run: int) -> np.ndarray:
    """True for each word within a run of ``run`` words that equals one starting earlier in the same text."""
    n = len(hashes) - run + 1
    out = np.zeros(len(hashes), bool)
    if n <= 0:
        return out
    gram = np.zeros(n, np.uint64)
    for k in range(run):
        gram = gram * np.uint64(0xBF58476D1CE4E5B9) + hashes[k : k + n]
    at = np.flatnonzero(owner[:n] == owner[run - 1 :])
    key = mix(gram[at]) ^ mix(owner[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    begins = at[order[1:][again]]
    change = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + run, -1)
    return np.cumsum(change[:-1]) > 0


@dataclass
class Units:
    """Units of a slice of texts in reading order, with their words and features."""

    owner: np.ndarray
    words: np.ndarray
    repeated: np.ndarray
    features: np.ndarray


def units_of(codes: np.ndarray, starts: np.ndarray) -> Units:
    begin, end, hashes, owner = words(codes, starts)
    exact, near = repeated_words(hashes, owner, RUN), repeated_words(hashes, owner, FEATURE_RUN)
    stop = codes == 10
    stops_before = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(stop, out=stops_before[1:])
    # A unit's words share their text and the number of unit ends before them.
    mark = stops_before[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (owner[1:] != owner[:-1])
    # No unit is longer than UNIT_WORDS, so a repeated stretch within a long unit stands out.
    first = np.flatnonzero(new)
    within = np.arange(len(begin)) - np.repeat(first, np.diff(np.append(first, len(begin))))
    first = np.flatnonzero(within % UNIT_WORDS == 0)
    if not len(first):
        return Units(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, 6)))
    size = np.diff(np.append(first, len(begin)))
    share = np.add.reduceat(near.astype(np.int64), first) / size
    # A unit that stood before as a whole, whatever its length.
    whole = np.add.reduceat(hashes * mix(np.arange(len(hashes), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64) + np.uint64(7)), first)
    key = mix(whole) ^ mix(owner[first].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    echo = np.zeros(len(first), bool)
    echo[order[1:][key[order][1:] == key[order][:-1]]] = True
    features = np.stack([np.ones(len(first)), share, share >= 0.5, echo & (size >= 3), np.log1p(size) / 4, share * np.minimum(size, 16) / 16], axis=1)
    return Units(owner[first], size, np.add.reduceat(exact.astype(np.int64), first), features)


class LineField:
    """A linear-chain conditional random field with the states content (0) and repeated (1)."""

    def __init__(self, weights: np.ndarray | None = None, steps: np.ndarray | None = None, begin: np.ndarray | None = None):
        self.weights = np.zeros((6, 2)) if weights is None else weights
        self.steps = np.zeros((2, 2)) if steps is None else steps
        self.begin = np.zeros(2) if begin is None else begin

    @staticmethod
    def _layout(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """First unit of each chain, longest chain first, its length, and how many chains reach each step."""
        new = np.ones(len(owner), bool)
        new[1:] = owner[1:] != owner[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(owner)))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        return first, size, alive.tolist()

    def decode(self, owner: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The most probable state of each unit (Viterbi)."""
        states = np.zeros(len(owner), np.int8)
        if not len(owner):
            return states
        emit = features @ self.weights
        first, size, alive = self._layout(owner)
        score = emit[first] + self.begin
        back = np.zeros((len(owner), 2), np.int8)
        for t in range(1, len(alive)):
            m = alive[t]
            paths = score[:m, :, None] + self.steps[None]
            at = first[:m] + t
            back[at] = paths.argmax(axis=1)
            score[:m] = paths.max(axis=1) + emit[at]
        state = score.argmax(axis=1).astype(np.int8)
        for t in range(len(alive) - 1, -1, -1):
            m = alive[t]
            at = first[:m] + t
            states[at] = state[:m]
            if t:
                state[:m] = back[at, state[:m]]
        return states

    def fit(self, owner: np.ndarray, features: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 3.0, decay: float = 1e-4) -> LineField:
        """Maximum likelihood by gradient ascent; expectations come from forward and backward sums."""
        if not len(owner):
            return self
        first, size, alive = self._layout(owner)
        n, hot = len(owner), np.eye(2)[labels]
        seen_steps = np.zeros((2, 2))
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        np.add.at(seen_steps, (labels[inner], labels[inner + 1]), 1)
        seen_begin = hot[first].sum(axis=0)
        # Repeated units are rare; both states weigh the same on the emission weights.
        weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))[:, None] * n
        for _ in range(rounds):
            emit = features @ self.weights
            fore, aft = np.zeros((n, 2)), np.zeros((n, 2))
            fore[first] = emit[first] + self.begin
            for t in range(1, len(alive)):
                at = first[: alive[t]] + t
                fore[at] = np.logaddexp.reduce(fore[at - 1][:, :, None] + self.steps[None], axis=1) + emit[at]
            for t in range(len(alive) - 1, 0, -1):
                at = first[: alive[t]] + t
                aft[at - 1] = np.logaddexp.reduce(self.steps[None] + (emit[at] + aft[at])[:, None, :], axis=2)
            logz = np.logaddexp.reduce(fore[first + size - 1], axis=1)
            chain = np.empty(n, np.int64)
            chain[np.concatenate([np.arange(f, f + s) for f, s in zip(first, size)])] = np.repeat(np.arange(len(first)), size)
            belief = np.exp(fore + aft - logz[chain][:, None])
            pair = np.exp(fore[inner][:, :, None] + self.steps[None] + (emit[inner + 1] + aft[inner + 1])[:, None, :] - logz[chain[inner]][:, None, None])
            self.weights += rate * (features.T @ (weight * (hot - belief)) / n - decay * self.weights)
            self.steps += rate * ((seen_steps - pair.sum(axis=0)) / n - decay * self.steps)
            self.begin += rate * ((seen_begin - belief[first].sum(axis=0)) / len(first) - decay * self.begin)
        return self


def _labels(u) -> np.ndarray:  # noqa: ANN001
    return (2 * u.repeated >= u.words).astype(np.int64)


_DRAWN = "k string, owner long, features array<double>, label int"


def _drawn_units(repeating: bool, most: int):
    """Units of documents with their labels, the first ``most`` of each document; with ``repeating``, only documents that have a repeated one among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                u = units_of(*decode(part.column(1)))
                labels = _labels(u)
                new = np.ones(len(u.owner), bool)
                new[1:] = u.owner[1:] != u.owner[:-1]
                first = np.flatnonzero(new)
                keep = np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new)))) < most
                if repeating:
                    keep &= (np.bincount(u.owner[keep], labels[keep], part.num_rows) > 0)[u.owner]
                owner = u.owner[keep]
                features = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1, dtype=np.int32) * u.features.shape[1]), pa.array(u.features[keep].reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)).cast(pa.string()), pa.array(owner.astype(np.int64)), features, pa.array(labels[keep].astype(np.int32))], names=["k", "owner", "features", "label"])

    return run


def train_field(df: DataFrame, key: str, text: str, sample: int = SAMPLE_DOCUMENTS) -> LineField:
    """Fit the field on about ``sample`` documents drawn by hash; their units are labelled by the exact definition.

    What is collected is the features and labels of at most DRAWN_UNITS units of each drawn document, never texts. The draw is a range of hashes, so
    no task sends more rows than belong to the sample. If it holds no repeated unit, half as many documents that do are added, those of
    smallest hash; if there are none at all, a warning says so.
    """
    count = df.count()
    upto = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, sample / max(1, count)) * (1 << 64)))
    full = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("text"))
    hashed = F.xxhash64("k", "text")  # rows that share a key are drawn each for itself
    drawn = full.where(hashed <= F.lit(upto)).limit(2 * sample).mapInArrow(_drawn_units(False, DRAWN_UNITS), _DRAWN).toArrow()
    if not pc.any(pc.greater(drawn["label"], 0)).as_py():
        some = full.mapInArrow(_drawn_units(True, DRAWN_UNITS), _DRAWN).groupBy("k").agg(F.collect_list(F.struct("owner", "features", "label")).alias("u")).orderBy(F.xxhash64("k"), "k").limit(max(1, sample // 2))
        drawn = pa.concat_tables([drawn, some.selectExpr("k", "inline(u)").toArrow().cast(drawn.schema)])
        if not pc.any(pc.greater(drawn["label"], 0)).as_py():
            warnings.warn("no document has a repeated unit; the field takes all units for content", stacklevel=2)
    # Units of a document stand together and in order; documents are put in the order of their keys, so the fit does not depend on tasks.
    keys, owners = drawn["k"].to_pylist(), drawn["owner"].to_numpy()
    place = np.array(sorted(range(len(keys)), key=lambda i: keys[i]), np.int64)
    features = drawn["features"].combine_chunks().flatten().to_numpy().reshape(len(keys), -1)[place] if keys else np.zeros((0, 6))
    labels = drawn["label"].to_numpy()[place].astype(np.int64)
    names = np.array(keys, object)[place] if keys else np.zeros(0, object)
    owners = owners[place]
    new = np.ones(len(place), bool)
    new[1:] = (names[1:] != names[:-1]) | (owners[1:] != owners[:-1])
    # Chains are fitted in stretches of FIT_UNITS units, so one long document does not set the number of steps.
    first = np.flatnonzero(new)
    within = np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))
    chain = np.cumsum(new | (within % FIT_UNITS == 0))
    return LineField().fit(chain, features, labels)


def _label(field: LineField, retain: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                u = units_of(*decode(part.column(1)))
                states = field.decode(u.owner, u.features)
                n = part.num_rows
                total = np.bincount(u.owner, u.words, n)
                content = np.bincount(u.owner, u.words * (states == 0), n)
                exact = np.bincount(u.owner, u.repeated, n)
                with np.errstate(invalid="ignore", divide="ignore"):
                    content_share = np.where(total > 0, content / total, 1.0)
                    share = np.where(total > 0, exact / total, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total.astype(np.int64)), pa.array(np.bincount(u.owner, minlength=n).astype(np.int64)), pa.array(np.bincount(u.owner, states == 1, n).astype(np.int64)), pa.array(content_share), pa.array(content_share > retain), pa.array(share)],
                    names=["owner", "words", "units", "repeated_units", "content_share", "retained", "repeated_share"],
                )

    return run


def repetition(df: DataFrame, key: str, text: str, retain: float = 0.7, sample: int = SAMPLE_DOCUMENTS, field: LineField | None = None) -> DataFrame:
    """Repetition of every document: ``key``, words, units, repeated_units, content_share (share of words in units
    the field labels content), retained (content_share is above ``retain``) and repeated_share (exact share of
    words in a run of 8 words that stood earlier in the document).

    One row per row of ``df``, repeated keys included. Null, empty and wordless texts have 0 words, content
    share 1 and repeated share 0, and are retained. Whole texts are read; nothing is shuffled. ``field`` may be
    given; else it is fitted on at most ``sample`` documents.
    """
    field = field or train_field(df, key, text, sample)
    schema = "owner long, words long, units long, repeated_units long, content_share double, retained boolean, repeated_share double"
    return df.select(F.col(key).cast("long").alias("owner"), F.col(text).alias("text")).mapInArrow(_label(field, retain), schema).withColumnRenamed("owner", key)
