"""Detections of a model's reply made ready for use (N2 to N4, G11): a score threshold, then suppression of overlapping boxes of one class."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.functions.labels import THRESHOLDS


def kept_boxes(boxes: np.ndarray, labels: np.ndarray, scores: np.ndarray, least: float, most_overlap: float) -> np.ndarray:
    """Positions that stay, best first: scores of at least ``least``; of boxes of one class that overlap by more than ``most_overlap`` (intersection over union) the best.

    Among equal scores the earlier position goes first. Boxes without area overlap nothing.
    """
    order = np.lexsort((np.arange(len(scores)), -scores))
    order = order[scores[order] >= least]
    x1, y1, x2, y2 = boxes.T if len(boxes) else np.zeros((4, 0))
    area = np.maximum(0, x2 - x1) * np.maximum(0, y2 - y1)
    kept = []
    while len(order):
        best, rest = order[0], order[1:]
        kept.append(best)
        shared = np.maximum(0, np.minimum(x2[best], x2[rest]) - np.maximum(x1[best], x1[rest])) * np.maximum(0, np.minimum(y2[best], y2[rest]) - np.maximum(y1[best], y1[rest]))
        union = area[best] + area[rest] - shared
        order = rest[(labels[rest] != labels[best]) | (np.divide(shared, union, out=np.zeros(len(rest)), where=union > 0) <= most_overlap)]
    return np.array(kept, np.int64)


def suppress(df: DataFrame, key: str | list[str], boxes: Column | str, labels: Column | str, scores: Column | str, kind: str = "page_elements", thresholds: tuple[float, float] | None = None) -> DataFrame:
    """Detections that stay of each row's parallel arrays: ``key`` (one or several integer columns), place (position in the arrays), rank (from 0, best first).

    ``kind`` names the model whose thresholds apply, unless ``thresholds`` gives them. Entries whose box has not four finite numbers, or that have no score, go; a
    null label is a class of its own; arrays count to the shortest. One row's detections are handled together, rows each for itself. An empty table gives none.
    """
    least, most = thresholds or THRESHOLDS[kind]
    keys = [key] if isinstance(key, str) else list(key)
    c = lambda x: F.col(x) if isinstance(x, str) else x
    finite = lambda x: x is not None and abs(x) < float("inf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, rank = [], [], []
            for n, (b, label, s) in enumerate(zip(*(x.to_pylist() for x in batch.columns[len(keys) :]))):
                sound = [(i, *e) for i, e in enumerate(zip(b or (), label or (), s or ())) if finite(e[2]) and e[0] is not None and len(e[0]) == 4 and all(finite(x) for x in e[0])]
                if sound:
                    kept = kept_boxes(np.array([r[1] for r in sound], float), np.array([-1 if r[2] is None else r[2] for r in sound]), np.array([r[3] for r in sound], float), least, most)
                    row += [n] * len(kept)
                    place += [sound[k][0] for k in kept]
                    rank += range(len(kept))
            owners = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*owners, pa.array(place, pa.int32()), pa.array(rank, pa.int32())], names=[*(f"k{i}" for i in range(len(keys))), "place", "rank"])

    rows = df.select(*[F.col(k).cast("long").alias(f"k{i}") for i, k in enumerate(keys)], c(boxes).cast("array<array<double>>").alias("b"), c(labels).cast("array<int>").alias("l"), c(scores).cast("array<double>").alias("s"))
    found = rows.mapInArrow(run, ", ".join([*(f"k{i} long" for i in range(len(keys))), "place int", "rank int"]))
    return found.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
