"""The seam for models: batched calls with fall-back, splitting and isolation of failures.

A backend is loaded once in each Python worker by its factory and called with batches. No model is part of the engine; ``hash_embedder`` is a
deterministic stand-in for tests of the plumbing and has no meaning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of a service's reply that hold one result per item.
ITEM_KEYS = ("data", "output", "outputs", "results", "result")


class Backend(Protocol):
    """Takes a batch of inputs and returns as many outputs, in order."""

    def __call__(self, batch: Sequence[Any]) -> Sequence[Any]: ...


class BatchTooLarge(Exception):
    """Raised by a backend when a smaller batch may succeed."""


_LOADED: dict[str, Backend] = {}


def loaded(name: str, factory: Callable[[], Backend]) -> Backend:
    """The backend of this worker, made at its first use."""
    if name not in _LOADED:
        _LOADED[name] = factory()
    return _LOADED[name]


def call_batch(backend: Backend, batch: Sequence[Any], smallest: int = 1) -> list[tuple[Any, str | None]]:
    """(output, error) for each input. A batch too large is halved; a batch that fails otherwise is called item by item."""
    try:
        out = list(backend(batch))
        if len(out) != len(batch):
            raise ValueError(f"{len(out)} outputs for {len(batch)} inputs")
        return [(x, None) for x in out]
    except BatchTooLarge as problem:
        if len(batch) <= smallest:
            return [(None, f"{type(problem).__name__}: {problem}")] * len(batch)
        half = max(smallest, len(batch) // 2)
        return [r for at in range(0, len(batch), half) for r in call_batch(backend, batch[at : at + half], smallest)]
    except Exception as problem:
        if len(batch) == 1:
            return [(None, f"{type(problem).__name__}: {problem}")]
        return [call_batch(backend, [x], smallest)[0] for x in batch]


def embed(df: DataFrame, key: str, text: str, name: str, factory: Callable[[], Backend], batch: int = 64, prefix: str = "") -> DataFrame:
    """``key``, vector, error of every row with text. Blank texts are left out before the call, so rows stay aligned."""
    from pagelathe.functions.text import not_blank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = loaded(name, factory)
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                done = call_batch(backend, part.column(1).to_pylist())
                vectors = pa.array([None if v is None else np.asarray(v, np.float32) for v, _ in done], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), vectors, pa.array([e for _, e in done], pa.string())], names=[key, "vector", "error"])

    kind = df.schema[key].dataType.simpleString()
    return df.where(not_blank(text)).select(key, F.concat(F.lit(prefix), text).alias("t")).mapInArrow(run, f"`{key}` {kind}, vector array<float>, error string")


def split_failures(done: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Results, and skips (image_path, reason, details) of what failed."""
    failed = done.where("error IS NOT NULL")
    reason = F.when(F.col("error").startswith("BatchTooLarge"), "cuda_oom_runtime").otherwise("error")
    return done.where("error IS NULL").drop("error"), failed.select(F.col(key).cast("string").alias("image_path"), reason.alias("reason"), F.col("error").alias("details"))


class HashEmbedder:
    """Unit vectors from word hashes; equal texts give equal vectors."""

    def __init__(self, dimensions: int = 32):
        self.dimensions = dimensions

    def __call__(self, batch: Sequence[str]) -> list[np.ndarray]:
        out = []
        for text in batch:
            v = np.zeros(self.dimensions)
            for word in text.lower().split():
                h = hashlib.blake2b(word.encode(), digest_size=8).digest()
                v[int.from_bytes(h[:4], "little") % self.dimensions] += 1 if h[4] & 1 else -1
            out.append((v / max(np.linalg.norm(v), 1e-12)).astype(np.float32))
        return out


def hash_embedder() -> Backend:
    return HashEmbedder()


def items_of(reply: Any) -> list[Any] | None:
    """M2: the list of results in a service's reply, or None."""
    if isinstance(reply, list):
        return reply
    return next((v for k in ITEM_KEYS if isinstance(v := reply.get(k), list)), None) if isinstance(reply, dict) else None


def detections_of(item: Any) -> list[dict[str, Any]]:
    """M3, M4: detections (bbox, label, score) of one image's reply, from columns or from a list under several names.

    A label or score of 0 is a value, not a missing one, so the three never shift against each other.
    """
    if isinstance(item, dict) and all(isinstance(item.get(k), list) for k in ("boxes", "labels", "scores")):
        return [{"bbox": b, "label": x, "score": s} for b, x, s in zip(item["boxes"], item["labels"], item["scores"])]
    rows = item if isinstance(item, list) else next((v for k in ("detections", "objects", "items") if isinstance(v := item.get(k), list)), []) if isinstance(item, dict) else []
    pick = lambda d, *names: next((d[n] for n in names if d.get(n) is not None), None)
    found = [{"bbox": pick(d, "bbox", "box", "boxes"), "label": pick(d, "label", "labels", "class_id", "class"), "score": pick(d, "score", "scores", "confidence")} for d in rows if isinstance(d, dict)]
    return [d for d in found if d["bbox"] is not None]


def vectors_of(reply: Any) -> list[list[float]]:
    """Vectors of an embedding service's reply: a list of objects with ``embedding``, or lists, under ``data`` or ``embeddings``."""
    rows = reply
    if isinstance(reply, dict):
        rows = next((reply[k] for k in ("data", "embeddings", "embedding") if isinstance(reply.get(k), list)), None)
    if rows is None:
        raise ValueError("no vectors in the reply")
    if rows and all(isinstance(x, (int, float)) for x in rows):
        rows = [rows]
    return [[float(x) for x in (r["embedding"] if isinstance(r, dict) else r)] for r in rows]


class HttpBackend:
    """Posts batches as JSON to an endpoint and checks that as many results come back."""

    def __init__(self, endpoint: str, headers: dict[str, str] | None = None, timeout: float = 60.0, parse: Callable[[Any], list[Any] | None] = items_of):
        from pagelathe.functions.text import endpoint_url

        self.endpoint, self.headers, self.timeout, self.parse = endpoint_url(endpoint), {"Content-Type": "application/json", **(headers or {})}, timeout, parse
        if not self.endpoint:
            raise ValueError("an endpoint is needed")

    def __call__(self, batch: Sequence[Any]) -> list[Any]:
        import json
        from urllib.request import Request, urlopen

        with urlopen(Request(self.endpoint, json.dumps({"input": list(batch)}).encode(), self.headers), timeout=self.timeout) as reply:
            found = self.parse(json.load(reply))
        if found is None or len(found) != len(batch):
            raise ValueError(f"{None if found is None else len(found)} results for {len(batch)} inputs")
        return found


def device_list(wanted: str, available: int) -> list[int]:
    """device numbers of ``all`` or of a comma-separated list, each once, in order; one out of range is an error."""
    if wanted.strip().lower() == "all":
        return list(range(available))
    found = [int(x) for x in wanted.split(",") if x.strip()]
    wrong = [x for x in found if not 0 <= x < available]
    if wrong:
        raise ValueError(f"no devices {wrong} among {available}")
    return list(dict.fromkeys(found))
