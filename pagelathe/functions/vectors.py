"""Vector functions over array columns. Sums are taken in double, in order of the entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: keeps a zero vector's norm from being divided by.
EPSILON = 1e-12
#: Keys that may hold an embedding, in order of preference.
EMBEDDING_KEYS = ("pooler_output", "sentence_embedding", "embeddings", "embedding")
HIDDEN_KEYS = ("last_hidden_state", "hidden_states")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2_squared(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def l2(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(l2_squared(a, b))


def norm(a: Column | str) -> Column:
    return F.sqrt(_total(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def normalised(a: Column | str, floor: bool = False) -> Column:
    """``v / (|v| + eps)``; with ``floor`` V14: ``v / max(|v|, eps)``, which differs for tiny vectors."""
    size = norm(a)
    by = F.greatest(size, F.lit(EPSILON)) if floor else size + F.lit(EPSILON)
    return F.transform(_c(a), lambda x: x.cast("double") / by)


def mean_pool(rows: Column | str, mask: Column | str) -> Column:
    """Unit vector of the mean of the rows whose mask is 1; null without any."""
    kept = F.transform(F.filter(F.arrays_zip(_c(rows).alias("v"), _c(mask).alias("m")), lambda r: r["m"] == 1), lambda r: r["v"])
    total = F.aggregate(kept, F.transform(F.get(kept, 0), lambda x: F.lit(0.0)), lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y.cast("double")))
    return F.when(F.size(kept) > 0, normalised(F.transform(total, lambda x: x / F.size(kept)), floor=True))


def embedding_from_json(json: Column | str) -> Column:
    """A 1-d vector of an embedding service's JSON: the preferred key's first row, or the mean of the first hidden states."""
    c = _c(json)
    flat = [F.from_json(F.get_json_object(c, f"$.{k}"), "array<double>") for k in EMBEDDING_KEYS]
    rows = [F.get(F.from_json(F.get_json_object(c, f"$.{k}"), "array<array<double>>"), 0) for k in EMBEDDING_KEYS]
    plain = [F.from_json(c, "array<double>"), F.get(F.from_json(c, "array<array<double>>"), 0)]

    def mean(k: str) -> Column:
        states = F.get(F.from_json(F.get_json_object(c, f"$.{k}"), "array<array<array<double>>>"), 0)
        total = F.aggregate(states, F.transform(F.get(states, 0), lambda x: F.lit(0.0)), lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))
        return F.transform(total, lambda x: x / F.size(states))

    sound = lambda v: F.when(F.exists(v, lambda x: x.isNotNull()), v)
    return F.coalesce(*[sound(v) for pair in zip(flat, rows) for v in pair], *[sound(mean(k)) for k in HIDDEN_KEYS], *[sound(v) for v in plain])
