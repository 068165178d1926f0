"""Deeply nested sidecar records as related flat tables.

One pass over the payloads: a depth-first visitor emits, for every record, region and detection it meets, a row of
(table tag, primary key, parent key, payload). The rows are written once, partitioned by tag; each table is then
the folder of its tag with its schema applied. Nothing is shuffled, and a payload of any size and depth is one row's work: the visitor keeps its
own stack, and a payload too deep for the standard parser is parsed by one that does so as well.

Shapes the visitor reads alike: a record alone, in a list, under wrappers of any name, or stored as a JSON string;
regions as list, as object by position, as a single object or as a JSON string; detections as list of objects,
as lists in lists, as a single object, as columns (boxes, labels, scores) or as a JSON string; numbers as strings.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from json.decoder import scanstring
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.session import cut

#: Keys under which a wrapper holds a record that has no regions.
WRAPPERS = ("result", "results", "data", "output", "outputs")
_RECORD_KEYS = {"schema_version", "stage", "model", "image", "stage2_json", "timing", "regions"}
_REGION_KEYS = {"region_index", "page_element", "detections", "boxes", "raw_preds_present"}
_DETECTION_KEYS = {"bbox_xyxy_norm_in_region", "bbox_xyxy_norm_in_page", "bbox_xyxy_norm", "label", "label_name", "score"}

TABLES = {
    "record": "schema_version int, stage int, model string, image_path string, image_height int, image_width int, stage2_json string, seconds double, extra string",
    "region": "region_index int, label int, score double, bbox array<double>, raw_preds_present boolean, extra string",
    "detection": "label int, label_name string, score double, bbox_in_region array<double>, bbox_in_page array<double>, extra string",
}
#: A row's payload holds the fields of its table; those of other tables are null.
_PAYLOAD = {f.split()[0]: f.split()[1] for fields in TABLES.values() for f in fields.split(", ")}
#: Columns that locate a row of each table; those of the parent are all but the last.
KEYS = {"record": ["owner", "record_no"], "region": ["owner", "record_no", "region_no"], "detection": ["owner", "record_no", "region_no", "det_no"]}


def number(value: Any) -> float | None:
    """A finite number, also from a numeric string; else None."""
    if isinstance(value, bool) or value is None:
        return None
    try:
        out = float(value)
    except (TypeError, ValueError):
        return None
    return out if math.isfinite(out) else None


def whole(value: Any) -> int | None:
    out = number(value)
    return int(out) if out is not None and out == int(out) and abs(out) < 2**31 else None


def box(value: Any) -> list[float] | None:
    """Four numbers, or None."""
    value = unquote(value)
    if not isinstance(value, list) or len(value) != 4:
        return None
    out = [number(x) for x in value]
    return None if None in out else out


_TOKEN = re.compile(r'\s*(?:([\[\]{}:,])|(")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity))')


def _parse_deep(text: str) -> Any:
    """JSON by a stack of open containers, for any depth."""
    holders: list[Any] = []
    keys: list[Any] = []
    at, expected, root = 0, "value", None
    while True:
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no JSON at {at}")
        mark, at = m[1], m.end()
        if mark in ("]", "}") and expected in (("first value", "comma") if mark == "]" else ("first key", "comma")):
            if not holders or isinstance(holders[-1], list) != (mark == "]"):
                raise ValueError(f"no JSON at {at}")
            holders.pop()
            keys.pop()
        elif mark == "," and expected == "comma" and holders:
            expected = "key" if isinstance(holders[-1], dict) else "value"
            continue
        elif mark == ":" and expected == "colon":
            expected = "value"
            continue
        elif m[2] and expected in ("key", "first key"):
            keys[-1], at = scanstring(text, at, True)
            expected = "colon"
            continue
        elif mark in ("[", "{") or (not mark and expected in ("value", "first value")):
            if expected not in ("value", "first value"):
                raise ValueError(f"no JSON at {at}")
            if m[2]:
                value, at = scanstring(text, at, True)
            else:
                value = [] if mark == "[" else {} if mark == "{" else json.loads(m[3])
            if not holders:
                root = value
            elif isinstance(holders[-1], dict):
                holders[-1][keys[-1]] = value
            else:
                holders[-1].append(value)
            if mark:
                holders.append(value)
                keys.append(None)
                expected = "first value" if mark == "[" else "first key"
                continue
        else:
            raise ValueError(f"no JSON at {at}")
        expected = "comma"
        if not holders:
            if text[at:].strip():
                raise ValueError(f"more than one value at {at}")
            return root


def parse(text: str) -> Any:
    """A JSON text's value, however deep. Raises ValueError for what is no complete JSON."""
    try:
        return json.loads(text)
    except RecursionError:
        return _parse_deep(text)


def to_json(value: Any) -> str:
    """JSON with sorted keys, however deep."""
    try:
        return json.dumps(value, ensure_ascii=False, sort_keys=True)
    except RecursionError:
        out: list[str] = []
        todo: list[Any] = [("value", value)]
        while todo:
            kind, x = todo.pop()
            if kind == "text" or not isinstance(x, (list, dict)):
                out.append(x if kind == "text" else json.dumps(x, ensure_ascii=False))
                continue
            items = x if isinstance(x, list) else sorted(x.items())
            todo.append(("text", "]" if isinstance(x, list) else "}"))
            for i in range(len(items) - 1, -1, -1):
                todo.append(("value", items[i] if isinstance(x, list) else items[i][1]))
                todo.append(("text", (", " if i else "") + ("" if isinstance(x, list) else json.dumps(items[i][0], ensure_ascii=False) + ": ")))
            out.append("[" if isinstance(x, list) else "{")
        return "".join(out)


def unquote(value: Any) -> Any:
    """What a JSON string holds if it holds an object or a list, through any number of quotings; anything else as it is."""
    while isinstance(value, str) and value.lstrip()[:1] in ("{", "[", '"'):
        try:
            value = parse(value)
        except ValueError:
            return value
    return value


def _rest(value: dict, known: set[str]) -> str | None:
    extra = {k: v for k, v in value.items() if k not in known}
    return to_json(extra) if extra else None


class Visitor:
    """Walks one payload depth first; ``emit(tag, record_no, region_no, det_no, fields)`` gets each row."""

    def __init__(self, emit: Callable[[str, int, int | None, int | None, dict], None]):
        self.emit = emit
        self.records = 0

    def payload(self, value: Any) -> None:
        todo = [value]
        while todo:
            value = unquote(todo.pop())
            if isinstance(value, list):
                todo += reversed(value)
            elif isinstance(value, dict):
                inner = None if "regions" in value else self.wrapped(value)
                if inner is None:
                    self.record(value)
                else:
                    todo += reversed(inner)

    @staticmethod
    def wrapped(value: dict) -> list | None:
        """The records an object without regions wraps: all objects with regions below it, whatever the names between; else what its wrapper keys hold; None if it wraps nothing."""
        found: list = []
        todo = list(reversed(list(value.values())))
        while todo:
            x = unquote(todo.pop())
            if isinstance(x, dict) and "regions" in x:
                found.append(x)
            elif isinstance(x, (list, dict)):
                todo += reversed(x if isinstance(x, list) else list(x.values()))
        if found:
            return found
        return [x for k in WRAPPERS if isinstance(x := unquote(value.get(k)), (list, dict))] or None

    def record(self, value: dict) -> None:
        no, self.records = self.records, self.records + 1
        image = unquote(value.get("image"))
        image = image if isinstance(image, dict) else {}
        timing = unquote(value.get("timing"))
        text = lambda x: x if isinstance(x, str) else None
        self.emit("record", no, None, None, {
            "schema_version": whole(value.get("schema_version")), "stage": whole(value.get("stage")), "model": text(value.get("model")), "image_path": text(image.get("path")),
            "image_height": whole(image.get("height")), "image_width": whole(image.get("width")), "stage2_json": text(value.get("stage2_json")),
            "seconds": number(timing.get("seconds")) if isinstance(timing, dict) else None, "extra": _rest(value, _RECORD_KEYS),
        })
        regions = unquote(value.get("regions"))
        if isinstance(regions, dict):
            regions = [regions] if _REGION_KEYS & regions.keys() else list(regions.values())
        for position, region in enumerate(regions if isinstance(regions, list) else []):
            region = unquote(region)
            if isinstance(region, dict):
                self.region(no, position, region)

    def region(self, record_no: int, no: int, value: dict) -> None:
        element = unquote(value.get("page_element"))
        element = element if isinstance(element, dict) else {}
        present = value.get("raw_preds_present")
        self.emit("region", record_no, no, None, {
            "region_index": whole(value.get("region_index")), "label": whole(element.get("label")), "score": number(element.get("score")), "bbox": box(element.get("bbox_xyxy_norm")),
            "raw_preds_present": present if isinstance(present, bool) else None, "extra": _rest(value, _REGION_KEYS | {"labels", "scores"}),
        })
        found = value.get("detections")
        if found is None and isinstance(unquote(value.get("boxes")), list):
            found = {k: value.get(k) for k in ("boxes", "labels", "scores")}
        found = unquote(found)
        if isinstance(found, (list, dict)):
            self.detections(record_no, no, found)

    def detections(self, record_no: int, region_no: int, value: list | dict) -> None:
        """Emit what ``value`` holds; whatever is no container takes a position."""
        position = 0
        todo: list[Any] = [value]
        while todo:
            value = unquote(todo.pop())
            if isinstance(value, list):
                todo += reversed(value)
                continue
            if not isinstance(value, dict):
                position += 1
                continue
            boxes = unquote(value.get("boxes"))
            if isinstance(boxes, list):
                labels, scores = (x if isinstance(x := unquote(value.get(k)), list) else [] for k in ("labels", "scores"))
                at = lambda column, i: column[i] if i < len(column) else None
                for i, entry in enumerate(boxes):
                    if entry is not None:
                        self.emit("detection", record_no, region_no, position, {"label": whole(at(labels, i)), "score": number(at(scores, i)), "bbox_in_region": box(entry)})
                    position += 1
                continue
            name = value.get("label_name")
            self.emit("detection", record_no, region_no, position, {
                "label": whole(value.get("label")), "label_name": name if isinstance(name, str) else None, "score": number(value.get("score")), "bbox_in_region": box(value.get("bbox_xyxy_norm_in_region")),
                "bbox_in_page": box(value.get("bbox_xyxy_norm_in_page", value.get("bbox_xyxy_norm"))), "extra": _rest(value, _DETECTION_KEYS),
            })
            position += 1


_EMITTED = "tag string, pk string, parent string, owner long, record_no int, region_no int, det_no int, payload struct<" + ", ".join(f"{k}: {v}" for k, v in _PAYLOAD.items()) + ">"
_ARROW = {"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.struct([(k, _ARROW[v]) for k, v in _PAYLOAD.items()])]
_NAMES = ["tag", "pk", "parent", "owner", "record_no", "region_no", "det_no", "payload"]


def _emit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in _TYPES]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)
        rows.clear()
        return out

    for incoming in batches:
        for owner, payload in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
            lead = "" if owner is None else str(owner)

            def emit(tag: str, record_no: int, region_no: int | None, det_no: int | None, fields: dict, owner: int | None = owner, lead: str = lead) -> None:
                parent = lead if region_no is None else f"{lead}/{record_no}" if det_no is None else f"{lead}/{record_no}/{region_no}"
                last = record_no if region_no is None else region_no if det_no is None else det_no
                rows.append((tag, f"{parent}/{last}", parent, owner, record_no, region_no, det_no, fields))

            try:
                value = parse(payload)
            except ValueError:
                continue
            Visitor(emit).payload(value)
            if len(rows) >= 20_000:
                yield batch()
    yield batch()


def emit_tagged(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Rows (tag, pk, parent, owner, record_no, region_no, det_no, payload) of all payloads of ``df``, in one pass.

    ``owner`` is ``key``; positions are 0-based. Null entries take a position and emit nothing; the position of a detection
    counts through lists in lists. Null, empty, incomplete and non-object payloads emit nothing. Payloads that repeat under
    other keys are emitted for each. Unknown fields of a table go to its ``extra`` (JSON); other columns of ``df`` are
    ignored, whatever their names. An empty table emits nothing.
    """
    held = df.where(F.col(payload).isNotNull() & (F.length(F.trim(F.col(payload))) > 0))
    return held.select(F.col(key).cast("long").alias("owner"), F.col(payload).cast("string").alias("payload")).mapInArrow(_emit_all, _EMITTED)


def write_tagged(df: DataFrame, key: str, payload: str) -> DataFrame:
    """``emit_tagged``, written once to the shared folder with a folder for each tag."""
    return cut(emit_tagged(df, key, payload), "tagged", partition_by=["tag"])


def tagged_table(tagged: DataFrame, tag: str, key: str) -> DataFrame:
    """The table of ``tag`` with its schema: pk, parent, key columns (owner as ``key``) and its fields."""
    fields = [F.col("payload")[f.split()[0]].alias(f.split()[0]) for f in TABLES[tag].split(", ")]
    rows = tagged.where(F.col("tag") == tag)
    return rows.select("pk", "parent", F.col("owner").alias(key), *KEYS[tag][1:], *fields)
