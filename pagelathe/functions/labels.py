"""Label names and the predicates that route detections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelathe.functions.text import ustrip

#: Page-element labels by number.
LABELS = {0: "table", 1: "chart", 2: "title", 3: "infographic", 4: "text", 5: "header_footer"}
#: Labels that go to each kind of region model.
TABLE_LABELS, GRAPHIC_LABELS, GRAPHIC_LABELS_WIDE, OCR_LABELS = (0,), (1, 3), (1, 2, 3), (0, 1, 3)
OCR_NAMES, GRAPHIC_NAMES = ("table", "chart", "infographic"), ("chart", "infographic")
#: Score and overlap thresholds that the layout, graphic and table models declare.
THRESHOLDS = {"page_elements": (0.01, 0.5), "graphic_elements": (0.01, 0.25), "table_structure": (0.01, 0.25)}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def label_name(label: Column | str) -> Column:
    """The label's name, ``unknown_<i>`` for others."""
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, _c(label)), F.concat(F.lit("unknown_"), _c(label).cast("string")))


def is_table(label: Column | str) -> Column:
    """F1."""
    return _false(_c(label).isin(*TABLE_LABELS))


def is_graphic(label: Column | str, wide: bool = False) -> Column:
    """F2; with ``wide`` F3, which takes titles too."""
    return _false(_c(label).isin(*(GRAPHIC_LABELS_WIDE if wide else GRAPHIC_LABELS)))


def counts_as_graphic(name: Column | str, label: Column | str) -> Column:
    """by name; by number only where the name is missing (a blank name is a name)."""
    return _false(F.when(_c(name).isNotNull(), F.lower(ustrip(_c(name))).isin(*GRAPHIC_NAMES)).otherwise(_c(label).isin(*GRAPHIC_LABELS)))


def is_ocr_target(name: Column | str, label: Column | str) -> Column:
    """by number or by name; a label that is no integer decides nothing."""
    return _false(_c(label).try_cast("int").isin(*OCR_LABELS)) | _false(F.lower(ustrip(_c(name))).isin(*OCR_NAMES))


def keeps_score(score: Column | str, least: float) -> Column:
    """F8: an unknown score passes."""
    return _c(score).isNull() | (_c(score) >= F.lit(least))
