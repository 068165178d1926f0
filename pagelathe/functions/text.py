"""String, path and text-choice functions as column expressions. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space stripped from texts (all of Unicode's, and the four separators 1C to 1F).
_SPACE = r"(?U)^[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+$"
#: Keys that may hold a recognised text, in order of preference.
TEXT_KEYS = ("text", "output_text", "generated_text", "ocr_text")
#: Column names that may hold a query, in order of preference.
QUERY_COLUMNS = ("text_query", "query", "question", "prompt", "q", "text")
QUERY_PREFIX, PASSAGE_PREFIX = "query: ", "passage: "


def ustrip(c: Column | str) -> Column:
    """Without white space of any script at either end (F16)."""
    return F.regexp_replace(c, _SPACE, "")


def not_blank(c: Column | str) -> Column:
    """Whether something is left after stripping; null counts as blank."""
    return F.coalesce(F.length(ustrip(c)) > 0, F.lit(False))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def page_key(path: Column | str) -> Column:
    """Struct doc, page, image_name of ``<doc>_page<N>.<png|jpg|jpeg>``; else doc is the stem and page null."""
    name, rule = base_name(path), r"(?i)^(.+)_page(\d+)\.(png|jpg|jpeg)$"
    doc = F.nullif(F.regexp_extract(name, rule, 1), F.lit(""))
    page = F.regexp_extract(name, rule, 2).try_cast("int")
    return F.struct(F.coalesce(doc, stem(path)).alias("doc"), page.alias("page"), name.alias("image_name"))


def skipped_page_key(path: Column | str, page_base: int = 0) -> Column:
    """``<pdf>_<page>`` of a numeric ``<pdf>_page<N>``, with pages from 1; null otherwise. ``page_base`` is that of the names."""
    rule = r"^(\d+)_page(\d+)$"
    page = F.regexp_extract(stem(path), rule, 2).try_cast("long") + (1 - page_base)
    return F.when(F.regexp_like(stem(path), F.lit(rule)), F.concat(F.regexp_extract(stem(path), rule, 1), F.lit("_"), page.cast("string")))


def split_pdf_page(c: Column | str) -> Column:
    """Struct pdf, page of ``<pdf>_<page>``, cut at the first underscore; page null if it is no integer."""
    parts = F.split(c, "_", 2)
    return F.struct(F.get(parts, 0).alias("pdf"), F.trim(F.get(parts, 1)).try_cast("int").alias("page"))


def page_from_path(path: Column | str) -> Column:
    """T4: the integer between the last ``_page`` and the next dot."""
    return F.get(F.split(F.element_at(F.split(path, "_page"), -1), r"\."), 0).try_cast("int")


def padded_page(page: Column | str) -> Column:
    """T5: at least four digits, longer numbers whole."""
    return F.format_string("%04d", page)


def retrieved_key(source: Column | str, metadata: Column | str, whole_stem: bool = False) -> Column:
    """``<pdf>_<page>``; the pdf is the name up to the first underscore, or with ``whole_stem`` the whole stem."""
    pdf = stem(source) if whole_stem else F.get(F.split(base_name(source), "_"), 0)
    return F.concat(pdf, F.lit("_"), metadata)


def embedding_stem(path: Column | str) -> Column:
    """The PDF's stem from an embedding file's name."""
    name = base_name(path)
    return F.when(name.endswith(".embedding_results.pt"), F.regexp_replace(name, r"\.embedding_results\.pt$", "")).otherwise(stem(path))


def preview(texts: Column | str, most: int = 200) -> Column:
    """P10: texts in one line, cut to ``most`` characters with an ellipsis."""
    whole = F.regexp_replace(F.array_join(texts, " "), "\n", " ")
    return F.when(F.length(whole) > most, F.concat(F.left(whole, F.lit(most)), F.lit("…"))).otherwise(whole)


def shortened(c: Column | str, most: int = 80) -> Column:
    """T13."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(F.col(c) if isinstance(c, str) else c)


def joined_text(entries: Column | str) -> Column:
    """Texts of an array of structs with a text, joined by blanks and stripped; a null text is empty, a null array null."""
    c = F.col(entries) if isinstance(entries, str) else entries
    return ustrip(F.array_join(F.transform(c, lambda e: F.coalesce(e["text"], F.lit(""))), " "))


def _first_text(json: Column, keys: Sequence[str]) -> Column:
    found = [F.get_json_object(json, f"$.{k}") for k in keys]
    return F.coalesce(*[F.when(not_blank(x), ustrip(x)) for x in found])


def ocr_text(json: Column | str, depth: int = 3) -> Column:
    """The text of a recogniser's free-form JSON result, or ``""``.

    An object gives the first non-blank of its text keys, else the same of ``raw`` (``depth`` levels), else itself as text;
    a list gives its items' texts joined by blanks; anything that is no JSON is stripped text. Null gives ``""``.
    """
    c = F.col(json) if isinstance(json, str) else json

    def item(x: Column, left: int) -> Column:
        raw = F.get_json_object(x, "$.raw")
        inner = item(raw, left - 1) if left else ustrip(raw)
        return F.when(ustrip(x).startswith("{"), F.coalesce(_first_text(x, TEXT_KEYS), F.when(raw.isNotNull(), inner), ustrip(x))).otherwise(ustrip(x))

    parts = F.from_json(c, "array<string>")
    many = F.array_join(F.filter(F.transform(parts, lambda x: item(x, 1)), not_blank), " ")
    return F.coalesce(F.when(ustrip(c).startswith("["), F.coalesce(many, ustrip(c))).otherwise(item(c, depth)), F.lit(""))


def words_text(json: Column | str) -> Column:
    """Like ``ocr_text`` for an object whose text is spread over ``words[].text``."""
    c = F.col(json) if isinstance(json, str) else json
    words = F.from_json(F.get_json_object(c, "$.words"), "array<struct<text:string>>")
    joined = F.array_join(F.filter(F.transform(words, lambda w: w["text"]), lambda t: t.isNotNull()), " ")
    return F.coalesce(_first_text(c, TEXT_KEYS), F.when(F.length(joined) > 0, ustrip(joined)), ustrip(c), F.lit(""))


def record_text(kind: Column | str, subtype: Column | str, fields: dict[str, str], enabled: Sequence[str] = ("text", "chart", "table", "image", "infographic", "audio"), most: int = 65_535, embedded: Column | None = None) -> Column:
    """A record's text by type, or null.

    ``fields`` names the columns content, table_content, caption, image_text and audio_transcript. Switched-off types, blank or
    longer texts than ``most``, and records that are not ``embedded`` give null.
    """
    kind, subtype = (F.col(c) if isinstance(c, str) else c for c in (kind, subtype))
    col = lambda name: F.col(fields[name]) if name in fields else F.lit(None).cast("string")
    off = [s for s in ("chart", "table", "infographic") if s not in enabled]
    structured = F.when(~F.coalesce(subtype.isin(off), F.lit(False)), col("table_content")) if off else col("table_content")
    text = F.when((kind == "text") & F.lit("text" in enabled), col("content")).when(kind == "structured", structured)
    text = text.when((kind == "image") & F.lit("image" in enabled), F.when(subtype == "page_image", col("image_text")).otherwise(col("caption")))
    text = text.when((kind == "audio") & F.lit("audio" in enabled), col("audio_transcript"))
    keep = (F.length(text) > 0) & (F.length(text) <= most)
    return F.when(keep & embedded if embedded is not None else keep, text)


def record_location(kind: Column | str, subtype: Column | str, table: Column, image: Column, enabled: Sequence[str] = ("chart", "table", "image", "infographic")) -> Column:
    """A record's location (any type) by document type; null for types without one or switched off."""
    kind, subtype = (F.col(c) if isinstance(c, str) else c for c in (kind, subtype))
    off = [s for s in ("chart", "table", "infographic") if s not in enabled]
    structured = F.when(~F.coalesce(subtype.isin(off), F.lit(False)), table) if off else table
    return F.when(kind == "structured", structured).when((kind == "image") & F.lit("image" in enabled), image)


def metadata_cell(c: Column | str) -> Column:
    """A side-table cell as struct value, items: empty is null; a cell that begins with ``[`` becomes a list of strings."""
    c = F.col(c) if isinstance(c, str) else c
    value = F.nullif(c, F.lit(""))
    return F.struct(value.alias("value"), F.when(value.startswith("["), F.from_json(value, "array<string>", {"allowSingleQuotes": "true"})).alias("items"))


def report_page(number: Column | str, text: Column | str) -> Column:
    """A page as Markdown section."""
    return F.concat(F.lit("## Page "), F.col(number).cast("string") if isinstance(number, str) else number.cast("string"), F.lit("\n\n"), F.coalesce(text, F.lit("")))


def clock(seconds: Column | str) -> Column:
    """HH:MM:SS; null, NaN and negative are ``unknown``."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    whole = F.floor(s)
    known = s.isNotNull() & ~F.isnan(s) & (s >= 0)
    return F.when(known, F.format_string("%02d:%02d:%02d", F.floor(whole / 3600), F.floor(F.pmod(whole, F.lit(3600)) / 60), F.pmod(whole, F.lit(60)))).otherwise("unknown")


def human_size(size: Column | str, units: Sequence[str] = ("B", "KB", "MB", "GB", "TB")) -> Column:
    """Bytes with one decimal in the largest unit below 1024; the last unit takes all above."""
    s = (F.col(size) if isinstance(size, str) else size).cast("double")
    out = F.when(s < 1024, F.format_string(f"%.1f {units[0]}", s))
    for i, unit in enumerate(units[1:], 1):
        fits = s < 1024 ** (i + 1) if i < len(units) - 1 else F.lit(True)
        out = out.when(fits, F.format_string(f"%.1f {unit}", s / 1024**i))
    return F.when(s.isNotNull(), out)


def endpoint_url(c: str | None) -> str | None:
    """Stripped, with ``http://`` where no scheme is given; blank is None."""
    value = (c or "").strip()
    return None if not value else value if "://" in value else f"http://{value}"


def stage_number(c: Column | str) -> Column:
    """The number of ``stage N`` or ``N``; null otherwise."""
    return F.regexp_extract(c, r"(?i)^\s*(?:stage)?[\s_-]*(\d+)\s*$", 1).try_cast("int")


def query_column(names: Sequence[str]) -> str | None:
    """The column that holds the query: the first preferred name (any case), else the first column."""
    lower = {n.strip().lower(): n for n in reversed(names)}
    return next((lower[c] for c in QUERY_COLUMNS if c in lower), names[0] if names else None)


def label_key(name: Column | str, label: Column | str) -> Column:
    """The name, or ``label_<v>`` where it is blank or missing."""
    name, value = (F.col(c) if isinstance(c, str) else c for c in (name, label))
    return F.coalesce(F.when(not_blank(name), name), F.concat(F.lit("label_"), F.coalesce(value.cast("string"), F.lit("None"))))
