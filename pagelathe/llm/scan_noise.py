"""Noise in text from scanned pages: misread words, split words, running headers and page numbers.

1. One pass over the pages takes out what the rest needs: lines at page ends, words that are in no dictionary with the
   words around them, lines that end in a hyphen, and for every dictionary word how often which words stand near it.
2. Furniture. Lines at a page's ends are compared by their letters with such lines of other pages of the same
   PDF: lines with the same letters on two pages by an aggregate, others with every other line there. Page numbers are
   recognised by form and, where bare, by counting in step with the pages. A title that stands in the midst of a sentence is furniture too.
3. Skip-gram vectors are learned from all pages: the best vectors of words and contexts for the skip-gram objective are a
   factorisation of the matrix of their (shifted) pointwise mutual information, whose counts add up over tasks.
4. Rare words (none of the dictionary) are linked to dictionary words that differ in one glyph; what glyphs the
   scanner confuses is learned from these links: a confusion links many different words, chance only few. No table of confusions is given.
5. A word is put right in context: the weight of its weakest glyph edit and the skip-gram score of the repair among the words
   around it decide together whether it is misread, and as what. Any number of glyphs may be wrong.
6. A word cut at a line end is joined when both parts together are in the dictionary, also over a page end. Furniture
   goes, words are put right and joined, and lines are reflowed into paragraphs.

The dictionary (lexicon) is of bounded size; it is broadcast behind a check of its size.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.llm.codepoints import decode, letter_table, lower_table, mix, runs, slices, space_table, span_hashes
from pagelathe.session import cut

#: Characters that end a line inside a word, and those that stand between the words of a token.
HYPHENS = "-­‐¬"
_JOINERS = HYPHENS + "'’"
ENDINGS = frozenset(HYPHENS)
#: Lexicon words that may be broadcast (some 40 MB with their vectors); a larger one is no dictionary.
MOST_LEXICON = 200_000
#: Skip-gram: words on each side, buckets that context words fall into (for each side), dimensions.
CONTEXT, BUCKETS, VECTOR_SIZE = 2, 256, 32
#: Weight of the skip-gram score beside the glyphs' log odds (contexts of one place are not independent).
CONTEXT_WEIGHT = 0.5
#: Links of a confusion that chance reaches, as a multiple of the median confusion's links.
SPREAD = 1.0
#: Log odds of the surest glyph edit.
MOST_ODDS = 3.0
#: Lines at each end of a page that may be furniture.
DEPTH = 4
#: Lines, and letters of these, of one PDF that a task compares with as many; the parts of a larger PDF meet in pairs.
LINES, LETTERS = 32_768, 1 << 22

_PAGE_NUMBER = re.compile(
    r"^(?P<word>(?:page|seite|página|pagina|p\.|s\.)\s*)?(?P<open>[-–—\[(]\s*)?(?P<number>\d{1,6}|[ivxlc]{1,8})(?:\s*[-–—\])])?(?P<of>\s*/\s*\d+)?$", re.IGNORECASE
)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_OUTER = ".,;:?()[]{}\"'«»“”„‚‘’…*"
_SYMBOLS = "@!$|"
_LETTERS = re.compile(r"[^\W\d_]+")


def page_number(line: str) -> tuple[int, bool] | None:
    """The number a line consists of, and whether it is marked as a page number (word, brackets, total, roman)."""
    m = _PAGE_NUMBER.match(line.strip())
    if not m:
        return None
    digits = m["number"].lower()
    if digits.isdigit():
        return int(digits), bool(m["word"] or m["open"] or m["of"])
    values = [_ROMAN[c] for c in digits]
    return sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0])), True


def skeleton(line: str) -> str:
    return "".join(_LETTERS.findall(line.lower()))


def edge_lines(lines: list[str], depth: int = DEPTH) -> list[tuple[str, int, int]]:
    """The outer lines with content of a page, as (end, lines further out, line number); a page's middle line is at both ends."""
    full = [i for i, line in enumerate(lines) if line.strip()]
    each = min(depth, (len(full) + 1) // 2)
    return [("t", k, full[k]) for k in range(each)] + [("b", k, full[-1 - k]) for k in range(each)]


def interrupts(lines: list[str], at: int) -> bool:
    """Whether a page's first line is a title that stands in the midst of a sentence: the next line goes on in lower case."""
    names = _LETTERS.findall(lines[at])
    if len(names) < 3 or not all(n[0].isupper() for n in names) or lines[at].rstrip()[-1] in ".;:,!?" + HYPHENS:
        return False
    after = next((line.lstrip() for line in lines[at + 1 :] if is_running(line)), "")
    return after[:1].islower()


def is_rest(line: str, letters: str) -> bool:
    """Whether a line of fewer than six letters is the rest of a sentence, which stands on many pages by chance."""
    if len(letters) >= 6:
        return False
    line = line.strip()
    return line[:1].islower() and line[-1:] in set(".;:,!?")


def is_running(line: str) -> bool:
    """Whether a line holds running text (not blank, not a row of figures)."""
    return any(c.isalpha() for c in line)


def split_end(line: str) -> str | None:
    """The letters before the hyphen that ends a line, or None."""
    end = line.rstrip()
    if len(end) < 2 or end[-1] not in HYPHENS:
        return None
    at = last = len(end) - 1
    while at and end[at - 1].isalnum() and not end[at - 1].isdecimal():
        at -= 1
    return end[at:last] or None


def split_begin(line: str) -> str | None:
    """The letters a line begins with, or None."""
    m = re.match(r"[^\W\d_]+", line.lstrip())
    return m.group() if m else None


# --- words of a slice of pages


def _members(characters: str) -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[ord(c) for c in characters]] = True
    return table


class Lexicon:
    """Dictionary words in order, their hashes, and lookups by hash and by prefix."""

    def __init__(self, found: set[str]):
        self.words = sorted(w for w in found if w)
        codes, starts = decode(pa.array(self.words, pa.string()))
        self.codes, self.starts = codes, starts
        hashes = span_hashes(lower_table()[codes], starts[:-1], starts[1:])
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.bucket = (mix(hashes) % np.uint64(BUCKETS)).astype(np.int64)
        self.known = set(self.words)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The word's number for each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def number(self, word: str) -> int:
        at = bisect_left(self.words, word)
        return at if at < len(self.words) and self.words[at] == word else -1

    def has_prefix(self, prefix: str) -> bool:
        at = bisect_left(self.words, prefix)
        return at < len(self.words) and self.words[at].startswith(prefix)


class Words:
    """Words of a slice of texts: the parts of tokens between joiners, without the punctuation around them."""

    def __init__(self, column: pa.Array, lexicon: Lexicon):
        codes, starts = decode(column)
        space = space_table()[codes]
        joiner, outer = _members(_JOINERS)[codes], _members(_OUTER)[codes]
        begin, end = runs(~space & ~joiner, starts)
        core = np.flatnonzero(~space & ~joiner & ~outer)
        first, after = np.searchsorted(core, begin), np.searchsorted(core, end)
        full = after > first
        begin, end = core[first[full]], core[after[full] - 1] + 1
        meant = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(letter_table()[codes] | _members(_SYMBOLS)[codes], out=meant[1:])
        digit = np.zeros(len(codes) + 2, bool)
        digit[:-2] = (codes >= 48) & (codes <= 57)
        follows = np.append(codes, np.zeros(2, np.uint32))
        letters = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(letter_table()[codes], out=letters[1:])
        # Short letters before a hyphen and digits are a code, no word.
        code = (follows[end] == 45) & digit[np.minimum(end + 1, len(codes))] & (end - begin <= 4) & (letters[end] - letters[begin] == end - begin)
        newlines = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(codes == 10, out=newlines[1:])
        row = np.searchsorted(starts, begin, side="right") - 1
        line = newlines[begin] - newlines[starts[row]]
        self.first = np.ones(len(begin), bool)
        self.first[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
        self.last = np.append(self.first[1:], True)[: len(begin)]
        keep = (meant[end] > meant[begin]) & ~code
        self.begin, self.end, self.row, self.line, self.first, self.last = (x[keep] for x in (begin, end, row, line, self.first, self.last))
        low = lower_table()[codes]
        self.number = lexicon.numbers(span_hashes(low, self.begin, self.end))
        # A closing ! may be one, or a letter; the word without it is looked up first.
        ends = np.flatnonzero((self.number < 0) & (self.end - self.begin > 1))
        ends = ends[np.isin(codes[self.end[ends] - 1], [ord("!"), ord("|")])]
        self.number[ends] = lexicon.numbers(span_hashes(low, self.begin[ends], self.end[ends] - 1))
        self.codes, self.starts = codes, starts

    def text(self, i: int) -> str:
        return self.codes[self.begin[i] : self.end[i]].tobytes().decode("utf-32-le")

    def contexts(self, bucket: np.ndarray) -> np.ndarray:
        """Context features of each word (a row of 2 * CONTEXT, -1 for none): the side and bucket of known words around it, in the same text."""
        n = len(self.begin)
        out = np.full((n, 2 * CONTEXT), -1, np.int64)
        held = np.where(self.number >= 0, bucket[self.number], -1) if len(bucket) else np.full(n, -1, np.int64)
        for d in range(1, min(CONTEXT, n - 1) + 1 if n else 0):
            same = self.row[d:] == self.row[:-d]
            out[d:, d - 1] = np.where(same, held[:-d], -1)
            out[:-d, CONTEXT + d - 1] = np.where(same & (held[d:] >= 0), held[d:] + BUCKETS, -1)
        return out


# --- one pass over the pages

_SEEN = "tag string, page_id long, pdf string, page_number int, line_no int, next_line int, word string, other string, depth int, ahead int, marked boolean, flag boolean, part boolean, at long, contexts array<int>, counts binary"
_SEEN_SCHEMA = pa.schema([
    ("tag", pa.string()), ("page_id", pa.int64()), ("pdf", pa.string()), ("page_number", pa.int32()), ("line_no", pa.int32()), ("next_line", pa.int32()), ("word", pa.string()), ("other", pa.string()), ("depth", pa.int32()),
    ("ahead", pa.int32()), ("marked", pa.bool_()), ("flag", pa.bool_()), ("part", pa.bool_()), ("at", pa.int64()), ("contexts", pa.list_(pa.int32())), ("counts", pa.binary()),
])
_FIELDS = {f.name: i for i, f in enumerate(_SEEN_SCHEMA)}


class _Rows:
    """Rows of the pass by tag, as column lists; what a tag leaves out is null."""

    def __init__(self) -> None:
        self.held: dict[tuple[str, ...], list[tuple]] = {}

    def batches(self) -> Iterator[pa.RecordBatch]:
        for names, rows in self.held.items():
            columns = dict(zip(names, zip(*rows)))
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in _SEEN_SCHEMA], schema=_SEEN_SCHEMA)
        self.held.clear()

    def of(self, *names: str) -> list[tuple]:
        return self.held.setdefault(("tag", *names), [])


def _page_lines(page_id: int, pdf: str, number: int | None, lines: list[str], known: set[str], out: _Rows) -> dict[int, bool]:
    """Rows of a page's lines: edge lines, splits at line ends, first lines; the lines whose last (False) or first (True) word is part of a split one."""
    edges = out.of("page_id", "pdf", "page_number", "other", "depth", "line_no", "word", "ahead", "marked", "flag")
    for end, depth, i in edge_lines(lines):
        value = page_number(lines[i])
        ahead, marked = (None, None) if value is None else (None if number is None else value[0] - number, value[1])
        letters = skeleton(lines[i])
        edges.append(("edge", page_id, pdf, number, end, depth, i, "" if is_rest(lines[i], letters) else letters, ahead, marked, end == "t" and depth == 0 and interrupts(lines, i)))
    parts: dict[int, bool] = {}
    splits = out.of("page_id", "pdf", "page_number", "line_no", "next_line", "word", "other")
    for i, line in enumerate(lines):
        if line.rstrip()[-1:] not in ENDINGS:
            continue
        end = split_end(line)
        if end is None:
            continue
        following = next((j for j in range(i + 1, len(lines)) if is_running(lines[j])), None)
        rest = None if following is None else split_begin(lines[following])
        splits.append(("split", page_id, pdf, number, i, following, end, rest))
        parts[2 * i] = False
        if rest is not None and ((end + rest).lower() in known or end.lower() not in known):
            parts[2 * following + 1] = True
    heads = out.of("page_id", "pdf", "page_number", "line_no", "word")
    first = 0
    for i, line in enumerate(lines):
        if is_running(line):
            heads.append(("head", page_id, pdf, number, i, split_begin(line)))
            first += 1
            if first > DEPTH:
                break
    return parts


def _pass(shared, most_words: int = 50_000):  # noqa: ANN001, ANN202
    """The pass over pages. Counts of contexts are held for at most ``most_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        width = 2 * BUCKETS
        place = np.full(len(lexicon.words), -1, np.int64)
        held: list[np.ndarray] = []
        sums = np.zeros((0, width), np.int32)

        def counted() -> pa.RecordBatch:
            nonlocal sums, held
            numbers = np.concatenate(held) if held else np.zeros(0, np.int64)
            rows = pa.array([r.tobytes() for r in sums[: len(numbers)]], pa.binary())
            columns = {"tag": pa.array(["count"] * len(numbers), pa.string()), "at": pa.array(numbers), "counts": rows}
            place[numbers], held, sums = -1, [], np.zeros((0, width), np.int32)
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(numbers), f.type)) for f in _SEEN_SCHEMA], schema=_SEEN_SCHEMA)

        for batch in batches:
            for part in slices(batch, "text"):
                out = _Rows()
                ids, pdfs, numbers, texts = (c.to_pylist() for c in part.columns)
                split = [_page_lines(i, p, n, t.split("\n"), lexicon.known, out) for i, p, n, t in zip(ids, pdfs, numbers, texts)]
                w = Words(part.column(3), lexicon)
                contexts = w.contexts(lexicon.bucket)
                tokens = out.of("page_id", "line_no", "word", "at", "other", "flag", "part", "contexts")
                unknown = np.flatnonzero(w.number < 0)
                for i, row, line, at, first, last in zip(unknown.tolist(), w.row[unknown].tolist(), w.line[unknown].tolist(), (w.begin - w.starts[w.row])[unknown].tolist(), w.first[unknown].tolist(), w.last[unknown].tolist()):
                    part_of = (last and 2 * line in split[row]) or (first and 2 * line + 1 in split[row])
                    word = w.text(i)
                    tokens.append(("token", ids[row], line, word.lower(), at, word, first, part_of, [c for c in contexts[i].tolist() if c >= 0]))
                yield from out.batches()
                # Counts of (word, context), summed in this task.
                which, slot = np.nonzero((contexts >= 0) & (w.number >= 0)[:, None])
                number, feature = w.number[which], contexts[which, slot]
                fresh = np.unique(number[place[number] < 0])
                if len(fresh):
                    size = sum(len(x) for x in held)
                    place[fresh] = np.arange(size, size + len(fresh))
                    held.append(fresh)
                    if size + len(fresh) > len(sums):
                        sums = np.concatenate([sums, np.zeros((max(1024, len(sums), len(fresh)), width), np.int32)])
                flat = place[number] * width + feature
                if sums.size < 1 << 22:
                    sums += np.bincount(flat, minlength=sums.size).astype(np.int32).reshape(sums.shape)
                else:
                    np.add.at(sums.reshape(-1), flat, 1)
                if len(held) and sum(len(x) for x in held) > most_words:
                    yield counted()
        yield counted()

    return run



# --- furniture


def distance_within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` edits (Levenshtein) turn one text into the other, whatever their lengths; rows of the table are bits of one integer."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most or not a:
        return len(b) <= most
    full, top = (1 << len(a)) - 1, len(a) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    up, down, distance, left = full, 0, len(a), len(b)
    for c in b:
        match = places.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        more, less = down | (full & ~(zero | up)), up & zero
        distance += (more >> top & 1) - (less >> top & 1)
        left -= 1
        if distance - left > most:
            return False
        more, less = (more << 1 | 1) & full, (less << 1) & full
        up, down = less | (full & ~(zero | more)), more & zero
    return distance <= most


class _Grams:
    """Lines in order of length as counts of their grams of ``size`` letters, which fall into buckets."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, size: int):
        line = np.repeat(np.arange(len(starts) - 1), np.maximum(np.diff(starts) - size + 1, 0))
        self.first = np.searchsorted(line, np.arange(len(starts)))
        begin = starts[line] + np.arange(len(line)) - self.first[line]
        found = span_hashes(codes, begin, begin + size)
        # A gram's second occurrence in a line is a gram of its own, so that products of counts add up to no more than common grams and chance.
        order = np.lexsort((found, line))
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[order][1:] != line[order][:-1]) | (found[order][1:] != found[order][:-1])
        place = np.arange(len(line))
        nth = np.empty(len(line), np.uint64)
        nth[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
        self.line, self.found = line, mix(found + nth)

    def counts(self, begin: int, end: int, buckets: int) -> np.ndarray:
        at = slice(self.first[begin], self.first[end])
        flat = (self.line[at] - begin) * buckets + (self.found[at] % np.uint64(buckets)).astype(np.int64)
        return np.bincount(flat, minlength=(end - begin) * buckets).astype(np.float32).reshape(end - begin, buckets)


def alike_lines(letters: pa.Array, low: np.ndarray, high: np.ndarray, asks: np.ndarray, met: np.ndarray, alike: float, held: int = 1 << 20) -> np.ndarray:
    """Which lines of ``asks`` differ from a line of ``met`` on another page in at most a share of 1 - ``alike`` of their letters (rounded): True for these.

    ``low`` and ``high`` are a line's first and last page. Every pair is tried: k edits leave all but k * n of the longer line's grams of n letters as they are, so pairs with fewer in
    common are out (common grams are counted by a matrix product, which never counts too few), and edits of the others are counted. About ``held`` counts are held for each side.
    """
    order = np.argsort(pc.utf8_length(letters).to_numpy(zero_copy_only=False), kind="stable")
    letters, low, high, asks, met = letters.take(pa.array(order)), low[order], high[order], asks[order], met[order]
    codes, starts = decode(letters)
    size, text, grams = np.diff(starts), letters.to_pylist(), {}
    found = np.zeros(len(size), bool)
    edits = lambda a, b: np.floor((1 - alike) * (a + b) / 2 + 0.5)
    share = (1 - alike) / 2
    begin = int(np.searchsorted(size, 1))
    while begin < len(size):
        least = int(size[begin])
        end = min(begin + 2048, int(np.searchsorted(size, 1.25 * least + 1)))
        # Grams of n letters tell only while an edit in every 1 / (1 - alike) letters leaves some of them.
        n = 2 if least < 20 else 3 if least < 200 else 4
        buckets = min(held, 1 << max(6, (6 * int(size[end - 1])).bit_length()))
        rows = min(2048, held // buckets)
        end = min(end, begin + rows)
        asked = np.flatnonzero(asks[begin:end] & ~found[begin:end]) + begin
        if len(asked):
            if n not in grams:
                grams[n] = _Grams(codes, starts, n)
            mine = grams[n].counts(begin, end, buckets)[asked - begin]
            # Lines whose length alone is not too far off.
            from_, upto = np.searchsorted(size, (least * (1 - share) - 0.5) / (1 + share) - 1e-6), np.searchsorted(size, (size[end - 1] * (1 + share) + 0.5) / (1 - share) + 1e-6, "right")
            for at in range(int(from_), int(upto), rows):
                stop = min(at + rows, int(upto))
                common = mine @ grams[n].counts(at, stop, buckets).T
                for length in np.unique(size[asked]).tolist():
                    which = np.flatnonzero((size[asked] == length) & ~found[asked])
                    most = edits(length, size[at:stop])
                    need = (np.maximum(length, size[at:stop]) - n + 1 - n * most).astype(np.float32)
                    need[~met[at:stop] | (abs(size[at:stop] - length) > most)] = np.inf
                    near = common[which] >= need
                    for r in np.flatnonzero(near.any(axis=1)).tolist():
                        row = int(asked[which[r]])
                        others = np.flatnonzero(near[r])
                        # Most alike first: one is enough.
                        for c in others[np.argsort(need[others] - common[which[r], others], kind="stable")].tolist():
                            other = at + c
                            if other != row and max(high[row], high[other]) > min(low[row], low[other]) and distance_within(text[row], text[other], int(most[c])):
                                found[row] = True
                                break
        begin = end
    out = np.zeros(len(size), bool)
    out[order] = found
    return out


def _alike(alike: float):  # noqa: ANN202
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        low, high, asks, met = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "asks", "met"))
        found = alike_lines(rows.column("letters").combine_chunks(), low, high, asks, met, alike) if asks.any() else np.zeros(len(rows), bool)
        return rows.select(["pdf", "end", "letters"]).filter(pa.array(found))

    return run


def furniture(edges: DataFrame, alike: float = 0.85) -> DataFrame:
    """Running headers, footers and page numbers: page_id, line_no. ``edges`` are the pass's rows of page ends.

    The two outer lines of each end are judged first; lines further in only where both of these are furniture, so body text is not compared.

    Lines with the same letters on two pages of a PDF count, and so does a line on one page only that is ``alike`` a line on another page: it is compared with all lines at that end of the PDF's pages.
    """
    # Of each PDF: whether it has marked page numbers, counts that go in step with its pages, or but one page.
    outer = edges.where("depth = 0")
    step = outer.where("ahead IS NOT NULL").groupBy("pdf", "ahead").agg((F.max("page_number") > F.min("page_number")).alias("in_step"))
    known = outer.where("page_number IS NOT NULL").groupBy("pdf").agg((F.max("page_number") == F.min("page_number")).alias("lonely"), F.max(F.coalesce("marked", F.lit(False))).alias("has_marked"))
    numbering = cut(known.join(step.groupBy("pdf").agg(F.max("in_step").alias("in_step")), "pdf", "full"), "numbering")
    near = _judged(edges.where("depth < 2"), numbering, alike)
    full = near.groupBy("page_id", "end").agg(F.count_distinct("depth").alias("n")).where("n = 2").select("page_id", "end")
    both = near.unionByName(_judged(edges.where("depth >= 2").join(full, ["page_id", "end"], "left_semi"), numbering, alike))
    # An inner line counts only if all lines further out are furniture.
    reached = F.row_number().over(Window.partitionBy("page_id", "end").orderBy("depth")) - 1
    return both.withColumn("reached", reached).where("reached = depth").select("page_id", "line_no").distinct()


def _judged(edges: DataFrame, numbering: DataFrame, alike: float) -> DataFrame:
    """Lines of ``edges`` that repeat, or are page numbers by ``numbering``: page_id, end, depth, line_no."""
    place, line = ["page_id", "end", "depth", "line_no"], ["pdf", "end", "letters"]
    # Page numbers: marked ones by their form, bare ones when the PDF has marked ones, counts in step on two pages, or has but one page.
    numbered = edges.where("marked IS NOT NULL").join(numbering, "pdf", "left").where("marked OR in_step OR coalesce(has_marked OR lonely, true)").select(*place)
    titled = edges.where("flag").select(*place)
    # Headers: lines whose letters stand on two pages, however many and however short.
    worded = edges.where("letters <> '' AND page_number IS NOT NULL")
    lines = cut(worded.groupBy(*line).agg(F.min("page_number").alias("low"), F.max("page_number").alias("high")), "edge-lines")
    exact = worded.join(lines.where("low < high"), line, "left_semi").select(*place)
    # Each other line is compared with all lines.
    # Only PDFs too large for one task are cut into parts, each of which is compared with every other; there is at most one such PDF end for every LINES lines or LETTERS letters.
    parts = lines.groupBy("pdf", "end").agg(F.ceil(F.greatest(F.count("*") / LINES, F.sum(F.length("letters")) / LETTERS)).cast("int").alias("parts")).where("parts > 1")
    lines = lines.join(F.broadcast(parts), ["pdf", "end"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("letters"), "parts").cast("int"))
    asking = "filter(transform(sequence(0, parts - 1), p -> struct(own AS i, p AS j, low = high AS asks, p = own AS met)), t -> t.asks OR t.met)"
    meeting = "filter(transform(sequence(0, parts - 1), p -> struct(p AS i, own AS j, false AS asks, true AS met)), t -> t.i <> own)"
    tried = lines.select(*line, "low", "high", F.explode(F.expr(f"concat({asking}, {meeting})")).alias("t")).select(*line, "low", "high", "t.*")
    akin = tried.groupBy("pdf", "end", "i", "j").applyInArrow(_alike(alike), "pdf string, end string, letters string").distinct()
    headed = exact.unionByName(worded.join(akin, line, "left_semi").select(*place))
    return cut(numbered.unionByName(headed).unionByName(titled).distinct(), "judged-lines")


# --- skip-gram vectors


def _adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2 * BUCKETS, 2 * BUCKETS))
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(batch.num_rows, -1).astype(np.float64)
        total += rows.T @ rows
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gram"])


def _information(counts: np.ndarray, features: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """Pointwise mutual information of words (rows) and contexts, drawn to none where counts are small."""
    share = features / max(1.0, features.sum())
    expected = counts.sum(axis=1, keepdims=True) * share[None]
    return np.log((counts + prior * share[None] * len(share)) / (expected + prior * share[None] * len(share) + 1e-12) + 1e-12).astype(np.float32) * (features > 0)


def skip_gram_vectors(counts: DataFrame, size: int = VECTOR_SIZE) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Vectors of lexicon words (by number) and of context features, whose product is the skip-gram score: the log of how
    much likelier the context is beside the word. ``counts`` are the pass's rows (at, counts), several for a word."""
    width = 2 * BUCKETS

    def whole(group: pa.Table) -> pa.Table:
        numbers, where = np.unique(group["at"].to_numpy(), return_inverse=True)
        total = np.zeros((len(numbers), width), np.int64)
        for i, raw in zip(where.tolist(), group["counts"].to_pylist()):
            total[i] += np.frombuffer(raw, np.int32)
        return pa.table({"at": pa.array(numbers, pa.int64()), "counts": pa.array([r.tobytes() for r in total.astype(np.float32)], pa.binary())})

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(batch.num_rows, -1).sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    summed = cut(counts.withColumn("bucket", F.pmod("at", F.lit(256))).groupBy("bucket").applyInArrow(whole, "at long, counts binary"), "contexts")
    sums = [np.frombuffer(r.sums) for r in summed.select("counts").coalesce(8).mapInArrow(columns, "sums binary").collect()]
    features = np.sum(sums, axis=0) if sums else np.zeros(width)
    if not features.sum():
        return {}, np.zeros((width, size), np.float32)

    def informed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in _information(raw, features)], pa.binary())], names=["row"])

    grams = [np.frombuffer(r.gram).reshape(width, width) for r in summed.select("counts").mapInArrow(informed, "row binary").coalesce(8).mapInArrow(_adder, "gram binary").collect()]
    _, axes = np.linalg.eigh(np.sum(grams, axis=0))
    basis = axes[:, ::-1][:, :size].astype(np.float32)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in (_information(raw, features) @ basis).astype(np.float32)], pa.binary())], names=["at", "vector"])

    found = summed.select("at", "counts").mapInArrow(project, "at long, vector binary").toArrow()  # one row for each lexicon word
    return dict(zip(found["at"].to_pylist(), (np.frombuffer(v, np.float32) for v in found["vector"].to_pylist()))), basis


# --- glyph edits


def _wildcards(codes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word and place, the hash of the word with ``width`` characters left open there; with the word's number and the place."""
    size = np.diff(starts)
    many = np.maximum(0, size - width + 1)
    word = np.repeat(np.arange(len(size)), many)
    at = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    begin, end = starts[:-1][word], starts[1:][word]
    return mix(span_hashes(codes, begin, begin + at)) ^ span_hashes(codes, begin + at + width, end), word, at


def glyph_links(words: list[str], lexicon: Lexicon) -> list[tuple[str, str, str, str]]:
    """(word, lexicon word, wrong, right) for each lexicon word that differs from a word in one glyph: one character for another, two for one or one for two."""
    codes, starts = decode(pa.array(words, pa.string()))
    out: set[tuple[str, str, str, str]] = set()
    if not len(lexicon.words) or not words:
        return []
    for mine, theirs in ((1, 1), (2, 1), (1, 2)):
        key, word, at = _wildcards(lexicon.codes, lexicon.starts, theirs)
        order = np.argsort(key, kind="stable")
        key, word, at = key[order], word[order], at[order]
        wanted, w, a = _wildcards(codes, starts, mine)
        low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
        many = high - low
        k = np.repeat(np.arange(len(w)), many)
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        for x, v, i, j in zip(w[k].tolist(), word[entry].tolist(), a[k].tolist(), at[entry].tolist()):
            left, right = words[x], lexicon.words[v]
            wrong, meant = left[i : i + mine], right[j : j + theirs]
            if i != j or left[:i] != right[:j] or left[i + mine :] != right[j + theirs :]:
                continue
            # An edit that keeps a character is an insertion or a deletion, no confusion of glyphs.
            if wrong != meant and not (mine != theirs and (wrong[0] == meant[0] or wrong[-1] == meant[-1])):
                out.add((left, right, wrong, meant))
    return sorted(out)


def learn_edits(tokens: DataFrame, shared, spread: float = SPREAD) -> dict[tuple[str, str], float]:  # noqa: ANN001
    """Log odds that a link by each glyph edit (wrong, right) is a misreading: {edit: log odds}, those above -2.

    ``tokens`` (column word) are unknown words outside furniture. Every distinct word of at least three characters gives its links; of the edits that
    explain it, that which explains most words gets it. What remains to edits by chance is measured by the median edit of its kind.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = None
        for batch in batches:
            lexicon = lexicon or Lexicon(shared.value)
            rows = glyph_links(batch.column(0).to_pylist(), lexicon)
            columns = list(zip(*rows)) if rows else [[] for _ in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["word", "meant", "wrong", "right"])

    distinct = tokens.where(F.length("word") >= 3).select("word").distinct()
    found = cut(distinct.mapInArrow(links, "word string, meant string, wrong string, right string").select("word", "wrong", "right").distinct(), "glyph-links")
    first = cut(found.groupBy("wrong", "right").agg(F.count(F.lit(1)).alias("words")), "glyph-counts")
    best = found.join(first, ["wrong", "right"]).groupBy("word").agg(F.max(F.struct("words", "wrong", "right")).alias("e"))
    edits = cut(best.groupBy(F.col("e.wrong").alias("wrong"), F.col("e.right").alias("right")).agg(F.count(F.lit(1)).alias("words")), "glyph-edits")
    kind = F.concat_ws(":", F.length("wrong"), F.length("right"), F.col("wrong").rlike(r"^[\p{L}\p{M}]+$"))
    kinds = first.groupBy(kind.alias("kind")).agg(F.expr("percentile(words, 0.5)").alias("usual"), F.count(F.lit(1)).alias("edits"))
    chance = F.col("usual") * spread * (1 - 1 / F.col("edits"))
    # However many words an edit explains, a name may differ from a word by just that edit: the odds end at MOST_ODDS.
    odds = F.least(F.lit(MOST_ODDS), F.log((F.col("words") + 0.5) / (chance + 0.5)))
    rows = edits.withColumn("kind", kind).join(F.broadcast(kinds), "kind").withColumn("odds", odds).where("odds > -2").select("wrong", "right", "odds").collect()  # bounded by pairs of glyphs
    return {(r.wrong, r.right): float(r.odds) for r in rows}


class Reader:
    """Repairs of unknown words by learned glyph edits, judged among the words around them."""

    def __init__(self, lexicon: Lexicon, edits: dict[tuple[str, str], float], vectors: dict[int, np.ndarray] | None = None, basis: np.ndarray | None = None, weight: float = CONTEXT_WEIGHT):
        self.lexicon, self.vectors, self.basis, self.weight = lexicon, vectors or {}, basis, weight
        self.by_glyph: dict[str, list[tuple[str, str, float]]] = {}
        for (wrong, right), odds in sorted(edits.items()):
            self.by_glyph.setdefault(wrong[0], []).append((wrong, right, odds))
        self.memory: dict[str, list[tuple[str, int, float]]] = {}

    def repairs(self, word: str) -> list[tuple[str, int, float]]:
        """Lexicon words that ``word`` becomes by learned edits, any number of them: (repair, its number, log odds of its weakest edit)."""
        found = self.memory.get(word)
        if found is not None:
            return found
        best: dict[str, tuple[int, float]] = {}
        # Partial repairs that begin a lexicon word: place in the word, letters so far, edits, weakest edit.
        open_ends = [(0, "", 0, np.inf)]
        while open_ends:
            at, built, edits, weakest = open_ends.pop()
            if at == len(word):
                if edits and built in self.lexicon.known:
                    # More edits must not seem better than fewer.
                    odds = weakest - (edits - 1) * 0.5
                    if built not in best or odds > best[built][1]:
                        best[built] = (edits, odds)
                continue
            steps = [(word[at], word[at], np.inf)] + [e for e in self.by_glyph.get(word[at], ()) if word.startswith(e[0], at)]
            for wrong, right, odds in steps:
                longer = built + right
                if self.lexicon.has_prefix(longer):
                    open_ends.append((at + len(wrong), longer, edits + (odds != np.inf), min(weakest, odds)))
        found = sorted(((w, self.lexicon.number(w), odds) for w, (_, odds) in best.items()), key=lambda x: (-x[2], x[0]))
        if len(self.memory) < 200_000:
            self.memory[word] = found
        return found

    def score(self, number: int, contexts: list[int]) -> float:
        """The skip-gram score of a lexicon word among contexts; 0 where nothing is known."""
        vector = self.vectors.get(number)
        if vector is None or not len(contexts):
            return 0.0
        return self.weight * float(self.basis[contexts].sum(axis=0) @ vector)

    def correct(self, word: str, contexts: list[int]) -> str | None:
        """What an unknown word was misread from, or None if it more likely is a word of its own."""
        best, most = None, 0.0
        for repair, number, odds in self.repairs(word):
            total = odds + self.score(number, contexts)
            if total > most:
                best, most = repair, total
        return best


def _corrector(shared):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            if reader is None:
                words, *rest = shared.value
                reader = Reader(Lexicon(words), *rest)
            rows = []
            for page_id, line, at, word, other, contexts in zip(*(c.to_pylist() for c in batch.columns)):
                found = reader.correct(word, contexts)
                # A closing mark may have been read as part of the word.
                if found is None and len(word) > 2 and word[-1] in "!|":
                    found, other = reader.correct(word[:-1], contexts), other[:-1]
                if found is not None:
                    found = found.upper() if other.isupper() and len(other) > 1 else found[:1].upper() + found[1:] if other[:1].isupper() else found
                    rows.append((page_id, line, at, len(other), found))
            columns = list(zip(*rows)) if rows else [[] for _ in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()))], names=["page_id", "line_no", "at", "size", "repair"])

    return run


# --- pages


def _pages(df: DataFrame, key: str, source: str, number: str, text: str) -> DataFrame:
    """The columns the operator needs; a page without source stands alone."""
    return df.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(source), F.concat(F.lit("\u0000"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("pdf"), F.col(number).cast("int").alias("page_number"), F.col(text).alias("text")
    )


def lexicon_set(lexicon: DataFrame, word: str = "word") -> set[str]:
    found = lexicon.where(F.col(word).isNotNull()).select(F.lower(word).alias("w")).distinct().limit(MOST_LEXICON + 1).toArrow()
    if found.num_rows > MOST_LEXICON:
        raise ValueError(f"the lexicon has more than {MOST_LEXICON} words")
    return set(found.column("w").to_pylist())


class Scan:
    """What is known of scanned pages: furniture, splits within and over pages, and repairs of misread words."""

    def __init__(self, pages: DataFrame, lexicon: DataFrame, use_vectors: bool = True):
        context = pages.sparkSession.sparkContext
        words = lexicon_set(lexicon)
        shared = context.broadcast(words)
        seen = cut(pages.select("page_id", "pdf", "page_number", "text").mapInArrow(_pass(shared), _SEEN), "scan", partition_by=["tag"])
        tag = lambda name, *columns: seen.where(F.col("tag") == name).select(*columns)
        edges = tag("edge", "page_id", "pdf", "page_number", F.col("other").alias("end"), "depth", "line_no", F.col("word").alias("letters"), "ahead", "marked", "flag")
        self.furniture = cut(furniture(edges), "furniture")
        held = self.furniture.select("page_id", "line_no")
        # Splits: the line that goes on with the word is the next one with letters, unless that is furniture at the page's end.
        splits = tag("split", "page_id", "pdf", "page_number", "line_no", "next_line", F.col("word").alias("end"), F.col("other").alias("rest")).join(held, ["page_id", "line_no"], "left_anti")
        splits = splits.join(held.select("page_id", F.col("line_no").alias("next_line"), F.lit(True).alias("gone")), ["page_id", "next_line"], "left")
        whole = lexicon.select(F.lower("word").alias("whole")).distinct()
        inner = splits.where("next_line IS NOT NULL AND gone IS NULL AND rest IS NOT NULL").withColumn("whole", F.lower(F.concat("end", "rest")))
        self.splits = inner.join(F.broadcast(whole), "whole", "left_semi").select("page_id", "line_no", "next_line", "end", "rest")
        tails = splits.where("(next_line IS NULL OR gone) AND page_number IS NOT NULL").select("page_id", "pdf", (F.col("page_number") + 1).alias("page_number"), F.col("line_no").alias("tail_line"), F.col("end").alias("tail"))
        tails = cut(tails, "tails")
        heads = tag("head", "page_id", "pdf", "page_number", "line_no", "word").where("page_number IS NOT NULL").join(held, ["page_id", "line_no"], "left_anti")
        heads = heads.groupBy("page_id", "pdf", "page_number").agg(F.min(F.struct("line_no", F.col("word").alias("head"))).alias("h")).select("page_id", "pdf", "page_number", "h.line_no", "h.head")
        heads = cut(heads.join(tails.select("pdf", "page_number").distinct(), ["pdf", "page_number"], "left_semi"), "heads")
        over = tails.join(heads.where("head IS NOT NULL").select("pdf", "page_number", "head").distinct(), ["pdf", "page_number"]).withColumn("whole", F.lower(F.concat("tail", "head")))
        self.over = over.join(F.broadcast(whole), "whole", "left_semi").select("page_id", "pdf", "page_number", "tail_line", "tail", "head")
        # Unknown words that are no parts of words and stand in running text.
        off = held.withColumn("whole_line", F.lit(True)).unionByName(heads.select("page_id", "line_no", F.lit(False).alias("whole_line"))).groupBy("page_id", "line_no").agg(F.max("whole_line").alias("whole_line"))
        tokens = tag("token", "page_id", "line_no", "word", "at", "other", "flag", "part", "contexts").where("NOT part").join(off, ["page_id", "line_no"], "left")
        tokens = cut(tokens.where("whole_line IS NULL OR (NOT whole_line AND NOT flag)").select("page_id", "line_no", "at", "word", "other", "contexts"), "unknown-words")
        edits = learn_edits(tokens, shared)
        vectors, basis = skip_gram_vectors(tag("count", "at", "counts")) if use_vectors else ({}, np.zeros((2 * BUCKETS, VECTOR_SIZE), np.float32))
        tools = context.broadcast((words, edits, vectors, basis))
        self.repairs = tokens.mapInArrow(_corrector(tools), "page_id long, line_no int, at long, size int, repair string")


def scan_defects(df: DataFrame, lexicon: DataFrame, key: str = "page_id", source: str = "pdf_path", number: str = "page_number", text: str = "text", use_vectors: bool = True) -> DataFrame:
    """Defects of scanned pages: page_id, line_no, defect (furniture, hyphen or misread), without repeated rows.

    A furniture line has no other defect; others may have two. Null and blank texts have none. A page without source
    has no neighbours, one without number no running lines and no next page; their marked page numbers are still found.
    Pages scanned again count as the same page. Hyphens at line ends that belong to compounds, and words whose
    repair is not in ``lexicon`` (columns word, lang), are no defects. Without ``use_vectors`` words are judged by their glyphs alone.
    """
    scan = Scan(_pages(df, key, source, number, text), lexicon, use_vectors)
    out = scan.furniture.select("page_id", "line_no", F.lit("furniture").alias("defect"))
    for rows, line, defect in ((scan.splits, "line_no", "hyphen"), (scan.over, "tail_line", "hyphen"), (scan.repairs, "line_no", "misread")):
        out = out.unionByName(rows.select("page_id", F.col(line).alias("line_no"), F.lit(defect).alias("defect")))
    return out.distinct()


def reflow(text: str, skip: set[int], fixes: list[tuple[int, int, str]], joined: dict[int, int]) -> list[str]:
    """Paragraphs of a page: ``fixes`` (character position, length, repair) are put in, ``joined`` lines (line, the line whose first word it
    lends its split word) lose their hyphen, line breaks go. Lines in ``skip`` are left out."""
    for at, size, repair in sorted(fixes, reverse=True):
        text = text[:at] + repair + text[at + size :]
    lines = text.split("\n")
    completes = {after: before for before, after in joined.items()}
    paragraphs: list[list[str]] = [[]]
    previous = None
    for i, line in enumerate(lines):
        if i in skip or not is_running(line):
            continue
        if previous is not None and any(not lines[j].strip() for j in range(previous + 1, i)) and paragraphs[-1]:
            paragraphs.append([])
        tokens = line.split()
        if paragraphs[-1] and (completes.get(i) == previous and previous is not None):
            tokens[0] = paragraphs[-1].pop()[:-1] + tokens[0]
        elif paragraphs[-1] and split_end(paragraphs[-1][-1]) is not None:
            tokens[0] = paragraphs[-1].pop() + tokens[0]  # a compound keeps its hyphen
        paragraphs[-1] += tokens
        previous = i
    return [" ".join(p) for p in paragraphs if p]


def _reflow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, pdfs, numbers, texts, skips, fixes, joined = (c.to_pylist() for c in batch.columns)
        found = [
            reflow(t, set(s or ()), [(f["at"], f["size"], f["repair"]) for f in x or ()], {j["line_no"]: j["next_line"] for j in n or ()}) for t, s, x, n in zip(texts, skips, fixes, joined)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.string()))], names=["page_id", "pdf", "page_number", "paragraphs"])


_OPEN = r"[\p{L}\p{N},;:)\]\"'»”’-]$"


def repair_pages(df: DataFrame, lexicon: DataFrame, key: str = "page_id", source: str = "pdf_path", number: str = "page_number", text: str = "text") -> DataFrame:
    """Repaired, continuous paragraphs: page_id and paragraph_no of where a paragraph begins, paragraph, pages (that it runs over).

    A paragraph that does not end in a sentence's end goes on with the next page's first paragraph if that begins in lower case or with the rest
    of a split word; it may run over any number of pages. Of a page scanned several times the scan with the smallest id takes part in this,
    the others' paragraphs stay by themselves, as do those of pages without source or number. Pages without text yield none.
    """
    scanned = _pages(df, key, source, number, text)
    scan = Scan(scanned, lexicon)
    skip = scan.furniture.groupBy("page_id").agg(F.collect_set("line_no").alias("skip"))
    fixes = scan.repairs.groupBy("page_id").agg(F.collect_list(F.struct("at", "size", "repair")).alias("fixes"))
    within = scan.splits.groupBy("page_id").agg(F.collect_set(F.struct("line_no", "next_line")).alias("joined"))
    read = scanned.join(skip, "page_id", "left").join(fixes, "page_id", "left").join(within, "page_id", "left").select("page_id", "pdf", "page_number", "text", "skip", "fixes", "joined")
    read = read.mapInArrow(_reflow_all, "page_id long, pdf string, page_number int, paragraphs array<string>")
    ends = scan.over.groupBy("page_id").agg(F.max("head").alias("completed"))
    begins = scan.over.select("pdf", "page_number", "head").distinct().withColumn("drops", F.lit(True))
    # The rest of a word that the page before begins is dropped where the first paragraph begins with it.
    first = F.regexp_extract(F.element_at("paragraphs", 1), r"^[\p{L}]+", 0)
    pages = read.where(F.size("paragraphs") > 0).withColumn("head", first).join(ends, "page_id", "left").join(begins, ["pdf", "page_number", "head"], "left")
    last = F.size("paragraphs") - 1
    whole = F.transform(
        "paragraphs",
        lambda p, i: F.when((i == last) & F.col("completed").isNotNull(), F.concat(F.regexp_replace(p, f"[{HYPHENS}]$", ""), F.col("completed"))).otherwise(p),
    )
    whole = F.transform(whole, lambda p, i: F.when((i == 0) & F.col("drops"), F.ltrim(F.substr(p, F.length("head") + 1))).otherwise(p))
    pages = pages.withColumn("paragraphs", whole).where(F.size("paragraphs") > 0).select("page_id", "pdf", "page_number", "paragraphs", F.coalesce("drops", F.lit(False)).alias("drops"))
    pages = cut(pages, "paragraphs")
    # One scan of each page, with what its ends look like: only these flags are compared, never texts.
    seen = pages.where("page_number IS NOT NULL").groupBy("pdf", "page_number").agg(F.min("page_id").alias("page_id"))
    flags = pages.select("page_id", "pdf", "page_number", (F.size("paragraphs") == 1).alias("single"), F.element_at("paragraphs", -1).rlike(_OPEN).alias("open"), (F.col("drops") | F.element_at("paragraphs", 1).rlike(r"^[\p{Ll}.,;:!?]")).alias("goes_on"))
    flags = flags.join(seen, ["pdf", "page_number", "page_id"], "left_semi")
    before = flags.select("pdf", (F.col("page_number") + 1).alias("page_number"), F.col("page_id").alias("to"), F.col("open").alias("before_open"))
    # Links from a page whose first paragraph goes on to the page before; a page that is one such paragraph is passed through.
    links = cut(flags.join(before, ["pdf", "page_number"]).where("goes_on AND before_open").select("page_id", "to", "single"), "links")
    roots = _follow(links)
    order = F.struct(F.col("page_number").alias("n"), F.col("paragraph_no").alias("i"), F.col("paragraph").alias("p"))
    each = pages.select("page_id", "page_number", F.size("paragraphs").alias("many"), F.posexplode("paragraphs").alias("paragraph_no", "paragraph")).where("paragraph <> ''")
    last_no = pages.select(F.col("page_id").alias("root"), (F.size("paragraphs") - 1).alias("root_no"))
    placed = each.join(roots.join(last_no, "root").withColumn("paragraph_no", F.lit(0)), ["page_id", "paragraph_no"], "left")
    placed = placed.select(F.coalesce("root", "page_id").alias("at"), F.coalesce("root_no", "paragraph_no").alias("at_no"), order.alias("piece"))
    merged = placed.groupBy("at", "at_no").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return merged.select(F.col("at").alias("page_id"), F.col("at_no").alias("paragraph_no"), F.array_join(F.transform("pieces", lambda x: x["p"]), " ").alias("paragraph"), F.size("pieces").alias("pages"))


def _follow(links: DataFrame) -> DataFrame:
    """The page where each linked page's first paragraph begins: page_id, root. Chains are halved in each round, so their length hardly matters."""
    through = links.where("single").select(F.col("page_id").alias("via"), F.col("to").alias("next"))
    roots = links.select("page_id", F.col("to").alias("root"))
    while not roots.join(through, F.col("root") == F.col("via"), "left_semi").isEmpty():
        roots = cut(roots.join(through, F.col("root") == F.col("via"), "left").select("page_id", F.coalesce("next", "root").alias("root")), "roots")
        through = cut(through.join(through.select(F.col("via").alias("v2"), F.col("next").alias("n2")), F.col("next") == F.col("v2"), "left").select("via", F.coalesce("n2", "next").alias("next")), "through")
    return roots
