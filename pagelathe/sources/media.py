"""Pages of PDF files (S7 to S12, S29): an optional backend, guarded.

Rasterising needs a PDF library that may not be installed; nothing here is verified without one. The engine's other
parts read page tables, whoever made them. A backend is any callable ``bytes -> iterator of dicts`` with page_number, width, height,
text and image (bytes); the default uses pypdfium2 where it can be imported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

PAGE = "path string, page_number int, width int, height int, text string, image binary, error string"


def available() -> bool:
    """Whether the default backend can be imported."""
    try:
        import pypdfium2  # noqa: F401
    except ImportError:
        return False
    return True


def pdfium_pages(content: bytes, dpi: float = 150.0) -> Iterator[dict[str, Any]]:
    """Pages by pypdfium2; an unreadable text is ``""``."""
    import io

    import pypdfium2

    for number, page in enumerate(pypdfium2.PdfDocument(content)):
        bitmap = page.render(scale=dpi / 72)
        try:
            text = page.get_textpage().get_text_range().strip()
        except Exception:
            text = ""
        out = io.BytesIO()
        bitmap.to_pil().save(out, format="PNG")
        yield {"page_number": number, "width": bitmap.width, "height": bitmap.height, "text": text, "image": out.getvalue()}


def render_pages(files: DataFrame, backend: Callable[[bytes], Iterator[dict[str, Any]]] = pdfium_pages) -> DataFrame:
    """Pages of ``files`` (path, content). A file that cannot be read yields one row with its error; others go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PAGE.split(", ")]
        types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # A page leaves as soon as it is rendered: a long PDF is never held whole.
                try:
                    for page in backend(content):
                        row = {"path": path, "error": None, **page}
                        yield pa.RecordBatch.from_arrays([pa.array([row.get(n)], t) for n, t in zip(names, types)], names=names)
                except Exception as problem:
                    row = {"path": path, "error": f"{type(problem).__name__}: {problem}"}
                    yield pa.RecordBatch.from_arrays([pa.array([row.get(n)], t) for n, t in zip(names, types)], names=names)

    return files.select("path", "content").mapInArrow(run, PAGE)


def pdfium_count(content: bytes) -> int:
    """Pages of a PDF by pypdfium2; nothing is rendered."""
    import pypdfium2

    return len(pypdfium2.PdfDocument(content))


def page_counts(files: DataFrame, counter: Callable[[bytes], int] = pdfium_count) -> DataFrame:
    """Path and pages; an unreadable file has 0. Pages are counted, not rendered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for content in batch.column(1).to_pylist():
                try:
                    found.append(int(counter(content)))
                except Exception:
                    found.append(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["path", "pages"])

    return files.select("path", "content").mapInArrow(run, "path string, pages long")


LAYOUT = "path string, page_number int, title string, width double, height double, fonts array<string>, images int, annotations int, links int, error string"


def page_layouts(files: DataFrame, examine: Callable[[bytes], Iterator[dict[str, Any]]]) -> DataFrame:
    """What ``examine`` (a PDF library's reading of a file, page by page) tells of each page: title, size, fonts, images, annotations, links. A file that cannot be read yields one row with its error."""
    fields = [f.strip().split(" ", 1) for f in LAYOUT.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows += [{**page, "path": path, "error": None} for page in examine(content)]
                except Exception as problem:
                    rows.append({"path": path, "error": f"{type(problem).__name__}: {problem}"})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], types[t]) for n, t in fields], names=[n for n, _ in fields])

    return files.select("path", "content").mapInArrow(run, LAYOUT)


def png_pixels(content: bytes) -> Any:
    """S10, S12, N9 reversed: the pixels of a PNG as channels x height x width (uint8). 8 bits a channel, grey, RGB, or either with alpha (which is dropped), not interlaced."""
    import struct
    import zlib

    import numpy as np

    if content[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, head, data = 8, None, []
    while at + 8 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", content[at + 8 : at + 21])
        elif kind == b"IDAT":
            data.append(content[at + 8 : at + 8 + size])
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        raise ValueError("only PNGs of 8 bits a channel, not interlaced, without palette")
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width, channels), np.uint8)
    above = np.zeros((width, channels), np.uint8)
    for y in range(height):
        line = raw[y, 1:].reshape(width, channels)
        mode = raw[y, 0]
        if mode == 1:
            line = np.cumsum(line, axis=0, dtype=np.uint32).astype(np.uint8)
        elif mode == 2:
            line = line + above
        elif mode in (3, 4):
            done = np.zeros((width + 1, channels), np.int32)
            up = np.concatenate([np.zeros((1, channels), np.int32), above.astype(np.int32)])
            for x in range(width):
                left, top, corner = done[x], up[x + 1], up[x]
                if mode == 3:
                    guess = (left + top) // 2
                else:
                    p = left + top - corner
                    a, b, c = abs(p - left), abs(p - top), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, top, corner))
                done[x + 1] = (line[x] + guess) & 255
            line = done[1:].astype(np.uint8)
        elif mode:
            raise ValueError(f"unknown filter {mode}")
        out[y] = above = line
    colours = out[..., :1] if channels <= 2 else out[..., :3]
    return np.ascontiguousarray(colours.transpose(2, 0, 1))


def drawn_boxes(image: Any, boxes: list[list[int]], colours: list[tuple[int, ...]], thickness: int = 2) -> Any:
    """K22 with pixels: an image (channels x height x width) with frames of ``boxes`` (x1, y1, x2, y2 in pixels, as ``overlay_pixels`` gives them)."""
    import numpy as np

    out = np.array(image, copy=True)
    for (x1, y1, x2, y2), colour in zip(boxes, colours):
        paint = np.asarray(colour, out.dtype)[: out.shape[0], None, None]
        t = max(1, min(thickness, (x2 - x1 + 1) // 2 or 1, (y2 - y1 + 1) // 2 or 1))
        for rows, columns in ((slice(y1, y1 + t), slice(x1, x2)), (slice(max(y1, y2 - t), y2), slice(x1, x2)), (slice(y1, y2), slice(x1, x1 + t)), (slice(y1, y2), slice(max(x1, x2 - t), x2))):
            out[:, rows, columns] = paint
    return out


def on_canvas(image: Any, target: tuple[int, int], fill: int = 255) -> Any:
    """G9 with pixels: a thumbnail (never enlarged, nearest neighbour) in the middle of a canvas of ``target`` height and width."""
    import numpy as np

    pixels = np.asarray(image)
    channels, height, width = pixels.shape
    scale = min(1.0, target[0] / height, target[1] / width)
    nh, nw = max(1, round(height * scale)), max(1, round(width * scale))
    y = np.minimum((np.arange(nh) + 0.5) * height / nh, height - 1).astype(int)
    x = np.minimum((np.arange(nw) + 0.5) * width / nw, width - 1).astype(int)
    out = np.full((channels, *target), fill, pixels.dtype)
    top, left = (target[0] - nh) // 2, (target[1] - nw) // 2
    out[:, top : top + nh, left : left + nw] = pixels[:, y][:, :, x]
    return out


def png_base64(image: Any) -> str:
    """An image of channels x height x width (floats up to 1.5 count as shares of 255) as base64 of a PNG. Grey or RGB."""
    import base64
    import struct
    import zlib

    import numpy as np

    pixels = np.asarray(image)
    if pixels.ndim != 3 or pixels.shape[0] not in (1, 3):
        raise ValueError(f"an image has 1 or 3 channels, height and width, not {pixels.shape}")
    if np.issubdtype(pixels.dtype, np.floating):
        pixels = pixels * 255 if pixels.size and pixels.max() <= 1.5 else pixels
    pixels = np.clip(np.rint(pixels), 0, 255).astype(np.uint8).transpose(1, 2, 0)
    height, width, channels = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + row.tobytes() for row in pixels)
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)
    return base64.b64encode(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")).decode()


def letterboxed(image: Any, target: tuple[int, int] = (1024, 1024), pad: float = 114.0) -> Any:
    """G4 with pixels: an image fitted into ``target`` from the top left by nearest neighbour, the rest filled with ``pad``."""
    import numpy as np

    pixels = np.asarray(image)
    channels, height, width = pixels.shape
    scale = min(target[0] / height, target[1] / width)
    nh, nw = max(1, int(height * scale)), max(1, int(width * scale))
    y = np.minimum((np.arange(nh) + 0.5) * height / nh, height - 1).astype(int)
    x = np.minimum((np.arange(nw) + 0.5) * width / nw, width - 1).astype(int)
    out = np.full((channels, *target), pad, pixels.dtype)
    out[:, :nh, :nw] = pixels[:, y][:, :, x]
    return out
