"""Box geometry as column expressions. A box is an array of four doubles x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _four(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(x1, y1, x2, y2)


def parts(box: Column | str) -> list[Column]:
    return [F.get(_c(box), i) for i in range(4)]


def valid_box(box: Column | str) -> Column:
    """four entries, all numbers."""
    return F.coalesce((F.size(_c(box)) == 4) & F.forall(_c(box), lambda x: x.try_cast("double").isNotNull()), F.lit(False))


def coerced_box(box: Column | str) -> Column:
    """G8 for boxes: an array of strings or numbers as four doubles, or null."""
    return F.when(valid_box(box), F.transform(_c(box), lambda x: x.try_cast("double")))


def region_to_page(region: Column | str, inner: Column | str) -> Column:
    """G1: a box within a region as box of the page, in [0, 1] and at least 1e-6 wide where room is left."""
    r, d = parts(region), parts(inner)

    def axis(low: Column, high: Column, a: Column, b: Column) -> tuple[Column, Column]:
        span = F.greatest(F.lit(1e-12), high - low)
        p1, p2 = (F.least(F.lit(1.0), F.greatest(F.lit(0.0), low + x * span)) for x in (a, b))
        return p1, F.when(p2 <= p1, F.least(F.lit(1.0), p1 + F.lit(1e-6))).otherwise(p2)

    x1, x2 = axis(r[0], r[2], d[0], d[2])
    y1, y2 = axis(r[1], r[3], d[1], d[3])
    return _four(x1, y1, x2, y2)


def _inside(x1: Column, x2: Column, size: int) -> tuple[Column, Column]:
    low = F.greatest(F.lit(0), F.least(x1, F.lit(size - 1)))
    return low, F.greatest(low + 1, F.least(x2, F.lit(size)))


def crop_pixels(box: Column | str, width: int, height: int) -> Column:
    """A normalised box in whole pixels, cut towards zero, within the image and at least one pixel wide."""
    b = parts(box)
    whole = [(x * size).cast("int") for x, size in zip(b, (width, height, width, height))]
    x1, x2 = _inside(whole[0], whole[2], width)
    y1, y2 = _inside(whole[1], whole[3], height)
    return F.array(x1, y1, x2, y2)


def letterboxed_pixels(box: Column | str, original: tuple[int, int], resized: tuple[int, int]) -> Column:
    """A normalised box of an image (height, width) in pixels of its letterboxed copy with centred padding."""
    (h, w), (th, tw) = original, resized
    scale = min(th / h, tw / w)
    pad_y, pad_x = (th - int(h * scale)) / 2, (tw - int(w * scale)) / 2
    b = parts(box)
    whole = [(x * F.lit(float(side)) * F.lit(scale) + F.lit(pad)).cast("int") for x, side, pad in zip(b, (w, h, w, h), (pad_x, pad_y, pad_x, pad_y))]
    x1, x2 = _inside(whole[0], whole[2], tw)
    y1, y2 = _inside(whole[1], whole[3], th)
    return F.array(x1, y1, x2, y2)


def letterbox_shape(height: Column | str, width: Column | str, target: tuple[int, int]) -> Column:
    """Struct scale, height, width, pad_bottom, pad_right of an image fitted into ``target`` from the top left."""
    h, w = _c(height).cast("double"), _c(width).cast("double")
    scale = F.least(F.lit(float(target[0])) / h, F.lit(float(target[1])) / w)
    nh, nw = (F.greatest(F.lit(1), (x * scale).cast("int")) for x in (h, w))
    return F.struct(scale.alias("scale"), nh.alias("height"), nw.alias("width"), (F.lit(target[0]) - nh).alias("pad_bottom"), (F.lit(target[1]) - nw).alias("pad_right"))


def to_pixels(box: Column | str, width: Column | str, height: Column | str) -> Column:
    """A normalised box in pixels, not rounded."""
    b, w, h = parts(box), _c(width), _c(height)
    return _four(b[0] * w, b[1] * h, b[2] * w, b[3] * h)


def to_normalised(box: Column | str, width: Column | str, height: Column | str) -> Column:
    """A box in pixels as shares of the image."""
    b, w, h = parts(box), _c(width), _c(height)
    return _four(b[0] / w, b[1] / h, b[2] / w, b[3] / h)


def overlay_pixels(box: Column | str, width: int, height: int) -> Column:
    """A normalised box in pixels for drawing: rounded half to even, within the image, at least one pixel wide."""
    b = parts(box)
    whole = [F.rint(x * size).cast("int") for x, size in zip(b, (width, height, width, height))]
    x1, x2 = _inside(whole[0], whole[2], width)
    y1, y2 = _inside(whole[1], whole[3], height)
    return F.array(x1, y1, x2, y2)


def detected_pixels(box: Column | str, width: int, height: int) -> Column:
    """A box that may be normalised (no entry above 1) or in pixels, in pixels; null where nothing would be left."""
    b = parts(box)
    scale = F.array_max(_c(box)) <= 1.0
    whole = [F.when(scale, x * size).otherwise(x).cast("int") for x, size in zip(b, (width, height, width, height))]
    x1, y1, x2, y2 = (F.greatest(F.lit(0), F.least(x, F.lit(size - 1))) for x, size in zip(whole, (width, height, width, height)))
    return F.when((x2 > x1) & (y2 > y1), F.array(x1, y1, x2, y2))


def render_scale(dpi: Column | str | float) -> Column:
    """Points to pixels."""
    return (F.lit(dpi) if isinstance(dpi, (int, float)) else _c(dpi)) / F.lit(72.0)


def centred_on_canvas(height: Column | str, width: Column | str, target: tuple[int, int]) -> Column:
    """G9, the geometry: struct height, width, top, left of a thumbnail centred on a canvas; small images are not enlarged."""
    h, w = _c(height).cast("double"), _c(width).cast("double")
    scale = F.least(F.lit(1.0), F.lit(float(target[0])) / h, F.lit(float(target[1])) / w)
    nh, nw = (F.greatest(F.lit(1), F.rint(x * scale).cast("int")) for x in (h, w))
    return F.struct(nh.alias("height"), nw.alias("width"), F.floor((F.lit(target[0]) - nh) / 2).cast("int").alias("top"), F.floor((F.lit(target[1]) - nw) / 2).cast("int").alias("left"))


def overlap(a: Column | str, b: Column | str) -> Column:
    """Intersection over union of two boxes; 0 where both are empty."""
    p, q = parts(a), parts(b)
    width = F.greatest(F.lit(0.0), F.least(p[2], q[2]) - F.greatest(p[0], q[0]))
    height = F.greatest(F.lit(0.0), F.least(p[3], q[3]) - F.greatest(p[1], q[1]))
    area = lambda z: (z[2] - z[0]) * (z[3] - z[1])
    return F.coalesce(F.try_divide(width * height, area(p) + area(q) - width * height), F.lit(0.0))
