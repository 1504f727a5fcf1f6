"""Box geometry as column expressions. Boxes are pixel coordinates (x0, y0, x1, y1) and never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", alias: str | None = None) -> Box:
    """The four coordinate columns, optionally of an aliased relation."""
    dot = f"{alias}." if alias else ""
    return tuple(F.col(f"{dot}{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def area(b: Box) -> Column:
    big = [c.cast("bigint") for c in b]
    return (big[2] - big[0]) * (big[3] - big[1])


def intersection(a: Box, b: Box) -> Column:
    """Common area, 0 where boxes only touch or are apart."""
    w = F.least(a[2], b[2]).cast("bigint") - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]).cast("bigint") - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0).cast("bigint"))


def covers(span: Box, region: Box, min_overlap: float = 0.3) -> Column:
    """Whether ``region`` covers at least ``min_overlap`` of the area of ``span``. Not symmetric."""
    common = intersection(span, region)
    share = common.cast("double") / F.greatest(area(span), F.lit(1).cast("bigint"))
    return (common > 0) & (share >= F.lit(float(min_overlap)))


def to_pixels(points: Column, dpi: int = 300) -> Column:
    """Points to whole pixels, toward zero."""
    return (points * F.lit(dpi / 72.0)).cast("int")


def padded(b: Box, width: Column, height: Column, padding: int = 8) -> Box:
    """Crop box: ``padding`` more on each side, within the image."""
    zero, pad = F.lit(0), F.lit(padding)
    return F.greatest(zero, b[0] - pad), F.greatest(zero, b[1] - pad), F.least(width, b[2] + pad), F.least(height, b[3] + pad)


def column_index(x0: Column, x1: Column, page_width: Column, columns: int) -> Column:
    """Index of the page column that the middle of a box falls in, the last one at most.

    The quotient is floored exactly as floating floor division does: the remainder goes first.
    """
    middle = (x0.cast("bigint") + x1.cast("bigint")).cast("double") / 2
    width = page_width.cast("double") / columns
    return F.least(F.round((middle - F.pmod(middle, width)) / width).cast("int"), F.lit(columns - 1))


def per_mille(value: Column, extent: Column) -> Column:
    """A coordinate as thousandths of the page extent, toward zero."""
    return ((value / extent) * 1000).cast("int")


def centre(b: Box) -> tuple[Column, Column]:
    two = lambda a, c: ((a.cast("bigint") + c.cast("bigint")) / 2).cast("int")
    return two(b[0], b[2]), two(b[1], b[3])
