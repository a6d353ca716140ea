"""Box geometry as column expressions; boxes are x1, y1, x2, y2 of columns or of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))


def part(s: Column) -> tuple[Column, Column, Column, Column]:
    return s["x1"], s["y1"], s["x2"], s["y2"]


def width(b) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0])


def height(b) -> Column:
    return F.greatest(F.lit(0.0), b[3] - b[1])


def area(b) -> Column:
    return width(b) * height(b)


def aspect(b) -> Column:
    """Width over height, 0 where there is no height."""
    return F.when(height(b) > 0, width(b) / height(b)).otherwise(0.0)


def inter(a, b) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return w * h


def union(a, b) -> Column:
    return area(a) + area(b) - inter(a, b)


def iou(a, b, eps: float = 0.0) -> Column:
    """Intersection over union; 0 for an empty union, unless ``eps`` keeps it from being empty."""
    if eps:
        return inter(a, b) / (union(a, b) + F.lit(eps))
    return F.when(union(a, b) > 0, inter(a, b) / union(a, b)).otherwise(0.0)


def contains(outer, inner) -> Column:
    return (inner[0] >= outer[0]) & (inner[1] >= outer[1]) & (inner[2] <= outer[2]) & (inner[3] <= outer[3])


def contains_share(outer, inner, share: float = 0.85) -> Column:
    return F.when(area(inner) > 0, inter(outer, inner) / area(inner) >= share).otherwise(False)


def contains_tol(outer, inner, tol: float) -> Column:
    """Containment with a slack of ``tol`` times the outer box's own size."""
    dx, dy = width(outer) * tol, height(outer) * tol
    return (inner[0] >= outer[0] - dx) & (inner[1] >= outer[1] - dy) & (inner[2] <= outer[2] + dx) & (inner[3] <= outer[3] + dy)


def enclosing(a, b):
    return F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[2], b[2]), F.greatest(a[3], b[3])


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def edges_touched(b, near: float) -> Column:
    """How many sides lie within ``near`` of the image's border."""
    sides = (b[0] <= near, b[1] <= near, b[2] >= 1 - near, b[3] >= 1 - near)
    return sum((s.cast("int") for s in sides[1:]), sides[0].cast("int"))


def to_pixels(b, w: int, h: int):
    """Normalised corners to whole pixels, cut off towards zero."""
    return (b[0] * w).cast("int"), (b[1] * h).cast("int"), (b[2] * w).cast("int"), (b[3] * h).cast("int")


def to_centre(b):
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2, b[2] - b[0], b[3] - b[1]


def from_centre(cx, cy, w, h):
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def yolo_pixels(cx, cy, w, h, iw: int, ih: int) -> Column:
    """Centre form to pixel corners, swapped if inverted and clipped to the last pixel; null if empty."""
    a = from_centre(cx * iw, cy * ih, w * iw, h * ih)
    x1, x2 = F.least(a[0], a[2]), F.greatest(a[0], a[2])
    y1, y2 = F.least(a[1], a[3]), F.greatest(a[1], a[3])
    c = [F.greatest(F.lit(0.0), F.least(F.lit(float(m - 1)), v)) for v, m in ((x1, iw), (y1, ih), (x2, iw), (y2, ih))]
    return F.when((c[2] > c[0]) & (c[3] > c[1]), F.struct(*[v.alias(n) for v, n in zip(c, ("x1", "y1", "x2", "y2"), strict=True)]))
