"""Column functions on vectors, rectangles and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalised(v: Column) -> Column:
    n = F.greatest(norm(v), F.lit(1e-12))
    return F.transform(v, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of structs x1, y1, x2, y2; 0 without an overlap."""
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    both = w * h
    area = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    union = area(a) + area(b) - both
    return F.when((w > 0) & (h > 0) & (union != 0), F.try_divide(both, union)).otherwise(F.lit(0.0))


#: Fixed value: height of a page in points where none is given.
PAGE_HEIGHT = 841.89


def flip(box: Column, height: float = PAGE_HEIGHT, tidy: bool = False) -> Column:
    """The box seen from the other vertical end of the page; `tidy` puts swapped corners right."""
    y1, y2 = F.lit(height) - box["y2"], F.lit(height) - box["y1"]
    if tidy:
        y1, y2 = F.least(y1, y2), F.greatest(y1, y2)
    return F.when(box.isNotNull(), F.struct(box["x1"].alias("x1"), y1.alias("y1"), box["x2"].alias("x2"), y2.alias("y2")))


def coords_box(coords: Column, as_size: bool = False) -> Column:
    """struct(page, x1, y1, x2, y2) around the spans 'page,a,b,c,d;...': first page, least and greatest corners.

    Spans that don't have five numbers are passed over; without any the result is
    null.  as_size: c and d are width and height.
    """
    spans = F.transform(F.split(coords, ";"), lambda s: F.transform(F.split(s, ","), lambda x: F.regexp_replace(x, " ", "").try_cast("double")))
    good = F.filter(spans, lambda s: (F.size(s) == 5) & ~F.exists(s, lambda x: x.isNull()))
    at = lambda k: F.transform(good, lambda s: s[k])
    far = lambda k: F.transform(good, lambda s: s[k] + s[k + 2]) if as_size else F.transform(good, lambda s: s[k + 2])
    return F.when(
        F.size(good) > 0,
        F.struct(F.get(good, F.lit(0))[0].cast("int").alias("page"), F.array_min(at(1)).alias("x1"), F.array_min(at(2)).alias("y1"), F.array_max(far(1)).alias("x2"), F.array_max(far(2)).alias("y2")),
    )


def megabytes(size: Column, digits: int = 2) -> Column:
    return F.round(size / F.lit(1048576.0), digits)


def retry_delay(retries: Column, base: int, doubling: bool = True) -> Column:
    """Seconds to wait before the next attempt: base * 2^r, or base * (r + 1)."""
    return (F.lit(base) * (F.pow(F.lit(2), retries) if doubling else retries + 1)).cast("long")
