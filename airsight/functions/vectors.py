"""Dense vectors as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsight.functions.text import let


def as_doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    return let(norm(v), lambda n: F.transform(as_doubles(v), lambda x: F.when(n > 0, x / n).otherwise(x)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def softmax(v: Column) -> Column:
    raised = let(F.array_max(v), lambda top: F.transform(as_doubles(v), lambda x: F.exp(x - top)))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return let(raised, lambda e: let(total(e), lambda t: F.transform(e, lambda x: x / t)))


def argmax(v: Column) -> Column:
    """0-based position of the first largest element."""
    return F.array_position(v, F.array_max(v)) - 1
