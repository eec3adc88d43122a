"""Vector arithmetic on ``array<float>`` columns, always in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TORCH_NORM_EPSILON = 1e-12


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), F.lit(dim))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; a zero vector scores 0, a null vector stays null."""
    similarity = F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), similarity)


def l2_normalize(v: Column, epsilon: float = TORCH_NORM_EPSILON) -> Column:
    # the norm is computed once, in a one-element array, and not once per entry
    scale = F.array(F.greatest(norm(v), F.lit(epsilon)))
    return F.element_at(
        F.transform(scale, lambda n: F.transform(v, lambda x: x.cast("double") / n)), 1
    )
