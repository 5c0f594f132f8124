"""Vector arithmetic on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearkin.functions.text import let


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Vector scaled to length one; a zero vector stays zero."""
    return let(
        F.struct(a.alias("v"), norm(a).alias("n")),
        lambda s: F.transform(
            s["v"], lambda x: F.when(s["n"] > 0, x.cast("double") / s["n"]).otherwise(0.0)
        ),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if either has length zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
