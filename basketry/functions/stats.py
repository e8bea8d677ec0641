"""Ranks with ties, the normal quantile function, and vector arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import names, salted_lookup


def average_rank(by: str | Sequence[str], score: str) -> Column:
    """Rank inside a group, best first; tied rows share the mean of their ranks; null stays null."""
    ordered = Window.partitionBy(*names(by)).orderBy(F.col(score).desc_nulls_last())
    ties = Window.partitionBy(*names(by), score)
    rank = F.rank().over(ordered) + (F.count(F.lit(1)).over(ties) - 1) / 2
    return F.when(F.col(score).isNotNull(), rank)


def average_rank_by_value(
    df: DataFrame, by: str | Sequence[str], value: str, salt_on: str | Sequence[str], out: str
) -> DataFrame:
    """Same rank for groups of any size: only the distinct values of a group are sorted."""
    by = names(by)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    above = (Window.partitionBy(*by).orderBy(F.col(value).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(
        *by, value,
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + (F.col("_n") + 1) / 2).alias(out))
    return salted_lookup(df, ranks, [*by, value], salt_on, "inner")


def tie_key(score: str | Column, digits: int = 6) -> Column:
    """Sort key in which scores that differ by rounding noise only are equal."""
    value = F.col(score) if isinstance(score, str) else score
    return F.rint(value * F.lit(10.0 ** digits))


# Coefficients of Wichura's algorithm AS 241 (PPND16), lowest power first.
AS241_CENTRE_NUM = [
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
    1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
    3.3430575583588128105e4, 2.5090809287301226727e3,
]
AS241_CENTRE_DEN = [
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
    5.2264952788528545610e3,
]
AS241_MIDDLE_NUM = [
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
    3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
    2.27238449892691845833e-2, 7.74545014278341407640e-4,
]
AS241_MIDDLE_DEN = [
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
    1.05075007164441684324e-9,
]
AS241_TAIL_NUM = [
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
    2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
    2.71155556874348757815e-5, 2.01033439929228813265e-7,
]
AS241_TAIL_DEN = [
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
    2.04426310338993978564e-15,
]
# Probabilities closer than this to 0 or 1 are clipped.
NORMAL_CLIP = 1e-7


def _horner(coefficients: list[float], x: Column) -> Column:
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * x + F.lit(c)
    return total


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, clipped near 0 and 1; null stays null."""
    given = p
    p = F.greatest(F.lit(NORMAL_CLIP), F.least(F.lit(1 - NORMAL_CLIP), p))
    q = p - 0.5
    centre = 0.180625 - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    middle, tail = r - 1.6, r - 5.0
    outer = F.when(
        r <= 5.0, _horner(AS241_MIDDLE_NUM, middle) / _horner(AS241_MIDDLE_DEN, middle),
    ).otherwise(_horner(AS241_TAIL_NUM, tail) / _horner(AS241_TAIL_DEN, tail))
    inner = q * _horner(AS241_CENTRE_NUM, centre) / _horner(AS241_CENTRE_DEN, centre)
    return F.when(
        given.isNotNull(),
        F.when(F.abs(q) <= 0.425, inner).otherwise(F.when(q < 0, -outer).otherwise(outer)))


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def unit(vec: str | Column) -> Column:
    """Vector divided by its Euclidean length; a zero vector gives null."""
    length = F.sqrt(dot(vec, vec))
    return F.when(length > 0, F.transform(vec, lambda x: x / length))
