"""Vectors as ``array<double>``; every sum is taken in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.base import let

_ZERO = 0.0
NEAR_ZERO = 1e-12


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(_ZERO), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(_ZERO), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    return let(
        as_double(vector),
        lambda v: let(
            norm(v),
            lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v),
        ),
    )


def cosine_similarity(a: Column, b: Column) -> Column:
    return dot(l2_normalize(a), l2_normalize(b))


def euclidean_distance(a: Column, b: Column) -> Column:
    return norm(F.zip_with(a, b, lambda x, y: x - y))


def question_half(vector: Column) -> Column:
    return F.slice(vector, F.lit(1), (F.size(vector) / 2).cast("int"))


def answer_half(vector: Column) -> Column:
    half = (F.size(vector) / 2).cast("int")
    return F.slice(vector, half + 1, F.size(vector) - half)


def concat_halves(question: Column, answer: Column) -> Column:
    return F.concat(question, answer)


def rescale(vector: Column, low: Column, high: Column) -> Column:
    """Shift by ``low`` and divide by the range, but never by less than one."""
    width = F.greatest(high - low, F.lit(1.0))
    return F.transform(vector, lambda x: (x - low) / width)


def _shares(vector: Column) -> Column:
    """Divide by the sum; a zero sum gives NaN instead of an error."""
    return let(
        vector,
        lambda v: let(
            total(v),
            lambda s: F.transform(
                v, lambda x: F.when(s != 0, x / s).otherwise(F.lit(float("nan")))
            ),
        ),
    )


def kl_divergence(p: Column, q: Column) -> Column:
    """Relative entropy of p to q after both are scaled to sum one: 0 where p is 0,
    +inf where only q is 0."""

    def term(x: Column, y: Column) -> Column:
        return (
            F.when(F.isnan(x) | F.isnan(y), F.lit(float("nan")))
            .when((x > 0) & (y > 0), x * F.ln(x / y))
            .when((x == 0) & (y >= 0), F.lit(0.0))
            .otherwise(F.lit(float("inf")))
        )

    return total(F.zip_with(_shares(p), _shares(q), term))


def entropy(vector: Column) -> Column:
    """Natural-log entropy after scaling to sum one; a negative share gives -inf."""

    def term(x: Column) -> Column:
        return (
            F.when(F.isnan(x), F.lit(float("nan")))
            .when(x > 0, -x * F.ln(x))
            .when(x == 0, F.lit(0.0))
            .otherwise(F.lit(float("-inf")))
        )

    return total(F.transform(_shares(vector), term))


def normalized_effective_rank(vector: Column) -> Column:
    """Entropy in bits of the absolute values over its maximum: 0 … 1."""
    sizes = F.filter(
        F.transform(as_double(vector), lambda x: F.abs(x)), lambda x: x > NEAR_ZERO
    )
    return let(
        sizes,
        lambda s: F.when(
            F.size(s) > 1,
            let(
                total(s),
                lambda t: total(
                    F.transform(s, lambda x: -(x / t) * F.log2(x / t))
                ),
            )
            / F.log2(F.size(s).cast("double")),
        ).otherwise(F.lit(0.0)),
    )
