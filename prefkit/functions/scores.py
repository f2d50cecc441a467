"""Score columns: comparisons, losses and report texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def beats(a: Column, b: Column) -> Column:
    """Strictly greater. A tie, a NaN or a missing score never wins.

    Spark orders NaN above every number, so it has to be ruled out by hand.
    """
    return F.coalesce(~F.isnan(a) & ~F.isnan(b) & (a > b), F.lit(False))


def verdict(chosen: Column, rejected: Column) -> Column:
    return F.when(beats(chosen, rejected), "Correct").otherwise("Incorrect")


def first_logit(logits: Column) -> Column:
    return F.element_at(logits, 1)


def pair_loss(chosen: Column, rejected: Column) -> Column:
    """``softplus(rejected - chosen)`` in the form that does not overflow."""
    gap = rejected - chosen
    return F.greatest(gap, F.lit(0.0)) + F.log1p(F.exp(-F.abs(gap)))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, null for an empty whole."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def four_places(score: Column) -> Column:
    return F.when(score.isNotNull(), F.format_string("%.4f", score))


def two_places_percent(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.2f%%", value))
