"""Similarities of two values as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.functions.text import byte_view


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repetitions; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both.cast("double") / (F.size(a) + F.size(b) - both))


def dice(a: Column, b: Column) -> Column:
    """Of two arrays without repetitions; 1 if both are empty."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(F.lit(2.0) * F.size(F.array_intersect(a, b)) / total)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length, in bytes; an empty side gives 1 only against an empty one."""
    longest = F.greatest(F.octet_length(a), F.octet_length(b))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(1.0 - F.levenshtein(byte_view(a), byte_view(b)).cast("double") / longest)


def length_ratio(a: Column, b: Column) -> Column:
    x, y = F.octet_length(a), F.octet_length(b)
    return F.when((x == 0) | (y == 0), 0.0).otherwise(F.least(x, y).cast("double") / F.greatest(x, y))


def containment(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), 0.0).otherwise((F.contains(a, b) | F.contains(b, a)).cast("double"))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def f_beta(tp: Column, predicted: Column, true: Column, beta: float = 0.5) -> Column:
    """F-beta of one entity: without true matches 1 if nothing is predicted, else 0."""
    p, r, b2 = tp / predicted, tp / true, beta * beta
    return F.when(true == 0, F.when(predicted == 0, 1.0).otherwise(0.0)).when((predicted == 0) | (tp == 0), 0.0).otherwise((1 + b2) * p * r / (b2 * p + r))
