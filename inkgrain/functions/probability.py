"""Row-wise work on arrays of class probabilities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def max_probability(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def is_confident(probabilities: Column, threshold: float = 0.90) -> Column:
    """True where the largest probability reaches the threshold; 1.01 turns it off."""
    return max_probability(probabilities) >= F.lit(float(threshold))


def argmax_index(probabilities: Column) -> Column:
    """Position of the first maximum, from 0."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def argmax_label(probabilities: Column, labels) -> Column:
    """The label at the first maximum; ``labels`` are in the order of the probabilities."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), argmax_index(probabilities) + 1)


def normalise(probabilities: Column) -> Column:
    """Scale to sum 1; all zeros become equal shares."""
    total = F.aggregate(probabilities, F.lit(0.0), lambda a, x: a + x)
    equal = F.lit(1.0) / F.size(probabilities)
    return F.transform(probabilities, lambda p: F.when(total > 0, p / total).otherwise(equal))


def soft_vote(members) -> Column:
    """Mean of the members' probability arrays."""
    members = list(members)
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), members)
    return F.transform(total, lambda x: x / len(members))
