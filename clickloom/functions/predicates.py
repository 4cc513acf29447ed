"""Filter predicates with one rule in common: a missing parameter passes every row, and with
the parameter set a missing data value fails."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def between(value: Column, low: int | None, high: int | None) -> Column | None:
    """Closed range; applies only when both bounds are given."""
    if low is None or high is None:
        return None
    return F.coalesce(value.between(low, high), F.lit(False))


def in_list(value: Column, wanted: Sequence | None) -> Column | None:
    """A text column, itself possibly a comma list, with an element among ``wanted``."""
    return any_in(F.split(value, ","), wanted)


def any_in(values: Column, wanted: Sequence | None) -> Column | None:
    """An array column sharing an element with ``wanted``."""
    if not wanted:
        return None
    return F.coalesce(F.arrays_overlap(values, F.array(*map(F.lit, wanted))), F.lit(False))


def equal(value: Column, wanted: str | None) -> Column | None:
    if wanted is None:
        return None
    return F.coalesce(value == F.lit(wanted), F.lit(False))


def all_of(*conditions: Column | None) -> Column:
    """AND of the conditions that apply; TRUE when none does."""
    return reduce(lambda a, b: a & b, (c for c in conditions if c is not None), F.lit(True))
