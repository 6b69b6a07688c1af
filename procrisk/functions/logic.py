"""Boolean combinations of any number of conditions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of the conditions."""
    return reduce(and_, conditions)


def any_of(conditions: list[Column]) -> Column:
    """Disjunction of the conditions."""
    return reduce(or_, conditions)
