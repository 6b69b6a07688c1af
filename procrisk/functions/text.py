"""Display text of report columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from procrisk import fixed


def thousands(column: str) -> Column:
    """``1,234,567``; NULL as empty text."""
    return F.coalesce(F.format_number(F.bround(F.col(column), 0).cast("decimal(38,0)"), 0), F.lit(""))


def flag_title(column: str) -> Column:
    """``single_bidder_flag`` as ``Single Bidder``."""
    return F.initcap(F.replace(F.replace(F.col(column), F.lit("_flag"), F.lit("")), F.lit("_"), F.lit(" ")))


def row_colour(column: str) -> Column:
    """Cell style of a risk category; empty for the others."""
    high, medium = fixed.ROW_COLOURS["High"], fixed.ROW_COLOURS["Medium"]
    return F.when(F.col(column) == "High", high).when(F.col(column) == "Medium", medium).otherwise("")


def object_name(column: str) -> Column:
    """Object entity of a list entity; an unknown name stays as it is."""
    pairs = [F.lit(part) for pair in fixed.OBJECT_NAMES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.col(column))
