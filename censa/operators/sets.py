"""Set operations over common columns, each one grouped pass with map-side combining.

Grouping collapses copies before the shuffle, so a row that fills a third of a
table costs one record per task; a join-based INTERSECT would send all copies to
one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.operators.schema import common_columns

_SIDE = "__side"


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows over the common columns, with bit 1 for ``a`` and bit 2 for ``b``."""
    columns = common_columns(a, b)
    tagged = a.select(*columns, F.lit(1).alias(_SIDE)).unionAll(b.select(*columns, F.lit(2).alias(_SIDE)))
    return tagged.groupBy(*columns).agg(F.bit_or(_SIDE).alias(_SIDE))


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both frames."""
    return _sides(a, b).filter(F.col(_SIDE) == 3).drop(_SIDE)


def only_in_first(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks."""
    return _sides(a, b).filter(F.col(_SIDE) == 1).drop(_SIDE)


def merge_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames over their common columns, without copies."""
    columns = common_columns(a, b)
    return a.select(*columns).unionAll(b.select(*columns)).distinct()
