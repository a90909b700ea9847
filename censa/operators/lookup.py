"""Registry lookups of a whole column of group codes or column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from censa.registry.groups import group_types
from censa.registry.schemas import default_groups


def group_of(code: Column) -> Column:
    """Registered group of a code: the same one, else the first that starts with it, else null."""
    codes = list(default_groups())
    wanted = F.upper(F.trim(code))
    starts = F.filter(F.array(*map(F.lit, codes)), lambda known: known.startswith(wanted))
    return F.when(wanted.isin(codes), wanted).otherwise(F.get(starts, F.lit(0)))


def table_of(code: Column) -> Column:
    """Table name of a code's group, null without one."""
    names = F.create_map(*[F.lit(x) for group, info in default_groups().items() for x in (group, info["table"])])
    return F.element_at(names, group_of(code))


def is_declared(name: Column, group: str) -> Column:
    """Whether a column name, in any case, belongs to the declared schema of the group."""
    return F.lower(F.trim(name)).isin(list(group_types(group)))
