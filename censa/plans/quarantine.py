"""Conversion that sets whole columns aside, published in one pass over the rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation

from censa.operators.conversion import both_forms, declared_type
from censa.registry.types import spark_type
from censa.sinks import generations
from censa.sinks.tables import Published, reconcile


def publish_quarantined(df: DataFrame, types: dict[str, str], table: str, root: str, **options) -> Published:
    """Publish the converted frame; a column with one failure or more is null there and kept whole in ``new_<column>``.

    Which columns fail is known only after all rows were converted.  So both forms of every declared
    column are written, failures are counted by the same job, and the table then shows the
    right form of each.  ``values`` are the failures by column.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table.replace('.', '_')}-{uuid.uuid4().hex}"
    seen = Observation(f"quarantine-{uuid.uuid4().hex}")
    forms = both_forms(df, types, seen, **options)
    forms.write.mode("errorifexists").parquet(path)
    counts = dict(seen.get)
    n_rows = reconcile(counts.pop("__rows"), spark.read.schema(forms.schema).parquet(path).count())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in forms.schema.fields)
    newest = generations.new_generation(spark, table)
    spark.sql(f"CREATE TABLE {newest} ({fields}) USING parquet LOCATION '{path}'")
    nothing = {c: f"CAST(NULL AS {spark_type(declared_type(types, c)).simpleString()}) AS `{c}`" for c, n in counts.items() if n}
    shown = [nothing.get(c, f"`{c}`") for c in df.columns] + [f"`new_{c}`" for c in nothing]
    generations.show(spark, table, newest, shown)
    generations.retire(spark, table, root)
    return Published(spark.table(table), n_rows, counts)
