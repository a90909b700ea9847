"""Counts and reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_GROUP = "00"


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def last_date(df: DataFrame | None, column: str) -> DataFrame | None:
    """Latest date of a column; nothing when there is no table yet."""
    return None if df is None else df.agg(F.max(F.col(column)).cast("date").alias("last_date"))


def procedure_group(procedure: Column) -> Column:
    """First two characters of a procedure code, ``00`` when there is none."""
    return F.coalesce(F.substring(procedure, 1, 2), F.lit(NO_GROUP))


def monthly_crosstab(
    df: DataFrame, year: str, hospital: str, procedure: str, month: str
) -> DataFrame:
    """Rows per procedure and month for each year and hospital, in one grouped pass.

    Twelve conditional counts instead of a pivot: one shuffle, no second pass, and a
    month without rows is zero.  Rows with another month count nowhere.
    """
    months = [F.count_if(F.col(month) == m).alias(f"m{m:02d}") for m in range(1, 13)]
    counted = (
        df.dropna(subset=[year, procedure])
        .groupBy(F.col(year).alias("year"), F.col(hospital).alias("hospital"), F.col(procedure).alias("procedure"))
        .agg(*months)
    )
    total = sum((F.col(f"m{m:02d}") for m in range(2, 13)), F.col("m01"))
    return counted.withColumn("total", total).withColumn(
        "procedure_group", procedure_group(F.col("procedure").cast("string"))
    )


def sorted_report(report: DataFrame) -> DataFrame:
    """Report rows by year, hospital, procedure group and procedure."""
    return report.orderBy("year", "hospital", "procedure_group", "procedure")


def report_totals(report: DataFrame) -> DataFrame:
    """Procedures, distinct procedure groups and grand total per year and hospital.

    The groups are counted from a first, smaller aggregate, so a large hospital's
    rows are already combined when its groups are counted.
    """
    groups = report.groupBy("year", "hospital", "procedure_group").agg(
        F.count(F.lit(1)).alias("procedures"), F.sum("total").alias("total")
    )
    return groups.groupBy("year", "hospital").agg(
        F.sum("procedures").alias("n_procedures"),
        F.count(F.lit(1)).alias("n_groups"),
        F.sum("total").alias("grand_total"),
    )


def group_fields(df: DataFrame, fields: Iterable[str], sums: Iterable[str] = ()) -> DataFrame:
    """Rows, and sums of value columns, per combination of the requested fields."""
    return df.groupBy(*fields).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums]
    )
