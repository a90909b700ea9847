"""Procedure-by-month report per year and hospital."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from censa.operators.profile import null_ratio
from censa.operators.reports import monthly_crosstab, report_totals
from censa.operators.schema import rename_present
from censa.sinks.files import export_report

# Spellings of the input columns.
INPUT_NAMES = {
    "Sp Procrea": "Sp_Procrea",
    "Sp Mm": "Sp_Mm",
    "Sp Aa": "Sp_Aa",
    "Sp Cnes": "Sp_Cnes",
}


def build_report(df: DataFrame, hospital: str = "Sp_Cnes") -> DataFrame:
    """Crosstab of a production frame; missing columns are an error."""
    named = rename_present(df, INPUT_NAMES)
    missing = [c for c in INPUT_NAMES.values() if c not in named.columns]
    if missing:
        raise ValueError(f"columns missing from the report input: {missing}")
    return monthly_crosstab(named, "Sp_Aa", hospital, "Sp_Procrea", "Sp_Mm")


def report_nulls(df: DataFrame) -> DataFrame:
    """Nulls per needed input column."""
    return null_ratio(rename_present(df, INPUT_NAMES), INPUT_NAMES.values())


def write_report(
    df: DataFrame, path: str, hospital: str = "Sp_Cnes", per_hospital: bool = True
) -> DataFrame:
    """Write the report and return its totals, read back from what was written."""
    report = build_report(df, hospital)
    export_report(report, path, per_hospital)
    folders = ["year", "hospital"] if per_hospital else ["year"]
    fields = [f for f in report.schema.fields if f.name not in folders]
    schema = T.StructType(fields + [report.schema[c] for c in folders])
    return report_totals(df.sparkSession.read.schema(schema).option("header", True).csv(path))
