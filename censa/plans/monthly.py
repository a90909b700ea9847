"""Monthly clean, rename, period date and CSV export of group folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from censa.operators.cleaning import clean_frame
from censa.operators.schema import rename_present
from censa.sinks.files import balanced
from censa.sources.files import with_lineage

# Published names of the main columns.
PUBLISHED_NAMES = {
    "N_AIH": "numeroAIH",
    "ANO_CMPT": "anoCompetencia",
    "MES_CMPT": "mesCompetencia",
    "VAL_TOT": "valorTotal",
    "CNES": "cnes",
    "DT_SAIDA": "dataSaida",
}


def monthly_frame(raw: DataFrame, group: str) -> DataFrame:
    """Cleaned rows under their published names, with the month from the folder name."""
    dated = with_lineage(raw, group, ["competencia"])
    named = rename_present(clean_frame(dated), PUBLISHED_NAMES)
    return named.withColumnRenamed("competencia", "dataCompetencia")


def export_monthly(raw: DataFrame, group: str, path: str) -> None:
    """CSV folders per month."""
    balanced(monthly_frame(raw, group), ["dataCompetencia"]).write.mode("overwrite").partitionBy(
        "dataCompetencia"
    ).option("header", True).csv(path)
