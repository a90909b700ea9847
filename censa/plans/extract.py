"""Extraction: scan, filter, trim, convert with error flags, publish."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from censa.operators.cleaning import trim_text
from censa.operators.conversion import convert_with_errors, error_columns
from censa.operators.filters import any_text, keep_facilities, project
from censa.operators.reports import group_fields
from censa.registry.groups import Request, facility_column, group_types
from censa.sinks.tables import publish
from censa.sources.files import scan_request


def select_raw(raw: DataFrame, fields: list[str], facility: str, codes: list[str]) -> DataFrame:
    """Requested fields of the requested facilities, as trimmed text."""
    return trim_text(project(keep_facilities(raw, facility, codes), fields, facility))


def extract_frame(
    raw: DataFrame, fields: list[str], facility: str, codes: list[str], types: dict[str, str], **options
) -> DataFrame:
    """Requested fields of the requested facilities, typed, with error flags."""
    return convert_with_errors(select_raw(raw, fields, facility, codes), types, **options)


def extract(spark: SparkSession, root: str, request: Request, facility: str | None = None, **options) -> DataFrame:
    """The frame a request describes, over the group's folders; nothing runs yet."""
    types = group_types(request.group)
    return convert_with_errors(_selected(spark, root, request, facility), types, **options)


def _selected(spark: SparkSession, root: str, request: Request, facility: str | None, required: bool = False) -> DataFrame:
    types = group_types(request.group)
    raw = scan_request(spark, root, request, types={c.upper(): t for c, t in types.items()}, required=required)
    return select_raw(raw, request.fields, facility or facility_column(request.group), request.facilities)


@dataclass
class Extracted:
    """The published table and what was counted on the way."""

    table: DataFrame
    n_rows: int
    n_with_text: int
    errors: dict[str, int]


def extract_to_table(
    spark: SparkSession,
    root: str,
    request: Request,
    target_root: str,
    facility: str | None = None,
    grouped: bool = False,
    allow_missing: bool = False,
    **options,
) -> Extracted:
    """Run a request and publish the result; one read of the source in all.

    Text statistics, error counts and the row count are observed during the write.
    ``grouped`` publishes rows per combination of the requested fields instead; its text
    count is taken below a shuffle, so a task that runs again counts twice there.
    A period without any folder is an error and the table stays as it was, unless
    ``allow_missing``.
    """
    seen = Observation(f"extract-{uuid.uuid4().hex}")
    selected = _selected(spark, root, request, facility, required=not allow_missing)
    counted = selected.observe(seen, F.count_if(any_text(selected)).alias("n_with_text"))
    df = convert_with_errors(counted, group_types(request.group), **options)
    flags = [] if grouped else error_columns(df)
    result = group_fields(df, request.fields) if grouped else df
    out = publish(result, request.target_table, target_root, optional=flags)
    return Extracted(out.table, out.n_rows, seen.get["n_with_text"], out.values)
