"""Labelled-pair CSV and JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.labels import PAIR_COLUMNS, require_columns

ENVELOPE_KEYS = ("jobs", "resumes", "data", "training_data")


def read_pairs_csv(spark: SparkSession, path: str, needed: list[str] = PAIR_COLUMNS) -> DataFrame:
    """CSV with quoted multi-line texts. The header is read first and checked
    against the contract, so a wrong file fails with the missing names."""
    options = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}
    header = spark.read.options(**options).csv(path)
    require_columns(header, needed)
    return header.select(*needed)


def unwrap_envelope(raw: Column, row_schema: str, keys: tuple[str, ...] = ENVELOPE_KEYS) -> Column:
    """Rows of a JSON response: a bare list, a list under a known key, or one
    object. Unreadable or empty responses give no rows."""
    as_list = F.from_json(raw, f"array<{row_schema}>")
    wrapped = F.from_json(raw, "struct<" + ", ".join(f"{k}: array<{row_schema}>" for k in keys) + ">")
    single = F.from_json(raw, row_schema)
    body = F.ltrim(raw)
    inner = F.coalesce(*[wrapped[k] for k in keys])
    has_key = F.coalesce(*[F.get_json_object(raw, f"$.{k}") for k in keys]).isNotNull()
    rows = F.when(body.startswith("["), as_list).when(has_key, inner).otherwise(F.array(single))
    return F.coalesce(rows, F.array().cast(f"array<{row_schema}>"))


def rows_of(df: DataFrame, raw: str, row_schema: str, needed: list[str]) -> DataFrame:
    """Explode envelopes to rows; rows without all needed fields are dropped."""
    others = [c for c in df.columns if c != raw]
    rows = df.select(*others, F.inline(unwrap_envelope(F.col(raw), row_schema)))
    return rows.na.drop(subset=needed)
