"""Surrogate keys, row hashes and audit columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.context import RunContext, utc

KEY_SEPARATOR = "-"
KEY_NULL = "_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts as text; NULL parts keep their place through a marker."""
    return F.md5(
        F.concat_ws(
            KEY_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(KEY_NULL)) for p in parts]
        )
    )


def row_hash(columns: Iterable[str]) -> Column:
    """MD5 of the row as JSON. NULL fields are left out, so a new all-NULL column changes nothing."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns])))


def with_staging_audit(df: DataFrame, model: str, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "_stg_loaded_at": utc(ctx.run_ts),
            "_stg_model_name": F.lit(model),
            "_stg_run_id": F.lit(ctx.run_id),
        }
    )


def with_gold_audit(df: DataFrame, model: str, ctx: RunContext) -> DataFrame:
    loaded, name, run = fv.GOLD_AUDIT_COLUMNS
    return df.withColumns(
        {loaded: utc(ctx.run_ts), name: F.lit(model), run: F.lit(ctx.run_id)}
    )
