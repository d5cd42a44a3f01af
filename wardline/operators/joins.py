"""Join helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zero_filled(df: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Counts become 0 where a join found nothing; all other measures keep their NULL."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def full_outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], counts: Sequence[str]
) -> DataFrame:
    """Full outer join with coalesced keys and zero-filled counts."""
    return zero_filled(left.join(right, list(keys), "full_outer"), counts)


def left_chain(
    spine: DataFrame, measures: Sequence[DataFrame], keys: Sequence[str]
) -> DataFrame:
    """Spine left-joined to several measure tables on the same keys."""
    joined = spine
    for measure in measures:
        joined = joined.join(measure, list(keys), "left")
    return joined


def orphan_rows(child: DataFrame, parent: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Child rows whose (non-NULL) reference is missing from the parent."""
    for column in columns:
        child = child.filter(F.col(column).isNotNull())
    keys = parent.select(*[F.col(p).alias(c) for c, p in columns.items()])
    return child.join(keys, list(columns), "left_anti")

