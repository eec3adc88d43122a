"""Joins of many wide rows with few narrow ones that share hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of one key are split into.
SALTS = 32


def join_spread(
    rows: DataFrame, few: DataFrame, key: Sequence[str], spread: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Inner join of ``rows`` with ``few`` on ``key``, every key split over ``salts`` parts.

    ``few`` is repeated once per part and should be narrow; ``rows`` are dealt by
    the hash of their ``spread`` columns, so a key that holds a third of them is
    no single task.  A small ``few`` is still broadcast by Spark's own size check.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(salts).cast("bigint"))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    repeated = few.withColumn("_part", parts)
    return rows.withColumn("_part", part).join(repeated, [*key, "_part"]).drop("_part")
