"""Set-like operations by key: first row wins, ignore known, replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Each task ranks its own rows first and passes on one row per key, so copies
    of a hot key never meet in one task.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def not_yet_stored(new: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``stored``: one anti join.

    After :func:`first_per_key` the new rows are partitioned by the key already.
    """
    return new.join(stored.select(*key), list(key), "left_anti")


def merge_replace(
    new: DataFrame, stored: DataFrame, key: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Upsert: rows of ``new`` replace those of ``stored`` with the same key.

    Columns in ``keep`` are not replaced: a stored value survives, a new row has
    null there.  Stored rows without a counterpart stay.
    """
    key = list(key)
    replaced = [c for c in new.columns if c not in key and c not in keep]
    values = [
        F.when(F.col("_is_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
        for c in replaced
    ]
    fresh = new.select(*key, *replaced).withColumn("_is_new", F.lit(True)).alias("n")
    return fresh.join(stored.alias("o"), key, "full_outer").select(
        *key, *values, *[F.col(f"o.{c}").alias(c) for c in keep]
    )
