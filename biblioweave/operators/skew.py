"""Joins whose left side may keep a large share of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F, types as T

# A key is hot when it holds more than 1/SHARE of the rows, so there are always
# fewer than SHARE hot keys, whatever the size of the data.
SHARE = 256
# Keys below this many rows fit a task easily and are never split.
MIN_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = SHARE, min_rows: int = MIN_ROWS) -> list[Row]:
    """The hot keys (NULL included) and the number of splits each needs: under ``share`` rows."""
    counts = df.groupBy(*[F.col(f"`{k}`").alias(f"_hot{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    sizes = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
    per_split = max((sizes.total or 0) / share, min_rows)
    if not sizes.largest or sizes.largest <= per_split:
        return []
    splits = F.ceil(F.col("_n") / per_split).cast("int")
    return counts.where(F.col("_n") > per_split).withColumn("_splits", splits).drop("_n").collect()


def _with_splits(df: DataFrame, hot: list[Row], keys: Sequence[str]) -> DataFrame:
    fields = [T.StructField(f"_hot{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    table = df.sparkSession.createDataFrame(hot, T.StructType([*fields, T.StructField("_splits", T.IntegerType())]))
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_hot{i}")) for i, k in enumerate(keys)])
    joined = df.join(F.broadcast(table), same, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_splits", F.lit(1)).alias("_splits"))


def spread(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_id: str,
    share: int = SHARE,
    min_rows: int = MIN_ROWS,
    salt: str = "_salt",
) -> tuple[DataFrame, DataFrame]:
    """Add column ``salt`` to both sides if the left side has hot keys.

    Left rows of a hot key (a NULL key included) are dealt over its splits and
    the right rows of that key are repeated once per split; every other row has
    salt 0. Joining on ``keys`` and ``salt`` gives the same rows as on ``keys``.
    """
    hot = hot_keys(left, keys, share, min_rows)
    if not hot:
        return left, right
    salted = _with_splits(left, hot, keys).withColumn(
        salt, F.pmod(F.xxhash64(row_id), F.col("_splits")).cast("int")
    )
    repeated = _with_splits(right, hot, keys).withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))
    )
    return salted.drop("_splits"), repeated.drop("_splits")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_id: str,
    how: str,
    share: int = SHARE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``left.join(right, keys, how)`` for inner, left, left_semi and left_anti joins."""
    left, right = spread(left, right, keys, row_id, share, min_rows)
    salt = ["_salt"] if "_salt" in left.columns else []
    return left.join(right, [*keys, *salt], how).drop("_salt")
