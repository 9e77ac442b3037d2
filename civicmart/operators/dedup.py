"""Unions of tagged sources and the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames by column name, naming each row's origin in ``tag``."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: str,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest ``newest``, NULL last.

    Ties fall to the smallest remaining columns in frame order, so the choice is
    the same on every run.  Columns in ``ignore`` (audit stamps) take no part.

    The filter on row number 1 becomes a group limit that runs before the
    shuffle: each map task sends one row per key, so a key holding a third of
    the table costs its reducer one row per map task.
    """
    rest = [c for c in df.columns if c not in {*keys, newest, *ignore}]
    order = [F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def join_latest(
    left: DataFrame,
    right: DataFrame,
    key: str,
    newest: str,
) -> DataFrame:
    """Left join on ``key`` with the newest ``right`` row of that key.

    Rows without a key never match.  They carry a hash of their own content beside
    the missing key, so they spread over all tasks; rows with a key carry 0 on both
    sides.  Key and hash travel as one struct: as two columns the optimizer would
    fold the right side's constant and shuffle by the key alone.  A hot key among
    the matching rows is split by AQE, because the right side holds one row per key.
    """
    place, none = "__place", F.lit(0).cast("bigint")
    latest = latest_per_key(right.filter(F.col(key).isNotNull()), [key], newest)
    others = [c for c in left.columns if c != key]
    # Never 0, so that a row without a key differs from every row on the right.
    scattered = F.xxhash64(*others).bitwiseOR(F.lit(1).cast("bigint"))
    lane = F.when(F.col(key).isNull(), scattered).otherwise(none)
    placed = left.withColumn(place, F.struct(F.col(key).alias("key"), lane.alias("lane")))
    matches = latest.withColumn(place, F.struct(F.col(key).alias("key"), none.alias("lane"))).drop(key)
    joined = placed.join(matches, place, "left").drop(place)
    return joined.select(key, *[c for c in joined.columns if c != key])
