"""Keeping one row per key, and telling a first row from its later copies.

The order is total up to identical rows, so any run keeps the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reliq.operators.skew import NONE, Hot, is_one_of

def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Spark cuts every map task down to one row per key before the exchange, so a
    key that holds a third of all rows costs the reducer one row per map task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The incoming rows whose key the target does not hold, one row per key.

    The incoming rows are cut to one per key first, which also leaves them partitioned
    for the join.
    """
    return first_per_key(incoming, key, order).join(target.select(key), key, "left_anti")


def mark_firsts(
    df: DataFrame, key: str, order: Sequence[Column], valid: str, hot: Hot = NONE, lane: str = "_lane"
) -> DataFrame:
    """Add ``is_first`` and ``is_first_valid``.

    ``is_first`` marks the first of all rows of a key, ``is_first_valid`` the first
    of those where ``valid`` holds. Both come from one exchange on the key.

    Hot keys are ranked in two steps: inside each value of the column ``lane`` (the
    input split a row was read from), and then among the lane winners only, at most
    two per lane. All other keys are settled by the first step.
    """
    if not hot:
        return _ranked(df, [key], order, valid)
    laned = df.withColumn("_spread", is_one_of(F.col(key), hot.values))
    laned = laned.withColumn(lane, F.when(F.col("_spread"), F.col(lane)).otherwise(-1))
    local = _ranked(laned, [key, lane], order, valid)
    # Told by a column the window does not partition by, so that both branches read the
    # same exchange instead of repeating what lies below it.
    winner = F.col("_spread") & (F.col("is_first") | F.col("is_first_valid"))
    settled = local.filter(~winner)
    contested = local.filter(winner).drop("is_first", "is_first_valid")
    return settled.unionByName(_ranked(contested, [key], order, valid)).drop("_spread")


def _ranked(df: DataFrame, by: list[str], order: Sequence[Column], valid: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = {
        "_rank": F.row_number().over(window),
        "_valid_rank": F.sum(F.col(valid).cast("int")).over(running),
    }
    firsts = {
        "is_first": F.col("_rank") == 1,
        "is_first_valid": F.col(valid) & (F.col("_valid_rank") == 1),
    }
    return df.withColumns(ranks).withColumns(firsts).drop("_rank", "_valid_rank")
