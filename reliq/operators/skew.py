"""Hot keys: finding them, and joining around them.

A key may hold a third of all rows. The lists made here only steer how rows are spread
over tasks; a key that is missing or listed needlessly changes no result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MOST_KEYS = 1_000
MOST_PIECES = 10_000


@dataclass(frozen=True)
class Hot:
    """Values of a key column to spread, each over so many pieces."""

    values: tuple = ()
    pieces: int = 1

    def __bool__(self) -> bool:
        return bool(self.values)


HotKeys = Mapping[str, Hot]
NONE = Hot()


def hot_keys(
    df: DataFrame, *columns: str, min_rows: int = HOT_ROWS, fraction: float = 0.001
) -> dict[str, Hot]:
    """Values likely held by at least ``min_rows`` rows, per string column.

    One job over a sample of these columns; at most ``MOST_KEYS`` counts of each reach the driver.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("key")) for name in columns]))
    sampled = df.select(*columns).sample(fraction=fraction, seed=11).select(keys.alias("k"))
    counts = sampled.groupBy("k.name", "k.key").agg(F.count("*").alias("hits"))
    hits = max(1, int(min_rows * fraction / 2))
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("hits"), "key"))
    top = counts.filter(F.col("hits") >= hits).withColumn("place", place).filter(F.col("place") <= MOST_KEYS).collect()
    found = {}
    for name in columns:
        mine = [row for row in top if row["name"] == name]
        if mine:
            pieces = ceil(max(row["hits"] for row in mine) / fraction / min_rows)
            found[name] = Hot(tuple(row["key"] for row in mine), min(max(pieces, 2), MOST_PIECES))
    return found


def is_one_of(column: Column, values: Sequence) -> Column:
    """Membership that also finds null, and is never null itself."""
    known = [value for value in values if value is not None]
    found = column.isNull() if len(known) < len(values) else F.lit(False)
    if known:
        found = found | F.coalesce(column.isin(known), F.lit(False))
    return found


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: Hot = NONE) -> DataFrame:
    """Join on a key that is unique on the right.

    Rows of a hot key are spread by the input split they come from, and its one row on
    the right is repeated for every piece.
    """
    if not hot:
        return left.join(right, key, how)
    column, pieces = F.col(key), hot.pieces
    split = F.spark_partition_id() % pieces
    spread = left.withColumn("_piece", F.when(is_one_of(column, hot.values), split).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(pieces - 1))
    repeated = right.withColumn(
        "_piece", F.explode(F.when(is_one_of(column, hot.values), every).otherwise(F.array(F.lit(0))))
    )
    return spread.join(repeated, [key, "_piece"], how).drop("_piece")
