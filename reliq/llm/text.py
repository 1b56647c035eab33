"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.session import fresh_dir

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    # Of a text of ASCII alone that is its lower case, which takes bytes, not characters.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without(text: Column, characters: str) -> Column:
    """The text without any of some characters."""
    return F.translate(text, characters, "")


def split_words(text: Column) -> Column:
    """The words between runs of white space, as an array without empty words."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def key128(*values: Column) -> list[Column]:
    """Two 64-bit hashes that together stand for the values."""
    return [F.xxhash64(*values), F.xxhash64(F.lit(2654435769), *values)]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: later jobs start from its files."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a frame, written as text, up to which it may be broadcast.
BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """A stored frame, marked for broadcast if it has at most ``most_rows`` rows and ``BROADCAST_BYTES`` bytes.

    Beyond that the join is left to Spark, which shuffles both sides and splits hot keys.
    """
    row = F.octet_length(F.to_json(F.struct(*[df[name] for name in df.columns])))
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).head()
    return F.broadcast(df) if size["rows"] <= most_rows and size["bytes"] <= BROADCAST_BYTES else df
