"""Documents for small tests."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

PROSE = (
    "the river ran slowly past an old mill where nobody had worked since the winter of the great flood and "
    "children from both villages came here to catch small silver fish with nets their grandmothers had made "
    "while travellers on the road above stopped to rest their horses under tall trees and watch the water turn "
)


def prose(start: int, n: int) -> str:
    """``n`` words that no other start shares three of in a row, but for chance."""
    words = PROSE.split()
    return " ".join(words[(start * 31 + i * (7 + start % 11) + i * i // 5) % len(words)] + (f"{start}" if i % 3 == 0 else "") for i in range(n))


#: Rows that every operator must take: nulls, empty, very long, only white space, twice the same.
ODD = [
    (100, None, None, None, None),
    (101, "", "en", "s", 0),
    (102, " \t\n\x0b\x0c\r ", "en", "s", 7),
    (103, "x" * 30_000, "en", "s", 30_000),
    (None, prose(90, 60), "en", "s", 1),
    (105, prose(91, 80), "en", None, 1),
    (105, prose(91, 80), "en", None, 1),
    (106, "12 34 !!! 56", "en", "s", 12),
    (107, "Ünïcödé 日本語 \U0001f600 text\x00with\x1cbytes", "fr", "s", 1),
]
