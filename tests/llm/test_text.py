"""Column helpers of the text operators."""

from pyspark.sql import functions as F

from reliq.llm.text import LOWER, UPPER, ascii_lower


def test_ascii_lower_takes_plain_texts_in_bytes(spark):
    texts = ["", "AbZ[@`{09\x00\t", "ÄÖ Aİ", "K of Kelvin ß", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(ascii_lower(F.col("text")).alias("low"), "text")
    table = str.maketrans(UPPER, LOWER)
    assert [tuple(r) for r in df.collect()] == [(t if t is None else t.translate(table), t) for t in texts]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(text" in plan and "translate(text" in plan
