"""Broadcast behind a bound of rows and of bytes."""

from pyspark.sql import functions as F

from parcelflow.operators.joins import bounded_broadcast


def hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_bounds_of_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.lit(None).cast("string").alias("none"))
    assert hinted(bounded_broadcast(df)) and hinted(bounded_broadcast(df, 100, 110_000))
    assert not hinted(bounded_broadcast(df, 99)) and not hinted(bounded_broadcast(df, 100, 100_000))
    nested = spark.range(10).select(F.array_repeat(F.struct("id"), 1000).alias("a b"))
    assert hinted(bounded_broadcast(nested)) and not hinted(bounded_broadcast(nested, 10, 50_000))
    assert hinted(bounded_broadcast(df.where("false"), 0, 0))
