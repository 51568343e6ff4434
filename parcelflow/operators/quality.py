"""Row-level rejects and primary-key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.schemas import MAX_LEN


def length_rules(columns, max_len: dict[str, int] = MAX_LEN) -> dict[str, Column]:
    """TOO_LONG:<col> for every column with a declared maximum length."""
    return {f"TOO_LONG:{c}": F.length(F.col(c)) > F.lit(n)
            for c, n in max_len.items() if c in columns}


def null_rules(cols: list[str]) -> dict[str, Column]:
    return {f"NULL:{c}": F.col(c).isNull() for c in cols}


def with_reject_reason(df: DataFrame, rules: dict[str, Column],
                       col: str = "reject_reason") -> DataFrame:
    """Add the first failing rule's name (NULL when the row is good).  One
    pass; the good and rejected rows are two filters of the same plan."""
    expr = None
    for name, cond in rules.items():
        c = F.coalesce(cond, F.lit(False))
        expr = F.when(c, F.lit(name)) if expr is None else expr.when(c, F.lit(name))
    return df.withColumn(col, expr if expr is not None else F.lit(None).cast("string"))


def split_rejects(df: DataFrame, rules: dict[str, Column], source: str,
                  key_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, reject rows in the rejects layout)."""
    tagged = with_reject_reason(df, rules)
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    data_cols = [c for c in df.columns]
    bad = tagged.where(F.col("reject_reason").isNotNull()).select(
        F.lit(source).alias("source"),
        F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key_cols]).alias("key"),
        F.col("reject_reason").alias("reason"),
        F.to_json(F.struct(*data_cols)).alias("row_json"))
    return good, bad


def pk_violations(df: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def keep_first_by_key(df: DataFrame, pk: list[str], order_col: str) -> tuple[DataFrame, DataFrame]:
    """(first row per key in ``order_col`` order, the other rows).
    ``order_col`` must be unique per key (a load position).

    The first position per key is a ``min`` aggregation, which combines on
    the map side, so a key with millions of copies costs one row per map task
    -- no per-key window buffers the copies in one task.  Rows are then
    matched on (key, position), which is unique, so even the hottest key
    spreads evenly over the join; the duplicates are the rows not matched.
    """
    first = df.groupBy(*pk).agg(F.min(order_col).alias(order_col))
    kept = df.join(first, [*pk, order_col], "left_semi")
    dups = df.join(first, [*pk, order_col], "left_anti")
    return kept, dups
