"""Page coverage of a crawl: the planned page ranges against the loaded pages.

A key's pages are planned in batches of one size (``plan.page_batches``), so the
batch of a loaded page follows from its number.  Loaded pages are gathered per
(key, batch), at most one batch of numbers each: a district with a third of all
pages is spread over its batches, and nothing is sorted per district.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = ("begin_page_num", "end_page_num")


def page_gaps(plan: DataFrame, loaded: DataFrame, keys: list[str], page_col: str = "page") -> DataFrame:
    """Planned ranges (keys, batch_id, begin_page_num, end_page_num) and loaded
    pages (keys, page; repeats allowed) -> one row per maximal range of planned
    pages of a batch that was not loaded: keys, batch_id, gap_begin, gap_end,
    n_pages.  Pages outside the plan and null pages are ignored; keys are
    matched null-safe."""
    begin, end = RANGE
    null_safe = [F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(f"_{k}") for k in keys]
    own = [f"_{k}" for k in keys]
    planned = plan.select(*keys, *null_safe, "batch_id", F.col(begin).cast("long"), F.col(end).cast("long"))
    # The first range has the full size; a last, shorter one begins where a full one would.
    sizes = planned.groupBy(*own).agg(F.max(F.col(end) - F.col(begin) + 1).alias("_size"))
    page = F.col(page_col).cast("long")
    got = (loaded.select(*null_safe, page.alias("_page")).where("_page >= 1").distinct()
           .join(sizes, own)
           .select(*own, "_page", (F.floor((F.col("_page") - 1) / F.col("_size")) * F.col("_size") + 1).alias(begin))
           .groupBy(*own, begin).agg(F.sort_array(F.collect_list("_page")).alias("_pages")))
    # Between two neighbouring loaded pages (or the ends of the range) lies a gap or nothing.
    inside = F.filter(F.coalesce("_pages", F.array().cast("array<bigint>")), lambda p: p <= F.col(end))
    edges = F.concat(F.array(F.col(begin) - 1), inside, F.array(F.col(end) + 1))
    gaps = F.filter(F.zip_with(edges, F.slice(edges, 2, F.size(edges)), lambda a, b: F.struct(
        (a + 1).alias("lo"), (b - 1).alias("hi"))), lambda g: g["lo"] <= g["hi"])
    return (planned.join(got, [*own, begin], "left")
            .select(*keys, "batch_id", F.explode(gaps).alias("g"))
            .select(*keys, "batch_id", F.col("g.lo").alias("gap_begin"), F.col("g.hi").alias("gap_end"),
                    (F.col("g.hi") - F.col("g.lo") + 1).alias("n_pages")))
