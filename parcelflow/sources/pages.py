"""Listing, migration and option rows from stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.html import html_rows
from parcelflow.functions.text import (
    PARKING_ICON_CLASS, clean_cell, half_width, parking_mark, remove_whitespace, strip, type_map,
)
from parcelflow.schemas import BUSINESS, CELL_INDEX

# --- fixed values ------------------------------------------------------------
LISTING_ROWS = "#table-item-tbody tr"
MIGRATION_ROWS = "#datatable tbody tr"
RESULT_INFO = "#price_table_info"
CITY_OPTIONS = "#p_city option"
DISTRICT_OPTIONS = "#p_town option"
OPTION_HEADERS = ["縣市", "請選擇"]
PRICE_CELL, TYPE_CELL, TARGET_CELL = 2, 7, 11
MIN_LISTING_CELLS = 19
# -----------------------------------------------------------------------------


def explode_rows(df: DataFrame, html_col: str, selector: str,
                 cell_tag: str | None = "td", keep: list[str] | None = None) -> DataFrame:
    """One output row per matched HTML row: ``keep`` columns + pos, cells,
    spans, hrefs.  The HTML column is dropped right after it is cut."""
    keep = keep if keep is not None else [c for c in df.columns if c != html_col]
    return (df.select(*keep, F.explode(html_rows(html_col, selector, cell_tag)).alias("_r"))
              .select(*keep, "_r.pos", "_r.cells", "_r.spans", "_r.hrefs"))


def _has_class(spans: Column, cls: str) -> Column:
    return F.exists(F.coalesce(spans, F.array().cast("array<string>")),
                    lambda c: F.array_contains(F.split(F.trim(c), r"\s+"), F.lit(cls)))


def _icon_class(spans: Column) -> Column:
    icons = F.filter(F.coalesce(spans, F.array().cast("array<string>")),
                     lambda c: c.endswith("_br"))
    return F.try_element_at(icons, F.lit(1))


def listing_columns(rows: DataFrame) -> DataFrame:
    """Positional cells of listing rows (output of :func:`explode_rows`) ->
    the 17 named columns, cleaned: half width, strip, parking mark on the
    price, building type from the icon, whitespace-free transaction target,
    empty mark for empty cells.  Each column is a plain expression on one
    cell (codegen-friendly); only the icon lookups look into the short
    span-class lists."""
    def cell(i):
        return strip(half_width(strip(F.get(F.col("cells"), i))))

    price = parking_mark(cell(PRICE_CELL),
                         _has_class(F.get("spans", PRICE_CELL), PARKING_ICON_CLASS))
    kind = type_map(_icon_class(F.get("spans", TYPE_CELL)), cell(TYPE_CELL))
    target = remove_whitespace(half_width(F.get(F.col("cells"), TARGET_CELL)))
    special = {PRICE_CELL: price, TYPE_CELL: kind, TARGET_CELL: target}
    keep = [c for c in rows.columns if c not in ("cells", "spans", "hrefs")]
    cols = [clean_cell(special.get(i, cell(i))).alias(name) for name, i in CELL_INDEX.items()]
    return rows.select(*keep, F.size("cells").alias("n_cells"), *cols)


def cells_to_columns(df: DataFrame, mapping: dict[str, int] = CELL_INDEX,
                     cells_col: str = "cells", clean: bool = True) -> DataFrame:
    """Positional cells -> named columns.  ``get`` gives NULL past the end of
    the array (short rows are then caught by the reject rules)."""
    others = [c for c in df.columns if c != cells_col]
    cols = []
    for name, i in mapping.items():
        v = F.get(F.col(cells_col), i)
        cols.append((clean_cell(v) if clean else v).alias(name))
    return df.select(*others, F.size(cells_col).alias("n_cells"), *cols)


def with_min_cells(df: DataFrame, n: int, cells_col: str = "cells") -> DataFrame:
    """Rows with at least ``n`` cells (data rows of a statistics table)."""
    return df.where(F.size(cells_col) >= n)


def listing_rows(pages: DataFrame) -> DataFrame:
    """Stored listing pages (page_id, city_name, district_name, batch_id, page,
    html) -> one row per listing with the 17 business columns, ``pos`` (row in
    page) and ``n_cells`` (for the short-row rule)."""
    keep = [c for c in ("page_id", "city_name", "district_name", "batch_id", "page")
            if c in pages.columns]
    rows = explode_rows(pages, "html", LISTING_ROWS, "td", keep)
    return listing_columns(rows).select(*keep, "pos", "n_cells", *BUSINESS)


def migration_cells(pages: DataFrame) -> DataFrame:
    """Stored migration pages (metric, roc_year, roc_month, html) -> one row of
    cell texts per data-table body row."""
    keep = [c for c in pages.columns if c != "html"]
    return explode_rows(pages, "html", MIGRATION_ROWS, "td", keep).drop("spans", "hrefs")


def option_labels(pages: DataFrame, selector: str, html_col: str = "html") -> DataFrame:
    """Option (or list item) labels in page order: keep columns + pos, label, href."""
    keep = [c for c in pages.columns if c != html_col]
    return (explode_rows(pages, html_col, selector, None, keep)
            .select(*keep, "pos", strip(F.get("cells", 0)).alias("label"),
                    F.get("hrefs", 0).alias("href")))


def district_options(city_page: DataFrame, town_pages: DataFrame) -> DataFrame:
    """All (city, district) work items with ids 1..n in dropdown order.

    ``city_page`` (html) holds the city dropdown; ``town_pages`` (city, html)
    hold each city's district dropdown.  Header entries are dropped.  The
    option lists are short (a country's districts), so the numbering window
    over them is bounded."""
    from parcelflow.operators.checklist import number_options

    cities = (option_labels(city_page.select("html"), CITY_OPTIONS)
              .where(~F.col("label").isin(OPTION_HEADERS))
              .select(F.col("pos").alias("city_pos"), F.col("label").alias("city_name")))
    towns = (option_labels(town_pages.select(F.col("city").alias("city_name"), "html"),
                           DISTRICT_OPTIONS)
             .where(~F.col("label").isin(OPTION_HEADERS))
             .select("city_name", F.col("pos").alias("district_pos"),
                     F.col("label").alias("district_name")))
    both = cities.join(towns, "city_name")
    return number_options(both, ["city_pos", "district_pos"]).select(
        "record_id", "city_name", "district_name")


def result_lines(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The result line (``#price_table_info``, e.g. ``查詢結果：1,234 筆``) of
    each stored search page: keep columns + text (NULL when the page has
    none).  Feeds :func:`parcelflow.operators.plan.crawl_batches` and the
    empty-district rule of the listing load."""
    keep = [c for c in pages.columns if c != html_col]
    first = F.get(html_rows(html_col, RESULT_INFO, None), 0)
    return pages.select(*keep, strip(F.get(first.cells, 0)).alias("text"))
