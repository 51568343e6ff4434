"""Column functions for listing and statistics text.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
none calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
EMPTY_MARK = "無"          # written for a missing / empty cell
PARKING_MARK = "車"        # appended to the total price when the parking icon shows
# Icon code (class text before "_") -> building type.
TYPE_ICONS = {"bt01": "寓", "bt02": "透", "bt05": "樓", "bt06": "華",
              "bt09": "廠", "bt03": "店", "bt07": "套"}
PARKING_ICON_CLASS = "btP_br"
RESULT_TOTAL_PATTERN = r"查詢結果\s*[:：]\s*([\d,]+)\s*筆"
LISTING_PAGE_SIZE = 15
ROC_OFFSET = 1911          # AD year = ROC year + 1911
# -----------------------------------------------------------------------------

# Full-width forms U+FF01..U+FF5E sit 0xFEE0 above ASCII 0x21..0x7E; the
# ideographic space U+3000 maps to a plain space.  Built from that rule.
_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "

# Python's str.strip() removes every code point with str.isspace(); the set
# is built from that rule (a few dozen characters) and trimmed with btrim.
_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_width(col) -> Column:
    """Full-width ASCII forms and the ideographic space to their half-width
    counterparts; every other character is kept."""
    return F.translate(_c(col), _FULL, _HALF)


def full_width(col) -> Column:
    """Inverse of :func:`half_width` on printable ASCII (used to build fixtures)."""
    return F.translate(_c(col), _HALF, _FULL)


def strip(col) -> Column:
    """Leading/trailing whitespace removed exactly like Python ``str.strip()``."""
    return F.btrim(_c(col), F.lit(_WHITESPACE))


def remove_whitespace(col) -> Column:
    """Delete every whitespace character (Python's ``\\s`` on text)."""
    return F.translate(_c(col), _WHITESPACE, "")


def clean_cell(col) -> Column:
    """Strip; an empty result becomes the empty mark.  NULL (a missing cell)
    stays NULL so that reject rules can see it."""
    s = strip(col)
    return F.when(F.length(s) == 0, F.lit(EMPTY_MARK)).otherwise(s)


def parking_mark(price, has_parking) -> Column:
    p = _c(price)
    return F.when(_c(has_parking), F.concat(p, F.lit(PARKING_MARK))).otherwise(p)


def _type_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in TYPE_ICONS.items() for x in kv])


def icon_key(icon_class) -> Column:
    """First class token, then the part before '_' (``"bt06_br x"`` -> ``bt06``)."""
    first = F.regexp_extract(_c(icon_class), r"^\s*(\S+)", 1)
    return F.substring_index(first, "_", 1)


def type_map(icon_class, text) -> Column:
    """Building type from the icon class; unknown icon keeps the cell text (or
    the empty mark when it has none); a cell without an icon keeps its text."""
    t = _c(text)
    known = F.try_element_at(_type_map(), icon_key(icon_class))
    fallback = F.when(F.coalesce(F.length(t), F.lit(0)) > 0, t).otherwise(F.lit(EMPTY_MARK))
    return F.when(_c(icon_class).isNull(), t).otherwise(F.coalesce(known, fallback))


def result_total(text) -> Column:
    """Record total from a result line like ``查詢結果：1,234 筆``; NULL when the
    line has no total.  Digits may be full-width (Python's ``\\d`` matches them)."""
    digits = F.regexp_extract(_c(text), "(?U)" + RESULT_TOTAL_PATTERN, 1)
    plain = F.regexp_replace(half_width(digits), ",", "")
    return F.when(F.length(plain) > 0, plain.try_cast("int"))


def page_count(total, page_size: int = LISTING_PAGE_SIZE) -> Column:
    """ceil(total / page_size); exact, as IEEE division of two integers that
    divide evenly is exact."""
    return F.ceil(_c(total).cast("long") / F.lit(page_size)).cast("long")


def city_squeeze(col) -> Column:
    """Strip, then delete every ASCII space (city names in statistics pages)."""
    return F.replace(strip(col), F.lit(" "), F.lit(""))


def roc_split(ym) -> Column:
    """``yyyMM`` ROC year-month text -> struct(roc_year, roc_month, ad_year,
    ad_month); fields are NULL where the text is not a number."""
    s = _c(ym)
    y = F.substring(s, 1, 3).try_cast("int")
    m = F.substr(s, F.lit(4)).try_cast("int")
    return F.struct(y.alias("roc_year"), m.alias("roc_month"),
                    (y + F.lit(ROC_OFFSET)).alias("ad_year"), m.alias("ad_month"))


def stage_suffix(date_col) -> Column:
    """``yyyyMMdd`` text of a run date (the dated stage / check-list name)."""
    return F.date_format(_c(date_col), "yyyyMMdd")
