"""Column functions (JVM-side expressions) and the HTML row reader."""

from parcelflow.functions.text import (  # noqa: F401
    city_squeeze, clean_cell, full_width, half_width, page_count, parking_mark,
    remove_whitespace, result_total, roc_split, stage_suffix, strip, type_map,
)
