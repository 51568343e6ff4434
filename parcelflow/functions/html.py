"""Rows and cells of stored HTML pages, cut by Spark's own string functions.

A page goes through these steps, all of them column expressions:

1. Comments and raw-text elements (script, style, textarea, title ...) are
   removed, and the rest is split at ``<``.  Each piece that begins with a tag
   gets its ends marked by control characters, so that a ``>`` inside a quoted
   attribute no longer counts, and a hidden element (``hidden``, or an inline
   ``display: none``) is marked as such.  Every piece is matched once, from its
   begin, so broken markup costs no more than sound one.
2. The selector's containers are cut out, and in them the rows; a row or cell
   also ends where HTML lets its end tag be left out (at the next ``<tr>``,
   ``<td>``, ``<li>``, ``<option>`` or the end of its container).  A table
   without ``<tbody>`` is its own body, but for its head and foot.
3. Per cell: the classes of its spans, the target of its first link, and the
   visible text.  Text is collapsed as rendered: whitespace runs become one
   space, ``<br>`` and block boundaries line breaks; entities are decoded.

Limits.  Style sheets are not evaluated.  An element taken out by its name (a
container, a hidden element) ends at the first end tag of that name, so one
inside another of its name ends early; rows of a row (lists in list items) are
rows of their own.  A ``<`` inside an attribute value ends the tag there, and a
tag whose quote never closes is text.  Only entities with their semicolon are
decoded.
"""

from __future__ import annotations

import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks: a tag begins, its name ends, it is hidden, it ends; a line break.
_TAG, _NAME, _HID, _END, _BR = "\x01", "\x02", "\x04", "\x03", "\x05"
_MARKS = _TAG + _NAME + _END + _HID + _BR

_RAW = "script|style|template|textarea|title|xmp|iframe|noembed|noframes"
_REMOVED = (rf"(?is)<!--.*?(?:-->|\z)|<({_RAW})(?=[\s/>])[^<>]*+>.*?(?:</\1(?=[\s/>])[^<>]*+>?|\z)")
_PIECE = r"""(?s)\A(/?[a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>(.*)\z"""
_NO_TAG = r"(?s)\A[!?/][^>]*+>?"
_QUOTED = r""""[^"]*+"|'[^']*+'"""
_IS_HIDDEN = r"""(?i)(?:\A|[\s/"])hidden(?=[\s=/"]|\z)"""
_NOT_SHOWN = r"""(?is)(?:\A|[\s/"'])style\s*+=\s*+(?:"[^"]*?|'[^']*?|[^\s"']*?)display\s*+:\s*+none"""
_VOID = "area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr"
_BLOCKS = ("address|article|aside|blockquote|div|dl|fieldset|footer|form|h1|h2|h3|h4|h5|h6|header|hr|main|nav|"
           "ol|p|pre|section|table|ul")
# What ends a row or cell of each tag, besides its own end tag and start tag.
_ENDS = {
    "tr": "/?tbody|/?thead|/?tfoot|/table",
    "td": "/?th|/?tr|/?tbody|/?thead|/?tfoot|/table",
    "li": "/ul|/ol|/menu",
    "option": "/?optgroup|/select|/datalist",
    "p": f"{_BLOCKS}|/div|/td|/li|/article|/section|/body",
}


def _marked(piece: Column) -> Column:
    """A piece behind a ``<``, its tag marked; or as text again."""
    name, attrs, text = (F.regexp_extract(piece, _PIECE, i) for i in (1, 2, 3))
    hidden = (attrs != "") & (F.regexp_replace(attrs, _QUOTED, '""').rlike(_IS_HIDDEN) | attrs.rlike(_NOT_SHOWN))
    tag = F.concat(F.lit(_TAG), F.lower(name), F.lit(_NAME), F.when(hidden, _HID).otherwise(""), attrs, F.lit(_END), text)
    return (F.when(name != "", tag).when(piece.rlike(r"\A[!?/]"), F.regexp_replace(piece, _NO_TAG, ""))
            .otherwise(F.concat(F.lit("<"), piece)))


def marked_page(html: Column) -> Column:
    plain = F.regexp_replace(F.translate(html, _MARKS, ""), _REMOVED, "")
    pieces = F.split(plain, "<")
    tagged = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _marked)
    return F.concat(F.get(pieces, 0), F.array_join(tagged, ""))


def _until(ends: str) -> str:
    """What follows up to a tag of these names (a group that never backtracks)."""
    return rf"((?:[^\x01]++|\x01(?!(?:{ends})\x02))*+)"


def _before(name: str) -> str:
    """Behind a tag's name: its attributes up to the value of this one."""
    other = rf"""[\s/]*+(?!(?i:{name})\s*+=)[^\s="'/\x03]++(?:\s*+=\s*+(?:"[^"\x03]*+"|'[^'\x03]*+'|[^\s"'\x03]++))?"""
    return rf"""\x02\x04?(?:{other}|["'=])*+[\s/]*+(?i:{name})\s*+=\s*+"""


_VALUES = r"""(?:"([^"\x03]*+)"|'([^'\x03]*+)'|([^\s"'\x03]++))"""


def _value(text: Column, pattern: str) -> Column:
    """The value of an attribute pattern, quoted in one way or another."""
    return F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])


def _regions(page: Column, part: str) -> Column:
    """The insides of all containers that match one part of the selector."""
    if part.startswith("#"):
        own = re.escape(part[1:])
        start = rf"""\x01([^\x02/]++){_before('id')}(?:"{own}"|'{own}'|{own}(?=[\s/\x03]))[^\x03]*+\x03"""
        return F.regexp_extract_all(page, F.lit(rf"(?s){start}(.*?)(?:\x01/\1\x02|\z)"), F.lit(2))
    inside = F.regexp_extract_all(page, F.lit(rf"(?s)\x01{part}\x02[^\x03]*+\x03(.*?)(?:\x01/{part}\x02|\z)"), F.lit(1))
    if part != "tbody":
        return inside
    no_head = F.regexp_replace(page, r"(?s)\x01(thead|tfoot)\x02.*?(?:\x01/\1\x02[^\x03]*+\x03|\z)", "")
    return F.when(F.contains(page, F.lit(f"{_TAG}tbody{_NAME}")), inside).otherwise(F.array(no_head))


def _inside(part: str):
    return lambda page: _regions(page, part)


def _rows(region: Column, tag: str) -> Column:
    """The rows of a container, each with its start tag in front."""
    ends = f"/?{tag}" + (f"|{_ENDS[tag]}" if tag in _ENDS else "")
    found = F.regexp_extract_all(region, F.lit(rf"\x01{tag}\x02[^\x03]*+\x03{_until(ends)}"), F.lit(0))
    if tag != "tr":
        return found
    bare = F.regexp_extract(region, rf"\A{_until('tr')}", 1)  # cells in front of any row are one
    return F.when(F.contains(bare, F.lit(f"{_TAG}td{_NAME}")), F.concat(F.array(bare), found)).otherwise(found)


def _cells(row: Column, tag: str | None) -> Column:
    if tag is None:
        return F.array(row)
    return F.regexp_extract_all(row, F.lit(rf"\x01{tag}\x02[^\x03]*+\x03{_until(f'/?{tag}|' + _ENDS.get(tag, '/tr'))}"), F.lit(0))


# Named entities by the standard's own table, as far as they end in a semicolon.
_ENTITIES = _TAG.join(f"{k[:-1]}{_NAME}{v}" for k, v in html5.items() if k.endswith(";"))


def _decoded(piece: Column) -> Column:
    """``name;rest`` behind an ampersand, with the entity decoded."""
    name = F.regexp_extract(piece, r"\A(#?\w{1,32});", 1)
    rest = F.substring(piece, F.length(name) + 2, F.length(piece))
    number = F.when(name.rlike(r"\A#[xX][0-9a-fA-F]{1,6}\z"), F.conv(F.substring(name, F.lit(3), F.lit(8)), 16, 10)).when(
        name.rlike(r"\A#[0-9]{1,7}\z"), F.substring(name, F.lit(2), F.lit(8))).try_cast("int")
    number = F.when((number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF), number)
    table = F.str_to_map(F.lit(_ENTITIES), F.lit(_TAG), F.lit(_NAME))  # folded to a constant
    char = F.coalesce(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"), F.try_element_at(table, name))
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def unescape(text: Column) -> Column:
    """Text with its entities decoded."""
    pieces = F.split(text, r"&(?=#?\w{1,32};)")
    decoded = F.concat(F.get(pieces, 0), F.array_join(
        F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _decoded), ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def _visible(cell: Column) -> Column:
    shown = F.regexp_replace(
        cell, rf"(?s)\x01(?!(?:{_VOID})\x02)([^\x02/]++)\x02\x04[^\x03]*+\x03.*?(?:\x01/\1\x02[^\x03]*+\x03|\z)", "")
    text = F.regexp_replace(shown, rf"\x01(?:br|/?(?:{_BLOCKS}))\x02(?!\x04)[^\x03]*+\x03", _BR)
    text = F.regexp_replace(text, r"\x01[^\x03]*+\x03", "")
    text = F.regexp_replace(text, r"[ \t\n\r\f]++", " ")
    text = F.regexp_replace(text, r" ?\x05[ \x05]*+", _BR)
    text = unescape(F.translate(F.btrim(text, F.lit(_BR)), _BR, "\n"))
    return F.when(cell.rlike(r"\A\x01[^\x02]*+\x02\x04"), "").otherwise(text)


def _spans(cell: Column) -> Column:
    attrs = F.regexp_extract_all(cell, F.lit(r"\x01span(\x02\x04?[^\x03]*+)\x03"), F.lit(1))
    return F.transform(attrs, lambda a: _value(a, _before("class") + _VALUES))


def _href(cell: Column) -> Column:
    link = rf"\x01a{_before('href')}{_VALUES}"
    return F.when(cell.rlike(link), unescape(_value(cell, link)))


def html_rows(html: Column | str, selector: str, cell_tag: str | None = "td") -> Column:
    """``array<struct<pos, cells, spans, hrefs>>`` of the rows that match
    ``selector``: parts ``tag`` or ``#id``, the last of them the row.  Cells are
    the ``cell_tag`` elements of a row, or the row itself where that is None.  A
    null page gives null."""
    *containers, row = selector.split()
    if not all(re.fullmatch(r"#?[\w-]+", p) for p in (*containers, row)):
        raise ValueError(f"unsupported selector: {selector!r}")
    page = marked_page(F.col(html) if isinstance(html, str) else html)
    regions = F.array(page)
    for part in containers:
        regions = F.flatten(F.transform(regions, _inside(part)))
    cut = (lambda r: _regions(r, row)) if row.startswith("#") else (lambda r: _rows(r, row))
    rows = F.flatten(F.transform(regions, cut))

    def built(r, pos):
        cells = _cells(r, cell_tag)
        return F.struct(pos.alias("pos"), F.transform(cells, _visible).alias("cells"),
                        F.transform(cells, _spans).alias("spans"), F.transform(cells, _href).alias("hrefs"))

    return F.transform(rows, built)
