"""Page and record field extraction (S8-S14, S17) as Column expressions.

The reference reads these values from a live page; here they are parsed from
stored page HTML or stored label strings, so the whole record assembly is one
projection per row. Integer parsing is strict (digits only, like Python's
``int()``); anything else is null for that field only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_TAGS = "No tags found"
DATE_PATTERN = r"([0-9]{1,2}\s[A-Za-z0-9_]+\s[0-9]{4}|[A-Za-z0-9_]+\s[0-9]{1,2},\s[0-9]{4})"


def _blank_null(c: Column) -> Column:
    return F.when(c != "", c)


def strict_long(s: Column) -> Column:
    """``int(s)`` for plain digit strings, null otherwise."""
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("long"))


#: The named entities of markup and the no-break space; &amp; last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0"}


def element_text(inner: Column) -> Column:
    """The rendered text of an element's inner markup: tags dropped, numeric and
    named entities decoded, trimmed."""
    text = F.regexp_replace(inner, r"<[^>]*>", "")
    for base, entity in ((10, "&#[0-9]{1,7};"), (16, "&#[xX][0-9A-Fa-f]{1,6};")):
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(entity), 0))

        def decoded(s: Column, e: Column, base: int = base) -> Column:
            digits = F.conv(F.regexp_replace(e, "[&#xX;]", ""), base, 16)
            point = F.conv(digits, 16, 10).cast("int")
            known = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
            return F.when(known, F.replace(s, e, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))).otherwise(s)

        text = F.aggregate(found, text, lambda s, e: decoded(s, e))
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.regexp_replace(F.replace(text, F.lit("&amp;"), F.lit("&")), r"^[ \t\r\n\u00a0]+|[ \t\r\n\u00a0]+$", "")


def page_title(html: Column) -> Column:
    """Text of the first ``<title>`` element, null when absent."""
    return _blank_null(element_text(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title>", 1)))


def page_lang(html: Column) -> Column:
    return _blank_null(F.regexp_extract(html, r"<html[^>]*\slang=\"([^\"]*)\"", 1))


def page_tags(html: Column) -> Column:
    """Anchor texts of the navigation block, all leading '#' removed;
    ``["No tags found"]`` when there is none."""
    nav = F.regexp_extract(html, r"(?is)<nav(?:\s[^>]*)?>(.*?)</nav>", 1)
    anchors = F.regexp_extract_all(nav, F.lit(r"(?is)<a(?:\s[^>]*)?>(.*?)</a>"), 1)
    tags = F.transform(anchors, lambda t: F.regexp_replace(element_text(t), r"^#+", ""))
    return F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit(NO_TAGS)))


def count_digits(text: Column) -> Column:
    """Every non-digit dropped, then int."""
    return strict_long(F.regexp_replace(text, r"[^0-9]", ""))


def views_from_info(info: Column) -> Column:
    """``([\\d,.]+)\\sviews``, commas dropped, strict int."""
    return strict_long(F.translate(F.regexp_extract(info, r"([0-9,.]+)\sviews", 1), ",", ""))


def upload_date(info: Column) -> Column:
    """First 'd Mon yyyy' or 'Mon d, yyyy' in the text (kept as text)."""
    return _blank_null(F.regexp_extract(info, DATE_PATTERN, 1))


def upload_dt(date_text: Column) -> Column:
    return F.coalesce(F.try_to_date(date_text, "d MMM yyyy"), F.try_to_date(date_text, "MMM d, yyyy"))


def likes_from_label(label: Column) -> Column:
    """First run of digits/commas/dots, commas dropped, strict int."""
    return strict_long(F.translate(F.regexp_extract(label, r"([0-9,.]+)", 1), ",", ""))


def subscriber_count(text: Column) -> Column:
    """S14: 'subscribers' removed; K = x1 000, M = x1 000 000, else int.

    Deviation from the reference: the multiplication is exact decimal
    (65.1K -> 65100, not 65099)."""
    s = F.trim(F.regexp_replace(F.trim(text), "subscribers", ""))

    def scaled(letter: str, factor: int) -> Column:
        num = F.regexp_replace(s, letter, "").try_cast("decimal(20,4)")
        return (num * F.lit(factor)).cast("long")

    return (
        F.when(s.contains("K"), scaled("K", 1000))
        .when(s.contains("M"), scaled("M", 1_000_000))
        .otherwise(strict_long(F.regexp_replace(s, ",", "")))
    )
