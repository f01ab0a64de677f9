"""Deterministic text variants mixed into the test tables by the driver queries.

The generated test tables hold no replies, URLs, emoji, special spaces,
brackets or slang contractions, so the cleaning queries wrap each input text
in one of these fixed (prefix, suffix) pairs, chosen by ``(id) % len(...)``. A pair
without a suffix replaces the text, which makes copies inside a video (user
turns are two apart).
Spark and the DuckDB oracle build exactly the same strings from this list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = " "

# comments: chosen by (conv_id + turn) % their number
COMMENT_VARIANTS = [
    ("", ""),
    ("@", ""),
    ("", " see https://example.com/p?q=1 and www.example.org/x"),
    ("u r gr8" + NBSP, " lol"),
    ("\U0001F525 ", " \U0001F389\U0001F1EE\U0001F1F3 ikr \U0001F602"),
    ("ain't no cap\r\n", "\ttho "),
    ("   ", " ... 0:10 !! l.o.l"),
    ("\U0001F44D\U0001F3FD ", " \U0001F1EF\U0001F1F5\u2B50 1\uFE0F\u20E3 11 \u2713"),
    ("\u2764\uFE0F\u200D\U0001F525", " \u2764\uFE0F \U0001F601\U0001F4AF \U0001F468\u200D\U0001F469\u200D\U0001F467"),
    ("", " \U0001F3C6\U0001F3C6\U0001F389\u23F0\U0001F7E2 \U0001F64C\U0001F3FF\u200D\U0001F525"),
    ("So  true ", None),
    ("", ""),
    ("so true!", None),
]

# transcripts: chosen by doc_id % 5
TRANSCRIPT_VARIANTS = [
    ("", ""),
    ("[Music] ", " [Applause]"),
    ("", "\r\n[00:12] end [unclosed"),
    (NBSP, " & $2.5 million - ok?"),
    ("Intro:\t", " [a\nb]"),
]

# slang: chosen by doc_id % 4
SLANG_VARIANTS = [
    ("", ""),
    ("ain't ", " ain't ain't"),
    ("u r ", " no cap, tho"),
    ("", " éu l.o.l ily2"),
]


def wrap(text: Column, selector: Column, variants: list[tuple[str, str | None]]) -> Column:
    out = None
    for i, (pre, suf) in enumerate(variants):
        v = F.lit(pre) if suf is None else F.concat(F.lit(pre), text, F.lit(suf))
        out = F.when(selector == i, v) if out is None else out.when(selector == i, v)
    return out


def sql_lit(s: str) -> str:
    """SQL string expression; control characters and NBSP via chr()."""
    if s == "":
        return "''"
    parts, buf = [], ""
    for ch in s:
        if ch in "\r\n\t" or ch == NBSP:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def wrap_sql(text: str, selector: str, variants: list[tuple[str, str | None]]) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {sql_lit(pre)}" + ("" if suf is None else f" || {text} || {sql_lit(suf)}") for i, (pre, suf) in enumerate(variants)
    )
    return f"(CASE ({selector}) {whens} END)"
