"""Column -> Column text cleaners (comments and transcripts).

Every function here returns a Spark ``Column`` built from JVM-side built-ins
(``regexp_replace``, ``regexp_extract_all``, ``transform``, map lookups), so
the whole cleaning chain is one projection inside whole-stage codegen; no
Python runs per row.

Regex notes (Java regex, as used by Spark):
* whitespace is spelled out as ``WS`` (the same set Python's Unicode ``\\s``
  matches); Java's ``\\s`` misses NBSP and friends.
* word characters are ``[\\p{L}\\p{N}_]``; ``\\b`` and ``\\w`` differ across
  engines and JDK versions and are never used.
* ``(?d)`` makes ``.`` stop only at ``\\n``.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from reverbkit.constants import SLANG
from reverbkit.functions.emoji import SELECTORS, TONES, emoji_table_json, part_pattern, start_pattern, token_pattern, tone_names

WS = r"[\s\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


@functools.lru_cache(maxsize=1)
def _single_word_slang_json() -> str:
    # Multi-word keys never match after single-word keys ran ("no cap" is
    # shadowed by "cap"), and "ain't" is handled by a guarded replace.
    return json.dumps({k: v for k, v in SLANG.items() if k.replace("_", "").isalnum()})


def slang_map_column() -> Column:
    """The slang dictionary as a constant map (folded at plan time)."""
    return F.from_json(F.lit(_single_word_slang_json()), "map<string,string>")


def emoji_map_column() -> Column:
    return F.from_json(F.lit(emoji_table_json()), "map<string,string>")


def collapse_ws(col: Column | str, trim: bool = True) -> Column:
    """runs of whitespace -> one space (optionally trimmed)."""
    out = F.regexp_replace(_c(col), WS + "+", " ")
    return F.trim(out) if trim else out


def newlines_to_space(col: Column | str) -> Column:
    """F1."""
    return F.regexp_replace(_c(col), r"\r\n|\n", " ")


def remove_urls(col: Column | str) -> Column:
    """``http\\S+`` and ``www.\\S+``."""
    not_ws = r"[^\s\x1c-\x1f\x85\p{Z}]"
    return F.regexp_replace(_c(col), f"http{not_ws}+|www\\.{not_ws}+", "")


def _emoji_name(cluster: Column) -> Column:
    """``:name:`` of one emoji cluster, its skin tones' names appended; null
    where the table has none."""
    names = F.create_map(*[F.lit(x) for pair in tone_names().items() for x in pair])
    tones = F.array_join(F.transform(F.regexp_extract_all(cluster, F.lit(f"[{TONES}]"), 0), lambda t: F.concat(F.lit("_"), names[t])), "")
    base = F.regexp_replace(cluster, f"[{SELECTORS}{TONES}]", "")
    name = F.when(base == "", F.substr(tones, F.lit(2))).otherwise(F.concat(F.try_element_at(emoji_map_column(), base), tones))
    return F.when(name != "", F.concat(F.lit(":"), name, F.lit(":")))


def demojize(col: Column | str) -> Column:
    """emoji -> ``:name:``. A cluster without a name is named part by part;
    a part without one (a symbol that is no emoji) stays."""
    toks = F.regexp_extract_all(_c(col), F.lit(token_pattern()), 0)

    def parts(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(part_pattern()), 0)
        return F.array_join(F.transform(found, lambda p: F.coalesce(_emoji_name(p), p)), "")

    # map literals are searched linearly: look up only tokens that may hold
    # an emoji (the other tokens are plain-text runs)
    named = F.transform(
        toks, lambda t: F.when(t.rlike(start_pattern()), F.coalesce(_emoji_name(t), parts(t))).otherwise(t))
    return F.array_join(named, "")


def expand_slang(col: Column | str) -> Column:
    """every slang key as a whole word, in one pass.

    ``ain't`` is replaced first with neighbour guards (run twice so adjacent
    occurrences both match), then the text is split into word / non-word
    tokens and each word token is looked up in the constant map.
    """
    guarded = f"(^|{NOT_WORD})ain't({NOT_WORD}|$)"
    x = F.regexp_replace(_c(col), guarded, "$1is not$2")
    x = F.regexp_replace(x, guarded, "$1is not$2")
    smap = slang_map_column()
    keys = list(json.loads(_single_word_slang_json()))
    toks = F.regexp_extract_all(x, F.lit(TOKEN_PATTERN), 0)
    # map literals are searched linearly; the IN list becomes a hash set
    # (InSet), so only actual slang tokens reach the map
    return F.array_join(
        F.transform(toks, lambda t: F.when(t.isin(keys), F.coalesce(F.try_element_at(smap, t), t)).otherwise(t)),
        "",
    )


def clean_comment(col: Column | str) -> Column:
    """P1 -> F1 -> F2 -> P2 -> F3 -> F4 -> F5 -> F6 -> F7 -> F2 -> P1.

    Returns null for empty input, replies (leading ``@``) and comments that
    clean down to nothing. For DataFrames prefer ``with_clean_comment``,
    which projects each step once.
    """
    raw = _c(col)
    x = collapse_ws(raw)  # F1 + F2: newlines are whitespace, one pass does both
    y = _comment_body(x)
    return F.when(raw.isNull() | (raw == "") | x.startswith("@"), F.lit(None).cast("string")).otherwise(
        F.nullif(y, F.lit(""))
    )


def _comment_body(x: Column) -> Column:
    y = remove_urls(x)
    y = F.lower(demojize(y))
    y = expand_slang(y)
    y = F.regexp_replace(y, r"[^a-zA-Z0-9\s\x1c-\x1f\x85\p{Z}:]", "")
    return collapse_ws(y)


def with_clean_comment(df, raw_col: str, out_col: str = "comment"):
    """F10 as staged projections: the collapsed text and the cleaned body
    are each projected once (both are referenced twice, so Catalyst keeps
    them as separate projections instead of re-running the regex chain)."""
    raw = F.col(raw_col)
    staged = df.withColumn("_cx", collapse_ws(raw)).withColumn(  # F1 + F2 in one pass
        "_cy", _comment_body(F.col("_cx"))
    )
    out = F.when(raw.isNull() | (raw == "") | F.col("_cx").startswith("@"), F.lit(None).cast("string")).otherwise(
        F.when(F.col("_cy") != "", F.col("_cy"))
    )
    return staged.withColumn(out_col, out).drop("_cx", "_cy")


def valid_comments(df, raw_col: str, out_col: str = "comment"):
    """``with_clean_comment`` without the rows whose comment is null. They go by an
    ``explode``: Spark would push a filter below the projections and clean each
    text again for it."""
    cleaned = with_clean_comment(df, raw_col, out_col)
    return cleaned.withColumn(out_col, F.explode(F.array_compact(F.array(out_col))))


def clean_transcript(col: Column | str) -> Column:
    """brackets -> newlines -> whitespace -> keep-set -> trim; null -> ''."""
    raw = _c(col)
    x = F.regexp_replace(raw, r"(?d)\[.*?\]", "")
    # F1 + F2 in one pass: "\r\n" and "\n" are whitespace, so collapsing
    # whitespace runs to one space gives what newline -> space, then collapse gives
    x = collapse_ws(x, trim=False)
    x = F.regexp_replace(x, r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}.,!?-]", "")
    x = F.trim(x)
    return F.coalesce(x, F.lit(""))


def words(col: Column | str) -> Column:
    """Whitespace split with empty strings dropped (Python ``str.split()``)."""
    return F.filter(F.split(_c(col), WS + "+"), lambda w: w != "")
