"""Fill-in-middle transformation with counted-quantifier regexes.

A text is a row of n units (default: code points). ``regexp_count`` gives n; a
keyed hash of the id draws two cuts a <= b and the form; one match of the row's
own pattern, with the possessive groups ``unit{a}+`` and ``unit{b-a}+``, captures
prefix, middle and suffix, and the replacement puts them in the form's order:

    plain   the text as it is
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Possessive counted quantifiers run in a loop without backtracking, so neither
stack nor time depends on more than the text's length. Units are counted in
blocks of ``BLOCK`` and then in the rest, as ``regexp_count`` makes a string of
every match. Built-in functions only: one narrow projection, no shuffle.

Defined results: a null text is an empty one; empty texts, and texts that hold a
sentinel, are plain. A text that is not valid UTF-8 is taken as
``make_valid_utf8`` repairs it. A null id hashes like an empty string; rows that
share an id share its draws, each on its own text. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import texts

SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
BLOCK = 1024


def count_units(text: Column, unit: str = ".") -> Column:
    """Number of ``unit`` matches that tile ``text`` from its start."""
    blocks = F.regexp_count(text, F.lit(f"(?s){unit}{{{BLOCK}}}+"))
    rest = F.regexp_extract(text, f"(?s)\\A(?:{unit}{{{BLOCK}}}+)*+(.*)\\z", 1)
    return blocks.cast("long") * BLOCK + F.regexp_count(rest, F.lit(f"(?s){unit}"))


def _draws(id_col: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of sha256(seed:id), as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _literal(sentinel: str) -> str:
    """A sentinel inside a replacement string."""
    return re.sub(r"([\\$])", r"\\\1", sentinel)


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
    sentinels: tuple[str, str, str] = SENTINELS,
    unit: str = ".",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of
    ``docs``; the two lengths count units and are null for plain rows.
    ``unit`` is one regex atom that matches a character or more."""
    p, s, m = map(_literal, sentinels)
    rows = texts(docs, id_col, text_col).select("doc_id", F.make_valid_utf8("text").alias("text"))
    counted = rows.select("doc_id", "text", count_units(F.col("text"), unit).alias("n"), F.array(*_draws(F.col("doc_id"), seed)).alias("h"))
    h = [F.col("h")[k] for k in range(4)]
    marked = F.lit(False)
    for x in sentinels:
        marked = marked | F.contains("text", F.lit(x))
    cut = [h[k] % (F.col("n") + 1) for k in range(2)]
    drawn = counted.select(
        "doc_id",
        "text",
        "n",
        F.when((F.col("n") == 0) | marked | (h[2] % 100 >= 100 - plain_percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(*cut).alias("a"),
        F.greatest(*cut).alias("b"),
    )
    plain = F.col("form") == "plain"
    size = [F.col("a"), F.col("b") - F.col("a")]
    pattern = F.format_string(f"(?s)\\A({unit.replace('%', '%%')}{{%d}}+)({unit.replace('%', '%%')}{{%d}}+)(.*)\\z", *size)
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    return drawn.select(
        "doc_id",
        "n",
        "form",
        F.when(~plain, size[0]).alias("prefix_chars"),
        F.when(~plain, size[1]).alias("middle_chars"),
        F.when(plain, F.col("text")).otherwise(F.regexp_replace("text", pattern, order)).alias("output"),
    )


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` of ``form`` was made from. A text with a sentinel
    is plain, so the first sentinel of each kind is the one put in."""
    p, s, m = (f"\\Q{x}\\E" for x in sentinels)
    psm = F.regexp_replace(output, f"(?s)\\A{p}(.*?){s}(.*?){m}(.*)\\z", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)\\A{s}(.*?){p}(.*?){m}(.*)\\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
