"""Emoji -> ``:short_name:``: the name table and the patterns that find emoji.

The names (CLDR English short names, lower case) are read from the table file
``EMOJI_NAMES``, one emoji and its name per line; another file of that form may
be given instead. Skin tones are not listed: a cluster's tones are cut out, the
rest is looked up, and the tones' names are appended. What the table does not
hold is looked up part by part, and a part without a name stays as it is, so
symbols that are no emoji are left alone.

Spark sees the table as one constant-folded map literal (see
``functions.text.emoji_map_column``).
"""

from __future__ import annotations

import functools
import json
from pathlib import Path

EMOJI_NAMES = Path(__file__).resolve().parent.parent / "data" / "emoji_names.tsv"

TONES = r"\x{1F3FB}-\x{1F3FF}"
SELECTORS = r"\x{FE0E}\x{FE0F}"
_FLAG = r"\x{1F1E6}-\x{1F1FF}"
_TAGS = r"\x{E0020}-\x{E007F}"
_PLAIN = r"[\x00-\x22\x24-\x29\x2B-\x2F\x3A-\x7F]+"  # ASCII that starts no cluster
_KEYCAP = rf"[0-9#*][{SELECTORS}]?\x{{20E3}}"


@functools.lru_cache
def emoji_table(path: str | Path = EMOJI_NAMES) -> dict[str, str]:
    """Emoji cluster (no variation selector, no skin tone) -> short name."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    return dict(line.split("\t") for line in lines if line and not line.startswith("#"))


def tone_names() -> dict[str, str]:
    """The five skin tones, which are emoji of their own as well."""
    return {e: name for e, name in emoji_table().items() if name.endswith("_skin_tone")}


@functools.lru_cache
def _bases() -> str:
    """The code points that stand alone as an emoji or start one, as the inside
    of a character class."""
    points = sorted({ord(e[0]) for e in emoji_table() if ord(e[0]) > 0x7F and not 0x1F1E6 <= ord(e[0]) <= 0x1F1FF})
    runs: list[list[int]] = []
    for p in points:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


def part_pattern() -> str:
    """One emoji with its selectors, tones and tags, or any other character."""
    return f"[{_bases()}][{SELECTORS}{TONES}]*[{_TAGS}]*|(?s:.)"


def cluster_pattern() -> str:
    """A flag, a keycap, or emoji joined to one cluster."""
    one = f"[{_bases()}][{SELECTORS}{TONES}]*[{_TAGS}]*"
    return f"[{_FLAG}][{_FLAG}]|{_KEYCAP}|{one}(?:\\x{{200D}}{one})*"


def token_pattern() -> str:
    """A run of ASCII text, an emoji cluster or a run of other text; a character that
    could have started a cluster but didn't (a digit, half a flag) is a token of its
    own. ASCII goes first: the other classes are searched range by range."""
    return f"{_PLAIN}|{cluster_pattern()}|[^{_FLAG}{_bases()}0-9#*]+|(?s:.)"


def start_pattern() -> str:
    """Tokens that may hold an emoji: not those of plain text."""
    return f"^(?:[{_FLAG}{_bases()}]|{_KEYCAP})"


def emoji_table_json() -> str:
    return json.dumps(emoji_table(), ensure_ascii=False)
