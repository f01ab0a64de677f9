r"""Secret scans by a recursive decoding worklist.

Three kinds of secrets are searched in the text itself (leftmost,
non-overlapping per kind): assignments of a value of 8 or more characters to a
name such as ``password``, access keys of 16 or more characters, and runs of 32
or more hexadecimal digits. The text is the first layer of a worklist. From
each layer others are unwrapped: percent escapes (also ``%u``), ``\u``, ``\u{}``, ``\U``
and ``\x`` escapes (what stands around them with all escapes of the sort decoded), runs of base64,
also over several lines (each read from its first four characters, as a path or
other prefix may be part of the run), gzip and zlib data inside them. Each new layer is scanned
and unwrapped in turn until nothing new appears; a layer whose text and place
were seen before is not taken again, so data that decode to themselves end. Work
and memory grow in proportion to a text and to what its layers hold, however long a run.
Every decoded layer is scanned, binary ones too: bytes that are not UTF-8 are
replaced, and ASCII characters of two bytes (UTF-16) are read as one.

A span found in a layer is mapped back to the text: character by character
through escapes, to the whole run for base64 and what is inside it.

Compressed data are inflated whole, member after member and however deep, and
scanned in parts of about ``BLOCK`` characters that end where no secret and no
encoded run goes on. Memory grows with the longest stretch without such a place,
time with the inflated size.

Defined results: null and empty texts have no spans; repeated rows each get a
row; ids may be null; an empty table gives an empty result. Other columns of
the input are ignored. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from reverbkit.llm.common import texts

#: Bytes that go into an inflation at once, and bytes or characters that come out.
FED, BLOCK = 64 << 10, 1 << 20

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:%u[0-9A-Fa-f]{4})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}={0,2}")
BASE64_URL = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*[_-])[A-Za-z0-9_-]{16,}={0,2}")
#: A line end, also one spelled as an escape, with what indents the next line.
LINE_END = re.compile(r"[ \t]*+(?:\r\n?|\n|(?:\\r)?\\n)[ \t]*+")
#: The first line of wrapped base64, from wherever it starts, and a whole further one.
WRAPPED = [
    (
        re.compile(rf"(?:(?<![{a}])(?!(?<=\\)[nr])|(?<=\\n))[{a}]{{4,}}+(?={LINE_END.pattern}[{a}])"),
        re.compile(rf"([{a}]++={{0,2}}+)(?=[ \t]*+(?:[^\w \t]|\Z))"),
    )
    for a in ("A-Za-z0-9+/", "A-Za-z0-9_-")
]
#: The start of gzip or zlib data after a sign.
PACKED = re.compile(r"(?<=[+/])(?:H4sI|e[AFJN])")
FROM_URL = str.maketrans("-_", "+/")
#: ASCII characters of two bytes, UTF-16 of either byte order.
WIDE = re.compile(r"(?:[\x01-\x7f]\x00){2,}|(?:\x00[\x01-\x7f]){2,}")
#: All up to the last character that neither a secret nor an encoded run goes across.
NOTHING_ACROSS = r"(?:[^A-Za-z0-9+/=_.:%{}\\\"'\s\x00-]|\x00\x00)"
NEXT_BREAK, BREAK = re.compile(NOTHING_ACROSS), re.compile("(?s).*" + NOTHING_ACROSS)

Span = tuple[int, int, int]  # start, kind, end


def scan(text: str) -> list[Span]:
    """The secrets of one layer, in its own offsets."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


class Layer:
    """A text and where its characters come from: one span of the document for
    all (``whole``), cuts of an outer layer, or the document itself. A cut tells
    from which character on (``at``) it holds, the stretch of the outer layer, and
    how many characters there stand for one here (0: all of them for each)."""

    def __init__(self, text: str, whole: tuple[int, int] | None = None, outer: Layer | None = None, cuts: list[tuple[int, int, int, int]] | None = None):
        self.text, self.whole, self.outer, self.cuts = text, whole, outer, cuts

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.outer is None:
            return start, end
        return self.outer.place(self._source(start)[0], self._source(end - 1)[1])

    def _source(self, i: int) -> tuple[int, int]:
        at, start, end, step = self.cuts[bisect_right(self.cuts, i, key=lambda c: c[0]) - 1]
        return (start + step * (i - at), start + step * (i - at + 1)) if step else (start, end)

    def key(self) -> tuple:
        return (hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), self.place(0, len(self.text)))


def _blocks(data: bytes, begin: int = 0) -> Iterator[tuple[bool, bytes]]:
    for at in range(begin, len(data), FED):
        yield at == begin, data[at : at + FED]


def _inflated(source: Iterable[tuple[bool, bytes]], members: set[int] | None = None, begin: int = 0) -> Iterator[tuple[bool, bytes]]:
    """The data of the gzip and zlib members at the head of ``source``, which
    gives (starts a member, bytes), at the head of its own members, and directly
    behind another member. With ``members`` the source is stored data from place
    ``begin`` on, of one member or none: the place where each member starts is
    added, and reading ends where no member goes on."""
    z, rest, armed, starts, fed = None, b"", False, False, begin
    for new, data in source:
        fed += len(data)
        if z is None:
            armed = armed or new
            rest = b"" if new else rest
        rest = rest + data if armed else b""
        while armed:
            if z is None:
                if len(rest) < 2:
                    break
                if rest[:2] != b"\x1f\x8b" and not (rest[0] == 0x78 and (rest[0] * 256 + rest[1]) % 31 == 0):
                    armed = False
                    break
                z, starts = zlib.decompressobj(47), True
                if members is not None:
                    members.add(fed - len(rest))
            try:
                out = z.decompress(rest, BLOCK)
            except zlib.error:
                z, armed = None, False
                break
            if out:
                yield starts, out
                starts = False
            if z.eof:
                # members may be filled up with zeros
                z, rest = None, z.unused_data.lstrip(b"\0")
            else:
                rest = z.unconsumed_tail
                if not rest and len(out) < BLOCK:
                    break
        if members is not None and not armed:
            return


def _windows(blocks: Iterable[bytes]) -> Iterator[str]:
    """Bytes as text, whatever they are, in parts that end where nothing that is
    searched for or unwrapped can go on. All of that is ASCII: bytes that are not
    UTF-8 only stand between."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    parts, size, full = [], 0, BLOCK
    for data in blocks:
        parts.append(decoder.decode(data))
        size += len(parts[-1])
        if size >= full:
            text = "".join(parts)
            end = m.end() if (m := BREAK.match(text)) else 0
            if end:
                yield text[:end]
            parts, size = [text[end:]], len(text) - end
            full = max(BLOCK, 2 * size)
    yield "".join(parts) + decoder.decode(b"", True)


def _layers(data: bytes, place: tuple[int, int], members: set[int], begin: int = 0, steps: int = 0) -> Iterator[Layer]:
    """The texts of some bytes, of what is compressed in them, and so on until
    nothing new appears; with ``steps`` = 1 only what is compressed. Each step
    inflates anew from the first, block by block: memory does not grow with what
    data inflate to."""
    seen = set()
    while True:
        digest, size = hashlib.blake2b(digest_size=16), 0

        def read(steps: int = steps, digest: hashlib.blake2b = digest) -> Iterator[bytes]:
            nonlocal size
            source: Iterable[tuple[bool, bytes]] = _blocks(data, begin)
            for step in range(steps):
                source = _inflated(source) if step else _inflated(source, members, begin)
            for _, block in source:
                digest.update(block)
                size += len(block)
                yield block

        yield from (Layer(text, place) for text in _windows(read()))
        if not size or digest.digest() in seen:
            return
        seen.add(digest.digest())
        steps += 1


def _narrow(run: str) -> str:
    return run.replace("\0", "")


def _unescaped(run: str) -> str:
    if run[:2] == "%u":
        return bytes.fromhex(run.replace("%u", "")).decode("utf-16-be", "replace")
    if run[0] == "%":
        data = bytes.fromhex(run.replace("%", ""))
    elif run[1:3] == "u{":
        return chr(min(int(run[3:-1], 16), 0x10FFFF))
    elif run[1] == "u":
        return bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "replace")
    elif run[1] == "U":
        return chr(min(int(run[2:], 16), 0x10FFFF))
    else:
        data = bytes.fromhex(run.replace("\\x", ""))
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _through_escapes(layer: Layer, pattern: re.Pattern, decode: Callable[[str], str] = _unescaped) -> Layer | None:
    """The layer with all escapes of a sort decoded, without the stretches between
    characters nothing goes across that hold none: they show nothing new."""
    text, pieces, cuts, size, at = layer.text, [], [], 0, 0

    def add(piece: str, start: int, end: int, step: int) -> None:
        nonlocal size
        if piece:
            pieces.append(piece)
            cuts.append((size, start, end, step))
            size += len(piece)

    for m in pattern.finditer(text):
        # what ends the stretch before stays on its side, what begins this one here
        first = NEXT_BREAK.search(text, at, m.start()) if cuts else None
        last = BREAK.match(text, first.end() if first else at, m.start()) if first or not cuts else None
        if first:
            add(text[at : first.end()], at, first.end(), 1)
            at = first.end()
        at = max(at, last.end() - 2) if last else at
        add(text[at : m.start()], at, m.start(), 1)
        new = decode(m[0])
        # characters that take equally long escapes map one by one
        add(new, m.start(), m.end(), len(m[0]) // len(new) if new and len(m[0]) % len(new) == 0 else 0)
        at = m.end()
    if not pieces:
        return None
    end = after.end() if (after := NEXT_BREAK.search(text, at)) else len(text)
    add(text[at:end], at, end, 1)
    return Layer("".join(pieces), layer.whole) if layer.whole else Layer("".join(pieces), None, layer, cuts)


def unwrap(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside a layer."""
    if "%" in layer.text and (inner := _through_escapes(layer, PERCENT)):
        yield inner
    if "\\" in layer.text and (inner := _through_escapes(layer, ESCAPE)):
        yield inner
    if "\0" in layer.text and (inner := _through_escapes(layer, WIDE, _narrow)):
        yield inner
    for pattern in (BASE64, BASE64_URL):
        for m in pattern.finditer(layer.text):
            yield from _decoded(m[0], layer.place(m.start(), m.end()))
    for first, line in WRAPPED:
        for run, start, end in _wrapped(layer.text, first, line):
            yield from _decoded(run, layer.place(start, end))


def _wrapped(text: str, first: re.Pattern, line: re.Pattern) -> Iterator[tuple[str, int, int]]:
    """Base64 over several lines: the characters, start and end. A line that is
    shorter than the one before or ends with padding is the last."""
    at = 0
    while m := first.search(text, at):
        lines, at = [m[0]], m.end()
        while (gap := LINE_END.match(text, at)) and (more := line.match(text, gap.end())):
            lines.append(more[1])
            at = more.end(1)
            if len(more[1]) < len(lines[-2]) or more[1][-1] == "=":
                break
        run = "".join(lines)
        if len(lines) > 1 and len(run) >= 16:
            yield run, m.start(), at


def _decoded(run: str, place: tuple[int, int]) -> Iterator[Layer]:
    """What a run of base64 holds, read from each of its first four characters,
    as what stands before the data, such as a path, may look like base64 too;
    compressed data need their very start and are also tried after each sign."""
    run = run.rstrip("=").translate(FROM_URL)
    packed = [m.start() for m in PACKED.finditer(run)]
    for at in range(4):
        data, members = _bytes(run[at:]), set()
        yield from _layers(data, place, members)
        for begin in ((hit - at) // 4 * 3 for hit in packed if hit % 4 == at):
            # a member behind another one has been read with it
            if begin not in members:
                yield from _layers(data, place, members, begin, 1)


def _bytes(run: str) -> bytes:
    run = run[: len(run) - (len(run) % 4 == 1)]
    return binascii.a2b_base64(run + "=" * (-len(run) % 4))


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """The spans found in the text itself, and those of all layers, in order."""
    base = sorted(scan(text))
    # the layers one in another that are being unwrapped: inflated data come part by part
    found, work, seen = set(base), [unwrap(Layer(text))], set()
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        if not seen:
            seen.add(Layer(text).key())
        if inner.text and (key := inner.key()) not in seen:
            seen.add(key)
            found |= {(s, k, e) for a, k, b in scan(inner.text) for s, e in [inner.place(a, b)]}
            work.append(unwrap(inner))
    return base, sorted(found)


def spelled(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs``: arrays of (kind, start,
    end), ``base`` those of the text itself."""
    rows = texts(docs, id_col, text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [spans(t.as_py()) for t in b["text"]]
            lists = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x[i]] for x in both], span) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *lists], ["doc_id", "base", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    of = "array<struct<kind: string, start: long, end: long>>"
    return rows.mapInArrow(found, f"doc_id {kind}, base {of}, spans {of}")
