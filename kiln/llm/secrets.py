"""Secret scans: fixed patterns, and dictionary-primed Zstandard novelty.

Base patterns (leftmost, not overlapping within a kind): ``assign``, ``access``,
``hex``.  Beside them, ``novel`` spans: strings of ``CANDIDATE`` or more characters
that stand within ``REACH`` characters after a sensitive word and overlap no base
span are measured by the bytes they add to a Zstandard frame of their
surroundings, with a dictionary of identifiers as prefix: compressed(surroundings
+ candidate) - compressed(surroundings).  Words and identifiers are found in the
surroundings or the dictionary and add a few bytes; a random string adds nearly
its own length.  From ``NOVELTY`` bytes per character on, or ``DENSITY`` of the bits
of its own alphabet (digits, hex digits, or all characters of a string) if that is
less, the string is reported.

Secrets must not vouch for one another: base spans, other candidates and all other
strings of ``CANDIDATE`` or more characters are left out of the surroundings.  Only
strings that stand before it, away from any sensitive word, and share ``CANDIDATE``
characters with it stay and count as known.  Entropy coding and repeats make long
strings cheaper, so a string is judged by its pieces of ``PIECE`` characters as well:
one novel piece is enough.

The identifier dictionary holds the words that stand around sensitive words in
the corpus, counted over all documents, the most frequent ``DICTIONARY`` of them
(its size does not grow with the corpus).

Defined cases: null text is empty; offsets are code points, end exclusive; a
repeated row is scanned again; an empty table gives no rows; extra columns are
ignored; without any sensitive word the dictionary is empty and nothing is novel.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_batches

# The patterns of the scan, and their kinds in order.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 8
# A run of 16 (32) or more is the greedy run of the pattern with "+", kept only if long enough.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey", "credential", "private_key", "bearer", "auth_key", "access_key", "akia")

CANDIDATE = 16
REACH = 64
AROUND = 256
NOVELTY = 0.8
DENSITY = 0.95
PIECE = 32
DICTIONARY = 4096
LEVEL = 3
FLUSH = 100_000
_SENSITIVE = re.compile("|".join(WORDS), re.IGNORECASE | re.ASCII)
_STRING = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % CANDIDATE)
_ALPHABETS = [(re.compile(p), size) for p, size in ((r"[0-9]+", 10), (r"[0-9a-f]+|[0-9A-F]+", 16), (r"[0-9A-Fa-f]+", 22), (r".+", 67))]
# Words without digits, whole: a random string must not vouch for itself.
_IDENTIFIER = re.compile(r"(?<!\w)[^\W\d]{3,24}(?!\w)")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns."""
    out, low = [], text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "api_key", "apikey")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def sensitive(text: str) -> list[tuple[int, int]]:
    """Places of sensitive words."""
    low = text.lower()
    return [m.span() for m in _SENSITIVE.finditer(text)] if any(w in low for w in WORDS) else []


def packer(words: list[str]) -> zstandard.ZstdCompressor:
    """A compressor primed with the words, the most frequent last (nearest)."""
    prefix = " ".join(reversed(words)).encode()
    kept = {"dict_data": zstandard.ZstdCompressionDict(prefix, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if len(prefix) >= 8 else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **kept)


def surroundings(text: str, start: int, end: int, hidden: list[tuple[int, int]]) -> bytes:
    """The text around text[start:end] without the ``hidden`` spans (in order) and
    without other long strings, unless they stand before it and share a run with it."""
    lo, hi = max(0, start - AROUND), end + AROUND
    runs = {text[i:i + CANDIDATE] for i in range(start, end - CANDIDATE + 1)}

    def shared(a: int, b: int) -> bool:
        return any(text[i:i + CANDIDATE] in runs for i in range(a, b - CANDIDATE + 1))

    gone = [(a, b) for a, b in hidden[:bisect_left(hidden, (hi, 0))] if b > lo and (b <= start or a >= end)]
    gone += [m.span() for m in _STRING.finditer(text, lo, start) if not shared(*m.span())]
    gone += [m.span() for m in _STRING.finditer(text, end, hi + CANDIDATE) if m.start() < hi]
    out, at = [], lo
    for a, b in sorted([*gone, (start, end)]):
        if b > at:
            out.append(text[at:max(at, a)] + "\n" * (a == start))
            at = b
    out.append(text[at:max(at, hi)] + "\n")
    return "".join(out).encode(errors="replace")


def limit(string: str) -> float:
    """Added bytes per character from which the string is novel."""
    size = next(n for p, n in _ALPHABETS if p.fullmatch(string))
    return min(NOVELTY, DENSITY * math.log2(size) / 8)


def novel(pack: zstandard.ZstdCompressor, text: str, start: int, end: int, hidden: list[tuple[int, int]]) -> bool:
    """Whether text[start:end], or a piece of it, is novel in its surroundings."""
    around = surroundings(text, start, end, hidden)
    bare = len(pack.compress(around))

    def new(a: int, b: int) -> bool:
        return len(pack.compress(around + text[a:b].encode())) - bare >= limit(text[a:b]) * (b - a)

    if new(start, end):
        return True
    last = end - PIECE
    return any(new(a, a + PIECE) for a in [*range(start, last, PIECE // 2), last]) if last > start else False


def novel_spans(pack: zstandard.ZstdCompressor, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Incompressible strings near sensitive words, outside the base spans."""
    found, done = [], -1
    taken = sorted((a, b) for _, a, b in base)
    for _, after in sensitive(text):
        for m in _STRING.finditer(text, max(after, done)):
            start, end = m.span()
            if start > after + REACH:
                break
            if any(a < end and start < b for a, b in taken):
                continue
            done = end
            found.append((start, end))
    hidden = sorted([*taken, *found])
    return [("novel", a, b) for a, b in found if novel(pack, text, a, b, hidden)]


def identifiers(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words around sensitive words, over all documents."""
    small_batches(docs.sparkSession)

    def run(batches):
        count: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(count), pa.string()), "n": pa.array(list(count.values()), pa.int64())})

        for b in batches:
            for text in b.column(0).to_pylist():
                done = 0
                for start, end in sensitive(text or ""):
                    lo, hi = max(done, start - AROUND), end + AROUND
                    count.update(_IDENTIFIER.findall(text, lo, hi))
                    done = max(done, min(hi, len(text)))
            if len(count) >= FLUSH:
                yield rows()
                count.clear()
        if count:
            yield rows()

    words = docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def scan(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base, spans) of every row;
    ``base`` and ``spans`` list the base spans and all spans."""
    words = identifiers(docs) if words is None else words
    small_batches(docs.sparkSession)

    def run(batches):
        pack = packer(words)
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base = base_spans(text or "")
                extra = novel_spans(pack, text or "", base)
                n = Counter(k for k, _, _ in base + extra)
                rows.append({"doc_id": i, **{f"n_{k}": n[k] for k in KINDS}, "base": listed(base), "spans": listed(base + extra)})
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base string, spans string"))


_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base", pa.string()), ("spans", pa.string())])


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
