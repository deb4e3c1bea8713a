"""Secret scans with multipart credential linking (operator 7).

Base kinds are found wherever they stand. A credential often comes in parts, though: an access
identifier here, a secret there, an endpoint beside them. Parts that are too common to report
alone (a 40-character base64 string, an endpoint) are weak candidates, found on the whole text of a
document that has an identifier. Each access identifier opens a scope of ``scope`` characters on
either side. Weak parts are joined to scopes by overlap, with their full spans, and reported only when
complementary parts share one scope: a weak secret needs an identifier, an endpoint needs an identifier
and a secret (weak or base) that overlap the same identifier's scope as it does. The interval join asks
sorted intervals with a running maximum of their ends, so it is O(n log n) and makes no pairs.

Edge cases: null text is empty and has no spans; texts of any length are scanned whole; ties in
start are ordered by kind as listed in ``KINDS``; repeated rows give repeated rows; an empty
table gives no rows; other columns are kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

KINDS = ("assign", "access", "hex", "weak_secret", "endpoint")
SCOPE = 200
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::\d{1,5})?|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{1,5})?\b|\b[a-z0-9.-]+\.amazonaws\.com\b", re.A)

Span = tuple[int, int, int]  # start, kind, end: sorts as the contract asks


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans.sort()
    return spans


class Intervals:
    """A set of [start, end) intervals that is asked whether any overlaps a given one."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.tops = list(accumulate((e for _, e in spans), max))

    def hit(self, s: int, e: int) -> bool:
        i = bisect_left(self.starts, e)
        return i > 0 and self.tops[i - 1] > s


def linked_spans(text: str, base: list[Span], width: int = SCOPE) -> list[Span]:
    """Weak parts that parts of the same scope complete."""
    around = [(max(0, s - width), e + width) for s, kind, e in base if kind == 1]
    if not around:
        return []
    taken = Intervals([(s, e) for s, _, e in base])
    scopes = Intervals(around)
    weak = [m.span() for m in WEAK_SECRET.finditer(text)]
    weak = [w for w in weak if scopes.hit(*w) and not taken.hit(*w)]
    secret = Intervals([*weak, *((s, e) for s, kind, e in base if kind in (0, 2))])
    whole = Intervals([scope for scope in around if secret.hit(*scope)])
    ends = [m.span() for m in ENDPOINT.finditer(text)] if whole.starts else []
    return [(s, 3, e) for s, e in weak] + [(s, 4, e) for s, e in ends if whole.hit(s, e)]


def find(text: str, width: int = SCOPE) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each sorted."""
    base = base_spans(text)
    if not any(kind == 1 for _, kind, _ in base):
        return base, base
    return base, sorted(base + linked_spans(text, base, width))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    tune(docs.sparkSession)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = find(text or "", scope)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*n, hashlib.sha256(shown(base).encode()).hexdigest(), shown(every), len(every) - len(base)))
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


def blanked(text: str, spans: list[Span]) -> str:
    """The text with every span (overlapping ones as one) replaced by the mark of its first kind."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with secrets in ``text`` blanked; all columns stay, n_chars (where there is one) follows the text."""
    tune(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: None if t is None else blanked(t, find(t, scope)[1]))

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
