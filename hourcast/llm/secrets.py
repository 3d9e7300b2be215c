"""Secret scan: fixed patterns, and windows of high Shannon entropy.

Candidates are long runs of key characters. Over each slides a window; the
entropy of its characters follows from their counts, of which one goes and one
comes at each step. Hexadecimal runs and runs of the whole alphabet have their
own window and limit, and a window must mix character classes as random keys
do; limits and mixes are such that at most one random window in fifty fails them.
Windows above the limit are joined to spans. Strings of the allow list (hosts and
paths of addresses, identifiers, plain words) are suppressed, but not what stands
before an @ there; spans that a pattern has found already are not repeated.

Defined cases: a null text is empty; no spans give an empty list. Repeated rows
give repeated results. Whole texts are read, whatever their length. An empty
table gives an empty result.
"""
from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns and lengths that the task states.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones cannot hide a longer one
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "entropy")
#: a text without any of these (in lower case) has no assignment
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: character class: (all characters of the run, window, bits at least, mixes), a mix
#: being the fewest lower-case letters, capitals and digits of a window; one must hold
CLASSES = (
    ("hex", re.compile(r"[0-9A-Fa-f]+"), 24, 2.9, ((3, 0, 4), (0, 3, 4))),
    ("one case", re.compile(r"[a-z0-9+/_=-]+|[A-Z0-9+/_=-]+"), 20, 3.35, ((6, 0, 2), (0, 6, 2))),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.55, ((2, 2, 1), (5, 5, 0))),
)
#: a word in one case, or words whose first letters are capitals, or a short number
_PLAIN = "[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|[0-9]{1,4}"
#: whole candidates that are no secrets
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(rf"({_PLAIN})([/_=+-]+({_PLAIN}))*[/_=+-]*"),  # words and short numbers with marks between
    re.compile(r"(.{1,8}?)\1{2,}.{0,8}"),  # repetitions
)
#: a candidate right after one of these is part of an address, but for its user part
ADDRESS = re.compile(r"(https?://|www\.)\S*$|@$")
USER = re.compile(r"[^\s/@]*@")


def _class(c: str) -> int:
    """0 to 3: lower-case letter, capital, digit, other."""
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def entropy_spans(text: str, window: int, bits: float, mixes) -> list[tuple[int, int]]:
    """Joined windows of ``text`` whose entropy reaches ``bits`` and that hold one
    of ``mixes``: the fewest lower-case letters, capitals and digits."""
    cost = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    full = math.log2(window)
    counts: dict[str, int] = {}
    total, held, out = 0.0, [0, 0, 0, 0], []
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        total += cost[k + 1] - cost[k]
        counts[c] = k + 1
        held[_class(c)] += 1
        if i >= window:
            c = text[i - window]
            k = counts[c]
            total += cost[k - 1] - cost[k]
            counts[c] = k - 1
            held[_class(c)] -= 1
        if i >= window - 1 and full - total / window >= bits and any(
                held[0] >= a and held[1] >= b and held[2] >= d for a, b, d in mixes):
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def find(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind, end) of all spans of a text; kind by KINDS."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    known = list(out)
    for m in CANDIDATE.finditer(text):
        own = m[0].lstrip("/")  # the slashes before a host
        begin = m.end() - len(own)
        if len(own) < 20 or any(a.fullmatch(own) for a in ALLOW):
            continue
        address = ADDRESS.search(text, max(0, begin - 200), begin)
        if address and ("/" in address[0].partition("://")[2] or not USER.match(text, m.end())):
            continue
        window, bits, mixes = next(x[2:] for x in CLASSES if x[1].fullmatch(own))
        for a, b in entropy_spans(own, window, bits, mixes):
            a, b = a + begin, b + begin
            if not any(x <= a and b <= y for x, _, y in known):
                out.append((a, 3, b))
    return sorted(out)


SPANS = "doc_id long, spans array<struct<kind:string,start:long,stop:long>>"


def _scan(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    for b in batches:
        spans = [[{"kind": KINDS[k], "start": a, "stop": z} for a, k, z in find(t)] if t else [] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["doc_id", "spans"])


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the spans (kind, start, stop; code points) of every row."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan, SPANS)


def redact(docs: DataFrame, mask: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; same columns."""
    def run(batches):
        for b in batches:
            k = b.schema.get_field_index(text)
            yield b.set_column(k, b.schema.field(k), pa.array([_redacted(t, mask) for t in b.column(k).to_pylist()], b.schema.field(k).type))
    return docs.mapInArrow(run, docs.schema)


def _redacted(text, mask):
    if not text:
        return text
    out, at = [], 0
    for a, _, z in find(text):
        if z > at:
            out += [text[at:max(a, at)], mask] if a >= at else []
            at = z
    return "".join(out) + text[at:]
