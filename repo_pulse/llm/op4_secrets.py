"""Operator 4: secret scan with sliding-window Shannon entropy.

Fixed patterns find assignments, access keys and long hex runs. The entropy
scan looks at every run of key-like characters as a whole (base64), at its
pieces between ``= / _ -``, and at each stretch of lower or upper case hex in
it; the character class sets window and threshold. A
window's entropy follows from incremental character counts: moving it by one
character changes two counts, so a run of any length costs one step a
character. Overlapping windows above the threshold merge into one span. A
window inside what an allow-list entry matches does not count, nor does a span
that a fixed pattern has found; a path of words explains windows across its
separators, not its single words; a window of letters of one case needs more
bits than others, as long words have what random letters have. Allowed spans
and windows are walked side by side, so the work is linear in the text.

Scale: one scan without a shuffle; whole texts, any length; memory is one
Arrow batch.

Rows: NULL text counts as empty and has no spans; repeated rows are scanned
each; NULL doc_id stays NULL; other columns are not read; an empty table
gives an empty result. Ties in start go by kind, in the order of KINDS.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
NAMES = ("passw", "secret", "token", "apikey", "api_key")  # every ASSIGN match holds one, in some case
LEAST = {"assign": 12, "access": 18, "hex": 16}
LONG = re.compile(r"\S{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
PIECE = re.compile(r"[A-Za-z0-9+]+")
#: class: (window, bits); the shortest secret is one window
CLASSES = {"hex": (16, 2.5), "base64": (16, 3.5)}
#: Limit for windows that a word can fill: letters alone, all of one case but for one. Random ones have 3.5 bits as words do.
WORD_BITS = 3.9
STRETCH = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
ALLOWED = (
    re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])"),  # UUID
    re.compile(r"(?<![0-9A-Za-z+])[0-9]+(?![0-9A-Za-z+])"),  # plain number
    re.compile(r"(?<![0-9A-Za-z])[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2,6}Z?)?(?![0-9A-Za-z])"),  # date
    re.compile(r"sha256-[A-Za-z0-9+/]{43}=|sha384-[A-Za-z0-9+/]{64}(?![A-Za-z0-9+/])|sha512-[A-Za-z0-9+/]{86}=="),  # integrity digest
    re.compile(r"AKIA[A-Z0-9]{9}EXAMPLE(?![A-Za-z0-9])|[A-Za-z0-9+/]{30}EXAMPLEKEY(?![A-Za-z0-9])"),  # documented sample key
)
PATH = re.compile(r"(?<![0-9A-Za-z+])([A-Za-z]+[/_-])+[A-Za-z]+[0-9]{0,4}(?![0-9A-Za-z+])")  # path or identifier of words


def high_entropy(run: str, window: int, bits: float, allowed: list[tuple[int, int]] = (), words: float = 0.0) -> list[tuple[int, int]]:
    """Merged windows whose Shannon entropy is at least ``bits``, by incremental counts; windows inside one of ``allowed`` (sorted) do not count.

    Windows that a word can fill (letters alone, all of one case but for one) need ``words`` bits.
    """
    part = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    limit = window * (math.log2(window) - bits) + 1e-9  # H >= bits  <=>  sum n log n <= limit
    strict = window * (math.log2(window) - max(words, bits)) + 1e-9
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    upper = lower = 0
    reach, at = 0, 0  # the farthest end of the allowed spans that start no later than the window, and how many there are
    for i, c in enumerate(run):
        if i >= window:
            old = run[i - window]
            n = counts[old]
            total += part[n - 1] - part[n]
            counts[old] = n - 1
            upper -= "A" <= old <= "Z"
            lower -= "a" <= old <= "z"
        n = counts.get(c, 0)
        total += part[n + 1] - part[n]
        counts[c] = n + 1
        upper += "A" <= c <= "Z"
        lower += "a" <= c <= "z"
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if total > strict and upper + lower == window and min(upper, lower) <= 1:
                continue
            while at < len(allowed) and allowed[at][0] <= start:
                reach = max(reach, allowed[at][1])
                at += 1
            if i < reach:
                continue
            if spans and start <= spans[-1][1]:
                spans[-1] = spans[-1][0], i + 1
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted."""
    found = []
    low = text.lower()
    if any(n in low for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    for t in LONG.finditer(text):
        found += [(t.start() + m.start(), 2, t.start() + m.end()) for m in HEX.finditer(t[0]) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found)


def run_spans(run: str) -> list[tuple[int, int]]:
    """Merged spans of high entropy in a run, over the run, its pieces and its stretches of hex."""
    if len(run) < 16:
        return []
    allowed = sorted(m.span() for a in ALLOWED for m in a.finditer(run))
    paths = [m.span() for m in PATH.finditer(run)]
    spans = high_entropy(run, *CLASSES["base64"], sorted(allowed + paths), WORD_BITS)
    if paths:  # elsewhere the windows of the run hold those of its pieces
        spans += _in_parts(PIECE, run, allowed, *CLASSES["base64"], WORD_BITS)
    spans += _in_parts(STRETCH, run, allowed, *CLASSES["hex"])
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _in_parts(parts: re.Pattern, run: str, allowed: list[tuple[int, int]], window: int, bits: float, words: float = 0.0) -> list[tuple[int, int]]:
    """Windows of high entropy in each part of a run; parts and allowed spans are walked side by side."""
    spans, open_, at = [], [], 0
    for m in parts.finditer(run):
        start, end = m.span()
        if end - start < window:
            continue
        while at < len(allowed) and allowed[at][0] < end:
            open_.append(allowed[at])
            at += 1
        open_ = [x for x in open_ if x[1] > start]  # those that can hold a window of this part or a later one
        spans += [(start + a, start + b) for a, b in high_entropy(m[0], window, bits, [(a - start, b - start) for a, b in open_], words)]
    return spans


def entropy_spans(text: str) -> list[tuple[int, int]]:
    spans = []
    for t in LONG.finditer(text):
        for m in RUN.finditer(t[0]):
            at = t.start() + m.start()
            spans += [(at + a, at + b) for a, b in run_spans(m[0])]
    return spans


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (start, kind number, end)."""
    base = base_spans(text or "")
    more, reach, at = [], 0, 0
    for s, e in entropy_spans(text or ""):  # in order of start
        while at < len(base) and base[at][0] <= s:
            reach = max(reach, base[at][2])
            at += 1
        if e > reach:  # else a fixed pattern holds it
            more.append((s, 3, e))
    return base, sorted(base + more)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy and the list of found strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans", "found"]
        for b in batches:
            rows = []
            for doc_id, value in zip(b.column(0).to_pylist(), b.column(1)):
                text = value.as_py() or ""
                base, spans = scan(text)
                kinds = [k for _, k, _ in spans]
                rows.append((doc_id, *[kinds.count(k) for k in range(4)], hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), [text[s:e] for s, _, e in spans]))
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string, found array<string>")


def op4(docs: DataFrame) -> DataFrame:
    return secrets(docs).drop("found")
