"""Operator 9: packing documents into token windows by minimum bin slack.

A document's full windows are sequences of their own. What remains of each
document (1 to window-1 tokens) is packed per block of remainders: a bitset
dynamic program over the multiset of remaining lengths (longest first) finds
the reachable total closest to the window, backtracking gives how many pieces
of each length reach it, and that choice is used for as many windows as the
counts allow before the next one is computed. When no choice fills a window
exactly, one further remainder is cut to fit and its rest goes back to the
multiset. The last, partly filled window of a block is cut into sequences of
power-of-two lengths, which need no padding.

Scale: documents are encoded once, in one pass without a shuffle. A task
holds the remainders of at most ``BLOCK`` tokens, so memory is bounded for
any table or document; each block is planned on at most window-1 counts.
A hot source or group of copies changes nothing, as rows are never grouped.
sequence_id = task number * 2^32 + number in the task, so the input must be
read again in the same partitions when a task is repeated (a table is).

Rows: NULL text counts as empty; an empty text is the closing id alone;
repeated rows are packed each; NULL doc_ids stay NULL; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm import tokens

WINDOW = 2048
BLOCK = 1 << 22  # tokens of remainders that a task packs at a time

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(lengths: list[int], counts: list[int], window: int) -> list[tuple[int, int]]:
    """The multiset of lengths (descending) whose total is closest to, and at most, the window.

    The longest length is always used; returns [(position, how many)].
    """
    mask = (1 << (window + 1)) - 1
    sets = [1 << lengths[0]]
    for i, (size, have) in enumerate(zip(lengths, counts)):
        have = min(have - (i == 0), window // size)
        reach, step = sets[-1], 1
        while have > 0:  # binary splitting: after k steps every number of copies up to have is covered
            take = min(step, have)
            reach |= (reach << (size * take)) & mask
            have -= take
            step *= 2
        sets.append(reach)
        if reach >> window & 1:
            break
    total = sets[-1].bit_length() - 1
    chosen = []
    for i in range(len(sets) - 2, -1, -1):
        n = 0
        while not sets[i] >> total & 1:
            total -= lengths[i]
            n += 1
        n += i == 0
        if n:
            chosen.append((i, n))
    return chosen


class Block:
    """Remainders by length; a remainder is (document in the block, start, length)."""

    def __init__(self, window: int):
        self.window, self.rest, self.size = window, {}, 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.rest.setdefault(length, []).append((doc, start))
        self.size += length

    def sequences(self) -> Iterator[list[tuple[int, int, int]]]:
        """Lists of (document, start, length), each filling one window or a power of two."""
        window, rest = self.window, self.rest
        lengths = sorted(rest, reverse=True)
        while lengths:
            counts = [len(rest[n]) for n in lengths]
            chosen = fill(lengths, counts, window)
            slack = window - sum(lengths[i] * n for i, n in chosen)
            need = {lengths[i]: n for i, n in chosen}
            cut = None
            if slack:  # some longer remainder that is not in the choice
                cut = next((n for n in reversed(lengths) if n > slack and len(rest[n]) > need.get(n, 0)), None)
                if cut is None:
                    yield from self._powers([(d, s, lengths[i]) for i, n in chosen for d, s in (rest[lengths[i]].pop() for _ in range(n))])
                    lengths = [n for n in lengths if rest[n]]
                    continue
            used = need | ({cut: need.get(cut, 0) + 1} if cut else {})
            for _ in range(min(len(rest[n]) // k for n, k in used.items())):
                pieces = [(d, s, n) for n, k in need.items() for d, s in (rest[n].pop() for _ in range(k))]
                if cut:
                    d, s = rest[cut].pop()
                    pieces.append((d, s, slack))
                    rest.setdefault(cut - slack, []).append((d, s + slack))
                yield pieces
            if cut and cut - slack not in lengths:
                lengths = sorted([*lengths, cut - slack], reverse=True)
            lengths = [n for n in lengths if rest[n]]

    def _powers(self, pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
        total = sum(n for _, _, n in pieces)
        pieces = pieces[::-1]
        for power in range(total.bit_length() - 1, -1, -1):
            left, sequence = total & (1 << power), []
            while left:
                d, s, n = pieces.pop()
                sequence.append((d, s, min(n, left)))
                if n > left:
                    pieces.append((d, s + left, n - left))
                left -= min(n, left)
            if sequence:
                yield sequence


def pack_rows(rows: Iterator[tuple[int | None, np.ndarray]], window: int, block: int, first_id: int) -> Iterator[tuple]:
    """(doc_id, ids) -> result rows, in blocks of remainders."""
    sequence = first_id
    now, held = Block(window), []

    def flush() -> Iterator[tuple]:
        nonlocal sequence
        for pieces in now.sequences():
            offset = 0
            for d, s, n in pieces:
                doc_id, ids, before = held[d]
                yield doc_id, before + s, n, zlib.crc32(ids[s:s + n].tobytes()), before + len(ids), sequence, offset
                offset += n
            sequence += 1

    for doc_id, ids in rows:
        full = len(ids) // window * window
        for at in range(0, full, window):
            yield doc_id, at, window, zlib.crc32(ids[at:at + window].tobytes()), len(ids), sequence, 0
            sequence += 1
        if full < len(ids):
            now.add(len(held), 0, len(ids) - full)
            held.append((doc_id, ids[full:].copy(), full))
        if now.size >= block:
            yield from flush()
            now, held = Block(window), []
    yield from flush()


def pack(docs: DataFrame, ids_of: Callable[[str], np.ndarray] | None = None, path: str | None = None,
         window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Pieces of all documents; ids_of(text) or the tokenizer file at ``path`` gives the ids before the closing one."""
    path = path or (None if ids_of else tokens.default_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of or tokens.encoder(path).ids

        def rows():
            for b in batches:
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                    yield doc_id, np.append(encode(text.as_py() or ""), np.uint32(tokens.END)).astype("<u4")

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        out: list[tuple] = []
        for row in pack_rows(rows(), window, block, TaskContext.get().partitionId() << 32):
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


def op9(docs: DataFrame) -> DataFrame:
    return pack(docs)
