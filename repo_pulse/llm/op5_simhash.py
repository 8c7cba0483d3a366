"""Operator 5: SimHash near-duplicates by Golay-code fuzzy hashing.

A document's 64-bit fingerprint is cut into segments of 23, 23 and 18 bits
(the last padded to 23). If two fingerprints differ in at most 4 bits, some
two of the three segments differ in at most 2 bits each, so both share a
Golay key there: joining on the pair of key indices (24 bits) finds every
link; each candidate is then verified by its bit distance.

Scale. Copies collapse to one fingerprint before any key is made. Each
fingerprint gives at most 3 x 36 keys. Keys are hash-partitioned and sorted;
a task streams over its runs of equal keys and holds at most ``RUN`` numbers.
Short runs are compared at every lag; runs up to ``RUN`` emit a spanning
forest only, never all their pairs; members of longer runs go to an exact
fallback that needs no pairs: two fingerprints are within 4 bits exactly when
some number is within 2 bits of both, so each member emits its 2,081
neighbours and links to the first member of each neighbour's run.

Rows: NULL text counts as empty; texts without words have fingerprint zero
and link like any other; repeated rows each get a result row; an empty table
gives an empty result. A NULL doc_id never is a component id unless all ids
of the component are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm import golay
from repo_pulse.llm.common import row_key, store
from repo_pulse.llm.components import components

SHINGLE = 4
MAX_BITS = 4
RUN = 4096  # longest run of equal keys that one task compares
LAG = 32  # runs up to this length are compared pair by pair
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (lowest bit, bits)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bit i is set if set in over half the shingle hashes."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not found:
        return 0
    n = max(1, len(found) - shingle + 1)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(found))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], 42) for i, j in zip(starts[:n].tolist(), ends[size - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): one narrow row per document; fp as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "key", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("key"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, key long, fp long")


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys): the join keys of each fingerprint, for all pairs of segments."""
    u = fps.view(np.uint64)
    found = [golay.keys(((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64)) for lo, n in SEGMENTS]
    at, out = [], []
    slot = np.arange(6)
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        (a, na), (b, nb) = found[i], found[j]
        use = (slot[None, :, None] < na[:, None, None]) & (slot[None, None, :] < nb[:, None, None])
        key = (pair << 24) | (a[:, :, None] << 12) | b[:, None, :]
        at.append(np.nonzero(use)[0])
        out.append(key[use])
    return np.concatenate(at), np.concatenate(out)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        all_fps = np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64)
        for at in range(0, len(all_fps), 2048):
            fps = all_fps[at:at + 2048]
            i, key = segment_keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[i])], names=["key", "fp"])


def _lags(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = [], []
    i, lag = np.arange(len(key)), 1
    while True:
        i = i[i + lag < len(key)]
        i = i[key[i] == key[i + lag]]
        if not len(i):
            break
        near = i[np.bitwise_count((fp[i] ^ fp[i + lag]).view(np.uint64)) <= max_bits]
        a.append(fp[near])
        b.append(fp[near + lag])
        lag += 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _forest(fp: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links within one run; each number leaves the rest once."""
    rest, a, b = fp, [], []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count((rest ^ x).view(np.uint64)) <= max_bits
            if near.any():
                new = rest[near]
                a.extend([int(x)] * len(new))
                b.extend(new.tolist())
                todo.extend(new)
                rest = rest[~near]
    return a, b


def link_runs(batches: Iterator[pa.RecordBatch], max_bits: int = MAX_BITS, run: int = RUN) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> links (a, b); members of runs over ``run`` come as (fp, NULL)."""

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def whole(key, fp):  # complete runs
        _, first, size = np.unique(key, return_index=True, return_counts=True)
        each = np.repeat(size, size)
        short = (each > 1) & (each <= LAG)
        yield out(*_lags(key[short], fp[short], max_bits))
        for f, n in zip(first[size > LAG].tolist(), size[size > LAG].tolist()):
            yield out(fp[f:f + n], [None] * n) if n > run else out(*_forest(fp[f:f + n], max_bits))

    key, fp, long_key = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for b in batches:
        key = np.concatenate((key, b.column(0).to_numpy(zero_copy_only=False)))
        fp = np.concatenate((fp, b.column(1).to_numpy(zero_copy_only=False)))
        if long_key is not None:  # more of a run already known as long
            n = int(np.searchsorted(key, long_key, "right"))
            if n:
                yield out(fp[:n], [None] * n)
                key, fp = key[n:], fp[n:]
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield from whole(key[:cut], fp[:cut])
        key, fp = key[cut:], fp[cut:]
        if len(key) > run:
            long_key = int(key[0])
            yield out(fp, [None] * len(fp))
            key, fp = key[:0], fp[:0]
    if len(key):
        yield from whole(key, fp)


def _ball(bits: int = 2) -> np.ndarray:
    masks = [0] + [sum(1 << i for i in at) for n in range(1, bits + 1) for at in combinations(range(64), n)]
    return np.array(masks, np.uint64).view(np.int64)


def _emit_ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = _ball()
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 64):
            part = fps[at:at + 64]
            yield pa.RecordBatch.from_arrays([pa.array((part[:, None] ^ masks[None, :]).ravel()), pa.array(np.repeat(part, len(masks)))], names=["key", "fp"])


def link_to_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> (fp, first fp of the key)."""
    last, first = None, None
    for b in batches:
        if not b.num_rows:
            continue
        key, fp = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        new = np.concatenate(([last is None or key[0] != last], key[1:] != key[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        head = np.where(at >= 0, fp[np.maximum(at, 0)], fp[0] if first is None else first)
        last, first = key[-1], head[-1]
        use = head != fp
        yield pa.RecordBatch.from_arrays([pa.array(fp[use]), pa.array(head[use])], names=["a", "b"])


def links(fps: DataFrame, max_bits: int = MAX_BITS, run: int = RUN) -> DataFrame:
    """Distinct fingerprints ``fps(fp)`` -> edges (a, b) that span the same components as all links."""
    if not 0 <= max_bits <= 4:
        raise ValueError("two of three Golay segments guarantee links of at most 4 bits")
    keyed = fps.mapInArrow(_emit_keys, "key long, fp long")
    found = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        lambda batches: link_runs(batches, max_bits, run), "a long, b long").distinct()
    found = store(found, "links")
    edges = found.where("b IS NOT NULL")
    crowded = found.where("b IS NULL").select(F.col("a").alias("fp"))
    if crowded.isEmpty():
        return edges
    if max_bits != 4:
        raise ValueError("runs longer than the limit are linked exactly for 4 bits only")
    star = crowded.mapInArrow(_emit_ball, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        link_to_first, "a long, b long").distinct()
    return edges.unionByName(star)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, run: int = RUN) -> DataFrame:
    """(doc_id, key, fp, component_id) for every document row; component_id is the smallest doc_id reachable."""
    prints = store(with_fingerprints(docs, shingle), "fingerprints")
    per_fp = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
    joined = components(links(per_fp.select("fp"), max_bits, run))
    label = joined.withColumnRenamed("node", "fp").join(per_fp, "fp")
    label = label.join(label.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    of = store(per_fp.join(label, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "of")
    return prints.join(of, "fp").select("doc_id", "key", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, with one row kept of each group: that of the smallest doc_id (ties: smallest row hash)."""
    found = store(near_duplicates(docs, shingle, max_bits), "groups")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("m"))
    keep = first.select(F.col("m.doc_id").alias("k_doc"), F.col("m.key").alias("k_key"))
    return keep_rows(docs, keep)


def keep_rows(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of docs named by keep(k_doc, k_key), exact repeats once, in docs' columns.

    Only the narrow (doc_id, key) columns decide; repeats are cut to one before
    the shuffle (rank limit), so a row repeated a million times moves once.
    """
    from pyspark.sql import Window

    from repo_pulse.llm.common import fresh

    k, n, r = fresh(docs, "_key"), fresh(docs, "_id"), fresh(docs, "_rank")
    d = docs.withColumn(k, row_key(docs)).withColumn(n, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)))
    d = d.withColumn(r, F.row_number().over(Window.partitionBy(n, k).orderBy(F.lit(0)))).where(F.col(r) == 1)
    keep = keep.select(F.coalesce("k_doc", F.lit(-1)).alias(n), F.col("k_key").alias(k))
    return d.join(keep, [n, k], "left_semi").select(docs.columns)


def op5(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
