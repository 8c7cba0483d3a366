"""Operator 13: Merkle manifest of a dataset, by checkpoint and recompute.

Every document is a leaf: the digest of its fields. Per source, the leaves in
order of doc_id are hashed in runs of ``FANOUT``, level by level, to the
source's root; the roots of the sources, in order of source, are hashed the
same way to the dataset's root. A proof of a document is the digests of its
run's other members on every level: with it and the leaf alone the root can be
computed again, and a changed document does not give it.

Only every ``STRIDE``-th level is persisted (and the leaves): one digest of
FANOUT ** STRIDE, not one of FANOUT, is written and kept. Proofs go from the
top down: an aligned subtree between two persisted levels is read as its
lowest nodes, its missing interior nodes are computed again in the task, each
lowest node's siblings are emitted below the path of the subtree's own root,
and the interior is dropped.

Scale. A leaf's position comes from a range sort by (source, doc_id, leaf) and
the row counts of its partitions, so a source of a third of all rows is
sorted, counted, cut and proven by many tasks; positions within partitions are
numbered by Spark. A subtree has at most FANOUT ** STRIDE nodes of about 100
bytes, whatever the size of its source. Texts are read and hashed by Spark
once and never shuffled. Persisted tables shrink by FANOUT ** STRIDE per
round, so there are log rounds.

Rows: each row is a leaf; NULL fields count as ``-``, so NULL and empty texts
differ. NULL doc_ids come first. Rows with the same doc_id are ordered by leaf
digest; equal rows are leaves of their own with equal digests, whose proofs
differ by position and are dealt arbitrarily. A NULL source is a source of its
own and the first. Rows without doc_id are not tampered with. Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from repo_pulse.llm.common import store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
STRIDE = 7  # levels from one persisted level to the next
ALL = ""  # the tree of the sources' roots


# ---------------------------------------------------------------- digests

def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` or UTF-8 byte count, colon, value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(fields[n]) for n in FIELDS]).cast("binary"), 256)


def source_key(source: Column) -> Column:
    """A string that is never NULL, equal only for equal sources, and sorts as they do, NULL first."""
    return F.coalesce(F.concat(F.lit("."), source.cast("string")), F.lit(ALL))


# ---------------------------------------------------------------- positions

def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """rows with ``pos`` (from 0) and ``width`` (rows) in their group, by ``order``; stored."""
    spread = rows.repartitionByRange(group, *order, F.xxhash64("uid")).sortWithinPartitions(group, *order, F.xxhash64("uid"))
    spread = store(spread.drop("uid").withColumn("at", F.monotonically_increasing_id()), "sorted")  # partition number and row number
    part = F.shiftright("at", 33)
    runs = spread.groupBy(F.col(group).alias("g"), part.alias("p")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    each = Window.partitionBy("g").orderBy("p")  # at most one row a partition
    runs = runs.select("g", "p", (F.sum("n").over(each) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("g")).alias("width"))
    out = spread.join(runs, (F.col(group) == F.col("g")) & (part == F.col("p")))
    return out.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "g", "p", "shift")


# ---------------------------------------------------------------- trees

def runs_of(nodes: list[str]) -> list[list[str]]:
    return [nodes[i:i + FANOUT] for i in range(0, len(nodes), FANOUT)]


def levels_left(width: int) -> int:
    """Levels from ``width`` nodes to the one that remains."""
    n = 0
    while width > 1:
        width, n = -(-width // FANOUT), n + 1
    return n


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """An aligned subtree from its lowest nodes: all its levels, lowest first."""
    out = [nodes]
    for _ in range(levels):
        out.append([_h(*run) for run in runs_of(out[-1])])
    return out


def path_of(levels: list[list[str]], at: int) -> str:
    """One ``/``-ended step a level: the run of a lowest node with ``*`` for its own branch."""
    steps = []
    for nodes in levels[:-1]:
        first = at - at % FANOUT
        steps.append("".join("*" if i == at else nodes[i] for i in range(first, min(first + FANOUT, len(nodes)))) + "/")
        at //= FANOUT
    return "".join(steps)


def siblings(path: str) -> str:
    return path.replace("*", "").replace("/", "")


def fold(digest: str, path: str) -> str:
    """The root that a leaf and the siblings of its path give."""
    for step in path.split("/")[:-1]:
        digest = _h(step.replace("*", digest))
    return digest


def _blocks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[tuple]]:
    """Rows of one (group, block) at a time, from rows sorted by both."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*[b.column(c).to_pylist() for c in ("group", "block", *columns)]):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[tuple], schema: pa.Schema, n: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _in_blocks(nodes: DataFrame, stride: int, *order: str) -> DataFrame:
    """Whole aligned subtrees to a task, in order."""
    block = F.floor(F.col("pos") / F.lit(FANOUT ** stride)).cast("long") if "block" not in nodes.columns else F.col("block")
    return nodes.withColumn("block", block).repartition("group", "block").sortWithinPartitions("group", "block", *order)


NODES = "group string, pos long, width long, digest string"


def raised(nodes: DataFrame, stride: int) -> DataFrame:
    """The nodes ``stride`` levels above nodes(group, pos, width, digest), or the roots if these come first."""
    schema = to_arrow_schema(StructType.fromDDL(NODES))

    def run(batches):
        def rows():
            for held in _blocks(batches, "width", "digest"):
                group, block, width, _ = held[0]
                levels = min(stride, levels_left(width))
                for _ in range(levels):
                    width = -(-width // FANOUT)
                yield group, block, width, subtree([r[3] for r in held], levels)[-1][0]

        yield from _batched(rows(), schema)

    return _in_blocks(nodes.select("group", "pos", "width", "digest"), stride, "pos").mapInArrow(run, NODES)


def checkpoints(nodes: DataFrame, stride: int) -> list[DataFrame]:
    """The persisted levels above ``nodes`` (itself the first), up to the one of roots alone."""
    out = [nodes]
    while out[-1].where("width > 1").limit(1).count():
        out.append(store(raised(out[-1], stride), "level"))
    return out


def extracted(nodes: DataFrame, above: DataFrame, stride: int, carried: str = "") -> DataFrame:
    """nodes with the path of each to the root, and the root; ``carried``: further columns of nodes (DDL).

    above(group, pos, path, root): the next persisted level with its paths. The
    interior of each subtree is computed here, read off and dropped.
    """
    ddl = NODES + ", path string, root string" + (f", {carried}" if carried else "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    more = [n.split()[0] for n in carried.split(", ")] if carried else []
    inner = nodes.select("group", F.floor(F.col("pos") / F.lit(FANOUT ** stride)).cast("long").alias("block"), F.lit(1).alias("kind"), "pos", "width", "digest",
                         F.lit("").alias("path"), F.lit("").alias("root"), *more)
    heads = above.select("group", F.col("pos").alias("block"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("width"),
                         F.lit("").alias("digest"), "path", "root", *[F.lit(None).cast(nodes.schema[n].dataType).alias(n) for n in more])

    def run(batches):
        def rows():
            for head, *held in _blocks(batches, "kind", "pos", "width", "digest", "path", "root", *more):
                path, root = head[6], head[7]
                levels = subtree([r[5] for r in held], min(stride, levels_left(held[0][4])))
                for i, r in enumerate(held):
                    yield r[0], r[3], r[4], r[5], path_of(levels, i) + path, root, *r[8:]

        yield from _batched(rows(), schema, 1024)

    return _in_blocks(inner.unionByName(heads), stride, "kind", "pos").mapInArrow(run, ddl)


def with_paths(nodes: DataFrame, stride: int, above: DataFrame | None = None, levels: list[DataFrame] | None = None, carried: str = "") -> DataFrame:
    """Every node of nodes(group, pos, width, digest) with its path and root, from the persisted levels down.

    above(group, path, root): the path of each group's root in a tree above, if there is one.
    """
    levels = levels or checkpoints(nodes, stride)
    top = levels[-1].select("group", "pos", "digest")
    if above is None:
        top = top.select("group", "pos", F.lit("").alias("path"), F.col("digest").alias("root"))
    else:
        top = top.select("group", "pos").join(above.select("group", "path", "root"), "group")
    if len(levels) == 1:  # roots only
        return levels[0].join(top, ["group", "pos"])
    for level in levels[-2:0:-1]:
        top = store(extracted(level, top, stride), "paths")
    return extracted(levels[0], top, stride, carried)


# ---------------------------------------------------------------- documents

def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, group, digest of each document, and the digest after tampering (NULL where it stays)."""
    fields = {n: F.col(n) for n in FIELDS}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    hit = hit & F.contains(F.col("text").cast("string"), F.lit("\n"))
    torn = fields | {"text": F.translate(F.col("text").cast("string"), "\n", "")}
    return docs.select("doc_id", source_key(F.col("source")).alias("group"), leaf(fields).alias("digest"), F.when(hit, leaf(torn)).alias("tampered"),
                       F.monotonically_increasing_id().alias("uid"))


def manifest(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """doc_id, group, digest, tampered, subroot, root, path of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = F.col("doc_id")
    nodes = store(numbered(store(leaves(docs), "digests"), "group", "doc_id", "digest").select("group", "pos", "width", "digest", first, "tampered"), "leaves")
    levels = checkpoints(nodes, stride)
    subroots = levels[-1].select(F.lit(ALL).alias("group"), F.col("group").alias("source_key"), "digest", F.lit(0).alias("uid"))
    tops = numbered(subroots, "group", "source_key").select("group", "pos", "width", "digest", "source_key")
    tops = store(tops, "subroots")
    above = with_paths(tops, stride, carried="source_key string")
    above = store(above.select(F.col("source_key").alias("group"), F.col("digest").alias("subroot"), "path", "root"), "tops")
    out = with_paths(nodes, stride, above, levels, f"doc_id {kind}, tampered string")
    return out.join(above.select("group", "subroot"), "group")


def verified(proofs: DataFrame) -> DataFrame:
    """manifest() rows -> the digest of each proof, and the root that the (tampered) leaf gives."""

    @F.pandas_udf("proof_sha256 string, folded_root string")
    def check(path, digest):
        import pandas as pd

        return pd.DataFrame({"proof_sha256": [_h(siblings(p)) for p in path], "folded_root": [fold(d, p) for d, p in zip(digest, path)]})

    out = proofs.withColumn("c", check("path", F.coalesce("tampered", "digest")))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "c.proof_sha256", "c.folded_root", (F.col("c.folded_root") == F.col("root")).alias("verified"))


def op13(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    return verified(manifest(docs))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
    text, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) & 1 AS odd
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS tampered
  FROM (SELECT *, CASE WHEN odd = 1 THEN replace(text, chr(10), '') ELSE text END AS t FROM d)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), up(source, level, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY pos) FROM placed GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM up WHERE len(nodes) > 1
), subs AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE len(nodes) = 1
), top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM subs HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM top WHERE len(nodes) > 1
), steps AS (
  SELECT p.doc_id, p.source, p.pos, u.level, (p.pos // (3 ** u.level)::BIGINT)::BIGINT AS spot, u.nodes
  FROM placed p JOIN up u ON u.source IS NOT DISTINCT FROM p.source AND len(u.nodes) > 1
  UNION ALL
  SELECT p.doc_id, p.source, p.pos, 1000 + t.level, (s.pos // (3 ** t.level)::BIGINT)::BIGINT, t.nodes
  FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN top t ON len(t.nodes) > 1
), paths AS (
  SELECT source, pos, list({'b': coalesce(array_to_string(nodes[spot - spot % 3 + 1:spot], ''), ''), 'a': coalesce(array_to_string(nodes[spot + 2:spot - spot % 3 + 3], ''), '')} ORDER BY level) AS path
  FROM steps GROUP BY source, pos
)
SELECT p.doc_id, p.leaf, s.subroot, r.nodes[1] AS root,
  sha256(coalesce(array_to_string(list_transform(path, lambda x: x.b || x.a), ''), '')) AS proof_sha256,
  list_reduce(list_prepend({'b': p.tampered, 'a': ''}, coalesce(path, [])), lambda x, y: {'b': sha256(y.b || x.b || y.a), 'a': ''}).b AS folded_root,
  list_reduce(list_prepend({'b': p.tampered, 'a': ''}, coalesce(path, [])), lambda x, y: {'b': sha256(y.b || x.b || y.a), 'a': ''}).b = r.nodes[1] AS verified
FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN top r ON len(r.nodes) = 1
LEFT JOIN paths h ON h.source IS NOT DISTINCT FROM p.source AND h.pos = p.pos
"""
