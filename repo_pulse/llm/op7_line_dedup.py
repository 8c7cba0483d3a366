"""Operator 7: line dedup with a fixed-depth log-template tree.

A line's tokens that hold a digit are variable fields (``<*>``). The tree's
path is the token count and the first ``DEPTH`` tokens; a leaf's template
keeps, position by position, the token that over half of the leaf's lines
agree on, and generalises all other positions. Its members are taken out and
the rest has its next template; lines without a majority are split by a
frequent token, so a leaf has as many templates as it needs. A line belongs to a
template if at least ``SIMILAR`` of its tokens are words equal to the
template's (a field is no agreement); any other line is a template of its own
(its masked form). A line with fewer words than that share, such as a row of
numbers, is not masked: only exact repeats of it recur. Templates found in
``MIN_DOCS`` documents or more recur: their lines are dropped from every
document but the first (smallest doc_id), so no text is lost everywhere.
Lines without a token are left alone; all others recur by the same rule.

Scale: a document gives one narrow (leaf, line hash) row per distinct line;
documents per line and per leaf are pre-aggregated counts. Line texts are
only taken from the leaves that can have a template of several lines, added up
within each task. Leaves of up to ``WEIGHT`` characters of distinct lines are
dealt out whole and settled in one streaming pass; a larger leaf is counted by
(leaf, position, token) in grouped rounds, at most one split a token, until its
parts are as small: the same templates either way. A line in a third of all
documents is one pre-aggregated count and an AQE-split join.

Rows: NULL text stays NULL; a document that loses all lines keeps its row
with an empty text; exact repeats of the first row count as documents, and
all keep their lines; an empty table gives an empty result; other columns
pass through. Documents without a dropped line keep their exact text.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import fresh, row_key, store

DEPTH = 3
SIMILAR = 0.7
MIN_DOCS = 2
WEIGHT = 1_000_000  # characters of a node's distinct lines up to which one task settles it; larger nodes are first split by grouped counts
LEAVES = 2_000_000  # leaves up to this number are broadcast (16 MB); more are joined by a shuffle
FIELD = "<*>"
DIGIT = re.compile(r"[0-9]")


def _hash(text: str, seed: int = 0) -> int:
    n = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)
    return n - (1 << 64) if n >> 63 else n


def masked(line: str) -> list[str]:
    """Tokens of a line, variable fields replaced."""
    found = line.split()
    return [FIELD if DIGIT.search(t) else t for t in found] if DIGIT.search(line) else found


def form(line: str) -> tuple[list[str], bool]:
    """Masked tokens and True, or the tokens as they are and False where masking leaves too few words to tell lines apart."""
    tokens = masked(line)
    if tokens.count(FIELD) > (1 - SIMILAR) * len(tokens) + 1e-9:
        return line.split(), False
    return tokens, True


def path(tokens: list[str], depth: int) -> int:
    """The tree's leaf: token count and leading tokens."""
    return _hash("\x00".join([str(len(tokens)), *tokens[:depth]]), 1)


def line_hashes(text: str, depth: int) -> list[tuple[int, int, str] | None]:
    """(leaf, line hash, line's form) of each line, None for those without a token; a line that is not masked is a leaf of its own."""
    out = []
    for line in text.split("\n"):
        tokens, is_masked = form(line)
        joined = " ".join(tokens)
        out.append((path(tokens, depth if is_masked else len(tokens)), _hash(joined), joined) if tokens else None)
    return out


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), row_key(docs).alias("key"), F.col("text").cast("string").alias("text"))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """Distinct lines of each document: (id, key, leaf, line, size), size in characters of the line's form."""
    names = ["id", "key", "leaf", "line", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for b in batches:
            for i, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                out += [(i, key, at, h, len(joined)) for at, h, joined in set(filter(None, line_hashes(text.as_py() or "", depth)))]
                if len(out) > 50_000:
                    yield _batch(out, names)
                    out = []
        yield _batch(out, names)

    return _narrow(docs).mapInArrow(run, "id long, key long, leaf long, line long, size long")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n == "masked" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(names), kinds)], names=names)


def _forms(docs: DataFrame, depth: int, leaves: DataFrame, n_leaves: int) -> tuple[DataFrame, Broadcast | None]:
    """(node, line, docs, masked) of the lines of these leaves, documents added up in each task, and the broadcast to destroy after use."""
    known = None
    if n_leaves <= LEAVES:  # a proven bound: other lines then never leave their task
        known = docs.sparkSession.sparkContext.broadcast(np.sort(leaves.select("leaf").toArrow()["leaf"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value if known else None
        names = ["node", "line", "docs", "masked"]
        seen: dict[tuple, int] = {}
        held = 0
        for b in batches:
            for text in b.column(2):
                lines = list(set(filter(None, line_hashes(text.as_py() or "", depth))))
                if wanted is not None and lines:
                    paths = np.array([x[0] for x in lines])
                    lines = [x for x, w in zip(lines, wanted[np.minimum(np.searchsorted(wanted, paths), len(wanted) - 1)] == paths) if w]
                for x in lines:
                    n = seen[x] = seen.get(x, 0) + 1
                    held += len(x[2]) + 100 if n == 1 else 0
                if held > 16_000_000:
                    yield _batch([(at, h, n, joined) for (at, h, joined), n in seen.items()], names)
                    seen, held = {}, 0
        yield _batch([(at, h, n, joined) for (at, h, joined), n in seen.items()], names)

    found = _narrow(docs).mapInArrow(run, "node long, line long, docs long, masked string")
    return (found if known else found.join(leaves.select(F.col("leaf").alias("node")), "node", "left_semi")), known


def first() -> Column:
    """The document that keeps a line: smallest doc_id, NULL last, ties by row hash."""
    return F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "key"))


def rounds(node: np.ndarray, line: np.ndarray, docs: np.ndarray, forms: pa.Array, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """(line, template) of the lines that belong to a majority template; every node is whole.

    A round takes the members of each node's majority template out; a node
    without members is split at the position of the token that most of its
    documents share but not all of its lines: the lines of each token found
    in several lines are a node, all other lines are one. Ends when no node
    has members or such a token. A template's name is its smallest line.
    """
    words = pc.split_pattern(forms, " ")
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    words = words.flatten().dictionary_encode()
    names, field = len(words.dictionary), pc.index(words.dictionary, FIELD).as_py()
    row = np.repeat(np.arange(len(line)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    spot = at * names + words.indices.to_numpy(zero_copy_only=False)  # position and token
    width = int(size.max()) * names
    node, live = np.unique(node, return_inverse=True)[1], np.arange(len(line))
    found = [], []
    while len(live):
        cell, of = np.unique(node[row] * width + spot, return_inverse=True)
        home, n, kinds = cell // width, np.bincount(of, docs[row]), np.bincount(of)
        total, lines = np.bincount(node[live], docs[live]), np.bincount(node[live])
        major = (2 * n > total[home]) & (cell % names != field)
        agree = np.bincount(row, major[of], len(line))[live]
        inside = (agree > 0) & (agree >= similar * size[live])
        member = live[inside]
        took = np.zeros(len(total), bool)
        took[node[member]] = True
        name = np.full(len(total), np.iinfo(np.int64).max)
        np.minimum.at(name, node[member], line[member])
        found[0].append(line[member]), found[1].append(name[node[member]])
        part = (kinds > 1) & (kinds < lines[home]) & ~took[home]
        best = np.flatnonzero(part)
        best = best[np.lexsort((cell[best] % width // names, -n[best], home[best]))]
        best = best[np.unique(home[best], return_index=True)[1]]
        split = np.full(len(total), -1)
        split[home[best]] = cell[best] % width // names
        child = np.full(len(line), -1)
        rest = live[~inside & took[node[live]]]
        child[rest] = node[rest]
        here = np.flatnonzero(spot // names == split[node[row]])
        child[row[here]] = len(total) + np.where(part[of[here]], of[here], len(cell) + node[row[here]])
        live = live[child[live] >= 0]
        _, back, count = np.unique(child[live], return_inverse=True, return_counts=True)
        live, back = live[count[back] > 1], back[count[back] > 1]
        node = np.full(len(line), -1)
        node[live] = np.unique(back, return_inverse=True)[1]
        on = node[row] >= 0
        row, spot = row[on], spot[on]
    return np.concatenate(found[0] or [line[:0]]), np.concatenate(found[1] or [line[:0]])


def settle(texts: DataFrame, similar: float, weight: int = WEIGHT) -> DataFrame:
    """(line, template) as ``rounds`` finds them, from texts(node, line, docs, masked) whose nodes hold at most ``weight`` characters each."""

    def merged(t: pa.Table) -> pa.Table:
        node, line = t["node"].to_numpy(), t["line"].to_numpy()
        new = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (line[1:] != line[:-1])])
        return t.take(new).set_column(2, "docs", pa.array(np.add.reduceat(t["docs"].to_numpy(), new))).combine_chunks()

    def settled(t: pa.Table) -> Iterator[pa.RecordBatch]:
        node = t["node"].to_numpy()
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        before = np.r_[0, np.cumsum(pc.utf8_length(t["masked"]).to_numpy() + 1)][starts] // weight
        cuts = [*starts[np.r_[True, before[1:] != before[:-1]]], len(node)]
        for a, b in zip(cuts, cuts[1:]):  # whole nodes, at most twice the weight
            p = t.slice(a, b - a).combine_chunks()
            found = rounds(p["node"].to_numpy(), p["line"].to_numpy(), p["docs"].to_numpy(), p["masked"].chunk(0), similar)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["line", "template"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = merged(pa.concat_tables([held, t]) if held is not None else t)
            node = held["node"].to_numpy()
            cut = int(np.searchsorted(node, node[-1]))
            if cut and held.nbytes > 4 * weight:  # the last node may go on in the next batch
                yield from settled(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None:
            yield from settled(held)

    texts = texts.select("node", "line", "docs", "masked").repartition("node").sortWithinPartitions("node", "line")
    return texts.mapInArrow(run, "line long, template long")


def members(texts: DataFrame, similar: float, weight: int = WEIGHT) -> DataFrame:
    """``settle`` for nodes of any size: grouped counts by (node, position, token) until each node is small enough for a task.

    A split fixes a position, so a node is split at most once a token.
    """
    word = F.transform(F.split("masked", " "), lambda t: F.when(t != FIELD, F.xxhash64(t)).otherwise(0))
    token = store(texts.select("node", "line", "docs", F.length("masked").alias("weight"), F.size(F.split("masked", " ")).alias("size"),
                               F.posexplode(word).alias("at", "token")), "tokens")
    found, handed = [], []
    for turn in itertools.count():
        share = store(token.groupBy("node", "at", "token").agg(F.sum("docs").alias("n"), F.count("*").alias("kinds")), "shares")
        total = share.where("at = 0").groupBy("node").agg(F.sum("n").alias("total"), F.sum("kinds").alias("lines"))
        share = share.join(total, "node")
        same = token.join(share.where("2 * n > total AND token != 0").select("node", "at", "token"), ["node", "at", "token"])
        same = same.groupBy("node", "line").agg(F.count("*").alias("same"), F.first("size").alias("size"))
        out = store(same.where(F.col("same") >= similar * F.col("size")).select("node", "line"), "members")
        took = out.select("node").distinct()
        found.append(out.select("line", F.xxhash64("node", F.lit(turn)).alias("template")))
        part = share.where("kinds > 1 AND kinds < lines").join(took, "node", "left_anti")
        at = part.groupBy("node").agg(F.max(F.struct("n", (-F.col("at")).alias("back"), "token")).alias("best")).select("node", (-F.col("best.back")).alias("at"))
        several = part.join(at, ["node", "at"]).select("node", "at", "token", F.lit(True).alias("several"))
        child = F.when(F.col("several"), F.xxhash64("node", "at", "token")).otherwise(F.xxhash64("node", "at"))
        child = token.join(at, ["node", "at"]).join(several, ["node", "at", "token"], "left").select("node", "line", "weight", child.alias("child"))
        left = token.where("at = 0").join(took, "node", "left_semi").join(out, ["node", "line"], "left_anti").select("node", "line", "weight", F.col("node").alias("child"))
        left = store(left.unionByName(child), "left")
        some = left.groupBy("child").agg(F.count("*").alias("n"), F.sum("weight").alias("all")).where("n > 1").select("child", (F.col("all") <= weight).alias("small"))
        left = store(left.join(some, "child"), "left")
        handed.append(left.where("small").select("line", F.xxhash64("child", F.lit(turn)).alias("child")))
        left = left.where("NOT small")
        if not left.head(1):
            break
        token = store(token.join(left.select("node", "line", "child"), ["node", "line"])
                      .select(F.col("child").alias("node"), "line", "docs", "weight", "size", "at", "token"), "tokens")
    small = texts.drop("node").join(functools.reduce(DataFrame.unionByName, handed).withColumnRenamed("child", "node"), "line")
    return functools.reduce(DataFrame.unionByName, found).unionByName(settle(small, similar, weight))


def templates(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR, min_docs: int = MIN_DOCS, weight: int = WEIGHT) -> tuple[DataFrame, DataFrame]:
    """The distinct lines of each document, and (line, template, first) of every line whose template recurs."""
    rows = store(_lines(docs, depth), "lines")
    per_line = store(rows.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.max("size").alias("size"), first().alias("first"))
                     .withColumn("several", F.col("docs") >= min_docs), "per_line")
    # leaves where lines of different text together reach the documents they need
    leaves = per_line.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs"), F.sum("size").alias("weight"))
    leaves = store(leaves.where((F.col("kinds") > 1) & (F.col("docs") >= min_docs)).select("leaf", (F.col("weight") <= weight).alias("small")), "leaves")
    n_small, n_large = leaves.agg(F.count_if("small"), F.count_if(~F.col("small"))).first()
    member, used = docs.sparkSession.createDataFrame([], "line long, template long"), []
    if n_small:
        texts, known = _forms(docs, depth, leaves.where("small"), n_small)
        member, used = settle(texts, similar, weight), [known]
    if n_large:
        texts, known = _forms(docs, depth, leaves.where("NOT small"), n_large)
        texts = store(texts.groupBy("node", "line").agg(F.sum("docs").alias("docs"), F.first("masked").alias("masked")), "texts")
        member, used = member.unionByName(members(texts, similar, weight)), [*used, known]
    member = store(member, "member")
    for known in filter(None, used):
        known.destroy()
    of = per_line.join(member, "line", "left").withColumn("template", F.coalesce("template", "line"))
    of = store(of, "template_of")
    # A template's documents: one line found in several settles it, else the distinct documents of its lines are counted.
    settled = of.groupBy("template").agg(F.max("several").alias("several"), F.min("first").alias("first"), F.count("*").alias("kinds"))
    settled = store(settled.where(F.col("several") | (F.col("kinds") > 1)), "settled")
    open_ = settled.where("NOT several").select("template")
    lines = rows.select("id", "key", "line").join(of.select("line", "template").join(open_, "template"), "line")
    if min_docs <= 2:
        spread = lines.groupBy("template").agg(F.min(F.struct("id", "key")).alias("a"), F.max(F.struct("id", "key")).alias("b")).where("a != b")
    else:
        spread = lines.groupBy("template").agg(F.count_distinct(F.struct("id", "key")).alias("n")).where(F.col("n") >= min_docs)
    recurring = settled.where("several").select("template", "first").unionByName(settled.join(spread.select("template"), "template").select("template", "first"))
    return rows, store(of.select("line", "template").join(recurring, "template"), "recurring")


def drop_lines(docs: DataFrame, dropped: DataFrame, depth: int = DEPTH, count: str | None = None) -> DataFrame:
    """docs without the lines named by dropped(id, key, line); ``count`` names a column for the number of dropped lines."""
    per_doc = store(dropped.groupBy("id", "key").agg(F.collect_set("line").alias("gone")), "dropped")
    i, k, gone, new = fresh(docs, "_id"), fresh(docs, "_key"), fresh(docs, "_gone"), fresh(docs, "_new")
    per_doc = per_doc.select(F.coalesce("id", F.lit(-1)).alias(i), F.col("key").alias(k), F.col("gone").alias(gone))

    @F.arrow_udf("struct<text: string, n: long>")
    def without(text: pa.Array, gone: pa.Array) -> pa.Array:
        out, n = [], []
        for t, g in zip(text, gone):
            t, was = t.as_py(), 0
            if t is not None and g.is_valid:
                drop = set(g.as_py())
                lines = t.split("\n")
                kept = [line for line, h in zip(lines, line_hashes(t, depth)) if h is None or h[1] not in drop]
                t, was = "\n".join(kept), len(lines) - len(kept)
            out.append(t), n.append(was)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(n, pa.int64())], names=["text", "n"])

    d = docs.withColumn(i, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn(k, row_key(docs)).join(per_doc, [i, k], "left")
    d = d.withColumn(new, without(F.col("text").cast("string"), F.col(gone))).withColumn("text", F.col(f"`{new}`.text"))
    if count:
        d = d.withColumn(count, F.col(f"`{new}`.n"))
    return d.select(*docs.columns, *([count] if count else []))


def line_dedup(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR, min_docs: int = MIN_DOCS, count: str | None = None, weight: int = WEIGHT) -> DataFrame:
    """docs with recurring lines dropped from all documents but the template's first; ``count`` names a column for the number of dropped lines."""
    rows, recurring = templates(docs, depth, similar, min_docs, weight)
    gone = rows.join(recurring, "line").where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")))).select("id", "key", "line")
    return drop_lines(docs, gone, depth, count)


def op7(docs: DataFrame) -> DataFrame:
    return line_dedup(docs.select("doc_id", "lang", "source", "text"), count="n_dropped_lines").select("doc_id", "text", "n_dropped_lines")
