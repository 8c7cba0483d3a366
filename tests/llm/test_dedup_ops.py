"""Operators 5 to 9 and the pipeline against brute force."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import edge_rows, prose, rows_of, same, table
from repo_pulse.llm import golay, tokens
from repo_pulse.llm import op5_simhash as op5
from repo_pulse.llm import op6_kneser_ney as op6
from repo_pulse.llm import op7_line_dedup as op7
from repo_pulse.llm import op8_neighbours as op8
from repo_pulse.llm import op9_packing as op9
from repo_pulse.llm.common import row_key
from repo_pulse.llm.components import components


@pytest.fixture(scope="module")
def edge(spark):
    return table(spark, edge_rows()).cache()


# ---- 5


def test_golay_keys_meet_within_two_bits():
    near = [0] + [sum(1 << i for i in at) for n in (1, 2) for at in itertools.combinations(range(23), n)]
    balls = near + [sum(1 << i for i in at) for at in itertools.combinations(range(23), 3)]
    x = np.array(balls)
    kx, nx = golay.keys(x)
    slot = np.arange(6)
    for e in near:
        ky, ny = golay.keys(x ^ e)
        hit = (kx[:, :, None] == ky[:, None, :]) & (slot[None, :, None] < nx[:, None, None]) & (slot[None, None, :] < ny[:, None, None])
        assert hit.any(axis=(1, 2)).all()
    assert len(set(golay.CODEWORDS.tolist())) == 4096 and set(np.bitwise_count(golay.CODEWORDS).tolist()) == {0, 7, 8, 11, 12, 15, 16, 23}


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def near_rows():
    r = random.Random(5)
    rows = list(edge_rows())
    for g in range(12):
        words = prose(50 + g, 150).split()
        for c in range(6):
            copy = list(words)
            for _ in range(c % 4):
                copy[r.randrange(len(copy))] = "changed"
            rows.append((1000 + 10 * g + c, " ".join(copy), "en", "a"))
    return rows


@pytest.mark.parametrize("run", [op5.RUN, 3])
def test_op5_equals_brute_force(spark, run):
    rows = near_rows()
    docs = table(spark, rows)
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    label = brute_components(fps)
    least = {}
    for (d, *_), c in zip(rows, label):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    want = [(d, f"{f:016x}", least.get(c)) for (d, *_), f, c in zip(rows, fps, label)]
    got = op5.near_duplicates(docs, run=run).selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS f", "component_id")
    same([tuple(r) for r in got.collect()], want)


def test_op5_dense_runs_give_the_same_components(spark):
    """Fingerprints a few bits apart: pair, forest and neighbourhood links agree."""
    r = random.Random(1)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(160)} | {r.getrandbits(64) for _ in range(60)})
    want = brute_components(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for run in (4096, 8):
        label = {x.node: x.component for x in components(op5.links(df, run=run)).collect()}
        groups = [label.get(f, f) for f in signed]
        assert {frozenset(i for i, g in enumerate(groups) if g == x) for x in groups} == {frozenset(i for i, g in enumerate(want) if g == x) for x in want}


def test_op5_link_runs_across_batches():
    rows = sorted([(k, f) for k, fs in {1: [0, 1, 3], 2: [5], 3: list(range(40)), 4: [1 << 40, 1 << 50]}.items() for f in fs])
    whole = None
    for size in (1, 3, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:i + size]], pa.int64()), pa.array([f for _, f in rows[i:i + size]], pa.int64())], names=["key", "fp"]) for i in range(0, len(rows), size)]
        out = sorted(p for b in op5.link_runs(iter(batches)) for p in zip(b["a"].to_pylist(), b["b"].to_pylist()))
        whole = whole or out
        assert out == whole
        first = sorted(p for b in op5.link_to_first(iter(batches)) for p in zip(b["a"].to_pylist(), b["b"].to_pylist()))
        assert first == sorted([(1, 0), (3, 0), *[(i, 0) for i in range(1, 40)], (1 << 50, 1 << 40)])


def test_op5_one_per_group(spark):
    docs = table(spark, near_rows())
    kept = op5.one_per_group(docs)
    assert kept.columns == docs.columns
    want = {(r.component_id,) for r in op5.near_duplicates(docs).collect()}
    same(rows_of(kept, "doc_id"), list(want))


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


# ---- 6


def brute_model(texts):
    """Interpolated modified Kneser-Ney from plain dictionaries; returns logp(4-gram)."""
    grams = {op6.ORDER: {}}
    for t in texts:
        u = [op6.START] * 3 + list(np.frombuffer(t.encode("utf-16-le"), "<u2")) + [op6.END]
        for i in range(len(u) - 3):
            g = tuple(int(x) for x in u[i:i + 4])
            grams[4][g] = grams[4].get(g, 0) + 1
    for k in (3, 2, 1):
        grams[k] = {}
        for g in grams[k + 1]:
            grams[k][g[1:]] = grams[k].get(g[1:], 0) + 1
    stats = {}
    for k in range(1, 5):
        n = [sum(1 for c in grams[k].values() if c == i) for i in range(1, 5)]
        d = []
        for i in (1, 2, 3):
            if n[0] and n[i - 1]:
                d.append(max(0.1, min(i, i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1])))
            else:
                d.append(i / 2)
        ctx = {}
        for g, c in grams[k].items():
            total, left, kinds = ctx.get(g[:-1], (0, 0.0, 0))
            ctx[g[:-1]] = total + c, left + d[min(c, 3) - 1], kinds + 1
        stats[k] = d, ctx

    def p(g):
        k = len(g)
        d, ctx = stats[k]
        if g[:-1] not in ctx:
            return p(g[1:])
        total, left, kinds = ctx[g[:-1]]
        lower = p(g[1:]) if k > 1 else 1 / (kinds + 1)
        c = grams[k].get(g, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total + left / total * lower

    return p


def test_op6_equals_brute_force_locally_and_sharded(spark):
    trusted = [prose(i, 12, "abcd") for i in range(30)]
    probe = ["abca dcba", "xyz!", prose(99, 20, "abcde"), "a", None, ""]
    p = brute_model(trusted)

    def want(t):
        if not t:
            return None
        u = [op6.START] * 3 + list(np.frombuffer(t.encode("utf-16-le"), "<u2")) + [op6.END]
        return -sum(math.log(p(tuple(int(x) for x in u[i:i + 4]))) for i in range(len(u) - 3)) / (len(u) - 3)

    train = spark.createDataFrame([("en", t) for t in trusted], "lang string, text string")
    probs, backs = op6.train(train)
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(probe)] + [(50, "abc", "zz", "a"), (51, "abc", None, "a"), (2, probe[2], "en", "a")])
    for limit in (op6.LOCAL_ROWS, 20):
        rows = rows_of(op6.with_log_perplexity(docs, probs, backs, "lp", limit), "doc_id", "lp")
        assert len(rows) == docs.count()
        for i, lp in rows:
            expected = want(probe[i]) if i < 50 else None
            assert (lp is None) == (expected is None) and (lp is None or lp == pytest.approx(expected, abs=1e-9))
    total = {c: sum(math.exp(r.logp) for r in probs.where(f"k = {c}").collect()) for c in (0, 1)}
    assert total[0] + total[1] == pytest.approx(1.0)


def test_op6_rejects_junk_and_keeps_clean(spark, edge):
    clean = [(i, prose(i, 60), "en", "a") for i in range(200)]
    junk = [(1000 + i, " ".join(w.upper() + "##" for w in prose(i, 60).split()), "en", "a") for i in range(10)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 160)] + [(1000, 0), (5, 1), (None, 1)], "doc_id long, quality int")
    docs = table(spark, clean + junk)
    got = dict(rows_of(op6.op6(docs, labels), "doc_id", "kept"))
    assert all(got[d] for d, *_ in clean) and not any(got[d] for d, *_ in junk)
    out = op6.classify(edge, op6.trusted_ids(labels.limit(0)), score="_s", threshold="_t", kept="_k")
    assert out.count() == edge.count() and out.where("NOT _k").count() == 0


def test_op6_quantile_of_histogram(spark):
    df = spark.createDataFrame([("a", i / 1000) for i in range(1000)] + [("b", 2.0), ("b", None)], "lang string, lp double")
    got = dict(rows_of(op6.thresholds(df, "lp", 0.9, 0.0), "lang", "threshold"))
    assert got["a"] == pytest.approx(0.9, abs=0.0021) and got["b"] == pytest.approx(2.001)


def test_op6_every_trusted_document_is_scored_by_the_other_folds(spark):
    texts = [(i, prose(i, 12, "abcd")) for i in range(24)]
    fold = {i: zlib.crc32(str(i).encode()) % op6.FOLDS for i, _ in texts}
    want = []
    for i, t in texts:
        p = brute_model([x for j, x in texts if fold[j] != fold[i]])
        u = [op6.START] * 3 + list(np.frombuffer(t.encode("utf-16-le"), "<u2")) + [op6.END]
        want.append(-sum(math.log(p(tuple(int(x) for x in u[k:k + 4]))) for k in range(len(u) - 3)) / (len(u) - 3))
    held = op6.cross_fit(spark.createDataFrame([(i, "en", t) for i, t in texts], "doc_id long, lang string, text string"))[0]
    got = sorted(x for _, x in rows_of(held, "lang", "lp"))
    assert got == pytest.approx(sorted(want), abs=1e-9)


# ---- 7


def test_op7_drops_recurring_lines_but_the_first(spark):
    line = "all rights reserved by the owner of this page 2020"
    other = "all rights reserved by the owner of this page 1999"  # same template: digits are fields
    near = "all rights reserved by the holder of this page 7"  # generalised by the tree
    docs = table(spark, [
        (1, f"{prose(1, 9)}\n{line}\nshort line", "en", "a"), (2, f"{line}\n{prose(2, 9)}\nshort line", "en", "a"),
        (3, f"{other}\n{other}\n{prose(3, 9)}", "en", "a"), (4, near, "en", "a"), (5, None, "en", "a"), (6, prose(6, 9), "en", "a")])
    got = dict(rows_of(op7.line_dedup(docs), "doc_id", "text"))
    assert got == {1: f"{prose(1, 9)}\n{line}\nshort line", 2: prose(2, 9), 3: prose(3, 9), 4: "", 5: None, 6: prose(6, 9)}


def test_op7_exact_lines_equal_brute_force(spark, edge):
    rows = edge_rows() + [(500 + i, "\n".join(prose(j, 8) for j in (i, i + 1, i + 2)), "en", "a") for i in range(40)]
    docs = table(spark, rows)
    first = {}
    forms = lambda t: [" ".join(op7.masked(x)) for x in (t or "").split("\n")]
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for f in forms(t):
            if f:
                first.setdefault(f, d)
    want = []
    for d, t, *_ in rows:
        keep = [x for x, f in zip((t or "").split("\n"), forms(t)) if not f or first[f] == d]
        want.append((d, None if t is None else "\n".join(keep)))
    out = op7.line_dedup(docs)
    assert out.columns == docs.columns
    same(rows_of(out, "doc_id", "text"), want)


def test_op7_min_docs(spark):
    line = "this line is found in two documents"
    docs = table(spark, [(1, line, "en", "a"), (2, line, "en", "a"), (3, prose(1, 10), "en", "a")])
    assert dict(rows_of(op7.line_dedup(docs, min_docs=3), "doc_id", "text"))[2] == line


def test_op7_rows_of_numbers_recur_only_as_they_are(spark):
    docs = table(spark, [(1, "12 40 3 7 9\nBerlin 4 5 6 7", "en", "a"), (2, "2019 1 5 8 33\nBerlin 8 8 8 9", "en", "a"), (3, "12 40 3  7 9", "en", "a"),
                         (4, "2019 1 5 8 34", "en", "a")])
    got = dict(rows_of(op7.line_dedup(docs), "doc_id", "text"))
    assert got == {1: "12 40 3 7 9\nBerlin 4 5 6 7", 2: "2019 1 5 8 33\nBerlin 8 8 8 9", 3: "", 4: "2019 1 5 8 34"}


def test_op7_short_lines_recur_as_others_do(spark):
    docs = table(spark, [(i, f"{prose(i, 9)}\nAll rights reserved.\n\u7248\u6743\u6240\u6709\n{'two only' if i < 3 else prose(50 + i, 2)}", "en", "a") for i in range(1, 6)])
    out = op7.line_dedup(docs, count="n")
    got = dict(rows_of(out, "doc_id", "text"))
    assert got.pop(1) == f"{prose(1, 9)}\nAll rights reserved.\n\u7248\u6743\u6240\u6709\ntwo only"
    assert got == {i: prose(i, 9) + ("" if i < 3 else "\n" + prose(50 + i, 2)) for i in range(2, 6)}
    assert dict(rows_of(out, "doc_id", "n")) == {1: 0, 2: 3, 3: 2, 4: 2, 5: 2}


def test_op7_counts_every_dropped_line(spark):
    docs = table(spark, [(1, "one two three", "en", "a"), (2, "one two three\nfour\none two three", "en", "a")])
    assert sorted(rows_of(op7.op7(docs), "doc_id", "text", "n_dropped_lines")) == [(1, "one two three", 0), (2, "four", 2)]


def brute_templates(lines, similar):
    """Template of each member line of one leaf, {line: tokens with weight}, by plain dictionaries."""
    nodes, found, turn = [list(lines)], {}, 0
    while nodes:
        after, turn = [], turn + 1
        for node in nodes:
            size = len(lines[node[0]][0])
            n, kinds = {}, {}
            for x in node:
                for c in enumerate(lines[x][0]):
                    n[c], kinds[c] = n.get(c, 0) + lines[x][1], kinds.get(c, 0) + 1
            total = sum(lines[x][1] for x in node)
            agree = {x: sum(2 * n[c] > total and c[1] != op7.FIELD for c in enumerate(lines[x][0])) for x in node}
            took = [x for x in node if agree[x] and agree[x] >= similar * size]
            found.update({x: min(took) for x in took})
            part = [c for c in n if 1 < kinds[c] < len(node)]
            if took:
                after.append([x for x in node if x not in took])
            elif part:
                at = min(part, key=lambda c: (-n[c], c[0]))[0]
                child = {}
                for x in node:
                    child.setdefault(lines[x][0][at] if 1 < kinds[at, lines[x][0][at]] < len(node) else None, []).append(x)
                after += child.values()
        nodes = [x for x in after if len(x) > 1]
    return found


@pytest.mark.parametrize("weight", [op7.WEIGHT, 150])
def test_op7_templates_equal_brute_force(spark, weight):
    """Both ways, in a task and by grouped rounds, give the templates of plain dictionaries."""
    r = random.Random(3)
    texts = {}
    for leaf in range(12):
        for _ in range(r.randint(2, 25)):
            texts[" ".join(["it", "is", str(leaf) + "th"] + [r.choice("abcd") if r.random() < 0.8 else r.choice(["<*>", "q%d" % r.randint(0, 99)]) for _ in range(6)])] = (leaf, r.randint(1, 9))
    rows = [(leaf, i, n, t) for i, (t, (leaf, n)) in enumerate(texts.items())]
    want = {}
    for leaf in range(12):
        want |= brute_templates({i: (t.split(), n) for at, i, n, t in rows if at == leaf}, 0.7)
    df = spark.createDataFrame([x for at, i, n, t in rows for x in [(at, i, 1, t)] * n], "node long, line long, docs long, masked string")
    if weight < op7.WEIGHT:
        merged = df.groupBy("node", "line", "masked").agg(F.sum("docs").alias("docs"))
        out = op7.members(merged, 0.7, weight)
    else:
        out = op7.settle(df, 0.7, weight)
    groups = lambda pairs: sorted(sorted(x for x, t in pairs if t == g) for g in {t for _, t in pairs})
    got = [tuple(x) for x in out.collect()]
    assert len(want) > 30 and groups(got) == groups(list(want.items()))


def test_op7_is_the_same_by_either_way(spark, edge):
    docs = table(spark, edge_rows() + [(500 + i, "\n".join(f"line {j} of part {prose(j % 7, 3)} and {prose(j, 2)}" for j in range(i, i + 9)), "en", "a") for i in range(40)])
    same(rows_of(op7.op7(docs), "doc_id", "text", "n_dropped_lines"), rows_of(op7.line_dedup(docs, count="n", weight=40), "doc_id", "text", "n"))


def test_op7_several_templates_in_a_leaf(spark):
    """Three templates with a common opening, none with a majority, and a hot line in the same leaf."""
    ends = ["by {} for the quiet garden behind old walls", "after {} left our harbour on its last trip", "under {} when seven rivers froze over that winter"]
    names = [["anna", "bert", "cora"], ["dora", "emil", "fritz"], ["gerd", "hanna", "ida"]]
    rows = [(10 * i + j, "it was written " + e.format(n), "en", "a") for i, e in enumerate(ends, 1) for j, n in enumerate(names[i - 1])]
    hot = "it was written somewhere that nobody ever reads such long lines again"
    rows += [(100 + i, hot, "en", "a") for i in range(30)]
    got = dict(rows_of(op7.line_dedup(table(spark, rows)), "doc_id", "text"))
    assert {d for d, t in got.items() if t} == {10, 20, 30, 100}


# ---- 8


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_nearest(rows):
    ok = [(i, np.asarray(v, float)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % 50 == 0:
            s = [(-float(q @ v) / math.sqrt(float(q @ q) * float(v @ v)), j) for j, v in ok if j != i and len(v) == len(q)]
            out[i] = sorted((round(x, 9), j) for x, j in s)[:5]
    return out


def test_op8_recall_ties_and_invalid_vectors(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * r.normal(size=16)).astype(np.float32).tolist(), 0) for i in range(3000)]
    rows += [(5000 + i, rows[50][1], 0) for i in range(8)]  # ties go to the smaller id
    rows += [(10000, None, 0), (10050, [0.0] * 16, 0), (10100, [float("nan")] * 16, 0), (10150, [None] * 16, 0), (10200, [], 0), (None, rows[0][1], 0)]
    want = brute_nearest(rows)
    got = {}
    for x in op8.op8(vectors(spark, rows)).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    hit = sum(len({j for _, j, _ in got[i]} & {j for _, j in want[i]}) for i in want)
    assert hit / (5 * len(want)) >= 0.9 and set(got) == set(want)
    score = {(i, j): -s for i in want for s, j in want[i]}
    assert all(abs(s - score[i, j]) < 1e-9 for i in got for _, j, s in got[i] if (i, j) in score)
    assert [j for _, j, _ in sorted(got[50])] == [5000, 5001, 5002, 5003, 5004]


def test_op8_many_leaves_and_few_candidates(spark, monkeypatch):
    for name, value in (("LEAF_ROWS", 128), ("BLOCK_ROWS", 64), ("QUERY_BLOCK", 4)):
        monkeypatch.setattr(op8, name, value)
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=12).tolist(), 0) for i in range(1500)]
    want = brute_nearest(rows)
    got = rows_of(op8.op8(vectors(spark, rows)), "query_id", "vec_id")
    assert sum((i, j) in set(got) for i in want for _, j in want[i]) / (5 * len(want)) >= 0.9 and len(got) == 5 * len(want)
    few = [(0, [1.0, 0.0], 0), (1, [0.0, 2.0], 0), (2, [3.0, 0.0], 0), (3, [1.0, 1.0, 1.0], 0)]
    same(rows_of(op8.op8(vectors(spark, few)), "query_id", "rank", "vec_id"), [(0, 1, 2), (0, 2, 1)])
    assert op8.op8(vectors(spark, [])).collect() == []


# ---- 9


def test_encoder_equals_library():
    e = tokens.Encoder(tokens.default_path(), cache=5)
    for t in [*(r[1] or "" for r in edge_rows()), "it's don't WE'LL 123 ß÷× a<|endoftext|>b \x1c!  x é İ", "Hello, World!! don't", ""]:
        assert e.ids(t).tolist() == e.library.encode(t, add_special_tokens=False).ids


def check_packing(pieces, ids_of_rows, window):
    assert sum(p.length for p in pieces) == sum(len(x) for x in ids_of_rows)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for s in by.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_op9_pieces_cover_every_document(spark, edge):
    e = tokens.encoder(tokens.default_path())
    rows = edge_rows()
    ids = [np.append(e.ids(t or ""), np.uint32(1)) for _, t, *_ in rows]
    pieces = op9.op9(edge).collect()
    assert check_packing(pieces, ids, 2048) == 0
    for d in {r[0] for r in rows if r[0] not in (None, 1)}:
        want = next(x for r, x in zip(rows, ids) if r[0] == d)
        mine = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
        assert [p.start for p in mine] == [sum(q.length for q in mine[:i]) for i in range(len(mine))]
        assert all(p.doc_tokens == len(want) and p.ids_crc32 == zlib.crc32(want[p.start:p.start + p.length].astype("<u4").tobytes()) for p in mine)
        assert sum(p.length for p in mine) == len(want)


@pytest.mark.parametrize("sizes", [[700] * 900, list(range(1, 300)), [2047] * 40 + [1] * 3, [5], []])
def test_op9_packs_any_lengths_without_padding(spark, sizes):
    docs = table(spark, [(i, "x" * (n - 1), "en", "a") for i, n in enumerate(sizes)])
    out = op9.pack(docs, ids_of=lambda t: np.full(len(t), 7, "<u4"), window=2048, block=1 << 16).collect()
    assert check_packing(out, [np.zeros(n) for n in sizes], 2048) == 0


def test_op9_fill_is_the_best_subset():
    r = random.Random(3)
    for _ in range(60):
        lengths = sorted(r.sample(range(1, 60), r.randint(1, 5)), reverse=True)
        counts = [r.randint(1, 3) for _ in lengths]
        chosen = op9.fill(lengths, counts, 64)
        assert all(n <= counts[i] for i, n in chosen) and any(i == 0 for i, _ in chosen)
        got = sum(lengths[i] * n for i, n in chosen)
        best = max(t for c in itertools.product(*[range(n + 1) for n in counts]) if c[0] and (t := sum(a * b for a, b in zip(lengths, c))) <= 64)
        assert got == best


# ---- pipeline


def test_pipeline_stages_and_run(spark, tmp_path):
    clean = [(i, prose(i, 60 + i % 40), "en", f"s{i % 4}") for i in range(150)]
    junk = [(1000 + i, " ".join(w.upper() + "##" for w in prose(i, 60).split()), "en", "s0") for i in range(8)]
    shared = "this very line is shared by many of the documents here"
    rows = [(d, f"{t}\n{shared}" if d % 10 == 0 else t, lang, s) for d, t, lang, s in clean] + junk
    rows += [(2000 + i, clean[i + 1][1], "en", "s1") for i in range(5)] + [(3000, None, None, None), (3001, "", "en", None)]
    docs = table(spark, rows)
    d = str(tmp_path)
    docs.coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = []
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, d)
        assert now.columns == docs.columns, name
        now = spark.createDataFrame(now.collect(), now.schema)
        seen.append({r.doc_id: r.text for r in now.collect()})
    kept, lines, one, mixed = seen
    assert set(kept) == {r[0] for r in rows} - {r[0] for r in junk}
    assert sum(shared in (t or "") for t in lines.values()) == 1 and set(lines) == set(kept)
    # brute force: one document of each group by fingerprint
    ids = sorted(lines)
    label = brute_components([brute_fingerprint(lines[i]) for i in ids])
    assert set(one) == {ids[c] for c in set(label)}
    assert set(mixed) <= set(one)
    e = tokens.encoder(tokens.default_path())
    copies = [r for r in now.collect()]
    out = corpus_pipeline.run(spark, d)
    total = sum(r.length for r in out.collect())
    assert total == sum(len(e.ids(r.text or "")) + 1 for r in copies)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark):
    empty = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op5.op5(empty).collect() == [] and op5.one_per_group(empty).collect() == []
    assert op6.op6(empty, labels).collect() == [] and op7.op7(empty).collect() == [] and op9.op9(empty).collect() == []


def test_row_key_is_shared(spark, edge):
    assert edge.select(row_key(edge).alias("k")).distinct().count() == len({r for r in edge_rows()})
