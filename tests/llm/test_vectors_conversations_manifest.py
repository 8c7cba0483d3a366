"""Operators 11 to 13 against brute force, with NULLs, empty tables, repeats and clashing columns."""

import hashlib
import random
import zlib

import brute_conversations as brute
import numpy as np
import pytest
from helpers import edge_rows, same, table

from repo_pulse.llm import op11_metric_join as op11
from repo_pulse.llm import op12_conversations as op12
from repo_pulse.llm import op13_manifest as op13

# ---------------------------------------------------------------- 11


def links_of(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = [[j for j, (_, w) in enumerate(rows) if i != j and ok[i] and ok[j] and len(v) == len(w) and op11.cosine_of(np.array(v, float), np.array(w, float)) >= least] for i, (_, v) in enumerate(rows)]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        component = min(ids) if ids and ok[i] else vec_id
        out.append((vec_id, len(near[i]), component, vec_id == component))
    return out


def vectors(seed=5, n=260, dim=6):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and i % 3:
            base = np.array(rows[r.integers(len(rows))][1])
            v = base * r.uniform(0.5, 4) + r.normal(0, r.choice([0, 0.02, 0.2]), dim)
        else:
            v = r.normal(0, 1, dim)
        rows.append((int(i * 7 % n), v.tolist()))
    return rows


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, "n", 1.5, "c", 3) for i, v in rows], "vec_id long, embedding array<double>, node string, links double, component_id string, copies int")


def test_range_join_equals_all_pairs(spark):
    rows = vectors()
    same([tuple(r) for r in op11.op11(vector_table(spark, rows)).collect()], links_of(rows))


def test_range_join_with_many_small_blocks_and_pivots(spark, monkeypatch):
    """Cells of several blocks, units of several parts: every pair still counts once."""
    monkeypatch.setattr(op11, "block_rows", lambda dim: 7)
    monkeypatch.setattr(op11, "CELL_ROWS", 10)
    monkeypatch.setattr(op11, "PART", 2)
    monkeypatch.setattr(op11, "BATCH", 5)
    rows = vectors(9, 300, 3)
    same([tuple(r) for r in op11.op11(vector_table(spark, rows)).collect()], links_of(rows))


def test_range_join_prunes_by_the_triangle_inequality():
    """Vectors around well-separated pivots visit few cells, and none that holds a partner is left out."""
    r = np.random.default_rng(3)
    centres = np.eye(8)
    rows = np.concatenate([c + r.normal(0, 0.05, (40, 8)) for c in centres])
    units = op11._units(rows)
    cells = op11.Cells({8: op11.farthest_first(units, 8)}, np.arccos(0.9))
    angles = cells.angles(8, units)
    home = angles.argmin(axis=1)
    own = angles[np.arange(len(rows)), home]
    cells.size([{"dim": 8, "cell": c, "n": int((home == c).sum()), "inner": own[home == c].min(), "outer": own[home == c].max()} for c in range(8)])
    assert cells.visits(8, home, own, angles).sum() == 0  # 90 degrees apart, radius 26
    wide = op11.Cells({8: cells.pivots[8]}, np.arccos(0.1))
    wide.inner, wide.outer, wide.blocks = cells.inner, cells.outer, cells.blocks
    go = wide.visits(8, home, own, angles)
    for i, j in zip(*np.nonzero(units @ units.T >= 0.1)):
        if home[i] != home[j]:
            assert go[i, home[j]] or go[j, home[i]]


def test_range_join_edge_rows(spark):
    one, other = [1.0, 0.0, 0.0], [0.9, 0.19 ** 0.5, 0.0]
    rows = [(1, one), (1, one), (2, one), (2, [0.0, 1.0, 0.0]), (3, [3e300, 0.0, 0.0]), (4, [1e-300, 0.0, 0.0]), (None, one), (None, [0.0, 0.0, 1.0]),
            (None, None), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 0.0]), (9, [float("nan"), 1.0, 0.0]), (10, [float("inf"), 0.0, 0.0]),
            (11, [1.0]), (12, [2.0]), (13, [1.0, 0.0]), (14, other), (15, [-1.0, 0.0, 0.0]), (16, [0.0, -0.0, 5.0])]
    same([tuple(r) for r in op11.op11(vector_table(spark, rows)).collect()], links_of(rows))


def test_range_join_hot_vector_and_empty_table(spark):
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(400)] + [(1000 + i, [1.0, 2.0, 2.0 + i / 1000]) for i in range(200)] + [(5000, [-2.0, 1.0, 0.0])]
    got = {r[0]: tuple(r[1:]) for r in op11.op11(vector_table(spark, rows)).collect()}
    assert got[0] == (599, 0, True) and got[1199] == (599, 0, False) and got[5000] == (0, 5000, True) and len(got) == 601
    assert op11.op11(vector_table(spark, [])).collect() == []
    assert op11.op11(vector_table(spark, [(1, None)])).collect() == [(1, 0, 1, True)]


# ---------------------------------------------------------------- 12


def turns(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "a") for r in rows], "conv_id long, turn long, role string, text string, kind string, cost int, audit string")


def held(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def conversation_rows(seed, n):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        at = 0
        for _ in range(r.randint(1, 9)):
            at += r.choice([0, 1, 1, 1, 1, 2, 4])
            role = r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv if r.random() < 0.95 else None, at if r.random() < 0.95 else None, role, r.choice(["Yes.", "No", "Why?  ", "", " \t\n", None, "Ünïcode \U0001F600!", "a:b\nc."])))
    return rows


def test_repair_equals_plain_dynamic_programming():
    r, repair = random.Random(4), op12.Repair()
    code = {"": op12.NONE, "b": op12.BLANK, "d": op12.DUPLICATE, "t": op12.CUT}
    for _ in range(1500):
        rows = [(i, r.choice(["system", "user", "assistant", "tool", "", "system"]), "x") for i in range(r.randint(0, 12))]
        fault = [r.choice(["", "", "", "b", "d", "t"]) for _ in rows]
        asked = [(role[:1] if role[:1] in op12.TERMINALS else "", code[f]) for (_, role, _), f in zip(rows, fault)]
        assert repair(asked) == brute.repair(rows, fault)[:2]


def test_long_conversations_need_few_steps():
    r, repair = random.Random(7), op12.Repair()
    rows = [(r.choice("suaau"), r.choice([0, 0, 0, 1, 2, 3])) for _ in range(50_000)]
    cost, audit = repair(rows)
    assert len(audit.replace("I", "")) == len(rows) and len(repair.steps) < 1000
    late = sum(op12.TRUNCATED for e, (_, f) in zip(audit.replace("I", ""), rows) if e != "D" and f == op12.CUT)
    assert cost == audit.count("R") + 2 * audit.count("D") + 5 * audit.count("I") + late


def test_conversations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op12, "MOST_STEPS", 50)  # workers start again between conversations
    rows = conversation_rows(2, 400)
    assert held(op12.op12(turns(spark, rows).repartition(7))) == brute.expected(rows)


def test_conversation_edge_rows(spark):
    rows = [(None, None, None, None), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
            (2, -(1 << 62), "user", "a."), (2, 1 << 62, "assistant", "b."), (3, 0, "user", "x" * 500_000 + "."), (3, 1, "assistant", " " * 300_000)]
    rows += [(9, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(3000)]
    rows += [(k, t, "user", "Gone.") for k in range(100, 400) for t in [0] if zlib.crc32(f"{k}:0".encode()) % 20 == 0]  # lose all rows
    want = brute.expected([r for r in rows if r[0] != 9 and (r[0] or 0) < 100])
    got = held(op12.op12(turns(spark, rows)))
    assert {k: got[k] for k in want} == want
    gone = [v for k, v in got.items() if (k or 0) >= 100]
    assert gone and set(gone) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert len(got[9][6].replace("I", "")) >= 2800
    assert op12.op12(turns(spark, [])).collect() == []


def test_hot_conversation_is_flagged_across_partitions(spark):
    """One text a third of the time in one conversation: the first of its rows is no duplicate, all others are."""
    rows = [(1, i, "user", "Same." if i % 3 else f"Text {i}.") for i in range(1500)]
    damaged = brute.damage(rows)
    assert held(op12.op12(turns(spark, rows).repartition(9)))[1][2] == brute.faults(damaged).count("d")


# ---------------------------------------------------------------- 13


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_of(rows, tamper=True):
    """rows of (doc_id, source, lang, n_chars, text), whole trees in memory."""
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([_h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def proof(levels, p):
        out = []
        for nodes in levels[:-1]:
            f = p - p % 3
            out.append((nodes[f:p], nodes[p + 1:f + 3]))
            p //= 3
        return out

    by = {}
    for d, s, lang, n, t in rows:
        torn = t.replace("\n", "") if t is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else t
        by.setdefault(s, []).append((d, _h(*map(enc, (d, s, lang, n, t))), _h(*map(enc, (d, s, lang, n, torn)))))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in keys}
    top = tree([trees[s][-1][0] for s in keys])
    out = []
    for k, s in enumerate(keys):
        for p, (d, leaf, torn) in enumerate(sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            path, root = proof(trees[s], p) + proof(top, k), torn
            for before, after in path:
                root = _h(*before, root, *after)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], _h(*[x for b, a in path for x in b + a]), root, root == top[-1][0]))
    return out


def plain(rows):
    return [(d, s, lang, len(t or ""), t) for d, t, lang, s in rows]


def test_manifest_equals_whole_trees(spark):
    r = random.Random(8)
    rows = [(i * 3 % 997, r.choice(["one\ntwo", "line", "", "é\n" * 5]) + str(i), "en", r.choice(["a", "a", "a", "b", "é", "", None])) for i in range(700)]
    rows += [(5000 + i, f"x\n{i}", None, f"s{i}") for i in range(40)]  # many sources: a tall tree above them
    docs = table(spark, rows)
    for stride in (1, 2, op13.STRIDE):
        same([tuple(x) for x in op13.verified(op13.manifest(docs, stride)).collect()], manifest_of(plain(rows)))


def test_manifest_edge_rows(spark):
    same([tuple(x) for x in op13.op13(table(spark, edge_rows())).collect()], manifest_of(plain(edge_rows())))
    assert op13.op13(table(spark, [])).collect() == []
    one = [(7, "a\nb", "en", "s")]
    same([tuple(x) for x in op13.op13(table(spark, one)).collect()], manifest_of(plain(one)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_manifest_of_ragged_runs(spark, n):
    rows = [(i, f"t\n{i}", "en", "s") for i in range(n)]
    same([tuple(x) for x in op13.verified(op13.manifest(table(spark, rows), 2)).collect()], manifest_of(plain(rows)))


def test_only_every_stride_th_level_is_persisted(spark):
    rows = [(i, "t", "en", "s") for i in range(100)]
    nodes = op13.numbered(op13.leaves(table(spark, rows)), "group", "doc_id", "digest")
    assert [x.count() for x in op13.checkpoints(nodes, 2)] == [100, 12, 2, 1]


def test_oracles_agree(spark):
    import duckdb

    con = duckdb.connect()
    for name, op, sql, kind in (("embeddings", op11.op11, op11.ORACLE, "embedding"), ("documents", op13.op13, op13.ORACLE, "text")):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{name}.parquet')")
        got = op(spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
        same([tuple(r) for r in got.collect()], con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall())
