"""Operator 12: conversation structure repair by generalised LR parsing.

A conversation's role initials must spell ``(s?(ua)+)?``. The grammar is
compiled to an LR automaton (lr.py); a conversation is read once, in order,
with a graph-structured stack. At every row each stack top is kept, reroled
to user or assistant, or deleted, and missing turns are inserted between
rows; equal stack tops merge by the least (cost, audit), the audit being the
letters D, I, K, R of the edits so far. Two audits of equal cost that have
read the same rows are never a proper prefix of one another, so the least
merge at every row gives the least audit over all.

Only a few tops exist at a time. What a row does to them depends on their
relative costs and audit order alone, so steps are looked up: audits are not
copied, each row stores one small number, and the chosen edits are read back
from the end.

Scale. Faults are found by Spark: the earliest turn of every (conversation,
role, text digest) by one pre-aggregated count and a join, whatever the size
of a conversation. Then narrow rows (initial, fault) stream through a task,
sorted by conversation: 4 bytes a row are held until the conversation ends, as
its audit is one value of a letter per edit. Texts move in a second pass, in
which the digest of a conversation is fed row by row: no task holds the texts
of a conversation, and a conversation of a third of all rows costs one task
time, not memory. (Its digest is one sequential sha256, so one task must read
it through.)

Rows: a NULL conv_id is one conversation. NULL turn, role or text become one
space, in the number that damages as well. Rows of one turn are ordered by
role and text digest; equal rows repeat. A role whose initial is none of s, u,
a (an empty one too) can't be kept. Conversations that lose all rows keep
theirs, with zeros, an empty audit and the digest of the empty text. ``gaps``
stops at the largest long. Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import store
from repo_pulse.llm.lr import Stacks

# The role grammar, its terminals' roles and the costs of the edits.
GRAMMAR = (("S", ()), ("S", ("T",)), ("S", ("s", "T")), ("T", ("u", "a")), ("T", ("T", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
TERMINALS = ("s", "u", "a")
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A top this much above the least can't win: what another top can still read, any top can read after one inserted turn, with a system turn deleted.
SPREAD = INSERT + DELETE
SPACE = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # faults
LONGEST = (1 << 63) - 1


# ---------------------------------------------------------------- repair

#: Tops after a row: ((vertex, cost above the least, rank of the audit without its last inserts, last inserts), ...) by vertex.
Tops = tuple[tuple[int, int, int, str], ...]


class Repair:
    """Least-cost repair of a sequence of (initial, fault)."""

    def __init__(self, productions=GRAMMAR, rerole=REROLE, delete=DELETE, insert=INSERT, truncated=TRUNCATED, spread=SPREAD):
        """spread: a bound as SPREAD's for the grammar and costs given."""
        self.stacks = Stacks(productions)
        self.rerole, self.delete, self.insert, self.truncated, self.spread = rerole, delete, insert, truncated, spread
        self.steps: list[tuple[tuple[int, str], ...]] = []  # by step: for each base its (rank before, letters)
        self.seen: dict[tuple, tuple[Tops, int, int]] = {}
        self.start = self._inserted({self.stacks.root: (0, 0, "")})

    def _inserted(self, tops: dict[int, tuple[int, int, str]]) -> Tops:
        """The tops with all that inserted turns make of them, equal ones merged."""
        todo = list(tops)
        while todo:
            v = todo.pop()
            cost, base, more = tops[v]
            for terminal in ROLES:
                for w in self.stacks.advance(v, terminal):
                    new = (cost + self.insert, base, more + "I")
                    if w not in tops or new < tops[w]:
                        tops[w] = new
                        todo.append(w)
        least = min(cost for cost, *_ in tops.values())
        return tuple((v, cost - least, base, more) for v, (cost, base, more) in sorted(tops.items()) if cost <= least + self.spread)

    def step(self, tops: Tops, initial: str, fault: int) -> tuple[Tops, int, int]:
        """(tops after a row, cost that all share more, number of the step)."""
        key = (tops, initial, fault)
        if key in self.seen:
            return self.seen[key]
        best: dict[int, tuple[int, tuple[int, str]]] = {}  # vertex: (cost, (rank before, letters))

        def offer(w, cost, path):
            if w not in best or (cost, path) < best[w]:
                best[w] = cost, path

        late = self.truncated if fault == CUT else 0
        for v, cost, base, more in tops:
            offer(v, cost + self.delete, (base, more + "D"))
            if fault not in (BLANK, DUPLICATE):
                for w in self.stacks.advance(v, initial) if initial else ():
                    offer(w, cost + late, (base, more + "K"))
                for terminal in ROLES:
                    for w in self.stacks.advance(v, terminal):
                        offer(w, cost + late + self.rerole, (base, more + "R"))
        paths = sorted({p for _, p in best.values()})  # none is a prefix of another: each ends with this row's edit
        rank = {p: i for i, p in enumerate(paths)}
        flat = {v: (cost, rank[p], "") for v, (cost, p) in best.items()}
        after = self._inserted(flat)
        floor = min(cost for cost, *_ in flat.values())  # an insert only adds, so the least stays
        self.seen[key] = after, floor, len(self.steps)
        self.steps.append(tuple(paths))
        return self.seen[key]

    def end(self, tops: Tops) -> tuple[int, int, str]:
        """(cost above the least, rank, last inserts) of the best accepted top."""
        return min((cost, base, more) for v, cost, base, more in tops if self.stacks.accepts(v))

    def audit(self, steps: array, rank: int, more: str) -> str:
        """The edits in order, read back from the end."""
        out = [more[::-1]]
        for k in reversed(steps):
            rank, letters = self.steps[k][rank]
            out.append(letters[::-1])
        return "".join(out)[::-1]

    def __call__(self, rows: list[tuple[str, int]]) -> tuple[int, str]:
        """(cost, audit) of a whole sequence."""
        tops, cost, steps = self.start, 0, array("I")
        for initial, fault in rows:
            tops, more, k = self.step(tops, initial, fault)
            cost += more
            steps.append(k)
        last, rank, inserts = self.end(tops)
        return cost + last, self.audit(steps, rank, inserts)


MOST_STEPS = 50_000  # looked up by one worker, about 1 KB each


@lru_cache(1)
def _repair() -> Repair:
    return Repair()


def repair() -> Repair:
    """One per worker, so that its steps serve all its conversations; a new one between two conversations when they are many."""
    if len(_repair().steps) > MOST_STEPS:
        _repair.cache_clear()
    return _repair()


# ---------------------------------------------------------------- tables

def damaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text (NULLs one space, but for conv and turn) after the damage that the numbers call for."""
    conv, turn = F.col("conv_id"), F.col("turn").cast("long")
    name = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    flat = rows.select(conv.alias("conv"), turn.alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("way")).where("way != 0")
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = flat.select("conv", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      F.when(F.col("way") == 3, 2).otherwise(1).alias("times"))
    return out.select("*", F.explode(F.sequence(F.lit(1), "times")).alias("_i")).drop("times", "_i")


def last_letter(text: str) -> Column:
    """The last character that is no ASCII white space; empty if none."""
    return F.right(F.rtrim(F.col(text), F.lit(SPACE)), F.lit(1))


def with_faults(rows: DataFrame) -> DataFrame:
    """conv, turn, role, digest, initial, fault; rows that repeat within one turn have ``fault`` of the first."""
    digest = F.md5(F.col("text"))
    end = last_letter("text")
    # Repeats within a turn are told apart in the stream, where they are neighbours.
    narrow = rows.select("conv", "turn", "role", digest.alias("digest"), F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), CUT).otherwise(NONE).alias("fault"))
    key = F.xxhash64("conv", "role", "digest")
    narrow = narrow.withColumn("k", key)
    at = F.struct(F.col("turn").isNotNull().alias("n"), F.col("turn").alias("t"))
    seen = narrow.groupBy("k", "conv", "role", "digest").agg(F.min(at).alias("f"), F.max(at).alias("l")).where("f != l")
    seen = seen.select("k", F.col("conv").alias("s_conv"), F.col("role").alias("s_role"), F.col("digest").alias("s_digest"), "f")
    on = (narrow["k"] == seen["k"]) & narrow["conv"].eqNullSafe(seen["s_conv"]) & (narrow["role"] == seen["s_role"]) & (narrow["digest"] == seen["s_digest"])
    out = narrow.join(seen, on, "left").select(narrow["conv"], "turn", "role", "digest", "fault", F.col("f").isNotNull().alias("again"), (F.col("f") != at).alias("later"))
    later = F.col("again") & F.col("later")
    return out.select("conv", "turn", "role", "digest", F.left("role", F.lit(1)).alias("initial"),
                      F.when(later & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")).cast("int").alias("fault"))


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations to a task, rows by turn (NULL first), then role and text digest."""
    return rows.repartition("conv").sortWithinPartitions("conv", *first, "turn", "role", "digest")


class _Reading:
    """What is held of the conversation being read."""

    def __init__(self, conv):
        self.repair = repair()
        self.conv, self.tops, self.cost, self.steps = conv, self.repair.start, 0, array("I")
        self.counts, self.illegal, self.turns = [0, 0, 0, 0], 0, 0
        self.low = self.high = self.turn = None
        self.before = self.initial = None

    def row(self, turn, role, digest, initial, fault) -> None:
        if self.before == (turn, role, digest) and fault != BLANK:
            fault = DUPLICATE
        self.before = turn, role, digest
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.counts[fault] += 1
        self.tops, more, k = self.repair.step(self.tops, initial if initial in TERMINALS else "", fault)
        self.cost += more
        self.steps.append(k)

    def result(self) -> tuple:
        last, rank, more = self.repair.end(self.tops)
        gaps = 0 if self.low is None else min(LONGEST, self.high - self.low + 1 - self.turns)
        return self.conv, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, self.cost + last, self.repair.audit(self.steps, rank, more)


def _parse(schema: pa.Schema):
    def out(done: list[_Reading]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[r.result() for r in done]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            done = []
            for conv, *row in zip(*[c.to_pylist() for c in b.columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now)
                    now = _Reading(conv)
                now.row(*row)
            if done:
                yield out(done)
        if now is not None:
            yield out([now])

    return run


class _Writing:
    """Feeds the repaired turns of a conversation to its digest, edit by edit."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at = conv, audit, 0
        self.sha, self.last, self.some = hashlib.sha256(), "", False

    def turn(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.some else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.some, self.last = True, role[:1]

    def expected(self) -> str:
        return ROLES["a" if self.last == "u" else "u"]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.turn(self.expected(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.turn(role if edit == "K" else self.expected(), text)

    def result(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def _hash(schema: pa.Schema):
    """Rows sorted by conversation, its audit first -> (conv, repaired_sha256)."""

    def out(done: list[_Writing]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.conv for w in done], schema[0].type), pa.array([w.result() for w in done])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            done = []
            for conv, kind, role, text, audit in zip(*[b.column(n).to_pylist() for n in ("conv", "kind", "role", "text", "audit")]):
                if kind == 0:
                    if now is not None:
                        done.append(now)
                    now = _Writing(conv, audit)
                else:
                    now.row(role, text)
            if done:
                yield out(done)
        if now is not None:
            yield out([now])

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation of rows(conv, turn, role, text): its faults, least cost, audit and the digest of the repaired turns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = rows.schema["conv"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    parsed = StructType.fromDDL(f"conv {kind}, {counts}, audit string")
    audits = store(_ordered(with_faults(rows)).mapInArrow(_parse(to_arrow_schema(parsed)), parsed), "audits")
    turns = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "text", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.lit("").alias("text"), "audit")
    hashed = StructType.fromDDL(f"conv {kind}, repaired_sha256 string")
    hashes = _ordered(heads.unionByName(turns), "kind").mapInArrow(_hash(to_arrow_schema(hashed)), hashed)
    hashes = hashes.withColumnRenamed("conv", "h_conv")
    return audits.join(hashes, audits["conv"].eqNullSafe(hashes["h_conv"])).drop("h_conv")


def op12(conversations: DataFrame) -> DataFrame:
    """Every conv_id with the faults and the repair of its damaged rows."""
    found = repaired(store(damaged(conversations), "damaged"))
    every = conversations.select("conv_id").distinct()
    out = every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
