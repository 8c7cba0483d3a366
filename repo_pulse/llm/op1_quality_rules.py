"""Operator 1: weakly supervised quality rules, in DataFrame functions only.

Each rule looks at one feature of a text and votes good (1), bad (-1) or
abstains (0). Nobody says how good the rules are: expectation-maximisation on
the counts of vote patterns estimates the share of good documents and, for
every rule, how often it votes good, bad or not at all on good documents and
on each kind of bad ones, and from these its accuracy (how often its vote, when
it votes, is right). Bad documents come in kinds (rows of symbols, shouting,
repetition), each found by rules of its own: after a fit, documents still taken
for good on which two rules or more find a fault start a further kind, until
there are few of them. A document is kept if its posterior probability of
being good is at least one half (and the fixed base rules do not fail).

Scale: features are computed in one scan, row by row, in built-in functions
(word windows are compared through 64-bit hashes, sorted within the row:
n log n, whole texts). The narrow feature rows are stored; patterns are a
pre-aggregated count of at most 3^8 rows, whatever the input; each EM step is
one aggregate over that table and returns one row of sums. There are at most
as many kinds as rules.

Rows: NULL or empty text has no words, fails the base and is not kept;
repeated rows are scored each; NULL doc_id stays NULL; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import WORD, let, store

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
WINDOW = 3
REPEAT_PERCENT = 50
#: name: (feature, good if at most, bad if above). Between the two bounds a rule abstains; without the first it only finds faults.
RULES = {
    "letters": ("other_share", 0.08, 0.16),
    "variety": ("top_word_share", 0.06, 0.15),
    "symbols": ("symbol_share", None, 0.06),
    "runs": ("run_share", None, 0.20),
    "repeats": ("repeat_share", None, 0.40),
    "dup_lines": ("dup_line_share", None, 0.60),
    "capitals": ("capital_share", None, 0.50),
    "exclaims": ("exclaim_share", None, 0.30),
}
PRIOR_GOOD = 0.8  # where EM starts; the share itself is estimated
START_RIGHT = 0.8  # a vote is right this often at the start
SMOOTH = 10.0  # pseudo-documents a class; a further kind starts from more documents than that
AGREE = 2  # rules that find a fault in a document of a further kind
LEAST = 1e-4  # no vote is impossible
STEPS = 50
TOLERANCE = 1e-3
KEEP = 0.5
VOTES = (-1, 0, 1)


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of words found twice or more; the first find counts."""
    size = F.size(found)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(window)]))

    def positions(h: Column) -> Column:  # of windows whose neighbour in hash order is equal
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        n = F.size(h)
        return let(pairs, lambda s: F.sort_array(F.filter(
            F.transform(s, lambda p, i: F.when(((i > 0) & (F.get(s, i - 1)["h"] == p["h"])) | ((i < n - 1) & (F.get(s, i + 1)["h"] == p["h"])), p["i"])),
            lambda i: i.isNotNull())))

    def covered(at: Column) -> Column:  # a window adds its words up to the next repeated one
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("end")),
                           lambda s, i: F.struct((s["n"] + F.least(F.lit(window), i - s["end"] + window)).alias("n"), (i + window).alias("end")), lambda s: s["n"])

    counted = let(found, lambda w: F.when(F.size(w) < window + 1, F.lit(0)).otherwise(
        let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(positions(h), covered)))))
    return F.when(size < window + 1, F.lit(0)).otherwise(counted)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the features of the rules; one row per document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def of_words(w: Column) -> Column:
        sorted_hashes = let(F.sort_array(F.transform(w, lambda x: F.xxhash64(x))), lambda h: F.aggregate(
            h, F.struct(F.lit(0).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("top")),
            lambda s, x: let(F.when(s["last"] == x, s["run"] + 1).otherwise(1), lambda r: F.struct(x.alias("last"), r.alias("run"), F.greatest(s["top"], r).alias("top"))),
            lambda s: s["top"]))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).cast("long").alias("n_repeat_words"), sorted_hashes.alias("top"))

    lines = let(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    d = d.select(
        "doc_id", let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), of_words).alias("w"), lines.alias("l"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-ZÀ-ÖØ-Þ]")).alias("capitals"), F.regexp_count("text", F.lit("[!?]")).alias("exclaims"), 
        F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]{2,}")).alias("runs"), F.length(F.regexp_replace("text", r"[\p{L}\s]+", "")).alias("others"))
    chars = F.greatest(F.col("w.word_chars"), F.lit(1))
    n = F.greatest(F.col("w.n_words"), F.lit(1))
    return d.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words",
        (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("w.n_repeat_words") / n).alias("repeat_share"),
        (F.col("l.dup") / F.greatest(F.col("l.n"), F.lit(1))).alias("dup_line_share"), (F.col("others") / chars).alias("other_share"),
        (F.col("capitals") / chars).alias("capital_share"), (F.col("exclaims") / n).alias("exclaim_share"), (F.col("runs") / n).alias("run_share"),
        F.when(F.col("w.n_words") >= MIN_WORDS, F.col("w.top") / n).alias("top_word_share"))


def votes(rules: dict = RULES) -> dict[str, Column]:
    """1 good, -1 bad, 0 abstain (also when the feature is NULL)."""
    return {f"v_{name}": (F.when(F.col(f) > bad, -1) if good is None else F.when(F.col(f) > bad, -1).when(F.col(f) <= good, 1)).otherwise(0).cast("byte")
            for name, (f, good, bad) in rules.items()}


def start(rates: dict[int, float]) -> dict[int, tuple[float, float]]:
    """P(vote | good), P(vote | bad) of a rule with these overall vote rates whose votes are right START_RIGHT of the time."""
    wrong = 1 - START_RIGHT
    good = {-1: rates[-1] * wrong / PRIOR_GOOD, 1: rates[1] * START_RIGHT / PRIOR_GOOD}
    bad = {-1: rates[-1] * START_RIGHT / (1 - PRIOR_GOOD), 1: rates[1] * wrong / (1 - PRIOR_GOOD)}
    for p in (good, bad):
        p[0] = max(1 - p[-1] - p[1], LEAST)
    return {v: (good[v] / sum(good.values()), bad[v] / sum(bad.values())) for v in VOTES}


def odds(model: dict, kind: int) -> Column:
    """P(kind | votes) / P(good | votes): the shares' odds times each vote's (or abstention's) likelihood ratio.

    The weights are array constants, which generated code refers to and does
    not spell out, so all steps of a fit share their compiled code.
    """
    out, add = F.lit(0.0), math.log(model["shares"][kind] / model["prior"])
    for c, p in model["kinds"][kind].items():
        w = [math.log(max(p[v], LEAST) / max(model["good"][c][v], LEAST)) + add for v in VOTES]
        out, add = out + F.get(F.lit(w), F.col(c).cast("int") + 1), 0.0
    return F.exp(out)


def posterior(model: dict) -> Column:
    """P(good | votes)."""
    return 1 / (1 + sum((odds(model, k) for k in range(len(model["kinds"]))), F.lit(0.0)))


def count_votes(columns: list[str], of: Column, name: str) -> list[Column]:
    return [F.sum(F.when(F.col(c) == v, of).otherwise(0)).alias(f"{name}:{c}:{v}") for c in columns for v in (-1, 1)]


def probabilities(row, columns: list[str], name: str, total: float, begin: dict) -> dict[str, dict[int, float]]:
    """P(vote | class) from a row of sums and SMOOTH pseudo-documents of ``begin``."""
    out = {}
    for c in columns:
        found = {-1: row[f"{name}:{c}:-1"], 1: row[f"{name}:{c}:1"]}
        found[0] = max(total - found[-1] - found[1], 0.0)
        out[c] = {v: (found[v] + SMOOTH * begin[c][v]) / (total + SMOOTH) for v in VOTES}
    return out


def fit(patterns: DataFrame, columns: list[str], model: dict, n: int, voted: dict[str, int], steps: int) -> dict:
    """EM steps from a model over n documents; the classes keep their pseudo-documents ("begin")."""
    begin, kinds = model["begin"], range(len(model["kinds"]))
    for _ in range(steps):
        p = patterns.withColumns({f"o{k}": odds(model, k) for k in kinds})
        p = p.withColumn("g", F.col("n") / (1 + sum((F.col(f"o{k}") for k in kinds), F.lit(0.0))))
        p = p.withColumns({f"b{k}": F.col("g") * F.col(f"o{k}") for k in kinds})
        row = p.agg(*[F.sum(x).alias(x) for x in ("g", *[f"b{k}" for k in kinds])], *count_votes(columns, F.col("g"), "g"),
                    *[x for k in kinds for x in count_votes(columns, F.col(f"b{k}"), f"b{k}")]).first()
        new = {"begin": begin, "prior": (row["g"] + SMOOTH * PRIOR_GOOD) / (n + SMOOTH), "good": probabilities(row, columns, "g", row["g"], begin[0]),
               "kinds": [probabilities(row, columns, f"b{k}", row[f"b{k}"], begin[k + 1]) for k in kinds],
               "shares": [(row[f"b{k}"] + SMOOTH * (1 - PRIOR_GOOD) / len(kinds)) / (n + SMOOTH) for k in kinds]}
        for c in columns:
            right = row[f"g:{c}:1"] + sum(row[f"b{k}:{c}:-1"] for k in kinds)
            new[c] = (right + SMOOTH * START_RIGHT) / (voted[c] + SMOOTH)
        moved = max(abs(new[c] - model[c]) for c in ("prior", *columns))
        model = new
        if moved < TOLERANCE:
            break
    return model


def estimate(patterns: DataFrame, columns: list[str], steps: int = STEPS) -> dict:
    """EM over patterns(votes.., n): the share of good documents ("prior") and of each kind of bad ones ("shares"), the vote
    probabilities of each class ("good", "kinds") and, under its own name, each rule's accuracy among its votes.

    Smoothing adds pseudo-documents of a class's starting probabilities to it.
    """
    total = patterns.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *count_votes(columns, F.col("n"), "n")).first()
    n = total["n"]
    votes_of = {c: {v: total[f"n:{c}:{v}"] or 0 for v in (-1, 1)} for c in columns}
    voted = {c: sum(x.values()) for c, x in votes_of.items()}
    begin = {c: start({v: x / max(n, 1) for v, x in votes_of[c].items()}) for c in columns}
    good, bad = ({c: {v: begin[c][v][i] for v in VOTES} for c in columns} for i in (0, 1))
    model = {"begin": [good, bad], "prior": PRIOR_GOOD, "good": good, "kinds": [bad], "shares": [1 - PRIOR_GOOD]} | dict.fromkeys(columns, START_RIGHT)
    if not n:
        return model
    model = fit(patterns, columns, model, n, voted, steps)
    faults = sum(((F.col(c) == -1).cast("int") for c in columns), F.lit(0))
    while len(model["kinds"]) < len(columns):
        missed = patterns.where((faults >= AGREE) & (posterior(model) >= KEEP))
        row = missed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *count_votes(columns, F.col("n"), "n")).first()
        if row["n"] <= SMOOTH:
            break
        kind, share = probabilities(row, columns, "n", row["n"], good), row["n"] / n
        model = model | {"begin": [*model["begin"], kind], "kinds": [*model["kinds"], kind], "shares": [*model["shares"], share],
                         "prior": max(model["prior"] - share, share)}
        model = fit(patterns, columns, model, n, voted, steps)
    return model


def quality(docs: DataFrame, rules: dict = RULES, keep: float = KEEP, steps: int = STEPS) -> DataFrame:
    """doc_id, base counts, base_failed, the votes, good (posterior) and kept, for every document."""
    v = votes(rules)
    rows = store(features(docs).withColumns(v), "features")
    patterns = store(rows.groupBy(*v).agg(F.count("*").alias("n")).orderBy(*v).coalesce(1), "patterns")
    model = estimate(patterns, list(v), steps)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = rows.withColumn("base_failed", failed).withColumn("good", posterior(model))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("good") >= keep))


def op1(docs: DataFrame) -> DataFrame:
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "good", "kept")
