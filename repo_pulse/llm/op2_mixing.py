"""Operator 2: mixing sources to target weights.

Words are counted per document, summed per source, and each source gets a
target share by weight; a source's repetition rate is target / size. Every
document is taken floor(rate) times plus one copy when a hash of its id, read
as a number in [0, 1), falls below the rate's fraction. The hash depends on
doc_id and the seed alone, so reruns agree on any cluster.

Targets: the sources share ``budget`` times all words by weight; a source
stops at ``most`` times its own words and the excess is shared again by
weight, until none is above. The loop runs on sums over the source table.

Scale: one scan counts words; its narrow (doc_id, source, size) rows are
stored. The only shuffles are the sum per source (pre-aggregated) and, if the
rates are too many for Spark to broadcast, a join that AQE can split on a hot
source. Sources are numbered by range partition and offsets, never in one task.

Rows: NULL or empty text has size 0 and is taken 0 words (a document of no
words still gets its copies in ``mix``); NULL source is a source of its own,
last in order; NULL doc_id hashes like the empty string; repeated rows get
the same copies each; all sizes 0 give targets 0; an empty table gives an
empty result; other columns pass through ``mix`` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.llm.common import WORD, fresh, store

WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)  # 150 % of all words, as a fraction
MOST = 2
SEED = "mix-1"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def unit(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 13 hex digits (52 bits) of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def numbered(sources: DataFrame) -> DataFrame:
    """Add ``at``: position from 0 by code point, NULL last, through range partitions and their counts."""
    part = store(sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()), "sources")
    counts = part.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return part.withColumn("within", within).join(before, "part").withColumn("at", F.col("before") + F.col("within")).drop("part", "within", "before")


def rates(sources: DataFrame, weights=WEIGHTS, budget=BUDGET, most: int = MOST) -> DataFrame:
    """sources(source, source_size) -> with target and rate."""
    s = numbered(sources)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    s = store(s.withColumn("weight", weight).drop("at"), "weights")
    total = s.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    goal, share, free = total * budget[0] / budget[1], 0.0, None
    while True:  # each round caps at least one more source; sums only
        over = (F.col("weight") * F.lit(share)) >= (F.lit(most) * F.col("source_size")).cast("double")
        row = s.agg(F.coalesce(F.sum(F.when(over, F.col("source_size") * most)), F.lit(0)).alias("capped"),
                    F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("w")).first()
        if row["w"] == free or row["w"] == 0:
            break
        free, share = row["w"], float(goal - row["capped"]) / row["w"]
    target = F.least((F.lit(most) * F.col("source_size")).cast("double"), F.col("weight") * F.lit(share))
    s = s.withColumn("target", target)
    return s.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def taken(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies per document row."""
    sized = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words().alias("size")), "sizes")
    table = store(rates(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most), "rates")
    out = sized.join(table, sized["source"].eqNullSafe(table["source"])).drop(table["source"])
    whole = F.floor("rate")
    copies = whole + (unit(seed=seed) < F.col("rate") - whole).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it; docs' own columns only."""
    sources = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum(n_words()).alias("source_size"))
    table = store(rates(sources, weights, budget, most), "rates").select("source", "rate")
    c, r = fresh(docs, "_copies"), fresh(docs, "_rate")
    src = fresh(docs, "_source")
    table = table.select(F.col("source").alias(src), F.col("rate").alias(r))
    d = docs.join(table, docs["source"].cast("string").eqNullSafe(table[src]))
    whole = F.floor(r)
    d = d.withColumn(c, (whole + (unit(seed=seed) < F.col(r) - whole).cast("long")).cast("int"))
    return d.where(F.col(c) > 0).withColumn(c, F.explode(F.array_repeat(F.lit(1), F.col(c)))).select(docs.columns)


def op2(docs: DataFrame) -> DataFrame:
    t = taken(docs)
    return t.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM per),
prefix AS (  -- the sources capped first are those with the least words per weight
  SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS capped, coalesce(sum(weight) OVER before, 0) AS gone,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM weighted
  WINDOW before AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT coalesce(max((total * 3 / 2 - capped)::DOUBLE / (weights - gone)::DOUBLE), 0) AS level
  FROM prefix WHERE 2 * source_size / weight >= (total * 3 / 2 - capped)::DOUBLE / (weights - gone)::DOUBLE),
targets AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, weight * level) AS target,
         CASE WHEN source_size > 0 THEN least((2 * source_size)::DOUBLE, weight * level) / source_size ELSE 0 END AS rate
  FROM weighted, share)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (d.size * (floor(t.rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0
                                            < t.rate - floor(t.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
"""
