"""Mixing sources to target weights, with DataFrame operations only.

Sizes are summed per source (a partial sum in every task, so that a hot source costs no
more than another), targets are filled up to a cap, and each document is taken
floor(rate) times plus once more with the remaining probability, by a hash of its id.

Defined cases: a null text has size 0; a null source is a source of its own and sorts
last; a source of size 0 gets target 0; a null doc_id is hashed by its text instead;
repeated rows are documents of their own with the same draw; extra columns are kept out of
the plan, and ``emit`` keeps them but for one called ``copy``, whose place the number of the
copy takes; an empty table gives an empty plan. The sums by source meet in one task: a row a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import BROADCAST_ROWS, WORD, Scratch, packed, small

WEIGHTS = (5, 2, 1)
#: Hex digits of the hash that make the draw: 13 digits are 52 bits, exact in a double.
DIGITS = 13


def draw(seed: str, doc_id, text):
    """Uniform in [0, 1), by an md5 of seed and id (of the text where there is none), the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, nulls last, weigh ``weights`` in turn and share ``share`` times
    all sizes. A target stops at ``cap`` times its source's size; what is above goes to the
    others by weight. In the order of cap / weight the sources that stop come first, so
    that level at which the rest share is that of the first source that stays below its cap.
    """
    by_source = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (place + 1).cast("int")).cast("double")
    s = by_source.withColumn("w", w).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    s = s.withColumn("level", F.col("most") / F.col("w"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = (
        s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy()))
        .withColumn("filled", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("open_w", F.sum("w").over(rest))
        .withColumn("at", F.row_number().over(order))
    )
    s = s.withColumn("own", (F.col("total") - F.col("filled")) / F.col("open_w"))
    s = s.withColumn("shared", F.min_by(F.when(F.col("own") <= F.col("level"), F.col("own")), F.when(F.col("own") <= F.col("level"), F.col("at"))).over(Window.partitionBy()))
    level = F.coalesce(F.col("shared") * F.col("w"), F.col("most"))
    return s.select("source", "source_size", F.least(F.col("most"), level).alias("target"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: str = "mix", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (and ``keep``)."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", *keep, size.alias("size"), draw(seed, F.col("doc_id"), F.col("text")).alias("u"))
    scratch = Scratch(spark, "mixing")
    goal = scratch.save(targets(sized, weights, share, cap), "targets")
    goal = small(goal.withColumnRenamed("source", "goal_source"), goal.count(), BROADCAST_ROWS)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    copies = (whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)).cast("long")
    return (
        sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
        .withColumn("rate", rate)
        .withColumn("copies", copies)
        .select("doc_id", "source", *keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def emit(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as its plan says, numbered by ``copy`` from 1."""
    planned = plan(packed(docs, "doc_id", "source", "text"), keep=["_doc"], **how)
    rows = planned.where("copies > 0").select("_doc", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    return rows.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns if c != "copy"], "copy")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS drawn, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, 2.0::DOUBLE * source_size AS most FROM by_source),
levels AS (
  SELECT *, most / w AS level, row_number() OVER (ORDER BY most / w, source ASC NULLS LAST) AS pos FROM weighed),
filled AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM levels)
             - coalesce(sum(most) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own FROM levels),
goal AS (
  SELECT source, source_size, least(most, coalesce((SELECT own FROM filled WHERE own <= level ORDER BY pos LIMIT 1) * w, most)) AS target FROM filled),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix:' || drawn), 1, {DIGITS}))::BIGINT::DOUBLE / {float(16**DIGITS)}::DOUBLE AS u
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
