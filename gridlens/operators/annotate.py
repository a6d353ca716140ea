"""The annotation stages: verdicts, refinement, the canonical list and what is dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.scalars import norm_alias
from gridlens.operators import boxes as B

NO_CLASS = ("other", "unknown", "none")


def route_verdicts(verdicts: DataFrame, detections: DataFrame, classes: DataFrame, aliases: DataFrame, reject_below: float, accept_above: float) -> DataFrame:
    """(cand, img, class_name, decision, relabel): a class of none rejects, a known other one relabels, confidence decides."""
    v = verdicts.select("cand", "img", "correct_class", "confidence", norm_alias(F.col("correct_class")).alias("_key"))
    d = detections.select("cand", "cls").join(F.broadcast(classes.select("cls", "class_name")), "cls")  # the registry of classes
    j = v.join(d, "cand").join(F.broadcast(aliases.select(F.col("alias").alias("_key"), "canonical")), "_key", "left")
    said = F.coalesce((F.col("correct_class") != "") & (F.col("correct_class") != F.col("class_name")), F.lit(False))
    none = said & F.lower("correct_class").isin(*NO_CLASS)
    decision = F.when(none, "rejected").when(F.col("confidence") < reject_below, "rejected").when(F.col("confidence") >= accept_above, "accepted").otherwise("review")
    relabel = F.when(said & ~none & (F.col("canonical") != F.col("class_name")), F.col("canonical"))
    return j.select("cand", "img", "class_name", decision.alias("decision"), relabel.alias("relabel"))


def combine(refinements: DataFrame, routed: DataFrame) -> DataFrame:
    """The final verdict and box source of refined candidates, from the evaluation and the adjudication.

    An unchanged box keeps its evaluation; a changed one that is rejected goes to review as it was.
    """
    j = refinements.join(routed.where("decision <> 'rejected'").select("cand", "decision"), "cand")
    verdict = F.when(~F.col("changed"), F.col("decision")).when(F.col("adjudicate") == "accept", "accepted").otherwise("review")
    source = F.when(~F.col("changed") | (F.col("adjudicate") == "reject"), "original").otherwise("refined")
    return j.withColumn("verdict", verdict).withColumn("source", source)


def canonical(detections: DataFrame, classes: DataFrame, routed: DataFrame, refinements: DataFrame) -> DataFrame:
    """Candidates that end accepted, with their class and box as changed; rejected and review ones, and those without a verdict, are not in it."""
    c = combine(refinements, routed).select("cand", "verdict", "source", *[F.col(f"r{x}") for x in B.BOX])
    r = routed.where("decision <> 'rejected'").select("cand", "decision", "relabel", "class_name")
    j = detections.join(r, "cand").join(c, "cand", "left").where("case when verdict is null then decision = 'accepted' else verdict = 'accepted' end")
    refined = F.coalesce(F.col("source") == "refined", F.lit(False))
    out = j.withColumn("was_refined", refined)
    notes = F.array_compact(F.array(F.when(refined, "refined"), F.when(F.col("relabel").isNotNull(), F.concat(F.lit("relabel:"), "class_name", F.lit("->"), "relabel"))))
    out = out.withColumn("notes", notes).withColumn("class_name", F.coalesce("relabel", "class_name"))
    for x in B.BOX:
        out = out.withColumn(x, F.when(F.col("was_refined"), F.col(f"r{x}")).otherwise(F.col(x)))
    ids = F.broadcast(classes.select("class_name", F.col("cls").alias("_cls")))
    out = out.join(ids, "class_name", "left").withColumn("cls", F.coalesce("_cls", "cls"))
    return out.select("cand", "img", "cls", "model", "score", *B.BOX, "class_name", "was_refined", "notes")


def review_items(routed: DataFrame, refinements: DataFrame) -> DataFrame:
    """(cand, reason): in review after evaluation and not refined, or after refinement."""
    first = routed.where("decision = 'review'").join(refinements, "cand", "left_anti").select("cand", F.lit("evaluate_review").alias("reason"))
    return first.unionByName(combine(refinements, routed).where("verdict = 'review'").select("cand", F.lit("refine_review").alias("reason")))


def dropped(before: DataFrame, after: DataFrame, reason: str) -> DataFrame:
    return before.join(after.select("cand"), "cand", "left_anti").withColumn("reason", F.lit(reason))


def finalize(rows: DataFrame, classes: DataFrame, models: DataFrame, confusions: DataFrame, geometric: dict, threshold: float, cap: int, unknown: int = 99) -> DataFrame:
    """rows (cand, img, cls, model, score, box) with outcome: ``kept``, or the step that drops them.

    Geometric test, collapse of clusters, cap per class, rules across classes. Steps mark rows and
    do not remove them, so that one pass gives both the kept and the drops with their reasons.
    """
    core = rows.select("cand", "img", "cls", "model", "score", *B.BOX).withColumn("_bad", B.geometric_reason(**geometric))
    bad = core.where("_bad is not null").select("cand", F.lit("geometric").alias("outcome"))
    m = F.broadcast(models.select("model", F.col("priority").alias("_p")))  # one row a model
    c = B.clusters(core.where("_bad is null").drop("_bad"), ["img", "cls"], threshold).join(m, "model", "left").withColumn("_p", F.coalesce("_p", F.lit(unknown)))
    own = Window.partitionBy("img", "cls", "cluster")
    c = c.withColumn("_first", F.row_number().over(own.orderBy("_p", F.col("score").desc(), "cand")) == 1).withColumn("agreement", F.size(F.collect_set("model").over(own)).cast("long"))
    place = F.row_number().over(Window.partitionBy("img", "cls", "_first").orderBy(F.col("score").desc(), "cand"))
    c = c.withColumn("_step", F.when(~F.col("_first"), "duplicate").when(place > cap, "cap"))
    left = c.where("_step is null").select("cand", "img", "cls", "model", "score", *B.BOX, "agreement")
    stays = B.cross_class(left, classes, confusions, models).select("cand", F.lit(True).alias("_stays"))
    told = c.select("cand", "_step").join(stays, "cand", "left")
    outcome = F.coalesce("_step", F.when(F.col("_stays"), "kept").otherwise("cross_class"))
    return bad.unionByName(told.select("cand", outcome.alias("outcome")))


def detect_chain(rows: DataFrame, classes: DataFrame, models: DataFrame, confusions: DataFrame, geometric: dict, threshold: float, cap: int) -> DataFrame:
    """From proposals to routed candidates; cheap tests come before the costly ones."""
    ok = B.score_floor(rows.where(B.geometric_reason(**geometric).isNull()), models).select(*rows.columns)
    one = B.collapse(ok, models, threshold).drop("models")
    few = B.top_k(one, ["img", "cls"], [F.col("score").desc(), F.col("cand")], cap)
    return B.route(B.cross_class(few, classes, confusions, models), classes, models, (1, 2), 2, 0.5)


def refine_chain(rows: DataFrame) -> DataFrame:
    """Steps in order, each of which may replace the box as left by the one before; x1 stands for the box."""
    start = F.struct(F.col("x1").alias("x1"), F.filter(F.array(F.lit("")), lambda x: F.lit(False)).alias("outcomes"))

    def step(acc: Column, s: Column) -> Column:
        outcome = F.when(~s["changed"], "no_change").when(s["passes"], "replaced").otherwise("rejected")
        return F.struct(F.when(outcome == "replaced", acc["x1"] / s["by"]).otherwise(acc["x1"]).alias("x1"), F.concat(acc["outcomes"], F.array(outcome)).alias("outcomes"))

    return rows.select("cand", F.aggregate("steps", start, step).alias("r")).select("cand", "r.x1", F.array_join("r.outcomes", ",").alias("outcomes"))


def retry_rounds(rows: DataFrame, works: Callable[[DataFrame, int], Column], most: int) -> DataFrame:
    """rows with rounds and done: what failed is tried again, ``most`` times at the most."""
    state = rows.withColumn("rounds", F.lit(0).cast("long")).withColumn("done", works(rows, 0))
    for k in range(1, most + 1):
        state = state.withColumn("rounds", F.when(F.col("done"), F.col("rounds")).otherwise(F.lit(k).cast("long"))).withColumn("done", F.col("done") | works(state, k))
    return state


# The order in which stages have the last word.
PRECEDENCE = ("validation_detailed", "validation_screening", "detailed", "screening")


def last_word(opinions: DataFrame) -> DataFrame:
    """(cand, action): the decision of the first stage that settled it, else a human's review."""
    rank = F.array_position(F.array(*[F.lit(s) for s in PRECEDENCE]), F.col("stage"))
    o = opinions.withColumn("_rank", F.when(F.col("decision") != "review", rank))
    w = Window.partitionBy("cand").orderBy(F.col("_rank").asc_nulls_last())
    best = o.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return best.select("cand", F.when(F.col("_rank").isNull(), "human_review").otherwise(F.col("decision")).alias("action"))
