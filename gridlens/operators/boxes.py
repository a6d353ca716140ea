"""Operators over boxes of images.

Every greedy operator is one fold: the boxes of a group are put in a total order, and a box
stays if no box kept before suppresses it. The fold is a native aggregate over a sorted array,
so groups are as large as an image's boxes (of a class) and everything stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions import geometry as G

BOX = ("x1", "y1", "x2", "y2")


def _packed(columns: Sequence[str], order: Sequence[Column]) -> Column:
    return F.struct(*[o.alias(f"_o{k}") for k, o in enumerate(order)], *[F.col(c) for c in columns])


def greedy(rows: DataFrame, by: Sequence[str], order: Sequence[Column], suppresses: Callable[[Column, Column], Column]) -> DataFrame:
    """The rows that no kept earlier row of their group suppresses; order must be total.

    ``suppresses(kept, row)`` gets two structs of the columns.
    """
    cols = [c for c in rows.columns if c not in by]
    groups = rows.groupBy(*by).agg(F.array_sort(F.collect_list(_packed(cols, order))).alias("_all"))
    empty = F.filter("_all", lambda x: F.lit(False))
    kept = F.aggregate("_all", empty, lambda acc, x: F.when(F.exists(acc, lambda k: F.coalesce(suppresses(k, x), F.lit(False))), acc).otherwise(F.concat(acc, F.array(x))))
    out = groups.select(*by, F.explode(kept).alias("_k"))
    return out.select(*by, *[F.col(f"_k.{c}") for c in cols]).select(*rows.columns)


def over(threshold: float, strict: bool = True, eps: float = 0.0) -> Callable[[Column, Column], Column]:
    """Suppression by IoU above (or from) a threshold."""

    def test(k: Column, x: Column) -> Column:
        v = G.iou(G.part(k), G.part(x), eps)
        return v > threshold if strict else v >= threshold

    return test


def over_or_empty(threshold: float) -> Callable[[Column, Column], Column]:
    """IoU above a threshold; an empty union is no number and suppresses, too."""
    return lambda k, x: F.when(G.union(G.part(k), G.part(x)) > 0, G.iou(G.part(k), G.part(x)) > threshold).otherwise(True)


def size_aware(threshold: float, ratio: float, share: float = 0.85) -> Callable[[Column, Column], Column]:
    """IoU from a threshold, but not where a much smaller box lies inside the larger."""

    def test(k: Column, x: Column) -> Column:
        a, b = G.part(k), G.part(x)
        most, least = F.greatest(G.area(a), G.area(b)), F.least(G.area(a), G.area(b))
        small = F.when(most > 0, least / most).otherwise(1.0) < ratio
        inside = F.when(G.area(b) < G.area(a), G.contains_share(a, b, share)).otherwise(G.contains_share(b, a, share))
        return (G.iou(a, b) >= threshold) & ~(small & inside)

    return test


def nested(h_tolerance: float) -> Callable[[Column, Column], Column]:
    """A box inside a kept larger one of nearly its height."""

    def test(k: Column, x: Column) -> Column:
        a, b = G.part(k), G.part(x)
        ratio = F.when(G.height(a) > 0, G.height(b) / G.height(a)).otherwise(0.0)
        return G.contains(a, b) & (F.abs(1 - ratio) <= h_tolerance)

    return test


def score_first() -> tuple[Column, Column]:
    return -F.col("score"), F.col("cand")


def pairs(rows: DataFrame, by: Sequence[str], key: str = "cand", keep: Sequence[str] = ()) -> DataFrame:
    """Unordered pairs of a group's rows, with a_ and b_ columns: an equi-join on the group."""
    cols = [key, *[c for c in keep if c != key], *BOX]
    a = rows.select(*by, *[F.col(c).alias(f"a_{c}") for c in cols])
    b = rows.select(*by, *[F.col(c).alias(f"b_{c}") for c in cols])
    return a.join(b, list(by)).where(F.col(f"a_{key}") < F.col(f"b_{key}"))


def iou_pairs(rows: DataFrame, by: Sequence[str], threshold: float, strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    p = pairs(rows, by, keep=keep).withColumn("iou", G.iou(G.box("a_"), G.box("b_")))
    return p.where(F.col("iou") > threshold if strict else F.col("iou") >= threshold)


def without_larger_outer(rows: DataFrame, by: Sequence[str], tol: float) -> DataFrame:
    """Boxes that lie in no larger one (with a slack), whether that one is kept or not: an anti-join."""
    a = rows.withColumn("_area", G.area(G.box()))
    b = a.select(*[F.col(c).alias(f"b_{c}") for c in by], F.col("_area").alias("b_area"), *[F.col(c).alias(f"b_{c}") for c in BOX])
    same = F.lit(True)
    for c in by:
        same = same & (F.col(c) == F.col(f"b_{c}"))
    return a.join(b, same & (F.col("b_area") > F.col("_area")) & G.contains_tol(G.box("b_"), G.box(), tol), "left_anti").drop("_area")


def geometric_reason(lo: float, hi: float, ar_lo: float, ar_hi: float, near: float) -> Column:
    """The first test that a box fails, or null: area, shape, then two or more edges."""
    b = G.box()
    return (
        F.when((G.area(b) < lo) | (G.area(b) > hi), "area")
        .when((G.aspect(b) <= 0) | (G.aspect(b) < ar_lo) | (G.aspect(b) > ar_hi), "aspect")
        .when(G.edges_touched(b, near) >= 2, "edge")
    )


def score_floor(rows: DataFrame, floors: DataFrame) -> DataFrame:
    """Rows at or above their model's floor; models without one pass."""
    f = floors.select("model", F.col("floor_score").alias("_f"))
    return rows.join(F.broadcast(f), "model", "left").where("_f is null or score >= _f").drop("_f")  # one row a model


def top_k(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    if n <= 0:
        return rows
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def clusters(rows: DataFrame, by: Sequence[str], threshold: float) -> DataFrame:
    """rows with ``cluster``: the least cand of those joined by overlaps, within each group.

    One native fold per group: each box joins the sets that it overlaps into one.
    """
    cols = [c for c in rows.columns if c not in by]
    groups = rows.groupBy(*by).agg(F.array_sort(F.collect_list(_packed(cols, (F.col("cand"),)))).alias("_all"))
    none = F.transform(F.filter("_all", lambda x: F.lit(False)), lambda x: F.array(x))

    def join(acc: Column, x: Column) -> Column:
        told = F.transform(acc, lambda s: F.struct(s.alias("s"), F.exists(s, lambda k: G.iou(G.part(k), G.part(x)) >= threshold).alias("meets")))

        def joined(t: Column) -> Column:
            sets = lambda met: F.transform(F.filter(t, lambda y: y["meets"] if met else ~y["meets"]), lambda y: y["s"])
            return F.concat(sets(False), F.array(F.concat(F.flatten(sets(True)), F.array(x))))

        return F.get(F.transform(F.array(told), joined), F.lit(0))  # a name for what is used twice

    sets = groups.select(*by, F.explode(F.aggregate("_all", none, join)).alias("_s"))
    out = sets.select(*by, F.array_min(F.transform("_s", lambda k: k["cand"])).alias("cluster"), F.explode("_s").alias("_k"))
    return out.select(*by, *[F.col(f"_k.{c}") for c in cols], "cluster")


def collapse(rows: DataFrame, models: DataFrame, threshold: float, unknown: int = 99) -> DataFrame:
    """One survivor of each cluster of a class: by model priority, then score, then cand; with the models that agree.

    Without a positive threshold every box survives alone.
    """
    m = F.broadcast(models.select("model", F.col("priority").alias("_p")))  # one row a model
    if threshold <= 0:
        return rows.withColumns({"agreement": F.lit(1).cast("long"), "models": F.array("model")})
    c = clusters(rows, ["img", "cls"], threshold).join(m, "model", "left").withColumn("_p", F.coalesce("_p", F.lit(unknown)))
    own = [x for x in rows.columns if x not in ("img", "cls")]
    best = c.groupBy("img", "cls", "cluster").agg(
        F.min(F.struct(F.col("_p"), (-F.col("score")).alias("_s"), F.col("cand").alias("_c"), *[F.col(x) for x in own])).alias("_b"),
        F.sort_array(F.collect_set("model")).alias("models"),
    )
    return best.select("img", "cls", *[F.col(f"_b.{x}") for x in own], F.size("models").cast("long").alias("agreement"), "models").select(*rows.columns, "agreement", "models")


def cross_class(rows: DataFrame, classes: DataFrame, confusions: DataFrame, models: DataFrame, threshold: float = 0.5, unknown: int = 99) -> DataFrame:
    """Suppression across classes: pairs in order, the loser by agreement, priority, score, else the second.

    A box that loses as the outer one of a pair goes on to suppress within its own row, as a
    first element is tested once only.
    """
    r = rows.join(F.broadcast(classes.select("cls", "exempt")), "cls", "left").join(F.broadcast(models.select("model", F.col("priority").alias("_p"))), "model", "left")
    pair_list = F.broadcast(confusions.agg(F.collect_list(F.struct("a", "b")).alias("_pairs")))  # one row
    r = r.withColumn("_p", F.coalesce("_p", F.lit(unknown))).crossJoin(pair_list)
    first = F.min(F.struct((-F.col("score")).alias("s"), F.col("cand"))).over(Window.partitionBy("img", "cls"))
    cols = [c for c in rows.columns if c != "img"]
    order = (F.col("_f")["s"], F.col("_f")["cand"], F.col("cls"), -F.col("score"), F.col("cand"))
    r = r.withColumn("_f", first)
    groups = r.groupBy("img").agg(F.array_sort(F.collect_list(_packed([*cols, "exempt", "_p"], order))).alias("_all"), F.first("_pairs").alias("_pairs"))
    groups = groups.withColumn("_all", F.transform("_all", lambda x, i: x.withField("_i", i)))
    none = F.transform(F.filter("_all", lambda x: F.lit(False)), lambda x: x["cand"])

    def beats(a: Column, b: Column) -> Column:
        """Whether the first of two wins."""
        return (
            F.when(a["agreement"] != b["agreement"], a["agreement"] > b["agreement"])
            .when(a["_p"] != b["_p"], a["_p"] < b["_p"])
            .when(a["score"] != b["score"], a["score"] > b["score"])
            .otherwise(True)
        )

    def outer(lost: Column, a: Column) -> Column:
        def hits(b: Column) -> Column:
            confused = F.exists(F.col("_pairs"), lambda p: ((p["a"] == a["cls"]) & (p["b"] == b["cls"])) | ((p["a"] == b["cls"]) & (p["b"] == a["cls"])))
            return (a["cls"] != b["cls"]) & ~b["exempt"] & (G.iou(G.part(a), G.part(b)) > threshold) & ~confused & ~F.array_contains(lost, b["cand"])

        later = F.slice("_all", a["_i"] + 2, F.size("_all"))
        losers = F.transform(F.filter(later, hits), lambda b: F.when(beats(a, b), b["cand"]).otherwise(a["cand"]))
        return F.when(F.coalesce(a["exempt"], F.lit(True)) | F.array_contains(lost, a["cand"]), lost).otherwise(F.array_union(lost, losers))

    out = groups.withColumn("_lost", F.aggregate("_all", none, outer)).select("img", F.explode(F.filter("_all", lambda x: ~F.array_contains(F.col("_lost"), x["cand"]))).alias("_k"))
    return out.select("img", *[F.col(f"_k.{c}") for c in cols]).select(*rows.columns)


def route(rows: DataFrame, classes: DataFrame, models: DataFrame, tiers: Sequence[int], agreement: int, least: float) -> DataFrame:
    """rows with decision: auto_accept for classes of the tiers, seen by enough models at their floor or above."""
    r = rows.join(F.broadcast(classes.select("cls", "tier")), "cls", "left").join(F.broadcast(models.select("model", "floor_score")), "model", "left")
    ok = F.col("tier").isin(*tiers) & (F.col("agreement") >= agreement) & (F.col("score") >= F.coalesce("floor_score", F.lit(least)))
    return r.withColumn("decision", F.when(F.coalesce(ok, F.lit(False)), "auto_accept").otherwise("evaluate")).select(*rows.columns, "decision")


def average_merge(rows: DataFrame, by: Sequence[str], threshold: float) -> DataFrame:
    """Each free row absorbs all later free ones that overlap it, the box being a running mean in which later rows weigh more."""
    distinct = rows.select(*by, "cls", *BOX).distinct()
    groups = distinct.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cls", *BOX))).alias("_all"))
    none = F.transform(F.filter("_all", lambda x: F.lit(False)), lambda x: F.array(x))
    taken = lambda acc, x: F.exists(acc, lambda s: (F.element_at(s, 1) == x) | (G.iou(G.part(F.element_at(s, 1)), G.part(x)) > threshold))
    heads = F.aggregate("_all", none, lambda acc, x: F.when(taken(acc, x), acc).otherwise(F.concat(acc, F.array(F.array(x)))))
    h = groups.withColumn("_heads", F.transform(heads, lambda s: F.element_at(s, 1)))

    def members(head: Column, k: Column) -> Column:
        earlier = F.slice("_heads", F.lit(1), k)
        free = lambda x: ~F.exists(earlier, lambda e: G.iou(G.part(e), G.part(x)) > threshold)
        return F.filter("_all", lambda x: (x > head) & (G.iou(G.part(head), G.part(x)) > threshold) & free(x))

    def mean(a: Column, b: Column) -> Column:
        return F.struct(*[((a[c] + b[c]) / 2).alias(c) for c in BOX])

    merged = F.transform("_heads", lambda head, k: F.aggregate(members(head, k), F.struct(*[head[c].alias(c) for c in BOX]), mean))
    return h.select(*by, F.explode(F.array_distinct(merged)).alias("_m")).select(*by, *[F.col(f"_m.{c}").alias(c) for c in BOX]).distinct()


def gates(orig, load, merged, area_ratio: float, gap: float, lo: float, hi: float) -> Column:
    """Whether a merged box may take the place of the original: area, gap of boxes that do not overlap, shape."""
    dx = F.greatest(F.lit(0.0), F.greatest(load[0] - orig[2], orig[0] - load[2]))
    dy = F.greatest(F.lit(0.0), F.greatest(load[1] - orig[3], orig[1] - load[3]))
    near = (G.iou(orig, load) > 0) | (F.sqrt(dx * dx + dy * dy) <= F.lit(gap) * F.sqrt(F.lit(2.0)))
    return (G.area(merged) / F.greatest(G.area(orig), F.lit(1e-9)) <= area_ratio) & near & G.aspect(merged).between(lo, hi)


def fused(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Score-weighted box of each group."""
    total = F.sum(F.greatest("score", F.lit(1e-6)))
    return rows.groupBy(*by).agg(*[(F.sum(F.col(c) * F.col("score")) / total).alias(c) for c in BOX], F.max("score").alias("score"), F.count_distinct("model").alias("agreement"))
