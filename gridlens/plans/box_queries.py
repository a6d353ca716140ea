"""Queries over boxes: geometry, filters, joins, greedy folds, clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlens.functions import geometry as G
from gridlens.operators import boxes as B
from gridlens.registry import query

# SQL pieces


def area(a: str) -> str:
    return f"(greatest(0e0, {a}.x2 - {a}.x1) * greatest(0e0, {a}.y2 - {a}.y1))"


def inter(a: str, b: str) -> str:
    return f"(greatest(0e0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0e0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"


def union(a: str, b: str) -> str:
    return f"({area(a)} + {area(b)} - {inter(a, b)})"


def iou(a: str, b: str) -> str:
    return f"CASE WHEN {union(a, b)} > 0 THEN {inter(a, b)} / {union(a, b)} ELSE 0e0 END"


def fold(source: str, by: str, order: str, suppresses: str, out: str = "cand") -> str:
    """Greedy suppression by recursion over ranks; suppresses compares k (kept) and x."""
    on = " AND ".join(f"k.{c} = x.{c}" for c in by.split(", "))
    sel = ", ".join(f"x.{c}" for c in by.split(", "))
    return f"""WITH RECURSIVE src AS ({source}), ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rn FROM src),
sup AS (SELECT {sel}, x.rn, coalesce(list(k.rn) FILTER ({suppresses}), []) AS s FROM ranked x LEFT JOIN ranked k ON {on} AND k.rn < x.rn GROUP BY ALL),
walk AS (SELECT {by}, rn, [rn] AS kept FROM sup WHERE rn = 1 UNION ALL
  SELECT {sel}, x.rn, CASE WHEN list_has_any(x.s, k.kept) THEN k.kept ELSE list_append(k.kept, x.rn) END FROM walk k JOIN sup x ON {on} AND x.rn = k.rn + 1),
kept AS (SELECT {by}, unnest(arg_max(kept, rn)) AS rn FROM walk GROUP BY {by})
SELECT {out} FROM ranked JOIN kept USING ({by}, rn)"""


def links(source: str) -> str:
    """Clusters of a table's boxes by reachability: adds clu (with cluster), to follow WITH RECURSIVE."""
    return f"""links AS (SELECT a.img, a.cls, a.cand AS a, b.cand AS b FROM {source} a JOIN {source} b ON a.img = b.img AND a.cls = b.cls AND {iou('a', 'b')} >= 0.5e0),
reach AS (SELECT img, cls, a, b FROM links UNION SELECT r.img, r.cls, r.a, l.b FROM reach r JOIN links l ON r.img = l.img AND r.cls = l.cls AND r.b = l.a),
clu AS (SELECT d.*, c.cluster FROM {source} d JOIN (SELECT a AS cand, min(b) AS cluster FROM reach GROUP BY a) c USING (cand))"""


def survivors(source: str) -> str:
    """Adds surv: one box of each cluster with its agreement."""
    return f"""{links(source)}, agree AS (SELECT img, cls, cluster, count(DISTINCT model) AS agreement, list_sort(list(DISTINCT model)) AS models FROM clu GROUP BY ALL),
surv AS (SELECT * FROM (SELECT c.*, m.priority, row_number() OVER (PARTITION BY c.img, c.cls, c.cluster ORDER BY coalesce(m.priority, 99), c.score DESC, c.cand) AS rn FROM clu c LEFT JOIN models m USING (model)) x
  JOIN agree USING (img, cls, cluster) WHERE rn = 1)"""


def across(source: str) -> str:
    """Adds crossed: what the rules across classes leave of a table with agreement and priority.

    A walk over the outer boxes of an image in order, carrying the list of those that lost.
    """
    return f"""firsts AS (SELECT img, cls, row_number() OVER (PARTITION BY img ORDER BY score DESC, cand) AS f FROM (SELECT *, row_number() OVER (PARTITION BY img, cls ORDER BY score DESC, cand) AS k FROM {source}) q WHERE k = 1),
listed AS (SELECT s.*, c.exempt, row_number() OVER (PARTITION BY s.img ORDER BY f.f, s.score DESC, s.cand) AS i FROM {source} s JOIN firsts f USING (img, cls) JOIN classes c USING (cls)),
hits AS (SELECT a.img, a.i, a.cand, coalesce(list({{'b': b.cand, 'loser': CASE WHEN a.agreement <> b.agreement THEN CASE WHEN a.agreement > b.agreement THEN b.cand ELSE a.cand END
    WHEN coalesce(a.priority, 99) <> coalesce(b.priority, 99) THEN CASE WHEN coalesce(a.priority, 99) < coalesce(b.priority, 99) THEN b.cand ELSE a.cand END
    WHEN a.score < b.score THEN a.cand ELSE b.cand END}}) FILTER (b.cand IS NOT NULL), []) AS p
  FROM listed a LEFT JOIN listed b ON a.img = b.img AND a.i < b.i AND a.cls <> b.cls AND NOT a.exempt AND NOT b.exempt AND {iou('a', 'b')} > 0.5e0
    AND NOT EXISTS (SELECT 1 FROM confusions x WHERE (x.a = a.cls AND x.b = b.cls) OR (x.a = b.cls AND x.b = a.cls)) GROUP BY a.img, a.i, a.cand),
tour AS (SELECT img, i, list_transform(p, lambda x: x.loser) AS lost FROM hits WHERE i = 1
  UNION ALL SELECT h.img, h.i, CASE WHEN list_contains(t.lost, h.cand) THEN t.lost ELSE list_concat(t.lost, list_transform(list_filter(h.p, lambda x: NOT list_contains(t.lost, x.b)), lambda x: x.loser)) END
  FROM tour t JOIN hits h ON h.img = t.img AND h.i = t.i + 1),
fallen AS (SELECT DISTINCT unnest(arg_max(lost, i)) AS cand FROM tour GROUP BY img),
crossed AS (SELECT * FROM listed WHERE cand NOT IN (SELECT cand FROM fallen))"""


D = "SELECT * FROM detections"
G2 = "detections a JOIN ground_truth b ON a.img = b.img"


def against_truth(t):
    return t.detections.join(t.ground_truth.select("gt", "img", *[F.col(c).alias(f"b_{c}") for c in B.BOX]), "img")


@query("box_iou", f"SELECT cand, gt, {iou('a', 'b')} AS iou FROM {G2}")
def _(t):
    return against_truth(t).select("cand", "gt", G.iou(G.box(), G.box("b_")).alias("iou"))


@query("box_iou_eps", f"SELECT cand, gt, {inter('a', 'b')} / ({union('a', 'b')} + 1e-6) AS iou FROM {G2}")
def _(t):
    return against_truth(t).select("cand", "gt", G.iou(G.box(), G.box("b_"), 1e-6).alias("iou"))


@query("box_iou_matrix", f"SELECT a.img, max({iou('a', 'b')}) AS best, count(*) AS pairs FROM {G2} GROUP BY a.img")
def _(t):
    return against_truth(t).groupBy("img").agg(F.max(G.iou(G.box(), G.box("b_"))).alias("best"), F.count(F.lit(1)).alias("pairs"))


@query("box_area", f"SELECT cand, {area('d')} AS area FROM detections d")
def _(t):
    return t.detections.select("cand", G.area(G.box()).alias("area"))


@query("box_aspect", "SELECT cand, CASE WHEN y2 > y1 THEN greatest(0e0, x2 - x1) / (y2 - y1) ELSE 0e0 END AS aspect FROM detections")
def _(t):
    return t.detections.select("cand", G.aspect(G.box()).alias("aspect"))


@query("box_convert", """SELECT cand, trunc(x1 * 640)::INT AS px1, trunc(y1 * 480)::INT AS py1, trunc(x2 * 640)::INT AS px2, trunc(y2 * 480)::INT AS py2,
  (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, x2 - x1 AS w, y2 - y1 AS h FROM detections""")  # fmt: skip
def _(t):
    px, c = G.to_pixels(G.box(), 640, 480), G.to_centre(G.box())
    return t.detections.select("cand", *[v.alias(n) for v, n in zip((*px, *c), ("px1", "py1", "px2", "py2", "cx", "cy", "w", "h"), strict=True)])


@query("box_yolo_pixel", """WITH p AS (SELECT cand, greatest(0e0, least(639e0, least(x1 * 640, x2 * 640 - 256))) AS a, greatest(0e0, least(479e0, y1 * 480)) AS b,
  greatest(0e0, least(639e0, greatest(x1 * 640, x2 * 640 - 256))) AS c, greatest(0e0, least(479e0, y2 * 480)) AS d FROM detections)
SELECT cand, CASE WHEN c > a AND d > b THEN a END AS x1, CASE WHEN c > a AND d > b THEN c END AS x2 FROM p""")  # fmt: skip
def _(t):
    # a width that may be negative or zero: right end moved 256 pixels to the left
    a = G.yolo_pixels((F.col("x1") * 640 + (F.col("x2") * 640 - 256)) / 2 / 640, (F.col("y1") + F.col("y2")) / 2, (F.col("x2") * 640 - 256 - F.col("x1") * 640) / 640, F.col("y2") - F.col("y1"), 640, 480)
    return t.detections.select("cand", a["x1"].alias("x1"), a["x2"].alias("x2"))


@query("box_union", f"SELECT cand, gt, least(a.x1, b.x1) AS x1, least(a.y1, b.y1) AS y1, greatest(a.x2, b.x2) AS x2, greatest(a.y2, b.y2) AS y2 FROM {G2}")
def _(t):
    return against_truth(t).select("cand", "gt", *[v.alias(n) for v, n in zip(G.enclosing(G.box(), G.box("b_")), B.BOX, strict=True)])


@query("box_contains", f"SELECT cand, gt FROM {G2} WHERE b.x1 >= a.x1 AND b.y1 >= a.y1 AND b.x2 <= a.x2 AND b.y2 <= a.y2")
def _(t):
    return against_truth(t).where(G.contains(G.box(), G.box("b_"))).select("cand", "gt")


@query("box_contains_frac", f"SELECT cand, gt FROM {G2} WHERE {area('b')} > 0 AND {inter('a', 'b')} / {area('b')} >= 0.85e0")
def _(t):
    return against_truth(t).where(G.contains_share(G.box(), G.box("b_"))).select("cand", "gt")


@query("box_inside_tol", f"""SELECT cand, gt FROM {G2} WHERE b.x1 >= a.x1 - (a.x2 - a.x1) * 0.125e0 AND b.y1 >= a.y1 - (a.y2 - a.y1) * 0.125e0
  AND b.x2 <= a.x2 + (a.x2 - a.x1) * 0.125e0 AND b.y2 <= a.y2 + (a.y2 - a.y1) * 0.125e0""")  # fmt: skip
def _(t):
    return against_truth(t).where(G.contains_tol(G.box(), G.box("b_"), 0.125)).select("cand", "gt")


@query("box_crop", """SELECT cand, greatest(0, trunc((x1 - (x2 - x1) * 0.125e0) * 640)::INT) AS left_px, least(640, trunc((x2 + (x2 - x1) * 0.125e0) * 640)::INT) AS right_px FROM detections""")
def _(t):
    pad = (F.col("x2") - F.col("x1")) * 0.125
    return t.detections.select("cand", F.greatest(F.lit(0), ((F.col("x1") - pad) * 640).cast("int")).alias("left_px"), F.least(F.lit(640), ((F.col("x2") + pad) * 640).cast("int")).alias("right_px"))


@query("box_clip_valid", """WITH c AS (SELECT cand, greatest(0e0, least(1e0, x1 - 0.25e0)) AS a, greatest(0e0, least(1e0, x2 - 0.25e0)) AS b FROM detections) SELECT cand, a AS x1, b AS x2 FROM c WHERE b > a""")
def _(t):
    c = t.detections.select("cand", G.clamp(F.col("x1") - 0.25).alias("x1"), G.clamp(F.col("x2") - 0.25).alias("x2"))
    return c.where("x2 > x1")


EDGE = "((x1 <= 0.03125e0)::INT + (y1 <= 0.03125e0)::INT + (x2 >= 0.96875e0)::INT + (y2 >= 0.96875e0)::INT)"
ASPECT = "CASE WHEN y2 > y1 THEN (x2 - x1) / (y2 - y1) ELSE 0e0 END"
REASON = f"""CASE WHEN (x2 - x1) * (y2 - y1) < 0.0625e0 OR (x2 - x1) * (y2 - y1) > 0.09e0 THEN 'area' WHEN {ASPECT} <= 0 OR {ASPECT} < 0.875e0 OR {ASPECT} > 1.125e0 THEN 'aspect' WHEN {EDGE} >= 2 THEN 'edge' END"""
GEO = {"lo": 0.0625, "hi": 0.09, "ar_lo": 0.875, "ar_hi": 1.125, "near": 0.03125}


@query("flt_geometric", f"SELECT cand, {REASON} AS reason FROM detections")
def _(t):
    return t.detections.select("cand", B.geometric_reason(**GEO).alias("reason"))


@query("flt_model_score", "SELECT d.cand FROM detections d LEFT JOIN models m USING (model) WHERE m.floor_score IS NULL OR d.score >= m.floor_score")
def _(t):
    return B.score_floor(t.detections, t.models).select("cand")


@query("flt_conf", "SELECT cand FROM detections WHERE score >= 0.5e0")
def _(t):
    return t.detections.where("score >= 0.5").select("cand")


@query("flt_class", "SELECT cand, 0 AS cls FROM detections WHERE cls IN (0, 2)")
def _(t):
    return t.detections.where("cls in (0, 2)").select("cand", F.lit(0).alias("cls"))


@query("flt_bad_box", f"""WITH f AS (SELECT cand, y2 - y1 > 0.28125e0 AS tall, x2 - x1 > 0.265625e0 AS wide, {EDGE} >= 2 AS edge, (x2 - x1) * (y2 - y1) > 0.085e0 AS large FROM detections)
SELECT count(*) AS n, count(*) FILTER (tall) AS tall, count(*) FILTER (wide) AS wide, count(*) FILTER (edge) AS edge, count(*) FILTER ((tall AND wide AND edge) OR (tall AND NOT wide) OR large) AS bad FROM f""")  # fmt: skip
def _(t):
    b = G.box()
    f = t.detections.select((G.height(b) > 0.28125).alias("tall"), (G.width(b) > 0.265625).alias("wide"), (G.edges_touched(b, 0.03125) >= 2).alias("edge"), (G.area(b) > 0.085).alias("large"))
    n = lambda e: F.count_if(F.expr(e))
    return f.agg(F.count(F.lit(1)).alias("n"), n("tall").alias("tall"), n("wide").alias("wide"), n("edge").alias("edge"), n("(tall and wide and edge) or (tall and not wide) or large").alias("bad"))


@query("prj_quality", "SELECT cand, CASE WHEN score < 0.4e0 THEN 'bad' WHEN score < 0.6e0 THEN 'partial' WHEN score < 0.8e0 THEN 'loose' ELSE 'good' END AS quality FROM detections")
def _(t):
    s = F.col("score")
    return t.detections.select("cand", F.when(s < 0.4, "bad").when(s < 0.6, "partial").when(s < 0.8, "loose").otherwise("good").alias("quality"))


@query("prj_two_box", f"SELECT a.cand, b.gt, {iou('a', 'b')} AS iou, {iou('a', 'b')} < 0.95e0 AS review FROM {G2} WHERE a.cls = b.cls")
def _(t):
    j = t.detections.join(t.ground_truth.select("gt", "img", "cls", *[F.col(c).alias(f"b_{c}") for c in B.BOX]), ["img", "cls"])
    return j.withColumn("iou", G.iou(G.box(), G.box("b_"))).select("cand", "gt", "iou", (F.col("iou") < 0.95).alias("review"))


@query("prj_class_ids", "SELECT cand, 0 AS merged, cls AS original, row_number() OVER (PARTITION BY img ORDER BY cand) - 1 AS sequential FROM detections")
def _(t):
    return t.detections.select("cand", F.lit(0).alias("merged"), F.col("cls").alias("original"), (F.row_number().over(Window.partitionBy("img").orderBy("cand")) - 1).cast("long").alias("sequential"))


@query("prj_confusion_id", """SELECT d.cand, g.gt, CASE WHEN d.cls = g.cls THEN g.cls ELSE 5 + g.cls * 4 + d.cls - (d.cls > g.cls)::INT END AS id FROM detections d JOIN ground_truth g ON d.img = g.img""")
def _(t):
    j = t.detections.select("cand", "img", "cls").join(t.ground_truth.select("gt", "img", F.col("cls").alias("e")), "img")
    return j.select("cand", "gt", F.expr("case when cls = e then e else 5 + e * 4 + cls - int(cls > e) end").alias("id"))


@query("prj_validate_cat", """SELECT cand, CASE WHEN score < 0.0625e0 THEN 'parse_error' WHEN score < 0.4e0 THEN 'discard' WHEN cand % 3 = 0 THEN 'fix' WHEN score < 0.75e0 THEN 'fix' ELSE 'keep' END AS category FROM detections""")
def _(t):
    # a missing match (every third is a mismatch here, every other third has none) counts as one
    match = F.when(F.col("cand") % 3 == 0, False).when(F.col("cand") % 3 == 1, True)
    s = F.col("score")
    return t.detections.select("cand", F.when(s < 0.0625, "parse_error").when(s < 0.4, "discard").when(~F.coalesce(match, F.lit(True)), "fix").when(s < 0.75, "fix").otherwise("keep").alias("category"))


@query("prj_rater_cat", """SELECT cand, CASE WHEN score >= 0.75e0 THEN 'correct' WHEN model = 0 THEN 'wrong_class' WHEN model = 1 THEN 'loose_box' WHEN score < 0.25e0 THEN 'no_object' ELSE 'partial' END AS category FROM detections""")
def _(t):
    s, m = F.col("score"), F.col("model")
    return t.detections.select("cand", F.when(s >= 0.75, "correct").when(m == 0, "wrong_class").when(m == 1, "loose_box").when(s < 0.25, "no_object").otherwise("partial").alias("category"))


@query("prj_clean", """SELECT cand, img, CASE WHEN cand % 3 = 0 THEN (cls + 1) % 5 ELSE cls END AS cls FROM detections WHERE cand % 4 <> 0
  AND img NOT IN (SELECT img FROM detections WHERE score < 0.03125e0)""")  # fmt: skip
def _(t):
    bad = t.detections.where("score < 0.03125").select("img")
    ok = t.detections.where("cand % 4 <> 0").join(bad, "img", "left_anti")
    return ok.select("cand", "img", F.when(F.col("cand") % 3 == 0, (F.col("cls") + 1) % 5).otherwise(F.col("cls")).alias("cls"))


# joins


@query("jn_iou_pairs", f"SELECT a.cand AS a_cand, b.cand AS b_cand, {iou('a', 'b')} AS iou FROM detections a JOIN detections b ON a.img = b.img AND a.cls = b.cls AND a.cand < b.cand WHERE {iou('a', 'b')} >= 0.5e0")
def _(t):
    return B.iou_pairs(t.detections, ["img", "cls"], 0.5).select("a_cand", "b_cand", "iou")


@query("jn_gt_match", f"SELECT a.cand, b.gt, {iou('a', 'b')} AS iou FROM {G2} AND a.cls = b.cls WHERE {iou('a', 'b')} >= 0.5e0")
def _(t):
    j = t.detections.join(t.ground_truth.select("gt", "img", "cls", *[F.col(c).alias(f"b_{c}") for c in B.BOX]), ["img", "cls"])
    return j.withColumn("iou", G.iou(G.box(), G.box("b_"))).where("iou >= 0.5").select("cand", "gt", "iou")


@query("jn_gt_any", f"""WITH p AS (SELECT cand, gt, b.cls AS gcls, {iou('a', 'b')} AS iou FROM {G2}),
r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY iou DESC, gt) AS rn FROM p) SELECT cand, gt, gcls, iou FROM r WHERE rn = 1""")  # fmt: skip
def _(t):
    j = t.detections.join(t.ground_truth.select("gt", "img", F.col("cls").alias("gcls"), *[F.col(c).alias(f"b_{c}") for c in B.BOX]), "img")
    best = j.groupBy("cand").agg(F.min(F.struct((-G.iou(G.box(), G.box("b_"))).alias("n"), "gt", "gcls")).alias("m"))
    return best.select("cand", "m.gt", "m.gcls", (-F.col("m.n")).alias("iou"))


@query("jn_stem", "SELECT DISTINCT d.img FROM detections d JOIN ground_truth g ON 'img_' || d.img = 'img_' || g.img")
def _(t):
    a = t.detections.select(F.concat(F.lit("img_"), "img").alias("stem"), "img").distinct()
    b = t.ground_truth.select(F.concat(F.lit("img_"), "img").alias("stem")).distinct()
    return a.join(b, "stem", "left_semi").select("img")


@query("jn_image_ann", "SELECT img FROM (SELECT DISTINCT img FROM ground_truth) g WHERE img NOT IN (SELECT img FROM detections WHERE model = 2 AND score > 0.625e0)")
def _(t):
    return t.ground_truth.select("img").distinct().join(t.detections.where("model = 2 and score > 0.625"), "img", "left_anti")


@query("jn_full_models", "SELECT img, count(*) FILTER (model = 0) AS m0, count(*) FILTER (model = 1) AS m1, count(*) FILTER (model = 2) AS m2, count(*) FILTER (model = 3) AS m3 FROM detections GROUP BY img")
def _(t):
    return t.detections.groupBy("img").agg(*[F.count_if(F.col("model") == k).alias(f"m{k}") for k in range(4)])


@query("set_union", "SELECT img, cls, count(*) AS n FROM (SELECT img, cls FROM detections UNION ALL SELECT img, cls FROM ground_truth) u GROUP BY ALL")
def _(t):
    return t.detections.select("img", "cls").unionByName(t.ground_truth.select("img", "cls")).groupBy("img", "cls").agg(F.count(F.lit(1)).alias("n"))


@query("jn_combos", """SELECT a.model::VARCHAR AS combo FROM models a UNION ALL SELECT a.model || '+' || b.model FROM models a JOIN models b ON a.model < b.model
UNION ALL SELECT a.model || '+' || b.model || '+' || c.model FROM models a JOIN models b ON a.model < b.model JOIN models c ON b.model < c.model UNION ALL SELECT string_agg(model, '+' ORDER BY model) FROM models""")  # fmt: skip
def _(t):
    m = F.broadcast(t.models.select("model"))  # the models of a run: a handful
    two = m.alias("a").join(m.alias("b"), F.col("a.model") < F.col("b.model")).select(F.col("a.model").alias("a"), F.col("b.model").alias("b"))
    three = two.join(m.select(F.col("model").alias("c")), F.col("b") < F.col("c"))
    every = m.agg(F.sort_array(F.collect_list("model")).alias("l")).where("size(l) >= 4").select(F.array_join(F.transform("l", lambda x: x.cast("string")), "+").alias("combo"))
    return m.select(F.col("model").cast("string").alias("combo")).union(two.select(F.concat_ws("+", "a", "b"))).union(three.select(F.concat_ws("+", "a", "b", "c"))).union(every)


# windows


@query("win_topk_class", "SELECT cand FROM (SELECT cand, row_number() OVER (PARTITION BY img, cls ORDER BY score DESC, cand) AS rn FROM detections) r WHERE rn <= 3")
def _(t):
    return B.top_k(t.detections, ["img", "cls"], [F.col("score").desc(), F.col("cand")], 3).select("cand")


@query("win_interleave", """SELECT img, cand FROM (SELECT img, cand, row_number() OVER (PARTITION BY img ORDER BY rn, model) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY img, model ORDER BY score DESC, cand) AS rn FROM detections) x) y WHERE place <= 6""")  # fmt: skip
def _(t):
    own = F.row_number().over(Window.partitionBy("img", "model").orderBy(F.col("score").desc(), "cand"))
    return B.top_k(t.detections.withColumn("rn", own), ["img"], [F.col("rn"), F.col("model")], 6).select("img", "cand")


# greedy folds


def nms(name: str, sql: str, by, order, test, source=lambda t: t.detections):
    query(name, sql)(lambda t: B.greedy(source(t), by, order(), test).select("cand"))


IOU = iou("k", "x")
nms("nms_torch", fold(D, "img", "score DESC, cand", f"{inter('k', 'x')} / ({union('k', 'x')} + 1e-6) > 0.5e0"), ["img"], B.score_first, B.over(0.5, True, 1e-6))
nms("nms_class", fold(D, "img, cls", "score DESC, cand", f"{IOU} > 0.5e0"), ["img", "cls"], B.score_first, B.over(0.5))
nms("nms_ge", fold(D, "img, cls", "score DESC, cand", f"{IOU} >= 0.5e0"), ["img", "cls"], B.score_first, B.over(0.5, False))
nms("nms_eval", fold(D, "img, model", "score DESC, cand", f"coalesce(NOT ({inter('k', 'x')} / nullif({union('k', 'x')}, 0) <= 0.5e0), true)"), ["img", "model"], B.score_first, B.over_or_empty(0.5))
nms("nms_uniform", fold(D, "img", "cand DESC", f"{IOU} > 0.5e0"), ["img"], lambda: (-F.col("cand"),), B.over(0.5))
SMALL = f"least({area('k')}, {area('x')}) / greatest({area('k')}, {area('x')}) < 0.875e0"
INSIDE = f"CASE WHEN {area('x')} < {area('k')} THEN {inter('k', 'x')} / {area('x')} >= 0.85e0 ELSE {inter('k', 'x')} / {area('k')} >= 0.85e0 END"
nms("nms_size_aware", fold(D, "img, cls", "score DESC, cand", f"{IOU} >= 0.5e0 AND NOT ({SMALL} AND {INSIDE})"), ["img", "cls"], B.score_first, B.size_aware(0.5, 0.875))
nms("nms_dedup_v2", fold(D, "img, cls", "score DESC, cand", f"{IOU} >= 0.625e0"), ["img", "cls"], B.score_first, B.over(0.625, False))
BY_AREA = "(x2 - x1) * (y2 - y1) DESC, cand"


def area_first():
    return -G.area(G.box()), F.col("cand")


nms("nms_nested", fold(D, "img", BY_AREA, "x.x1 >= k.x1 AND x.y1 >= k.y1 AND x.x2 <= k.x2 AND x.y2 <= k.y2 AND abs(1 - (x.y2 - x.y1) / (k.y2 - k.y1)) <= 0.15e0"), ["img"], area_first, B.nested(0.15))
nms("nms_cross_query", fold("SELECT * FROM detections WHERE model IN (0, 2)", "img", "score DESC, cand", f"{IOU} > 0.5e0"), ["img"], B.score_first, B.over(0.5), lambda t: t.detections.where("model in (0, 2)"))


@query("nms_inner", f"""SELECT cand FROM detections x WHERE NOT EXISTS (SELECT 1 FROM detections k WHERE k.img = x.img AND {area('k')} > {area('x')}
  AND x.x1 >= k.x1 - (k.x2 - k.x1) * 0.0625e0 AND x.y1 >= k.y1 - (k.y2 - k.y1) * 0.0625e0 AND x.x2 <= k.x2 + (k.x2 - k.x1) * 0.0625e0 AND x.y2 <= k.y2 + (k.y2 - k.y1) * 0.0625e0)""")  # fmt: skip
def _(t):
    return B.without_larger_outer(t.detections, ["img"], 0.0625).select("cand")


@query("agg_global_max", "SELECT cand, score / max(score) OVER (PARTITION BY model) AS score FROM detections")
def _(t):
    top = t.detections.groupBy("model").agg(F.max("score").alias("_m"))
    return t.detections.join(F.broadcast(top), "model").select("cand", F.when(F.col("_m") > 0, F.col("score") / F.col("_m")).otherwise(F.col("score")).alias("score"))  # one row a model


@query("pipe_merge", fold(D, "img, cls", "score DESC, cand", f"{IOU} >= 0.5e0 AND NOT ({SMALL} AND {INSIDE})", "img, cls, cand, model"))
def _(t):
    return B.greedy(t.detections, ["img", "cls"], B.score_first(), B.size_aware(0.5, 0.875)).select("img", "cls", "cand", "model")


FIRST_PASS = fold("SELECT * FROM detections WHERE score >= 0.25e0", "img, model", "score DESC, cand", f"{IOU} >= 0.5e0", "*").replace("SELECT * FROM ranked", "SELECT cand, img, cls, model, score / max(score) OVER (PARTITION BY model) AS score, x1, y1, x2, y2 FROM ranked")


@query("pipe_fl_pj", fold(D, "img", "score DESC, cand", f"{IOU} >= 0.5e0").replace("WITH RECURSIVE src AS (SELECT * FROM detections)", "WITH RECURSIVE " + FIRST_PASS[len("WITH RECURSIVE "):].replace("src", "src0").replace("ranked", "ranked0").replace("sup", "sup0").replace("walk", "walk0").replace("SELECT cand, img, cls", "src AS (SELECT cand, img, cls").replace(" JOIN kept USING (img, model, rn)", " JOIN kept0 USING (img, model, rn))").replace("kept AS (SELECT img, model", "kept0 AS (SELECT img, model").replace("GROUP BY img, model)\n", "GROUP BY img, model),\n")))
def _(t):
    one = B.greedy(t.detections.where("score >= 0.25"), ["img", "model"], B.score_first(), B.over(0.5, False))
    top = one.groupBy("model").agg(F.max("score").alias("_m"))
    scaled = one.join(F.broadcast(top), "model").withColumn("score", F.col("score") / F.col("_m")).drop("_m")  # one row a model
    return B.greedy(scaled, ["img"], B.score_first(), B.over(0.5, False)).select("cand")


# clusters and rules

LINKS = links("detections")
SURVIVORS = survivors("detections")


@query("clu_collapse", f"WITH RECURSIVE {SURVIVORS} SELECT img, cls, cand, score, agreement, models FROM surv")
def _(t):
    return B.collapse(t.detections, t.models, 0.5).select("img", "cls", "cand", "score", "agreement", "models")


@query("agg_agreement", f"WITH RECURSIVE {LINKS} SELECT img, cls, cluster, count(DISTINCT model) AS agreement, count(*) AS members FROM clu GROUP BY ALL")
def _(t):
    return B.clusters(t.detections, ["img", "cls"], 0.5).groupBy("img", "cls", "cluster").agg(F.count_distinct("model").alias("agreement"), F.count(F.lit(1)).alias("members"))


@query("agg_fusion", f"""WITH RECURSIVE {LINKS} SELECT img, cls, cluster, sum(x1 * score) / sum(greatest(score, 1e-6)) AS x1, sum(y2 * score) / sum(greatest(score, 1e-6)) AS y2 FROM clu GROUP BY ALL""")
def _(t):
    f = B.fused(B.clusters(t.detections, ["img", "cls"], 0.5), ["img", "cls", "cluster"])
    return f.select("img", "cls", "cluster", "x1", "y2")


@query("agg_cluster_quality", f"""WITH RECURSIVE {LINKS}, q AS (SELECT img, cls, cluster, least(count(DISTINCT model) / 2e0, 1e0) AS support, max(score) AS top, count(DISTINCT model) AS agreement FROM clu GROUP BY ALL),
v AS (SELECT *, 0.55e0 * support + 0.45e0 * top AS quality, 0.45e0 * (1e0 - support) + 0.4e0 * greatest(0e0, 0.65e0 - top) AS gap FROM q)
SELECT img, cls, cluster, round(quality, 6) AS quality, round(least(1e0, greatest(gap, 1e0 - quality)), 6) AS uncertainty FROM v""")  # fmt: skip
def _(t):
    c = B.clusters(t.detections, ["img", "cls"], 0.5).groupBy("img", "cls", "cluster").agg(F.count_distinct("model").alias("n"), F.max("score").alias("top"), F.max_by(F.struct(*B.BOX), F.struct("score", -F.col("cand"))).alias("b"))
    q = quality(c)
    return q.select("img", "cls", "cluster", F.round("quality", 6).alias("quality"), F.round("uncertainty", 6).alias("uncertainty"))


def quality(c, need: int = 2):
    """quality, uncertainty and geometry of clusters with n models, top score and box b."""
    b = G.part(F.col("b"))
    shape = (b[2] - b[0]) / F.greatest(b[3] - b[1], F.lit(1e-6))
    checks = [G.area(b) > 0.001, G.area(b) < 0.9, b[2] - b[0] > 0.01, b[3] - b[1] > 0.01, (shape > 0.05) & (shape < 20), ~((b[0] <= 0) & (b[2] >= 0.99)), ~((b[1] <= 0) & (b[3] >= 0.99))]
    geometry = sum((x.cast("int") for x in checks[1:]), checks[0].cast("int")) / F.lit(7.0)
    support = F.least(F.col("n") / F.lit(float(need)), F.lit(1.0))
    evidence = F.when(F.col("top") <= 0, support).otherwise(0.55 * support + 0.45 * F.col("top"))
    q = c.withColumn("geometry", geometry).withColumn("support", support)
    q = q.withColumn("quality", G.clamp(evidence - F.greatest(F.lit(0.0), 0.7 - F.col("geometry")) * 0.15))
    doubt = F.when(F.col("top") <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), 0.65 - F.col("top")))
    gap = 0.45 * (1 - F.col("support")) + 0.4 * doubt + 0.15 * F.greatest(F.lit(0.0), 0.6 - F.col("geometry"))
    return q.withColumn("uncertainty", G.clamp(F.greatest(gap, 1 - F.col("quality"))))


@query("clu_consensus", f"""WITH RECURSIVE {LINKS}, q AS (SELECT img, cls, cluster, least(count(DISTINCT model) / 2e0, 1e0) AS support, max(score) AS top, count(DISTINCT model) AS n FROM clu GROUP BY ALL),
v AS (SELECT *, 0.55e0 * support + 0.45e0 * top AS quality, 0.45e0 * (1e0 - support) + 0.4e0 * greatest(0e0, 0.65e0 - top) AS gap FROM q),
u AS (SELECT *, least(1e0, greatest(gap, 1e0 - quality)) AS uncertainty FROM v)
SELECT img, cls, cluster, CASE WHEN n >= 2 AND quality >= 0.75e0 AND uncertainty <= 0.35e0 THEN 'accepted' WHEN quality < 0.4e0 AND uncertainty > 0.5e0 AND top < 0.5e0 AND n < 2 THEN 'rejected' ELSE 'flagged' END AS decision FROM u""")  # fmt: skip
def _(t):
    c = B.clusters(t.detections, ["img", "cls"], 0.5).groupBy("img", "cls", "cluster").agg(F.count_distinct("model").alias("n"), F.max("score").alias("top"), F.max_by(F.struct(*B.BOX), F.struct("score", -F.col("cand"))).alias("b"))
    d = F.when(F.col("geometry") < 0.35, "rejected").when(F.expr("n >= 2 and quality >= 0.75 and uncertainty <= 0.35"), "accepted").when(F.expr("quality < 0.4 and uncertainty > 0.5 and top < 0.5 and n < 2"), "rejected").otherwise("flagged")
    return quality(c).select("img", "cls", "cluster", d.alias("decision"))


@query("clu_avg_merge", fold("SELECT DISTINCT img, cls, x1, y1, x2, y2 FROM detections", "img", "cls, x1, y1, x2, y2", f"{IOU} > 0.7e0", "*").replace("SELECT * FROM ranked JOIN kept USING (img, rn)", f""", heads AS (SELECT ranked.* FROM ranked JOIN kept USING (img, rn)),
took AS (SELECT x.img, min(k.rn) AS head, x.rn, any_value(x.x1) AS x1, any_value(x.y1) AS y1, any_value(x.x2) AS x2, any_value(x.y2) AS y2 FROM ranked x JOIN heads k ON k.img = x.img AND k.rn < x.rn AND {IOU} > 0.7e0 GROUP BY x.img, x.rn),
parts AS (SELECT img, rn AS head, rn, x1, y1, x2, y2 FROM heads UNION ALL SELECT img, head, rn, x1, y1, x2, y2 FROM took)
SELECT DISTINCT img, {", ".join(f"list_reduce(list({c} ORDER BY rn), lambda a, b: (a + b) / 2) AS {c}" for c in ("x1", "y1", "x2", "y2"))} FROM parts GROUP BY img, head""").replace("GROUP BY img)\n,", "GROUP BY img),"))
def _(t):
    return B.average_merge(t.detections, ["img"], 0.7)


@query("sup_cross", f"WITH RECURSIVE {SURVIVORS}, {across('surv')} SELECT img, cls, cand FROM crossed")
def _(t):
    return B.cross_class(B.collapse(t.detections, t.models, 0.5).drop("models"), t.classes, t.confusions, t.models).select("img", "cls", "cand")


@query("tag_coexist", "SELECT a.class_name AS a, b.class_name AS b, EXISTS (SELECT 1 FROM confusions p WHERE p.a = a.cls AND p.b = b.cls) AS confused, a.exempt OR b.exempt AS exempt FROM classes a JOIN classes b ON a.cls < b.cls")
def _(t):
    a = t.classes.select(F.col("cls").alias("a_cls"), F.col("class_name").alias("a"), F.col("exempt").alias("ea"))
    b = t.classes.select(F.col("cls").alias("b_cls"), F.col("class_name").alias("b"), F.col("exempt").alias("eb"))
    p = t.confusions.select(F.col("a").alias("a_cls"), F.col("b").alias("b_cls"), F.lit(True).alias("c"))
    j = a.join(F.broadcast(b), F.col("a_cls") < F.col("b_cls")).join(F.broadcast(p), ["a_cls", "b_cls"], "left")  # the registry of classes
    return j.select("a", "b", F.coalesce("c", F.lit(False)).alias("confused"), (F.col("ea") | F.col("eb")).alias("exempt"))


@query("rte_candidates", f"""WITH RECURSIVE {SURVIVORS} SELECT s.cand, CASE WHEN c.tier IN (1, 2) AND s.agreement >= 2 AND s.score >= coalesce(m.floor_score, 0.5e0) THEN 'auto_accept' ELSE 'evaluate' END AS decision
FROM surv s LEFT JOIN classes c USING (cls) LEFT JOIN models m ON m.model = s.model""")  # fmt: skip
def _(t):
    return B.route(B.collapse(t.detections, t.models, 0.5), t.classes, t.models, (1, 2), 2, 0.5).select("cand", "decision")


@query("rte_confusions", f"""SELECT a.cand AS a_cand, b.cand AS b_cand, {iou('a', 'b')} AS iou FROM detections a JOIN detections b ON a.img = b.img AND a.cand < b.cand
JOIN confusions p ON (p.a = a.cls AND p.b = b.cls) OR (p.a = b.cls AND p.b = a.cls) WHERE {iou('a', 'b')} > 0.3e0""")  # fmt: skip
def _(t):
    both = t.confusions.union(t.confusions.select("b", "a")).select(F.col("a").alias("a_cls"), F.col("b").alias("b_cls"))
    return B.iou_pairs(t.detections, ["img"], 0.3, True, ["cls"]).join(F.broadcast(both), ["a_cls", "b_cls"], "left_semi").select("a_cand", "b_cand", "iou")


@query("rte_next_stage", f"""WITH RECURSIVE {SURVIVORS}, r AS (SELECT s.img, bool_or(NOT coalesce(c.tier IN (1, 2) AND s.agreement >= 2 AND s.score >= coalesce(m.floor_score, 0.5e0), false)) AS open
FROM surv s LEFT JOIN classes c USING (cls) LEFT JOIN models m ON m.model = s.model GROUP BY s.img) SELECT img, CASE WHEN open THEN 'evaluate' ELSE 'finalize' END AS next FROM r""")  # fmt: skip
def _(t):
    r = B.route(B.collapse(t.detections, t.models, 0.5), t.classes, t.models, (1, 2), 2, 0.5)
    return r.groupBy("img").agg(F.when(F.bool_or(F.col("decision") == "evaluate"), "evaluate").otherwise("finalize").alias("next"))


@query("agg_nms_stats", fold(D, "img, model", "score DESC, cand", f"{IOU} > 0.5e0", "model, count(*) AS kept") + " GROUP BY model")
def _(t):
    return B.greedy(t.detections, ["img", "model"], B.score_first(), B.over(0.5)).groupBy("model").agg(F.count(F.lit(1)).alias("kept"))


@query("agg_conf_prompts", "SELECT model, cls, count(DISTINCT img) AS images, count(*) AS n, round(avg(score), 6) AS mean_score FROM detections GROUP BY model, cls")
def _(t):
    return t.detections.groupBy("model", "cls").agg(F.count_distinct("img").alias("images"), F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("agg_detect_summary", "SELECT model, count(*) AS total, count(DISTINCT img) AS images, count(*) FILTER (cls = 0) AS c0, count(*) FILTER (cls = 1) AS c1 FROM detections GROUP BY model")
def _(t):
    return t.detections.groupBy("model").agg(F.count(F.lit(1)).alias("total"), F.count_distinct("img").alias("images"), F.count_if(F.col("cls") == 0).alias("c0"), F.count_if(F.col("cls") == 1).alias("c1"))


@query("agg_det_avg", "SELECT count(DISTINCT img) AS images, count(*) AS n, count(*) / count(DISTINCT img) AS per_image FROM detections")
def _(t):
    return t.detections.agg(F.count_distinct("img").alias("images"), F.count(F.lit(1)).alias("n")).withColumn("per_image", F.col("n") / F.col("images"))


@query("agg_filter_funnel", f"""WITH s AS (SELECT d.*, {REASON} AS reason FROM detections d) SELECT count(*) AS input, count(*) FILTER (reason IS NULL) AS geometric,
  count(*) FILTER (reason IS NULL AND (m.floor_score IS NULL OR score >= m.floor_score)) AS scored FROM s LEFT JOIN models m USING (model)""")  # fmt: skip
def _(t):
    s = t.detections.withColumn("reason", B.geometric_reason(**GEO)).join(F.broadcast(t.models.select("model", "floor_score")), "model", "left")
    return s.agg(F.count(F.lit(1)).alias("input"), F.count_if(F.expr("reason is null")).alias("geometric"), F.count_if(F.expr("reason is null and (floor_score is null or score >= floor_score)")).alias("scored"))
