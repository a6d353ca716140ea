"""Queries over detection quality, embeddings and the annotation stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions import geometry as G
from gridlens.functions.scalars import norm_alias
from gridlens.operators import annotate as A
from gridlens.operators import boxes as B
from gridlens.operators import metrics as M
from gridlens.operators import similarity as S
from gridlens.operators.scratch import settled
from gridlens.plans.box_queries import GEO, REASON, across, area, fold, inter, iou, survivors
from gridlens.registry import query

MATCH = f"""near AS (SELECT a.cand, a.score, b.gt, {iou('a', 'b')} AS iou FROM detections a JOIN ground_truth b ON a.img = b.img AND a.cls = b.cls),
bestg AS (SELECT cand, score, gt FROM (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY iou DESC, gt) AS rn FROM near WHERE iou >= 0.5e0 - 1e-6) x WHERE rn = 1),
hits AS (SELECT cand FROM (SELECT cand, row_number() OVER (PARTITION BY gt ORDER BY score DESC, cand) AS rn FROM bestg) x WHERE rn = 1),
matched AS (SELECT d.*, h.cand IS NOT NULL AS tp FROM detections d LEFT JOIN hits h USING (cand))"""


def curve_sql(by: str) -> str:
    return f"""WITH {MATCH}, totals AS (SELECT cls, count(*) AS total_gt FROM ground_truth GROUP BY cls),
run AS (SELECT m.*, row_number() OVER w AS rn, sum(tp::INT) OVER (PARTITION BY {by} ORDER BY score DESC, cand ROWS UNBOUNDED PRECEDING)::BIGINT AS acc_tp, total_gt
  FROM matched m JOIN totals USING (cls) WINDOW w AS (PARTITION BY {by} ORDER BY score DESC, cand)),
pr AS (SELECT *, acc_tp / (acc_tp + (rn - acc_tp) + 1e-6) AS precision, acc_tp / (total_gt + 1e-6) AS recall FROM run),
curve AS (SELECT *, 2 * (precision * recall) / (precision + recall + 1e-6) AS f1, max(precision) OVER (PARTITION BY {by} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS envelope FROM pr)"""


def matched(t) -> DataFrame:
    return M.match(t.detections, t.ground_truth)


def scored(t) -> DataFrame:
    """What curves read of the matches."""
    return matched(t).select("cand", "model", "cls", "score", "tp")


def curve(t, by=("cls",), hits=False) -> DataFrame:
    return M.ranked(scored(t), t.ground_truth, by, hits)


@query("ev_match", f"WITH {MATCH} SELECT cand, img, cls, tp FROM matched")
def _(t):
    return matched(t).select("cand", "img", "cls", "tp")


@query("win_cum_pr", f"{curve_sql('cls')} SELECT cand, rn, acc_tp, rn - acc_tp AS acc_fp, precision, recall, f1 FROM curve")
def _(t):
    return curve(t).select("cand", "rn", "acc_tp", "acc_fp", "precision", "recall", "f1")


@query("win_pr_envelope", f"{curve_sql('model, cls')} SELECT cand, model, rn, envelope FROM curve")
def _(t):
    return curve(t, ("model", "cls")).select("cand", "model", "rn", "envelope")


AP = "sum((acc_tp / (total_gt + 1e-6) - (acc_tp - 1) / (total_gt + 1e-6)) * envelope) FILTER (tp)"


@query("ev_ap", f"{curve_sql('cls')} SELECT cls, round(coalesce({AP}, 0e0), 7) AS ap FROM curve GROUP BY cls UNION ALL SELECT -1, round(avg(ap), 7) FROM (SELECT coalesce({AP}, 0e0) AS ap FROM curve GROUP BY cls)")
def _(t):
    # a mean over one row is that row: the rollup gives the classes and their mean from one curve
    ap = M.class_scores(scored(t), t.ground_truth).rollup("cls").agg(F.avg("ap").alias("ap"))
    return ap.select(F.coalesce(F.col("cls").cast("long"), F.lit(-1)).alias("cls"), F.round("ap", 7).alias("ap"))


@query("win_best_f1", f"{curve_sql('cls')} SELECT cls, f1 AS max_f1, precision, score AS conf FROM (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY f1 DESC, rn) AS k FROM curve) x WHERE k = 1")
def _(t):
    return M.best_f1(curve(t))


@query("ev_map_report", f"""{curve_sql('model, cls')}, r AS (SELECT model, cls, coalesce({AP}, 0e0) AS ap, max(f1) AS max_f1 FROM curve GROUP BY model, cls)
SELECT model, cls::VARCHAR AS class_id, round(ap, 7) AS ap, round(max_f1, 7) AS max_f1 FROM r UNION ALL SELECT model, 'mAP', round(avg(ap), 7), round(avg(max_f1), 7) FROM r GROUP BY model""")  # fmt: skip
def _(t):
    r = M.class_scores(scored(t), t.ground_truth, ("model", "cls"))
    r = r.rollup("model", "cls").agg(F.avg("ap").alias("ap"), F.avg("max_f1").alias("max_f1")).where("model is not null")
    return r.select("model", F.coalesce(F.col("cls").cast("string"), F.lit("mAP")).alias("class_id"), F.round("ap", 7).alias("ap"), F.round("max_f1", 7).alias("max_f1"))


@query("snk_pdf", f"{curve_sql('cls')} SELECT cls, rn, recall, precision, f1, score AS conf FROM curve WHERE tp")
def _(t):
    """The points of the curves that a plot draws: one for each true positive."""
    return curve(t, hits=True).select("cls", "rn", "recall", "precision", "f1", F.col("score").alias("conf"))


THRESHOLDS = "ths AS (SELECT i / 8e0 AS th FROM range(1, 8) r(i))"


def thresholds(t) -> DataFrame:
    return t.spark.range(1, 8).select((F.col("id") / F.lit(8.0)).alias("th"))


@query("ev_thresholds", f"""WITH {MATCH}, {THRESHOLDS}, totals AS (SELECT cls, count(*) AS g FROM ground_truth GROUP BY cls),
c AS (SELECT m.model, m.cls, th, count(*) FILTER (tp) AS tp, count(*) FILTER (NOT tp) AS fp FROM matched m JOIN ths ON score >= th GROUP BY ALL)
SELECT model, cls, th, tp, fp, g - tp AS fn, tp / (tp + fp + 1e-6) AS precision, tp / (g + 1e-6) AS recall FROM c JOIN totals USING (cls)""")  # fmt: skip
def _(t):
    return M.at_thresholds(matched(t), t.ground_truth, thresholds(t), ("model", "cls")).drop("f1")


@query("srt_pivot_cols", f"""WITH {MATCH} SELECT cls, count(*) FILTER (tp AND model = 0) AS tp_0, count(*) FILTER (tp AND model = 1) AS tp_1, count(*) FILTER (tp AND model = 2) AS tp_2, count(*) FILTER (tp AND model = 3) AS tp_3 FROM matched GROUP BY cls""")
def _(t):
    p = matched(t).where("tp").groupBy("cls").pivot("model", [0, 1, 2, 3]).agg(F.count(F.lit(1)))
    return p.select("cls", *[F.coalesce(F.col(str(k)), F.lit(0)).cast("long").alias(f"tp_{k}") for k in range(4)])


CONFUSED = f"""best AS (SELECT cand, gcls FROM (SELECT a.cand, b.cls AS gcls, {iou('a', 'b')} AS iou, row_number() OVER (PARTITION BY a.cand ORDER BY {iou('a', 'b')} DESC, b.gt) AS rn FROM matched a JOIN ground_truth b ON a.img = b.img WHERE NOT a.tp) x
  WHERE rn = 1 AND iou >= 0.5e0 - 1e-6), conf AS (SELECT CASE WHEN tp THEN cls ELSE coalesce(gcls, -1) END AS gt_cls, cls, score FROM matched LEFT JOIN best USING (cand))"""


@query("ev_confusion", f"WITH {MATCH}, {CONFUSED} SELECT gt_cls, cls, count(*) AS n, count(*) FILTER (score >= 0.5e0) AS n_half FROM conf GROUP BY ALL")
def _(t):
    c = M.confusion(matched(t), t.ground_truth)
    return c.groupBy("gt_cls", "cls").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") >= 0.5).alias("n_half"))


@query("ev_precision_target", f"""{curve_sql('cls')}, targets AS (SELECT unnest([0.03125e0, 0.0625e0, 0.125e0, 0.75e0]) AS target)
SELECT cls, target, conf, recall, f1 FROM (SELECT cls, target, score AS conf, recall, f1, row_number() OVER (PARTITION BY cls, target ORDER BY precision, rn) AS k FROM curve JOIN targets ON precision >= target) x WHERE k = 1""")  # fmt: skip
def _(t):
    targets = t.spark.createDataFrame([(0.03125,), (0.0625,), (0.125,), (0.75,)], "target double")
    return M.at_precision(curve(t), targets)


@query("ev_summary_table", f"""WITH {MATCH}, g AS (SELECT count(*) AS n FROM ground_truth), s AS (SELECT model, count(*) FILTER (tp) AS tp, count(*) AS dets FROM matched GROUP BY model)
SELECT model, tp, dets - tp AS fp, tp / dets AS precision, tp / n AS recall FROM s, g""")  # fmt: skip
def _(t):
    s = matched(t).groupBy("model").agg(F.count_if("tp").alias("tp"), F.count(F.lit(1)).alias("dets"))
    g = t.ground_truth.agg(F.count(F.lit(1)).alias("n"))
    return s.join(F.broadcast(g), F.lit(True)).select("model", "tp", (F.col("dets") - F.col("tp")).alias("fp"), (F.col("tp") / F.col("dets")).alias("precision"), (F.col("tp") / F.col("n")).alias("recall"))  # one row


SWEEP = (0.25, 0.5, 0.75)


def swept(th: float) -> str:
    """(model, kept, tp, nms) after suppression at a threshold."""
    kept = fold("SELECT * FROM detections", "img, cls, model", "score DESC, cand", f"{iou('k', 'x')} > {th}e0", "ranked.* EXCLUDE (rn)")
    return f"""SELECT k.model, count(*) AS kept, count(h.cand) AS tp, {th}e0 AS nms FROM ({kept}) k LEFT JOIN (
  SELECT cand FROM (SELECT cand, row_number() OVER (PARTITION BY gt ORDER BY score DESC, cand) AS rn FROM (
    SELECT cand, score, gt FROM (SELECT a.cand, a.score, b.gt, row_number() OVER (PARTITION BY a.cand ORDER BY {iou('a', 'b')} DESC, b.gt) AS rn
      FROM ({kept}) a JOIN ground_truth b ON a.img = b.img AND a.cls = b.cls WHERE {iou('a', 'b')} >= 0.5e0 - 1e-6) n WHERE rn = 1) m) c WHERE rn = 1) h USING (cand) GROUP BY k.model"""


SWEPT = " UNION ALL ".join(f"({swept(th)})" for th in SWEEP)


@query("ev_sweep", f"SELECT * FROM ({SWEPT}) s")
def _(t):
    """Kept boxes and their true positives for every model and suppression threshold, all in one plan."""
    out = None
    for th in SWEEP:
        kept = B.greedy(t.detections, ["img", "cls", "model"], B.score_first(), B.over(th))
        s = M.match(kept, t.ground_truth).groupBy("model").agg(F.count(F.lit(1)).alias("kept"), F.count_if("tp").alias("tp")).withColumn("nms", F.lit(th))
        out = s if out is None else out.unionByName(s)
    return out


@query("win_best_combo", f"""SELECT nms, arg_max(model, (f1, -model)) AS best_f1, arg_max(CASE WHEN precision >= 0.6e0 THEN model END, (precision >= 0.6e0, recall, -model)) FILTER (precision >= 0.6e0) AS best_recall FROM (
  SELECT *, 2 * precision * recall / (precision + recall + 1e-6) AS f1 FROM (SELECT nms, model, tp / kept AS precision, tp / (SELECT count(*) FROM ground_truth) AS recall FROM ({SWEPT}) s) p) q GROUP BY nms""")
def _(t):
    """Per suppression threshold the best model by F1, and the best recall among those of some precision, or none."""
    out = None
    n = t.ground_truth.agg(F.count(F.lit(1)).alias("n"))
    for th in SWEEP:
        kept = B.greedy(t.detections, ["img", "cls", "model"], B.score_first(), B.over(th))
        s = M.match(kept, t.ground_truth).groupBy("model").agg(F.count(F.lit(1)).alias("kept"), F.count_if("tp").alias("tp")).withColumn("nms", F.lit(th))
        out = s if out is None else out.unionByName(s)
    s = out.join(F.broadcast(n), F.lit(True)).withColumn("precision", F.col("tp") / F.col("kept")).withColumn("recall", F.col("tp") / F.col("n"))
    s = s.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + M.EPS))
    return s.groupBy("nms").agg(
        F.max_by("model", F.struct("f1", -F.col("model"))).alias("best_f1"),
        F.max_by(F.when(F.col("precision") >= 0.6, F.col("model")), F.struct((F.col("precision") >= 0.6), F.col("recall"), -F.col("model"))).alias("best_recall"),
    )


@query("ev_coco")
def _(t):
    """The protocol's summary of every model and area range, of each class and (cls null) on average of the classes; -1 where no box is held.

    A class of a model is a class of its own, and each model has the whole truth.
    """
    k = 1 << 20
    d = settled(t.detections.select("img", "model", (F.col("model") * k + F.col("cls")).alias("cls"), "cand", "score", *B.BOX))
    models = d.select("model").distinct()  # a registry: one row a model
    g = t.ground_truth.join(F.broadcast(models), F.lit(True)).withColumn("cls", F.col("model") * k + F.col("cls"))
    s = M.coco_results(d, g).withColumns({"model": F.floor(F.col("cls") / k), "cls": F.col("cls") % k})
    at = lambda th: F.avg(F.when(F.abs(F.col("th") - th) < 0.025, F.col("ap")))
    stats = {"ap": F.avg("ap"), "ap50": at(0.5), "ap75": at(0.75), **{f"ar_{most}": F.avg(f"ar_{most}") for most in M.COCO_RECALLS}}
    sets = [["model", "area"], ["model", "area", "cls"]]
    return s.groupingSets(sets, "model", "cls", "area").agg(*[F.coalesce(F.round(c, 6), F.lit(-1.0)).alias(name) for name, c in stats.items()])


PAIRED = f"""ordered AS (SELECT *, row_number() OVER (PARTITION BY img ORDER BY score DESC, cand) AS i FROM detections WHERE model = 1),
options AS (SELECT a.img, a.i, a.cand, coalesce(list({{'gt': b.gt, 'iou': b.iou}} ORDER BY b.iou DESC, b.gt) FILTER (b.gt IS NOT NULL), []) AS o FROM ordered a LEFT JOIN (
  SELECT a.cand, b.gt, {iou('a', 'b')} AS iou FROM ordered a JOIN ground_truth b ON a.img = b.img WHERE {iou('a', 'b')} >= 0.5e0) b USING (cand) GROUP BY a.img, a.i, a.cand),
walk AS (SELECT img, i, cand, list_filter(o, lambda x: true)[1] AS hit, CASE WHEN len(o) > 0 THEN [o[1].gt] ELSE [] END AS taken FROM options WHERE i = 1
  UNION ALL SELECT n.img, n.i, n.cand, list_filter(n.o, lambda x: NOT list_contains(w.taken, x.gt))[1],
    list_concat(w.taken, list_transform(list_filter(n.o, lambda x: NOT list_contains(w.taken, x.gt))[1:1], lambda x: x.gt)) FROM walk w JOIN options n ON n.img = w.img AND n.i = w.i + 1),
paired AS (SELECT img, cand, hit.gt AS gt, hit.iou AS iou FROM walk WHERE hit IS NOT NULL)"""


@query("jn_det_match", f"WITH RECURSIVE {PAIRED} SELECT * FROM paired")
def _(t):
    return M.one_to_one(t.detections.where("model = 1"), t.ground_truth, "img", 0.5)


@query("agg_match_stats", f"""WITH RECURSIVE {PAIRED} SELECT count(*) AS matched, (SELECT count(*) FROM detections WHERE model = 1) - count(*) AS only_left, (SELECT count(*) FROM ground_truth) - count(*) AS only_right,
  round(avg(iou), 6) AS mean_iou, min(iou) AS min_iou FROM paired""")
def _(t):
    m = M.one_to_one(t.detections.where("model = 1"), t.ground_truth, "img", 0.5)
    left = t.detections.where("model = 1").agg(F.count(F.lit(1)).alias("l"))
    right = t.ground_truth.agg(F.count(F.lit(1)).alias("r"))
    s = m.agg(F.count(F.lit(1)).alias("matched"), F.round(F.avg("iou"), 6).alias("mean_iou"), F.min("iou").alias("min_iou"))
    return s.join(left).join(right).select("matched", (F.col("l") - F.col("matched")).alias("only_left"), (F.col("r") - F.col("matched")).alias("only_right"), "mean_iou", "min_iou")  # one row each


# embeddings

POSITIVE, NEGATIVE, JUNK = (0, 1, 2), (3, 4), (5,)


def prompts(t) -> DataFrame:
    kind = F.when(F.col("vec_id").isin(*POSITIVE), "positive").when(F.col("vec_id").isin(*NEGATIVE), "negative").otherwise("junk")
    return t.embeddings.where("vec_id < 6").select(F.concat(F.lit("p"), "vec_id").alias("prompt"), kind.alias("kind"), F.col("vec_id").alias("pos"), "embedding")


SCORES = """sc AS (SELECT e.vec_id, p.vec_id AS pos, 1 / (1 + exp(-(list_inner_product(e.embedding::DOUBLE[], p.embedding::DOUBLE[]) * 4e0 - 0.5e0))) AS score
FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 6) p),
mx AS (SELECT vec_id, max(score) FILTER (pos < 3) AS p, max(score) FILTER (pos IN (3, 4)) AS n, max(score) FILTER (pos = 5) AS j FROM sc GROUP BY vec_id)"""


@query("flt_emb", f"WITH {SCORES} SELECT vec_id, round(p, 6) AS score FROM mx WHERE p > 0.45e0 AND n < 0.6e0 AND p - n > 0.02e0 AND j < 0.7e0 AND p - j > 0.01e0")
def _(t):
    s = S.prompt_scores(t.embeddings, prompts(t), 4.0, -0.5)
    return S.prompt_filter(s, 0.45, 0.6, 0.02, 0.7, 0.01).select("vec_id", F.round("p", 6).alias("score"))


@query("prj_best_class", f"WITH {SCORES} SELECT vec_id, 'p' || arg_max(pos, (score, -pos)) AS prompt FROM sc WHERE pos < 3 GROUP BY vec_id")
def _(t):
    s = S.prompt_scores(t.embeddings, prompts(t).where("kind = 'positive'"), 4.0, -0.5)
    return s.groupBy("vec_id").agg(F.max_by("prompt", F.struct("score", -F.col("pos"))).alias("prompt"))


@query("agg_pass_rate", f"WITH {SCORES} SELECT count(*) FILTER (p > 0.45e0 AND n < 0.6e0 AND p - n > 0.02e0 AND j < 0.7e0 AND p - j > 0.01e0) / greatest(count(*), 1) AS pass_rate FROM mx")
def _(t):
    passed = S.prompt_filter(S.prompt_scores(t.embeddings, prompts(t), 4.0, -0.5), 0.45, 0.6, 0.02, 0.7, 0.01).agg(F.count(F.lit(1)).alias("p"))
    return passed.join(t.embeddings.agg(F.count(F.lit(1)).alias("n"))).select((F.col("p") / F.greatest("n", F.lit(1))).alias("pass_rate"))  # one row each


def knn_sql(k: int, th: float, source: str = "embeddings") -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER (ORDER BY vec_id) AS i FROM {source}),
u AS (SELECT i, vec_id, list_transform(e, lambda x: x / greatest(sqrt(list_inner_product(e, e)), 1e-8)) AS e FROM v),
n AS (SELECT a.i, b.i AS j, list_inner_product(a.e, b.e) AS s FROM u a, u b),
top AS (SELECT i, j, s FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY (i <> j)::INT, s DESC, j) AS rn FROM n) x WHERE rn <= {k} AND i <> j AND s >= {th}e0),
bad AS (SELECT u.i, coalesce(list(t.i) FILTER (t.i < u.i), []) AS s FROM u LEFT JOIN top t ON t.j = u.i GROUP BY u.i),
walk AS (SELECT i, [i] AS kept FROM bad WHERE i = 1 UNION ALL SELECT b.i, CASE WHEN list_has_any(b.s, w.kept) THEN w.kept ELSE list_append(w.kept, b.i) END FROM walk w JOIN bad b ON b.i = w.i + 1),
kept AS (SELECT unnest(arg_max(kept, i)) AS i FROM walk)
SELECT vec_id FROM u JOIN kept USING (i)"""


@query("knn_dedup", knn_sql(5, 0.35))
def _(t):
    return S.knn_dedup(t.embeddings, 5, 0.35)


@query("knn_greedy_full", knn_sql(1_000_000, 0.35))
def _(t):
    return S.knn_dedup(t.embeddings, S.ALL, 0.35)


def knn_by_label(k: int, th: float) -> str:
    """As knn_sql, within each label."""
    sql = knn_sql(k, th).replace("SELECT vec_id, embedding", "SELECT vec_id, label AS g, embedding").replace("row_number() OVER (ORDER BY vec_id)", "row_number() OVER (PARTITION BY label ORDER BY vec_id)")
    sql = sql.replace("SELECT i, vec_id, list_transform", "SELECT g, i, vec_id, list_transform").replace("SELECT a.i, b.i AS j", "SELECT a.g, a.i, b.i AS j").replace("FROM u a, u b", "FROM u a JOIN u b USING (g)")
    sql = sql.replace("SELECT i, j, s FROM (SELECT *, row_number() OVER (PARTITION BY i ", "SELECT g, i, j, s FROM (SELECT *, row_number() OVER (PARTITION BY g, i ").replace("SELECT u.i, coalesce(", "SELECT u.g, u.i, coalesce(").replace("ON t.j = u.i GROUP BY u.i", "ON t.j = u.i AND t.g = u.g GROUP BY u.g, u.i")
    sql = sql.replace("SELECT i, [i] AS kept", "SELECT g, i, [i] AS kept").replace("SELECT b.i, CASE", "SELECT b.g, b.i, CASE").replace("ON b.i = w.i + 1", "ON b.g = w.g AND b.i = w.i + 1")
    return sql.replace("SELECT unnest(arg_max(kept, i)) AS i FROM walk", "SELECT g, unnest(arg_max(kept, i)) AS i FROM walk GROUP BY g").replace("JOIN kept USING (i)", "JOIN kept USING (g, i)")


@query("knn_two_phase", knn_sql(5, 0.35, f"(SELECT * FROM embeddings WHERE vec_id IN ({knn_by_label(5, 0.35)})) e"))
def _(t):
    """Within each label first, then over what is left."""
    first = S.knn_dedup(t.embeddings, 5, 0.35, "label")
    left = t.embeddings.join(first, "vec_id", "left_semi")
    return S.knn_dedup(left, 5, 0.35)


@query("agg_dedup_rate", f"SELECT n, k, 1 - k / greatest(n, 1) AS dedup_rate FROM (SELECT count(*) AS n FROM embeddings) a, (SELECT count(*) AS k FROM ({knn_sql(5, 0.35)}) q) b")
def _(t):
    kept = S.knn_dedup(t.embeddings, 5, 0.35).agg(F.count(F.lit(1)).alias("k"))
    return kept.join(t.embeddings.agg(F.count(F.lit(1)).alias("n"))).select("n", "k", (1 - F.col("k") / F.greatest("n", F.lit(1))).alias("dedup_rate"))  # one row each


@query("fn_cosine", "SELECT a.vec_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b")
def _(t):
    one = t.embeddings.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return t.embeddings.join(F.broadcast(one), F.lit(True)).select("vec_id", F.round(S.dot(F.col("embedding"), F.col("q")), 6).alias("sim"))  # one row


@query("fn_l2norm", "SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.round(S.norm(F.col("embedding")), 6).alias("norm"))


@query("fn_sigmoid", "SELECT cand, round(1 / (1 + exp(-(score * 4e0 - 1e0))), 9) AS p FROM detections")
def _(t):
    return t.detections.select("cand", F.round(S.sigmoid(F.col("score"), 4.0, -1.0), 9).alias("p"))


# annotation stages

NORM = "trim(regexp_replace(replace(replace(lower(correct_class), '_', ' '), '-', ' '), '\\s+', ' ', 'g'))"
ROUTED = f"""vr AS (SELECT v.cand, v.img, c.class_name, v.correct_class, v.confidence, a.canonical FROM verdicts v JOIN detections d USING (cand) JOIN classes c ON c.cls = d.cls LEFT JOIN aliases a ON a.alias = {NORM}),
routed AS (SELECT cand, img, class_name, CASE WHEN correct_class IS NOT NULL AND correct_class <> class_name AND lower(correct_class) IN ('other', 'unknown', 'none') THEN 'rejected'
  WHEN confidence < 0.3e0 THEN 'rejected' WHEN confidence >= 0.5e0 THEN 'accepted' ELSE 'review' END AS decision,
  CASE WHEN correct_class IS NOT NULL AND correct_class <> class_name AND lower(correct_class) NOT IN ('other', 'unknown', 'none') AND canonical <> class_name THEN canonical END AS relabel FROM vr)"""


def routed(t) -> DataFrame:
    return A.route_verdicts(t.verdicts, t.detections, t.classes, t.aliases, 0.3, 0.5)


@query("flt_routed", f"WITH {ROUTED} SELECT cand, decision, relabel FROM routed")
def _(t):
    return routed(t).select("cand", "decision", "relabel")


@query("jn_alias", f"SELECT cand, canonical FROM verdicts JOIN aliases ON alias = {NORM}")
def _(t):
    v = t.verdicts.select("cand", norm_alias(F.col("correct_class")).alias("alias"))
    return v.join(F.broadcast(t.aliases), "alias").select("cand", "canonical")  # the registry's synonyms


@query("jn_prompt_class", "SELECT cand, cls FROM verdicts JOIN classes ON class_name = lower(trim(correct_class))")
def _(t):
    v = t.verdicts.select("cand", F.lower(F.trim("correct_class")).alias("class_name"))
    return v.join(F.broadcast(t.classes.select("class_name", "cls")), "class_name").select("cand", "cls")  # the registry of classes


COMBINED = """comb AS (SELECT r.cand, CASE WHEN NOT changed THEN e.decision WHEN adjudicate = 'accept' THEN 'accepted' ELSE 'review' END AS verdict,
  CASE WHEN NOT changed OR adjudicate = 'reject' THEN 'original' ELSE 'refined' END AS source FROM refinements r JOIN routed e USING (cand) WHERE e.decision <> 'rejected')"""


@query("ann_combine", f"WITH {ROUTED}, {COMBINED} SELECT cand, verdict, source FROM comb")
def _(t):
    return A.combine(t.refinements, routed(t)).select("cand", "verdict", "source")


CANON = f"""{ROUTED}, {COMBINED}, canon AS (SELECT d.cand, d.img, coalesce(r.relabel, c.class_name) AS class_name, CASE WHEN b.source = 'refined' THEN f.rx1 ELSE d.x1 END AS x1, coalesce(b.source = 'refined', false) AS was_refined
FROM detections d JOIN classes c ON c.cls = d.cls JOIN routed r USING (cand) LEFT JOIN comb b USING (cand) LEFT JOIN refinements f USING (cand)
WHERE r.decision <> 'rejected' AND CASE WHEN b.cand IS NULL THEN r.decision = 'accepted' ELSE b.verdict = 'accepted' END)"""


@query("ann_canonical", f"WITH {CANON} SELECT cand, class_name, x1, was_refined FROM canon")
def _(t):
    return A.canonical(t.detections, t.classes, routed(t), t.refinements).select("cand", "class_name", "x1", "was_refined")


@query("jn_canonical", f"WITH {CANON} SELECT img, count(*) AS n, count(*) FILTER (was_refined) AS refined FROM canon GROUP BY img")
def _(t):
    c = A.canonical(t.detections, t.classes, routed(t), t.refinements)
    return c.groupBy("img").agg(F.count(F.lit(1)).alias("n"), F.count_if("was_refined").alias("refined"))


@query("ann_review", f"""WITH {ROUTED}, {COMBINED} SELECT r.cand, 'evaluate_review' AS reason FROM routed r LEFT JOIN refinements f USING (cand) WHERE decision = 'review' AND f.cand IS NULL
UNION ALL SELECT cand, 'refine_review' FROM comb WHERE verdict = 'review'""")  # fmt: skip
def _(t):
    return A.review_items(routed(t), t.refinements)


@query("set_diff_drop", f"WITH {CANON}, g AS (SELECT cand, {REASON.replace('x2', 'd.x2').replace('x1', 'd.x1').replace('y1', 'd.y1').replace('y2', 'd.y2')} AS reason FROM detections d JOIN canon USING (cand)) SELECT cand, 'geometric' AS reason FROM g WHERE reason IS NOT NULL")
def _(t):
    c = A.canonical(t.detections, t.classes, routed(t), t.refinements).select("cand")
    before = t.detections.join(c, "cand", "left_semi")
    after = before.where(B.geometric_reason(**GEO).isNull())
    return A.dropped(before, after, "geometric").select("cand", "reason")


CANON_BOXES = CANON.replace("SELECT d.cand, d.img, coalesce(r.relabel, c.class_name) AS class_name, CASE WHEN b.source = 'refined' THEN f.rx1 ELSE d.x1 END AS x1,", """SELECT d.cand, d.img, d.model, d.score, coalesce(r.relabel, c.class_name) AS class_name,
  CASE WHEN b.source = 'refined' THEN f.rx1 ELSE d.x1 END AS x1, CASE WHEN b.source = 'refined' THEN f.ry1 ELSE d.y1 END AS y1, CASE WHEN b.source = 'refined' THEN f.rx2 ELSE d.x2 END AS x2, CASE WHEN b.source = 'refined' THEN f.ry2 ELSE d.y2 END AS y2,""")
CHAIN = f"""capped AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY img, cls ORDER BY score DESC, cand) AS place FROM surv) x WHERE place <= 3)"""


@query("ann_finalize", f"""WITH RECURSIVE {CANON_BOXES}, core AS (SELECT canon.*, classes.cls FROM canon JOIN classes USING (class_name)), geo AS (SELECT * FROM core WHERE ({REASON}) IS NULL), {survivors('geo')}, {CHAIN}, {across('capped')}
SELECT cand, CASE WHEN cand IN (SELECT cand FROM crossed) THEN 'kept' WHEN cand IN (SELECT cand FROM capped) THEN 'cross_class' WHEN cand IN (SELECT cand FROM surv) THEN 'cap' WHEN cand IN (SELECT cand FROM geo) THEN 'duplicate' ELSE 'geometric' END AS outcome FROM core""")
def _(t):
    return A.finalize(A.canonical(t.detections, t.classes, routed(t), t.refinements), t.classes, t.models, t.confusions, GEO, 0.5, 3)


@query("ann_detect_chain", f"""WITH RECURSIVE geo AS (SELECT d.* FROM detections d LEFT JOIN models USING (model) WHERE ({REASON}) IS NULL AND (floor_score IS NULL OR score >= floor_score)), {survivors('geo')}, {CHAIN}, {across('capped')}
SELECT x.img, x.cand, x.agreement, CASE WHEN c.tier IN (1, 2) AND x.agreement >= 2 AND x.score >= coalesce(m.floor_score, 0.5e0) THEN 'auto_accept' ELSE 'evaluate' END AS decision FROM crossed x JOIN classes c USING (cls) LEFT JOIN models m ON m.model = x.model""")
def _(t):
    return A.detect_chain(t.detections, t.classes, t.models, t.confusions, GEO, 0.5, 3).select("img", "cand", "agreement", "decision")


ENC = {"x1": "least(a.x1, b.x1)", "y1": "least(a.y1, b.y1)", "x2": "greatest(a.x2, b.x2)", "y2": "greatest(a.y2, b.y2)"}
ENC_AREA = f"(({ENC['x2']} - {ENC['x1']}) * ({ENC['y2']} - {ENC['y1']}))"


@query("ann_refine_gate", f"""SELECT a.cand, b.gt FROM detections a JOIN ground_truth b ON a.img = b.img AND a.cls = b.cls WHERE {ENC_AREA} / {area('a')} <= 3e0
  AND ({inter('a', 'b')} > 0 OR sqrt(power(greatest(0e0, greatest(b.x1 - a.x2, a.x1 - b.x2)), 2) + power(greatest(0e0, greatest(b.y1 - a.y2, a.y1 - b.y2)), 2)) <= 0.03125e0 * sqrt(2e0))
  AND ({ENC['x2']} - {ENC['x1']}) / ({ENC['y2']} - {ENC['y1']}) BETWEEN 0.5e0 AND 2e0""")  # fmt: skip
def _(t):
    j = t.detections.join(t.ground_truth.select("gt", "img", "cls", *[F.col(c).alias(f"b_{c}") for c in B.BOX]), ["img", "cls"])
    a, b = G.box(), G.box("b_")
    return j.where(B.gates(a, b, G.enclosing(a, b), 3.0, 0.03125, 0.5, 2.0)).select("cand", "gt")


@query("ann_presence", f"SELECT b.gt, coalesce(max(a.score) FILTER ({iou('a', 'b')} >= 0.3e0), 0e0) AS score FROM ground_truth b LEFT JOIN detections a ON a.img = b.img AND a.cls = b.cls GROUP BY b.gt")
def _(t):
    j = t.ground_truth.select("gt", "img", "cls", *[F.col(c).alias(f"b_{c}") for c in B.BOX]).join(t.detections, ["img", "cls"], "left")
    return j.groupBy("gt").agg(F.coalesce(F.max(F.when(G.iou(G.box(), G.box("b_")) >= 0.3, F.col("score"))), F.lit(0.0)).alias("score"))


@query("ann_refine_chain", "SELECT cand, CASE WHEN cand % 5 <> 0 THEN CASE WHEN cand % 3 = 0 THEN x1 / 4e0 ELSE x1 / 2e0 END ELSE x1 END AS x1, CASE WHEN cand % 5 = 0 THEN 'no_change,no_change' WHEN cand % 3 = 0 THEN 'replaced,replaced' ELSE 'replaced,rejected' END AS outcomes FROM detections")
def _(t):
    steps = F.array(F.struct((F.col("cand") % 5 != 0).alias("changed"), F.lit(True).alias("passes"), F.lit(2.0).alias("by")), F.struct((F.col("cand") % 5 != 0).alias("changed"), (F.col("cand") % 3 == 0).alias("passes"), F.lit(2.0).alias("by")))
    return A.refine_chain(t.detections.select("cand", "x1", steps.alias("steps")))


@query("ann_v1_refine_best", "SELECT cand, score + 0.5e0 - abs((x2 - x1) * (y2 - y1) - 0.0625e0) > 0.75e0 AS replace FROM detections")
def _(t):
    return t.detections.select("cand", (F.col("score") + 0.5 - F.abs((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) - 0.0625) > 0.75).alias("replace"))


@query("ann_v1_verify", f"WITH {ROUTED} SELECT cand, CASE WHEN relabel IS NOT NULL AND decision <> 'rejected' THEN 'relabelled' WHEN decision = 'review' AND correct_class IS NULL THEN 'escalate' WHEN decision = 'review' THEN 'flagged' ELSE decision END AS route FROM routed JOIN (SELECT cand, correct_class FROM verdicts) v USING (cand)")
def _(t):
    r = routed(t).join(t.verdicts.select("cand", "correct_class"), "cand")
    d = F.col("decision")
    return r.select("cand", F.when(F.col("relabel").isNotNull() & (d != "rejected"), "relabelled").when((d == "review") & F.col("correct_class").isNull(), "escalate").when(d == "review", "flagged").otherwise(d).alias("route"))


@query("ann_v1_escalate", f"WITH {ROUTED} SELECT cand FROM detections LEFT JOIN routed r USING (cand) WHERE score < 0.25e0 AND (r.decision IS NULL OR r.decision = 'review')")
def _(t):
    r = routed(t).select("cand", "decision")
    return t.detections.where("score < 0.25").select("cand").join(r, "cand", "left").where("decision is null or decision = 'review'").select("cand")


@query("ann_v1_retry", "SELECT cand, least(cand % 4, 2) AS rounds, cand % 4 <= 2 AS done FROM detections")
def _(t):
    # rows whose effect works at the (cand % 4)th retry, with two retries
    rows = t.detections.select("cand", (F.col("cand") % 4).alias("works_at"))
    return A.retry_rounds(rows, lambda r, k: F.col("works_at") <= k, 2).select("cand", "rounds", "done")


@query("ann_v2_action", f"""WITH {ROUTED}, o AS (SELECT cand, decision, CASE cand % 4 WHEN 0 THEN 'validation_detailed' WHEN 1 THEN 'validation_screening' WHEN 2 THEN 'detailed' ELSE 'screening' END AS stage FROM routed)
SELECT cand, CASE WHEN stage = 'validation_screening' AND decision = 'review' THEN 'human_review' WHEN decision = 'review' THEN 'human_review' ELSE decision END AS action FROM o""")  # fmt: skip
def _(t):
    stage = F.when(F.col("cand") % 4 == 0, "validation_detailed").when(F.col("cand") % 4 == 1, "validation_screening").when(F.col("cand") % 4 == 2, "detailed").otherwise("screening")
    return A.last_word(routed(t).select("cand", "decision", stage.alias("stage")))


@query("ann_v2_fallback", "SELECT img, CASE WHEN count(*) FILTER (model = 2) > 0 THEN 'refined' WHEN count(*) FILTER (model = 1) > 0 THEN 'filtered' ELSE 'proposed' END AS used FROM detections GROUP BY img")
def _(t):
    has = lambda k: F.count_if(F.col("model") == k) > 0
    return t.detections.groupBy("img").agg(F.when(has(2), "refined").when(has(1), "filtered").otherwise("proposed").alias("used"))


@query("ann_v2_repropose", """SELECT d.cand, coalesce(r.score, d.score) AS score, coalesce(r.x1, d.x1) AS x1 FROM (SELECT * FROM detections WHERE model = 0) d LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY img, cls ORDER BY score DESC, cand) AS rn FROM detections WHERE model = 3) x WHERE rn = 1) r ON r.img = d.img AND r.cls = d.cls""")  # fmt: skip
def _(t):
    best = t.detections.where("model = 3").groupBy("img", "cls").agg(F.max_by(F.struct("score", "x1"), F.struct("score", -F.col("cand"))).alias("r"))
    return t.detections.where("model = 0").join(best, ["img", "cls"], "left").select("cand", F.coalesce("r.score", "score").alias("score"), F.coalesce("r.x1", "x1").alias("x1"))


@query("set_refine_ids", f"WITH {ROUTED} SELECT cand FROM routed WHERE decision = 'review' AND cand NOT IN (SELECT cand FROM refinements) UNION SELECT cand FROM refinements WHERE adjudicate = 'review'")
def _(t):
    need = routed(t).where("decision = 'review'").select("cand").join(t.refinements, "cand", "left_anti")
    return need.union(t.refinements.where("adjudicate = 'review'").select("cand")).distinct()


@query("jn_screen_idx", "SELECT v.cand, coalesce(d.cand::VARCHAR, 'x' || v.cand % 40) AS target FROM verdicts v LEFT JOIN (SELECT cand, img, row_number() OVER (PARTITION BY img ORDER BY cand) - 1 AS k FROM detections) d ON d.img = v.img AND d.k = v.cand % 40")
def _(t):
    from pyspark.sql import Window

    d = t.detections.select(F.col("cand").alias("target"), "img", (F.row_number().over(Window.partitionBy("img").orderBy("cand")) - 1).cast("long").alias("k"))
    v = t.verdicts.select("cand", "img", (F.col("cand") % 40).alias("k"))
    return v.join(d, ["img", "k"], "left").select("cand", F.coalesce(F.col("target").cast("string"), F.concat(F.lit("x"), "k")).alias("target"))
