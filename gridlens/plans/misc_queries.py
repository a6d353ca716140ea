"""Queries over labels, datasets, statistics, scalars and streams."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions import scalars as C
from gridlens.operators import stats as ST
from gridlens.operators.scratch import folder, settled
from gridlens.registry import query
from gridlens.sources import datasets as DS
from gridlens.sources import labels as L
from gridlens.sources import tables as TB
from gridlens.streaming import queue as Q

# The boxes as labels: corners taken as centres, so that all six digits are exact.
LABELS = """lab AS (SELECT 'img_' || img AS stem, img, cand, cls AS class_id, x1 AS cx, y1 AS cy, x2 - x1 AS w, y2 - y1 AS h, score AS conf FROM detections)"""
#: As LABELS, every eleventh image without any box.
WITH_EMPTY = """labels_e AS (SELECT img AS file, CASE WHEN img % 11 <> 0 THEN cls END AS class_id, x2 - x1 AS w, y2 - y1 AS h FROM detections WHERE img % 11 <> 0
  UNION ALL SELECT DISTINCT img, NULL, NULL, NULL FROM detections WHERE img % 11 = 0)"""
CATEGORIES = ["bus", "delivery van", "car", "person", "cargo bike"]


def lab(t) -> DataFrame:
    return t.detections.select(
        F.concat(F.lit("img_"), "img").alias("stem"), "img", "cand", F.col("cls").cast("int").alias("class_id"), F.col("x1").alias("cx"), F.col("y1").alias("cy"),
        (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), F.col("score").alias("conf"),
    )


def label_files(t, values=L.CENTRE, empty: bool = True) -> DataFrame:
    rows = lab(t).withColumn("path", F.concat("stem", F.lit(".txt")))
    if empty:
        rows = rows.withColumn("class_id", F.when(F.col("img") % 11 != 0, F.col("class_id")))
    return L.to_label_files(rows, values, order=("cand",))


def labels_e(t) -> DataFrame:
    d = t.detections
    some = d.where("img % 11 <> 0").select(F.col("img").alias("file"), F.col("cls").alias("class_id"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    return some.unionByName(d.where("img % 11 = 0").select(F.col("img").alias("file")).distinct(), allowMissingColumns=True)


@query("src_yolo", f"WITH {LABELS} SELECT stem || '.txt' AS path, class_id, cx, cy, w, h FROM lab WHERE img % 11 <> 0")
def _(t):
    return L.yolo(label_files(t), keep_empty=False).select("path", "class_id", *L.CENTRE)


@query("src_yolo_df", f"WITH {LABELS} SELECT stem || '.txt' AS path, class_id, w FROM lab WHERE img % 11 <> 0 UNION ALL SELECT DISTINCT stem || '.txt', NULL, NULL FROM lab WHERE img % 11 = 0")
def _(t):
    return L.yolo(label_files(t)).select("path", "class_id", "w")


@query("src_yolo_conf", f"WITH {LABELS} SELECT stem || '.txt' AS path, 0 AS class_id, 0.9e0 AS conf FROM lab WHERE img % 11 <> 0")
def _(t):
    return L.yolo_all_or_nothing(label_files(t), 0.9, 0.5).select("path", "class_id", "conf")


@query("src_yolo_fast", f"WITH {LABELS} SELECT stem || '.txt' AS path, class_id, conf FROM lab WHERE img % 11 <> 0")
def _(t):
    return L.yolo(label_files(t, (*L.CENTRE, "conf")), 0.9, keep_empty=False, strict=True).select("path", "class_id", "conf")


@query("src_yolo_extra", f"WITH {LABELS} SELECT stem || '.txt' AS path, class_id, printf('%.6f', conf) AS extra FROM lab WHERE img % 11 <> 0")
def _(t):
    return L.yolo(label_files(t, (*L.CENTRE, "conf")), keep_empty=False, extra=True).select("path", "class_id", F.array_join("extra", " ").alias("extra"))


@query("src_yolo_preds", f"WITH {LABELS} SELECT stem || '.txt' AS path, 1e0 AS conf FROM lab WHERE img % 11 <> 0 UNION ALL SELECT DISTINCT stem || '.txt', NULL FROM lab WHERE img % 11 = 0")
def _(t):
    return L.yolo(label_files(t), 1.0).select("path", "conf")


@query("flt_qrater7", f"WITH {LABELS} SELECT stem || '.txt' AS path, class_id, conf FROM lab WHERE conf >= 0.5e0")
def _(t):
    rows = lab(t).withColumn("path", F.concat("stem", F.lit(".txt")))
    text = F.concat_ws(" ", C.yolo_line(F.col("class_id"), *[F.col(c) for c in L.CENTRE]), F.format_string("%.6f", "conf"), F.lit("good"))
    files = rows.groupBy("path").agg(F.array_join(F.collect_list(text), "\n").alias("value"))
    return L.scored_lines(files).select("path", "class_id", "conf")


@query("snk_yolo", f"""WITH {LABELS} SELECT stem || '.txt' AS path, CASE WHEN img % 11 = 0 THEN '' ELSE string_agg(printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h), chr(10) ORDER BY cand) || chr(10) END AS value FROM lab GROUP BY stem, img""")
def _(t):
    return label_files(t)


@query("snk_yolo_conf", f"""WITH {LABELS} SELECT stem || '.txt' AS path, string_agg(printf('%d %.6f %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h, conf), chr(10) ORDER BY cand) || chr(10) AS value FROM lab WHERE conf >= 0.5e0 GROUP BY stem""")
def _(t):
    rows = lab(t).where("conf >= 0.5").withColumn("path", F.concat("stem", F.lit(".txt")))
    return L.to_label_files(rows, (*L.CENTRE, "conf"), order=("cand",))


@query("snk_scored", f"WITH {LABELS} SELECT cand, printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h) || ' ' || CASE WHEN conf >= 0.5e0 THEN 'good' ELSE 'weak' END AS line FROM lab")
def _(t):
    cat = F.when(F.col("conf") >= 0.5, "good").otherwise("weak")
    return lab(t).select("cand", F.concat_ws(" ", C.yolo_line(F.col("class_id"), *[F.col(c) for c in L.CENTRE]), cat).alias("line"))


def dataset(t) -> DS.Dataset:
    """Truth as a dataset of 640 x 640 images in three splits."""
    g = t.ground_truth
    split = F.when(F.col("img") % 5 == 0, "val").when(F.col("img") % 5 == 1, "test").otherwise("train")
    images = g.select("img").distinct().select(split.alias("split"), F.concat(F.lit("img_"), "img").alias("stem"), F.concat(F.lit("img_"), "img", F.lit(".jpg")).alias("file_name"), F.lit(640).alias("width"), F.lit(640).alias("height"))
    boxes = g.select(F.concat(F.lit("img_"), "img").alias("stem"), F.col("cls").cast("int").alias("class_id"), (F.col("x1") * 640).alias("x"), (F.col("y1") * 640).alias("y"), ((F.col("x2") - F.col("x1")) * 640).alias("w"), ((F.col("y2") - F.col("y1")) * 640).alias("h"))
    return DS.Dataset(images, boxes, CATEGORIES)


TRUTH = "SELECT 'img_' || img AS stem, cls::INT AS class_id, x1 * 640 AS x, y1 * 640 AS y, (x2 - x1) * 640 AS w, (y2 - y1) * 640 AS h FROM ground_truth"


@query("src_coco_gt", TRUTH)
def _(t):
    return L.coco(DS.write_coco(dataset(t))).select("stem", "class_id", *"xywh")


@query("src_coco_flat", "SELECT img, cls::INT AS cls, 1e0 AS conf, x1 * 640 AS x1, y1 * 640 AS y1, x2 * 640 AS x2, y2 * 640 AS y2 FROM ground_truth")
def _(t):
    c = L.coco(DS.write_coco(dataset(t)))
    return c.select(F.regexp_extract("stem", "(\\d+)$", 1).cast("long").alias("img"), F.col("class_id").alias("cls"), F.lit(1.0).alias("conf"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))


@query("snk_coco", "SELECT CASE WHEN img % 5 = 0 THEN 'annotations/instances_val2017.json' WHEN img % 5 = 1 THEN 'annotations/instances_test2017.json' ELSE 'annotations/instances_train2017.json' END AS path, count(DISTINCT img) AS images, count(*) AS annotations FROM ground_truth GROUP BY 1")
def _(t):
    j = DS.write_coco(dataset(t)).select(F.regexp_replace("path", r"-\d+\.json$", ".json").alias("path"), F.from_json("value", L.COCO).alias("c"))
    return j.groupBy("path").agg(F.sum(F.size("c.images")).alias("images"), F.sum(F.size("c.annotations")).alias("annotations"))


def predictions(t) -> DataFrame:
    """Boxes as COCO predictions: two digits in the box, four in the score."""
    d = t.detections
    two = lambda c: F.bround(c * 640, 2)
    x, y, w, h = F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return d.select(F.col("img").alias("image_id"), (F.col("cls") + 1).alias("category_id"), F.array(two(x), two(y), two(w), two(h)).alias("bbox"), F.bround("score", 4).alias("score"))


@query("snk_coco_preds", "SELECT img AS image_id, cls + 1 AS category_id, x1 * 640 AS x, round_even(score, 4) AS score FROM detections")
def _(t):
    return predictions(t).select("image_id", "category_id", F.get("bbox", F.lit(0)).alias("x"), "score")


@query("src_coco_preds", "SELECT img AS image_id, cls + 1 AS category_id, x1 * 640 AS x, (y2 - y1) * 640 AS h FROM detections")
def _(t):
    # one text per thousand images, as a file holds them
    files = predictions(t).groupBy(F.floor(F.col("image_id") / 1000).alias("path")).agg(F.to_json(F.collect_list(F.struct("image_id", "category_id", "bbox", "score"))).alias("value"))
    return L.coco_predictions(files).select("image_id", "category_id", "x", "h")


@query("snk_coco_preds_yolo", "SELECT count(*) FILTER (g.img IS NOT NULL) AS written, count(DISTINCT d.img) FILTER (g.img IS NULL) AS skipped FROM detections d LEFT JOIN (SELECT DISTINCT img FROM ground_truth WHERE img % 7 <> 0) g ON d.img = g.img")
def _(t):
    known = t.ground_truth.where("img % 7 <> 0").select("img").distinct().withColumn("known", F.lit(True))
    j = t.detections.select("img").join(known, "img", "left")
    return j.agg(F.count_if(F.col("known").isNotNull()).alias("written"), F.count_distinct(F.when(F.col("known").isNull(), F.col("img"))).alias("skipped"))


ROUND = f"SELECT stem, class_id, round(x, 3) AS x, round(w, 3) AS w FROM ({TRUTH}) q"


def _round_trip(name: str, layout: str) -> None:
    @query(name, ROUND)
    def _(t):
        d = dataset(t)
        sizes = d.images.select("stem", "file_name", "width", "height")
        back = DS.read(DS.WRITERS[layout](d), layout, sizes)
        return back.boxes.select("stem", "class_id", F.round("x", 3).alias("x"), F.round("w", 3).alias("w"))


for _name, _layout in (("src_ds_coco", "coco"), ("src_ds_roboflow", "roboflow"), ("src_ds_yolo_a", "yolo_a"), ("src_ds_yolo_b", "yolo_b"), ("src_ds_darknet", "darknet")):
    _round_trip(_name, _layout)


@query("snk_convert", ROUND)
def _(t):
    d = dataset(t)
    sizes = d.images.select("stem", "file_name", "width", "height")
    files = DS.convert(DS.write_yolo(d, "yolo_a"), "yolo_a", "coco", sizes)
    return DS.read(files, "coco").boxes.select("stem", "class_id", F.round("x", 3).alias("x"), F.round("w", 3).alias("w"))


@query("snk_formats", "SELECT CASE WHEN img % 5 = 0 THEN 'val' WHEN img % 5 = 1 THEN 'test' ELSE 'train' END AS split, count(DISTINCT img) AS files FROM ground_truth GROUP BY 1")
def _(t):
    f = DS.write_yolo(dataset(t), "yolo_b").where("path like 'labels/%'")
    return f.groupBy(F.split_part("path", F.lit("/"), F.lit(2)).alias("split")).agg(F.count(F.lit(1)).alias("files"))


@query("src_format_detect", "SELECT * FROM (VALUES ('coco', 'coco'), ('darknet', 'darknet'), ('roboflow', 'roboflow'), ('yolo_a', 'yolo_a'), ('yolo_b', 'yolo_b')) v(written, detected)")
def _(t):
    """The layout told from the paths that each writer makes; a listing is all that is needed."""
    d = dataset(t)
    # of each folder and ending one path is enough, whatever the files are called
    shapes = lambda files: files.groupBy(F.regexp_replace("path", r"[^/]*$", ""), F.regexp_extract("path", r"\.[^./]*$", 0)).agg(F.min("path").alias("path"))
    told = [(k, DS.detect_format(r.path for r in shapes(w(d)).collect())) for k, w in sorted(DS.WRITERS.items())]
    return t.spark.createDataFrame(told, "written string, detected string")


@query("src_class_yaml", "SELECT * FROM (VALUES (0, 'bus'), (1, 'delivery van'), (2, 'car'), (3, 'person'), (4, 'cargo bike')) v(class_id, class_name)")
def _(t):
    text = DS.data_yaml(CATEGORIES, ["train"], lambda s: s)
    return t.spark.createDataFrame(list(enumerate(DS.class_names(text))), "class_id int, class_name string")


@query("snk_link", "SELECT DISTINCT 'img_' || img || '.jpg' AS source, 'images/' || CASE WHEN img % 5 = 0 THEN 'val' WHEN img % 5 = 1 THEN 'test' ELSE 'train' END || '/img_' || img || '.jpg' AS target FROM ground_truth")
def _(t):
    """Where each image goes: what a copier or a linker carries out."""
    return dataset(t).images.select(F.col("file_name").alias("source"), F.concat(F.lit("images/"), "split", F.lit("/"), "file_name").alias("target"))


@query("src_sidecar", "SELECT img, cand, score AS bbox_score FROM detections WHERE img % 3 = 0")
def _(t):
    """One JSON text per image with its annotations, read back; a text that does not parse is left out."""
    side = t.detections.where("img % 3 = 0").groupBy("img").agg(F.to_json(F.struct(F.collect_list(F.struct("cand", "score")).alias("annotations"))).alias("value"))
    broken = t.detections.where("img % 3 = 1").select("img", F.lit("{broken").alias("value")).distinct()
    j = side.unionByName(broken).select("img", F.explode(F.from_json("value", "annotations array<struct<cand:bigint,score:double>>").getField("annotations")).alias("a"))
    return j.select("img", "a.cand", F.col("a.score").alias("bbox_score"))


@query("src_traces", "SELECT event_id, props::JSON->>'k' AS k FROM events WHERE event_id % 10 <> 0")
def _(t):
    text = F.when(F.col("event_id") % 10 == 0, F.lit("{not json")).otherwise(F.col("props"))
    return t.events.select("event_id", text.alias("v")).where(F.try_parse_json("v").isNotNull()).select("event_id", F.get_json_object("v", "$.k").alias("k"))


@query("src_urls", "SELECT key, url FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio, ord) AS rn FROM (SELECT url, page_id AS ord, 0 AS prio, page_id % 40 AS key FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT url, page_id, 1, page_id % 40 FROM pages) u) x WHERE rn = 1")
def _(t):
    # the number in the path stands for the id; every second page is in the first source
    p = t.pages.select("url", F.col("page_id").alias("ord"))
    return TB.url_sources([p.where("ord % 2 = 0"), p], F.col("ord") % 40).select("key", "url")


@query("src_urls_gather", "SELECT url, min(page_id) AS first FROM pages GROUP BY url")
def _(t):
    return TB.first_seen(t.pages, F.col("url"), [F.col("page_id")]).select("url", F.col("page_id").alias("first"))


@query("win_first_seen", "SELECT lower(event_type) AS k, min(event_id) AS first FROM events GROUP BY 1")
def _(t):
    return TB.first_seen(t.events, F.lower("event_type"), [F.col("event_id")]).select(F.lower("event_type").alias("k"), F.col("event_id").alias("first"))


@query("src_registry", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'EXTRACTED' WHEN 'P' THEN 'DOWNLOADED' ELSE 'PENDING' END AS status FROM orders")
def _(t):
    lookup = t.spark.createDataFrame([("F", "EXTRACTED"), ("P", "DOWNLOADED")], "o_orderstatus string, status string")
    return t.orders.select("o_orderkey", "o_orderstatus").join(F.broadcast(lookup), "o_orderstatus", "left").select("o_orderkey", F.coalesce("status", F.lit("PENDING")).alias("status"))  # a fixed list


ADVANCE = ("POPULATING", "DOWNLOADING", "FILTERING", "COMPLETE")


@query("src_registry_stage", """SELECT o_custkey % 25 AS project_id, ['POPULATING', 'DOWNLOADING', 'FILTERING', 'COMPLETE'][max(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 2 ELSE 1 END + (o_orderkey % 97 = 0)::INT)] AS stage FROM orders GROUP BY 1""")
def _(t):
    """A project's stage is that of its most advanced video, by the order of the stages and not of their names."""
    at = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "P", 2).otherwise(1) + (F.col("o_orderkey") % 97 == 0).cast("int")
    rows = t.orders.select((F.col("o_custkey") % 25).alias("project_id"), F.element_at(F.array(*[F.lit(s) for s in ADVANCE]), at).alias("s"))
    return TB.most_advanced(rows, "project_id", F.col("s"), ADVANCE)


@query("src_excel_q", "SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'walking' WHEN p_brand LIKE 'Brand#%' THEN 'street' ELSE 'live' END AS category, greatest(0.05e0, (p_size % 5) * 0.05e0) AS yield_ratio FROM part")
def _(t):
    cat = TB.category_of(F.col("p_brand"), [("brand#1", "walking"), ("brand#", "street")], "live")
    return t.part.select("p_partkey", cat.alias("category"), F.greatest(F.lit(0.05), (F.col("p_size") % 5) * F.lit(0.05)).alias("yield_ratio"))


@query("src_emb_cache", "SELECT vec_id, vec_id % 3 <> 0 AS cached FROM embeddings")
def _(t):
    cache = t.embeddings.where("vec_id % 3 <> 0").select("vec_id")
    found, missing = TB.with_cache(t.embeddings.select("vec_id"), cache, "vec_id")
    return found.withColumn("cached", F.lit(True)).unionByName(missing.withColumn("cached", F.lit(False)))


@query("src_images", "SELECT DISTINCT 'img_' || img || '.jpg' AS name FROM detections WHERE img % 3 = 0")
def _(t):
    names = t.detections.select(F.concat(F.lit("img_"), "img", F.when(F.col("img") % 3 == 0, ".jpg").otherwise(".txt")).alias("name")).distinct()
    return names.where(F.lower("name").rlike(r"\.(jpg|jpeg|png|bmp|webp)$")).orderBy("name")


@query("src_sql", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def _(t):
    return t.spark.sql("SELECT n_name, count(*) AS customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name", customer=t.customer, nation=t.nation)


@query("snk_trace", "SELECT image_id, count(*) AS stages FROM stage_rows GROUP BY image_id")
def _(t):
    traces = t.stage_rows.groupBy("image_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("created_at", "stage"))).alias("stages"))).alias("value"))
    return traces.select("image_id", F.size(F.from_json("value", "stages array<struct<stage:string>>").getField("stages")).cast("long").alias("stages"))


@query("snk_csv", "SELECT cls, count(*) FILTER (model = 0) AS m0, count(*) FILTER (model = 1) AS m1 FROM detections GROUP BY cls")
def _(t):
    p = t.detections.groupBy("cls").pivot("model", [0, 1]).agg(F.count(F.lit(1)))
    return p.select("cls", *[F.coalesce(F.col(str(k)), F.lit(0)).cast("long").alias(f"m{k}") for k in (0, 1)])


@query("snk_cache", "SELECT cand, substr(md5(img || '_' || cls || '_' || model), 1, 16) AS key FROM detections")
def _(t):
    return t.detections.select("cand", TB.result_key(F.col("img"), F.col("cls"), F.col("model")).alias("key"))


@query("snk_config_hash", "SELECT event_id, substr(sha256(props || chr(10) || event_type), 1, 16) AS hash FROM events")
def _(t):
    return t.events.select("event_id", TB.config_hash(F.col("props"), F.col("event_type")).alias("hash"))


# statistics


@query("agg_class_dist", f"WITH {WITH_EMPTY}, c AS (SELECT class_id, count(*) AS n FROM labels_e WHERE class_id IS NOT NULL GROUP BY 1) SELECT class_id, n, 100 * n / (SELECT sum(n) FROM c) AS percent FROM c")
def _(t):
    return ST.class_distribution(labels_e(t))


@query("agg_per_image", f"WITH {WITH_EMPTY} SELECT file, count(class_id) AS n FROM labels_e GROUP BY file")
def _(t):
    return ST.per_image(labels_e(t))


@query("agg_bbox_stats", f"""WITH {WITH_EMPTY}, b AS (SELECT class_id, w, h, w * h AS area, CASE WHEN h <> 0 THEN w / h END AS aspect FROM labels_e WHERE class_id IS NOT NULL)
SELECT class_id, round(avg(w), 6) AS w_mean, round(stddev_samp(w), 6) AS w_std, min(w) AS w_min, max(h) AS h_max, round(avg(area), 6) AS area_mean, round(avg(aspect), 6) AS aspect_mean, round(median(aspect), 6) AS aspect_median FROM b GROUP BY class_id""")  # fmt: skip
def _(t):
    r = lambda c: F.round(c, 6).alias(c)
    return ST.box_stats(labels_e(t)).select("class_id", r("w_mean"), r("w_std"), "w_min", "h_max", r("area_mean"), r("aspect_mean"), r("aspect_median"))


@query("agg_area_buckets", f"WITH {WITH_EMPTY} SELECT class_id, count(*) FILTER (w * h < 0.01e0) AS small, count(*) FILTER (w * h >= 0.01e0 AND w * h < 0.09e0) AS medium, count(*) FILTER (w * h >= 0.09e0 AND w * h < 1.01e0) AS large FROM labels_e WHERE class_id IS NOT NULL GROUP BY class_id")
def _(t):
    return ST.area_buckets(labels_e(t))


@query("agg_cooccur", f"WITH {WITH_EMPTY}, s AS (SELECT DISTINCT file, class_id FROM labels_e WHERE class_id IS NOT NULL) SELECT x.class_id AS a, y.class_id AS b, count(*) AS images FROM s x JOIN s y USING (file) GROUP BY ALL")
def _(t):
    return ST.cooccurrence(labels_e(t))


@query("agg_hist_per_image", f"WITH {WITH_EMPTY}, n AS (SELECT file, count(class_id) AS n FROM labels_e GROUP BY file) SELECT CASE WHEN n > 10 THEN '>10' ELSE n::VARCHAR END AS boxes, count(*) AS images FROM n WHERE n > 0 GROUP BY 1")
def _(t):
    return ST.images_by_count(labels_e(t))


@query("agg_split_summary", f"""WITH {WITH_EMPTY}, n AS (SELECT CASE WHEN file % 5 = 0 THEN 'val' ELSE 'train' END AS split, file, count(class_id) AS n FROM labels_e GROUP BY ALL)
SELECT coalesce(split, 'TOTAL') AS split, count(*) AS files, count(*) FILTER (n = 0) AS empty, sum(n)::BIGINT AS annotations, avg(n) FILTER (n > 0) AS mean, median(n) AS median, max(n) AS largest FROM n GROUP BY ROLLUP (split)""")  # fmt: skip
def _(t):
    return ST.split_summary(labels_e(t).withColumn("split", F.when(F.col("file") % 5 == 0, "val").otherwise("train")))


@query("agg_detailed_overview", f"WITH {WITH_EMPTY}, n AS (SELECT file, count(class_id) AS n FROM labels_e GROUP BY file) SELECT count(*) AS images, sum(n)::BIGINT AS boxes, round(avg(n), 6) AS mean, median(n) AS median, round(stddev_samp(n), 6) AS std, min(n) AS least, max(n) AS most FROM n")
def _(t):
    n = ST.per_image(labels_e(t))
    return n.agg(F.count(F.lit(1)).alias("images"), F.sum("n").alias("boxes"), F.round(F.avg("n"), 6).alias("mean"), F.median("n").alias("median"), F.round(F.stddev_samp("n"), 6).alias("std"), F.min("n").alias("least"), F.max("n").alias("most"))


QUALITY = "CASE WHEN score < 0.4e0 THEN 'discard' WHEN score < 0.75e0 THEN 'fix' ELSE 'keep' END"


@query("agg_validation", f"SELECT cls, {QUALITY} AS category, count(*) AS n FROM detections GROUP BY GROUPING SETS ((cls, {QUALITY}), (cls), ({QUALITY}), ())")
def _(t):
    cat = F.when(F.col("score") < 0.4, "discard").when(F.col("score") < 0.75, "fix").otherwise("keep")
    return t.detections.select("cls", cat.alias("category")).cube("cls", "category").agg(F.count(F.lit(1)).alias("n"))


RATED = ("correct", "loose_box", "wrong_class", "no_object", "partial", "parse_error")


@query("agg_rater", """WITH r AS (SELECT CASE WHEN score >= 0.75e0 THEN 'correct' WHEN model = 0 THEN 'wrong_class' WHEN model = 1 THEN 'loose_box' WHEN score < 0.25e0 THEN 'no_object' ELSE 'partial' END AS category FROM detections),
k AS (SELECT unnest(['correct', 'loose_box', 'wrong_class', 'no_object', 'partial', 'parse_error']) AS category) SELECT k.category, count(r.category) AS n, 100 * count(r.category) / (SELECT count(*) FROM r) AS percent FROM k LEFT JOIN r USING (category) GROUP BY k.category""")  # fmt: skip
def _(t):
    s, m = F.col("score"), F.col("model")
    cat = F.when(s >= 0.75, "correct").when(m == 0, "wrong_class").when(m == 1, "loose_box").when(s < 0.25, "no_object").otherwise("partial")
    return ST.shares(t.detections.select(cat.alias("category")), "category", RATED)


@query("agg_query_rate", "SELECT event_type AS query, count(*) AS total, count(*) FILTER (value > 10) AS positive, count(*) FILTER (value <= 10) AS negative, count(*) FILTER (value > 10) / count(*) AS rate FROM events GROUP BY event_type")
def _(t):
    return ST.answer_rates(t.events.withColumnRenamed("event_type", "query"), "query", F.col("value") > 10)


@query("agg_negatives", "SELECT event_type, count(*) AS n, min(event_id) AS first FROM events WHERE NOT (value > 10) GROUP BY event_type")
def _(t):
    return t.events.where(~(F.col("value") > 10)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@query("flt_classified", "SELECT user_id FROM events GROUP BY user_id HAVING coalesce(bool_and(value > 0.1) , true) AND bool_or(event_type = 'error')")
def _(t):
    a = t.events.groupBy("user_id").agg(F.bool_and(F.col("value") > 0.1).alias("is_real"), F.bool_or(F.col("event_type") == "error").alias("any"))
    return a.where("is_real is distinct from false and any").select("user_id")


@query("agg_classify", "SELECT count(*) FILTER (value > 10) AS present, count(*) FILTER (value IS NULL OR value <= 10) AS absent, 100 * count(*) FILTER (value > 10) / count(*) AS percent FROM events")
def _(t):
    p = F.count_if(F.col("value") > 10)
    return t.events.agg(p.alias("present"), F.count_if(F.coalesce(~(F.col("value") > 10), F.lit(True))).alias("absent"), (100 * p / F.count(F.lit(1))).alias("percent"))


@query("jn_query_filter", "SELECT cand FROM detections WHERE img IN (SELECT user_id FROM events WHERE value > 20)")
def _(t):
    yes = t.events.where("value > 20").select(F.col("user_id").alias("img")).distinct()
    return t.detections.join(yes, "img", "left_semi").select("cand")


@query("jn_result_diff", "SELECT a.image_id FROM stage_rows a JOIN work_queue b ON a.image_id = b.image_id AND a.stage = b.stage WHERE a.config_hash IS DISTINCT FROM CASE WHEN b.attempts % 2 = 0 THEN 'h0' ELSE 'h1' END")
def _(t):
    b = t.work_queue.select("image_id", "stage", F.when(F.col("attempts") % 2 == 0, "h0").otherwise("h1").alias("other"))
    return t.stage_rows.join(b, ["image_id", "stage"]).where(~F.col("config_hash").eqNullSafe(F.col("other"))).select("image_id")


# queries to search with


@query("jn_cross", "SELECT 'walk in ' || lower(n_name) || ' ' || r_name AS term FROM nation, region")
def _(t):
    # templates x places x apps: the product is the result, of two short lists
    c = t.nation.crossJoin(F.broadcast(t.region))
    return c.select(C.fill_template(F.lit("walk  in {city} {app} "), {"city": F.lower("n_name"), "app": F.col("r_name")}).alias("term"))


SEARCH = "q AS (SELECT p_partkey AS id, lower(p_name) AS term, p_size % 5 + 1 AS priority, p_size * 4 AS videos, (p_size % 10) / 16e0 AS yield_ratio, p_retailprice AS images, p_partkey % 6 = 0 AS is_variation FROM part)"


def search(t) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.lower("p_name").alias("term"), (F.col("p_size") % 5 + 1).alias("priority"), (F.col("p_size") * 4).alias("videos"), ((F.col("p_size") % 10) / F.lit(16.0)).alias("yield_ratio"), F.col("p_retailprice").alias("images"), (F.col("p_partkey") % 6 == 0).alias("is_variation"))


@query("flt_queries", f"WITH {SEARCH} SELECT id FROM q WHERE priority IN (1, 2) AND yield_ratio >= 0.125e0 AND videos >= 20 AND NOT is_variation")
def _(t):
    return search(t).where("priority in (1, 2) and yield_ratio >= 0.125 and videos >= 20 and not is_variation").select("id")


SORTS = {"score": ("priority", "images DESC"), "yield": ("yield_ratio DESC",), "images": ("images DESC",), "videos": ("videos DESC",)}


def ordered_by(sort: str) -> str:
    return ", ".join((*SORTS[sort], "id"))


@query("srt_queries", f"WITH {SEARCH} " + " UNION ALL ".join(f"SELECT id, '{k}' AS sort, row_number() OVER (ORDER BY {ordered_by(k)}) AS place FROM q" for k in SORTS))
def _(t):
    """Every query's place in each of the orders that a report may have."""
    q = search(t)
    out = None
    for sort in SORTS:
        order = [F.col(c.split()[0]).desc() if c.endswith(" DESC") else F.col(c).asc() for c in (*SORTS[sort], "id")]
        r = ST.placed(q, order).select("id", F.lit(sort).alias("sort"), "place")
        out = r if out is None else out.unionByName(r)
    return out


@query("fn_expand_query", f"""WITH {SEARCH} SELECT id, term || ' 4k' AS term, greatest(10, videos // 2)::BIGINT AS videos, 'quality_4k' AS kind FROM q WHERE NOT is_variation AND priority <= 3 AND videos >= 50 AND term NOT LIKE '%4k%'
UNION ALL SELECT id, term || ' ' || y, greatest(5, videos // 4)::BIGINT, 'year_' || y FROM q, (SELECT unnest(['2023', '2024']) AS y) x WHERE NOT is_variation AND priority <= 2 AND NOT contains(term, y)""")  # fmt: skip
def _(t):
    q = search(t).where("not is_variation")
    four = q.where("priority <= 3 and videos >= 50 and not contains(term, '4k')").select("id", F.concat("term", F.lit(" 4k")).alias("term"), F.greatest(F.lit(10), F.expr("videos div 2")).cast("long").alias("videos"), F.lit("quality_4k").alias("kind"))
    years = q.where("priority <= 2").withColumn("y", F.explode(F.array(F.lit("2023"), F.lit("2024")))).where("not contains(term, y)")
    return four.unionByName(years.select("id", F.concat_ws(" ", "term", "y").alias("term"), F.greatest(F.lit(5), F.expr("videos div 4")).cast("long").alias("videos"), F.concat(F.lit("year_"), "y").alias("kind")))


@query("agg_query_meta", f"WITH {SEARCH} SELECT count(*) AS n, sum(videos)::BIGINT AS videos, count(*) FILTER (is_variation) AS variations, list_sort(list(DISTINCT priority)) AS priorities FROM q")
def _(t):
    return search(t).agg(F.count(F.lit(1)).alias("n"), F.sum("videos").cast("long").alias("videos"), F.count_if("is_variation").alias("variations"), F.sort_array(F.collect_set("priority")).alias("priorities"))


@query("snk_queries", f"WITH {SEARCH} SELECT id, 'https://www.youtube.com/results?search_query=' || replace(url_encode(term), '%20', '+') AS url FROM q")
def _(t):
    return search(t).select("id", C.search_url(F.col("term")).alias("url"))


# scalars


@query("fn_norm_alias", "SELECT page_id, trim(regexp_replace(replace(replace(lower(url), '_', ' '), '-', ' '), '\\s+', ' ', 'g')) AS k FROM pages")
def _(t):
    return t.pages.select("page_id", C.norm_alias(F.col("url")).alias("k"))


@query("fn_stem", "SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem FROM pages")
def _(t):
    return t.pages.select("page_id", C.stem(F.col("url")).alias("stem"))


WATCH = """CASE page_id % 5 WHEN 0 THEN 'https://www.youtube.com/watch?x=1&v=abcdefg' || lpad(page_id::VARCHAR, 4, '0') || '&t=3' WHEN 1 THEN 'https://youtu.be/abcdefg' || lpad(page_id::VARCHAR, 4, '0') || '?t=1'
  WHEN 2 THEN 'https://www.youtube.com/shorts/abcdefg' || lpad(page_id::VARCHAR, 4, '0') WHEN 3 THEN 'https://example.org/v/x' ELSE url END"""


def watch(t) -> DataFrame:
    k = F.concat(F.lit("abcdefg"), F.lpad(F.col("page_id").cast("string"), 4, "0"))
    m = F.col("page_id") % 5
    u = F.when(m == 0, F.concat(F.lit("https://www.youtube.com/watch?x=1&v="), k, F.lit("&t=3"))).when(m == 1, F.concat(F.lit("https://youtu.be/"), k, F.lit("?t=1"))).when(m == 2, F.concat(F.lit("https://www.youtube.com/shorts/"), k)).when(m == 3, F.lit("https://example.org/v/x")).otherwise(F.col("url"))
    return t.pages.select("page_id", u.alias("u"))


IDS = f"(SELECT page_id, {WATCH} AS u, CASE WHEN page_id % 5 < 3 THEN 'abcdefg' || lpad(page_id::VARCHAR, 4, '0') WHEN page_id % 5 = 4 THEN nullif(regexp_extract(url, '(?:v=|/)([a-zA-Z0-9_-]{{11}})(?:[?&/]|$)', 1), '') END AS id FROM pages) w"


@query("fn_video_id", f"SELECT page_id, id FROM {IDS}")
def _(t):
    return watch(t).select("page_id", C.video_id(F.col("u")).alias("id"))


@query("fn_url_valid", f"SELECT page_id, CASE WHEN page_id % 5 >= 3 THEN 'domain' END AS problem FROM {IDS}")
def _(t):
    return watch(t).select("page_id", C.url_problem(F.col("u")).alias("problem"))


@query("fn_class_valid", "SELECT item_id, len(list_filter(string_split(text, ' '), lambda w: trim(w) = '' OR length(w) > 12)) = 0 AS ok FROM benchmark")
def _(t):
    return t.benchmark.select("item_id", C.class_list_ok(F.split("text", " "), 12).alias("ok"))


@query("fn_safe_name", "SELECT page_id, coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '[<>:\"/\\\\|?*]', '_', 'g'), '\\s+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 30), '_+$', ''), ''), 'unnamed') AS name FROM pages")
def _(t):
    return t.pages.select("page_id", C.safe_name(F.col("url"), 30).alias("name"))


@query("fn_yolo_line", f"WITH {LABELS} SELECT cand, printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h) AS line FROM lab")
def _(t):
    return lab(t).select("cand", C.yolo_line(F.col("class_id"), *[F.col(c) for c in L.CENTRE]).alias("line"))


@query("prj_yes_no", "SELECT item_id, CASE WHEN contains(lower(text), 'yes') AND NOT contains(lower(text), 'no') THEN true WHEN contains(lower(text), 'no') THEN false END AS answer FROM benchmark")
def _(t):
    return t.benchmark.select("item_id", C.yes_no(F.col("text")).alias("answer"))


#: Answers of models around the events' JSON: thoughts, fences, trailing commas, chatter.
ANSWER = "CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '<think>{}</think>' || props WHEN 2 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN 3 THEN replace(props, '}', ',}') ELSE 'Sure: ' || props || ' ok' END"


def answers(t) -> DataFrame:
    p, m = F.col("props"), F.col("event_id") % 5
    a = F.when(m == 0, p).when(m == 1, F.concat(F.lit("<think>{}</think>"), p)).when(m == 2, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(m == 3, F.replace(p, F.lit("}"), F.lit(",}"))).otherwise(F.concat(F.lit("Sure: "), p, F.lit(" ok")))
    return t.events.select("event_id", a.alias("a"))


@query("fn_vlm_json", "SELECT event_id, props::JSON->>'k' AS k FROM events")
def _(t):
    return answers(t).select("event_id", F.get_json_object(C.balanced_json(F.col("a")), "$.k").alias("k"))


@query("fn_fence_json", "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN props::JSON->>'k' END AS k FROM events")
def _(t):
    p = C.plain_json(F.col("a"))
    return answers(t).select("event_id", F.when(F.try_parse_json(p).isNotNull(), F.get_json_object(p, "$.k")).alias("k"))


@query("fn_bbox_json", "SELECT event_id, CASE WHEN event_id % 5 IN (0, 2, 4) THEN 1 ELSE 0 END AS n, CASE WHEN event_id % 5 IN (0, 2, 4) THEN props::JSON->>'k' END AS k FROM events")
def _(t):
    j = F.from_json(C.box_list_json(F.col("a")), "array<struct<k:string>>")
    return answers(t).withColumn("j", j).select("event_id", F.size("j").alias("n"), F.get("j.k", F.lit(0)).alias("k"))


@query("fn_rating_json", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN (event_id % 100) / 100e0 WHEN 1 THEN 1e0 ELSE -1e0 END AS score FROM events")
def _(t):
    m = F.col("event_id") % 3
    a = F.when(m == 0, F.concat(F.lit("Output: {'class_match': True, 'bbox_score': "), ((F.col("event_id") % 100) / 100.0).cast("string"), F.lit("}"))).when(m == 1, F.lit('no json, bbox_score: 7.5')).otherwise("nothing")
    return t.events.select("event_id", C.rating_score(a).alias("score"))


@query("fn_url_encode", "SELECT n_nationkey, replace(url_encode(n_name || ' street & more'), '%20', '+') AS term, 'q' AS first, least(n_nationkey * 10, 50)::VARCHAR AS most FROM nation")
def _(t):
    p = C.api_params(F.concat("n_name", F.lit(" street & more")), F.col("n_nationkey") * 10)
    return t.nation.select("n_nationkey", F.url_encode(F.concat("n_name", F.lit(" street & more"))).alias("term"), F.get(F.map_keys(p), F.lit(0)).alias("first"), F.element_at(p, "maxResults").alias("most"))


@query("fn_live_query", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'live cam ' || n_name WHEN n_nationkey % 3 = 1 THEN n_name || ' cam' END AS q FROM nation")
def _(t):
    m = F.col("n_nationkey") % 3
    how = F.when(m == 0, F.concat(F.lit("use 'x' or 'live cam "), "n_name", F.lit("' there"))).otherwise("open it")
    source = F.when(m == 1, F.concat(F.lit("YouTube: '"), "n_name", F.lit(" cam'"))).otherwise("site")
    return t.nation.select("n_nationkey", C.live_query(source, how).alias("q"))


@query("fn_template", "SELECT n_nationkey, 'drive ' || n_name || ' now' AS q FROM nation")
def _(t):
    return t.nation.select("n_nationkey", C.fill_template(F.lit(" drive   {city} now "), {"city": F.col("n_name")}).alias("q"))


@query("fn_legacy_path", "SELECT video_id, regexp_replace(frames_dir, '^frames/(\\d+)$', 'store/frames_raw/\\1') AS p FROM videos WHERE frames_dir IS NOT NULL")
def _(t):
    return t.videos.where("frames_dir is not null").select("video_id", F.regexp_replace("frames_dir", r"^frames/(\d+)$", "store/frames_raw/$1").alias("p"))


@query("fn_clamp", "SELECT cand, greatest(0.25e0, least(0.5e0, score)) AS s FROM detections")
def _(t):
    return t.detections.select("cand", F.greatest(F.lit(0.25), F.least(F.lit(0.5), F.col("score"))).alias("s"))


@query("fn_round", "SELECT cand, round_even(score, 2) AS two, round_even(score, 3) AS three FROM detections")
def _(t):
    return t.detections.select("cand", F.bround("score", 2).alias("two"), F.bround("score", 3).alias("three"))


@query("fn_mapdict", "SELECT cand, CASE model WHEN 0 THEN 0.25e0 WHEN 1 THEN 0.5e0 ELSE 0.125e0 END AS floor FROM detections")
def _(t):
    m = F.create_map(F.lit(0), F.lit(0.25), F.lit(1), F.lit(0.5))
    return t.detections.select("cand", F.coalesce(F.try_element_at(m, F.col("model").cast("int")), F.lit(0.125)).alias("floor"))


@query("flt_blocked_tag", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'slot' WHEN page_id % 3 = 1 THEN 'casino' END AS blocked FROM pages")
def _(t):
    m = F.col("page_id") % 3
    tags = F.when(m == 0, F.array(F.lit("Fun"), F.lit("MySLOTgame")))
    text = F.when(m == 1, F.lit("come to #BigCasino now")).otherwise("casino without a sign")
    return t.pages.select("page_id", C.blocked_tag(tags, text, F.array(F.lit("casino"), F.lit("slot"))).alias("blocked"))


@query("flt_age", "SELECT video_id FROM videos WHERE created_at < TIMESTAMP '1996-01-01 00:00:00' AND length('vid' || lpad(video_id::VARCHAR, 8, '0')) = 11")
def _(t):
    name = F.concat(F.lit("vid"), F.lpad(F.col("video_id").cast("string"), 8, "0"))
    return t.videos.where((F.length(name) == 11) & (F.col("created_at") < F.expr("timestamp_ntz'1996-01-01'"))).select("video_id")


@query("win_sample", "SELECT video_id, unnest(range(0, least(frame_count - 1, 9 * 7) + 1, 7)) AS frame FROM videos WHERE frame_count > 0")
def _(t):
    return TB.sampled_frames(t.videos.select("video_id", "frame_count"), F.col("frame_count"), F.lit(7).cast("long"), 10).select("video_id", "frame")


@query("win_keyframe", "SELECT user_id AS video, event_id AS frame FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) x WHERE n <= 2 OR abs(value - p) >= 30")
def _(t):
    return TB.keyframes(t.events.select(F.col("user_id").alias("video"), F.col("event_id").alias("frame"), "value"), 30.0).select("video", "frame")


@query("mask_bbox", "SELECT event_id, (event_id % 7)::BIGINT AS x1, (event_id % 5)::BIGINT AS y1, (event_id % 7 + 2)::BIGINT AS x2, (event_id % 5 + 3)::BIGINT AS y2 FROM events")
def _(t):
    """A mask as row-major bytes of 12 x 10 pixels: the box from its first to its last set pixel."""

    @F.pandas_udf("x1 long, y1 long, x2 long, y2 long")
    def tight(masks: pd.Series) -> pd.DataFrame:
        out = []
        for m in masks:
            y, x = np.nonzero(np.frombuffer(m, dtype=np.uint8).reshape(10, 12))
            out.append((x.min(), y.min(), x.max(), y.max()) if len(x) else (0, 0, 0, 0))
        return pd.DataFrame(out, columns=["x1", "y1", "x2", "y2"])

    dx, dy = F.col("event_id") % 7, F.col("event_id") % 5
    on = F.transform(F.sequence(F.lit(0), F.lit(119)), lambda i: F.when((i % 12).between(dx, dx + 2) & F.floor(i / 12).between(dy, dy + 3), "01").otherwise("00"))
    return t.events.select("event_id", tight(F.unhex(F.array_join(on, ""))).alias("b")).select("event_id", "b.*")


# streams, run over all that is there


def _stream_dir(t) -> str:
    return f"{folder(t.spark)}/stream-{uuid.uuid4().hex}"


@query("st_submit", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    at = _stream_dir(t)
    for k in range(2):
        Q.submit(t.events.where(F.col("event_id") % 2 == k), f"{at}/in")
    rows = Q.messages(t.spark, f"{at}/in", t.events.schema)
    return Q.run_now(rows, f"{at}/out", f"{at}/ck").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("st_read_group", "SELECT event_id FROM events WHERE event_id % 2 = 1")
def _(t):
    """A second run of a group sees only what came after the first."""
    at = _stream_dir(t)
    Q.submit(t.events.where("event_id % 2 = 0"), f"{at}/in")
    rows = Q.messages(t.spark, f"{at}/in", t.events.schema)
    rows.writeStream.format("noop").option("checkpointLocation", f"{at}/ck0").trigger(availableNow=True).start().awaitTermination()
    Q.submit(t.events.where("event_id % 2 = 1"), f"{at}/in")
    Q.forward(rows.select("event_id"), f"{at}/ck0", f"{at}/out", f"{at}/dead").awaitTermination()
    return t.spark.read.schema("event_id long").option("recursiveFileLookup", "true").parquet(f"{at}/out")


@query("st_ack", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'dead' ELSE 'done' END AS outcome FROM events")
def _(t):
    at = _stream_dir(t)
    Q.submit(t.events.repartition(2, "event_id"), f"{at}/in")
    rows = Q.messages(t.spark, f"{at}/in", t.events.schema).select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("props")).alias("props"))
    Q.forward(rows, f"{at}/ck", f"{at}/out", f"{at}/dead", F.try_parse_json("props").isNotNull()).awaitTermination()
    read = lambda p, s: t.spark.read.schema("event_id long").option("recursiveFileLookup", "true").parquet(f"{at}/{p}").withColumn("outcome", F.lit(s))
    return read("out", "done").unionByName(read("dead", "dead"))


@query("st_stream_barrier", "SELECT image_id, count(*) AS models, sum(boxes)::BIGINT AS boxes FROM proposals GROUP BY image_id HAVING count(*) = 4")
def _(t):
    at = _stream_dir(t)
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", Q.ROCKS)
    sent = settled(t.proposals)
    for k in (0, 1):
        Q.submit(sent.where(F.col("model") % 2 == k), f"{at}/in")
    out = Q.barrier(Q.messages(t.spark, f"{at}/in", t.proposals.schema, 1000), 4)
    return Q.run_now(out, f"{at}/out", f"{at}/ck").select("image_id", "models", "boxes")


@query("st_stream_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL")
def _(t):
    """Hours that the watermark has closed."""
    at = _stream_dir(t)
    Q.submit(t.events.withColumn("ts", F.col("ts").cast("timestamp")), f"{at}/in")
    # all files in one batch: none of the events is late
    rows = Q.messages(t.spark, f"{at}/in", t.events.withColumn("ts", F.col("ts").cast("timestamp")).schema, 1 << 30)
    return Q.run_now(Q.event_windows(rows, "1 hour"), f"{at}/out", f"{at}/ck").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("st_stream_retry", "SELECT image_id, count(*) FILTER (status = 'failed') AS attempts FROM work_queue GROUP BY image_id HAVING count(*) FILTER (status = 'failed') > 0")
def _(t):
    """Failures counted in the state store, one batch a stage; the last count of each image."""
    at = _stream_dir(t)
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", Q.ROCKS)
    results = t.work_queue.where("status = 'failed'").select("image_id", F.lit(True).alias("failed"))
    Q.submit(results, f"{at}/in")
    rows = Q.messages(t.spark, f"{at}/in", results.schema, 1 << 30)
    Q.forward(Q.retries(rows, 1000), f"{at}/ck", f"{at}/out", f"{at}/dead", mode="update").awaitTermination()
    out = t.spark.read.schema("image_id long, attempts long, outcome string").option("recursiveFileLookup", "true").parquet(f"{at}/out")
    return out.groupBy("image_id").agg(F.max("attempts").alias("attempts"))


@query("st_stream_stale", "SELECT image_id FROM (SELECT image_id, max(claimed_at) AS m FROM work_queue WHERE status = 'processing' AND claimed_at IS NOT NULL GROUP BY image_id) x WHERE m + INTERVAL 3 SECOND <= (SELECT max(claimed_at) FROM work_queue WHERE status = 'processing') - INTERVAL 1 SECOND")
def _(t):
    """Claims that went silent, by the time of the claims themselves: timers in the state store, closed by the watermark."""
    at = _stream_dir(t)
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", Q.ROCKS)
    claims = t.work_queue.where("status = 'processing' and claimed_at is not null").select("image_id", F.lit("claim").alias("kind"), F.col("stage").alias("worker"), F.col("claimed_at").cast("timestamp").alias("ts"))
    Q.submit(claims, f"{at}/in")
    rows = Q.messages(t.spark, f"{at}/in", claims.schema, 1 << 30)
    return Q.run_now(Q.stale_by_time(rows, 3000, "1 second"), f"{at}/out", f"{at}/ck").select("image_id")


@query("st_envelope", "SELECT event_id, 'ingest' AS origin, CASE WHEN event_id % 10 = 0 THEN 'dead_letter' ELSE 'ingest' END AS stage FROM events")
def _(t):
    """Messages in envelopes; those that can't be read go to the dead letters and still tell where they come from."""
    sent = Q.enveloped(t.events.select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("props")).alias("props")), "ingest", "job")
    content = F.from_json("data", "event_id long, props string")
    dead = Q.dead_letters(sent, F.when(content["props"].isNull(), "no props"))
    told = F.from_json("data", "origin string, message_id string, data string, error string")
    back = dead.select("stage", told.alias("d")).select("stage", "d.origin", F.from_json("d.data", "event_id long")["event_id"].alias("event_id"))
    good = Q.opened(sent, "event_id long, props string").where("props is not null").select("stage", F.col("stage").alias("origin"), "event_id")
    return good.unionByName(back).select("event_id", "origin", "stage")


@query("ext_detect", "SELECT DISTINCT 'img_' || img AS image_path, 'car' AS label, (img % 8) / 8e0 AS score, 'second' AS model FROM detections WHERE img % 7 <> 0")
def _(t):
    """A detector whose first model does not load; responses of another form are refused."""
    from gridlens.operators import models as MD

    def load(name):
        if name == "first":
            raise OSError("no weights")
        return name

    def run(model, batch: pd.DataFrame) -> pd.DataFrame:
        k = batch["image_path"].str.slice(4).astype(int)
        return pd.DataFrame({"boxes": [[[0.0, 0.0, 0.5, 2.0 if i % 7 == 0 else 1.0]] for i in k], "scores": [[i % 8 / 8] for i in k], "labels": [["Car "] for _ in k]})

    images = t.detections.select(F.concat(F.lit("img_"), "img").alias("image_path")).distinct()
    boxes, _refused = MD.detect(images, MD.Detector(("first", "second"), load, run), ["car", "bus"])
    return boxes.select("image_path", "label", "score", "model")


@query("ext_embed_cache", "SELECT vec_id, vec_id % 3 <> 0 AS cached FROM embeddings")
def _(t):
    """Embeddings from a cache that is filled with what lacks: those computed here are zeros."""
    from gridlens.operators import models as MD

    at = f"{folder(t.spark)}/cache-{uuid.uuid4().hex}"
    t.embeddings.where("vec_id % 3 <> 0").select("vec_id", "embedding").write.parquet(at)
    zeros = MD.Detector(("zeros",), lambda name: name, lambda model, batch: pd.DataFrame({"embedding": [np.zeros(4, dtype=np.float32) for _ in range(len(batch))]}))
    return MD.embedded(t.embeddings.select("vec_id"), "vec_id", at, zeros).select("vec_id", (F.size("embedding") != 4).alias("cached"))


@query("st_heartbeat", "SELECT image_id, stage FROM work_queue WHERE status = 'processing' AND claimed_at < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 30 SECOND")
def _(t):
    return t.work_queue.where("status = 'processing'").where(F.col("claimed_at") < F.expr("timestamp_ntz'2024-01-15 00:00:00' - interval 30 seconds")).select("image_id", "stage")


@query("st_backoff", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN 'ValueError: 3' END AS error FROM nation")
def _(t):
    """An effect that fails for some rows for good: the failure is a row's, not the task's."""
    from gridlens.operators.metrics import in_batches

    def effect(batch: pd.DataFrame) -> pd.DataFrame:
        def call(x):
            if x % 4 == 3:
                raise ValueError(3)
            return x

        run = Q.with_backoff(call, 2, 0.0)
        return pd.DataFrame({"n_nationkey": batch["n_nationkey"], "error": [run(x)[1] for x in batch["n_nationkey"]]})

    return in_batches(effect, "n_nationkey int, error string")(t.nation.select("n_nationkey"))
