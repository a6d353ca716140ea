"""Statistics of annotated datasets; labels has file, class_id, cx, cy, w, h, and an empty file one row of nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.operators.metrics import before, in_ranges

# Half-open bounds of the area buckets.
AREAS = {"small": (0.0, 0.01), "medium": (0.01, 0.09), "large": (0.09, 1.01)}


def class_distribution(labels: DataFrame) -> DataFrame:
    n = labels.where("class_id is not null").groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total), F.lit(True)).select("class_id", "n", (100 * F.col("n") / F.col("total")).alias("percent"))  # one row


def per_image(labels: DataFrame) -> DataFrame:
    return labels.groupBy("file").agg(F.count("class_id").alias("n"))


def box_stats(labels: DataFrame) -> DataFrame:
    b = labels.where("class_id is not null").withColumn("area", F.col("w") * F.col("h")).withColumn("aspect", F.when(F.col("h") != 0, F.col("w") / F.col("h")))
    out = [f(c).alias(f"{c}_{n}") for c in ("w", "h", "area") for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    return b.groupBy("class_id").agg(*out, F.avg("aspect").alias("aspect_mean"), F.median("aspect").alias("aspect_median"))


def area_buckets(labels: DataFrame) -> DataFrame:
    a = F.col("w") * F.col("h")
    return labels.where("class_id is not null").groupBy("class_id").agg(*[F.count_if((a >= lo) & (a < hi)).alias(k) for k, (lo, hi) in AREAS.items()])


def cooccurrence(labels: DataFrame) -> DataFrame:
    """(a, b, images) for classes in one image, the diagonal too: pairs of an image's classes, of which there are few."""
    sets = labels.where("class_id is not null").groupBy("file").agg(F.collect_set("class_id").alias("c"))
    pairs = sets.select(F.explode("c").alias("a"), "c").select("a", F.explode("c").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("images"))


def images_by_count(labels: DataFrame, most: int = 10) -> DataFrame:
    """Images with 1 to ``most`` boxes and with more; empty ones do not count."""
    bucket = F.when(F.col("n") > most, f">{most}").otherwise(F.col("n").cast("string"))
    return per_image(labels).where("n > 0").groupBy(bucket.alias("boxes")).agg(F.count(F.lit(1)).alias("images"))


def split_summary(labels: DataFrame, split: str = "split") -> DataFrame:
    """Per split and over all: files, empty files, annotations, mean over files that are not empty, median, largest."""
    f = labels.groupBy(split, "file").agg(F.count("class_id").alias("n"))
    out = [
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("n") == 0).alias("empty"), F.sum("n").alias("annotations"),
        F.avg(F.when(F.col("n") > 0, F.col("n"))).alias("mean"), F.median("n").alias("median"), F.max("n").alias("largest"),
    ]
    return f.rollup(split).agg(*out).withColumn(split, F.coalesce(split, F.lit("TOTAL")))


def shares(rows: DataFrame, by: str, categories: Sequence[str]) -> DataFrame:
    """Count and percent of each of a fixed list of categories, those without rows too."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(c,) for c in categories], f"{by} string")
    n = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    j = fixed.join(n, by, "left").join(total)  # one row
    return j.select(by, F.coalesce("n", F.lit(0)).cast("long").alias("n"), (100 * F.coalesce("n", F.lit(0)) / F.greatest("total", F.lit(1))).alias("percent"))


def answer_rates(answers: DataFrame, by: str, answer: Column) -> DataFrame:
    return answers.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(answer).alias("positive"), F.count_if(~answer).alias("negative"),
    ).withColumn("rate", F.col("positive") / F.col("total"))


def placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """rows with their place in the whole order, counted per range first, so that no task sorts them all."""
    r = in_ranges(rows, (), order)
    own = F.row_number().over(Window.partitionBy("_r").orderBy(*order))
    return r.join(before(r, (), _n0=F.count(F.lit(1))), "_r").withColumn("place", F.col("_n0") + own).drop("_r", "_n0")
