"""Other inputs: urls, sidecars, caches, query workbooks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """The first row of each key, by order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def url_sources(sources: Sequence[DataFrame], key: Column) -> DataFrame:
    """Urls of several sources, the first one that has a key wins; blank and # lines do not count."""
    every = None
    for k, s in enumerate(sources):
        rows = s.select("url", F.col("ord").cast("long").alias("ord"), F.lit(k).alias("prio")).where("trim(url) <> '' and not startswith(trim(url), '#')")
        every = rows if every is None else every.unionByName(rows)
    return first_seen(every.withColumn("key", key), F.col("key"), [F.col("prio"), F.col("ord")])


def with_cache(wanted: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(found, missing) of the wanted keys."""
    return wanted.join(cache, key), wanted.join(cache.select(key), key, "left_anti")


def sampled_frames(videos: DataFrame, n: Column, step: Column, most: int) -> DataFrame:
    """Every step-th frame of each video, ``most`` at the most."""
    last = F.least(n - 1, (F.lit(most) - 1) * step)
    return videos.where(n > 0).withColumn("frame", F.explode(F.sequence(F.lit(0).cast("long"), last, step)))


def keyframes(frames: DataFrame, threshold: float) -> DataFrame:
    """Frames (video, frame, value) that differ from the one before by the threshold; the first two of a video always stay."""
    w = Window.partitionBy("video").orderBy("frame")
    f = frames.withColumn("_p", F.lag("value").over(w)).withColumn("_n", F.row_number().over(w))
    return f.where((F.col("_n") <= 2) | (F.abs(F.col("value") - F.col("_p")) >= threshold)).drop("_p", "_n")


def category_of(term: Column, rules: Sequence[tuple[str, str]], other: str) -> Column:
    """The category of the first prefix that fits."""
    out = None
    for prefix, category in rules:
        hit = F.lower(term).startswith(prefix)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise(other)


def result_key(*parts: Column, digits: int = 16) -> Column:
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, digits)


def config_hash(*parts: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, digits)


def most_advanced(rows: DataFrame, by: str, stage: Column, order: Sequence[str]) -> DataFrame:
    """(by, stage): of each group the stage that stands last in ``order``, whatever the stages are called; others don't count."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), stage)
    return rows.withColumn("_p", place).where("_p > 0").groupBy(by).agg(F.max("_p").alias("_p")).select(by, F.element_at(F.array(*[F.lit(s) for s in order]), F.col("_p").cast("int")).alias("stage"))
