"""State of a media pipeline as snapshots.

A change is a function from one snapshot to the next: nothing is updated in place. Reads are
semi, anti and conditional aggregates that Catalyst plans as hash joins and partial sums.
Times are compared with a given ``now``, so that a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The states and what follows them.
FILTER_DONE = ("FILTERED", "FILTERED_EMPTY")
FILTER_TERMINAL = ("FILTERED", "FILTERED_EMPTY", "FAILED")
VIDEO_ROLLBACK = {"DOWNLOADING": "PENDING", "EXTRACTING": "DOWNLOADED"}
VIDEO_CLAIM = {"download": ("PENDING", "DOWNLOADING"), "extract": ("DOWNLOADED", "EXTRACTING")}
PROJECT_CLAIM = {"dedup": ("DEDUP_READY", "DEDUPING"), "detect": ("DETECT_READY", "DETECTING")}
STAGES = ("detect", "evaluate", "refine", "finalize")
COUNTS = ("extracted_frames", "filtered_frames", "total_videos", "videos_pending", "videos_downloaded", "videos_extracted", "videos_failed")


def minutes_since(when: Column, now: Column) -> Column:
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(when.cast("timestamp"))) / F.lit(60e6)


def older(when: Column, now: Column, minutes: float) -> Column:
    return minutes_since(when, now) > F.lit(float(minutes))


# reads


def project_counts(project_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """Frames and videos by state for each project; downloaded counts what came after, too."""
    joined = project_videos.select("project_id", "video_id", "passed_frames").join(videos.select("video_id", "status", "frame_count"), "video_id")
    return joined.groupBy("project_id").agg(
        F.coalesce(F.sum("frame_count"), F.lit(0)).cast("long").alias("extracted_frames"),
        F.coalesce(F.sum("passed_frames"), F.lit(0)).cast("long").alias("filtered_frames"),
        F.count(F.lit(1)).alias("total_videos"),
        F.count_if(F.col("status").isin("PENDING", "DOWNLOADING")).alias("videos_pending"),
        F.count_if(F.col("status").isin("DOWNLOADED", "EXTRACTING", "EXTRACTED")).alias("videos_downloaded"),
        F.count_if(F.col("status") == "EXTRACTED").alias("videos_extracted"),
        F.count_if(F.col("status") == "FAILED").alias("videos_failed"),
    )


def changed_counts(projects: DataFrame, counts: DataFrame) -> DataFrame:
    """The counts of projects in work that differ from those held."""
    held = projects.where("project_stage <> 'COMPLETE'").select("project_id", *[F.col(c).alias(f"held_{c}") for c in COUNTS])
    differs = F.lit(False)
    for c in COUNTS:
        differs = differs | (F.col(c) != F.col(f"held_{c}"))
    return counts.join(held, "project_id").where(differs).select("project_id", *COUNTS)


def status_pivot(project_videos: DataFrame, videos: DataFrame) -> DataFrame:
    """Totals derived from a project's two status counts."""
    both = project_videos.select("project_id", "video_id", F.col("status").alias("pv")).join(videos.select("video_id", F.col("status").alias("v")), "video_id")
    n = {f"{side}_{s}": F.count_if(F.col(side) == s) for side, s in [("v", x) for x in ("PENDING", "DOWNLOADING", "DOWNLOADED", "EXTRACTING", "EXTRACTED", "FAILED")] + [("pv", x) for x in ("PENDING", "FILTERED", "FILTERED_EMPTY", "FAILED")]}
    s = both.groupBy("project_id").agg(*[c.alias(k) for k, c in n.items()])
    downloaded = F.col("v_DOWNLOADED") + F.col("v_EXTRACTING") + F.col("v_EXTRACTED")
    return s.select(
        "project_id", downloaded.alias("downloaded"), (downloaded - F.col("v_EXTRACTED") - F.col("v_EXTRACTING")).alias("extraction_pending"),
        (F.col("v_EXTRACTED") - F.col("pv_FILTERED") - F.col("pv_FILTERED_EMPTY") - (F.col("pv_FAILED") - F.col("v_FAILED"))).alias("filter_pending"),
        F.col("v_PENDING").alias("download_pending"),
    )


def started(projects: DataFrame, project_videos: DataFrame) -> DataFrame:
    """POPULATING projects of which some video left PENDING."""
    return projects.where("project_stage = 'POPULATING'").join(project_videos.where("status <> 'PENDING'"), "project_id", "left_semi")


def all_filtered(projects: DataFrame, project_videos: DataFrame) -> DataFrame:
    """FILTERING projects that have videos, all of them in a final state."""
    open_ = project_videos.where(~F.col("status").isin(*FILTER_TERMINAL))
    ready = projects.where("project_stage = 'FILTERING'").join(project_videos, "project_id", "left_semi")
    return ready.join(open_, "project_id", "left_anti")


def to_reset(projects: DataFrame, project_videos: DataFrame) -> DataFrame:
    """Projects past FILTERING to which pending videos came."""
    past = projects.where("project_stage not in ('POPULATING', 'FILTERING', 'FAILED')")
    return past.join(project_videos.where("status = 'PENDING'"), "project_id", "left_semi")


def transitions(projects: DataFrame, project_videos: DataFrame) -> DataFrame:
    """The next snapshot of projects: the three moves above, from one pass over the links."""
    seen = project_videos.groupBy("project_id").agg(
        F.count_if(F.col("status") != "PENDING").alias("_left"), F.count_if(~F.col("status").isin(*FILTER_TERMINAL)).alias("_open"), F.count_if(F.col("status") == "PENDING").alias("_pending"),
    )
    stage = F.col("project_stage")
    new = (
        F.when((stage == "POPULATING") & (F.col("_left") > 0), "FILTERING")
        .when((stage == "FILTERING") & (F.col("_open") == 0), "DEDUP_READY")
        .when(~stage.isin("POPULATING", "FILTERING", "FAILED") & (F.col("_pending") > 0), "POPULATING")
        .otherwise(stage)
    )
    return projects.join(seen, "project_id", "left").withColumn("project_stage", new).drop("_left", "_open", "_pending")


def cleanable(videos: DataFrame, project_videos: DataFrame, done: Sequence[str] = FILTER_DONE) -> DataFrame:
    """Videos with raw frames of which every link is done."""
    has = videos.where("frames_dir is not null").join(project_videos, "video_id", "left_semi")
    return has.join(project_videos.where(~F.col("status").isin(*done)), "video_id", "left_anti")


def backup_ready(videos: DataFrame, project_videos: DataFrame) -> DataFrame:
    """Extracted videos not backed up yet; here a failed link counts as done."""
    return cleanable(videos.where("status = 'EXTRACTED' and not backed_up"), project_videos, FILTER_TERMINAL)


def orphans(videos: DataFrame, project_videos: DataFrame) -> DataFrame:
    return videos.join(project_videos, "video_id", "left_anti")


def held_long(rows: DataFrame, now: Column, minutes: float, since: str = "locked_at") -> DataFrame:
    """Rows locked for longer than ``minutes``, with how long."""
    return rows.where(F.col("locked_by").isNotNull() & older(F.col(since), now, minutes)).withColumn("minutes_locked", minutes_since(F.col(since), now))


def next_of(rows: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The first row (of each group): a heap of one row a task, not a sort of all."""
    if not by:
        return rows.orderBy(*order).limit(1)
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_rn = 1").drop("_rn")


# changes


def claim(rows: DataFrame, key: str, chosen: DataFrame, status: str, to: str, worker: str, now: Column, heartbeat: bool = True) -> DataFrame:
    """Locks the ``chosen`` keys for a worker."""
    mine = rows.join(F.broadcast(chosen.select(F.col(key).alias("_k"))), F.col(key) == F.col("_k"), "left")  # one row a worker
    hit = F.col("_k").isNotNull()
    out = mine.withColumn(status, F.when(hit, to).otherwise(F.col(status))).withColumn("locked_by", F.when(hit, worker).otherwise(F.col("locked_by")))
    for c in ("locked_at", "heartbeat_at") if heartbeat else ("locked_at",):
        if c in rows.columns:
            out = out.withColumn(c, F.when(hit, now).otherwise(F.col(c)))
    return out.drop("_k")


def release(rows: DataFrame, key: str, value, worker: str, to: str) -> DataFrame:
    """Unlocks one row if the worker still owns it."""
    own = F.coalesce((F.col(key) == value) & (F.col("locked_by") == worker), F.lit(False))
    free = {c: F.when(own, None).otherwise(F.col(c)) for c in ("locked_at", "heartbeat_at", "locked_by") if c in rows.columns}
    return rows.withColumns({"status": F.when(own, to).otherwise(F.col("status")), **free})


def beat(rows: DataFrame, worker: str, now: Column) -> DataFrame:
    return rows.withColumn("heartbeat_at", F.when(F.col("locked_by") == worker, now).otherwise(F.col("heartbeat_at")))


def recover(rows: DataFrame, now: Column, minutes: float, rollback: dict[str, str]) -> DataFrame:
    """Stale claims go back to the state before; locks without a heartbeat never go stale."""
    stale = F.col("locked_by").isNotNull() & F.col("heartbeat_at").isNotNull() & older(F.col("heartbeat_at"), now, minutes) & F.col("status").isin(*rollback)
    marked = rows.withColumn("_stale", F.coalesce(stale, F.lit(False)))
    back = F.col("status")
    for a, b in rollback.items():
        back = F.when(F.col("_stale") & (F.col("status") == a), b).otherwise(back)
    out = marked.withColumn("status", back)
    for c in ("locked_by", "locked_at", "heartbeat_at"):
        if c in rows.columns:
            out = out.withColumn(c, F.when(F.col("_stale"), None).otherwise(F.col(c)))
    return out.drop("_stale")


def fail_cascade(project_videos: DataFrame, failed: DataFrame) -> DataFrame:
    """Links of the failed videos (video_id, error) fail with a prefixed error."""
    hit = project_videos.join(failed.select("video_id", F.col("error").alias("_e")), "video_id", "left")
    return hit.withColumn("status", F.when(F.col("_e").isNotNull(), "FAILED").otherwise(F.col("status"))).withColumn("error", F.concat(F.lit("Video failed: "), "_e")).drop("_e")


def insert_missing(held: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``held`` and those of ``new`` whose key is not there; of equal new keys one."""
    return held.unionByName(new.dropDuplicates(list(key)).join(held.select(*key), list(key), "left_anti").select(*held.columns))


def replace_rows(held: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last row of each key, what is new before what is held at equal ``order``."""
    both = held.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return next_of(both, [F.col(order).desc(), F.col("_new").desc()], key).drop("_new")


def invalidate(stage_rows: DataFrame, from_stage: str, stages: Sequence[str] = STAGES) -> DataFrame:
    """Rows of a stage and of those after it go, ``stage:model`` forms with them."""
    gone = list(stages[stages.index(from_stage) :])
    return stage_rows.where(~F.substring_index("stage", ":", 1).isin(*gone))


def retry_or_bury(queue: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(next queue, failures): a failed row is queued once more, or buried at ``most`` attempts."""
    again = F.col("status") == "failed"
    bumped = queue.withColumn("attempts", F.when(again, F.col("attempts") + 1).otherwise(F.col("attempts")))
    dead = again & (F.col("attempts") >= most)
    live = bumped.where(~dead).withColumn("status", F.when(again, "queued").otherwise(F.col("status")))
    return live, bumped.where(dead).select("image_id", "stage", "attempts")
