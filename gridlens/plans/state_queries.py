"""Queries over the state of the pipeline."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlens.operators import state as S
from gridlens.plans.views import NOW
from gridlens.registry import query



def now():
    return F.expr(NOW)


MINUTES = f"(epoch({NOW}) - epoch({{}})) / 60e0"

COUNTS_SQL = """SELECT pv.project_id, coalesce(sum(v.frame_count), 0)::BIGINT AS extracted_frames, coalesce(sum(pv.passed_frames), 0)::BIGINT AS filtered_frames,
  count(*) AS total_videos, count(*) FILTER (v.status IN ('PENDING', 'DOWNLOADING')) AS videos_pending,
  count(*) FILTER (v.status IN ('DOWNLOADED', 'EXTRACTING', 'EXTRACTED')) AS videos_downloaded,
  count(*) FILTER (v.status = 'EXTRACTED') AS videos_extracted, count(*) FILTER (v.status = 'FAILED') AS videos_failed
FROM project_videos pv JOIN videos v USING (video_id) GROUP BY pv.project_id"""


@query("agg_project_counts", COUNTS_SQL)
def _(t):
    return S.project_counts(t.project_videos, t.videos)


@query("jn_update_from", f"""WITH c AS ({COUNTS_SQL}) SELECT c.* FROM c JOIN projects p USING (project_id) WHERE p.project_stage <> 'COMPLETE' AND
  (p.extracted_frames <> c.extracted_frames OR p.filtered_frames <> c.filtered_frames OR p.total_videos <> c.total_videos OR p.videos_pending <> c.videos_pending
   OR p.videos_downloaded <> c.videos_downloaded OR p.videos_extracted <> c.videos_extracted OR p.videos_failed <> c.videos_failed)""")  # fmt: skip
def _(t):
    return S.changed_counts(t.projects, S.project_counts(t.project_videos, t.videos))


@query("agg_video_status", "SELECT status, count(*) AS n FROM videos GROUP BY status")
def _(t):
    return t.videos.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("agg_project_status", """SELECT project_id, 'project_video' AS side, status, count(*) AS n FROM project_videos GROUP BY ALL
UNION ALL SELECT pv.project_id, 'video', v.status, count(*) FROM project_videos pv JOIN videos v USING (video_id) GROUP BY ALL""")  # fmt: skip
def _(t):
    links = t.project_videos.groupBy("project_id", F.lit("project_video").alias("side"), "status").agg(F.count(F.lit(1)).alias("n"))
    vids = t.project_videos.select("project_id", "video_id").join(t.videos.select("video_id", "status"), "video_id")
    return links.unionByName(vids.groupBy("project_id", F.lit("video").alias("side"), "status").agg(F.count(F.lit(1)).alias("n")))


@query("agg_count_project", "SELECT count(*) AS n FROM project_videos WHERE project_id = 7")
def _(t):
    return t.project_videos.where("project_id = 7").agg(F.count(F.lit(1)).alias("n"))


@query("agg_status_derived", """WITH s AS (SELECT pv.project_id, count(*) FILTER (v.status = 'PENDING') AS p, count(*) FILTER (v.status = 'DOWNLOADED') AS d,
  count(*) FILTER (v.status = 'EXTRACTING') AS x, count(*) FILTER (v.status = 'EXTRACTED') AS e, count(*) FILTER (v.status = 'FAILED') AS f,
  count(*) FILTER (pv.status = 'FILTERED') AS pf, count(*) FILTER (pv.status = 'FILTERED_EMPTY') AS pe, count(*) FILTER (pv.status = 'FAILED') AS pb
  FROM project_videos pv JOIN videos v USING (video_id) GROUP BY 1)
SELECT project_id, d + x + e AS downloaded, d + x + e - e - x AS extraction_pending, e - pf - pe - (pb - f) AS filter_pending, p AS download_pending FROM s""")  # fmt: skip
def _(t):
    return S.status_pivot(t.project_videos, t.videos)


@query("agg_failed_by_project", "SELECT p.name, count(*) AS failed FROM project_videos pv JOIN projects p USING (project_id) WHERE pv.status = 'FAILED' GROUP BY p.name")
def _(t):
    return t.project_videos.where("status = 'FAILED'").join(t.projects.select("project_id", "name"), "project_id").groupBy("name").agg(F.count(F.lit(1)).alias("failed"))


@query("agg_progress", """SELECT stage, status, count(*) AS n FROM work_queue GROUP BY ROLLUP (stage, status)""")
def _(t):
    return t.work_queue.rollup("stage", "status").agg(F.count(F.lit(1)).alias("n"))


@query("agg_barrier", "SELECT image_id, count(DISTINCT model) AS models FROM proposals GROUP BY image_id HAVING count(DISTINCT model) >= 3")
def _(t):
    return t.proposals.groupBy("image_id").agg(F.count_distinct("model").alias("models")).where("models >= 3")


@query("jn_claim_video", """SELECT v.video_id, v.created_at FROM videos v WHERE v.status = 'PENDING' AND v.locked_by IS NULL
  AND EXISTS (SELECT 1 FROM project_videos pv WHERE pv.video_id = v.video_id) ORDER BY v.created_at, v.video_id LIMIT 1""")  # fmt: skip
def _(t):
    free = t.videos.where("status = 'PENDING' and locked_by is null").join(t.project_videos, "video_id", "left_semi")
    return S.next_of(free, [F.col("created_at"), F.col("video_id")]).select("video_id", "created_at")


@query("jn_claim_pv", """SELECT pv.id, pv.video_id, p.name, v.frames_dir FROM project_videos pv JOIN videos v USING (video_id) JOIN projects p ON p.project_id = pv.project_id
WHERE pv.status = 'PENDING' AND v.status = 'EXTRACTED' AND v.frames_dir IS NOT NULL AND p.project_stage IN ('POPULATING', 'FILTERING')""")  # fmt: skip
def _(t):
    p = t.projects.where("project_stage in ('POPULATING', 'FILTERING')").select("project_id", "name")
    v = t.videos.where("status = 'EXTRACTED' and frames_dir is not null").select("video_id", "frames_dir")
    return t.project_videos.where("status = 'PENDING'").join(p, "project_id").join(v, "video_id").select("id", "video_id", "name", "frames_dir")


@query("jn_semi_started", "SELECT project_id, name FROM projects p WHERE project_stage = 'POPULATING' AND EXISTS (SELECT 1 FROM project_videos pv WHERE pv.project_id = p.project_id AND pv.status <> 'PENDING')")
def _(t):
    return S.started(t.projects, t.project_videos).select("project_id", "name")


@query("jn_anti_terminal", """SELECT project_id, name FROM projects p WHERE project_stage = 'FILTERING'
  AND NOT EXISTS (SELECT 1 FROM project_videos pv WHERE pv.project_id = p.project_id AND pv.status NOT IN ('FILTERED', 'FILTERED_EMPTY', 'FAILED'))
  AND EXISTS (SELECT 1 FROM project_videos pv WHERE pv.project_id = p.project_id)""")  # fmt: skip
def _(t):
    return S.all_filtered(t.projects, t.project_videos).select("project_id", "name")


@query("jn_reset_pending", """SELECT project_id, name FROM projects p WHERE project_stage NOT IN ('POPULATING', 'FILTERING', 'FAILED')
  AND EXISTS (SELECT 1 FROM project_videos pv WHERE pv.project_id = p.project_id AND pv.status = 'PENDING')""")  # fmt: skip
def _(t):
    return S.to_reset(t.projects, t.project_videos).select("project_id", "name")


TRANSITIONS_SQL = """SELECT p.project_id, CASE
  WHEN project_stage = 'POPULATING' AND EXISTS (SELECT 1 FROM project_videos v WHERE v.project_id = p.project_id AND status <> 'PENDING') THEN 'FILTERING'
  WHEN project_stage = 'FILTERING' AND EXISTS (SELECT 1 FROM project_videos v WHERE v.project_id = p.project_id)
    AND NOT EXISTS (SELECT 1 FROM project_videos v WHERE v.project_id = p.project_id AND status NOT IN ('FILTERED', 'FILTERED_EMPTY', 'FAILED')) THEN 'DEDUP_READY'
  WHEN project_stage NOT IN ('POPULATING', 'FILTERING', 'FAILED') AND EXISTS (SELECT 1 FROM project_videos v WHERE v.project_id = p.project_id AND status = 'PENDING') THEN 'POPULATING'
  ELSE project_stage END AS project_stage FROM projects p"""


@query("st_transitions", TRANSITIONS_SQL)
def _(t):
    return S.transitions(t.projects, t.project_videos).select("project_id", "project_stage")


@query("jn_cleanup_raw", """SELECT video_id, frames_dir FROM videos v WHERE frames_dir IS NOT NULL AND EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id)
  AND NOT EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id AND p.status NOT IN ('FILTERED', 'FILTERED_EMPTY'))""")  # fmt: skip
def _(t):
    return S.cleanable(t.videos, t.project_videos).select("video_id", "frames_dir")


@query("jn_backup_ready", """SELECT video_id, frames_dir FROM videos v WHERE status = 'EXTRACTED' AND frames_dir IS NOT NULL AND NOT backed_up
  AND EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id)
  AND NOT EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id AND p.status NOT IN ('FILTERED', 'FILTERED_EMPTY', 'FAILED'))""")  # fmt: skip
def _(t):
    return S.backup_ready(t.videos, t.project_videos).select("video_id", "frames_dir")


@query("jn_orphans", "SELECT v.video_id, v.status FROM videos v LEFT JOIN project_videos pv USING (video_id) WHERE pv.id IS NULL")
def _(t):
    return S.orphans(t.videos, t.project_videos).select("video_id", "status")


@query("jn_failed_3way", """SELECT pv.id, v.video_id, p.name FROM project_videos pv JOIN videos v USING (video_id) JOIN projects p ON p.project_id = pv.project_id
WHERE pv.status = 'FAILED' AND p.name LIKE '%1%'""")  # fmt: skip
def _(t):
    p = t.projects.where(F.col("name").contains("1")).select("project_id", "name")
    return t.project_videos.where("status = 'FAILED'").join(p, "project_id").join(t.videos.select("video_id"), "video_id").select("id", "video_id", "name")


@query("jn_remote_sync", "SELECT video_id FROM videos WHERE NOT backed_up AND video_id IN (SELECT p_partkey * 3 FROM part)")
def _(t):
    return t.videos.where("not backed_up").join(t.part.select((F.col("p_partkey") * 3).alias("video_id")), "video_id", "left_semi").select("video_id")


@query("lim_claim", """SELECT image_id, stage, score FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY score, claimed_at, image_id) AS rn
  FROM work_queue WHERE status = 'queued') AS q WHERE rn = 1""")  # fmt: skip
def _(t):
    return S.next_of(t.work_queue.where("status = 'queued'"), [F.col("score"), F.col("claimed_at"), F.col("image_id")], ["stage"]).select("image_id", "stage", "score")


@query("lim_longlock", f"SELECT video_id, status, locked_by, {MINUTES.format('locked_at')} AS minutes_locked FROM videos WHERE locked_by IS NOT NULL AND locked_at < {NOW} - INTERVAL 30 MINUTE")
def _(t):
    return S.held_long(t.videos, now(), 30).orderBy("locked_at", "video_id").select("video_id", "status", "locked_by", "minutes_locked")


@query("st_claim", """SELECT image_id, stage, CASE WHEN rn = 1 AND status = 'queued' THEN 'processing' ELSE status END AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY stage, status ORDER BY score, claimed_at, image_id) AS rn FROM work_queue) AS q""")  # fmt: skip
def _(t):
    first = F.row_number().over(Window.partitionBy("stage", "status").orderBy("score", "claimed_at", "image_id")) == 1
    return t.work_queue.select("image_id", "stage", F.when(first & (F.col("status") == "queued"), "processing").otherwise(F.col("status")).alias("status"))


@query("st_claim_stage", """SELECT project_id, CASE WHEN project_id = (SELECT min(project_id) FROM projects WHERE project_stage = 'DEDUP_READY') THEN 'DEDUPING' ELSE project_stage END AS project_stage FROM projects""")
def _(t):
    ready, to = S.PROJECT_CLAIM["dedup"]
    chosen = S.next_of(t.projects.where(F.col("project_stage") == ready), [F.col("project_id")]).select(F.col("project_id").alias("k"))
    return t.projects.join(F.broadcast(chosen), F.col("project_id") == F.col("k"), "left").select("project_id", F.when(F.col("k").isNotNull(), to).otherwise(F.col("project_stage")).alias("project_stage"))


STALE = f"locked_by IS NOT NULL AND heartbeat_at IS NOT NULL AND heartbeat_at < {NOW} - INTERVAL 2 MINUTE"


@query("fn_case_stale", f"""SELECT video_id, CASE WHEN {STALE} AND status = 'DOWNLOADING' THEN 'PENDING' WHEN {STALE} AND status = 'EXTRACTING' THEN 'DOWNLOADED' ELSE status END AS status,
  CASE WHEN {STALE} AND status IN ('DOWNLOADING', 'EXTRACTING') THEN NULL ELSE locked_by END AS locked_by FROM videos""")  # fmt: skip
def _(t):
    return S.recover(t.videos, now(), 2, S.VIDEO_ROLLBACK).select("video_id", "status", "locked_by")


@query("fn_now_age", f"SELECT video_id, {MINUTES.format('heartbeat_at')} AS minutes FROM videos WHERE heartbeat_at IS NOT NULL")
def _(t):
    return t.videos.where("heartbeat_at is not null").select("video_id", S.minutes_since(F.col("heartbeat_at"), now()).alias("minutes"))


@query("st_stale", f"""SELECT id, CASE WHEN {STALE} AND status = 'FILTERING' THEN 'PENDING' ELSE status END AS status, CASE WHEN {STALE} AND status = 'FILTERING' THEN NULL ELSE locked_by END AS locked_by FROM project_videos""")
def _(t):
    return S.recover(t.project_videos, now(), 2, {"FILTERING": "PENDING"}).select("id", "status", "locked_by")


@query("st_longlock_warn", f"SELECT locked_by, count(*) AS locks, max({MINUTES.format('locked_at')}) AS longest FROM videos WHERE locked_by IS NOT NULL AND locked_at < {NOW} - INTERVAL 30 MINUTE GROUP BY locked_by")
def _(t):
    return S.held_long(t.videos, now(), 30).groupBy("locked_by").agg(F.count(F.lit(1)).alias("locks"), F.max("minutes_locked").alias("longest"))


@query("st_retry", """SELECT image_id, stage, CASE WHEN status = 'failed' THEN 'queued' ELSE status END AS status, attempts + (status = 'failed')::INT AS attempts
FROM work_queue WHERE NOT (status = 'failed' AND attempts + 1 >= 3)""")  # fmt: skip
def _(t):
    return S.retry_or_bury(t.work_queue, 3)[0].select("image_id", "stage", "status", "attempts")


@query("st_deadletter", "SELECT image_id, stage, attempts + 1 AS attempts FROM work_queue WHERE status = 'failed' AND attempts + 1 >= 3")
def _(t):
    return S.retry_or_bury(t.work_queue, 3)[1]


@query("st_barrier", "SELECT image_id, list_sort(list(DISTINCT model)) AS models FROM proposals GROUP BY image_id HAVING count(DISTINCT model) = 4")
def _(t):
    return t.proposals.groupBy("image_id").agg(F.sort_array(F.collect_set("model")).alias("models")).where("size(models) = 4")


@query("st_forward", """SELECT image_id, count(DISTINCT stage) AS stages, bool_or(stage = 'finalize') AS complete, count(DISTINCT stage) = 4 AS all_stages FROM stage_rows GROUP BY image_id""")
def _(t):
    return t.stage_rows.groupBy("image_id").agg(F.count_distinct("stage").alias("stages"), F.bool_or(F.col("stage") == "finalize").alias("complete")).withColumn("all_stages", F.expr("stages = 4"))


@query("st_resume", """SELECT q.image_id, q.stage, CASE WHEN s.config_hash IS NULL THEN 'run' WHEN s.config_hash = 'h1' THEN 'skip' ELSE 'invalidate' END AS step
FROM work_queue q LEFT JOIN stage_rows s ON q.image_id = s.image_id AND q.stage = s.stage""")  # fmt: skip
def _(t):
    s = t.stage_rows.select("image_id", "stage", "config_hash")
    step = F.when(F.col("config_hash").isNull(), "run").when(F.col("config_hash") == "h1", "skip").otherwise("invalidate")
    return t.work_queue.select("image_id", "stage").join(s, ["image_id", "stage"], "left").select("image_id", "stage", step.alias("step"))


@query("st_force", """SELECT DISTINCT q.image_id, 'evaluate' AS stage, EXISTS (SELECT 1 FROM stage_rows s WHERE s.image_id = q.image_id AND s.stage = 'detect') AS allowed FROM work_queue q""")
def _(t):
    had = t.stage_rows.where("stage = 'detect'").select(F.col("image_id").alias("k")).distinct()
    images = t.work_queue.select("image_id").distinct()
    return images.join(had, F.col("image_id") == F.col("k"), "left").select("image_id", F.lit("evaluate").alias("stage"), F.col("k").isNotNull().alias("allowed"))


@query("st_monitor", """SELECT count(DISTINCT image_id) AS images, count(DISTINCT image_id) FILTER (stage = 'finalize' AND status = 'done') AS done,
  count(DISTINCT image_id) FILTER (status = 'failed') AS failed FROM work_queue""")  # fmt: skip
def _(t):
    return t.work_queue.agg(
        F.count_distinct("image_id").alias("images"),
        F.count_distinct(F.when((F.col("stage") == "finalize") & (F.col("status") == "done"), F.col("image_id"))).alias("done"),
        F.count_distinct(F.when(F.col("status") == "failed", F.col("image_id"))).alias("failed"),
    )


@query("st_pending", "SELECT stage, count(*) AS length, count(*) FILTER (status = 'processing') AS pending FROM work_queue GROUP BY stage")
def _(t):
    return t.work_queue.groupBy("stage").agg(F.count(F.lit(1)).alias("length"), F.count_if(F.col("status") == "processing").alias("pending"))


@query("st_job_filter", "SELECT event_type AS job, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type")
def _(t):
    return t.events.where("event_type <> 'error'").groupBy(F.col("event_type").alias("job")).agg(F.count(F.lit(1)).alias("n"))


# changes


@query("dml_upsert_link", """SELECT project_id, video_id FROM project_videos UNION SELECT o_custkey % 25, o_orderkey FROM orders WHERE o_orderkey % 10 = 9""")
def _(t):
    held = t.project_videos.select("project_id", "video_id").distinct()
    new = t.orders.where("o_orderkey % 10 = 9").select((F.col("o_custkey") % 25).alias("project_id"), F.col("o_orderkey").alias("video_id"))
    return S.insert_missing(held, new, ["project_id", "video_id"])


@query("dml_insert_ignore", """SELECT image_id, model, boxes FROM proposals UNION ALL
SELECT DISTINCT g.img, 1::BIGINT, 0::BIGINT FROM ground_truth g WHERE NOT EXISTS (SELECT 1 FROM proposals p WHERE p.image_id = g.img AND p.model = 1)""")  # fmt: skip
def _(t):
    new = t.ground_truth.select(F.col("img").alias("image_id"), F.lit(1).cast("long").alias("model"), F.lit(0).cast("long").alias("boxes"))
    return S.insert_missing(t.proposals, new, ["image_id", "model"])


@query("dml_replace", f"""SELECT image_id, stage, coalesce(n.config_hash, s.config_hash) AS config_hash FROM stage_rows s
FULL JOIN (SELECT image_id, stage, 'h2' AS config_hash FROM work_queue WHERE status = 'done') n USING (image_id, stage)""")  # fmt: skip
def _(t):
    new = t.work_queue.where("status = 'done'").select("image_id", "stage", F.lit("h2").alias("config_hash"), F.expr("timestamp_ntz'2030-01-01'").alias("created_at"))
    return S.replace_rows(t.stage_rows, new, ["image_id", "stage"], "created_at").select("image_id", "stage", "config_hash")


@query("dml_release", "SELECT video_id, CASE WHEN video_id = 1 AND locked_by = (SELECT locked_by FROM videos WHERE video_id = 1) THEN 'DOWNLOADED' ELSE status END AS status, CASE WHEN video_id = 1 THEN NULL ELSE locked_by END AS locked_by FROM videos")
def _(t):
    own = t.videos.where("video_id = 1").select(F.col("locked_by").alias("w"))
    hit = (F.col("video_id") == 1) & (F.col("locked_by") == F.col("w"))
    rows = t.videos.join(F.broadcast(own), F.lit(True), "left")
    return rows.select("video_id", F.when(hit, "DOWNLOADED").otherwise(F.col("status")).alias("status"), F.when(hit, None).otherwise(F.col("locked_by")).alias("locked_by"))


@query("dml_fail_cascade", """SELECT id, CASE WHEN v.status = 'FAILED' THEN 'FAILED' ELSE pv.status END AS status,
  CASE WHEN v.status = 'FAILED' THEN 'Video failed: gone' END AS error FROM project_videos pv LEFT JOIN videos v USING (video_id)""")  # fmt: skip
def _(t):
    failed = t.videos.where("status = 'FAILED'").select("video_id", F.lit("gone").alias("error"))
    return S.fail_cascade(t.project_videos, failed).select("id", "status", "error")


@query("dml_heartbeat", f"SELECT video_id, CASE WHEN locked_by = 'w1' THEN {NOW} ELSE heartbeat_at END AS heartbeat_at FROM videos")
def _(t):
    return S.beat(t.videos.withColumn("heartbeat_at", F.col("heartbeat_at").cast("timestamp")), "w1", now()).select("video_id", F.col("heartbeat_at").cast("timestamp_ntz").alias("heartbeat_at"))


@query("dml_stage_move", "SELECT project_id, CASE WHEN project_stage = 'DEDUPING' THEN 'DETECT_READY' WHEN project_id = 7 THEN 'FAILED' ELSE project_stage END AS project_stage FROM projects")
def _(t):
    return t.projects.select("project_id", F.when(F.col("project_stage") == "DEDUPING", "DETECT_READY").when(F.col("project_id") == 7, "FAILED").otherwise(F.col("project_stage")).alias("project_stage"))


@query("dml_clear_path", "SELECT video_id, CASE WHEN status = 'EXTRACTED' THEN NULL ELSE video_path END AS video_path FROM videos")
def _(t):
    return t.videos.select("video_id", F.when(F.col("status") == "EXTRACTED", None).otherwise(F.col("video_path")).alias("video_path"))


@query("dml_mark_backup", """SELECT v.video_id, backed_up OR (status = 'EXTRACTED' AND frames_dir IS NOT NULL AND EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id)
  AND NOT EXISTS (SELECT 1 FROM project_videos p WHERE p.video_id = v.video_id AND p.status NOT IN ('FILTERED', 'FILTERED_EMPTY', 'FAILED'))) AS backed_up FROM videos v""")  # fmt: skip
def _(t):
    ready = S.backup_ready(t.videos, t.project_videos).select(F.col("video_id").alias("k"))
    return t.videos.join(ready, F.col("video_id") == F.col("k"), "left").select("video_id", (F.col("backed_up") | F.col("k").isNotNull()).alias("backed_up"))


@query("dml_delete_project", "SELECT id, filtered_dir FROM project_videos WHERE project_id = 7 AND filtered_dir IS NOT NULL")
def _(t):
    return t.project_videos.where("project_id = 7 and filtered_dir is not null").select("id", "filtered_dir")


@query("dml_delete_filter", "SELECT id, project_id, status FROM project_videos WHERE NOT (project_id = 7 AND status = 'FILTERED')")
def _(t):
    return t.project_videos.where("not (project_id = 7 and status = 'FILTERED')").select("id", "project_id", "status")


@query("dml_delete_orphans", "SELECT video_id FROM videos WHERE video_id IN (SELECT video_id FROM project_videos)")
def _(t):
    return t.videos.join(t.project_videos, "video_id", "left_semi").select("video_id")


@query("dml_invalidate", "SELECT image_id, stage FROM stage_rows WHERE stage NOT IN ('refine', 'finalize')")
def _(t):
    return S.invalidate(t.stage_rows, "refine").select("image_id", "stage")


@query("dml_clear_image", "SELECT image_id, stage FROM stage_rows WHERE image_id NOT IN (SELECT image_id FROM work_queue WHERE status = 'failed')")
def _(t):
    return t.stage_rows.join(t.work_queue.where("status = 'failed'").select("image_id"), "image_id", "left_anti").select("image_id", "stage")


PLACES = "CASE WHEN frames_dir IS NOT NULL THEN 'local' WHEN backed_up THEN 'remote' ELSE 'nowhere' END"


@query("set_local_remote", f"SELECT video_id, {PLACES} AS place FROM videos WHERE status = 'FAILED' OR status = 'EXTRACTED'")
def _(t):
    place = F.when(F.col("frames_dir").isNotNull(), "local").when(F.col("backed_up"), "remote").otherwise("nowhere")
    return t.videos.where("status in ('FAILED', 'EXTRACTED')").select("video_id", place.alias("place"))


@query("dml_reset", f"""SELECT pv.id, CASE WHEN pv.status <> 'FAILED' THEN pv.status ELSE CASE {PLACES} WHEN 'local' THEN 'PENDING' WHEN 'remote' THEN 'FILTERED_EMPTY' ELSE 'REDOWNLOAD' END END AS status
FROM project_videos pv JOIN (SELECT video_id, frames_dir, backed_up FROM videos) v USING (video_id)""")  # fmt: skip
def _(t):
    to = F.when(F.col("frames_dir").isNotNull(), "PENDING").when(F.col("backed_up"), "FILTERED_EMPTY").otherwise("REDOWNLOAD")
    j = t.project_videos.select("id", "video_id", "status").join(t.videos.select("video_id", "frames_dir", "backed_up"), "video_id")
    return j.select("id", F.when(F.col("status") == "FAILED", to).otherwise(F.col("status")).alias("status"))


@query("jn_viewer", """SELECT q.image_id, list_sort(list(q.stage || ':' || q.status)) AS stages, coalesce(max(p.models), 0)::BIGINT AS models, max(f.n) AS failures FROM work_queue q
LEFT JOIN (SELECT image_id, count(*) AS models FROM proposals GROUP BY image_id) p USING (image_id)
LEFT JOIN (SELECT image_id, count(*) AS n FROM work_queue WHERE status = 'failed' GROUP BY image_id) f USING (image_id) GROUP BY q.image_id""")  # fmt: skip
def _(t):
    q = t.work_queue.groupBy("image_id").agg(F.sort_array(F.collect_list(F.concat_ws(":", "stage", "status"))).alias("stages"), F.nullif(F.count_if(F.col("status") == "failed"), F.lit(0)).alias("failures"))
    p = t.proposals.groupBy("image_id").agg(F.count(F.lit(1)).alias("models"))
    return q.join(p, "image_id", "left").select("image_id", "stages", F.coalesce("models", F.lit(0)).cast("long").alias("models"), "failures")


@query("jn_compare_runs", """SELECT stage, status, count(*) FILTER (image_id % 2 = 0) AS run_a, count(*) FILTER (image_id % 2 = 1) AS run_b,
  count(*) FILTER (image_id % 2 = 1) - count(*) FILTER (image_id % 2 = 0) AS diff FROM work_queue GROUP BY stage, status""")  # fmt: skip
def _(t):
    return t.work_queue.groupBy("stage", "status").agg(F.count_if(F.expr("image_id % 2 = 0")).alias("run_a"), F.count_if(F.expr("image_id % 2 = 1")).alias("run_b")).withColumn("diff", F.expr("run_b - run_a"))
