"""Tables of the media pipeline, derived from the driver's tables.

Each is one SELECT in the SQL that Spark and DuckDB share: whole numbers, remainders and
divisions by powers of two only, so that both engines hold the very same doubles.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: The moment at which ages are judged.
NOW = "TIMESTAMP '1998-01-01 00:00:00'"

VIEWS = {
    "detections": """
SELECT cand, img, cls, model, score, x1, y1, x2, y2 FROM (
  SELECT *, row_number() OVER (PARTITION BY cand ORDER BY score DESC, x1, y1, x2, y2) AS rn FROM (
    SELECT l_orderkey * 1000000000 + l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey AS cand,
           CAST(floor(CAST(l_orderkey AS DOUBLE) / 8e0) AS BIGINT) AS img, l_partkey % 5 AS cls, l_suppkey % 4 AS model,
           l_quantity / 64e0 AS score,
           ((l_partkey % 6) * 8 + l_suppkey % 3) / 64e0 AS x1,
           ((CAST(floor(l_extendedprice) AS BIGINT) % 6) * 8 + l_linenumber % 3) / 64e0 AS y1,
           ((l_partkey % 6) * 8 + l_suppkey % 3 + 16 + l_linenumber % 4) / 64e0 AS x2,
           ((CAST(floor(l_extendedprice) AS BIGINT) % 6) * 8 + l_linenumber % 3 + 16 + l_suppkey % 5) / 64e0 AS y2
    FROM lineitem) AS boxes) AS ranked WHERE rn = 1""",
    "ground_truth": """
SELECT o_orderkey AS gt, CAST(floor(CAST(o_orderkey AS DOUBLE) / 8e0) AS BIGINT) AS img, o_custkey % 5 AS cls,
       ((o_custkey % 6) * 8 + o_orderkey % 3) / 64e0 AS x1,
       ((CAST(floor(o_totalprice) AS BIGINT) % 6) * 8 + o_custkey % 3) / 64e0 AS y1,
       ((o_custkey % 6) * 8 + o_orderkey % 3 + 16 + o_orderkey % 4) / 64e0 AS x2,
       ((CAST(floor(o_totalprice) AS BIGINT) % 6) * 8 + o_custkey % 3 + 16 + o_custkey % 5) / 64e0 AS y2
FROM orders""",
    "classes": """
SELECT CAST(cls AS BIGINT) AS cls, class_name, CAST(tier AS BIGINT) AS tier, exempt FROM (VALUES
  (0, 'bus', 1, false), (1, 'delivery van', 1, false), (2, 'car', 2, false), (3, 'person', 2, true), (4, 'cargo bike', 3, false)) AS c(cls, class_name, tier, exempt)""",
    "models": """
SELECT CAST(model AS BIGINT) AS model, priority, floor_score FROM (VALUES
  (0, 2, 0.25e0), (1, 0, 0.125e0), (2, 1, CAST(NULL AS DOUBLE)), (3, 3, 0.5e0)) AS m(model, priority, floor_score)""",
    "confusions": "SELECT CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM (VALUES (0, 1), (2, 4)) AS p(a, b)",
    "aliases": """
SELECT alias, canonical FROM (VALUES ('bus', 'bus'), ('coach', 'bus'), ('delivery van', 'delivery van'), ('van', 'delivery van'),
  ('car', 'car'), ('sedan', 'car'), ('person', 'person'), ('cargo bike', 'cargo bike')) AS a(alias, canonical)""",
    "verdicts": """
SELECT d.cand, d.img,
       CASE d.cand % 11 WHEN 0 THEN 'Other' WHEN 1 THEN 'Coach' WHEN 2 THEN 'zeppelin' WHEN 3 THEN 'NONE' WHEN 4 THEN CAST(NULL AS VARCHAR(20)) WHEN 5 THEN 'Delivery_Van' ELSE c.class_name END AS correct_class,
       CASE WHEN d.cand % 64 = 19 THEN 0.3e0 WHEN d.cand % 64 = 32 THEN 0.5e0 ELSE (d.cand % 64) / 64e0 END AS confidence
FROM detections d JOIN classes c ON d.cls = c.cls WHERE d.cand % 13 <> 0""",
    "refinements": """
SELECT cand, img, CASE cand % 3 WHEN 0 THEN 'accept' WHEN 1 THEN 'review' ELSE 'reject' END AS adjudicate,
       cand % 5 <> 0 AS changed, x1 / 2e0 AS rx1, y1 / 2e0 AS ry1, x2 AS rx2, y2 AS ry2
FROM detections WHERE cand % 7 < 2""",
    "projects": """
SELECT CAST(n_nationkey AS BIGINT) AS project_id, n_name AS name,
       CASE n_nationkey % 8 WHEN 0 THEN 'POPULATING' WHEN 1 THEN 'FILTERING' WHEN 2 THEN 'DEDUP_READY' WHEN 3 THEN 'DEDUPING'
         WHEN 4 THEN 'FILTERING' WHEN 5 THEN 'DETECTING' WHEN 6 THEN 'COMPLETE' ELSE 'FAILED' END AS project_stage,
       CAST(0 AS BIGINT) AS extracted_frames, CAST(0 AS BIGINT) AS filtered_frames, CAST(n_nationkey AS BIGINT) AS total_videos,
       CAST(0 AS BIGINT) AS videos_pending, CAST(0 AS BIGINT) AS videos_downloaded, CAST(0 AS BIGINT) AS videos_extracted, CAST(0 AS BIGINT) AS videos_failed
FROM nation""",
    "videos": """
SELECT o_orderkey AS video_id, o_orderdate AS created_at,
       CASE o_orderkey % 9 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'DOWNLOADING' WHEN 2 THEN 'DOWNLOADED' WHEN 3 THEN 'EXTRACTING' WHEN 4 THEN 'FAILED' ELSE 'EXTRACTED' END AS status,
       CASE o_custkey % 3 WHEN 0 THEN 'SEARCH' WHEN 1 THEN 'MANUAL' ELSE 'FILE' END AS source_type,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 100 END AS frame_count,
       CASE WHEN o_orderkey % 9 > 4 AND o_orderkey % 4 <> 0 THEN 'frames/' || CAST(o_orderkey AS VARCHAR(20)) END AS frames_dir,
       CASE WHEN o_orderkey % 9 > 1 AND o_orderkey % 5 <> 0 THEN 'video/' || CAST(o_orderkey AS VARCHAR(20)) END AS video_path,
       CASE WHEN o_orderkey % 9 IN (1, 3) THEN 'w' || CAST(o_custkey % 4 AS VARCHAR(20)) END AS locked_by,
       CASE WHEN o_orderkey % 9 IN (1, 3) THEN o_orderdate END AS locked_at,
       CASE WHEN o_orderkey % 9 IN (1, 3) AND o_orderkey % 5 <> 1 THEN o_orderdate END AS heartbeat_at,
       o_orderkey % 6 = 5 AS backed_up
FROM orders""",
    "project_videos": """
SELECT id, project_id, video_id, created_at,
       CASE WHEN project_id % 4 = 0 THEN CASE WHEN id % 5 = 0 THEN 'FILTERED_EMPTY' WHEN id % 5 = 1 THEN 'FAILED' ELSE 'FILTERED' END
            WHEN project_id % 8 = 2 THEN CASE WHEN id % 2 = 0 THEN 'FILTERED' ELSE 'FILTERED_EMPTY' END
            ELSE CASE id % 6 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'FILTERING' WHEN 2 THEN 'FILTERED' WHEN 3 THEN 'FILTERED_EMPTY' WHEN 4 THEN 'FAILED' ELSE 'FILTERED' END END AS status,
       CASE WHEN id % 6 = 2 THEN id % 50 END AS passed_frames,
       CASE WHEN id % 6 = 2 THEN 'filtered/' || CAST(id AS VARCHAR(20)) END AS filtered_dir,
       CASE WHEN project_id % 4 <> 0 AND id % 6 = 1 THEN 'f' || CAST(id % 3 AS VARCHAR(20)) END AS locked_by,
       CASE WHEN project_id % 4 <> 0 AND id % 6 = 1 THEN created_at END AS heartbeat_at
FROM (
  SELECT o_orderkey * 2 AS id, o_custkey % 25 AS project_id, o_orderkey AS video_id, o_orderdate AS created_at FROM orders WHERE o_orderkey % 10 <> 9
  UNION ALL SELECT o_orderkey * 2 + 1, (o_custkey + 7) % 25, o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 3 = 0) AS links""",
    "work_queue": """
SELECT CAST(floor(CAST(event_id AS DOUBLE) / 4e0) AS BIGINT) AS image_id,
       CASE event_id % 4 WHEN 0 THEN 'detect' WHEN 1 THEN 'evaluate' WHEN 2 THEN 'refine' ELSE 'finalize' END AS stage,
       CASE WHEN event_id % 5 = 0 THEN 'processing' WHEN event_id % 5 < 3 THEN 'queued' WHEN event_id % 5 = 3 THEN 'done' ELSE 'failed' END AS status,
       CAST(user_id AS DOUBLE) / 4e0 AS score, ts AS claimed_at, event_id % 4 AS attempts
FROM events""",
    "stage_rows": """
SELECT CAST(floor(CAST(event_id AS DOUBLE) / 4e0) AS BIGINT) AS image_id,
       CASE event_id % 4 WHEN 0 THEN 'detect' WHEN 1 THEN 'evaluate' WHEN 2 THEN 'refine' ELSE 'finalize' END AS stage,
       CASE WHEN user_id % 3 = 0 THEN 'h0' ELSE 'h1' END AS config_hash, ts AS created_at
FROM events WHERE event_id % 7 <> 0""",
    "proposals": "SELECT img AS image_id, model, count(*) AS boxes FROM detections GROUP BY img, model",
}


def needs(name: str) -> list[str]:
    """Derived tables that a view is made from, then itself."""
    out: list[str] = []
    for other in VIEWS:
        if other != name and re.search(rf"\b(?:FROM|JOIN)\s+{other}\b", VIEWS[name]):
            out += [x for x in needs(other) if x not in out]
    return [*out, name]


def with_views(sql: str) -> str:
    """``sql`` with the derived tables that it names in front."""
    used: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            used += [x for x in needs(name) if x not in used]
    if not used:
        return sql
    defs = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in used)
    body = sql.strip()
    if m := re.match(r"(?i)WITH\s+(RECURSIVE\s+)?", body):
        return f"WITH {m[1] or ''}{defs},\n{body[m.end():]}"
    return f"WITH {defs}\n{body}"


class Tables:
    """Tables by name: the driver's parquet files and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in VIEWS:
                sql, args = VIEWS[name], {}
                for other in [*BASE, *VIEWS]:
                    if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", sql):
                        sql = re.sub(rf"\b(FROM|JOIN)(\s+){other}\b", rf"\1\2{{{other}}}", sql)
                        args[other] = getattr(self, other)
                self._made[name] = self.spark.sql(sql, **args)
            else:
                raise AttributeError(name)
        return self._made[name]

