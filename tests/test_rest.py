"""Similarity, state, sources on disk, streams, scalars, and life without the text operators."""

import json
import os
import random
import shutil
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gridlens.functions import scalars as C
from gridlens.operators import similarity as S
from gridlens.operators import state as ST
from gridlens.sources import datasets as DS
from gridlens.sources import labels as L
from gridlens.streaming import queue as Q

ROOT = Path(__file__).resolve().parent.parent


def vectors(spark, seed, n, d=4):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    return x, spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")


def slow_knn(x, ids, k, t):
    u = x.astype(np.float64)
    u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-8)
    s = u @ u.T
    keep, gone = [], set()
    for i in range(len(x)):
        if i in gone:
            continue
        keep.append(ids[i])
        order = sorted(range(len(x)), key=lambda j: (j != i, -s[i, j], j))[:k]
        gone |= {j for j in order if j != i and s[i, j] >= t and j > i}
    return set(keep)


@pytest.mark.parametrize(("k", "block"), [(3, 7), (5, 1000), (100, 13)])
def test_knn_against_a_loop(spark, k, block):
    x, df = vectors(spark, k, 60)
    edges = S.neighbours(df, k, 0.7, block=block)
    got = {r.id for r in S.greedy_keep(df.select(F.col("vec_id").alias("id")), edges).collect()}
    assert got == slow_knn(x, list(range(60)), k, 0.7)


def test_two_phases(spark):
    x, df = vectors(spark, 9, 60)
    first = set()
    for g in range(3):
        ids = [i for i in range(60) if i % 3 == g]
        first |= slow_knn(x[ids], ids, 5, 0.6)
    left = sorted(first)
    got = S.knn_dedup(df, 5, 0.6, "label")
    assert {r.vec_id for r in got.collect()} == first
    assert {r.vec_id for r in S.knn_dedup(df.join(got, "vec_id", "left_semi"), 5, 0.6).collect()} == slow_knn(x[left], left, 5, 0.6)


def test_prompt_kinds_may_be_absent(spark):
    scores = spark.createDataFrame([(1, "p", "positive", 0, 0.5), (2, "p", "positive", 0, 0.4)], "vec_id long, prompt string, kind string, pos int, score double")
    assert [r.vec_id for r in S.prompt_filter(scores, 0.4, 0, 9, 0, 9).collect()] == [1]  # above, not at


def test_transitions_by_hand(spark):
    projects = spark.createDataFrame([(1, "FILTERING"), (2, "FILTERING"), (3, "FILTERING"), (4, "POPULATING"), (5, "COMPLETE"), (6, "FAILED")], "project_id long, project_stage string")
    links = spark.createDataFrame([(2, 1, "FILTERED"), (2, 2, "FAILED"), (3, 1, "PENDING"), (4, 1, "FILTERING"), (5, 3, "PENDING"), (6, 3, "PENDING")], "project_id long, video_id long, status string")
    got = {r.project_id: r.project_stage for r in ST.transitions(projects, links).collect()}
    assert got == {1: "FILTERING", 2: "DEDUP_READY", 3: "FILTERING", 4: "FILTERING", 5: "POPULATING", 6: "FAILED"}


def test_stale_locks_by_hand(spark):
    rows = [(1, "DOWNLOADING", "w", "2024-01-01 00:00:00"), (2, "EXTRACTING", "w", "2024-01-01 00:09:00"), (3, "EXTRACTING", "w", None), (4, "EXTRACTED", "w", "2024-01-01 00:00:00"), (5, "EXTRACTING", None, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "video_id long, status string, locked_by string, heartbeat_at string").withColumn("heartbeat_at", F.col("heartbeat_at").cast("timestamp"))
    got = {r.video_id: (r.status, r.locked_by) for r in ST.recover(df, F.expr("timestamp'2024-01-01 00:10:00'"), 2, ST.VIDEO_ROLLBACK).collect()}
    assert got == {1: ("PENDING", None), 2: ("EXTRACTING", "w"), 3: ("EXTRACTING", "w"), 4: ("EXTRACTED", "w"), 5: ("EXTRACTING", None)}


def test_claim_and_release(spark):
    rows = spark.createDataFrame([(k, "PENDING", None, None, None) for k in range(3)], "video_id long, status string, locked_by string, locked_at timestamp, heartbeat_at timestamp")
    now = F.expr("timestamp'2024-01-01'")
    first = ST.next_of(rows, [F.col("video_id")])
    held = ST.claim(rows, "video_id", first, "status", "DOWNLOADING", "w1", now)
    assert [(r.status, r.locked_by) for r in held.orderBy("video_id").collect()] == [("DOWNLOADING", "w1"), ("PENDING", None), ("PENDING", None)]
    assert ST.release(held, "video_id", 0, "w2", "DOWNLOADED").where("status = 'DOWNLOADED'").count() == 0
    done = ST.release(held, "video_id", 0, "w1", "DOWNLOADED").orderBy("video_id").first()
    assert (done.status, done.locked_by, done.heartbeat_at) == ("DOWNLOADED", None, None)


def test_dataset_round_trips_on_disk(spark, tmp_path):
    images = [("train", f"im{k}", f"im{k}.jpg", 640, 480) for k in range(3)] + [("val", "im9", "im9.jpg", 320, 320)]
    r = random.Random(1)
    rows = [(s, r.randint(0, 2), float(r.randint(0, 99)), float(r.randint(0, 99)), float(r.randint(1, 99)), float(r.randint(1, 99))) for s in ("im0", "im0", "im1", "im9")]
    d = DS.Dataset(spark.createDataFrame(images, "split string, stem string, file_name string, width int, height int"), spark.createDataFrame(rows, "stem string, class_id int, x double, y double, w double, h double"), ["a", "b", "c"])
    sizes = d.images.select("stem", "file_name", "width", "height")
    for layout, write in DS.WRITERS.items():
        at = f"{tmp_path}/{layout}"
        L.save_files(write(d), at)
        paths = [str(p.relative_to(at)) for p in Path(at).rglob("*") if p.is_file()]
        assert DS.detect_format(paths) == layout
        files = L.text_files(spark, at)
        hidden = [p for p in paths if p.rpartition("/")[2].startswith("_")]
        if hidden:
            files = files.unionByName(L.named_files(spark, at, hidden))
        back = DS.read(files, layout, sizes)
        assert back.categories == ["a", "b", "c"]
        assert sorted((b.stem, b.class_id, round(b.x), round(b.h)) for b in back.boxes.collect()) == sorted((s, c, round(x), round(h)) for s, c, x, _, _, h in rows)
        assert {(i.split, i.stem) for i in back.images.collect()} == {(i[0], i[1]) for i in images}


def test_large_splits_are_sharded(spark, tmp_path, monkeypatch):
    """Several texts of a split, ids that go on through them, read back as one; no row holds a split."""
    monkeypatch.setattr(L, "SHARD", 4)
    monkeypatch.setattr(L, "LIST", 5)
    images = [("train", f"im{k}", f"im{k}.jpg", 640, 480) for k in range(30)] + [("val", "v", "v.jpg", 320, 320)]
    rows = [(f"im{k % 30}", k % 3, float(k), 1.0, 2.0, 3.0) for k in range(70)]
    d = DS.Dataset(spark.createDataFrame(images, "split string, stem string, file_name string, width int, height int"), spark.createDataFrame(rows, "stem string, class_id int, x double, y double, w double, h double"), ["a", "b", "c"])
    sizes = d.images.select("stem", "file_name", "width", "height")
    coco = L.to_coco(d.images, d.boxes, d.categories, F.concat("split", F.lit(".json")), 4)
    texts = {r.path: json.loads(r.value) for r in coco.collect()}
    assert len(texts) > 5 and "val.json" in texts and all(len(t["images"]) < 20 for t in texts.values())
    train = [t for p, t in texts.items() if p.startswith("train-")]
    assert sorted(i["id"] for t in train for i in t["images"]) == list(range(1, 31)) and sorted(a["id"] for t in train for a in t["annotations"]) == list(range(1, 71))
    assert all({a["image_id"] for a in t["annotations"]} <= {i["id"] for i in t["images"]} for t in train)
    lists = DS.write_darknet(d).where("path like '%.txt' and path not like 'labels%'")
    assert {len(r.value.splitlines()) for r in lists.collect()} < set(range(1, 20)) and lists.count() > 5
    back = DS.read(DS.write_darknet(d), "darknet", sizes)
    assert {(i.split, i.stem) for i in back.images.collect()} == {i[:2] for i in images}
    assert DS.detect_format(["train-00001.txt"]) == "darknet" and DS.detect_format(["train/_annotations-00000.coco.json"]) == "roboflow"


def test_layouts_of_ones_own(spark):
    d = DS.Dataset(spark.createDataFrame([("train", "a", "a.jpg", 1, 1)], "split string, stem string, file_name string, width int, height int"), spark.createDataFrame([], "stem string, class_id int, x double, y double, w double, h double"), [])
    DS.register("mine", lambda files, sizes, categories: d, lambda d: d.images.select(F.col("stem").alias("path"), F.lit("").alias("value")))
    try:
        files = spark.createDataFrame([("x", "")], "path string, value string")
        assert [r.path for r in DS.convert(files, "mine", "mine").collect()] == ["a"]
    finally:
        DS.READERS.pop("mine"), DS.WRITERS.pop("mine")


def test_neighbours_send_only_what_counts(spark, monkeypatch):
    x, df = vectors(spark, 2, 50)
    assert S.neighbours(df, 1 << 30, 0.95).count() < 200 and S.neighbours(df, 1, -2.0).count() == 0


def test_vectors_are_not_copied_for_their_partners(spark):
    """What is shuffled are pairs at the threshold, however many blocks there are; equal vectors tie by id."""
    x, df = vectors(spark, 3, 60)
    df = df.union(df.select(F.col("vec_id") + 60, "embedding", "label"))
    edges = S.neighbours(df, 4, 0.7, block=9)
    plan = edges._jdf.queryExecution().analyzed().toString().lower()
    assert "embedding" not in plan and "explode" not in plan
    got = {r.id for r in S.greedy_keep(df.select(F.col("vec_id").alias("id")), edges).collect()}
    assert got == slow_knn(np.concatenate((x, x)), list(range(120)), 4, 0.7)


@pytest.mark.parametrize(("block", "t"), [(7, 0.7), (7, 0.999), (1000, 0.7), (7, -2.0)])
def test_all_neighbours_without_pairs(spark, block, t, monkeypatch):
    """Rows that all near ones go from are found block by block, without a pair in a table, within groups, too."""
    x, df = vectors(spark, 4, 60)
    assert {r.vec_id for r in S.greedy_all(df, t, block=block).collect()} == slow_knn(x, list(range(60)), 60, t)
    by = set().union(*[slow_knn(x[ids], ids, 60, t) for g in range(3) if (ids := [i for i in range(60) if i % 3 == g])])
    assert {r.vec_id for r in S.greedy_all(df, t, "label", block).collect()} == by
    monkeypatch.setattr(S, "neighbours", None)
    assert S.knn_dedup(df, S.ALL, t).count() == len(slow_knn(x, list(range(60)), 60, t)) and S.greedy_all(df.limit(0), t).count() == 0


def test_label_lines(spark):
    text = "0 0.1 0.2 0.3 0.4\n1 0.5 0.5 0.1\n\n2 0.1 0.1 0.2 0.2 0.7 tail x\n3 a b c d\n"
    files = spark.createDataFrame([("f", text), ("empty", ""), ("six", "1 1 1 1 1 0.5")], "path string, value string")
    got = sorted((r.path, r.class_id, r.conf) for r in L.yolo(files, 0.9, keep_empty=False).collect())
    assert got == [("f", 0, 0.9), ("f", 2, 0.7), ("f", 3, 0.9), ("six", 1, 0.5)]
    assert {(r.path, r.class_id) for r in L.yolo(files).collect()} >= {("empty", None)}
    assert {r.path for r in L.yolo_all_or_nothing(files).collect()} == {"six"}
    assert {(r.path, r.class_id) for r in L.yolo(files, 0.9, keep_empty=False, strict=True).collect()} == {("f", 0), ("f", 3), ("six", 1)}


def test_layout_order_and_names():
    assert DS.detect_format(["annotations/instances_x.json", "train/_annotations.coco.json"]) == "coco"
    assert DS.detect_format(["data.yaml", "images/val/a.jpg"]) == "yolo_b" and DS.detect_format(["data.yaml"]) == "yolo_a"
    with pytest.raises(ValueError, match="layout"):
        DS.detect_format(["readme.md"])
    assert DS.class_names("names: [a, b]") == ["a", "b"] and DS.class_names("names: {10: z, 2: y}") == ["y", "z"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://www.youtube.com/watch?v=abcdefghijk&t=1", "abcdefghijk"), ("https://youtu.be/abcdefghijk?x=1", "abcdefghijk"), ("https://www.youtube.com/embed/abcdefghijk", "abcdefghijk"),
        ("https://www.youtube.com/shorts/abc", "abc"), ("https://other.org/x/abcdefghijk/", "abcdefghijk"), ("https://other.org/short", None), ("", None),
    ],
)
def test_video_ids(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(C.video_id(F.col("u"))).first()[0] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"a": 1}', "1"), ('<think>{"a": 0}</think> {"a": 2}', "2"), ('```json\n{"a": 3}\n```', "3"), ('{"a": 4,}', "4"), ('Sure {"b": {"a": 9}, "a": 5} and {x}', "5"), ("nothing", None), (None, None),
    ],
)
def test_model_json(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(F.get_json_object(C.balanced_json(F.col("t")), "$.a")).first()[0] == want


def test_area_bucket_bounds(spark):
    from gridlens.operators.stats import area_buckets

    rows = [("f", 0, 1.0, a) for a in (0.0, 0.01, 0.09, 1.01)]
    r = area_buckets(spark.createDataFrame(rows, "file string, class_id int, w double, h double")).first()
    assert (r.small, r.medium, r.large) == (1, 1, 1)


# streams


def test_barrier_over_batches(spark, tmp_path):
    rows = [(1, 0, 5), (1, 1, 5), (2, 0, 1), (2, 0, 1), (1, 2, 2), (2, 1, 1), (3, 2, 1)]
    schema = "image_id long, model long, boxes long"
    for k in range(0, len(rows), 2):
        Q.submit(spark.createDataFrame(rows[k : k + 2], schema).coalesce(1), f"{tmp_path}/in")
        time.sleep(0.05)
    out = Q.run_now(Q.barrier(Q.messages(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), 3), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert [tuple(r) for r in out.collect()] == [(1, 3, 12, False)]
    # what was missing comes in a later run: state and place are kept
    Q.submit(spark.createDataFrame([(2, 2, 4), (1, 2, 9)], schema).coalesce(1), f"{tmp_path}/in")
    out = Q.run_now(Q.barrier(Q.messages(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), 3), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 3, 12, False), (2, 3, 6, False)]


class Store:
    """Stands for a state store: counts what is asked of it."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema):
        return self

    def getMapState(self, *a):
        raise AssertionError("one call to the store an entry")

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.update(None)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_state_is_read_and_written_once_a_batch():
    """However many messages of a key there are; each call to the store is a round trip."""
    at, b = Store(), Q.Barrier(100)
    b.init(at)
    assert list(b.handleInputRows((7,), iter([Row(model=m, boxes=2) for m in range(99)]), None)) == [] and at.calls == 2
    assert [tuple(r) for r in b.handleInputRows((7,), iter([Row(model=m, boxes=2) for m in range(90, 100)]), None)] == [(7, 100, 200, False)] and at.calls == 4
    assert list(b.handleInputRows((7,), iter([Row(model=0, boxes=2)]), None)) == [] and at.calls == 5
    at, s = Store(), Q.Stale(10, False)
    s.init(at)
    claims = [Row(kind="claim", worker=f"w{k}", ms=k) for k in (5, 50, 20)]
    assert list(s.handleInputRows((7,), iter(claims), None)) == [] and at.calls == 2 and at.timers == [60] and at.value == ("w50", 60)
    assert list(s.handleInputRows((7,), iter([Row(kind="release", worker="w50", ms=51)]), None)) == [] and at.calls == 4 and at.timers == [] and at.value is None


def test_retries_end(spark, tmp_path):
    schema = "image_id long, failed boolean"
    for _ in range(3):
        Q.submit(spark.createDataFrame([(1, True), (2, False)], schema).coalesce(1), f"{tmp_path}/in")
        time.sleep(0.05)
    seen = []
    rows = Q.retries(Q.messages(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), 3)
    q = rows.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).foreachBatch(lambda b, _: seen.extend(tuple(r) for r in b.collect())).start()
    q.awaitTermination()
    assert seen == [(1, 1, "again"), (1, 2, "again"), (1, 3, "dead")]


def test_silent_claims_come_back(spark, tmp_path):
    schema = spark.createDataFrame([], "image_id long, kind string, worker string").schema
    Q.submit(spark.createDataFrame([(1, "claim", "w1"), (2, "claim", "w2"), (2, "release", "w2")], schema).coalesce(1), f"{tmp_path}/in")
    seen = []
    rows = Q.stale(Q.messages(spark, f"{tmp_path}/in", schema), 500)
    q = rows.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="300 milliseconds").foreachBatch(lambda b, _: seen.extend(tuple(r) for r in b.collect())).start()
    end = time.time() + 60
    while not seen and time.time() < end:
        time.sleep(0.3)
    q.stop()
    assert seen == [(1, "w1")]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = "job_id string, v int"
    Q.submit(spark.createDataFrame([("a", 1), ("b", 2), ("a", None)], schema).coalesce(1), f"{tmp_path}/in")
    rows = Q.of_job(Q.messages(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), "a")
    for ck in ("ck1", "ck2"):  # a lost checkpoint makes the batch run again
        Q.forward(rows, f"{tmp_path}/{ck}", f"{tmp_path}/out", f"{tmp_path}/dead", F.col("v").isNotNull()).awaitTermination()
    read = lambda p: spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{p}").count()
    assert (read("out"), read("dead")) == (1, 1)


def test_backoff():
    calls = []

    def effect(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("busy")
        return x

    assert Q.with_backoff(effect, 3, 0.0)(7) == (7, None) and len(calls) == 3
    assert Q.with_backoff(lambda x: 1 / x, 1, 0.0)(0)[1].startswith("ZeroDivisionError")


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_without_the_text_operators(tmp_path, gone):
    """With those folders gone, and the pipeline too or not, the entry point works, and nothing else names them."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *gone, "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), len(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) > 240 and out[1] == "False"
