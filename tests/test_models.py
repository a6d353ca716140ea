"""Slots for models, envelopes, stages by name."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlens.operators import models as MD
from gridlens.operators import scratch
from gridlens.streaming import queue as Q


def test_first_that_loads():
    def load(name):
        if name != "c":
            raise OSError(f"no {name}")
        return 7

    assert MD.first_that_loads(["a", "b", "c", "d"], load) == (7, "c")
    with pytest.raises(RuntimeError, match="a: OSError: no a; b"):
        MD.first_that_loads(["a", "b"], load)


def test_requests_are_checked(spark):
    df = spark.createDataFrame([("p", ["x"], 0.5)], "image_path string, prompts array<string>, threshold double")
    assert MD.checked(df, MD.DETECT_REQUEST).count() == 1
    for bad in (df.drop("prompts"), df.withColumn("more", F.lit(1)), df.withColumn("threshold", F.lit("x"))):
        with pytest.raises(ValueError, match="prompts|more|threshold"):
            MD.checked(bad, MD.DETECT_REQUEST)


@pytest.mark.parametrize(
    ("response", "want"),
    [
        (([[0.0, 0.0, 1.0, 1.0]], [0.5], ["car"]), None), (([], [], []), None), ((None, [], []), "missing"), (([[0.0, 0.0, 1.0, 1.0]], [], ["car"]), "lengths differ"),
        (([[0.0, 0.0, 1.0]], [0.5], ["car"]), "a box has not four numbers"), (([[0.0, 0.0, 1.5, 1.0]], [0.5], ["car"]), "a box is not normalised"), (([[0.0, 0.0, 1.0, 1.0]], [1.5], ["car"]), "a score is not in 0 to 1"),
    ],
)
def test_responses_are_checked(spark, response, want):
    df = spark.createDataFrame([response], MD.DETECT_RESPONSE)
    assert df.select(MD.detect_problem(F.col("boxes"), F.col("scores"), F.col("labels"))).first()[0] == want


@pytest.mark.parametrize(("response", "want"), [(([0.0, 0.0, 1.0, 1.0], 0.5), None), ((None, 0.0), None), (([0.0], 0.5), "a box has not four numbers"), (([0.0, 0.0, 1.0, -1.0], 0.5), "a box is not normalised"), ((None, None), "a score is not in 0 to 1")])
def test_refinements_are_checked(spark, response, want):
    df = spark.createDataFrame([response], MD.REFINE_RESPONSE)
    assert df.select(MD.refine_problem(F.col("box"), F.col("score"))).first()[0] == want


def test_detectors_by_name(spark):
    run = lambda model, batch: pd.DataFrame({"boxes": [[[0.0, 0.0, 1.0, 1.0]] for _ in range(len(batch))], "scores": [[0.5] for _ in range(len(batch))], "labels": [[x[0]] for x in batch["prompts"]]})
    MD.register_detector("mine", MD.Detector(("m1", "m2"), lambda name: name, run))
    try:
        images = spark.createDataFrame([("a",), ("b",)], "image_path string")
        rows, refused = MD.detect(images, MD.get_detector("mine"), ["Car"])
        assert {(r.image_path, r.label, r.model) for r in rows.collect()} == {("a", "car", "m1"), ("b", "car", "m1")} and refused.count() == 0
        assert MD.get_detector("mine", "own").ids == ("own",)
        strange = MD.Detector(("x",), lambda name: name, lambda model, batch: run(model, batch).assign(labels=[["dog"] for _ in range(len(batch))]))
        rows, refused = MD.detect(images, strange, ["Car"])
        assert rows.count() == 0 and {r.problem for r in refused.collect()} == {"a label was not asked for"}
    finally:
        MD.DETECTORS.pop("mine")
    with pytest.raises(KeyError, match="no detector"):
        MD.get_detector("mine")


def test_cache_is_filled_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def run(model, batch):
        for k in batch["k"]:
            (calls / f"{k}-{len(list(calls.iterdir()))}").touch()
        return pd.DataFrame({"embedding": [np.float32([k, model]) for k in batch["k"]]})

    d = MD.Detector(("2",), int, run)
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    for rows, n in ((wanted, 2), (wanted.union(spark.createDataFrame([(3,)], "k long")), 3), (wanted, 3)):
        got = MD.embedded(rows, "k", f"{tmp_path}/cache", d).collect()
        assert sorted((r.k, *r.embedding) for r in got) == sorted((r.k, r.k, 2.0) for r in rows.collect())
        assert len(list(calls.iterdir())) == n


def test_stages_by_name(spark):
    @MD.stage("double")
    def _(df):
        return df.withColumn("id", F.col("id") * 2)

    try:
        assert [r.id for r in MD.staged(spark.range(3), ["double", "double"]).collect()] == [0, 4, 8]
        with pytest.raises(ValueError, match="two stages"):
            MD.stage("double")(lambda df: df)
    finally:
        MD.STAGES.pop("double")
    with pytest.raises(KeyError, match="no stage"):
        MD.staged(spark.range(1), ["double"])


def test_envelopes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (1, "a")], "k long, v string")
    sent = Q.enveloped(rows, "detect", "j1")
    assert sent.select("message_id").distinct().count() == 2  # a repeated message has the same id
    assert Q.enveloped(rows, "refine", "j1").join(sent, "message_id").count() == 0
    assert sorted((r.k, r.v or "") for r in Q.opened(sent, "k long, v string").collect()) == [(1, "a"), (1, "a"), (2, "")]
    dead = Q.dead_letters(sent, F.when(F.get_json_object("data", "$.v").isNull(), "no v")).collect()
    assert [(r.stage, r.job_id) for r in dead] == [("dead_letter", "j1")] and '"origin":"detect"' in dead[0].data


def test_settled_tables_go(spark, tmp_path):
    paths = []
    df = scratch.settled(spark.range(3), paths)
    assert df.count() == 3 and len(paths) == 1
    scratch.forget(spark, paths)
    from pathlib import Path

    assert not Path(paths[0].removeprefix("file://")).exists()
