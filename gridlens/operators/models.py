"""Slots for models: what goes in and out, which one runs, what is remembered, and stages by name.

A model is a function of batches of rows. It is loaded once in a worker, the first of a list that
loads; requests and responses have fixed columns, which are checked before a run and row by row
after it. Nothing here knows a model: they are registered by those who have one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of requests and responses.
DETECT_REQUEST = "image_path string, prompts array<string>, threshold double"
DETECT_RESPONSE = "boxes array<array<double>>, scores array<double>, labels array<string>"
REFINE_REQUEST = "image_path string, bbox array<double>, points array<array<double>>, threshold double"
REFINE_RESPONSE = "box array<double>, score double"


def checked(df: DataFrame, columns: str) -> DataFrame:
    """``df`` in the order of ``columns``; a column that lacks, is too many or of another type is an error."""
    want = StructType.fromDDL(columns)
    have, need = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in want}
    wrong = [f"{c} is {have.get(c, 'missing')}, not {t}" for c, t in need.items() if have.get(c) != t] + [f"{c} is not known" for c in have if c not in need]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*need)


def detect_problem(boxes: Column, scores: Column, labels: Column) -> Column:
    """Why a detector's response can't be taken, or null."""
    return (
        F.when(boxes.isNull() | scores.isNull() | labels.isNull(), "missing")
        .when((F.size(boxes) != F.size(scores)) | (F.size(boxes) != F.size(labels)), "lengths differ")
        .when(F.exists(boxes, lambda b: b.isNull() | (F.size(b) != 4)), "a box has not four numbers")
        .when(F.exists(boxes, lambda b: F.exists(b, lambda v: v.isNull() | (v < 0) | (v > 1))), "a box is not normalised")
        .when(F.exists(scores, lambda s: s.isNull() | (s < 0) | (s > 1)), "a score is not in 0 to 1")
    )


def refine_problem(box: Column, score: Column) -> Column:
    """Why a refiner's response can't be taken, or null; no box is an answer too."""
    return F.when(box.isNotNull() & (F.size(box) != 4), "a box has not four numbers").when(F.exists(box, lambda v: v.isNull() | (v < 0) | (v > 1)), "a box is not normalised").when(score.isNull() | (score < 0) | (score > 1), "a score is not in 0 to 1")


def first_that_loads(ids: Sequence[str], load: Callable[[str], object]) -> tuple[object, str]:
    """(model, id) of the first of ``ids`` that loads; if none does, an error that names each with its reason."""
    why = []
    for name in ids:
        try:
            return load(name), name
        except Exception as e:  # noqa: BLE001
            why.append(f"{name}: {type(e).__name__}: {e}")
    raise RuntimeError("no model loads: " + "; ".join(why))


@dataclass(frozen=True)
class Detector:
    """A detector by name: its models in order of preference, how one is loaded, and its function (model, batch) -> frame."""

    ids: tuple[str, ...]
    load: Callable[[str], object]
    run: Callable[[object, pd.DataFrame], pd.DataFrame]


DETECTORS: dict[str, Detector] = {}


def register_detector(name: str, detector: Detector) -> None:
    DETECTORS[name] = detector


def get_detector(name: str, model_id: str | None = None) -> Detector:
    """The detector of a name, with one model of one's own or its usual list."""
    if name not in DETECTORS:
        raise KeyError(f"no detector is called {name}; there are {', '.join(sorted(DETECTORS)) or 'none'}")
    found = DETECTORS[name]
    return found if model_id is None else Detector((model_id,), found.load, found.run)


def through(df: DataFrame, detector: Detector, response: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` of df and the columns of ``response`` and model (the id that ran); loaded once in a worker."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = name = None
        for batch in batches:
            if name is None:
                model, name = first_that_loads(detector.ids, detector.load)
            out = detector.run(model, batch)
            yield pd.concat([batch[list(keep)].reset_index(drop=True), out.reset_index(drop=True)], axis=1).assign(model=name)

    return df.mapInPandas(run, f"{kept}, {response}, model string")


def detect(images: DataFrame, detector: Detector, prompts: Sequence[str], threshold: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(boxes, refused): a row for each box (image_path, label, score, x1..y2, model), and responses that can't be taken with their problem.

    images has image_path. A label that is none of the prompts, in any case, is refused with its response.
    """
    request = images.select("image_path", F.array(*[F.lit(p) for p in prompts]).cast("array<string>").alias("prompts"), F.lit(threshold).cast("double").alias("threshold"))
    answers = through(checked(request, DETECT_REQUEST), detector, DETECT_RESPONSE, ["image_path"])
    known = F.array(*[F.lit(p.strip().lower()) for p in prompts]).cast("array<string>")
    odd = F.exists("labels", lambda x: ~F.coalesce(F.array_contains(known, F.lower(F.trim(x))), F.lit(False)))
    answers = answers.withColumn("problem", F.coalesce(detect_problem(F.col("boxes"), F.col("scores"), F.col("labels")), F.when(odd, "a label was not asked for")))
    each = answers.where("problem is null").select("image_path", "model", F.explode(F.arrays_zip("boxes", "scores", "labels")).alias("d"))
    rows = each.select("image_path", F.lower(F.trim("d.labels")).alias("label"), F.col("d.scores").alias("score"), *[F.get("d.boxes", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))], "model")
    return rows, answers.where("problem is not null").select("image_path", "model", "problem")


def embedded(wanted: DataFrame, key: str, cache: str, detector: Detector) -> DataFrame:
    """(key, embedding) of every row of ``wanted``: from the cache, a Parquet folder, or computed and added to it.

    The keys that lack are computed once each, in the workers; the cache only grows, and a run that
    is lost leaves it as it was.
    """
    spark = wanted.sparkSession
    columns = f"`{key}` {dict(wanted.dtypes)[key]}, embedding array<float>"
    try:
        held = spark.read.schema(columns).parquet(cache)
        held.schema  # noqa: B018
        known = held.select(key)
        missing = wanted.join(known, key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        missing = wanted
    through(missing.dropDuplicates([key]), detector, "embedding array<float>", [key]).select(key, "embedding").write.mode("append").parquet(cache)
    return wanted.select(key).join(spark.read.schema(columns).parquet(cache), key)


STAGES: dict[str, Callable[[DataFrame], DataFrame]] = {}


def stage(name: str) -> Callable:
    """Registers a function of a DataFrame as a stage."""

    def mark(run: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        if name in STAGES:
            raise ValueError(f"two stages are called {name}")
        STAGES[name] = run
        return run

    return mark


def staged(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` through the stages of these names, in order."""
    for name in names:
        if name not in STAGES:
            raise KeyError(f"no stage is called {name}")
        df = STAGES[name](df)
    return df
