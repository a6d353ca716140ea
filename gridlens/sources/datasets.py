"""Dataset layouts: COCO, Roboflow, YOLO split-first and modality-first, Darknet; each to each.

A dataset in between is images (split, stem, file_name, width, height), boxes (stem, class_id,
x, y, w, h in pixels) and the list of its categories. COCO texts and path lists of large splits are
written in shards (``instances_train2017-00003.json``, ``train-00003.txt``), which are read alike, so
that no row holds a split.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.scalars import stem
from gridlens.sources import labels as L

# Names of splits and of the files that mark a layout.
SPLITS = ("train", "val", "test")
ALIASES = {"valid": "val"}
COCO_SPLITS = {"train": "train2017", "val": "val2017", "test": "test2017"}


@dataclass
class Dataset:
    images: DataFrame
    boxes: DataFrame
    categories: list[str]


def detect_format(paths: Iterable[str]) -> str:
    """Layout of a folder by the paths in it, tested in a fixed order."""
    names = list(paths)
    has = lambda pattern: any(re.search(pattern, f"/{n}") for n in names)
    split = "(train|valid|val|test)"
    if has(r"^/annotations/instances_[^/]*\.json$"):
        return "coco"
    if has(rf"^/{split}/_annotations(-\d+)?\.coco\.json$"):
        return "roboflow"
    if has(r"^/data\.yaml$"):
        if has(rf"^/{split}/(images|labels)/"):
            return "yolo_a"
        return "yolo_b" if has(rf"^/(images|labels)/{split}/") else "yolo_a"
    if has(r"^/obj\.data$") or has(r"^/train(-\d+)?\.txt$"):
        return "darknet"
    raise ValueError("no known layout")


def class_names(text: str) -> list[str]:
    """Names of a data.yaml: a list, or a dictionary in the order of its whole-number keys."""
    names = (yaml.safe_load(text) or {}).get("names", [])
    return [str(names[k]) for k in sorted(names, key=int)] if isinstance(names, dict) else [str(n) for n in names]


def data_yaml(categories: list[str], splits: Iterable[str], place: Callable[[str], str]) -> str:
    """The text of data.yaml, its keys the splits' names."""
    return yaml.safe_dump({s: place(s) for s in splits} | {"nc": len(categories), "names": list(categories)}, sort_keys=False)


def _pixels(rows: DataFrame, images: DataFrame) -> DataFrame:
    b = rows.where("class_id is not null").join(images.select("stem", "width", "height"), "stem")
    return b.select(
        "stem", "class_id", ((F.col("cx") - F.col("w") / 2) * F.col("width")).alias("x"), ((F.col("cy") - F.col("h") / 2) * F.col("height")).alias("y"),
        (F.col("w") * F.col("width")).alias("w"), (F.col("h") * F.col("height")).alias("h"),
    )


def _normal(d: Dataset) -> DataFrame:
    b = d.boxes.join(d.images.select("stem", "width", "height"), "stem")
    return b.select(
        "stem", "class_id", ((F.col("x") + F.col("w") / 2) / F.col("width")).alias("cx"), ((F.col("y") + F.col("h") / 2) / F.col("height")).alias("cy"),
        (F.col("w") / F.col("width")).alias("w"), (F.col("h") / F.col("height")).alias("h"),
    )


def read_yolo(files: DataFrame, sizes: DataFrame, categories: list[str], layout: str) -> Dataset:
    """Label files below a root (paths from it) with sizes (stem, file_name, width, height) of the images."""
    pattern = r"^(?:.*/)?(train|valid|val|test)/labels/" if layout == "yolo_a" else r"^(?:.*/)?labels/(train|valid|val|test)/"
    f = files.withColumn("split", F.regexp_extract("path", pattern, 1)).where("split <> ''").withColumn("stem", stem(F.col("path")))
    f = f.withColumn("split", F.when(F.col("split") == "valid", "val").otherwise(F.col("split")))
    images = f.select("split", "stem").join(sizes, "stem").select("split", "stem", "file_name", "width", "height")
    rows = L.yolo(f.select("path", "value")).withColumn("stem", stem(F.col("path")))
    return Dataset(images, _pixels(rows, images), categories)


def read_darknet(files: DataFrame, sizes: DataFrame, categories: list[str] | None = None) -> Dataset:
    """Path lists name the images of a split; without obj.names classes are class_0 to the largest."""
    lists = files.where(F.col("path").rlike(r"^(train|val|valid|test)(-\d+)?\.txt$"))
    named = lists.select(F.regexp_extract("path", r"^(\w+?)(-\d+)?\.txt$", 1).alias("split"), F.explode(F.split("value", "\n")).alias("line")).where("trim(line) <> ''")
    images = named.select("split", stem(F.trim("line")).alias("stem")).join(sizes, "stem").select("split", "stem", "file_name", "width", "height")
    label_files = files.where(F.col("path").rlike(r"^labels/"))
    rows = L.yolo(label_files).withColumn("stem", stem(F.col("path")))
    if categories is None:
        top = rows.agg(F.max("class_id")).first()[0]
        categories = [] if top is None else [f"class_{k}" for k in range(top + 1)]
    return Dataset(images, _pixels(rows, images), categories)


def read_coco(files: DataFrame, layout: str = "coco") -> Dataset:
    pattern = r"^(?:.*/)?annotations/instances_(train|val|test)(?:2017)?(?:-\d+)?\.json$" if layout == "coco" else r"^(?:.*/)?(train|valid|val|test)/_annotations(?:-\d+)?\.coco\.json$"
    f = files.withColumn("split", F.regexp_extract("path", pattern, 1)).where("split <> ''")
    f = f.withColumn("split", F.when(F.col("split") == "valid", "val").otherwise(F.col("split")))
    j = f.select("split", F.from_json("value", L.COCO).alias("c"))
    images = j.select("split", F.explode("c.images").alias("i")).select("split", stem(F.col("i.file_name")).alias("stem"), "i.file_name", "i.width", "i.height")
    rows = L.coco(f.select("path", "value"))
    names = [r[0] for r in j.select(F.explode("c.categories").alias("k")).select("k.name", "k.id").groupBy("name").agg(F.min("id").alias("id")).orderBy("id").collect()]  # the classes of a dataset
    return Dataset(images, rows.select("stem", "class_id", *"xywh"), names)


def write_yolo(d: Dataset, layout: str) -> DataFrame:
    place = (lambda s: f"{s}/images") if layout == "yolo_a" else (lambda s: f"images/{s}")
    at = F.concat("split", F.lit("/labels/"), "stem", F.lit(".txt")) if layout == "yolo_a" else F.concat(F.lit("labels/"), "split", F.lit("/"), "stem", F.lit(".txt"))
    rows = d.images.select("stem", at.alias("path")).join(_normal(d), "stem", "left")
    files = L.to_label_files(rows, order=("class_id", *L.CENTRE))
    splits = [s for s in SPLITS if not d.images.where(F.col("split") == s).isEmpty()]
    extra = d.images.sparkSession.createDataFrame([("data.yaml", data_yaml(d.categories, splits, place))], "path string, value string")
    return files.unionByName(extra)


def write_darknet(d: Dataset) -> DataFrame:
    spark = d.images.sparkSession
    rows = d.images.select("stem", F.concat(F.lit("labels/"), "stem", F.lit(".txt")).alias("path")).join(_normal(d), "stem", "left")
    lists = L.sharded(d.images, "split", F.col("stem"), L.LIST).groupBy("split", "mark").agg(F.sort_array(F.collect_list(F.concat(F.lit("images/"), "file_name"))).alias("l"))
    lists = lists.select(F.concat("split", "mark", F.lit(".txt")).alias("path"), F.concat(F.array_join("l", "\n"), F.lit("\n")).alias("value"))
    names = spark.createDataFrame([("obj.names", "\n".join(d.categories) + "\n"), ("obj.data", f"classes = {len(d.categories)}\nnames = obj.names\n")], "path string, value string")
    return L.to_label_files(rows, order=("class_id", *L.CENTRE)).unionByName(lists).unionByName(names)


def write_coco(d: Dataset, layout: str = "coco") -> DataFrame:
    if layout == "coco":
        at = F.concat(F.lit("annotations/instances_"), F.create_map(*[F.lit(x) for kv in COCO_SPLITS.items() for x in kv])[F.col("split")], F.lit(".json"))
    else:
        at = F.concat(F.when(F.col("split") == "val", "valid").otherwise(F.col("split")), F.lit("/_annotations.coco.json"))
    return L.to_coco(d.images, d.boxes, d.categories, at)


#: Layouts by name; ``register`` adds others.
WRITERS: dict[str, Callable[[Dataset], DataFrame]] = {
    "coco": write_coco,
    "roboflow": lambda d: write_coco(d, "roboflow"),
    "yolo_a": lambda d: write_yolo(d, "yolo_a"),
    "yolo_b": lambda d: write_yolo(d, "yolo_b"),
    "darknet": write_darknet,
}


READERS: dict[str, Callable] = {}


def register(layout: str, reader: Callable[[DataFrame, DataFrame | None, list[str] | None], Dataset] | None = None, writer: Callable[[Dataset], DataFrame] | None = None) -> None:
    """A layout of one's own: a reader of (files, sizes, categories), a writer of a Dataset, or both; one's own goes before those here."""
    if reader is not None:
        READERS[layout] = reader
    if writer is not None:
        WRITERS[layout] = writer


def read(files: DataFrame, layout: str, sizes: DataFrame | None = None, categories: list[str] | None = None) -> Dataset:
    """A dataset from its files; label layouts need the images' sizes, their categories come from data.yaml or obj.names."""
    if layout in READERS:
        return READERS[layout](files, sizes, categories)
    if layout in ("coco", "roboflow"):
        return read_coco(files, layout)
    if layout == "darknet":
        found = files.where("path = 'obj.names'").first()
        return read_darknet(files, sizes, categories or (found and [x.strip() for x in found.value.splitlines() if x.strip()]))
    found = files.where("path = 'data.yaml'").first()
    return read_yolo(files, sizes, categories or (class_names(found.value) if found else []), layout)


def convert(files: DataFrame, source: str, target: str, sizes: DataFrame | None = None) -> DataFrame:
    """Files of one layout as those of another."""
    return WRITERS[target](read(files, source, sizes))
