"""Label texts to rows and back.

Readers take files as (path, value) with the path from the root and the whole text, as ``text_files`` gives them, and
writers give files in the same form, which ``save_files`` stores; so every reader and writer
is a plan and can be run without a disk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlens.functions.scalars import stem, yolo_line


def text_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, value) of all files below ``root`` whose name fits, empty ones too.

    Spark's readers leave out files of no length, which are images without boxes here; a listing finds
    them: the folders of ``root`` here, what is below each of them in a task.
    """
    from pyarrow import fs

    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root, wholetext=True)
    place = root if "://" in root else f"file://{root}"
    system, base = fs.FileSystem.from_uri(place)
    folders = [f.path for f in system.get_file_info(fs.FileSelector(base)) if not f.is_file]

    def empty(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from fnmatch import fnmatch

        system, base = fs.FileSystem.from_uri(place)
        for batch in batches:
            for folder, deep in zip(batch["folder"], batch["deep"], strict=True):
                found = system.get_file_info(fs.FileSelector(folder, recursive=bool(deep)))
                bare = [f.path.removeprefix(base).lstrip("/") for f in found if f.is_file and not f.size and fnmatch(f.base_name, glob) and f.base_name[0] not in "._"]
                yield pd.DataFrame({"path": bare, "value": ""}, dtype=object)

    at = F.regexp_replace(F.input_file_name(), "^.*?" + re.escape(base.strip("/")) + "/", "")
    listed = spark.createDataFrame([(base, False), *((f, True) for f in folders)], "folder string, deep boolean").repartition(len(folders) + 1)
    return df.select(at.alias("path"), "value").unionByName(listed.mapInPandas(empty, "path string, value string"))


def named_files(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """(path, value) of files given by name below ``root``, read in tasks: for those that Spark's readers hide (``_`` in front)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for batch in batches:
            texts = []
            for name in batch["path"]:
                with system.open_input_stream(f"{base}/{name}") as f:
                    texts.append(f.read().decode())
            yield pd.DataFrame({"path": batch["path"], "value": texts})

    return spark.createDataFrame([(n,) for n in names], "path string").mapInPandas(read, "path string, value string")


def save_files(files: DataFrame, root: str) -> None:
    """Stores (path, value) below ``root``, on whatever file system that names."""

    def write(rows: Iterator) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for row in rows:
            at = f"{base}/{row.path}"
            system.create_dir(at.rpartition("/")[0], recursive=True)
            part = f"{at}.part"
            with system.open_output_stream(part) as out:
                out.write(row.value.encode())
            system.move(part, at)  # all of a file or nothing

    files.select("path", "value").foreachPartition(write)


def fields(files: DataFrame) -> DataFrame:
    """(path, line, parts) of every line with words; a file without any has one row with nulls."""
    lines = files.select("path", F.posexplode(F.split("value", "\n")).alias("line", "text"))
    parts = lines.select("path", "line", F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ").alias("parts")).where("parts[0] <> ''")
    bare = files.select("path").join(parts.select("path").distinct(), "path", "left_anti")
    return parts.unionByName(bare.select("path", F.lit(None).cast("int").alias("line"), F.lit(None).cast("array<string>").alias("parts")))


def _num(k: int, kind: str = "double") -> Column:
    return F.get("parts", F.lit(k)).try_cast(kind)


CENTRE = ("cx", "cy", "w", "h")


def yolo(files: DataFrame, default_conf: float | None = None, keep_empty: bool = True, strict: bool = False, extra: bool = False) -> DataFrame:
    """(path, line, class_id, cx, cy, w, h[, conf][, extra]) of lines with five fields or more.

    With ``strict`` exactly five or six. A file without boxes keeps one row of nulls, so that it
    still counts as an image.
    """
    f = fields(files)
    n = F.size("parts")
    good = n.isin(5, 6) if strict else n >= 5
    cols = [F.col("path"), F.col("line"), _num(0, "int").alias("class_id"), *[_num(k + 1).alias(c) for k, c in enumerate(CENTRE)]]
    if default_conf is not None:
        cols.append(F.coalesce(_num(5), F.lit(default_conf)).alias("conf"))
    if extra:
        cols.append(F.when(n > 5, F.slice("parts", F.lit(6), n)).alias("extra"))
    rows = f.where(F.col("parts").isNotNull() & good).select(*cols)
    if not keep_empty:
        return rows
    bare = files.select("path").join(rows.select("path").distinct(), "path", "left_anti")
    return rows.unionByName(bare, allowMissingColumns=True)


def yolo_all_or_nothing(files: DataFrame, default_conf: float = 0.9, least: float = 0.0) -> DataFrame:
    """As ``yolo`` with confidence and all classes 0, but a file with any line that does not parse is empty."""
    f = fields(files).where("parts is not null")
    numbers = F.forall(F.slice("parts", 1, 6), lambda x: x.try_cast("double").isNotNull())
    bad = f.where((F.size("parts") < 5) | ~numbers).select("path").distinct()
    return yolo(files, default_conf, keep_empty=False).join(bad, "path", "left_anti").where(F.col("conf") >= least).withColumn("class_id", F.lit(0))


def scored_lines(files: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of seven fields (box, score, category) from a score on, without the category."""
    rows = fields(files).where(F.size("parts") == 7)
    return rows.select("path", "line", _num(0, "int").alias("class_id"), *[_num(k + 1).alias(c) for k, c in enumerate(CENTRE)], _num(5).alias("conf")).where(F.col("conf") >= least)


def to_label_files(rows: DataFrame, values: Sequence[str] = CENTRE, digits: int = 6, path: str = "path", order: Sequence[str] = ("line",)) -> DataFrame:
    """(path, value): one line a row, in order, ended by a newline; rows without a class make an empty file."""
    text = F.when(F.col("class_id").isNotNull(), yolo_line(F.col("class_id"), *[F.col(c) for c in values], digits=digits))
    lines = F.sort_array(F.collect_list(F.when(text.isNotNull(), F.struct(*order, text.alias("_t")))))
    out = rows.groupBy(F.col(path).alias("path")).agg(F.transform(lines, lambda x: x["_t"]).alias("l"))
    return out.select("path", F.when(F.size("l") > 0, F.concat(F.array_join("l", "\n"), F.lit("\n"))).otherwise("").alias("value"))


COCO = (
    "images array<struct<id:bigint,file_name:string,width:int,height:int>>, "
    "annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,area:double,iscrowd:int>>, "
    "categories array<struct<id:bigint,name:string>>"
)


def coco(files: DataFrame) -> DataFrame:
    """(path, stem, width, height, class_id, class_name, x, y, w, h) of COCO texts.

    Categories are counted anew from 0 by id; annotations of unknown images or categories go.
    """
    j = files.select("path", F.from_json("value", COCO).alias("c"))
    images = j.select("path", F.explode("c.images").alias("i")).select("path", F.col("i.id").alias("image_id"), stem(F.col("i.file_name")).alias("stem"), "i.width", "i.height")
    cats = j.select("path", F.explode("c.categories").alias("k")).select("path", F.col("k.id").alias("category_id"), F.col("k.name").alias("class_name"))
    cats = cats.withColumn("class_id", F.row_number().over(Window.partitionBy("path").orderBy("category_id")) - 1)
    anns = j.select("path", F.explode("c.annotations").alias("a")).select("path", "a.image_id", "a.category_id", *[F.get("a.bbox", F.lit(k)).alias(c) for k, c in enumerate("xywh")])
    return anns.join(images, ["path", "image_id"]).join(cats, ["path", "category_id"]).select("path", "stem", "width", "height", "class_id", "class_name", *"xywh")


def coco_predictions(files: DataFrame) -> DataFrame:
    """(image_id, category_id, x, y, w, h, score) of a list of predictions."""
    p = files.select(F.explode(F.from_json("value", "array<struct<image_id:bigint,category_id:bigint,bbox:array<double>,score:double>>")).alias("p"))
    return p.select("p.image_id", "p.category_id", *[F.get("p.bbox", F.lit(k)).alias(c) for k, c in enumerate("xywh")], "p.score")


#: Images of a COCO text, and paths of a list: larger splits are written in shards.
SHARD, LIST = 10_000, 200_000


def sharded(rows: DataFrame, by: str, key: Column, most: int) -> DataFrame:
    """rows with shard (0 and on) and mark (what a path gets: nothing for a split of one shard, else ``-00000``)."""
    sizes = rows.groupBy(by).agg(F.greatest(F.ceil(F.count(F.lit(1)) / most), F.lit(1)).alias("_shards"))  # one row a split
    out = rows.join(F.broadcast(sizes), by).withColumn("shard", F.pmod(F.xxhash64(key), "_shards"))
    return out.withColumn("mark", F.when(F.col("_shards") > 1, F.format_string("-%05d", "shard")).otherwise("")).drop("_shards")


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """rows with ``name`` from 1 on, through the shards of ``by[0]`` in turn: counts first, then each shard's own numbers."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    start = Window.partitionBy(by[0]).orderBy(by[1]).rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    starts = sizes.select(*by, F.coalesce(F.sum("_n").over(start), F.lit(0)).alias("_n0"))
    own = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.join(starts, list(by)).withColumn(name, (F.col("_n0") + own).cast("long")).drop("_n0")


def to_coco(images: DataFrame, boxes: DataFrame, categories: Sequence[str], path: Column, shard: int = SHARD) -> DataFrame:
    """(path, value): COCO texts of images (stem, file_name, width, height) and boxes (stem, class_id, x, y, w, h in pixels).

    A split of more than ``shard`` images is written in several texts, each whole in itself, whose ids
    go on through all of them. Ids run from 1 in the order of stems and of boxes within a text;
    categories from 1; numbers have two digits.
    """
    i = sharded(images.withColumn("split_path", path), "split_path", F.col("stem"), shard)
    i = numbered(i, ("split_path", "shard"), ("stem",), "id").withColumn("path", F.regexp_replace("split_path", r"(\.coco)?\.json$", F.concat("mark", F.lit("$1.json"))))
    b = boxes.join(i.select("stem", "split_path", "shard", "path", F.col("id").alias("image_id")), "stem")
    b = numbered(b, ("split_path", "shard"), ("image_id", "class_id", *"xywh"), "id")
    two = lambda c: F.bround(c, 2)
    ann = F.struct("id", "image_id", (F.col("class_id") + 1).cast("long").alias("category_id"), F.array(*[two(F.col(c)) for c in "xywh"]).alias("bbox"), two(F.col("w") * F.col("h")).alias("area"), F.lit(0).alias("iscrowd"))
    ii = i.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("id", "file_name", "width", "height"))).alias("images"))
    bb = b.groupBy("path").agg(F.sort_array(F.collect_list(ann)).alias("annotations"))
    cats = F.array(*[F.struct(F.lit(k + 1).cast("long").alias("id"), F.lit(c).alias("name")) for k, c in enumerate(categories)])
    j = ii.join(bb, "path", "left")
    return j.select("path", F.to_json(F.struct("images", F.coalesce("annotations", F.array().cast(bb.schema["annotations"].dataType)).alias("annotations"), cats.alias("categories"))).alias("value"))
