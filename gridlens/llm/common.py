"""Shared pieces: scratch tables that survive executor loss, connected components."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a small side may be broadcast; beyond it a shuffle join is used.
BROADCAST_ROWS = 20_000

#: Rows that a Python worker is sent at once: of texts, this and not a partition's size is what it holds.
ROWS_A_BATCH = 1000

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset: a folder in the warehouse, which all
    machines see; a temporary one only if this process is the only machine."""
    global _own_dir
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if told:
        return told.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_gridlens"
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="gridlens-")
        atexit.register(shutil.rmtree, _own_dir, True)
    return f"file://{_own_dir}"


class Scratch:
    """Parquet tables in the shared folder; each one cuts the lineage at its place.

    A table lives until ``drop``; what a returned DataFrame still reads is never dropped by
    the operators. ``removed`` takes away what was made within it, once its results are stored.
    """

    _open = threading.local()

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        for made in getattr(Scratch._open, "made", []):
            made.append(self)

    @classmethod
    @contextmanager
    def removed(cls) -> Iterator[None]:
        """All that operators called within, by this thread, have kept goes at the end: nothing that reads it may still run then."""
        made: list[Scratch] = []
        cls._open.made = [*getattr(cls._open, "made", []), made]
        try:
            yield
        finally:
            cls._open.made = cls._open.made[:-1]
            for scratch in made:
                scratch.drop("")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(conf).delete(path, True)


def lean(spark: SparkSession) -> None:
    """Bounds the rows of a batch for Python workers in this session; a smaller bound stands. No result depends on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_A_BATCH:
        spark.conf.set(name, str(ROWS_A_BATCH))


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` keep within ``bound``."""
    return F.broadcast(df) if rows <= bound else df


def packed(docs: DataFrame, *own) -> DataFrame:
    """``docs`` as one struct ``_doc`` beside the columns ``own``, so that no name of theirs meets one of ours; ``_doc.*`` unpacks."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *own)


def ascii_lower(col):
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b).

    component is the smallest node that can be reached. Alternating large-star and
    small-star rounds: each keeps the number of edges or lowers it, and a star's centre is
    met by an aggregate and a join that may be split, never by a collected group. Self
    loops count as nodes; rows with a null end are ignored. No rows give no rows.
    """

    def oriented(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def large_star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        spread = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return spread.union(least.select("a", F.col("m").alias("b")))

    clean = edges.select("a", "b").where("a is not null and b is not null")
    e = scratch.save(oriented(clean).distinct(), "edges")
    loops = e.where("a = b").select("a", "b")
    now, name, print_of = e.where("a <> b"), "edges", None
    kept = ["edges"]
    for k in range(max_rounds):
        e = oriented(large_star(now)).where("a <> b").distinct()
        e = oriented(small_star(e)).where("a <> b").distinct()
        name = f"round{k}"
        now = scratch.save(e, name)
        kept.append(name)
        if len(kept) > 3:
            scratch.drop(kept.pop(1))
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.hash("b", "a"))).first()
        if mark == print_of:
            break
        print_of = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
