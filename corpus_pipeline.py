"""From documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and gives back documents; the last one gives every
document as often as the mix takes it, numbered by ``copy``. Stages are written as Parquet and
read again, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from gridlens.llm import decontaminate, mixing, quality_rules, simhash, suffix_dedup
from gridlens.llm.common import Scratch


def quality(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def passages(spark, docs, sf_dir):
    """Passages that occur earlier are cut out of the texts."""
    return suffix_dedup.cut_repeats(docs)


def benchmark(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs, sf_dir):
    """Every document is repeated as its source's target weight asks."""
    return mixing.emit(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("repeated_passages", passages),
    ("benchmark", benchmark),
    ("mix", mix),
]

#: Learnt thresholds and 64-bit fingerprints are beyond SQL; tests hold run() against every stage done by hand.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    before = None
    for name, stage in STAGES[:-1]:
        with Scratch.removed():  # what the stage keeps for itself
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
