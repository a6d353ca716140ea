"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints are 64 bits over 3-word shingles. Two link at a distance of 3 or less. Half the
radius lies between 1 and 2: of two linked fingerprints at distance 3 one has an odd number
of ones and the other an even number, and at least two of the three bits lie in the same half
of 32. So every fingerprint emits its ball of radius 1, odd ones also all variants with two
bits of one half flipped, and linked ones meet in a variant: an odd one walks two steps, an
even one the third. Who meets is linked for certain: members of a radius-1 ball are at most 2
apart and 3 from those that came two steps, so one star to the least of them stands for all
pairs of a variant, however many meet there. Stars are verified by bit count and joined into
components.

Only fingerprints that may have a partner emit variants: of six blocks of bits at least three
agree between linked ones, so a fingerprint that shares no three blocks with another has no
link. This loses nothing at any size.

Defined cases: a text without words has fingerprint zero; fewer words than a shingle are one
shingle; null and empty texts have no words; equal fingerprints are one class, counted in
every task before they meet; a null doc_id stands for itself but names no class unless it is
alone in it; repeated rows each get their result; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import Scratch, components, lean, packed

RADIUS = 3
#: Bits of the six blocks.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """The signed 64-bit fingerprint of one text."""
    import xxhash

    words = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return int(np.uint64(digest(b" ".join(words), 42)).astype(np.int64))
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[: -n])).tolist()
    stops = (ends[n - 1 :] - 1).tolist()
    h = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (and ``keep``) of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="text").assign(fp=[fingerprint(t) for t in batch["text"]])

    rows = docs.select("doc_id", *keep, F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text") + ", fp long")


def ball_masks(steps: int):
    """Array of the flips' masks: none and single bits at 1 step, pairs within a half at 2.

    Written as a rule, so that plans stay short.
    """
    if steps == 1:
        return F.expr("concat(array(0L), transform(sequence(0, 63), i -> shiftleft(1L, i)))")
    return F.expr("flatten(transform(sequence(0, 62), i -> transform(filter(sequence(i + 1, 63), j -> i div 32 = j div 32), j -> shiftleft(1L, i) | shiftleft(1L, j))))")


def block_keys(fp):
    """Array of (which three blocks, their bits) of a fingerprint."""

    def bits(at, n):
        return F.shiftright(fp, at).bitwiseAND(F.lit((1 << n) - 1))

    out = []
    for k, chosen in enumerate(combinations(BLOCKS, len(BLOCKS) - RADIUS)):
        key = F.lit(k).cast("long")
        for at, n in chosen:
            key = F.shiftleft(key, n).bitwiseOR(bits(at, n))
        out.append(key)
    return F.array(*out)


def link_stars(prints: DataFrame, scratch: Scratch, name: str = "near") -> DataFrame:
    """(a, b) with bit_count(a ^ b) <= 3 whose components are those of all links among the distinct ``prints`` (fp)."""
    keyed = prints.select("fp", F.explode(block_keys(F.col("fp"))).alias("k"))
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    near = scratch.save(keyed.join(shared.hint("merge"), "k").select("fp").distinct(), name)
    near = near.repartition(2 * max(prints.sparkSession.sparkContext.defaultParallelism, 1), "fp")  # few rows, many variants
    one = near.select("fp", F.explode(ball_masks(1)).alias("m"), F.lit(True).alias("close"))
    two = near.where("bit_count(fp) % 2 = 1").select("fp", F.explode(ball_masks(2)).alias("m"), F.lit(False).alias("close"))
    met = one.union(two).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"), "close")
    hub = met.groupBy("v").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1 and b is not null")
    # Spark's estimate of a size leaves out what explode makes of it: never broadcast
    stars = met.join(hub.select("v", "b").hint("merge"), "v").select(F.col("fp").alias("a"), "b").where("a <> b").distinct()
    return stars.where(f"bit_count(a ^ b) <= {RADIUS}")


def near_duplicates(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, class_id, component_id (and ``keep``) of every row.

    class_id is the least doc_id of the same fingerprint, component_id the least that links reach.
    """
    lean(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, keep), "prints")
    classes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("class_id")), "classes")
    stars = scratch.save(link_stars(classes.select("fp"), scratch), "stars")
    if stars.isEmpty():
        joined = classes.withColumn("component_id", F.col("class_id"))
    else:
        member = scratch.save(components(stars, scratch), "members").withColumnRenamed("node", "fp")
        named = classes.join(member, "fp")
        least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
        found = named.join(least, "component").select("fp", "component_id")
        joined = classes.join(found, "fp", "left").withColumn("component_id", F.coalesce("component_id", "class_id"))
        joined = scratch.save(joined, "joined")
    return rows.join(joined, "fp").select("doc_id", *keep, "fp", "class_id", F.coalesce("component_id", "doc_id").alias("component_id"))


#: Words of the shingles of ``keep_one``, and the Jaccard similarity that links two texts.
VERIFY_WORDS, SIMILARITY = 5, 0.8
#: Of so many hashes one is below the bound of ``sampled`` shingles.
SAMPLE = 3
#: Rounds in which a bucket is tested against one member, before all pairs left are tested.
HUB_ROUNDS = 2


def shingle_set(text: bytes | None, n: int = VERIFY_WORDS) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; fewer words, or none, are one shingle."""
    import xxhash

    words = (text or b"").lower().split()
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], dtype=np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64)
    x, count = np.zeros(len(h) - n + 1, dtype=np.uint64), len(h) - n + 1
    for k in range(n):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k : k + count]
    return np.unique((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB))


def prefix_size(n: int) -> int:
    """Of the n shingles of a text, so many that one at least is shared with any text SIMILARITY alike."""
    return n - math.ceil(SIMILARITY * n - 1e-9) + 1


def index_size(n):
    """Column: so many that one at least is among the ``prefix_size`` ones of any text that is SIMILARITY alike and no shorter."""
    return n - F.ceil(F.lit(2 * SIMILARITY / (1 + SIMILARITY)) * n - 1e-9) + 1


def print_of(hashes: np.ndarray) -> int:
    """The signed 64-bit fingerprint of distinct shingles: a bit is 1 if set in over half of them."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts (id, text) are SIMILARITY alike over VERIFY_WORDS words."""

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, held = [], None, None
        for a, b in zip(left, right, strict=True):
            if b != last:  # the hub's, which often comes again
                last, held = b, shingle_set(b)
            out.append(jaccard(shingle_set(a), held) >= SIMILARITY)
        return pd.Series(out, dtype=bool)

    first = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return both.where(alike("ta", "tb")).select("a", "b")


def shingles(texts: DataFrame, sampled: bool) -> DataFrame:
    """id, fp, n, p, hs of every row of texts (id, text): the fingerprint, the number of shingles, the prefix's, and all of them or those below a bound."""
    bound = np.uint64(2**64 // SAMPLE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch["text"]]
            size = [prefix_size(len(s)) for s in sets]
            held = [(s[: np.searchsorted(s, bound)] if sampled else s).view(np.int64) for s in sets]
            yield pd.DataFrame({"id": batch["id"], "fp": [print_of(s) for s in sets], "n": [len(s) for s in sets], "p": size, "hs": held})

    return texts.mapInPandas(run, "id long, fp long, n long, p long, hs array<long>")


def freed(scratch: Scratch) -> None:
    """Shuffle files of what is stored go now, not at some later collection."""
    scratch.spark._jvm.System.gc()


def partnered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The id and fp of each of ``docs`` (id, text) that may have a partner, and of few that have none.

    All but p - 1 shingles of a text occur in its partner, so of those below the bound as well:
    of s of them at least s - p + 1 are in another text too.
    """
    sets = scratch.save(shingles(docs, True), "sampled")
    own = sets.groupBy("id", "fp").agg(F.max(F.size("hs") - F.col("p") + 1).alias("need"), F.count(F.lit(1)).alias("rows"))
    each = sets.select("id", F.explode("hs").alias("h"))
    shared = scratch.save(each.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("h"), "shared")
    freed(scratch)
    found = each.join(shared.hint("merge"), "h").groupBy("id").agg(F.count(F.lit(1)).alias("found"))
    out = own.join(found, "id", "left").where("need <= 0 or found >= need * rows").select("id", "fp")  # an exact copy is a row more
    out = scratch.save(out, "partnered")
    scratch.drop("sampled", "shared")
    freed(scratch)
    return out


def ball_links(prints: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of pairs SIMILARITY alike that the balls around the ``prints`` (id, fp) find: equal fingerprints and stars of linked ones."""
    classes = scratch.save(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    stars = link_stars(classes.select("fp"), scratch)
    across = stars.join(classes.selectExpr("fp as a", "least as id"), "a").join(classes.selectExpr("fp as b", "least as id2"), "b").select("id", "id2")
    within = prints.join(classes, "fp").where("id <> least").select("id", F.col("least").alias("id2"))
    pairs = across.union(within).select(F.greatest("id", "id2").alias("a"), F.least("id", "id2").alias("b")).distinct()
    return scratch.save(verified(pairs, texts), "balls")


def buckets(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """h, id, n, pos, weight: shingles under which the ``texts`` (id, text) meet that are SIMILARITY alike; every such pair has one.

    A prefix filter: under one order for all, two such texts share a shingle of their first p. The
    order is by the number of texts, so that common passages come last; shingles of one text alone
    come first and only use up places. pos is the place in this order, weight how many places shared ones have.
    """
    sets = scratch.save(shingles(texts, False), "sets")
    each = sets.select("id", F.explode("hs").alias("h"))
    shared = scratch.save(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    freed(scratch)
    met = each.join(shared.hint("merge"), "h").groupBy("id").agg(F.collect_list(F.struct("df", "h")).alias("hs"))
    met = met.join(sets.select("id", "n", "p"), "id").withColumn("weight", F.col("p") - F.col("n") + F.size("hs")).where("weight > 0")
    first = F.expr("slice(array_sort(hs), 1, cast(weight as int))")
    out = met.select(F.posexplode(first).alias("k", "x"), "id", "n", "weight", F.size("hs").alias("m"))
    out = scratch.save(out.select("x.h", "id", "n", (F.col("n") - F.col("m") + F.col("k")).alias("pos"), "weight"), "buckets")
    scratch.drop("sets", "shared")
    freed(scratch)
    return out


#: Two texts (n, pos and n2, pos2) that share a shingle there first may be alike: the shingles from there on are enough.
_ENOUGH = f"least(n - pos, n2 - pos2) >= {SIMILARITY / (1 + SIMILARITY):.12f} * (n + n2) - 1e-6"


def groups(live: DataFrame, texts: DataFrame, scratch: Scratch, links: DataFrame | None = None) -> DataFrame:
    """(node, component) of texts linked by pairs SIMILARITY alike, of all within the buckets ``live`` and of the ``links`` (a, b) known before.

    In rounds every bucket is tested against the member that shares most, then what is in one
    component needs no more tests; in the last round all other pairs are tested. Buckets of one
    component are done, and rounds end when there are no others.
    """
    live = live.withColumn("c", F.col("id"))
    none = scratch.save(live.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0), "none")
    links, tested, member = none if links is None else links, none, None
    for k in range(HUB_ROUNDS + 1):
        if member is None:
            member = scratch.save(components(links, Scratch(scratch.spark, "nearmembers")), f"members{k}")
            live = live.drop("c").join(member.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left").withColumn("c", F.coalesce("c", "id"))
        hub = F.max_by(F.struct("id", "n", "pos", "c"), F.struct("weight", "id")).alias("hub")
        open_ = live.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), hub).where("lo <> hi").select("h", "hub")
        open_ = scratch.save(open_, f"open{k}")  # stored, so that a large bucket may be split where it is joined
        live = scratch.save(live.join(open_.hint("merge"), "h"), f"live{k}")
        if live.isEmpty():
            break
        if k < HUB_ROUNDS:
            met = live.select("id", "n", "pos", "c", *[F.col(f"hub.{x}").alias(f"{x}2") for x in ("id", "n", "pos", "c")])
        else:
            index = live.where(F.col("pos") < index_size(F.col("n"))).select("h", *[F.col(x).alias(f"{x}2") for x in ("id", "n", "pos", "c")])
            met = live.select("h", "id", "n", "pos", "c").join(index.hint("merge"), "h").where("struct(n, id) > struct(n2, id2)")
        met = met.where(f"c <> c2 and {_ENOUGH}")
        pairs = met.select(F.greatest("id", "id2").alias("a"), F.least("id", "id2").alias("b")).distinct()
        pairs = scratch.save(pairs.join(tested, ["a", "b"], "left_anti"), f"pairs{k}")
        found = scratch.save(verified(pairs, texts), f"links{k}")
        if not found.isEmpty():
            links, member = member.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found), None  # stars stand for all links before
        tested = tested.union(pairs)
        live = live.select("h", "id", "n", "pos", "c", F.when(F.col("id") == F.col("hub.id"), -1).otherwise(F.col("weight")).alias("weight"))
    return member if member is not None else scratch.save(components(links, Scratch(scratch.spark, "nearmembers")), "members")


def near_copies(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """(key, doc_id) of the rows that go, key the digest of the text, and whether rows are repeated.

    Of each group of near copies the row of the least doc_id stays.
    """
    lean(docs.sparkSession)
    rows = scratch.save(docs.select("doc_id", digest().alias("key")).groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")), "rows")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"))
    texts = scratch.save(rows.groupBy("key").agg(F.min(rank).alias("rank")).withColumn("id", F.xxhash64("key")), "texts")
    each = docs.select("doc_id", digest().alias("key"), F.col("text").cast("binary").alias("text")).withColumn("id", F.xxhash64("key"))
    needed = scratch.save(partnered(each.select("id", "text"), scratch).join(texts, "id").select("key", "fp", F.col("rank.doc_id").alias("_first")), "needed")
    again = each.join(needed.hint("merge"), "key").where("doc_id <=> _first")
    again = scratch.save(again.dropDuplicates(["key"]).select("id", "fp", "text"), "needed_texts")
    near = ball_links(again.select("id", "fp"), again.select("id", "text"), scratch)
    again = again.select("id", "text")
    member = groups(buckets(again, scratch), again, scratch, near).withColumnRenamed("node", "id")
    kept = texts.select("key", "rank", "id").join(member, "id", "left").select("key", "rank", F.coalesce("component", "id").alias("group"))
    best = kept.groupBy("group").agg(F.min(F.struct("rank", "key")).alias("best")).select("best.key", F.col("best.rank.doc_id").alias("_stays"), F.lit(True).alias("_is"))
    gone = rows.join(best, "key", "left").where("not coalesce(_is and doc_id <=> _stays, false)").select("key", "doc_id")
    return scratch.save(gone, "gone"), not rows.where("n > 1").isEmpty()


def digest(col: str = "text"):
    return F.md5(F.coalesce(F.col(col), F.lit("")).cast("binary"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each group of near copies, that of the least doc_id.

    Exact copies of a text are one at once, counted in every task before they meet. Of the
    distinct texts any two are linked that are SIMILARITY alike over VERIFY_WORDS-word
    shingles. The balls of the texts' fingerprints find the closest; pairs that are not yet in
    one component come from a prefix filter, which loses none. Texts of fewer words are
    one shingle. Rows of equal doc_id and text: one stays; a null doc_id sorts last; null and
    empty texts are copies of each other. All columns stay.
    """
    gone, repeated = near_copies(docs.select("doc_id", "text"), Scratch(docs.sparkSession, "nearcopies"))
    gone = gone.select(F.col("key").alias("_key"), F.col("doc_id").alias("_gone"))
    rows = packed(docs, "doc_id", digest().alias("_digest"))
    left = rows.join(gone.hint("merge"), (F.col("_digest") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    if repeated:
        left = left.dropDuplicates(["doc_id", "_digest"])
    return left.select("_doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
