"""Repeated passages by a sparse suffix array.

Words are bytes between ASCII white space, with A-Z lower-cased. A suffix is retained where
the hash of its first ANCHOR words is the least of a window of places, so any passage of
``least`` words retains the same suffix wherever it stands (the one that owns it). Retained
suffixes whose beginning stands at two places are written out in words, as far as the
passages that they own reach, and sorted: the array. Equal beginnings (a bucket) are
neighbours in one part of it. Common words of neighbours give, for every number of words,
the run of suffixes that agree so far to the right. Within a bucket matches are then extended
to the left, word by word, with the run to the right that makes ``least`` words with it, so
that all partners are met at once and never as pairs. Words are compared, not hashes.

A bucket of more than ``hot`` suffixes is dealt out in parts, by a hash of the place, that are
extended alike. Of the suffixes that agree in a window all but the first of a part are later
ones for certain; that first one stands for them where parts meet, under a digest of the
window's words, so that no more rows of a passage meet than it has parts.

The first occurrence of a window of ``least`` words (least doc_id, then place) is its
original; the words of all others are its copies, which ``cut_repeats`` removes. So a word
goes only if the same words stand earlier, and the first of them all stays.

Defined cases: null, empty and short texts (fewer than ``least`` words) hold no passage;
within a text repeats count too, overlapping ones included; rows that agree in doc_id and
text are one document, those that agree in doc_id alone are several, in the order of a hash
of their texts; a null doc_id sorts last and joins no other rows; an empty table gives no
rows; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import Scratch, lean, packed

#: Words of a passage that counts as repeated, words of a suffix's beginning, suffixes of a part of a bucket (about).
LEAST, ANCHOR, HOT = 50, 20, 2000
#: Suffixes that a task looks at together, if no bucket is larger.
CHUNK = 20_000

_SPACE = re.compile(rb"[^\x20\x09-\x0D]+")
#: Stands for a null doc_id inside; it sorts last.
_NO_ID = 2**63 - 1
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: A document: its id, and the hash of its text among those of equal id.
DOC = ("doc", "tie")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def windows_of(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, by doubling, each as exact as 64 bits are."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    out, have, power, width = None, 0, h, 1
    while True:
        if n & width:
            if out is None:
                out, have = power, width
            else:
                m = len(h) - have - width + 1
                out, have = _mix(out[:m] * _P + power[have : have + m] + _Q), have + width
        if have == n:
            return out
        m = len(power) - width
        power, width = _mix(power[:m] * _P + power[width:] + _Q), width * 2


def minimisers(a: np.ndarray, w: int) -> np.ndarray:
    """For every window of w values of ``a``, the place of its least (the leftmost of equals)."""
    n, count = len(a), len(a) - w + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    best, width = np.arange(n), 1
    out, have = None, 0
    while True:
        if w & width:
            if out is None:
                out, have = best[: n - width + 1], width
            else:
                m = n - have - width + 1
                left, right = out[:m], best[have : have + m]
                out, have = np.where(a[right] < a[left], right, left), have + width
        if have == w:
            return out
        m = n - 2 * width + 1
        if m <= 0:
            raise AssertionError("a window is longer than its values")
        left, right = best[:m], best[width : width + m]
        best, width = np.where(a[right] < a[left], right, left), width * 2


def retained(words: list[bytes], least: int = LEAST, anchor: int = ANCHOR):
    """(key, at, near, far) of the suffixes retained for the windows of ``least`` words: the hash of
    the beginning, the place, and that the windows owned begin near to far words before it."""
    if len(words) < least:
        return None
    begin = windows_of(word_hashes(words), anchor)
    owner = minimisers(begin, least - anchor + 1)
    # owners never go back, so the windows of one are consecutive
    at, first, count = np.unique(owner, return_index=True, return_counts=True)
    return begin[at].view(np.int64), at, at - first - count + 1, at - first


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only


def sparse_suffixes(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """(key, doc, tie, at, near, far): the retained suffixes of docs (doc, tie, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for doc, tie, text in zip(batch["doc"], batch["tie"], batch["text"], strict=True):
                if (found := retained(words_of(text), least, anchor)) is not None:
                    n = len(found[0])
                    parts.append((found[0], np.full(n, doc), np.full(n, tie), *(x.astype(np.int32) for x in found[1:])))
            if parts:
                yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(("key", "doc", "tie", "at", "near", "far"), zip(*parts, strict=True), strict=True)})

    return docs.mapInPandas(run, "key long, doc long, tie long, at int, near int, far int")


def contexts(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, part, parts, doc, tie, at, near, far, to_right, to_left) of the suffixes that texts (doc, tie, text, suffixes) names.

    to_right holds the words from the suffix on that its nearest window needs, each with a blank after
    it; to_left those before it that the furthest needs, from right to left. part is below parts, which
    is 1 for a bucket that is not hot.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, tie, text, suffixes in zip(batch["doc"], batch["tie"], batch["text"], batch["suffixes"], strict=True):
                words = words_of(text)
                for s in suffixes:
                    at, near, far = s["at"], s["near"], s["far"]
                    right, left = words[at : at + least - near], words[at - far : at][::-1]
                    out.append((s["key"], s["parts"], doc, tie, at, near, far, b"".join([w + b" " for w in right]), b"".join([w + b" " for w in left])))
            if out:
                yield pd.DataFrame(out, columns=["key", "parts", "doc", "tie", "at", "near", "far", "to_right", "to_left"])

    out = texts.mapInPandas(run, "key long, parts long, doc long, tie long, at int, near int, far int, to_right binary, to_left binary")
    return out.withColumn("part", F.pmod(F.xxhash64("doc", "tie", "at"), "parts"))


def _numbered(column: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal ones for equal words, one row each and -1 where there are no more; and how many words a row has."""
    size = np.fromiter((x.count(b" ") for x in column), dtype=np.int64, count=len(column))
    words = b"".join(column).split(b" ")[:-1]  # each has a blank after it
    out = np.full((len(column), width), -1, dtype=np.int64)
    out[np.arange(width) < size[:, None]] = pd.factorize(np.array(words, dtype=object))[0] if words else []
    return out, size


def _runs_from(new: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate(([True], new)))


def extended(rows: pd.DataFrame, least: int, anchor: int) -> tuple[pd.DataFrame, np.ndarray]:
    """Distinct ``rows`` of whole parts, sorted, and what their windows are: 0 single, 1 a first occurrence, 2 a later one, -1 not owned.

    Of the second, the column d belongs to the window that begins d words before the suffix.
    """
    rows = rows[~rows.duplicated(["doc", "tie", "at"])].reset_index(drop=True)  # rows of one document
    n, most = len(rows), least - anchor
    right, n_right = _numbered(rows["to_right"], least)
    left, _ = _numbered(rows["to_left"], most)
    some = left.max(initial=0) + 2
    place = np.empty(n, dtype=np.int64)
    place[np.lexsort((rows["at"], rows["tie"], rows["doc"]))] = np.arange(n)
    differ = right[1:] != right[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), least)
    common = np.minimum(common, np.minimum(n_right[1:], n_right[:-1]))
    part = rows["part"].to_numpy()
    common[part[1:] != part[:-1]] = 0
    near, far = rows["near"].to_numpy(), rows["far"].to_numpy()
    out = np.full((n, most + 1), -1, dtype=np.int8)
    matched = _runs_from(common < anchor)  # the bucket, then those of it that agree so far to the left
    for d in range(most + 1):
        if d:
            matched = np.unique(matched * some + left[:, d - 1] + 1, return_inverse=True)[1]
        own = np.nonzero((near <= d) & (d <= far))[0]
        to_right = _runs_from(common < least - d)[own]
        group = np.unique(matched[own] * (n + 1) + to_right, return_inverse=True)[1]
        count = np.bincount(group)
        first = np.full(len(count), n)
        np.minimum.at(first, group, place[own])
        out[own, d] = np.where(count[group] < 2, 0, np.where(place[own] == first[group], 1, 2))
    return rows, out


def windows_at(rows: pd.DataFrame, kinds: np.ndarray, least: int) -> pd.DataFrame:
    """(doc, tie, at, own, copied, firsts) of each suffix that has any repeated window. Of own (first
    occurrences) and copied the bit d is the window that begins d words before the suffix; of hot buckets
    the first ones of a part are listed with a digest."""
    at, hot = rows["at"].to_numpy(), rows["parts"].to_numpy() > 1
    bits = np.int64(1) << np.arange(kinds.shape[1], dtype=np.int64)
    own, copied = ((kinds == 1) & ~hot[:, None]) @ bits, (kinds == 2) @ bits
    some = np.nonzero((own | copied) | hot)[0]
    firsts: list[list[dict] | None] = [None] * len(some)
    for k in np.nonzero(hot[some])[0]:
        i = some[k]
        words, far = rows["to_left"].iat[i].split()[::-1], int(rows["far"].iat[i])
        words += rows["to_right"].iat[i].split()
        of = np.nonzero((kinds[i] == 0) | (kinds[i] == 1))[0].tolist()
        firsts[k] = [{"key": hashlib.blake2b(b" ".join(words[far - d : far - d + least]), digest_size=16).digest(), "start": int(at[i]) - d, "many": bool(kinds[i, d] == 1)} for d in of]
    return pd.DataFrame({"doc": rows["doc"].to_numpy()[some], "tie": rows["tie"].to_numpy()[some], "at": at[some], "own": own[some], "copied": copied[some], "firsts": firsts})


_FOUND = "doc long, tie long, at int, own long, copied long, firsts array<struct<key:binary,start:int,many:boolean>>"
#: Windows that a suffix may own: the bits of a long.
_OWNED = 63


def in_parts(array: DataFrame, least: int, anchor: int) -> DataFrame:
    """The columns of ``windows_at`` from the suffixes ``array``: sorted by their words, neighbours compared, extended."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def bucket(rows: pd.DataFrame, i: int) -> tuple:
            return rows["part"].iat[i], rows["to_right"].iat[i].split(b" ", anchor)[:anchor]

        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < CHUNK:
                continue
            rows = pd.concat(held, ignore_index=True)
            lo, hi, last = 0, len(rows) - 1, bucket(rows, len(rows) - 1)  # the last part may go on: it waits
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if bucket(rows, mid) == last else (mid + 1, hi)
            held = [rows.iloc[lo:]]
            if lo:
                yield windows_at(*extended(rows.iloc[:lo], least, anchor), least)
        if held:
            yield windows_at(*extended(pd.concat(held, ignore_index=True), least, anchor), least)

    cut = array.repartition("key", "part").sortWithinPartitions("part", "to_right")
    return cut.select("part", "parts", "doc", "tie", "at", "near", "far", "to_right", "to_left").mapInPandas(run, _FOUND)


def repeated_windows(docs: DataFrame, scratch: Scratch, least: int = LEAST, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc, tie, at, own, copied): bits of own and copied tell which windows that begin so many words before
    ``at`` occur twice, own the first occurrences; some rows for each document. docs has doc, tie, text."""
    if not 0 < anchor <= least < anchor + _OWNED:
        raise ValueError(f"a beginning has 1 to least words, and {_OWNED - 1} less than least at most")
    suffixes = scratch.save(sparse_suffixes(docs, least, anchor), "suffixes")
    place = F.xxhash64("doc", "tie", "at")
    shared = suffixes.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("n"))
    # stored, so that a frequent key may be split where it is joined
    shared = scratch.save(shared.where("lo <> hi").select("key", F.greatest(F.ceil(F.col("n") / hot), F.lit(1)).alias("parts")), "shared")
    alike = suffixes.join(shared.hint("merge"), "key").groupBy("doc", "tie").agg(F.collect_set(F.struct("key", "at", "near", "far", "parts")).alias("suffixes"))
    alike = scratch.save(alike, "alike")
    scratch.drop("suffixes", "shared")
    array = scratch.save(contexts(docs.join(alike.hint("merge"), list(DOC)), least), "array")
    scratch.drop("alike")
    found = scratch.save(in_parts(array, least, anchor), "found")
    scratch.drop("array")
    firsts = found.select("doc", "tie", F.explode("firsts").alias("f")).select("f.key", "f.many", "doc", "tie", "f.start")
    place = F.struct("doc", "tie", "start")
    met = firsts.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.max("many").alias("many")).where("n > 1 or many").select("key", "first")
    told = firsts.join(met.hint("merge"), "key").select("doc", "tie", F.col("start").alias("at"), (place == F.col("first")).cast("long").alias("own"))
    return found.where("own <> 0 or copied <> 0").select("doc", "tie", "at", "own", "copied").unionByName(told.withColumn("copied", 1 - F.col("own")))


def _covered(n: int, at: np.ndarray, masks: np.ndarray, least: int) -> np.ndarray:
    """Which of n words the windows that ``masks`` name before the places ``at`` cover."""
    step = np.zeros(n + 1, dtype=np.int64)
    i, d = np.nonzero(masks[:, None] >> np.arange(_OWNED) & 1)
    at = np.unique(at[i] - d)
    step[at] += 1
    step[at + least] -= 1
    return np.cumsum(step[:-1]) > 0


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.nonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))[0]
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def with_ids(docs: DataFrame) -> DataFrame:
    """doc, tie, text of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).cast("long").alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))


def repeats(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """One row for each document that holds a repeated passage: doc_id, tie, spans and copies.

    tie is the hash of its text; spans are the maximal spans of words (start, end) of passages that
    occur twice; copies are the words of windows that occur earlier.
    """
    lean(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "suffixes")
    windows = repeated_windows(with_ids(docs), scratch, least, anchor, hot)
    by_doc = windows.groupBy("doc", "tie").agg(*[F.collect_list(c).alias(c) for c in ("at", "own", "copied")])

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, copies = [], []
            for at, own, copied in zip(batch["at"], batch["own"], batch["copied"], strict=True):
                at, own, copied = (np.asarray(x, dtype=np.int64) for x in (at, own, copied))
                n = int(at.max()) + least
                spans.append([{"start": x, "end": y} for x, y in _runs(_covered(n, at, own | copied, least))])
                copies.append([{"start": x, "end": y} for x, y in _runs(_covered(n, at, copied, least))])
            yield pd.DataFrame({"doc_id": batch["doc"], "tie": batch["tie"], "spans": spans, "copies": copies})

    out = by_doc.mapInPandas(join, "doc_id long, tie long, spans array<struct<start:int,end:int>>, copies array<struct<start:int,end:int>>")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def cut_text(text: bytes, copies: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans and what stands between those words."""
    words = [m.span() for m in _SPACE.finditer(text)]
    out, last = [], 0
    for a, b in copies:
        out.append(text[last : words[a][0]])
        last = words[b][0] if b < len(words) else len(text)
    return b"".join([*out, text[last:]])


def cut_repeats(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """docs with the copies cut out of their texts; a text of which nothing is left goes.

    All columns stay; n_chars, where there is one, is counted anew.
    """
    spark = docs.sparkSession
    found = repeats(docs.select("doc_id", "text"), least, anchor, hot).where("size(copies) > 0")
    found = Scratch(spark, "repeats").save(found.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id"), F.col("tie").alias("_tie"), "copies"), "found")
    text = F.col("text").cast("binary")
    rows = packed(docs, F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id"), F.xxhash64(F.coalesce(text, F.lit("").cast("binary"))).alias("_tie"))
    # the copies grow with the corpus: shuffled, at every size alike
    joined = rows.join(found.hint("merge"), ["_id", "_tie"], "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, copies: pd.Series) -> pd.Series:
        return pd.Series([cut_text(t, [(c["start"], c["end"]) for c in x]).decode("utf-8", "replace") for t, x in zip(texts, copies, strict=True)])

    changed = joined.where("copies is not null").select("_doc", cut(F.col("_doc.text").cast("binary"), "copies").alias("_left")).where(F.col("_left").rlike(r"[^\x20\x09-\x0D]"))
    changed = changed.withColumn("_doc", F.col("_doc").withField("text", F.col("_left")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("_doc", F.col("_doc").withField("n_chars", F.length("_left").cast(docs.schema["n_chars"].dataType)))
    return joined.where("copies is null").select("_doc.*").unionByName(changed.select("_doc.*"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = "cast(aggregate({0}, 0, (n, s) -> n + s.end - s.start) as long)"
    return repeats(docs).select(
        "doc_id", F.size("spans").cast("long").alias("n_spans"), F.expr(words.format("spans")).alias("repeated_words"), F.expr(words.format("copies")).alias("cut_words"),
        F.expr("array_join(transform(spans, s -> concat(s.start, '-', s.end)), ',')").alias("spans"),
    )
