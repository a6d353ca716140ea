"""License scans: ordered signatures behind a keyword prefilter.

An Aho-Corasick pass over the words of a text finds the keywords in it; only rules of which a
set of keywords occurs are matched: every text that a rule matches holds one of its sets. Detections are taken in order of priority, and one whose
interval of words lies inside that of a detection already kept is suppressed.

Defined cases: null and empty texts have no words, null places and empty labels; whole texts
are read, whatever their length; of detections over the same words the first rule stays;
repeated rows each get their result; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from gridlens.llm.license_rules import table

#: Phrases of the base scan.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Bytes to words: A-Z lower-cased, what stands in no word made a blank.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<rule:int,label:string,first_word:long,end_word:long,weight:double>>"
)


@lru_cache(1)
def _compiled():
    import ahocorasick

    rules = [(label, weight, keys, re.compile(f"(?<= )(?:{regex})(?= )")) for label, weight, keys, regex in table()]
    keywords = ahocorasick.Automaton()
    for key in {k for r in rules for keys in r[2] for k in keys}:
        keywords.add_word(f" {key} ", key)
    keywords.make_automaton()
    by_key: dict[str, list[tuple[int, frozenset[str]]]] = {}
    for k, (_, _, sets, _) in enumerate(rules):
        for keys in sets:
            by_key.setdefault(min(keys), []).append((k, keys))
    return rules, keywords, by_key


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class _Reach:
    """Largest end among kept intervals that start at or before a place (a Fenwick tree)."""

    def __init__(self, starts: list[int]):
        self.starts, self.most = starts, [-1] * (len(starts) + 1)

    def add(self, start: int, end: int) -> None:
        k = bisect_left(self.starts, start) + 1
        while k <= len(self.starts):
            self.most[k] = max(self.most[k], end)
            k += k & -k

    def upto(self, start: int) -> int:
        k, out = bisect_left(self.starts, start) + 1, -1
        while k:
            out = max(out, self.most[k])
            k -= k & -k
        return out


def suppressed(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (rule, start, end), those not inside a kept one of an earlier rule, by start."""
    reach, kept = _Reach(sorted({s for _, s, _ in found})), []
    for rule, start, end in sorted(found, key=lambda d: (d[0], d[1], -d[2])):
        if reach.upto(start) < end:
            reach.add(start, end)
            kept.append((rule, start, end))
    return sorted(kept, key=lambda d: (d[1], d[2], d[0]))


def _places(text: str, at: list[int]) -> dict[int, int]:
    """Blanks before each of the sorted offsets: the places of words."""
    out, n, last = {}, 0, 0
    for k in at:
        n += text.count(" ", last, k)
        out[k], last = n, k
    return out


def scan(text: bytes | None) -> tuple:
    """What the columns of SCHEMA after doc_id hold, for one text."""
    words = words_of(text or b"")
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    rules, keywords, by_key = _compiled()
    base = []
    for phrase, label in BASE:
        look, k = f" {phrase} ", line.find(f" {phrase} ")
        while k >= 0:
            base.append((k, label))
            k = line.find(look, k + 1)
    base.sort()
    # a keyword's closing blank opens the next one, so overlapping finds are all reported
    present = {key for _, key in keywords.iter(line)}
    tried = {k for key in present for k, keys in by_key.get(key, ()) if keys <= present}
    found = [(k, m.start(), m.end()) for k in tried for m in rules[k][3].finditer(line)]
    kept = suppressed(found)
    place = _places(line, sorted({k for k, _ in base} | {k - 1 for _, k, _ in kept} | {k for *_, k in kept}))
    starts = [place[k] for k, _ in base]
    weights: dict[str, float] = {}
    for k, *_ in kept:
        weights[rules[k][0]] = max(weights.get(rules[k][0], 0), rules[k][1])
    labels, miss = {label for _, label in base}, 1.0
    for w in weights.values():
        miss *= 1 - w
    detections = [(k, rules[k][0], place[s - 1], place[e], rules[k][1]) for k, s, e in kept]
    return (len(words), len(base), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(labels)), ",".join(sorted(labels | {*weights})), round(1 - miss, 9), detections)


def license_scan(docs: DataFrame) -> DataFrame:
    """The columns of SCHEMA for every row of docs (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        for batch in batches:
            out = pd.DataFrame([scan(t) for t in batch["text"]], columns=names)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            for c in ("doc_id", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            out["detections"] = [[dict(zip(("rule", "label", "first_word", "end_word", "weight"), d, strict=True)) for d in x] for x in out["detections"]]
            yield out

    return docs.selectExpr("doc_id", "cast(text as binary) text").mapInPandas(run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan(docs).drop("detections")
