import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from gridlens.llm import license_rules, license_scan, quality_rules, token_counts

from .cases import frame, odd_rows, prose, store

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_Z = {c: c + 32 for c in range(65, 91)}


def base_scan(text):
    words = WORD.findall((text or "").translate(A_Z))
    found = []
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


LICENSE_TEXTS = [
    "CC BY cc-by, CC BY CC BY", "The MIT License MIT licensex mit  LICENSE", "GNU General\nPublic License; Apache-License", "gnu general public licensE cc\u00e9 by cc by",
    "SPDX-License-Identifier: Apache-2.0 OR MIT", "", None,
]


@pytest.mark.parametrize("text", LICENSE_TEXTS)
def test_base_scan(text):
    got = license_scan.scan(None if text is None else text.encode())
    assert got[:5] == base_scan(text)


def test_base_scan_random():
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(["cc", "by", "mit", "license", "apache", " ", "-", "gnu general public", "X", "\n", "\u00e9"]) + r.choice([" ", ""]) for _ in range(r.randint(0, 40)))
        assert license_scan.scan(text.encode())[:5] == base_scan(text), text


def test_rules_compile_and_are_many():
    rules, _, _ = license_scan._compiled()
    assert len(rules) > 400
    written = [line for table in (license_rules.NOTICES, license_rules.FURTHER, license_rules.NAMES) for line in table.strip().splitlines()]
    assert len({line.split(" | ", 3)[3] for line in written}) == len(written) > 300


def test_suppression_by_containment():
    # rule, start, end: a later rule inside an earlier one's interval goes, an overlapping one stays
    assert license_scan.suppressed([(0, 0, 10), (1, 2, 5), (2, 8, 12), (0, 20, 30), (3, 20, 30)]) == [(0, 0, 10), (2, 8, 12), (0, 20, 30)]

    def slow(found):
        kept = []
        for rule, s, e in sorted(found, key=lambda d: (d[0], d[1], -d[2])):
            if not any(a <= s and e <= b for _, a, b in kept):
                kept.append((rule, s, e))
        return sorted(kept, key=lambda d: (d[1], d[2], d[0]))

    r = random.Random(1)
    for _ in range(200):
        found = [(r.randint(0, 4), s := r.randint(0, 30), s + r.randint(1, 10)) for _ in range(r.randint(0, 25))]
        assert license_scan.suppressed(found) == slow(found)


def test_method_labels():
    labels = lambda t: license_scan.scan(t.encode())[5].split(",")
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]
    assert labels("Licensed under the Apache License, Version 2.0") == ["apache", "apache-2.0"]
    assert "cc-by-sa-4.0" in labels("CC BY-SA 4.0") and "cc-by" in labels("CC BY-SA 4.0")
    assert license_scan.scan(b"nothing to see")[6] == 0.0


def said_by(regex):
    """Texts made from every alternative of a regex, what is optional left out and taken."""
    from re import _parser

    def texts(parsed):
        out = [""]
        for op, arg in parsed:
            match str(op):
                case "LITERAL":
                    more = [chr(arg)]
                case "IN":
                    more = [chr(a) for o, a in arg if str(o) == "LITERAL"] or ["7"]
                case "MAX_REPEAT":
                    more, some = [], texts(arg[2])
                    for n in range(arg[0], min(int(arg[1]), max(arg[0], 1)) + 1):
                        more += [x * n for x in some]
                case "SUBPATTERN":
                    more = texts(arg[-1])
                case "BRANCH":
                    more = [x for branch in arg[1] for x in texts(branch)]
                case "ASSERT" | "ASSERT_NOT":
                    more = [""]
            out = list(dict.fromkeys(a + b for a in out for b in more))
        return out

    return texts(_parser.parse(regex.replace(r"\S", "7").replace(r"\w", "7")))


def test_keywords_lose_no_alternative():
    rules, _, _ = license_scan._compiled()
    for k, (label, _, _, look) in enumerate(rules):
        regex = license_scan.table()[k][3]
        for text in said_by(regex):
            line = f" x {text} version x " if "(?=" in regex else f" x {text} x "
            assert look.search(line), (label, text)
            every = [(n, m.start(), m.end()) for n, r in enumerate(rules) for m in r[3].finditer(line)]
            place = lambda at: line.count(" ", 0, at)  # noqa: B023, E731
            want = [(n, rules[n][0], place(a - 1), place(b), rules[n][1]) for n, a, b in license_scan.suppressed(every)]
            assert license_scan.scan(line.encode())[7] == want, (label, text)
    for text, label in (("same terms as perl itself", "artistic-1.0"), ("freebsd license", "bsd-2-clause"), ("Creative Commons Attribution-ShareAlike", "cc-by-sa"), ("for noncommercial use only", "non-commercial")):
        assert label in license_scan.scan(text.encode())[5].split(","), text


def test_license_query(spark, tmp_path):
    rows = odd_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(LICENSE_TEXTS)]
    got = license_scan.query(spark, store(spark, tmp_path, documents=frame(spark, rows))).collect()
    want = Counter((i, *base_scan(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 for r in got)


TOKEN_TEXTS = ["a<|endoftext|>b  <|startoftext|>", "\u0130stanbul \u03a3\u0391\u03a3 e\u0301 \ufb01 x\x1cy don't 'sun", "'s's", "\u65e5\u672c\u8a9e \ud55c\uad6d\uc5b4 \u0661\u0662 12345", "\U0001f600\U0001f600!!", "a\u00a0b\u2003c\x85d"]


def test_token_counts(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = odd_rows() + [(200 + i, x, "en", "a", 0) for i, x in enumerate(TOKEN_TEXTS)]
    got = token_counts.query(spark, store(spark, tmp_path, documents=frame(spark, rows))).collect()
    n = lambda x: len(t.encode(x or "", add_special_tokens=False).ids)
    want = Counter((i, len((x or "").encode()), n(x), n(x) > 2048) for i, x, *_ in rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_token_memory_changes_nothing(monkeypatch):
    from pathlib import Path

    spec = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    whole = token_counts.prove(spec)
    text = prose(9, 3000)
    n = token_counts.Counter(spec, whole).count(text)
    monkeypatch.setattr(token_counts, "MEMORY", 7)
    assert token_counts.Counter(spec, whole).count(text) == n
    assert token_counts.Counter(spec, frozenset()).count(text) == n  # the shortcut only saves work


def rule_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)]


def test_rule_statistics():
    r = random.Random(2)
    texts = [t for _, t, *_ in odd_rows()] + ["a b\na b\n\n \na b", "#$ <x> | % & *", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g h a"]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(150)]
    for t in texts:
        assert quality_rules.statistics(None if t is None else t.encode())[0] == rule_stats(t)


def junk(i, words):
    kind = i % 4
    if kind == 0:
        return " ".join(w + "#%$"[i // 4 % 3] * 3 for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 2:
        return "\n".join(" | ".join(words[k : k + 4]) for k in range(0, len(words), 4))
    return " ".join(f"{w} {w} {w} {w}" for w in words[: len(words) // 2])


def labelled(n=640):
    """Every eighth text is junk of one of four kinds."""
    docs, labels = [], []
    for i in range(n):
        text = prose(i, 40 + i * 7 % 160)
        text = junk(i // 8, text.split()) if i % 8 == 0 else text
        docs.append((i, text, "en", "a", len(text)))
        labels.append((i, int(i % 8 > 0), 0))
    return docs, labels


def slow_path(forest, root, row):
    """The path of one row through one tree, step by step."""
    at = root
    while forest.feature[at] >= 0:
        at = forest.left[at] + (row[forest.feature[at]] >= forest.cut[at])
    return forest.path[at]


def test_forest_against_single_steps():
    r = np.random.default_rng(3)
    x, good = r.normal(size=(300, 5)), np.arange(300) % 9 > 0
    x[~good] += 6
    x[:, 4] = 1.0  # never split
    forest = quality_rules.grow(x, good, trees=30, subsample=64)
    mean = [sum(slow_path(forest, root, row) for root in forest.roots) / len(forest.roots) for row in x]
    h = lambda n: sum(1 / k for k in range(1, n))
    usual = 2 * h(64) - 2 * 63 / 64
    assert abs(forest.scale - usual) < 0.02 and 4 not in forest.feature
    assert np.allclose(forest.scores(x), [2 ** (-m / forest.scale) for m in mean], rtol=1e-12)
    assert forest.scores(x)[~good].mean() > forest.scores(x)[good].mean() + 0.1
    for root in forest.roots:  # every row ends in a leaf, no deeper than allowed
        assert all(0 < slow_path(forest, root, row) <= 6 + 4 + 12 for row in x)


def test_threshold_comes_from_rows_that_grew_no_tree():
    r = np.random.default_rng(4)
    x, good = r.normal(size=(800, 3)), np.arange(800) // 2 % 5 > 0
    x[~good] += 5
    first = quality_rules.fit(x, good, np.ones(800, bool))
    assert first.threshold == quality_rules.calibrate(first.scores(x[1::2]), good[1::2])
    changed = good.copy()
    changed[::2] = True  # other labels among those that grow
    assert np.isfinite(first.threshold) and np.isfinite(quality_rules.fit(x, changed, np.ones(800, bool)).threshold)
    changed = good.copy()
    changed[1::2] = True  # nothing to calibrate on
    assert quality_rules.fit(x, changed, np.ones(800, bool)).threshold == np.inf
    ordered = np.sort(first.scores(x[1::2][good[1::2]]))
    assert (ordered > first.threshold).sum() <= quality_rules.FALSE_REJECTS * len(ordered)


def test_quality_rules_query(spark, tmp_path):
    docs, labels = labelled()
    rows = docs + [(i if i is None else i + 1000, *rest) for i, *rest in odd_rows()]
    labels += [(None, 1, 0), (3, 1, 0), (5000, 1, 0), (1, None, None)]
    d = store(spark, tmp_path, documents=frame(spark, rows), labels=frame(spark, labels, "doc_id long, quality int, toxic int"))
    got = quality_rules.query(spark, d).collect()
    want = Counter((i, *(s := rule_stats(t)), s[0] < 20 or 100 * s[4] > 30 * s[0]) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    own = {r.doc_id: r.kept for r in got if r.doc_id is not None and r.doc_id < 1000}
    assert sum(own[i] for i in range(0, 640, 8)) <= 12 and sum(own[i] for i in range(640) if i % 8) >= 550


def test_quality_rules_without_labels(spark, tmp_path):
    none = frame(spark, [], "doc_id long, quality int, toxic int")
    d = store(spark, tmp_path, documents=frame(spark, odd_rows()), labels=none)
    assert all(r.kept != r.base_failed for r in quality_rules.query(spark, d).collect())
    d = store(spark, tmp_path, documents=frame(spark, []), labels=none)
    assert quality_rules.query(spark, d).count() == 0


def test_quality_rules_stage_keeps_columns(spark):
    from .cases import with_clashes

    docs, labels = labelled(160)
    df = with_clashes(frame(spark, docs))
    out = quality_rules.keep_good(df, frame(spark, labels, "doc_id long, quality int, toxic int"))
    assert out.columns == df.columns and out.where("_quality = 'extra'").count() == out.count() > 100


def test_quality_rules_learn_from_all_labelled_rows(spark):
    """Leaves and threshold of 7,000 labelled rows, more than were once taken, by hand over each of them."""
    docs, labels = [], []
    for i in range(7000):
        words = prose(i, 22 + i % 15).split()
        docs.append((i, junk(i // 9, words) if i % 9 == 0 else " ".join(words), "en", "a", 0))
        labels.append((i, int(i % 9 > 0), 0))
    df, told = frame(spark, docs), frame(spark, labels, "doc_id long, quality int, toxic int")
    forest = quality_rules.fitted(df, told)
    judges = {r[0]: r[1] == 1 for r in df.selectExpr("doc_id", "xxhash64(doc_id) & 1").collect()}
    judges = np.array([judges[i] for i in range(7000)])
    both = [quality_rules.statistics(t.encode()) for _, t, *_ in docs]
    x, good = np.array([f for _, f in both]), np.array([q == 1 for _, q, _ in labels])
    passed = np.array([not (b[0] < 20 or 100 * b[4] > 30 * b[0]) for b, _ in both])

    ends = Counter()
    for row, usual in zip(x[~judges], good[~judges], strict=True):
        for root in forest.roots:
            at = root
            while forest.feature[at] >= 0:
                at = forest.left[at] + (row[forest.feature[at]] >= forest.cut[at])
            ends[at, bool(usual)] += 1
    n_good, n_rest = (good & ~judges).sum(), (~good & ~judges).sum()
    leaves = np.nonzero(forest.feature < 0)[0]
    assert quality_rules.tree_rows(n_good, n_rest) == (243, 13)
    mass = [ends[at, True] * 243 / n_good + ends[at, False] * 13 / n_rest for at in leaves]
    usual_path = [0.0, 1.0, *(2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n for n in range(3, 257))]
    assert np.allclose(forest.path[leaves], forest.depth[leaves] + np.interp(mass, range(1, 257), usual_path), rtol=1e-12)
    assert sum(ends.values()) == len(forest.roots) * (~judges).sum()
    at = judges & passed
    assert forest.threshold == quality_rules.calibrate(forest.scores(x[at]), good[at]) < np.inf

    # rows repeated, in other places, change nothing: one id of 400 rows among them
    again = quality_rules.fitted(df.union(df.limit(50)).union(df.where("doc_id = 5").selectExpr("*", "explode(sequence(1, 400)) k").drop("k")).repartition(5), told.repartition(3))
    for name in ("feature", "cut", "left", "path", "threshold"):
        assert np.array_equal(getattr(again, name), getattr(forest, name)), name


def test_draws_of_trees_are_of_all_rows(spark):
    r = random.Random(6)
    rows = [(r.randrange(-(2**63), 2**63), [float(i)] * len(quality_rules.FEATURES), i % 4 > 0) for i in range(5000)]
    got = quality_rules.drawn_rows(spark.createDataFrame(rows, "key long, x array<double>, good boolean"), (1250, 3750), (13, 243), "good", trees=40)

    def mixed(z):
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        return z ^ z >> 31

    seeds = np.random.default_rng(quality_rules.SEED).integers(0, 2**64, 40, dtype=np.uint64)
    drawn = set()
    for seed, own in zip(seeds, got, strict=True):
        ranked = sorted(rows, key=lambda row: mixed(row[0] % 2**64 ^ int(seed)))
        want = [row[1][0] for row in ranked if row[2]][:243] + [row[1][0] for row in ranked if not row[2]][:13]
        assert own[:, 0].tolist() == want
        drawn.update(want)
    assert len(drawn) > 3500  # each tree has other rows
    few = quality_rules.drawn_rows(spark.createDataFrame(rows[:8], "key long, x array<double>, good boolean"), (2, 6), (0, 6), "good", trees=3)
    assert [sorted(own[:, 0]) for own in few] == [[1, 2, 3, 5, 6, 7]] * 3


@pytest.mark.parametrize("n, share, kinds", [(3000, 0.1, 10**6), (3000, 0.1, 40), (700, 1.0, 10**6), (50, 0.0, 10**6), (0, 0.5, 1), (2, 0.5, 3)])
def test_threshold_in_the_cluster(spark, n, share, kinds):
    r = np.random.default_rng(n)
    scores, good = (r.integers(0, kinds, n) + 1) / (kinds + 1), r.random(n) >= share
    stored = spark.createDataFrame(list(zip(good.tolist(), scores.view(np.int64).tolist(), strict=True)), "good boolean, bits long")
    for rejects in (quality_rules.FALSE_REJECTS, 0.0, 0.2):
        assert quality_rules.threshold(stored, rejects) == quality_rules.calibrate(scores, good, rejects)


def test_quality_rules_of_one_kind_of_label(spark):
    """Without good rows, and with good rows only, the base rules decide alone."""
    docs, _ = labelled(120)
    for q in (0, 1):
        forest = quality_rules.fitted(frame(spark, docs), frame(spark, [(i, q, 0) for i in range(120)], "doc_id long, quality int, toxic int"))
        assert forest.threshold == np.inf and len(forest.roots) == quality_rules.TREES
