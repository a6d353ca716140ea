import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
from gridlens.llm import decontaminate, mixing, quality_rules, simhash, suffix_dedup

from .cases import frame, odd_rows, prose, store, with_clashes
from .test_counts_and_scans import rule_stats, slow_path
from .test_formats_and_mixes import slow_targets
from .test_groups import closure, slow_leaks


def corpus():
    docs, labels = [], []
    passage, item = prose(777, 70), prose(778, 30)
    for i in range(160):
        text = f"{prose(i, 80)}\n{prose(i + 1000, 60)}"
        if i % 8 == 0:
            text = " ".join(w + "%%%" for w in text.split())
        elif i % 8 == 1:
            text = f"{text} {passage} {prose(i + 2000, 15)}"
        elif i == 10:
            text = f"{text} {item}"
        docs.append((i, text, "en", "ab"[i % 2], len(text)))
        labels.append((i, int(i % 8 > 0), 0))
    docs += [(200, docs[2][1], "en", "a", 0), (201, docs[3][1].replace(docs[3][1].split()[40], "zz", 1), "en", "a", 0), (202, None, None, None, None)]
    return docs, labels, [(1, item)], passage


def test_run(spark, tmp_path):
    docs, labels, items, passage = corpus()
    d = store(spark, tmp_path, documents=frame(spark, docs), labels=frame(spark, labels, "doc_id long, quality int, toxic int"), benchmark=frame(spark, items, "item_id long, text string"))
    out = corpus_pipeline.run(spark, d)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert not ids & {10, 200, 201, 202}  # a leak, copies, an empty text
    assert sum(passage in t for t in {r.doc_id: r.text for r in rows}.values()) <= 1
    # step by step, each on what the one before left
    judged = quality_rules.judged(frame(spark, docs), quality_rules.fitted(frame(spark, docs), spark.read.parquet(f"{d}/labels.parquet")))
    good = {r.doc_id for r in judged.where("_quality.kept").collect()}
    assert ids <= good and len(good) >= 130
    left = frame(spark, docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, d)
        assert after.columns == left.columns, name
        left = spark.createDataFrame(after.collect(), after.schema)
    plan = {r.doc_id: r.copies for r in mixing.plan(left).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({k: v for k, v in plan.items() if v})


def last_if_none(i):
    return 2**63 - 1 if i is None else i


def slow_good(rows, forest):
    """Rows that pass the base rules and whose mean path, tree by tree, is long enough."""
    out = []
    for row in rows:
        n, _, _, _, repeated = rule_stats(row[1])
        x = quality_rules.statistics(None if row[1] is None else row[1].encode())[1]
        path = sum(slow_path(forest, root, x) for root in forest.roots) / len(forest.roots)
        if n >= 20 and 100 * repeated <= 30 * n and 2 ** (-path / forest.scale) <= forest.threshold:
            out.append(row)
    return out


def slow_one_of_each(rows):
    """Of every class of texts alike in five-word shingles, by all pairs, the row of the least id (then of the least digest of the text)."""
    sets = {r[1]: {*simhash.shingle_set((r[1] or "").encode()).tolist()} for r in rows}
    texts = sorted(sets, key=lambda t: t or "")
    number = {t: k for k, t in enumerate(texts)}
    links = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[texts[a]] & sets[texts[b]]) >= 0.8 * len(sets[texts[a]] | sets[texts[b]])]
    comp, best = closure(range(len(texts)), links), {}
    for r in rows:
        c = comp[number[r[1]]]
        key = (r[0] is None, last_if_none(r[0]), hashlib.md5((r[1] or "").encode()).hexdigest())
        best[c] = min(best.get(c, (key, r)), (key, r), key=lambda x: x[0])
    return [r for _, r in best.values()]


def slow_cut(spark, rows, least=50):
    """Texts without the words of windows that occur earlier."""
    ties = {r[:2]: suffix_dedup.with_ids(frame(spark, [r[:2]], "doc_id long, text string")).first().tie for r in rows}
    where = defaultdict(list)
    for r in sorted(rows, key=lambda r: (last_if_none(r[0]), ties[r[:2]])):
        w = (r[1] or "").lower().split()
        for k in range(len(w) - least + 1):
            where[tuple(w[k : k + least])].append((r[:2], k))
    gone = defaultdict(set)
    for found in where.values():
        for d, k in found[1:]:
            gone[d].update(range(k, k + least))
    out = []
    for r in rows:
        cut = gone.get(r[:2])
        if cut:
            text = re.match(r"\s*", r[1])[0] + "".join(w for k, w in enumerate(re.findall(r"\S+\s*", r[1])) if k not in cut)
            if not text.strip():
                continue
            r = (r[0], text, *r[2:4], len(text))
        out.append(r)
    return out


def slow_mix(rows):
    """How often each row is taken."""
    sizes, out = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    goal = slow_targets(dict(sizes))
    for r in rows:
        rate = goal[r[3]] / sizes[r[3]] if sizes[r[3]] else 0.0
        seed = str(r[0]) if r[0] is not None else hashlib.md5((r[1] or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix:{seed}".encode()).hexdigest()[:13], 16) / 16**13
        out[r] += int(rate) + (u < rate - int(rate))
    return +out


def test_run_against_brute_force(spark, tmp_path):
    """Each stage done by hand on what the one before left: repeated rows, rows without an id, of one id, and very long ones among them."""
    docs, labels, items, passage = corpus()
    long_tail = [(None, f"{prose(3000 + k, 70)} {passage if k == 1 else prose(3100 + k, 40)}", "en", "b", 0) for k in range(4)]
    docs += [*long_tail, long_tail[0], docs[5], *odd_rows(), (7, f"{prose(3200, 60)} {passage}", "en", "a", 0), (7, prose(3201, 200), "en", None, 0)]
    docs += [(300 + k, f"{prose(3300, 100)} {prose(3301 + k, 10)}", "en", "a", 0) for k in range(3)]
    d = store(spark, tmp_path, documents=frame(spark, docs), labels=frame(spark, labels, "doc_id long, quality int, toxic int"), benchmark=frame(spark, items, "item_id long, text string"))
    forest = quality_rules.fitted(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    good = slow_good(docs, forest)
    one = slow_one_of_each(good)
    cut = slow_cut(spark, one)
    leaked = {r for r in cut if slow_leaks([r], items)}
    want = slow_mix([r for r in cut if r not in leaked])
    got = Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, d).collect())
    assert got == want
    assert len(docs) > len(good) > len(one) and leaked and any(r not in one for r in cut) and any(r[0] is None for r in want)


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_copies", "repeated_passages", "benchmark", "mix"]
    for m in (quality_rules, simhash, suffix_dedup, decontaminate, mixing):
        assert m in (corpus_pipeline.__dict__[m.__name__.rpartition(".")[2]],)


def test_empty_tables_and_extra_columns(spark, tmp_path):
    docs, labels, items, _ = corpus()
    full, none = with_clashes(frame(spark, docs)), frame(spark, [])
    d = store(spark, tmp_path, labels=frame(spark, [], "doc_id long, quality int, toxic int"), benchmark=frame(spark, [], "item_id long, text string"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, d).count() == 0
        assert set(full.columns) <= set(stage(spark, full, d).columns)
