import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from gridlens.llm import decontaminate, simhash, suffix_dedup
from gridlens.llm.common import Scratch, components

from .cases import frame, odd_rows, prose, store, with_clashes


def closure(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100, 100), (None, 5)]
    chain = [(200 + i, 201 + i) for i in range(40)]
    star = [(300, 301 + i) for i in range(50)]
    e = links + chain + star
    got = {x.node: x.component for x in components(frame(spark, e, "a long, b long"), Scratch(spark, "t")).collect()}
    nodes = {x for ab in e for x in ab if None not in ab}
    assert got == closure(nodes, [ab for ab in e if None not in ab])


def test_components_of_nothing(spark):
    assert components(frame(spark, [], "a long, b long"), Scratch(spark, "t")).count() == 0


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def near_rows():
    r = random.Random(3)
    rows = odd_rows()
    for k in range(12):
        base = prose(50 + k, 400).split()
        for j in range(5):
            w = list(base)
            for _ in range(j):
                w[r.randrange(len(w))] = "zzz"
            rows.append((1000 + 10 * k + j, " ".join(w), "en", "a", 0))
    return rows


def test_simhash_query(spark, tmp_path):
    rows = near_rows()
    got = simhash.query(spark, store(spark, tmp_path, documents=with_clashes(frame(spark, rows)))).collect()
    prints = [(i, slow_print(t)) for i, t, *_ in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{p:016x}") for i, p in prints)
    distinct = sorted({p for _, p in prints})
    comp = closure(distinct, [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[comp[p]].append(i)
    want = Counter((i, min(least[comp[p]], default=i)) for i, p in prints)
    assert Counter((r.doc_id, r.component_id) for r in got) == want


def test_links_at_every_distance(spark):
    """Pairs at distances 1 to 5 with bits anywhere: linked up to 3, and only then."""
    r = random.Random(4)
    prints, far = [], 0
    for k in range(120):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), 1 + k % 5):
            b ^= 1 << bit
        prints += [a, b]
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = {frozenset(x) for x in simhash.link_stars(frame(spark, [(p,) for p in signed], "fp long"), Scratch(spark, "t")).collect()}
    pairs = {frozenset((signed[i], signed[i + 1])) for i in range(0, 240, 2) if (prints[i] ^ prints[i + 1]).bit_count() <= 3}
    assert found == pairs and far == 0


def test_simhash_empty(spark, tmp_path):
    assert simhash.query(spark, store(spark, tmp_path, documents=frame(spark, []))).count() == 0


def test_keep_one(spark):
    rows = near_rows() + [(2000, prose(70, 300), "en", "a", 0), (2001, prose(70, 300), "en", "a", 0), (2002, prose(71, 300), "en", "a", 0)]
    df = with_clashes(frame(spark, rows))
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[2000] == 1 and 2001 not in ids and ids[2002] == 1
    assert ids[1] + ids[2] == 1 and ids[6] == 1 and ids[7] == 2  # null and empty are one text; a repeated row is one; equal ids of other texts stay
    for k in range(12):  # up to four words of 400 changed: similar enough for most
        assert 1000 + 10 * k in ids and sum(1000 + 10 * k + j in ids for j in range(5)) <= 2


def edited(base, n, r):
    """A copy of the words ``base`` with n of them replaced, far apart."""
    w = list(base)
    for k in r.sample(range(len(w) // 6), n):
        w[6 * k + 2] = f"edit{r.getrandbits(40)}"
    return w


def test_keep_one_of_copies_alike_to_their_base_only(spark):
    """Copies at 0.82 or more to their base and less to each other: whatever hub is taken first, the base-copy pairs are tested."""
    r, rows = random.Random(8), []
    for k in range(3):
        base = prose(300 + k, 300).split()
        rows += [(1000 * k + j, " ".join(edited(base, 5 if j else 0, r)), "en", "a", 0) for j in range(60)]
    alike = lambda a, b: simhash.jaccard(simhash.shingle_set(a.encode()), simhash.shingle_set(b.encode()))
    assert alike(rows[0][1], rows[1][1]) >= 0.8 > alike(rows[1][1], rows[2][1])
    assert sorted(x.doc_id for x in simhash.keep_one(frame(spark, rows)).collect()) == [0, 1000, 2000]


def test_links_close_the_rounds(spark, monkeypatch):
    """With no hub round at all, and with hubs that share least, every pair alike is still linked."""
    r = random.Random(9)
    base = prose(310, 300).split()
    texts = [(j, " ".join(edited(base, 5 if j else 0, r)).encode()) for j in range(12)]
    df = frame(spark, texts, "id long, text binary")
    for rounds, weigh in ((0, "weight"), (2, "-weight"), (1, "-weight")):
        monkeypatch.setattr(simhash, "HUB_ROUNDS", rounds)
        scratch = Scratch(spark, "t")
        live = simhash.buckets(df, scratch).selectExpr("h", "id", "n", "pos", f"{weigh} as weight")
        got = simhash.groups(live, df, scratch).collect()
        assert {x.node: x.component for x in got} == dict.fromkeys(range(12), 0), rounds


def test_keep_one_against_every_pair(spark):
    """Blocks appended, words edited, passages shared by all: what stays is what all pairs by brute force leave."""
    r, rows = random.Random(10), []
    common = prose(400, 80)
    for k in range(25):
        base = prose(401 + k, 250).split()
        rows.append((10 * k, " ".join(base), "en", "a", 0))
        rows.append((10 * k + 1, " ".join(base) + " " + prose(500 + k, 8 + 4 * (k % 16)), "en", "a", 0))
        rows.append((10 * k + 2, " ".join(edited(base, r.randint(1, 9), r)), "en", "a", 0))
        rows.append((10 * k + 3, prose(600 + k, 100 + 10 * k) + " " + common, "en", "a", 0))
    sets = {i: {*simhash.shingle_set(t.encode()).tolist()} for i, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(links) > 25 and any(10 * k + 1 not in {b for _, b in links} for k in range(25))
    want = closure(sets, links)
    assert sorted(x.doc_id for x in simhash.keep_one(frame(spark, rows)).collect()) == sorted({*want.values()})


def test_a_common_passage_makes_no_pairs(spark, monkeypatch):
    """Texts of which the greater part is one passage of all, but that are not alike, are never tested pair by pair."""
    common, met = prose(700, 200), []
    texts = [(k, f"{common} {prose(701 + k, 60)}".encode()) for k in range(40)]
    texts += [(100 + k, f"{common} {prose(760, 30)} w{k}".encode()) for k in range(40)]
    monkeypatch.setattr(simhash, "verified", lambda pairs, texts, f=simhash.verified: met.append(pairs.count()) or f(pairs, texts))
    df = frame(spark, texts, "id long, text binary")
    scratch = Scratch(spark, "t")
    assert {x.node for x in simhash.groups(simhash.buckets(df, scratch), df, scratch).collect()} == {*range(100, 140)}
    assert sum(met) <= 3 * 80


def test_keep_one_against_the_exact_join(spark, sf_dir):
    """All pairs of the given documents that are alike: as many documents stay as there are classes of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets = {}
    for r in docs.orderBy("doc_id").collect():
        sets.setdefault(frozenset(simhash.shingle_set((r.text or "").encode()).tolist()), r.doc_id)
    where = defaultdict(list)
    for s, i in sets.items():
        for h in s:
            where[h].append((i, s))
    links = {(min(a, b), max(a, b)) for found in where.values() for k, (a, s) in enumerate(found) for b, t in found[:k] if len(s & t) >= 0.8 * len(s | t)}
    want = {*closure(sets.values(), links).values()}
    assert {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()} == want


def slow_repeats(spark, rows, least):
    """Words in windows that occur twice, and in later ones, for each document (id, text)."""
    docs = {(2**63 - 1 if i is None else i, t or "") for i, t, *_ in rows}
    ties = {d: suffix_dedup.with_ids(frame(spark, [d], "doc_id long, text string")).first().tie for d in docs if sum(x[0] == d[0] for x in docs) > 1}
    places = {d: k for k, d in enumerate(sorted(docs, key=lambda d: (d[0], ties.get(d, 0))))}
    where = defaultdict(list)
    for d in docs:
        w = d[1].encode().lower().split()
        for k in range(len(w) - least + 1):
            where[tuple(w[k : k + least])].append((places[d], k, d))
    found, copied = defaultdict(set), defaultdict(set)
    for at in where.values():
        for n, (_, k, d) in enumerate(sorted(at) if len(at) > 1 else ()):
            found[d].update(range(k, k + least))
            if n:
                copied[d].update(range(k, k + least))
    return Counter((None if d[0] == 2**63 - 1 else d[0], len(found[d]), len(copied[d])) for d in found)


def passage_rows():
    shared, short = prose(900, 60), prose(901, 49)
    rows = [(i, f"{prose(i, 30)} {shared} {prose(i + 500, 20)}", "en", "a", 0) for i in range(20, 26)]
    rows += [(30, f"{prose(30, 10)} {short} {prose(31, 10)}", "en", "a", 0), (31, f"{prose(32, 10)} {short} {prose(33, 10)}", "en", "a", 0)]
    rows += [(40, f"{shared} {prose(41, 5)} {shared}", "en", "a", 0), (41, prose(42, 50).upper(), "en", "a", 0), (42, prose(42, 50), "en", "a", 0), (43, "a b " * 100, "en", "a", 0)]
    return rows


def test_repeated_passages(spark, tmp_path):
    rows = odd_rows() + passage_rows()
    got = suffix_dedup.query(spark, store(spark, tmp_path, documents=with_clashes(frame(spark, rows)))).collect()
    assert Counter((r.doc_id, r.repeated_words, r.cut_words) for r in got) == slow_repeats(spark, rows, 50)
    assert not {30, 31} & {r.doc_id for r in got}  # 49 words are no passage


@pytest.mark.parametrize("hot", [1, 5, 2000])
@pytest.mark.parametrize("letters", ["ab", "abc"])
def test_repeats_of_random_words(spark, hot, letters):
    """Buckets of every size in one task or cut among tasks, ids that come twice."""
    r = random.Random(6)
    rows = [(i // 2 if i < 20 else i, " ".join(r.choice(letters) for _ in range(r.randint(0, 120))), "en", "a", 0) for i in range(60)]
    rows += rows[30:33]  # repeated rows are one document
    df = frame(spark, rows)
    got = suffix_dedup.repeats(df, least=9, anchor=4, hot=hot).collect()
    size = lambda x: sum(s.end - s.start for s in x)
    assert Counter((x.doc_id, size(x.spans), size(x.copies)) for x in got) == slow_repeats(spark, rows, 9)


def test_words_decide_not_hashes(monkeypatch):
    """With hashes that mostly agree the same passages are found."""
    r, found = random.Random(7), []
    texts = [[r.choice("abcd").encode() for _ in range(r.randint(20, 90))] for _ in range(25)]
    for hashes in (suffix_dedup.word_hashes, lambda w: np.array([x[0] & 1 for x in w], dtype=np.uint64)):
        monkeypatch.setattr(suffix_dedup, "word_hashes", hashes)
        rows = []
        for i, w in enumerate(texts):
            for _, at, near, far in zip(*suffix_dedup.retained(w, 9, 4), strict=True):
                rows.append((0, 1, i, 0, at, near, far, b"".join(x + b" " for x in w[at : at + 9 - near]), b"".join(x + b" " for x in w[at - far : at][::-1])))
        array = pd.DataFrame(rows, columns=["part", "parts", "doc", "tie", "at", "near", "far", "to_right", "to_left"]).sort_values("to_right", ignore_index=True)
        windows = suffix_dedup.windows_at(*suffix_dedup.extended(array, 9, 4), 9)
        found.append([{(d, at - k) for d, at, mask in zip(windows["doc"], windows["at"], windows[c], strict=True) for k in range(9) if mask >> k & 1} for c in ("own", "copied")])
    assert found[0] == found[1] and all(found[0])


def test_cut_repeats(spark):
    rows = odd_rows() + passage_rows()
    df = with_clashes(frame(spark, rows))
    out = suffix_dedup.cut_repeats(df)
    assert out.columns == df.columns
    kept = {r.doc_id: r.text for r in out.where("doc_id between 20 and 50").collect()}
    shared = prose(900, 60)
    assert sum(shared in t for t in kept.values()) == 1 and shared in kept[20]
    assert kept[21] == f"{prose(21, 30)} {prose(521, 20)}" and kept[30] == rows[[x[0] for x in rows].index(30)][1]
    assert 42 not in kept  # nothing was left of it
    lengths = {r.doc_id: r.n_chars for r in out.where("doc_id = 21").collect()}
    assert lengths[21] == len(kept[21])


def test_cut_repeats_cuts_only_its_own_row(spark):
    """Of rows of equal id, or of none, one holds a repeated passage: the others stay as they are."""
    passage, whole = prose(910, 60), [prose(911 + k, 200) for k in range(3)]
    rows = [(1, f"{passage} {prose(920, 30)}", "en", "a", 0)]
    for i in (7, None):
        rows += [(i, f"{prose(930, 80)} {passage}" if i else f"{prose(931, 80)} {passage}", "en", "a", 0), (i, whole[0 if i else 1], "en", "a", 0)]
    rows += [(None, whole[2], "en", "a", 0), (None, whole[2], "en", "a", 0)]
    out = Counter((r.doc_id, r.text) for r in suffix_dedup.cut_repeats(frame(spark, rows)).collect())
    assert out[1, rows[0][1]] == 1 and out[7, whole[0]] == 1 and out[None, whole[1]] == 1
    assert out[None, whole[2]] == 2  # rows that agree in id and text are one document
    assert {len(t.split()) for (i, t), _ in out.items() if t not in whole and i != 1} == {80}


def test_cut_repeats_inside_longer_ones(spark):
    """P stands in A; B and C share X P Y: P goes from B, and C loses all of it."""
    x, p, y = prose(940, 30), prose(941, 60), prose(942, 30)
    rows = [(1, f"{prose(943, 40)} {p}", "en", "a", 0), (2, f"{prose(944, 40)} {x} {p} {y}", "en", "a", 0), (3, f"{prose(945, 40)} {x} {p} {y}", "en", "a", 0)]
    out = {r.doc_id: r.text.split() for r in suffix_dedup.cut_repeats(frame(spark, rows)).collect()}
    assert len(out[1]) == 100 and " ".join(out[2]) == f"{prose(944, 40)} {x} {y}" and " ".join(out[3]) == prose(945, 40)


def test_repeats_of_nothing(spark, tmp_path):
    assert suffix_dedup.query(spark, store(spark, tmp_path, documents=frame(spark, []))).count() == 0


ITEMS = [
    (1, "Anna has 12 apples and gives 5 apples to Ben who then eats 5 apples while walking slowly home again"),
    (2, "the quick river runs under seven bridges before it reaches the wide and silent southern sea tonight"),
    (3, "too short here"),
    (4, None),
]


def leak_docs():
    same = ITEMS[0][1]
    return [
        (1, f"{prose(1, 20)} {same} {prose(2, 20)}", "en", "a", 0),
        (2, f"{prose(3, 20)}. Carl has 7 apples and gives 3 apples to Dora who then eats 3 apples while walking slowly home again, {prose(4, 9)}", "en", "a", 0),
        (3, f"{prose(5, 20)} one two three has 12 pears and takes 5 plums from Ben as he eats 5 cakes while running slowly home again", "en", "a", 0),
        (4, ITEMS[1][1].upper().lower().replace("seven", "SEVEN"), "en", "a", 0),
        (5, prose(6, 200), "en", "a", 0),
        (6, " ".join(ITEMS[1][1].split()[:8]), "en", "a", 0),
        (7, "the quick river runs under seven bridges before it reaches the wide and silent southern sea today", "en", "a", 0),
        (7, f"{ITEMS[1][1]} {ITEMS[1][1]}", "en", "a", 0), (None, ITEMS[1][1], None, None, None),
        (8, "Carl has 1 apples and gives 2 apples to Dora who then eats 3 apples while Zoe eats 4 and Max eats 6 apples too", "en", "a", 0),
        (9, f"{prose(7, 9)} Carl has 7 apples and gives 3 apples to Dora who then very slowly eats 3 apples while walking home again", "en", "a", 0),
        (11, "Mary Ann van Dyk has 1,250 apples and gives 3.5 apples to Tom who then eats 3.5 apples while walking slowly home again", "en", "a", 0),
    ]


def cut_words(text):
    """(kind or None, lower-cased word) of every word."""
    words = re.findall(r"[0-9]+(?:[.,][0-9]+)+[^\s!-/:-@\[-`{-~]*|[^\s!-/:-@\[-`{-~]+", text or "", re.ASCII)
    kind = lambda w: "#" if w[0] in "0123456789" else "N" if w[0] != w[0].lower() else "u" if w.lower() in decontaminate.UNITS else None
    return [(kind(w), w.lower()) for w in words]


def slow_windows(text):
    """(tokens, values, first word, words) of the windows that count."""
    words, tokens = cut_words(text), []
    for k, (kind, w) in enumerate(words):
        if kind == "N" and tokens and tokens[-1][0] == "N" and tokens[-1][3] == k:
            tokens[-1] = ("N", w, tokens[-1][2], k + 1)
        else:
            tokens.append((kind, w, k, k + 1))
    out = [(tuple(w for _, w in words[i : i + 5]), tuple(w for _, w in words[i : i + 5]), i, 5) for i in range(len(words) - 4)]
    for i in range(len(tokens) - 4):
        part = tokens[i : i + 5]
        if 2 <= sum(kind is None for kind, *_ in part) <= 4:
            out.append((tuple((kind,) if kind else w for kind, w, *_ in part), tuple(w for _, w, *_ in part), part[0][2], part[-1][3] - part[0][2]))
    return len(words), out


def slow_leaks(docs, items):
    out = set()
    for item, text in items:
        n, known = slow_windows(text)
        half = max(-(-n // 5), 4)
        for doc, t, *_ in docs if n > 4 else ():
            met = [(p, span, at - p, tokens, said, vals) for tokens, vals, at, _ in slow_windows(t)[1] for known_tokens, said, p, span in known if tokens == known_tokens]
            for grid in (0, half):
                cells = defaultdict(list)
                for m in met:
                    cells[(m[2] + grid) // (2 * half)].append(m)
                for cell in cells.values():
                    votes = defaultdict(set)
                    for p, _, _, tokens, said, vals in cell:
                        for j, (x, s, v) in enumerate(zip(tokens, said, vals, strict=True)):
                            if isinstance(x, tuple):
                                votes[x, s, v].add((p, j, tokens, said))
                    yield_of = {}
                    for (x, s, v), places in votes.items():
                        yield_of.setdefault((x, s), []).append((len(places), v))
                    told = {k: {v for n_v, v in c if n_v == max(c)[0]} for k, c in yield_of.items()}
                    for pick in (min, max):
                        good = [m for m in cell if all(not isinstance(x, tuple) or v == pick(told[x, s]) for x, s, v in zip(m[3], m[4], m[5], strict=True))]
                        covered = {w for p, span, *_ in good for w in range(p, p + span)}
                        whole = {w for p, span, *_ in good for w in range(p, p + span - 4)}
                        if len(whole) >= 0.8 * (n - 4) or (n >= 12 and len(covered) >= 0.8 * n):
                            out.add((doc, item))
    return out


def test_leaks(spark, tmp_path):
    rows = leak_docs() + [r for r in odd_rows() if r[0] is None or r[0] > 7]
    d = store(spark, tmp_path, documents=with_clashes(frame(spark, rows)), benchmark=frame(spark, ITEMS, "item_id long, text string"))
    got = decontaminate.query(spark, d).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert pairs == slow_leaks(rows, ITEMS) == {(1, 1), (2, 1), (4, 2), (7, 2), (None, 2), (9, 1), (11, 1)}  # 8: values do not stand for values
    assert {(r.doc_id, r.item_id): r.changed_slots for r in got}[2, 1] == 4 and {(r.doc_id, r.item_id): r.share for r in got}[1, 1] == 1.0


def variants(words, r):
    """An item as it may come back: as it is, in one case, with other values, with a word changed, put in or left out."""
    plain = [k for k, w in enumerate(words) if w.islower() and w.isalpha()]
    k = r.choice(plain[2:-2])
    new = {w: f"{r.randint(1, 9)},{r.randint(100, 999)}" if w[0].isdigit() else r.choice(["Olga", "Mary Ann", "Ibrahim", "Lee"]) + r.choice(["", " Smith"]) for w in {w for w in words if not w.islower()}}
    yield "same", words
    yield "upper", [w.upper() for w in words]
    yield "lower", [w.lower() for w in words]
    yield "values", [new.get(w, w) for w in words]
    yield "word", [*words[:k], "otherword", *words[k + 1 :]]
    yield "more", [*words[:k], "one", "more", *words[k:]]
    yield "less", [*words[:k], *words[k + 1 :]]


def test_recall_of_changed_items(spark):
    r = random.Random(12)
    items, docs, kinds = [], [], {}
    for i in range(60):
        words = prose(3000 + i, r.randint(20, 59)).split()
        for k in range(r.randint(0, 3), len(words), r.randint(6, 9)):
            words[k] = r.choice(["12", "7", "450"]) if r.random() < 0.5 else r.choice(["Anna", "Ben", "Carl"])
        items.append((i, " ".join(words)))
        for kind, v in variants(words, r):
            kinds[len(docs)] = (kind, i)
            docs.append((len(docs), f"{prose(5000 + len(docs), 40)} {' '.join(v)} {prose(6000 + len(docs), 30)}"))
    clean = [(10_000 + k, prose(8000 + k, 150)) for k in range(60)]
    got = {(x.doc_id, x.item_id) for x in decontaminate.leaks(frame(spark, docs + clean, "doc_id long, text string"), frame(spark, items, "item_id long, text string")).collect()}
    met = Counter(kind for d, (kind, i) in kinds.items() if (d, i) in got)
    assert all(met[k] >= 54 for k in ("same", "upper", "lower", "values", "word", "more", "less")), met
    assert all(kinds.get(d, ("", None))[1] == i for d, i in got)


def test_leaks_in_one_case(spark):
    """Passages wholly in capitals or without any are found, whichever side is so written."""
    items = [*ITEMS[:2], (5, "THE OLD MILL OF ANNA STANDS NEAR 14 TALL TREES AND ITS WHEEL TURNS ALL NIGHT")]
    docs = [(20, f"{prose(1, 20)} {ITEMS[0][1].upper()} {prose(2, 20)}"), (21, f"{prose(3, 9)} {ITEMS[0][1].lower()}"), (22, f"{ITEMS[1][1].upper()}. {prose(4, 9)}"),
            (23, "The old mill of Anna stands near 14 tall trees and its wheel turns all night"), (24, prose(5, 90).upper())]
    found = decontaminate.leaks(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.share, r.changed_slots) for r in found} == {(20, 1, 1.0, 0), (21, 1, 1.0, 0), (22, 2, 1.0, 0), (23, 5, 1.0, 0)}


def test_long_texts_and_items_that_repeat_themselves(spark):
    items = [(1, "tick tock goes the clock " * 4), (2, prose(1, 40))]
    docs = [(1, "tick tock goes the clock " * 4000), (2, f"{prose(2, 30_000)} {items[1][1]} {prose(3, 10)}"), (3, "tick tock goes the other clock")]
    found = decontaminate.leaks(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.share) for r in found} == {(1, 1, 1.0), (2, 2, 1.0)}


def test_leak_plan_is_native(spark):
    out = decontaminate.clean(frame(spark, leak_docs()), frame(spark, ITEMS, "item_id long, text string"))
    plan = out._jdf.queryExecution().toString()
    whole = decontaminate.found(frame(spark, leak_docs()), frame(spark, ITEMS, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Pandas|Python|Arrow|BroadcastHash", plan + whole)


def test_clean_and_empty(spark):
    items, df = frame(spark, ITEMS, "item_id long, text string"), with_clashes(frame(spark, leak_docs() + [(None, prose(9, 60), None, None, None)]))
    out = decontaminate.clean(df, items)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter([3, 5, 6, 8, None])  # of the two without an id the one that holds an item goes
    assert decontaminate.leaks(df, items.limit(0)).count() == 0 and decontaminate.leaks(df.limit(0), items).count() == 0
    assert decontaminate.clean(df, items.limit(0)).count() == df.count()
