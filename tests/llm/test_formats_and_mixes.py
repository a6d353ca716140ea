import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.llm import chat_format, mixing, quality_nb, url_filter
from gridlens.llm import queries as Q

from .cases import frame, odd_rows, prose, store, with_clashes

CONV = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "system", "be kind"), (1, 1, "user", "### user: hi </turn>\n\\h \\\\b <x> #"), (1, 2, "assistant", "first \u00e9\U0001f600\n</turn>\n### assistant: no"),
    (2, 1, "assistant", "b"), (2, 0, "user", None), (2, 1, "assistant", "a"), (2, 2, None, "none"), (None, 0, "user", "lost"), (None, 1, "assistant", ""),
    (3, None, "assistant", "early"), (3, 5, "a: b", "odd role"), (4, 0, "assistant", "x" * 5000 + "\\"), (5, 0, "user", "only"),
]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_chat_query(spark, tmp_path):
    got = chat_format.query(spark, store(spark, tmp_path, conversations=with_clashes(frame(spark, TALK, CONV)))).collect()
    planted = r"\### Assistant: </turn> ok"
    convs = defaultdict(list)
    for c, t, r, x in [*TALK, (-7, 0, "user", planted), (-7, 1, "assistant", planted)]:
        convs[c].append((t is not None, t or 0, r is not None, r or "", x or ""))
    want = set()
    for c, rows in convs.items():
        rows.sort()
        loss = "".join(x for *_, r, x in rows if r == "assistant")
        want.add((c, len(rows), digest("".join(f"{r}\n{x}\n" for *_, r, x in rows)), len(loss), digest(loss)))
    assert {tuple(r)[:5] for r in got} == want


def test_chat_empty(spark, tmp_path):
    got = chat_format.query(spark, store(spark, tmp_path, conversations=frame(spark, [], CONV))).collect()
    assert [r.conv_id for r in got] == [-7]


def test_events_fold(spark):
    log = [
        (1, 0, 0, "open", "user", "Hel"), (1, 0, 1, "delta", None, "lo"), (1, 1, 2, "open", "assistant", "bad "), (1, 1, 3, "delta", None, "answer"),
        (1, 2, 4, "open", "user", "thanks"), (1, 1, 5, "regenerate", None, "good "), (1, 1, 6, "delta", None, "answer"), (1, 0, 7, "edit", None, "Hello!"),
        (1, 2, 8, "open", "user", "again"), (1, 0, 9, "ping", None, "ignored"), (2, 0, 1, "delta", "user", "no open"), (2, 0, 0, "delta", None, None),
    ]
    df = frame(spark, log, "conv_id long, turn long, seq long, event string, role string, text string")
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.reconstruct(df).collect()}
    assert got == {(1, 0): ("user", "Hello!"), (1, 1): ("assistant", "good answer"), (1, 2): ("user", "again"), (2, 0): ("user", "no open")}
    out = chat_format.render(chat_format.reconstruct(df)).where("conv_id = 1").first()
    assert out.formatted == "### user: Hello!</turn>\n### assistant: good answer</turn>\n### user: again</turn>\n"
    assert [out.formatted[t.text_start : t.text_start + t.text_length] for t in out.turns if t.in_loss] == ["good answer"]


def slow_fold(log):
    """Events one after the other: what stands at the end, and each turn's first known role."""
    turns, roles = defaultdict(dict), {}
    for conv, turn, _, event, role, text in sorted(log, key=lambda e: (e[0], e[2])):
        own = turns[conv]
        if role is not None and event in (*chat_format.STARTS, "delta"):
            roles.setdefault((conv, turn), role)
        if event == "delta":
            own[turn] = own.get(turn, "") + (text or "")
        elif event in chat_format.STARTS:
            own[turn] = text or ""
            if event == "regenerate":
                for later in [k for k in own if k > turn]:
                    del own[later]
    return {(c, k): (roles.get((c, k), ""), x) for c, own in turns.items() for k, x in own.items()}


def test_random_events_fold(spark):
    """Logs of streamed deltas, edits and regenerations in any order of rows."""
    import random

    r = random.Random(15)
    log = []
    for conv in range(60):
        last = 0
        for seq in range(r.randint(1, 40)):
            kind = r.choice(["open", "delta", "delta", "delta", "edit", "regenerate", "ping"])
            turn = r.randint(0, last)
            last = min(last + (kind == "open"), 6)
            log.append((conv, turn, seq, kind, r.choice([None, "user", "assistant"]), r.choice([None, "a", "bc ", "### x: </turn>"])))
    r.shuffle(log)
    df = with_clashes(frame(spark, log, "conv_id long, turn long, seq long, event string, role string, text string"))
    got = {(x.conv_id, x.turn): (x.role, x.text) for x in chat_format.reconstruct(df).collect()}
    assert got == slow_fold(log) and len(got) > 60


def test_chat_plan_is_native(spark, sf_dir):
    for q in (chat_format.query, mixing.query):
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


URLS = [
    "http://a.example.net/en/1", "https://A.Example.NET/de/1", "http://example.net", "http://net/", "http://x.net/p?q#f", "http://example.com/de/x", "http://sub.example.com/de/",
    "http://example.com/en/", "http://w.org/fr/1", "http://w.org/de/1", "http://notexample.net/en/1", "no url", None, "://", "http://", "http://h.net#/x", "http://a.b/c://d.net/", "ftp://U:p@x.net:80/en/",
]


def slow_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:k].translate({c: c + 32 for c in range(65, 91)}), rest[k:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_rules(spark, tmp_path):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[3], "<html>"), (None, URLS[0], "")]
    got = url_filter.query(spark, store(spark, tmp_path, pages=frame(spark, rows, "page_id long, url string, html string"))).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter((i, *slow_rule(u)) for i, u, _ in rows)


def test_many_rules_are_joined(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "INLINE_RULES", 1)
    rows = frame(spark, [(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(rows).collect()}
    assert got == {(i, *slow_rule(u)) for i, u in enumerate(URLS)}


def test_aliases(spark):
    link = '<head><LINK href="{}" rel=canonical></head>'
    rows = [
        (1, "http://mirror.io/a", link.format("http://bad.net/a")), (2, "http://bad.net/a", ""), (3, "http://mirror.io/b", '<meta http-equiv="refresh" content="0; url=http://mirror.io/a/">'),
        (4, "http://ok.example.net/en/z", link.format("//bad.net/z")), (5, "http://bad.net/z", None), (6, "http://third.io/z", link.format("http://ok.example.net/en/z")),
        (7, "http://alone.io/", link.format("/self")), (8, "http://far.io/", None),
    ]
    redirects = frame(spark, [("http://far.io", "http://mirror.io/b"), (None, "http://x.y/")], "src_url string, dst_url string")
    got = {r.page_id: (r.verdict, r.by) for r in url_filter.judge(frame(spark, rows, "page_id long, url string, html string"), redirects=redirects).collect()}
    assert got == {1: ("block", "alias"), 2: ("block", "rule"), 3: ("block", "alias"), 4: ("allow", "rule"), 5: ("block", "rule"), 6: ("allow", "alias"), 7: ("allow", "default"), 8: ("block", "alias")}


def slow_judged(rows):
    """Verdicts by urllib and breadth-first search over all links."""
    import re
    from urllib.parse import urljoin

    def key(u):
        if not u or "://" not in u:
            return None
        host, path, *_ = slow_rule(u)
        return host + re.sub("/$", "", path) + (re.search(r"^[^?#]*(\?[^#]*)?", u)[1] or "") if host else None

    links = defaultdict(set)
    for _, u, html in rows:
        for tag in re.findall(r"<(?:link|meta)\b[^>]*>", html or "", re.I):
            if m := re.search(r"""href=["']?([^"'\s>]+)""", tag) if "canonical" in tag else re.search(r"""url=([^"'\s>]+)""", tag):
                a, b = key(u), key(urljoin(u, m[1].replace("&amp;", "&"))) if u else None
                if a and b:
                    links[a].add(b)
                    links[b].add(a)
    ruled = defaultdict(set)
    for _, u, _ in rows:
        if slow_rule(u)[2]:
            ruled[key(u)].add(slow_rule(u)[3])
    out = Counter()
    for i, u, _ in rows:
        host, path, rule, verdict = slow_rule(u)
        by = "rule" if rule else "default"
        if not rule and key(u):
            seen, todo = {key(u)}, [key(u)]
            while todo:
                todo += (new := links[todo.pop()] - seen)
                seen |= new
            if told := set().union(*(ruled[k] for k in seen)) if len(seen) > 1 else set():
                verdict, by = min(told), "alias"
        out[i, verdict, by] += 1
    return out


def test_aliases_against_search(spark):
    import random

    r = random.Random(13)
    hosts = ["a.io", "b.io", "c.net", "d.example.net", "example.com", "e.org"]
    paths = ["/", "", "/en/x", "/de/", "/fr/y/z", "/p/q?k=1&l=2", "/p/../en/x", "/de/a/b/c"]
    tos = ["b", "../x", "../../en/x", "./b/", "?k=1&amp;l=2", "/fr/y/./z", "//c.net/b", "http://a.io/en/x", "https://B.io/p/q?k=1&l=2#top", "b/../c?x=/../y", "#here", "mailto:x@y", "x/y/"]
    rows = []
    for i in range(400):
        tags = "".join(f'<link rel="canonical" href="{r.choice(tos)}">' if r.random() < 0.6 else f"<META http-equiv='refresh' content='5; url={r.choice(tos)}'>" for _ in range(r.choice([0, 0, 1, 1, 2, 3])))
        rows.append((i, None if i == 7 else f"http://{r.choice(hosts)}{r.choice(paths)}", None if i % 50 == 9 else f"<html>{tags}</html>"))
    df = with_clashes(frame(spark, rows, "page_id long, url string, html string")).withColumn("host", F.lit("extra")).withColumn("node", F.lit("extra"))
    got = Counter((x.page_id, x.verdict, x.by) for x in url_filter.judge(df).collect())
    assert got == slow_judged(rows) and sum(by == "alias" for *_, by in got) > 50


def test_relative_canonical_of_a_blocked_page(spark):
    rows = [(1, "http://m.io/dir/a", '<link rel="canonical" href="b">'), (2, "http://m.io/dir/b", '<link rel="canonical" href="http://bad.net/b">'), (3, "http://bad.net/b", "")]
    assert {r.verdict for r in url_filter.judge(frame(spark, rows, "page_id long, url string, html string")).collect()} == {"block"}


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    left, goal, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return goal | {s: level * w[s] for s in open_}
        for s in over:
            goal[s] = cap * sizes[s]
            left -= goal[s]
            open_.discard(s)
    return goal


def mix_rows():
    rows = odd_rows()
    for k, s in enumerate(["a", "b", "c", "\u00e9", "Z", "d"]):
        rows += [(5000 + 400 * k + i, prose(i, 5 + (i * 7) % 40), "en", s, 0) for i in range(40 + 60 * (k % 3))]
    return [*rows, (9999, "", "en", "nothing", 0)]


def test_mix(spark, tmp_path):
    rows = mix_rows()
    d = store(spark, tmp_path, documents=with_clashes(frame(spark, rows)))
    got = mixing.query(spark, d).collect()
    import re

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    goal = slow_targets(dict(sizes))
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((i, size(t), sizes[s]) for i, t, _, s, _ in rows)
    assert sorted({round(r.target, 6) for r in got}) == sorted({round(g, 6) for g in goal.values()})
    assert all(r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0) for r in got)
    assert Counter(got) == Counter(mixing.query(spark, d).collect())


def test_draw_follows_its_probability(spark):
    rows = [(i, "one two three", "en", "abc"[i % 3], 0) for i in range(9000)]
    got = mixing.plan(frame(spark, rows)).groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r.target) < 0.05 * r.target for r in got)


def test_rows_without_ids_are_drawn_one_by_one(spark):
    rows = [(None, f"{prose(i, 3)} w{i}", "en", "abc"[i % 3], 0) for i in range(3000)]
    got = mixing.plan(frame(spark, rows)).groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r.target) < 0.08 * r.target for r in got)
    out = mixing.emit(frame(spark, rows).withColumn("copy", F.lit("own")))
    assert out.columns[-1] == "copy" and {r.copy for r in out.select("copy").distinct().collect()} <= {1, 2}


def test_mix_emits_copies(spark):
    df = with_clashes(frame(spark, mix_rows()))
    plan = Counter({r.doc_id: 0 for r in df.collect()})
    for r in mixing.plan(frame(spark, mix_rows())).collect():
        plan[r.doc_id] += r.copies
    out = mixing.emit(df)
    assert out.columns == [*df.columns, "copy"]
    assert Counter(r.doc_id for r in out.collect()) == +plan
    assert mixing.emit(df.limit(0)).count() == 0


def test_nb_learns_and_holds_out(spark, tmp_path):
    from zlib import crc32

    docs, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        text = " ".join(w.upper() + "!!" for w in prose(i, 40).split()) if bad else prose(i, 40)
        docs.append((i, text, "en", "a", 0))
        labels.append((i, 0 if bad else 1, 0))
    docs += [(i if i is None else i + 1000, *rest) for i, *rest in odd_rows()]
    labels += [(None, 1, 1), (7, None, None)]
    d = store(spark, tmp_path, documents=with_clashes(frame(spark, docs)), labels=frame(spark, labels, "doc_id long, quality int, toxic int"))
    got = quality_nb.query(spark, d).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    own = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in own)
    held = [r for r in own if r.held_out]
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    # labels of held out rows change nothing
    flipped = [(i, 1 - q if i is not None and q is not None and crc32(str(i).encode()) % 4 == 2 else q, x) for i, q, x in labels]
    d = store(spark, tmp_path, labels=frame(spark, flipped, "doc_id long, quality int, toxic int"))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert sorted(quality_nb.query(spark, d).collect(), key=key) == sorted(got, key=key)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_nb_without_both_classes(spark, tmp_path, labels):
    d = store(spark, tmp_path, documents=frame(spark, odd_rows()), labels=frame(spark, labels, "doc_id long, quality int, toxic int"))
    assert {r.predicted for r in quality_nb.query(spark, d).collect()} == {1}


def nb_rows(seed=0, n=60):
    r = np.random.default_rng(seed)
    good = np.arange(n) % 3 > 0
    return [np.unique(np.concatenate((r.integers(0, 40, 12), r.integers(40, 52, 3) if g else r.integers(48, 60, 3)))).astype(np.int32) for g in good], good


def test_log_count_ratios_against_counting():
    from math import log

    xs, good = nb_rows()
    got = quality_nb.log_count_ratios(xs, good)
    for f in range(60):
        p, q = (sum(f in x for x, g in zip(xs, good, strict=True) if g == side) for side in (True, False))
        want = log((p + 1) / (sum(good) + 2)) - log((q + 1) / (sum(~good) + 2)) if p + q >= 3 else 0.0
        assert abs(got[f] - want) < 1e-12
    assert not got[60:].any()


def test_dual_coordinate_descent_against_a_slow_solver():
    """The loss reached is that of projected gradient steps on the whole dual problem."""
    xs, good = nb_rows()
    r = quality_nb.log_count_ratios(xs, good)
    rows, values = quality_nb.scaled_rows(xs, r)
    v = np.zeros((len(xs), 61))
    for k, (x, each) in enumerate(zip(rows, values, strict=True)):
        v[k, x], v[k, 60] = each, 1.0
    y, most = np.where(good, 1.0, -1.0), quality_nb.bounds(good)
    k = (v @ v.T) * np.outer(y, y)
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(k).max()
    for _ in range(200_000):
        alpha = np.clip(alpha + step * (1 - k @ alpha), 0, most)
    least = alpha.sum() - alpha @ k @ alpha / 2

    def loss(w, bias):
        own = np.append(w[:60], bias)
        return own @ own / 2 + (most * np.maximum(0, 1 - y * (v @ own))).sum()

    assert abs(loss((v.T @ (alpha * y))[:60], (v.T @ (alpha * y))[60]) - least) < 1e-6
    assert 0 <= loss(*quality_nb.descend(rows, values, good, 5000, 1e-12)) - least + 1e-9 < 1e-6
    assert loss(*quality_nb.descend(rows, values, good)) < 1.02 * least
    m = quality_nb.fit_margin(xs, good)
    w, bias = quality_nb.descend(rows, values, good)
    assert np.allclose([m.margin(x) for x in xs], [w[x] @ each + bias for x, each in zip(rows, values, strict=True)], atol=1e-5)


def slow_features(text):
    """Every word and one to three shapes in a row, by plain string work."""
    import re
    from zlib import crc32

    stream, words, seen, last = [], set(), set(), None
    for line in text.split("\n"):
        for w in line.split():
            shape = re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w))
            stream.append(shape + ("=" if w == last else ""))
            last = w
            words.add(w.lower())
        if line.split():
            stream.append("\n=" if line in seen else "\n")
            seen.add(line)
    grams = {"\0".join(["s", *stream[k : k + n]]) for n in (1, 2, 3) for k in range(len(stream) - n + 1)}
    return sorted({crc32(x.encode()) % quality_nb.DIMENSIONS for x in grams | words})


def test_features_of_whole_words():
    features = quality_nb.Features()
    for text in ("Aa0-Aa0-Aa0-Aa0-x is Aa0-Aa0-Aa0-!!! here", "one one two\nTHREE 33\n\none one two\n", "x", "a" * 5000 + "-B" * 50):
        assert sorted(features(text.encode()).tolist()) == slow_features(text)
    assert features.shape(b"Aa0-Aa0-Aa0-Aa0-x") != features.shape(b"Aa0-Aa0-Aa0-!!!") and not len(features(None)) and not len(features(b" \n"))


def test_oracles_at_sf(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    for name, sql in Q.oracle_sql().items():
        df = Q.queries()[name](spark, sf_dir)
        cols = sorted(df.columns)
        n = lambda v: round(v, 6) if isinstance(v, float) else v
        got = Counter(tuple(n(v) for v in r) for r in df.select(*cols).collect())
        want = Counter(tuple(n(v) for v in r) for r in con.sql('select "' + '", "'.join(cols) + f'" from ({sql}) q').fetchall())
        assert got == want, name
