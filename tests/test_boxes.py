"""Hand-made boxes and brute-force twins of the folds."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlens.functions import geometry as G
from gridlens.operators import annotate as A
from gridlens.operators import boxes as B
from gridlens.operators import metrics as M

COLS = "img long, cls long, model long, cand long, score double, x1 double, y1 double, x2 double, y2 double"


def boxes(spark, rows):
    return spark.createDataFrame(rows, COLS)


def iou(a, b):
    w, h = max(0.0, min(a[2], b[2]) - max(a[0], b[0])), max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    size = lambda x: max(0.0, x[2] - x[0]) * max(0.0, x[3] - x[1])
    u = size(a) + size(b) - w * h
    return w * h / u if u > 0 else 0.0


def noise(seed, n, images=4):
    r = random.Random(seed)
    out = []
    for k in range(n):
        x, y = r.randint(0, 6) / 16, r.randint(0, 6) / 16
        out.append((r.randint(1, images), r.randint(0, 2), r.randint(0, 3), k, r.randint(0, 8) / 8, x, y, x + r.randint(0, 6) / 16, y + r.randint(1, 6) / 16))
    return out


def test_iou_by_hand(spark):
    one = (0.0, 0.0, 1.0, 1.0)
    cases = [(one, one, 1.0), (one, (2.0, 2.0, 3.0, 3.0), 0.0), (one, (1.0, 0.0, 2.0, 1.0), 0.0), (one, (0.0, 0.0, 0.5, 0.5), 0.25), ((0.0, 0.0, 0.0, 1.0),) * 2 + (0.0,), ((1.0, 1.0, 0.0, 0.0), one, 0.0)]
    df = spark.createDataFrame([(*a, *b, v) for a, b, v in cases], "x1 double, y1 double, x2 double, y2 double, b_x1 double, b_y1 double, b_x2 double, b_y2 double, want double")
    assert all(r.v == r.want for r in df.select(G.iou(G.box(), G.box("b_")).alias("v"), "want").collect())


def greedy(rows, key, order, test):
    out, kept = [], {}
    for b in sorted(rows, key=order):
        k = kept.setdefault(key(b), [])
        if not any(test(a, b) for a in k):
            k.append(b)
            out.append(b[3])
    return set(out)


@pytest.mark.parametrize("strict", [True, False])
def test_ties_and_thresholds(spark, strict):
    # two halves of a box: IoU exactly 1/2; equal scores, so the lower cand stays
    rows = [(1, 0, 0, 1, 0.5, 0.0, 0.0, 1.0, 1.0), (1, 0, 0, 2, 0.5, 0.0, 0.0, 0.5, 1.0), (1, 0, 0, 3, 0.25, 0.0, 0.0, 1.0, 1.0)]
    kept = {r.cand for r in B.greedy(boxes(spark, rows), ["img"], B.score_first(), B.over(0.5, strict)).collect()}
    assert kept == ({1, 2} if strict else {1})


def test_chain(spark):
    rows = [(1, 0, 0, 1, 0.9, 0.0, 0.0, 1.0, 1.0), (1, 0, 0, 2, 0.8, 0.4, 0.0, 1.4, 1.0), (1, 0, 0, 3, 0.7, 0.8, 0.0, 1.8, 1.0)]
    df = boxes(spark, rows)
    assert {r.cand for r in B.greedy(df, ["img"], B.score_first(), B.over(0.4)).collect()} == {1, 3}
    assert {r.cluster for r in B.clusters(df, ["img", "cls"], 0.4).collect()} == {1}


def test_size_aware_keeps_a_small_box_inside(spark):
    rows = [(1, 0, 0, 1, 0.9, 0.0, 0.0, 1.0, 1.0), (1, 0, 0, 2, 0.8, 0.0, 0.0, 0.6, 1.0), (1, 0, 0, 3, 0.7, 0.0, 0.0, 0.95, 1.0)]
    assert {r.cand for r in B.greedy(boxes(spark, rows), ["img", "cls"], B.score_first(), B.size_aware(0.5, 0.7)).collect()} == {1, 2}


@pytest.mark.parametrize("seed", range(4))
def test_folds_against_loops(spark, seed):
    rows = noise(seed, 120)
    df = boxes(spark, rows)
    by_score = lambda b: (-b[4], b[3])
    got = {r.cand for r in B.greedy(df, ["img", "cls"], B.score_first(), B.over(0.3)).collect()}
    assert got == greedy(rows, lambda b: b[:2], by_score, lambda a, b: iou(a[5:], b[5:]) > 0.3)
    up = {b[3]: b[3] for b in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in rows:
        for b in rows:
            if a[:2] == b[:2] and iou(a[5:], b[5:]) >= 0.3:
                x, y = find(a[3]), find(b[3])
                up[max(x, y)] = min(x, y)
    assert {r.cand: r.cluster for r in B.clusters(df, ["img", "cls"], 0.3).collect()} == {k: find(k) for k in up}


def slow_cross(rows, exempt, pairs, priority, threshold):
    out = set()
    for img in {b[0] for b in rows}:
        own = [b for b in rows if b[0] == img]
        first = {}
        for b in sorted(own, key=lambda b: (-b[4], b[3])):
            first.setdefault(b[1], len(first))
        own.sort(key=lambda b: (first[b[1]], -b[4], b[3]))
        lost = set()
        for i, a in enumerate(own):
            if a[3] in lost:
                continue
            for b in own[i + 1 :]:
                if b[3] in lost or a[1] == b[1] or a[1] in exempt or b[1] in exempt or {a[1], b[1]} in pairs or iou(a[5:9], b[5:9]) <= threshold:
                    continue
                rank = lambda c: (-c[9], priority.get(c[2], 99), -c[4])
                lost.add(a[3] if rank(b) < rank(a) else b[3])
        out |= {b[3] for b in own} - lost
    return out


@pytest.mark.parametrize("seed", range(4))
def test_cross_class_against_a_loop(spark, seed):
    r = random.Random(seed)
    rows = [(*b, r.randint(1, 3)) for b in noise(seed + 10, 90)]
    rows = [(b[0], r.randint(0, 4), *b[2:]) for b in rows]
    df = spark.createDataFrame(rows, COLS + ", agreement long")
    classes = spark.createDataFrame([(k, k == 3) for k in range(5)], "cls long, exempt boolean")
    models = spark.createDataFrame([(0, 2), (1, 0), (2, 1)], "model long, priority int")
    confusions = spark.createDataFrame([(0, 1)], "a long, b long")
    got = {x.cand for x in B.cross_class(df, classes, confusions, models, 0.3).collect()}
    assert got == slow_cross(rows, {3}, [{0, 1}], {0: 2, 1: 0, 2: 1}, 0.3)


def slow_average(rows, threshold):
    out = set()
    for img in {b[0] for b in rows}:
        own = sorted({(b[1], *b[5:]) for b in rows if b[0] == img})
        gone = set()
        for i, a in enumerate(own):
            if i in gone:
                continue
            m = a[1:]
            for j in range(i + 1, len(own)):
                if j not in gone and iou(a[1:], own[j][1:]) > threshold:
                    gone.add(j)
                    m = tuple((p + q) / 2 for p, q in zip(m, own[j][1:], strict=True))
            out.add((img, *m))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_average_merge_against_a_loop(spark, seed):
    rows = noise(seed + 20, 80)
    assert {tuple(r) for r in B.average_merge(boxes(spark, rows), ["img"], 0.4).collect()} == slow_average(rows, 0.4)


def slow_match(preds, truth, threshold):
    hits = set()
    for cls in {p[1] for p in preds}:
        taken = set()
        for p in sorted((p for p in preds if p[1] == cls), key=lambda p: (-p[4], p[3])):
            own = [g for g in truth if g[0] == p[0] and g[1] == cls]
            best = min(own, key=lambda g: (-iou(p[5:], g[3:]), g[2]), default=None)
            if best and iou(p[5:], best[3:]) >= threshold - 1e-6 and best[2] not in taken:
                taken.add(best[2])
                hits.add(p[3])
    return hits


def truths(seed, n):
    return [(b[0], b[1], b[3], *b[5:]) for b in noise(seed, n)]


TRUTH = "img long, cls long, gt long, x1 double, y1 double, x2 double, y2 double"


@pytest.mark.parametrize("seed", range(3))
def test_match_and_curve_against_loops(spark, seed):
    preds, truth = noise(seed + 30, 150), truths(seed + 40, 40)
    p, g = boxes(spark, preds), spark.createDataFrame(truth, TRUTH)
    m = M.match(p, g, 0.4)
    hits = slow_match(preds, truth, 0.4)
    assert {r.cand for r in m.where("tp").collect()} == hits
    curve = {r.cand: r for r in M.ranked(m, g).collect()}
    aps = {r.cls: r.ap for r in M.average_precision(M.ranked(m, g)).collect()}
    for cls in {b[1] for b in preds}:
        own, tp = sorted((b for b in preds if b[1] == cls), key=lambda b: (-b[4], b[3])), 0
        total = sum(t[1] == cls for t in truth)
        prec, rec = [], []
        for n, b in enumerate(own, 1):
            tp += b[3] in hits
            prec.append(tp / (n + 1e-6))
            rec.append(tp / (total + 1e-6))
            r = curve[b[3]]
            assert (r.rn, r.acc_tp) == (n, tp) and abs(r.precision - prec[-1]) < 1e-12
        ap, last = 0.0, 0.0
        for k in range(len(own)):
            ap += (rec[k] - last) * max(prec[k:])
            last = rec[k]
        assert abs(aps[cls] - ap) < 1e-9
        assert 0 <= ap <= 1


def test_second_choice(spark):
    """Two predictions with one best box: the second is wrong here, but right under the COCO protocol if another box fits."""
    truth = [(1, 0, 1, 0.0, 0.0, 0.5, 1.0), (1, 0, 2, 0.05, 0.0, 0.55, 1.0)]
    preds = [(1, 0, 0, 1, 0.9, 0.0, 0.0, 0.5, 1.0), (1, 0, 0, 2, 0.8, 0.0, 0.0, 0.51, 1.0)]
    p, g = boxes(spark, preds), spark.createDataFrame(truth, TRUTH)
    assert [r.tp for r in M.match(p, g).orderBy("cand").collect()] == [True, False]
    c = M.coco_matches(p, g).where("area = 'all' and th = 0.5 and rank > 0").orderBy("rank").collect()
    assert [r.tp for r in c] == [True, True]
    s = M.coco_scores(M.coco_matches(p, g)).where("area = 'all' and th = 0.5").first()
    assert abs(s.ap - 1) < 1e-9 and s.ar == 1


def test_coco_by_hand(spark):
    """Three boxes, ranked right, wrong, right: 101-point precision 67 points at most."""
    truth = [(k, 0, k, 0.0, 0.0, 0.5, 0.5) for k in (1, 2, 3)]
    preds = [(1, 0, 0, 1, 0.9, 0.0, 0.0, 0.5, 0.5), (2, 0, 0, 2, 0.8, 0.5, 0.5, 1.0, 1.0), (3, 0, 0, 3, 0.7, 0.0, 0.0, 0.5, 0.5)]
    s = M.coco_scores(M.coco_matches(boxes(spark, preds), spark.createDataFrame(truth, TRUTH))).where("area = 'all' and th = 0.5").first()
    want = sum(1.0 if k / 100 <= 1 / 3 else 2 / 3 if k / 100 <= 2 / 3 else 0.0 for k in range(101)) / 101
    assert abs(s.ap - want) < 1e-9 and abs(s.ar - 2 / 3) < 1e-9


def slow_coco(preds, truth, th, area, scale=640.0):
    """Average precision and recall of one class at one threshold and area range, step by step."""
    lo, hi = M.COCO_AREAS[area]
    size = lambda b: (b[2] - b[0]) * (b[3] - b[1]) * scale * scale
    out, total = [], 0
    for img in sorted({p[0] for p in preds} | {g[0] for g in truth}):
        boxes_ = sorted(((not lo <= size(g[3:]) <= hi, g[2], g[3:]) for g in truth if g[0] == img), key=lambda g: g[:2])
        total += sum(not skip for skip, *_ in boxes_)
        used = set()
        for p in sorted((p for p in preds if p[0] == img), key=lambda p: (-p[4], p[3]))[:100]:
            best, at = min(th, 1 - 1e-10), None
            for k, (skip, _, g) in enumerate(boxes_):
                if k in used:
                    continue
                if at is not None and not boxes_[at][0] and skip:
                    break
                if (v := iou(p[5:], g)) >= best:
                    best, at = v, k
            if at is not None:
                used.add(at)
            if not (boxes_[at][0] if at is not None else not lo <= size(p[5:]) <= hi):
                out.append((p[4], at is not None))
    if not total:
        return None
    points, hits, seen = [], 0, 0
    for score in sorted({s for s, _ in out}, reverse=True):
        hits += sum(tp for s, tp in out if s == score)
        seen += sum(s == score for s, _ in out)
        points.append((hits / total, hits / seen))
    ap = sum(max((prec for rec, prec in points if rec >= k / 100 - 1e-11), default=0.0) for k in range(101)) / 101
    return ap, max((rec for rec, _ in points), default=0.0)


def test_coco_against_steps(spark):
    r = random.Random(21)
    truth, preds = [], []
    for k in range(900):
        x, y, w, h = r.randint(0, 40) / 64, r.randint(0, 40) / 64, r.choice([1, 2, 8, 20]) / 64, r.choice([1, 3, 8, 20]) / 64
        truth.append((r.randint(1, 300), k % 2, k, x, y, x + w, y + h))
    for k, (img, cls, _, *b) in enumerate(truth + truth[::3]):
        d = [v + r.choice([0, 0, 1, -1]) / 128 for v in b]
        preds.append((img if r.random() < 0.9 else r.randint(1, 300), cls, 0, k, r.randint(0, 12) / 12, *d))
    got = {(x.cls, x.area, round(x.th, 2)): (x.ap, x.ar) for x in M.coco_scores(M.coco_matches(boxes(spark, preds), spark.createDataFrame(truth, TRUTH))).collect()}
    for cls in (0, 1):
        for area in M.COCO_AREAS:
            for th in (0.5, 0.75, 0.95):
                want = slow_coco([p for p in preds if p[1] == cls], [g for g in truth if g[1] == cls], th, area)
                assert (cls, area, th) in got if want else (cls, area, th) not in got
                assert want is None or all(abs(a - b) < 1e-9 for a, b in zip(got[cls, area, th], want, strict=True)), (cls, area, th)


@pytest.mark.parametrize("bucket", [1, 50_000])
def test_coco_counts_are_small(spark, monkeypatch, bucket):
    """Predictions leave the tasks summed up by score, not as forty rows each, and give the scores of these rows; crowded groups, ties and empty boxes included."""
    monkeypatch.setattr(M, "BUCKET", bucket)
    r = random.Random(4)
    near = lambda: [v / 16 for v in (r.randint(0, 2), r.randint(0, 2), r.randint(2, 6), r.randint(2, 6))]
    truth = [(r.randint(0, 3), k % 2, k, *near()) for k in range(120)]
    preds = [(r.randint(0, 4), k % 2, 0, k, r.randint(0, 4) / 4, *near()) for k in range(700)]
    p, g = boxes(spark, preds), spark.createDataFrame(truth, TRUTH)
    total, counts = M.coco_counts(p, g)
    assert counts.count() <= 2 * 5 * 40
    key = lambda x: (x.cls, x.area, x.th)
    got = {key(x): (x.ap, x.ar) for x in M.coco_curve(total, counts).collect()}
    want = {key(x): (x.ap, x.ar) for x in M.coco_scores(M.coco_matches(p, g)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-12 for k in got for a, b in zip(got[k], want[k], strict=True))
    for (cls, area, th), (ap, ar) in got.items():
        slow = slow_coco([x for x in preds if x[1] == cls], [x for x in truth if x[1] == cls], th, area)
        assert abs(ap - slow[0]) < 1e-9 and abs(ar - slow[1]) < 1e-9
    plan = M.coco_curve(total, counts)._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition" in plan and "unboundedfollowing" not in plan


def slow_protocol(preds, truth, crowds, th, area, most, scale=640.0):
    """The COCO protocol of one class by its own steps: images in order, ``most`` predictions of each, all put by score in a stable sort and counted one by one."""
    lo, hi = M.COCO_AREAS[area]
    size = lambda b: (b[2] - b[0]) * (b[3] - b[1]) * scale * scale
    rows, total = [], 0
    for img in sorted({p[0] for p in preds} | {g[0] for g in truth}):
        gts = sorted(([g[2] in crowds or not lo <= size(g[3:]) <= hi, g[2] in crowds, g[3:], False] for g in truth if g[0] == img), key=lambda g: g[0])
        total += sum(not g[0] for g in gts)
        for p in sorted((p for p in preds if p[0] == img), key=lambda p: (-p[4], p[3]))[:most]:
            best, m = min(th, 1 - 1e-10), None
            for g in gts:
                if g[3] and not g[1]:
                    continue
                if m is not None and not m[0] and g[0]:
                    break
                b, d = g[2], p[5:]
                inter = max(0.0, min(b[2], d[2]) - max(b[0], d[0])) * max(0.0, min(b[3], d[3]) - max(b[1], d[1]))
                own = (d[2] - d[0]) * (d[3] - d[1])
                union = own if g[1] else own + (b[2] - b[0]) * (b[3] - b[1]) - inter
                v = inter / union if union > 0 else 0.0
                if v >= best:
                    best, m = v, g
            if m is not None:
                m[3] = True
            if not (m[0] if m is not None else not lo <= size(p[5:]) <= hi):
                rows.append((p[4], m is not None))
    if not total:
        return None
    hits, points = 0, []
    for n, (_, tp) in enumerate(sorted(rows, key=lambda r: -r[0]), 1):
        hits += tp
        points.append((hits / total, hits / n))
    return sum(max((prec for rec, prec in points if rec >= k / 100 - 1e-11), default=0.0) for k in range(101)) / 101, hits / total


def crowded(seed, images, n_truth, n_preds):
    """Boxes of few sizes about the limits of the area ranges, few scores, crowd regions, and images of more than ten predictions of a class."""
    r = random.Random(seed)

    def near():
        x, y = r.randint(0, 3) / 16, r.randint(0, 3) / 16
        return [x, y, x + r.choice([2, 3, 8, 12]) / 64, y + r.choice([2, 3, 8, 12]) / 64]

    truth = [(r.randint(0, images), k % 2, k, *near()) for k in range(n_truth)]
    preds = [(r.randint(0, images + 1), k % 3, 0, k, r.randint(0, 3) / 4, *near()) for k in range(n_preds)]
    return preds, truth, {k for k in range(n_truth) if r.random() < 0.15}


@pytest.mark.parametrize("bucket, chunk", [(1, 7), (50_000, 10_000)])
@pytest.mark.parametrize("images, n_truth, n_preds", [(3, 120, 700), (40, 120, 600)])
def test_coco_results_by_the_protocol(spark, monkeypatch, bucket, chunk, images, n_truth, n_preds):
    """Recall at 1, 10 and 100 predictions of an image, equal scores one by one, crowd regions, ranges without boxes."""
    monkeypatch.setattr(M, "BUCKET", bucket)
    monkeypatch.setattr(M, "CHUNK", chunk)
    preds, truth, crowds = crowded(images, images, n_truth, n_preds)
    g = spark.createDataFrame([(*t, t[2] in crowds) for t in truth], TRUTH + ", crowd boolean")
    got = {(x.cls, x.area, round(x.th, 2)): x for x in M.coco_results(boxes(spark, preds), g).collect()}
    assert len(got) == 2 * 40
    some = set()
    for (cls, area, th), x in got.items():
        own = [[b for b in side if b[1] == cls] for side in (preds, truth)]
        for most in (1, 10, 100):
            want = slow_protocol(*own, crowds, th, area, most)
            assert (x[f"ar_{most}"] is None) == (want is None)
            assert want is None or abs(x[f"ar_{most}"] - want[1]) < 1e-9, (cls, area, th, most)
        assert (x.ap is None) == (want is None) and (want is None or abs(x.ap - want[0]) < 1e-9), (cls, area, th)
        some.add(want is not None and x.ar_1 < x.ar_10)
    assert True in some


def test_coco_equal_scores_stand_by_image(spark):
    """A right and a wrong prediction of one score: the image that comes first decides."""
    truth = [(k, 0, k, 0.0, 0.0, 0.5, 0.5) for k in (1, 2)]
    right, wrong = (0.0, 0.0, 0.5, 0.5), (0.5, 0.5, 1.0, 1.0)
    for first, ap in ((right, 51 / 101), (wrong, 51 / 101 / 2)):
        preds = [(1, 0, 0, 9, 0.5, *first), (2, 0, 0, 1, 0.5, *(wrong if first == right else right))]
        s = M.coco_results(boxes(spark, preds), spark.createDataFrame(truth, TRUTH)).where("area = 'all' and th = 0.5").first()
        assert abs(s.ap - ap) < 1e-9 and s.ar_1 == s.ar_100 == 0.5


def test_coco_query_has_the_whole_summary(spark, sf_dir):
    """Of every model: means of the classes (cls null) and each class, at 0.5 too, recalls at 1, 10 and 100; -1 where no box is held."""
    from gridlens import registry
    from gridlens.plans.views import Tables

    t = Tables(spark, sf_dir)
    truth = [(g.img, g.cls, g.gt, g.x1, g.y1, g.x2, g.y2) for g in t.ground_truth.collect()]
    preds = [(d.img, d.cls, 0, d.cand, d.score, d.x1, d.y1, d.x2, d.y2) for d in t.detections.where("model = 1").collect()]
    rows = registry.queries()["ev_coco"](spark, sf_dir).collect()
    got = {(x.cls, x.area): x for x in rows if x.model == 1}
    classes = {g[1] for g in truth}
    assert got.keys() == {(c, a) for c in {None, *classes} for a in M.COCO_AREAS} and len(rows) == 4 * len(got)
    assert {x.ap for x in rows if x.area == "small"} == {-1.0}
    want = {}
    for cls in classes:
        own = [[b for b in side if b[1] == cls] for side in (preds, truth)]
        each = {th: slow_protocol(*own, set(), th, "all", 100)[0] for th in M.COCO_IOU}
        at = [[slow_protocol(*own, set(), th, "all", most)[1] for th in M.COCO_IOU] for most in (1, 10, 100)]
        want[cls] = [sum(each.values()) / 10, each[M.COCO_IOU[0]], each[M.COCO_IOU[5]], *[sum(a) / 10 for a in at]]
    want[None] = [sum(v) / len(classes) for v in zip(*want.values(), strict=True)]
    for cls, v in want.items():
        x = got[cls, "all"]
        assert all(abs(a - b) < 1.1e-6 for a, b in zip((x.ap, x.ap50, x.ap75, x.ar_1, x.ar_10, x.ar_100), v, strict=True)), cls


def test_curve_of_one_score(spark):
    """All scores equal: places go by id, through all ranges."""
    truth = [(k, 0, k, 0.0, 0.0, 0.5, 0.5) for k in range(200)]
    preds = [(k, 0, 0, k, 1.0, *((0.0, 0.0, 0.5, 0.5) if k % 3 else (0.5, 0.5, 1.0, 1.0))) for k in range(200)]
    p, g = boxes(spark, preds), spark.createDataFrame(truth, TRUTH)
    rows = M.ranked(M.match(p, g), g).orderBy("rn").collect()
    assert [r.cand for r in rows] == list(range(200)) and [r.acc_tp for r in rows] == [k + 1 - (k + 3) // 3 for k in range(200)]
    best = 0.0
    for r in reversed(rows):
        best = max(best, r.precision)
        assert r.envelope == best


def test_curves_run_through_in_linear_time(spark):
    """A window from each row to the end is run anew for every row: no curve has one. Scores of classes agree with the whole curve."""
    p, g = boxes(spark, noise(5, 200)), spark.createDataFrame(truths(6, 40), TRUTH)
    m = M.match(p, g, 0.4)
    curve = M.ranked(m, g)
    plan = curve._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition" in plan and "unboundedfollowing" not in plan
    whole = {r.cls: (r.ap, r.f) for r in M.average_precision(curve, ("cls",), F.max("f1").alias("f")).collect()}
    some = {r.cls: (r.ap, r.max_f1) for r in M.class_scores(m, g).collect()}
    assert whole.keys() == some.keys() and all(abs(a - b) < 1e-12 for k in whole for a, b in zip(whole[k], some[k], strict=True))
    at = {r.cand: (r.rn, r.acc_tp, r.envelope) for r in curve.where("tp").collect()}
    assert at == {r.cand: (r.rn, r.acc_tp, r.envelope) for r in M.ranked(m, g, hits=True).collect()}
    none = M.class_scores(M.match(p, g.limit(0)), g)
    assert {r.cls: (r.ap, r.max_f1) for r in none.collect()} == {k: (0.0, 0.0) for k in whole}


def test_empty_sides(spark):
    none, g = boxes(spark, []), spark.createDataFrame(truths(1, 5), TRUTH)
    assert M.match(none, g).count() == 0 and B.clusters(none, ["img", "cls"], 0.5).count() == 0
    assert M.match(boxes(spark, noise(1, 5)), g.limit(0)).where("tp").count() == 0
    assert B.greedy(none, ["img"], B.score_first(), B.over(0.5)).count() == 0


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10_000), parts=st.sampled_from([1, 8]))
def test_suppression_properties(spark, seed, parts):
    rows = noise(seed, 40, images=2)
    df = boxes(spark, rows).repartition(parts)
    once = B.greedy(df, ["img"], B.score_first(), B.over(0.3))
    kept = [tuple(r) for r in once.collect()]
    assert sorted(kept) == sorted(tuple(r) for r in B.greedy(once, ["img"], B.score_first(), B.over(0.3)).collect())
    for a in kept:
        for b in kept:
            assert a[0] != b[0] or a[3] == b[3] or iou(a[5:], b[5:]) <= 0.3


def test_one_to_one(spark):
    preds, truth = noise(70, 60), truths(71, 30)
    got = {(r.cand, r.gt) for r in M.one_to_one(boxes(spark, preds), spark.createDataFrame(truth, TRUTH), "img", 0.3).collect()}
    want, taken = set(), set()
    for p in sorted(preds, key=lambda p: (-p[4], p[3])):
        free = [t for t in truth if t[0] == p[0] and t[2] not in taken]
        best = min(free, key=lambda t: (-iou(p[5:], t[3:]), t[2]), default=None)
        if best and iou(p[5:], best[3:]) >= 0.3:
            taken.add(best[2])
            want.add((p[3], best[2]))
    assert got == want


def test_finalize_accounts_for_every_candidate(spark):
    df = boxes(spark, noise(50, 100))
    classes = spark.createDataFrame([(k, False) for k in range(3)], "cls long, exempt boolean")
    models = spark.createDataFrame([(k, k) for k in range(4)], "model long, priority int")
    confusions = spark.createDataFrame([(0, 1)], "a long, b long")
    geo = {"lo": 0.01, "hi": 0.1, "ar_lo": 0.1, "ar_hi": 10.0, "near": 0.01}
    got = A.finalize(df, classes, models, confusions, geo, 0.5, 2).collect()
    assert sorted(r.cand for r in got) == list(range(100))
    kept = {r.cand for r in got if r.outcome == "kept"}
    core = df.where(B.geometric_reason(**geo).isNull())
    chain = B.cross_class(B.top_k(B.collapse(core, models, 0.5).drop("models"), ["img", "cls"], [F.col("score").desc(), F.col("cand")], 2), classes, confusions, models)
    assert kept == {r.cand for r in chain.collect()} and {r.outcome for r in got} >= {"kept", "geometric", "duplicate"}


def test_verdict_edges(spark):
    det = boxes(spark, [(1, 0, 0, c, 0.5, 0.0, 0.0, 1.0, 1.0) for c in range(8)])
    classes = spark.createDataFrame([(0, "bus"), (1, "car")], "cls long, class_name string")
    aliases = spark.createDataFrame([("bus", "bus"), ("big coach", "bus"), ("car", "car"), ("sedan", "car")], "alias string, canonical string")
    said = [(0, "bus", 0.3), (1, "bus", 0.5), (2, "bus", 0.29), (3, "SEDAN", 0.9), (4, "Other", 0.9), (5, "zeppelin", 0.4), (6, None, 0.9), (7, "Big_Coach", 0.9)]
    v = spark.createDataFrame([(c, 1, k, s) for c, k, s in said], "cand long, img long, correct_class string, confidence double")
    got = {r.cand: (r.decision, r.relabel) for r in A.route_verdicts(v, det, classes, aliases, 0.3, 0.5).collect()}
    assert got == {0: ("review", None), 1: ("accepted", None), 2: ("rejected", None), 3: ("accepted", "car"), 4: ("rejected", None), 5: ("review", None), 6: ("accepted", None), 7: ("accepted", None)}


def test_nested_and_inner(spark):
    rows = [(1, 0, 0, 1, 0.5, 0.0, 0.0, 1.0, 1.0), (1, 0, 0, 2, 0.5, 0.1, 0.0, 0.4, 0.95), (1, 0, 0, 3, 0.5, 0.1, 0.1, 0.3, 0.3)]
    df = boxes(spark, rows)
    area_first = (-G.area(G.box()), F.col("cand"))
    assert {r.cand for r in B.greedy(df, ["img"], area_first, B.nested(0.15)).collect()} == {1, 3}
    assert {r.cand for r in B.without_larger_outer(df, ["img"], 0.01).collect()} == {1}
