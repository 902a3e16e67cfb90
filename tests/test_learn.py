"""Block-wise fitting against plain numpy: preprocessing, logistic, ordered statistics, forest, boosting."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from callcast.learn import design as D
from callcast.learn import linear as L
from callcast.learn import ordered as O
from callcast.learn import strategy as S
from callcast.learn import trees as T
from callcast.operators.resample import poisson_steps
from callcast.session import materialize

N = 500


def table(n=N, seed=0):
    r = np.random.default_rng(seed)
    job = r.choice(["a", "b", "c", "d"], n, p=[0.5, 0.3, 0.15, 0.05])
    x, z = r.normal(size=n), r.exponential(size=n)
    y = (r.random(n) < 1 / (1 + np.exp(-(x + (job == "b") - 1.5)))).astype(float)
    month = r.choice(["jan", "feb", None], n)
    return [(int(i), float(x[i]) if i % 17 else None, float(z[i]), str(job[i]), month[i], float(y[i]), int(i % 5), int(i // 7 % 5)) for i in range(n)]


SCHEMA = "contact_id long, x double, z double, job string, month string, label double, f1 int, f2 int"
FITS = [D.Fit("all"), D.Fit("no 2", ((0, 2),)), D.Fit("no 2, then 4", ((0, 2), (1, 4)))]


@pytest.fixture(scope="module")
def made(spark, monkeymodule):
    monkeymodule.setattr(D, "BLOCK_ROWS", 64)
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    d = D.encode(df, ["x", "z"], ["job", "month"], folds=["f1", "f2"])
    learnt = D.learn(d, df, FITS)
    return rows, df, d, learnt


@pytest.fixture(scope="module")
def monkeymodule():
    with pytest.MonkeyPatch.context() as m:
        yield m


def training(rows, fit):
    return [r for r in rows if all(r[6 + c] != v for c, v in fit.without)]


def test_preprocessing_is_learnt_from_each_training_set(made):
    rows, df, d, learnt = made
    assert d.levels == (("a", "b", "c", "d"), ("feb", "jan"))
    assert d.blocks.agg(F.sum("n")).first()[0] == N and d.blocks.agg(F.max("n")).first()[0] <= 64
    for fit, s in zip(FITS, learnt):
        mine = training(rows, fit)
        x = np.sort([r[1] for r in mine if r[1] is not None])
        assert s.median[0] in x and abs(np.searchsorted(x, s.median[0]) / len(x) - 0.5) < 0.01
        assert s.scale[0] == pytest.approx(np.quantile(x, 0.75) - np.quantile(x, 0.25), abs=0.05)
        assert s.counts.tolist() == [sum(r[5] == 0 for r in mine), sum(r[5] == 1 for r in mine)]
        assert (s.counts * s.weights).tolist() == pytest.approx([len(mine) / 2] * 2)
        assert len(s.edges[0]) == 31


def test_all_strengths_and_training_sets_reach_their_optimum(made):
    rows, df, d, learnt = made
    feats = L.logistic_features(d, FITS, learnt)
    strengths = [0.05, 1.0, 5.0]
    coef = L.fit_logistic(feats, learnt, strengths)
    assert len(coef) == 9
    for (f, c), w in coef.items():
        x, y = [], []
        for r in feats.where(F.col("fit") == f).collect():
            _, yy, train, _, xx = D.opened(r.asDict(), np.float64)
            x.append(xx[train])
            y.append(yy[train])
        x, y = np.concatenate(x), np.concatenate(y)
        assert len(y) == len(training(rows, FITS[f]))
        cw = np.where(y > 0, learnt[f].weights[1], learnt[f].weights[0])
        p = 1 / (1 + np.exp(-x @ w))
        gradient = strengths[c] * x.T @ (cw * (p - y)) + np.concatenate([[0], w[1:]])
        assert np.abs(gradient).max() < 1e-6
    scored = L.score_logistic(feats, coef, 3).collect()
    for f, fit in enumerate(FITS):
        want = {r[0] for r in rows} if not fit.without else {r[0] for r in training(rows, D.Fit("", fit.without[:-1])) if r[6 + fit.without[-1][0]] == fit.without[-1][1]}
        assert {s.id for s in scored if s.fit == f} == want and all(0 < s.p < 1 for s in scored)


def test_unwritten_features_give_the_same_fits_and_write_nothing(made, spark, monkeypatch):
    rows, df, d, learnt = made
    feats = L.logistic_features(d, FITS, learnt)
    want = L.fit_logistic(feats, learnt, [0.2, 1.0])
    names = []
    monkeypatch.setattr(L, "features", lambda *a, **b: names.append(a) or pytest.fail("features were written"))
    family = S.Family("Logistic Regression", "logistic", ((0.2,), (1.0,)))
    got, source = S.fit_family(family, S.Prepared(df, d), FITS, learnt)
    assert not names and set(got) == set(want) and all(np.allclose(got[k], want[k], atol=1e-7) for k in want)
    key = lambda r: (r.fit, r.candidate, r.id)
    a, b = (sorted(f.collect(), key=key) for f in (S.score_family(family, got, source), L.score_logistic(feats, want, 2)))
    assert [(*key(r), r.label) for r in a] == [(*key(r), r.label) for r in b] and np.allclose([r.p for r in a], [r.p for r in b], atol=1e-7)


def order(rows):
    import hashlib

    return sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}-42".encode()).hexdigest(), r[0]))


def test_ordered_statistics_equal_a_plain_loop(made):
    rows, df, d, learnt = made
    got = {(r.fit, r.id, r.column_name): r.value for r in O.statistics_rows(d, FITS, learnt).collect()}
    for f, (fit, s) in enumerate(zip(FITS, learnt)):
        mine = {r[0] for r in training(rows, fit)}
        prior = s.counts[1] / s.counts.sum()
        for name, at in (("job", 3), ("month", 4)):
            mode = d.levels[d.categorical.index(name)][s.mode[d.categorical.index(name)]]
            sums, whole = {}, {}
            for r in rows:
                if r[0] in mine:
                    a, b = whole.get(r[at] or mode, (0.0, 0))
                    whole[r[at] or mode] = (a + r[5], b + 1)
            for r in order(rows):
                key = (f, r[0], name)
                a, b = sums.get(r[at] or mode, (0.0, 0)) if r[0] in mine else whole[r[at] or mode]
                if key in got:
                    assert got[key] == pytest.approx((a + prior) / (b + 1), rel=1e-12)
                if r[0] in mine:
                    assert key in got
                    sums[r[at] or mode] = (a + r[5], b + 1)


def features_of(feats, fit):
    parts = [D.opened(r.asDict(), np.uint8) for r in feats.where(F.col("fit") == fit).orderBy("block").collect()]
    return [np.concatenate([p[k] for p in parts]) for k in range(5)]


IS_LEVEL = np.array([False, False, True, True])


def plain_split(bins, g, h, choices, l2, min_rows, min_h):
    """Every split, one by one."""
    best = None
    for f, c in choices:
        for cut in ([c] if c >= 0 else range(T.BINS - 1)):
            go = bins[:, f] == cut if c >= 0 else bins[:, f] <= cut
            if go.sum() < max(1, min_rows) or (~go).sum() < max(1, min_rows) or h[go].sum() <= min_h or h[~go].sum() <= min_h:
                continue
            gain = g[go].sum() ** 2 / (h[go].sum() + l2) + g[~go].sum() ** 2 / (h[~go].sum() + l2) - g.sum() ** 2 / (h.sum() + l2)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, cut, go)
    return best


ALL = [(0, -1), (1, -1)] + [(2, c) for c in range(5)] + [(3, c) for c in range(3)]


def test_leaf_wise_boosting_equals_plain_best_first(made):
    rows, df, d, learnt = made
    feats = D.features(d, FITS, learnt, T.binned, "test-bins")
    cands = [T.Candidate(0.1, 1.0, leaves=6, min_rows=5), T.Candidate(0.3, 0.0, leaves=3, min_rows=20)]
    models = T.fit_boosting(feats, learnt, 2, cands, rounds=4, refresh=2)
    for f in (0, 2):
        _, y, train, _, bins = features_of(feats, f)
        y, bins = y[train], bins[train]
        w = np.where(y > 0, learnt[f].weights[1], learnt[f].weights[0])
        for c, cand in enumerate(cands):
            raw = np.zeros(len(y))
            for k in range(4):
                p = 1 / (1 + np.exp(-raw))
                g, h = w * (y - p), w * p * (1 - p)
                leaves = [np.ones(len(y), bool)]
                found = [plain_split(bins, g, h, ALL, cand.l2, cand.min_rows, 1e-3)]
                while len(leaves) < cand.leaves and any(found):
                    i = max((i for i in range(len(leaves)) if found[i]), key=lambda i: found[i][0])
                    at, (_, fe, cut, go) = leaves.pop(i), found.pop(i)
                    left = at.copy()
                    left[at] = go
                    for part in (left, at & ~left):
                        leaves.append(part)
                        found.append(plain_split(bins[part], g[part], h[part], ALL, cand.l2, cand.min_rows, 1e-3))
                step = np.zeros(len(y))
                for at in leaves:
                    step[at] = cand.rate * g[at].sum() / (h[at].sum() + cand.l2)
                tree = models[(f, c)][k].arrays()
                assert (tree[0] < 0).sum() == len(leaves)
                assert np.allclose(tree[5][T.route(tree, bins)], step, atol=1e-9)
                raw += step


def test_symmetric_boosting_uses_one_split_a_level(made):
    rows, df, d, learnt = made
    feats = O.with_statistics(d, FITS[:1], learnt[:1], T.binned_statistics)
    models = T.fit_boosting(feats, learnt[:1], 2, [T.Candidate(0.2, 3.0, depth=3)], rounds=3, ordered=True)
    _, y, train, _, bins = features_of(feats, 0)
    w = np.where(y > 0, learnt[0].weights[1], learnt[0].weights[0])
    raw = np.zeros(len(y))
    for tree in models[(0, 0)]:
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (y - p), w * p * (1 - p)
        leaf = np.zeros(len(y), int)
        for _ in range(3):
            def total(f, cut):
                out = 0.0
                for v in np.unique(leaf):
                    at = leaf == v
                    go = at & (bins[:, f] <= cut)
                    no = at & ~go
                    if go.any() and no.any():
                        out += max(0.0, g[go].sum() ** 2 / (h[go].sum() + 3) + g[no].sum() ** 2 / (h[no].sum() + 3) - g[at].sum() ** 2 / (h[at].sum() + 3))
                return out

            scores = {(f, cut): total(f, cut) for f in range(4) for cut in range(T.BINS - 1)}
            f, cut = max(scores, key=lambda k: (round(scores[k], 9), -k[0], -k[1]))
            leaf = 2 * leaf + (bins[:, f] > cut)
        step = np.zeros(len(y))
        for v in np.unique(leaf):
            at = leaf == v
            step[at] = 0.2 * g[at].sum() / (h[at].sum() + 3)
        a = tree.arrays()
        assert np.allclose(a[5][T.route(a, bins)], step, atol=1e-9)
        raw += step


def test_each_tree_is_balanced_inside_its_own_bootstrap(made):
    rows, df, d, learnt = made
    feats = D.features(d, FITS, learnt, T.binned, "test-bins")
    masses = T.class_masses(feats, 3, 7, 42)
    for f in range(3):
        ids, y, train, _, _ = features_of(feats, f)
        ids, y = ids[train], y[train]
        for t in range(7):
            counts, w = T.bootstrap_weights(ids, y, t, 42, masses[f][t])
            assert masses[f][t].tolist() == [counts[y == 0].sum(), counts[y == 1].sum()]
            assert w[y == 1].sum() == pytest.approx(w[y == 0].sum(), abs=1e-9) and w.sum() == pytest.approx(counts.sum(), abs=1e-9)
    counts = np.concatenate([T.bootstrap_weights(np.arange(4000), np.ones(4000), t, 1, np.ones(2))[0] for t in range(5)])
    assert abs(counts.mean() - 1) < 0.05 and abs(counts.var() - 1) < 0.08


def test_forest_is_the_same_however_nodes_are_split(made):
    """Subtrees grown in tasks equal those of distributed histograms, and a plain recursion over the bootstrap."""
    rows, df, d, learnt = made
    feats = D.features(d, FITS, learnt, T.binned, "test-bins")
    small = T.fit_forest(feats, learnt, 2, min_leaf=(2, 8), n_trees=4, local_rows=40)
    large = T.fit_forest(feats, learnt, 2, min_leaf=(2, 8), n_trees=4, local_rows=10_000)
    masses = T.class_masses(feats, 3, 4, 42)
    levels = [len(k) for k in learnt[0].known]
    choices = T._choices(IS_LEVEL, levels)
    take = int(np.sqrt(len(choices)))
    for f in (0, 2):
        ids, y, train, _, bins = features_of(feats, f)
        for m, leaf in enumerate((2, 8)):
            for t in range(4):
                counts, w = T.bootstrap_weights(ids[train], y[train], t, 42, masses[f][t])
                want = np.zeros(len(counts))

                def grow(at, path):
                    yy, ww, bb = y[train][at], w[at], bins[train][at]
                    want[at] = (ww * yy).sum() / ww.sum()
                    if len(at) < 2 * leaf or want[at[0]] in (0.0, 1.0):
                        return
                    seen, best = T.node_orders(42, f, t, [path], len(choices))[0], None
                    for k, pick in enumerate(seen):
                        got = plain_split(bb, ww * yy, ww, [choices[pick]], 0.0, leaf, 1e-9)
                        if got and got[0] > 1e-12 and (best is None or got[0] > best[0] + 1e-9):
                            best = got
                        if k + 1 >= take and best:
                            break
                    if best:
                        go = best[3]
                        grow(at[go], 2 * path % (1 << 61))
                        grow(at[~go], (2 * path + 1) % (1 << 61))

                grow(np.flatnonzero(counts > 0), 1)
                for forest in (small, large):
                    a = forest[(f, m)][t].arrays()
                    got = a[5][T.route(a, bins[train])]
                    assert np.mean(np.isclose(got, want, atol=1e-9)[counts > 0]) > 0.99
    scored = T.score_forest(feats, small, [(None, 0), (2, 0), (8, 1)]).collect()
    assert {(s.fit, s.candidate) for s in scored} == {(f, c) for f in range(3) for c in range(3)} and all(0 <= s.p <= 1 for s in scored)


def test_counts_of_a_bootstrap_are_added_up_exactly_in_one_pass():
    r = np.random.default_rng(3)
    n = T.PACKED_ROWS + 500
    bins, slot = r.integers(0, T.BINS, (n, 3)).astype(np.uint8), r.integers(0, 4, n)
    counts, y = r.poisson(1.0, n).astype(float), (r.random(n) < 0.3).astype(float)
    got = T.count_histogram(bins, slot, counts, y, 4, T.BINS)
    few = slice(0, T.PACKED_ROWS)
    packed = np.stack(T.unpacked(T.packed_histogram(bins[few], slot[few], counts[few], y[few], 4, T.BINS)), axis=-1)
    assert len(poisson_steps()) < 20  # the bound that PACKED_ROWS relies on
    for part, sums in ((slice(0, n), got), (few, packed)):
        want = T.histogram(bins[part], slot[part], counts[part] * y[part], counts[part], 4, T.BINS)
        assert (sums == want).all()
    most = T.packed_histogram(np.zeros((T.PACKED_ROWS, 1), np.uint8), np.zeros(T.PACKED_ROWS, int), np.full(T.PACKED_ROWS, 20.0), np.ones(T.PACKED_ROWS), 1, 1)
    assert [int(v[0, 0, 0]) for v in T.unpacked(most)] == [20 * T.PACKED_ROWS, 20 * T.PACKED_ROWS, T.PACKED_ROWS]


def test_tasks_send_the_sums_of_looked_at_features_only(made, monkeypatch):
    rows, df, d, learnt = made
    feats = D.features(d, FITS, learnt, T.binned, "test-bins")
    sent, summed = [], T.summed
    monkeypatch.setattr(T, "summed", lambda rows, work, size: (sent.append(size), summed(rows, work, size))[1])
    forest = T.fit_forest(feats, learnt, 2, min_leaf=(2,), n_trees=4, local_rows=40, max_features=1)
    whole = 4 * len(FITS) * len(IS_LEVEL) * max(T.BINS, *(len(k) + 1 for k in learnt[0].known)) * 24
    assert sent[1] < whole  # the first level: one node a tree
    for trees in forest.values():
        assert all(isinstance(a, np.ndarray) for t in trees for a in t.arrays())


def test_forests_grown_in_turn_are_those_grown_together(made, monkeypatch):
    rows, df, d, learnt = made
    family = S.Family("f", "forest", ((None, 2), (3, 5)), 3)
    scores, calls, fit = [], [], T.fit_forest
    monkeypatch.setattr(T, "fit_forest", lambda *a, **k: (calls.append(1), fit(*a, **k))[1])
    for room in (1 << 30, 1):
        monkeypatch.setattr(S, "FOREST_BYTES", room)
        got = S.fold_scores([family], S.Prepared(df, d), FITS)
        scores.append(sorted(map(tuple, got.collect())))
    assert len(calls) == 1 + len(FITS)
    assert [r[:5] for r in scores[0]] == [r[:5] for r in scores[1]]
    assert np.allclose([r[5] for r in scores[0]], [r[5] for r in scores[1]], atol=1e-12)


def test_large_sums_are_added_in_tasks_with_the_same_result(made):
    rows, df, d, learnt = made
    work = lambda batches: {1: np.array([float(sum(n.as_py() for b in batches for n in b.column("n")))])}
    blocks = d.blocks.repartition(4)
    assert D.summed(blocks, work, 8)[1].tolist() == D.summed(blocks, work, 1 << 40)[1].tolist() == [float(N)]


def test_a_worker_is_sent_few_blocks_at_once(spark, made):
    rows, df, d, learnt = made
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    blocks = d.blocks.union(d.blocks).union(d.blocks).coalesce(1)
    assert blocks.count() > 2 * D.BATCH_BLOCKS
    most = D.summed(blocks, lambda batches: {1: np.array([float(max(b.num_rows for b in batches))])}, 8)[1]
    assert most[0] <= D.BATCH_BLOCKS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_files_of_blocks_have_small_row_groups(spark):
    large = spark.range(0, 300, 1, 1).select(F.expr("cast(randstr(131072, 5) as binary)").alias("x"))
    written = materialize(large, "blocks", **D.BLOCK_FILES)
    assert written.agg(F.sum(F.length("x"))).first()[0] == 300 * (128 << 10)
    for f in written.inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        assert all(meta.row_group(g).total_byte_size <= 20 << 20 for g in range(meta.num_row_groups))


def test_whole_training_sets_are_grown_in_tasks_and_give_the_distributed_forest(made, monkeypatch):
    rows, df, d, learnt = made
    feats = D.features(d, FITS, learnt, T.binned, "test-bins")
    variants = [(None, 0), (2, 0), (None, 1)]
    far = T.fit_forest(feats, learnt, 2, min_leaf=(2, 8), n_trees=5, local_rows=40)
    monkeypatch.setattr(T, "summed", lambda *a: pytest.fail("a job for sums"))
    near = T.fit_forest(feats, learnt, 2, min_leaf=(2, 8), n_trees=5)
    _, _, _, _, bins = features_of(feats, 0)
    for k in far:
        assert all(np.allclose(a.arrays()[5][T.route(a.arrays(), bins)], b.arrays()[5][T.route(b.arrays(), bins)], atol=1e-12) for a, b in zip(far[k], near[k], strict=True))
    stay = T.fit_forest(feats, learnt, 2, min_leaf=(2, 8), n_trees=5, stay=True)
    assert isinstance(stay, T.InTasks)
    key = lambda r: (r.fit, r.candidate, r.id)
    want, got = (sorted(T.score_forest(feats, f, variants).collect(), key=key) for f in (far, stay))
    assert [(*key(r), r.label) for r in got] == [(*key(r), r.label) for r in want] and np.allclose([r.p for r in got], [r.p for r in want], atol=1e-12)


@pytest.mark.parametrize("ordered", [False, True])
def test_whole_training_sets_are_boosted_in_tasks_like_level_by_level(made, monkeypatch, ordered):
    rows, df, d, learnt = made
    feats = O.with_statistics(d, FITS, learnt, T.binned_statistics) if ordered else D.features(d, FITS, learnt, T.binned, "test-bins")
    cands = [T.Candidate(0.2, 3.0, depth=3, min_rows=0), T.Candidate(0.3, 1.0, depth=2, min_rows=0)] if ordered else [T.Candidate(0.1, 1.0, leaves=6, min_rows=5), T.Candidate(0.3, 0.0, leaves=9, min_rows=20)]
    far = T.fit_boosting(feats, learnt, 2, cands, 5, ordered, refresh=2, whole_rows=0)
    monkeypatch.setattr(T, "summed", lambda *a: pytest.fail("a job for sums"))
    near = T.fit_boosting(feats, learnt, 2, cands, 5, ordered)
    assert set(far) == set(near) and all(len(far[k]) == len(near[k]) == 5 for k in far)
    _, _, _, _, bins = features_of(feats, 2)
    for c in range(2):
        assert all(np.allclose(a.arrays()[5][T.route(a.arrays(), bins)], b.arrays()[5][T.route(b.arrays(), bins)], atol=1e-9) for a, b in zip(far[(2, c)], near[(2, c)]))
    key = lambda r: (r.fit, r.candidate, r.id)
    stay = T.fit_boosting(feats, learnt, 2, cands, 5, ordered, stay=True)
    want, got = (sorted(T.score_boosting(feats, m).collect(), key=key) for m in (far, stay))
    assert [(*key(r), r.label) for r in got] == [(*key(r), r.label) for r in want] and np.allclose([r.p for r in got], [r.p for r in want], atol=1e-9)


def test_joint_codes_count_like_plain_histograms():
    r = np.random.default_rng(5)
    bins = np.stack([r.integers(0, k, 900) for k in (33, 33, 2, 3, 1, 17, 250)], axis=1).astype(np.uint8)
    g, h, rows, slot = r.normal(size=900), r.random(900), np.flatnonzero(r.random(900) < 0.4), None
    joint = T._JointBins(bins, 254)
    assert len(joint.groups) < bins.shape[1]
    slot = r.integers(0, 3, len(rows))
    want = T.histogram(bins[rows], slot, g[rows], h[rows], 3, 254)
    assert np.allclose(joint.histograms(rows, slot, g[rows], h[rows], 3), want, atol=1e-12)
    whole, part = joint.histograms(None, None, g, h)[0], joint.histograms(rows, None, g[rows], h[rows])[0]
    other = np.setdiff1d(np.arange(900), rows)
    assert np.allclose(joint.rest(whole, part), T.histogram(bins[other], np.zeros(len(other), int), g[other], h[other], 1, 254)[0], atol=1e-11)


def test_routes_follow_numbers_and_levels():
    tree = T.Tree()
    a, b = tree.split(0, 0, 12, False, (0.0, 0.0))
    c, e = tree.split(b, 1, 3, True, (0.0, 0.0))
    tree.split(c, 0, 30, False, (0.0, 0.0))
    bins = np.random.default_rng(6).integers(0, 33, (T.ROUTE_ROWS + 99, 2)).astype(np.uint8)
    bins[::2, 1] = 3
    x, z = bins.T
    assert (T.route(tree.arrays(), bins) == np.where(x <= 12, a, np.where(z != 3, e, np.where(x <= 30, e + 1, e + 2)))).all()
    assert (T.route(tree.arrays(), bins, 1) == np.where(x <= 12, a, b)).all() and (T.route(tree.arrays(), bins, 0) == 0).all()


def test_fold_metrics_rank_a_few_training_sets_at_a_time_and_leave_no_scores(spark, made, monkeypatch):
    import os

    from callcast.operators import evaluate as EV
    from callcast.session import checkpoint_root

    rows, df, d, learnt = made
    family = S.Family("Logistic Regression", "logistic", ((0.2,), (1.0,)))
    want = EV.ranking_metrics_by(S.fold_scores([family], S.Prepared(df, d), FITS), ["model", "candidate", "fit"]).collect()
    there = set(os.listdir(checkpoint_root(spark).removeprefix("file://")))
    ranked, rank = [], EV.ranking_metrics_by
    monkeypatch.setattr(EV, "ranking_metrics_by", lambda *a: (ranked.append(1), rank(*a))[1])
    for most, parts in ((1, 3), (1 << 30, 1)):
        monkeypatch.setattr(S, "RANKED_ROWS", most)
        ranked.clear()
        got = S.fold_metrics([family], S.Prepared(df, d), FITS)
        assert len(ranked) == parts
        assert sorted(r[:3] for r in got) == sorted((r.model, r.candidate, r.fit) for r in want)
        assert np.allclose([r[3] for r in sorted(got)], [r.average_precision for r in sorted(want, key=lambda r: (r.model, r.candidate, r.fit))], atol=1e-9)
    left = set(os.listdir(checkpoint_root(spark).removeprefix("file://"))) - there
    assert not [x for x in left if x.startswith(("grouped", "ordered", "fold-scores"))]


def test_split_and_folds_written_one_by_one_are_those_of_one_plan(spark):
    from callcast.operators import split as SP
    from callcast.plans import ml as ML
    from callcast.plans import queries as Q
    from sf_dirs import SF

    whole = SP.kfold_assign(SP.stratified_split(ML.with_label(Q.contacts(spark, SF))), k=5, seeds=(43, 44))
    dev, test = Q._dev_test(spark, SF)
    assert dev.columns == whole.where("split != 'test'").drop("split").columns
    assert sorted(dev.collect()) == sorted(whole.where("split != 'test'").drop("split").collect())
    assert sorted(test.collect()) == sorted(whole.where("split = 'test'").drop("split", "fold_43", "fold_44").collect())


def test_large_training_sets_are_sent_to_fewer_pieces(made, monkeypatch):
    rows, df, d, learnt = made
    cores = df.sparkSession.sparkContext.defaultParallelism
    many = T._pieces(df, learnt, [0], 300)
    monkeypatch.setattr(T, "PIECES_BYTES", 1)
    assert many == T.PIECES_PER_CORE * cores and T._pieces(df, learnt, [0], 300) == cores and T._pieces(df, learnt, [0], 2) == 2
