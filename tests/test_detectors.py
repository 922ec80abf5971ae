from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.config import ScaleLimits
from tidewatch.operators import components, scoring
from tidewatch.operators.dbscan import dbscan_labels, dbscan_scores
from tidewatch.operators.forest import ForestArrays, fit_isolation_forest
from tidewatch.operators.hierarchy import hierarchy_scores
from tidewatch.operators.importance import numbered, permutation_importance, permuted_blocks
from tidewatch.operators.lof import fit_lof, load_lof, lof_scores
from tidewatch.operators import dbscan, lof
from tidewatch.operators.neighbours import build_index, near_pairs, nearest_points, positions, weighted_points
from tidewatch.operators.oneclass import FourierMap, corrected, fit_oneclass, oneclass_scores
from tidewatch.operators.skew import checkpointed


def table(spark, x):
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "tx_id long, features array<double>").repartition(4)


@pytest.fixture(scope="module")
def blobs():
    """Two clusters, one of them with many copies of one point, and three far outliers."""
    rng = np.random.default_rng(5)
    a = rng.normal(0, 1, (120, 4))
    b = rng.normal(8, 0.5, (80, 4))
    copies = np.repeat(b[:1], 40, axis=0)
    far = np.array([[30.0, 0, 0, 0], [0, -25.0, 0, 0], [15, 15, -20, 3]])
    return np.vstack([a, b, copies, far])


def pairwise(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def brute_lof(x, k):
    d, n = pairwise(x), len(x)
    order = np.lexsort((np.tile(np.arange(n), (n, 1)), d), axis=1)
    fit = np.array([[j for j in order[i] if j != i][:k] for i in range(n)])
    kd = d[np.arange(n), fit[:, -1]]
    lrd = lambda nb: 1 / (np.maximum(np.take_along_axis(d, nb, 1), kd[nb]).mean(1) + 1e-10)
    dens = lrd(fit)
    new = order[:, :k]
    return dens[new].mean(1) / lrd(new)


@pytest.mark.parametrize("chunk", [5000, 40])
def test_lof(spark, blobs, chunk):
    out = lof_scores(table(spark, blobs), 20, "s", chunk_rows=chunk).toPandas().sort_values("tx_id")["s"].to_numpy()
    want = brute_lof(blobs, 20)
    assert len(out) == len(blobs)
    # Copies tie with each other, and equal rows may count any of their copies.
    assert np.allclose(out, want, rtol=1e-6)
    assert out[-3:].min() > 1.5


@pytest.mark.parametrize("chunk", [5000, 30])
def test_lof_of_new_rows(spark, blobs, tmp_path, chunk):
    fitted, new, k = blobs[::2], blobs[1::2], 10
    model = fit_lof(table(spark, fitted), k, chunk_rows=chunk)
    model.save(str(tmp_path / "lof"))
    d = pairwise(fitted)
    np.fill_diagonal(d, np.inf)
    own = np.argsort(d, axis=1, kind="stable")[:, :k]
    kdist = np.take_along_axis(d, own, 1)[:, -1]
    density = 1 / (np.maximum(np.take_along_axis(d, own, 1), kdist[own]).mean(1) + 1e-10)
    gap = np.sqrt(((new[:, None] - fitted[None]) ** 2).sum(-1))
    near = np.argsort(gap, axis=1, kind="stable")[:, :k]
    want = density[near].mean(1) * (np.maximum(np.take_along_axis(gap, near, 1), kdist[near]).mean(1) + 1e-10)
    for m in (model, load_lof(spark, str(tmp_path / "lof"))):
        got = m.score(table(spark, new), "s").toPandas().sort_values("tx_id")["s"].to_numpy()
        assert len(got) == len(new) and np.allclose(got, want, rtol=1e-6)


def test_neighbours_move_rows_once(spark, capsys):
    """Many cells, blocks and ties: the lists are those of brute force, and no row is copied for the cells it visits."""
    x = np.random.default_rng(3).integers(0, 25, (6000, 3)).astype(float)
    points = checkpointed(weighted_points(table(spark, x)))
    found = nearest_points(build_index(points, 150), 7)
    found.explain()
    plan = capsys.readouterr().out
    assert "CoGroup" not in plan and "Generate" not in plan
    ids, y = zip(*[(r["gid"], r["features"]) for r in points.collect()])
    ids, y = np.array(ids), np.array(y)
    lists = {r["gid"]: [(n["dist"], n["nid"]) for n in r["neighbours"]] for r in found.collect()}
    assert sorted(lists) == sorted(ids)
    for at in range(0, len(ids), 37):
        d = np.sqrt(((y - y[at]) ** 2).sum(1))
        assert lists[ids[at]] == [(d[i], ids[i]) for i in np.lexsort((ids, d))[:7]]


def test_one_class_of_new_rows(spark, blobs):
    model = fit_oneclass(table(spark, blobs[:240]), steps=6)
    everything = model.score(table(spark, blobs), "s").toPandas().sort_values("tx_id")["s"].to_numpy()
    alone = model.score(table(spark, blobs[240:]), "s").toPandas().sort_values("tx_id")["s"].to_numpy()
    assert np.allclose(everything[240:], alone) and alone.min() > np.quantile(everything[:240], 0.8)


def test_neighbours_across_cells(spark, blobs):
    points = checkpointed(weighted_points(table(spark, blobs)))
    index = build_index(points, 25)
    assert len(index.counts) > 4
    got = {r["gid"]: [(n["nid"], round(n["dist"], 9)) for n in r["neighbours"]] for r in nearest_points(index, 7).collect()}
    ids = sorted(got)
    d = pairwise(blobs)[np.ix_(ids, ids)]
    for i, g in enumerate(ids):
        assert got[g][0][0] == g and np.allclose([v for _, v in got[g]], np.sort(d[i])[:7], atol=1e-8)


def brute_dbscan(x, eps, m):
    near = pairwise(x) <= eps
    core = near.sum(1) >= m
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] < 0:
                    label[j] = i
                    todo += [k for k in np.flatnonzero(near[j] & core) if label[k] < 0]
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        label[i] = reach.min() if len(reach) else -1
    return label


@pytest.mark.parametrize("chunk", [5000, 40])
@pytest.mark.parametrize("eps", [0.6, 1.5])
def test_dbscan(spark, blobs, chunk, eps):
    labels = dbscan_labels(table(spark, blobs), eps, 5, chunk_rows=chunk)
    out = labels.toPandas().sort_values("tx_id")["cluster"].fillna(-1).astype(int).to_numpy()
    assert (out == brute_dbscan(blobs, eps, 5)).all()
    score = dbscan_scores(labels).toPandas().sort_values("tx_id")["dbscan_score"].to_numpy()
    assert ((score == 1) == (out == -1)).all() and score.min() >= 0 and score[out >= 0].max() == 0.5


def test_dbscan_single_cluster_scores_zero(spark):
    x = np.zeros((10, 2)) + np.arange(10)[:, None] * 0.01
    assert {r["dbscan_score"] for r in dbscan_scores(dbscan_labels(table(spark, x), 0.5, 5)).collect()} == {0.0}


def test_dbscan_asks_no_more_than_it_must(spark, monkeypatch):
    """A query that has found enough asks no more, and nobody asks again once one cluster is left."""
    scans, scan = [], dbscan.scan
    monkeypatch.setattr(dbscan, "scan", lambda *a: scans.append(a) or scan(*a))
    x = np.arange(40)[:, None] * 0.1
    assert {r["cluster"] for r in dbscan_labels(table(spark, x), 0.25, 3).collect()} == {0}
    assert len(scans) == 3  # counts, one round of links, borders
    search = scans[0][4]({"gid": np.arange(40), "features": x})
    p = {"gid": np.arange(40), "features": x, "weight": np.ones(40, np.int64)}
    assert (search.limit() == 0.25).all()
    search.meet(np.arange(40), p)
    assert (search.found == (pairwise(x) <= 0.25).sum(1)).all() and np.isneginf(search.limit()).all()


@pytest.mark.parametrize("shift", [0.0, 1e3])
@pytest.mark.parametrize("size", [1e-25, 1e-6, 1.0, 1e20])
def test_near_pairs_miss_none(shift, size):
    rng = np.random.default_rng(3)
    x, y = (rng.normal(shift, 1, (n, 6)) * size for n in (700, 300))
    y[:50] = x[:50]
    true = ((x[:, None] - y[None]) ** 2).sum(-1)
    limit = np.quantile(true, 0.02, axis=1)
    limit[:3] = 0.0, np.inf, true[2].min()
    wanted, seen = set(zip(*np.nonzero(true <= limit[:, None]))), set()
    for i, j, sq, noise in near_pairs(x, y, limit):
        assert (np.diff(i) >= 0).all() and (np.abs(sq - true[i, j]) <= noise).all()
        seen |= set(zip(i, j))
    assert wanted <= seen
    if size == 1.0:
        assert len(seen) < 1.2 * len(wanted)


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (8, 8), (7, 123)])
def test_positions_of_hits(shape):
    draw = np.random.default_rng(1)
    for share in (0.0, 0.01, 0.5, 1.0):
        hits = draw.uniform(size=shape) < share
        assert positions(hits).tolist() == np.flatnonzero(hits).tolist()


def test_cells_grow_with_the_root_of_the_rows(spark):
    """Every task opens the cells it reads, so many small cells cost more than they rule out."""
    x = np.random.default_rng(9).normal(0, 1, (400, 8))
    index = build_index(checkpointed(weighted_points(table(spark, x))), 1)
    assert len(index.pivots) <= 20
    got = {r["gid"]: [n["nid"] for n in r["neighbours"]] for r in nearest_points(index, 5).collect()}
    assert got == dict(enumerate(np.argsort(pairwise(x), axis=1, kind="stable")[:, :5].tolist()))


def test_components_of_a_chain(spark):
    nodes = spark.range(40).withColumnRenamed("id", "id")
    edges = spark.range(30).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).filter("src <> 14")
    out = {r["id"]: r["component"] for r in components.connected_components(nodes, edges).collect()}
    assert out == {i: 0 if i <= 14 else 15 if i <= 30 else i for i in range(40)}


def test_one_task_joins_what_rounds_join(spark, monkeypatch):
    draw = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(i + 1, i) for i in range(1000, 1400)]
    ids = sorted({i for p in pairs for i in p} | {2000})
    nodes, edges = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(pairs, "src long, dst long").repartition(5)
    wanted = {i: i for i in ids}
    for _ in range(500):
        for a, b in pairs:
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    written = []
    monkeypatch.setattr(components, "checkpointed", lambda df: written.append(1) or checkpointed(df))
    found = components.connected_components(nodes, edges, 1000)
    assert {r["id"]: r["component"] for r in found.collect()} == wanted and len(written) == 2
    assert {r["id"]: r["component"] for r in components.connected_components(nodes, edges, 100).collect()} == wanted
    two = lambda c: F.struct((F.col(c) % 2).alias("part"), F.col(c).alias("v"))
    same = edges.filter("src % 2 = dst % 2").select(two("src").alias("src"), two("dst").alias("dst"))
    by_rounds, by_task = (sorted(components.connected_components(nodes.select(two("id").alias("id")), same, n).collect()) for n in (0, 1000))
    assert by_rounds == by_task and len(by_task) == len(ids)
    assert components.connected_components(nodes, edges.limit(0), 10).filter("id = component").count() == len(ids)


def test_fitted_rows_ask_for_no_neighbours_again(spark, blobs, tmp_path, monkeypatch):
    x, asked = table(spark, blobs), []
    search = lof.nearest_to
    monkeypatch.setattr(lof, "nearest_to", lambda i, q, k: asked.append(q.count()) or search(i, q, k))
    model = fit_lof(x, 20, chunk_rows=40)
    model.save(str(tmp_path / "m"))
    loaded = load_lof(spark, str(tmp_path / "m"))
    scores = lambda m, t: {r["tx_id"]: r["s"] for r in m.score(t, "s").collect()}
    got = scores(model, x)
    assert not asked and np.allclose([got[i] for i in range(len(blobs))], brute_lof(blobs, 20), rtol=1e-6)
    assert scores(loaded, x) == got and not asked
    # Ids say nothing: other vectors under fitted ids are searched, and only those.
    moved = table(spark, np.vstack([blobs[:100], blobs[100:120] + 0.5]))
    for m in (model, loaded):
        assert scores(m, moved) == scores(replace(m, lists=None), moved)
    assert asked == [20, 120, 20, 120]


def test_isolation_forest(spark, blobs):
    df = table(spark, blobs)
    forest = fit_isolation_forest(df, trees=60, subsample=64, seed=7)
    again = fit_isolation_forest(df.repartition(7), trees=60, subsample=64, seed=7)
    pd.testing.assert_frame_equal(forest.nodes, again.nodes)
    full = fit_isolation_forest(df, trees=60, subsample=256, seed=7)
    s = full.score(df).toPandas().sort_values("tx_id")["isolation_raw"].to_numpy()
    assert ((0 < s) & (s < 1)).all()
    assert set(np.argsort(-s)[:3]) == {240, 241, 242}


def test_one_class(spark, blobs):
    s = oneclass_scores(table(spark, blobs), steps=8).toPandas().sort_values("tx_id")["oneclass_raw"].to_numpy()
    assert s[-3:].min() > np.quantile(s, 0.8)


@pytest.mark.parametrize("copies", [1, 200])
@pytest.mark.parametrize("nu", [0.05, 0.3])
def test_one_class_reaches_the_optimum(spark, blobs, nu, copies):
    """Gap below the tolerance, the share of outliers near nu, and no shorter vector by an independent solver."""
    x = np.vstack([blobs, np.repeat(blobs[130:131], copies - 1, axis=0)])
    model = fit_oneclass(table(spark, x), nu=nu, tolerance=1e-4)
    assert model.gap <= 1e-4 and model.steps < 40
    score = model.score(table(spark, x), "s").toPandas().sort_values("tx_id")["s"].to_numpy()
    assert (score > 1e-6).mean() <= nu + 1e-9 <= (score > -1e-3).mean() + 1e-9
    z = FourierMap(model.dims, model.gamma, model.size, model.seed)(x)
    alpha, bound = np.full(len(x), 1 / len(x)), 1 / (nu * len(x))
    rate, ahead, t = np.linalg.norm(z, 2) ** 2, alpha, 1.0
    for _ in range(1500):  # accelerated projected gradient on the weights of the rows, projected by bisection
        step = ahead - z @ (z.T @ ahead) / rate
        lo, hi = step.min() - 1, step.max()
        for _ in range(40):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (step - mid).clip(0, bound).sum() > 1 else (lo, mid)
        before, alpha, t, was = alpha, (step - lo).clip(0, bound), (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = alpha + (was - 1) / t * (alpha - before)
    best = ((z.T @ alpha) ** 2).sum()
    assert np.dot(model.weights, model.weights) == pytest.approx(best, rel=5e-4)


def test_corrected_shares():
    """The point nearest to the origin: inside an edge, at a corner, and with a repeated atom."""
    assert np.allclose(corrected(np.array([[1.0, 0], [0, 1.0], [2.0, 2.0]]), np.array([0, 0, 1.0])), [0.5, 0.5, 0])
    assert np.allclose(corrected(np.array([[1.0, 0], [2.0, 1.0]]), np.array([0.5, 0.5])), [1, 0])
    assert corrected(np.array([[1.0, 0], [1.0, 0]]), np.array([0.3, 0.7])).sum() == pytest.approx(1.0)


def test_one_class_of_equal_and_of_no_rows(spark):
    model = fit_oneclass(table(spark, np.ones((6, 2))))
    assert model.gap == pytest.approx(0.0, abs=1e-9)
    assert {round(r["s"], 9) for r in model.score(table(spark, np.ones((6, 2))), "s").collect()} == {0.0}
    with pytest.raises(ValueError):
        fit_oneclass(table(spark, np.ones((6, 2))).filter("tx_id < 0"))


def test_hierarchy(spark, blobs):
    s = hierarchy_scores(table(spark, blobs)).toPandas().sort_values("tx_id")["hierarchy_raw"].to_numpy()
    assert ((0 <= s) & (s <= 1)).all() and s[-3:].min() >= np.median(s)


def test_importance(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(0, 1, 300), np.zeros(300)])
    df = table(spark, x)
    out = {r["feature"]: r["importance"] for r in permutation_importance(
        df, ["varies", "constant"], fit_isolation_forest(df, trees=20, subsample=64)).collect()}
    assert out["varies"] == pytest.approx(1.0) and out["constant"] == 0.0


def test_resumed_walks_are_those_of_the_changed_rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 30))
    model = fit_isolation_forest(table(spark, x), 20, 64)
    trees = ForestArrays(model.nodes, model.subsample)
    nodes, lengths = trees.walk(x)
    assert (trees.scored(lengths) == trees.score(x)).all()
    for c in range(30):
        other, changed, path = rng.permutation(x[:, c]), x.copy(), lengths.copy()
        at = trees.touched(nodes, c)
        path[at[1:]] = trees.resumed(x, c, other, nodes, at)
        changed[:, c] = other
        assert (trees.scored(path) == trees.score(changed)).all() and len(at[0]) < 0.5 * lengths.size


def test_changes_of_all_columns_are_those_of_whole_walks(spark):
    rng = np.random.default_rng(12)
    x = np.column_stack([rng.normal(size=(500, 12)), np.zeros(500), rng.integers(0, 2, 500)])
    model = fit_isolation_forest(table(spark, x), 15, 64)
    trees = ForestArrays(model.nodes, model.subsample)
    other = {(c, r): np.random.default_rng([c, r]).permutation(x[:, c]) for c in range(14) for r in range(2)}
    got = trees.changes(x, 2, lambda c, r: other[c, r])
    for (c, r), values in other.items():
        changed = x.copy()
        changed[:, c] = values
        assert got[c, r] == pytest.approx(np.abs(trees.score(changed) - trees.score(x)).sum(), abs=1e-10)
    assert (got[12] == 0).all() and (got[:12] > 0).all()
    nodes = trees.walk(x)[0]
    for c, at in enumerate(trees.first_asked(nodes, 14)):
        asks = trees.feature[np.arange(15), nodes[:-1]] == c
        row, tree = np.nonzero(asks.any(axis=0))
        assert sorted(zip(*at)) == sorted(zip(asks[:, row, tree].argmax(axis=0), row, tree)) and (np.diff(at[0]) >= 0).all()


def test_importance_fits_no_neighbour_method(spark, monkeypatch):
    from catalog import detectors
    from tidewatch.plans import detect

    def unused(*args, **kwargs):
        raise AssertionError("importance reads the forest alone")

    monkeypatch.setattr(detect, "fit_lof", unused)
    out = detectors.QUERIES["permutation_importance"](spark, "/root/testdata/sf0.001").toPandas()
    assert len(out) and abs(out["importance"].sum() - 1) < 1e-9


@pytest.mark.parametrize("rows,block", [(100, 16), (100, 2048), (97, 7), (1, 4), (2, 4)])
def test_every_column_gets_its_own_permutation(spark, rows, block):
    x = np.column_stack([np.arange(rows), np.arange(rows) + 1000.0])
    work = lambda ids, x, moved: pd.DataFrame([
        (int(i), c, r, float(v)) for c in (0, 1) for r in (0, 1) for i, v in zip(ids, moved(c, r))], columns=["id", "c", "r", "v"])
    tables = []
    for limits in (ScaleLimits(), ScaleLimits(rows_per_task=15)):
        out = permuted_blocks(table(spark, x), work, "id long, c int, r int, v double", 1, 2, block, limits).toPandas()
        tables.append({k: g.sort_values("id")["v"].to_numpy() for k, g in out.groupby(["c", "r"])})
        for (c, r), v in tables[-1].items():
            assert sorted(v) == sorted(x[:, c])
    assert len(tables[0]) == 4
    if rows > 50:
        got = [tables[0][k] - 1000 * k[0] for k in tables[0]]
        assert all((a == b).mean() < 0.2 for i, a in enumerate(got) for b in got[:i])
        assert all((a == np.arange(rows)).mean() < 0.2 for a in got)
        # Neighbours do not stay neighbours.
        assert all((np.diff(a) == 1).mean() < 0.2 for a in got)


def test_numbers_are_dense_in_any_ranges(spark):
    df = table(spark, np.zeros((100, 1)))
    one = {r["tx_id"]: r["_row"] for r in numbered(df, 100, 3).collect()}
    many = {r["tx_id"]: r["_row"] for r in numbered(df.repartition(3), 100, 3, ScaleLimits(rows_per_task=9)).collect()}
    assert one == many and sorted(one.values()) == list(range(100))


def test_planted_column_ranks_first(spark):
    """Against a direct computation; the spread is small for many rows, and repeats agree with each other."""
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(0, 0.01, 400), np.where(rng.random(400) < 0.1, 9.0, 0.0) + rng.normal(0, 1, 400), np.zeros(400)])
    df = table(spark, x)
    forest = fit_isolation_forest(df, trees=30, subsample=128)
    out = {r["feature"]: r for r in permutation_importance(df, ["a", "planted", "flat"], forest, block=64).collect()}
    arrays = ForestArrays(forest.nodes, forest.subsample)
    base, change = arrays.score(x), []
    for c in range(3):
        moved = []
        for _ in range(20):
            y = x.copy()
            y[:, c] = rng.permutation(x[:, c])
            moved.append(np.abs(arrays.score(y) - base).mean())
        change.append(np.mean(moved))
    want = np.array(change) / np.sum(change)
    for name, w in zip(["a", "planted", "flat"], want):
        assert out[name]["importance"] == pytest.approx(w, abs=0.05)
    assert out["flat"]["importance"] == 0 and out["flat"]["spread"] == 0
    assert 0 < out["planted"]["spread"] < 0.1
    assert (out["planted"]["importance"] > out["a"]["importance"]) == (want[1] > want[0])
    assert permutation_importance(df.filter("tx_id < 0"), ["a", "planted", "flat"], forest).count() == 0


def test_equal_scores_normalise_to_zero(spark):
    df = table(spark, np.ones((5, 2)))
    forest = fit_isolation_forest(df, trees=3, subsample=4)
    out = scoring.minmax(forest.score(df, "raw").drop("features"), {"raw": "s"})
    assert {r["s"] for r in out.collect()} == {0.0}


def test_matrix_is_fitted_with_one_aggregate_for_all_columns(spark, monkeypatch):
    from tidewatch.operators import matrix

    calls, plain = [], matrix.F.stddev_pop
    monkeypatch.setattr(matrix.F, "stddev_pop", lambda c: calls.append(c) or plain(c))
    df = spark.createDataFrame(
        [(i, float(i), None if i % 3 else 2.0 * i, i % 24, "ab"[i % 2]) for i in range(50)], "tx_id long, amount double, amount_raw double, hour int, device_filled string")
    model = matrix.fit_matrix(df)
    assert model.names == ["amount", "amount_raw", "hour", "device_filled_encoded"] and len(calls) == 1
    x = np.array([[i, 0.0 if i % 3 else 2.0 * i, i % 24, i % 2] for i in range(50)], float)
    assert np.allclose(model.means, x.mean(0)) and np.allclose(model.stds, x.std(0))
    none = matrix.fit_matrix(df.limit(0))
    assert none.means == [0.0] * 4 and none.stds == [0.0] * 4


def test_isolation_forest_scores_rows_once(spark):
    from catalog.detectors import QUERIES

    out = QUERIES["isolation_forest"](spark, "/root/testdata/sf0.001")
    assert "ArrowEvalPython" not in out._jdf.queryExecution().toString()  # range and result read stored scores
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
