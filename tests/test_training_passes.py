"""Histogram boosting and one-pass linear models: against plain versions, and their number of jobs."""

import uuid

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.operators import boosting, training
from caseworks.operators.boosting import LEAST_CURVE, RIDGE, STEPS, Bins, Trees, best_split
from caseworks.plans.stages import VectorBatch, flat_vector


def jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def frame(spark, x, y, sparse=True, parts=3):
    rows = []
    for k, (values, label) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        held = {i: v for i, v in enumerate(values) if v != 0}
        rows.append((float(label), Vectors.sparse(len(values), held) if sparse and k % 3 else Vectors.dense(values)))
    return spark.createDataFrame(rows, ["label", "features"]).repartition(parts)


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.Generator(np.random.PCG64(3))
    x = np.round(rng.normal(0, 2, (400, 5)) * (rng.random((400, 5)) < 0.6), 1)
    y = (x[:, 0] > 1).astype(int) + 2 * (x[:, 1] + x[:, 2] < 0)
    return x, np.where(y == 3, 0, y)


def plain_boosting(x, y, priors, rounds, depth, eta):
    """The same algorithm on one matrix, every cut between observed values tried in turn."""
    margins = np.tile(np.array(priors), (len(x), 1))

    def leaf(g, h):
        return -eta * g / (h + RIDGE * STEPS)

    def grow(rows, level, g, h, out):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (0.0, None, None)
        if level < depth:
            for f in range(x.shape[1]):
                for cut in np.unique([*x[:, f], 0.0, *([np.nextafter(0.0, -1.0)] if (x[:, f] < 0).any() else [])])[:-1]:
                    left = rows[x[rows, f] <= cut]
                    lg, lh = g[left].sum(), h[left].sum()
                    if min(lh, total_h - lh) < LEAST_CURVE * STEPS:
                        continue
                    rg, rh = total_g - lg, total_h - lh
                    ridge = RIDGE * STEPS
                    gain = (lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - total_g**2 / (total_h + ridge)) / STEPS
                    if gain > max(best[0], 1e-9):
                        best = (gain, f, cut)
        if best[1] is None:
            out[rows] = leaf(total_g, total_h)
            return
        side = x[rows, best[1]] <= best[2]
        grow(rows[side], level + 1, g, h, out)
        grow(rows[~side], level + 1, g, h, out)

    for _ in range(rounds):
        powers = np.exp(margins - margins.max(1, keepdims=True))
        p = powers / powers.sum(1, keepdims=True)
        steps = np.zeros_like(margins)
        for k in range(len(priors)):
            g = np.rint((p[:, k] - (y == k)) * STEPS)
            h = np.rint(np.maximum(2 * p[:, k] * (1 - p[:, k]), 1e-6) * STEPS)
            grow(np.arange(len(x)), 0, g, h, steps[:, k])
        margins = margins + steps
    return margins


def test_trees_equal_a_plain_version(spark, drawn, monkeypatch):
    x, y = drawn
    monkeypatch.setattr(boosting, "BINS", 1_000)
    monkeypatch.setattr(boosting.fit_bins, "__defaults__", (1_000,))
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    model = training.train_trees(frame(spark, x, y), rounds=5, depth=3, eta=0.3)
    expected = plain_boosting(x, y, model.priors, 5, 3, 0.3)
    plain = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["i", "features"])
    found = np.array([r["rawPrediction"].toArray() for r in model.transform(plain).orderBy("i").collect()])
    assert np.abs(found - expected).max() < 1e-9
    p = np.exp(expected - expected.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert model.losses[-1][0] == pytest.approx(float(-np.log(p[np.arange(len(y)), y]).mean()), abs=1e-5)


def test_trees_do_not_depend_on_the_layout(spark, drawn, monkeypatch):
    x, y = drawn
    models = []
    for parts, dense, block in ((1, 1 << 22, 1 << 16), (7, 1 << 22, 20), (3, 0, 1 << 16), (2, 0, 20)):
        monkeypatch.setattr(boosting, "DENSE", dense)
        monkeypatch.setattr(boosting, "BLOCK", block)
        models.append(training.train_trees(frame(spark, x, y, parts=parts), rounds=3, depth=3))
    for m in models[1:]:
        for name in ("feature", "cut", "value"):
            assert (getattr(m.trees, name) == getattr(models[0].trees, name)).all()


def test_equal_rows_are_one_with_a_weight(spark, drawn, monkeypatch):
    x, y = np.round(np.tile(drawn[0][:100], (8, 1))), np.tile(drawn[1][:100], 8)
    sizes, spread = [], boosting._spread
    monkeypatch.setattr(boosting, "_spread", lambda rows, *rest: sizes.append((rows.count(), rows.agg(F.sum("weight")).first()[0])) or spread(rows, *rest))
    data = frame(spark, x, y)
    one = training.train_trees(data, data, rounds=4, depth=3, early_stop=4)
    grouped = boosting._binned
    monkeypatch.setattr(boosting, "_binned", lambda entries, layout, priors, drawn: grouped(entries, layout, priors, True))
    apart = training.train_trees(data, data, rounds=4, depth=3, early_stop=4)
    assert sizes[0][0] <= 200 and sizes[0][1] == 1600 and sizes[1] == (1600, 1600)
    assert one.losses == apart.losses
    for name in ("feature", "cut", "value"):
        assert (getattr(one.trees, name) == getattr(apart.trees, name)).all()


def test_small_nodes_are_finished_in_one_job(spark, drawn, monkeypatch):
    x, y = drawn
    data = frame(spark, x, y)
    models, jobs = [], []
    for finish, dense, block in ((0, 1 << 22, 1 << 16), (0, 0, 20), (700, 1 << 22, 20), (1 << 21, 1 << 22, 1 << 16)):
        for name, value in (("FINISH", finish), ("DENSE", dense), ("BLOCK", block)):
            monkeypatch.setattr(boosting, name, value)
        fit = lambda: training.train_trees(data, data, rounds=4, depth=5, early_stop=4)
        model, n = jobs_of(spark, fit)
        models.append(model)
        jobs.append(n)
        subsampled = training.train_trees(data, rounds=2, depth=4, subsample=0.6)
        models[-1].drawn = subsampled.trees
    for m in models[1:]:
        assert m.losses == models[0].losses
        for name in ("feature", "cut", "value"):
            assert (getattr(m.trees, name) == getattr(models[0].trees, name)).all()
            assert (getattr(m.drawn, name) == getattr(models[0].drawn, name)).all()
    assert jobs[3] < jobs[2] < jobs[0] and jobs[0] - jobs[3] >= 4 * 4, jobs


def test_nodes_whose_rows_are_all_zero(spark, monkeypatch):
    y = np.repeat(np.arange(4), 40)
    x = np.where(y == 3, 5.0, y)[:, None]
    x = np.concatenate([x, (y == 2)[:, None] * 2.0], 1)
    data = frame(spark, x, y, parts=1).sortWithinPartitions("label")
    models = []
    for finish, dense, pack, waiting in ((1 << 21, 1 << 22, 1 << 18, 1 << 22), (0, 1 << 22, 1 << 18, 1 << 22), (0, 1 << 22, 1, 0), (0, 0, 1, 0)):
        for name, value in (("FINISH", finish), ("DENSE", dense), ("PACK", pack), ("WAITING", waiting)):
            monkeypatch.setattr(boosting, name, value)
        models.append(training.train_trees(data, rounds=3, depth=4, subsample=0.9))
    assert training.holdout_accuracy(models[0], data) == 1.0
    for m in models[1:]:
        for name in ("feature", "cut", "value"):
            assert (getattr(m.trees, name) == getattr(models[0].trees, name)).all()


def test_packed_rows_are_stored_in_small_row_groups(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(boosting, "TASK_CELLS", 1 << 40)  # one task
    layout = spark.sparkContext.broadcast(Bins(np.arange(60_001), np.empty(0)))
    bins = F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(60_000)).cast("int"))
    rows = spark.range(0, 10_000, 1, 1).select(
        F.col("id").alias("row"), F.lit(0).alias("label"), F.lit(False).alias("watch"), bins.alias("bins"), F.lit(1).cast("long").alias("weight"),
        F.array(F.lit(0.0), F.lit(0.0)).alias("margin"),
    )
    packed, path = boosting._spread(*boosting.write_stage(rows, "binned"), 2, layout)
    files = [pq.ParquetFile(file).metadata for file in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
    assert max(f.num_rows for f in files) > 20
    assert max(f.row_group(k).total_byte_size for f in files for k in range(f.num_row_groups)) < 10 << 20
    assert packed.agg(F.sum("rows")).first()[0] == 10_000
    boosting.drop_stage(spark, path)


def test_only_the_smaller_child_is_added_up(spark, drawn, monkeypatch):
    x, y = drawn
    data = frame(spark, x, y)
    asked, histograms = [], boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *args: asked.append({(k, n) for k, nodes in args[5].items() for n in nodes}) or histograms(*args))
    monkeypatch.setattr(boosting, "FINISH", 0)
    models, levels = [], []
    for least, dense, block in ((1 << 60, 1 << 22, 1 << 16), (0, 1 << 22, 1 << 16), (0, 0, 20)):
        for name, value in (("KEPT_FROM", least), ("DENSE", dense), ("BLOCK", block), ("PACK", 100)):
            monkeypatch.setattr(boosting, name, value)
        models.append(training.train_trees(data, data, rounds=2, depth=4, early_stop=2))
        levels.append(list(asked))
        asked.clear()
    for m in models[1:]:
        assert m.losses == models[0].losses
        for name in ("feature", "cut", "value"):
            assert (getattr(m.trees, name) == getattr(models[0].trees, name)).all()
    siblings = [sum((k, n + 1) in nodes for k, n in nodes if n % 2) for nodes in (set().union(*level) for level in levels)]
    assert siblings[0] > 0 and siblings[1] < siblings[0]
    assert all(not any(n % 2 and (k, n + 1) in nodes for k, n in nodes) for level in levels[1:] for nodes in level)


def test_flat_vectors_hold_the_same_entries(spark):
    vectors = [Vectors.dense([1.5, 0.0, -2.0]), None, Vectors.sparse(9, {}), Vectors.sparse(9, {0: 0.0, 4: 3.0, 8: -1.0}), Vectors.dense([]), Vectors.dense([0.0, 7.0]), Vectors.sparse(3, {2: 1.0})]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT())]))
    table = df.coalesce(1).orderBy("id").select(flat_vector("features").alias("flat")).toArrow()
    assert str(table.schema.field("flat").type) == "list<element: double>"
    flat = VectorBatch(table["flat"])
    assert flat.rows == 7 and flat.row.tolist() == [0, 0, 3, 3, 5, 6]
    assert flat.index.tolist() == [0, 2, 4, 8, 1, 2] and flat.value.tolist() == [1.5, -2.0, 3.0, -1.0, 7.0, 1.0]


def test_trees_of_few_columns_step_alike_for_equal_rows():
    rng = np.random.Generator(np.random.PCG64(5))
    trees = Trees.leaves(3, 4, 2)
    trees.feature[..., :15], trees.cut[..., :15] = rng.integers(0, 2, (2, 3, 15)), rng.normal(size=(2, 3, 15))
    trees.value[:] = rng.normal(size=trees.value.shape)
    columns = np.round(rng.normal(size=(500, 2)))
    together, alone = np.zeros((500, 3)), np.zeros((500, 3))
    trees.add(together, columns, trees.used())
    for i in range(500):
        trees.add(alone[i : i + 1], columns[i : i + 1], trees.used())
    assert (together == alone).all()


def test_jobs_of_a_round_do_not_grow_with_classes(spark):
    counts = {}
    for classes in (2, 25):
        x = np.arange(500)[:, None] % classes + 1.0
        data = frame(spark, x, (x[:, 0] - 1).astype(int))
        _, few = jobs_of(spark, lambda: training.train_trees(data, rounds=1, depth=4))
        model, many = jobs_of(spark, lambda: training.train_trees(data, rounds=4, depth=4))
        counts[classes] = (many - few) / 3
        assert counts[classes] <= 4 * 4  # some jobs for each of four levels: shuffle stages run by the adaptive plan
    assert counts[25] <= counts[2] * 4 + 1 and counts[25] <= 16


def test_drawn_rows_and_columns(spark, drawn):
    x, y = drawn
    model = training.train_trees(frame(spark, x, y), rounds=20, depth=3, subsample=0.5, columns=0.5, eta=0.3)
    assert training.holdout_accuracy(model, frame(spark, x, y)) > 0.9
    again = training.train_trees(frame(spark, x, y, parts=3), rounds=20, depth=3, subsample=0.5, columns=0.5, eta=0.3)
    assert (model.trees.feature == again.trees.feature).all()
    kept = boosting._drawn(np.arange(10_000), 0.3, 4, 42)
    assert 0.27 < kept.mean() < 0.33 and (kept != boosting._drawn(np.arange(10_000), 0.3, 5, 42)).any()


def test_bins():
    bins = Bins.of({0: [1.0, 2.0, 5.0], 2: [-3.0, -1.0], 3: [7.0]}, 4)
    assert bins.start.tolist() == [0, 4, 5, 9, 11]
    feature = np.array([0, 0, 0, 0, 0, 1, 1, 2, 2, 2, 2, 2, 3, 3])
    value = np.array([-1.0, 0.0, 1.0, 1.5, 9.0, -1.0, 4.0, -9.0, -2.0, -1.0, -0.5, 0.0, 0.0, 7.0])
    assert bins.find(feature, value).tolist() == [0, 0, 1, 2, 3, 4, 4, 5, 6, 6, 7, 8, 9, 10]
    assert bins.cut_of(np.array([0, 2, 3]), np.array([2, 0, 0])).tolist() == [2.0, -3.0, 0.0]


def test_best_split_tries_every_cut():
    rng = np.random.Generator(np.random.PCG64(8))
    for _ in range(50):
        lengths = rng.integers(1, 6, 7)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        zero = starts + rng.integers(0, lengths)
        full_g = [rng.integers(-5, 6, n) * STEPS for n in lengths]
        full_h = [rng.integers(0, 3, n) * STEPS for n in lengths]
        total_g, total_h = 9 * STEPS, 30 * STEPS
        for f in range(7):  # every feature's bins add up to the node's sums
            z = zero[f] - starts[f]
            full_g[f][z] += total_g - full_g[f].sum()
            full_h[f][z] += total_h - full_h[f].sum()
        g, h = (np.concatenate(w).astype(float) for w in (full_g, full_h))
        g[zero] = h[zero] = 0
        best, place = 1e-9, (-1, 0)
        for f in range(7):
            for c in range(lengths[f] - 1):
                lg, lh = full_g[f][: c + 1].sum(), full_h[f][: c + 1].sum()
                rg, rh, ridge = total_g - lg, total_h - lh, RIDGE * STEPS
                if min(lh, rh) >= LEAST_CURVE * STEPS:
                    gain = (lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - total_g**2 / (total_h + ridge)) / STEPS
                    if gain > best:
                        best, place = gain, (f, c)
        found = best_split(g, h, starts, zero, total_g, total_h, np.ones(7, bool))
        assert found[1:3] == place


def test_vectors_of_both_kinds():
    import pyarrow as pa

    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows = [
        {"type": 0, "size": 6, "indices": [1, 4], "values": [2.0, 0.0]}, {"type": 1, "size": None, "indices": None, "values": [0.0, 3.0, 4.0]},
        {"type": 0, "size": 6, "indices": [], "values": []}, {"type": 0, "size": 6, "indices": [5], "values": [7.0]},
    ]
    batch = VectorBatch(pa.array(rows, kind))
    assert list(zip(batch.row.tolist(), batch.index.tolist(), batch.value.tolist())) == [(0, 1, 2.0), (1, 1, 3.0), (1, 2, 4.0), (3, 5, 7.0)]
    assert batch.columns(np.array([1, 5])).tolist() == [[2.0, 0.0], [3.0, 0.0], [0.0, 0.0], [0.0, 7.0]]
    assert VectorBatch(pa.array(rows, kind).slice(3)).columns(np.array([5])).tolist() == [[7.0]]
    assert VectorBatch(pa.array([], kind)).rows == 0


def test_linear_equals_separate_fits(spark, drawn):
    x, y = drawn
    data = frame(spark, x, y).persist()
    model = training.train_linear(data, reg=0.01, max_iter=200)
    apart = OneVsRest(classifier=LogisticRegression(regParam=0.01, maxIter=200, tol=1e-10)).fit(data)
    for k, single in enumerate(apart.models):
        assert np.abs(model.coefficients[k] - single.coefficients.toArray()).max() < 0.02
        assert abs(model.intercepts[k] - single.intercept) < 0.02
    rows = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["i", "features"])
    ours, theirs = (m.transform(rows).orderBy("i").collect() for m in (model, apart))
    assert sum(a["prediction"] == b["prediction"] for a, b in zip(ours, theirs, strict=True)) >= 0.99 * len(x)
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in ours)


def test_linear_jobs_do_not_grow_with_classes(spark, monkeypatch):
    counts = []
    for classes in (2, 20):
        x = np.eye(classes)[np.arange(200) % classes]
        data = frame(spark, x, np.arange(200) % classes)
        model, jobs = jobs_of(spark, lambda: training.train_linear(data, max_iter=5))
        counts.append((jobs, model.passes))
        assert training.holdout_accuracy(model, data) == 1.0
    assert counts[1][0] / counts[1][1] <= counts[0][0] / counts[0][1] + 1 and counts[1][1] <= 15
    from caseworks.operators import linear

    monkeypatch.setattr(linear, "HELD", 1)
    alone = training.train_linear(data, max_iter=5)
    assert np.abs(alone.coefficients - model.coefficients).max() < 1e-9


def test_models_survive_saving(spark, drawn, tmp_path):
    x, y = drawn
    data = frame(spark, x, y)
    for model, loader in ((training.train_linear(data, max_iter=3), "LinearModel"), (training.train_trees(data, rounds=2, depth=2), "SoftmaxTreesModel")):
        model.save(spark, str(tmp_path / loader))
        again = training.OWN_MODELS[loader].load(spark, str(tmp_path / loader))
        rows = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["i", "features"])
        a, b = (m.transform(rows).orderBy("i").collect() for m in (model, again))
        assert a == b
    assert isinstance(Trees.leaves(3, 2), Trees)
