"""Tree counts chosen from the data, and many configurations on the same folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators.trees import GBT, FoldTrainer, prepared
from tabforge.operators.validate import assign_folds


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.integers(0, 5, 400)
    rows = [(i, float(x), float(k), float(np.sin(x) + 0.3 * k + rng.normal(0, 0.4))) for i, (x, k) in enumerate(zip(a, b))]
    return assign_folds(spark.createDataFrame(rows, "id long, a double, b double, y double"), "id", 3).cache()


PARAMS = {"n_estimators": 40, "learning_rate": 0.3, "max_depth": 2, "subsample": 0.8}


def test_chosen_count_is_the_best_on_the_held_rows(data):
    gbt = GBT(["a", "b"], "y", PARAMS, id_col="id", choose_trees=True, first_trees=8)
    model = gbt.fit(data)
    held = F.pmod(F.xxhash64(F.col("id"), F.lit(42)), F.lit(10)) == 0
    whole = GBT(["a", "b"], "y", PARAMS, id_col="id").fit(data.where(~held))
    staged = whole.model.evaluateEachIteration(whole.asm.transform(data.where(held)), "squared")
    assert np.allclose(staged[:len(model.errors)], model.errors, rtol=0, atol=1e-12)   # a shorter fit is a prefix of a longer one
    best = int(np.argmin(model.errors)) + 1
    assert model.n_trees == best and (best <= 0.75 * len(model.errors) or len(model.errors) == 40)
    refit = GBT(["a", "b"], "y", PARAMS, best, "id").fit(data)
    a = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    assert a == {r["id"]: r["prediction"] for r in refit.transform(data).collect()}


def test_choice_without_held_rows_takes_the_count_of_the_parameters(data):
    few = data.where(F.pmod(F.xxhash64(F.col("id"), F.lit(42)), F.lit(10)) != 0)
    assert GBT(["a"], "y", {"n_estimators": 3}, id_col="id", choose_trees=True).fit(few).n_trees == 3


def test_fold_trainer_equals_fits_of_each_fold(data):
    with FoldTrainer(data, ["a", "b"], "y", "id") as folds:
        assert folds.folds == [0, 1, 2]
        got = folds.scores(PARAMS, 5)
    for k, score in zip(range(3), got):
        model = GBT(["a", "b"], "y", PARAMS, 5, "id").fit(data.where(F.col("fold") != k))
        out = model.transform(data.where(F.col("fold") == k))
        assert abs(out.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0] - score) < 1e-9


def test_tasks_of_a_tree_grow_slowly_with_the_rows(spark):
    """A job of a tree has as many tasks as partitions: 45 of 20,000 rows cost more than the work in them."""
    rows = spark.range(450_000).select("id", (F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("y"))
    _, data, n = prepared(rows, ["a"], ["y"], "id")
    assert n == data.rdd.getNumPartitions() == 3
    assert prepared(rows.limit(90_000), ["a"], ["y"], "id")[2] == 1


def test_node_ids_are_not_stored_and_change_nothing(data):
    gbt = GBT(["a", "b"], "y", PARAMS, 5, "id")
    assert not gbt.booster().getCacheNodeIds()
    _, rows, _ = prepared(data, ["a", "b"], ["y"], "id")
    want = gbt.booster().setCacheNodeIds(True).fit(rows).transform(rows)
    got = gbt.fit(data).transform(data)
    assert {r["id"]: r["prediction"] for r in got.collect()} == {r["id"]: r["prediction"] for r in want.collect()}


PUBLISHED = {"n_estimators": 64, "learning_rate": 0.1, "max_depth": 5, "min_child_weight": 5, "subsample": 0.6, "colsample_bytree": 0.5}


def _wide(spark, rows=900):
    rng = np.random.default_rng(8)
    a, b, c, d = rng.normal(size=rows), rng.integers(0, 9, rows), rng.integers(0, 2, rows), rng.normal(size=rows)
    y = np.sin(2 * a) + 0.2 * b + c * d + rng.normal(0, 0.3, rows)
    out = [(i, float(a[i]), float(b[i]), float(c[i]), float(d[i]), float(y[i])) for i in range(rows)]
    return assign_folds(spark.createDataFrame(out, "id long, a double, b double, c double, d double, y double"), "id", 3)


def test_draws_are_those_of_spark(spark):
    from tabforge.operators import cells
    random = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom
    drawn = cells.Draws([70, 0, 300], 0.6, 42).of(5, 3)
    assert drawn.shape == (3, 370)
    for tree in range(3):
        for part, rows in ((0, drawn[tree, :70]), (2, drawn[tree, 70:])):
            r = random(42 + 5 + tree + part + 1)
            assert [r.nextDouble() < 0.6 for _ in rows] == rows.tolist()


@pytest.mark.parametrize("parts", [1, 3])
def test_coded_rows_give_the_trees_of_spark(spark, parts):
    """Rows and features drawn, one and several partitions: the same splits, predictions to rounding."""
    import re
    rows = _wide(spark).cache()
    a, b = (GBT(["a", "b", "c", "d"], "y", PUBLISHED, 6 if not coded else None, "id", parts, coded=coded).fit(rows) for coded in (False, True))
    shape = lambda t: re.sub(r"Predict: .*", "", t.toDebugString.split("\n", 1)[1])
    assert [shape(t) for t in a.model.trees] == [shape(t) for t in b.model.trees[:6]] and b.n_trees == 64
    assert np.allclose(a.model.treeWeights, b.model.treeWeights[:6])
    for x, z in zip(a.model.trees, b.model.trees):
        assert np.allclose(x.featureImportances.toArray(), z.featureImportances.toArray(), atol=1e-9)
        values = [[float(v) for v in re.findall(r"Predict: (\S+)", t.toDebugString)] for t in (x, z)]
        assert np.allclose(*values, rtol=0, atol=1e-9)


def test_coded_models_predict_as_spark_and_are_kept(spark, tmp_path):
    rows = _wide(spark, 300).cache()
    model = GBT(["a", "b", "c", "d"], "y", PUBLISHED, None, "id", coded=True).fit(rows)
    odd = rows.withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a") * 3))
    mine = [r["prediction"] for r in model.transform(odd).orderBy("id").collect()]
    model.write().overwrite().save(str(tmp_path / "m"))
    back = type(model).load(str(tmp_path / "m"))
    assert back.n_trees == 64 and [r["prediction"] for r in back.transform(odd).orderBy("id").collect()] == mine
    spark_model = model.model.transform(model.asm.transform(odd)).orderBy("id").collect()
    assert np.allclose(mine, [r["prediction"] for r in spark_model], rtol=0, atol=1e-9)


def test_searches_fit_the_count_of_their_parameters(spark):
    """Scores of whole trials, by coded rows, equal fits of each fold."""
    rows = _wide(spark, 400).cache()
    with FoldTrainer(rows, ["a", "b", "c"], "y", "id") as folds:
        got = folds.scores(PUBLISHED | {"n_estimators": 80})
    for k, score in enumerate(got):
        model = GBT(["a", "b", "c"], "y", PUBLISHED | {"n_estimators": 80}, None, "id", coded=True).fit(rows.where(F.col("fold") != k))
        assert model.n_trees == 80
        out = model.transform(rows.where(F.col("fold") == k))
        assert abs(out.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0] - score) < 1e-9


def test_queries_fit_whole_models(spark, monkeypatch):
    """gbt_cv and search_trials fitted 20 trees instead of the count of their configurations."""
    from tabforge.operators import cells
    from tabforge.plans import catalogue
    fits = []

    def seen(spark, some, result):
        fits.extend(how["trees"] for _, how in some)
        return run(spark, [(rows, how | {"trees": 2}) for rows, how in some], result)
    run = cells.run_fits
    monkeypatch.setattr(cells, "run_fits", seen)
    c = catalogue.assign_folds(spark.createDataFrame([(i, float(i % 7), float(i % 31), "AB"[i % 2], float(i % 5)) for i in range(200)],
                                                     "id long, x1 double, x2 double, seg string, y double"), "id", k=5, seed=42)
    monkeypatch.setattr(catalogue, "c_folds", lambda spark, sf_dir: c)
    assert catalogue.gbt_cv(spark, "").count() == 10 and fits == [1000] * 10
    fits.clear()
    trials = catalogue.search_trials(spark, "").collect()
    assert sorted(fits) == sorted(5 * [r["n_estimators"] for r in trials]) and min(fits) >= 100 and len(fits) == 100


def test_chosen_count_by_coded_rows(spark, monkeypatch):
    from tabforge.operators import cells, trees
    monkeypatch.setattr(trees, "CODED_FROM", 1)
    rows = _wide(spark).cache()
    make = lambda coded: GBT(["a", "b", "c"], "y", PUBLISHED, 8, "id", choose_trees=True, first_trees=4, coded=coded)
    a, b = make(False).fit(rows), make(True).fit(rows)
    assert np.allclose(a.errors, b.errors, atol=1e-9) and a.n_trees == b.n_trees
    monkeypatch.setattr(cells, "MAX_CELLS", 10)   # too many cells: Spark's own fit
    assert make(True).fit(rows).errors == a.errors
