"""Params, Spark's Pipeline, saving through Spark, and CrossValidator over the operators."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tabforge.operators.clean import GroupMedianImputer, ModeImputer, RoleImputer
from tabforge.operators.encode import OneHotEncoder, RobustScaler, RobustScalerModel, TargetEncoder
from tabforge.operators.features import CastColumns, DerivedColumns, DerivedSpec, OrdinalMapper
from tabforge.operators.knn import KNNImputer
from tabforge.operators.linear import L1Selector, Lasso, LinearRegressionModel, Ridge, RidgeCV
from tabforge.operators.power import SkewRouter, YeoJohnson
from tabforge.operators.trees import GBT
from tabforge.operators.validate import LinearCV, assign_folds, fold_scores, score_summary


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, float(i % 17), float((i * 7) % 23), "abc"[i % 3], f"g{i % 4}", None if i % 5 == 0 else float(i % 11), None if i % 7 == 0 else "pq"[i % 2],
             2.0 * (i % 17) - (i % 3) + ((i * 13) % 10) / 10) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, seg string, grp string, front double, qual string, y double")
    return assign_folds(df, "id", 4).cache()


STAGES = [
    lambda: RoleImputer(semantic_cat=["qual"], fallback=True), lambda: ModeImputer(["qual"]), lambda: GroupMedianImputer("front", "grp"),
    lambda: OrdinalMapper({"qual": {"p": 1, "q": 2}}), lambda: CastColumns(["x1"], "string"),
    lambda: DerivedColumns(DerivedSpec(sums={"s": [("x1", 1.0), ("x2", 0.5)]}, flags={"f": "x1"})),
    lambda: RobustScaler(["x1", "x2"]), lambda: OneHotEncoder(["seg"]), lambda: TargetEncoder(["seg"], "y"), lambda: YeoJohnson(["x1"]),
    lambda: SkewRouter(["x1", "x2"]), lambda: KNNImputer(["front", "qual"], ["x1", "x2", "front", "qual"], "id"),
    lambda: Ridge(["x1", "x2"], "y", 10.0), lambda: Lasso(["x1", "x2"], "y", 0.01), lambda: RidgeCV(["x1"], "y", [0.1, 1.0]),
    lambda: L1Selector(["x1", "x2"], "y", 0.01), lambda: GBT(["x1", "x2"], "y", {"max_depth": 2}, 2, "id"),
]


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("make", STAGES, ids=lambda m: type(m()).__name__)
def test_stage_in_a_pipeline_saved_and_loaded(spark, data, tmp_path, make):
    stage = make()
    for p in stage.params:
        assert stage.hasParam(p.name) and stage.getParam(p.name) is p
        assert stage.isSet(p) and stage.getOrDefault(p) == getattr(stage, p.name)
    assert stage.explainParams() and set(stage.extractParamMap()) == set(stage.params)
    path = f"file://{tmp_path}"
    Pipeline(stages=[stage]).save(f"{path}/estimator")
    loaded = Pipeline.load(f"{path}/estimator")
    again = loaded.getStages()[0]
    assert type(again) is type(stage) and again.uid == stage.uid
    model = Pipeline(stages=[stage]).fit(data)
    want = table(model.transform(data))
    assert table(loaded.fit(data).transform(data)) == want
    model.save(f"{path}/model")
    assert table(PipelineModel.load(f"{path}/model").transform(data)) == want
    model.stages[0].write().overwrite().save(f"{path}/alone")
    assert table(type(model.stages[0]).load(f"{path}/alone").transform(data)) == want


def test_several_stages_in_one_pipeline(data, spark, tmp_path):
    pipe = Pipeline(stages=[RoleImputer(semantic_cat=["qual"], fallback=True), OrdinalMapper({"qual": {"p": 1, "q": 2}}, default=0),
                            RobustScaler(["x1", "x2"]), OneHotEncoder(["seg"]), Ridge(["x1", "x2", "qual", "seg_a", "seg_b"], "y", 1.0)])
    model = pipe.fit(data)
    model.save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    assert table(back.transform(data)) == table(model.transform(data))
    assert isinstance(back.stages[-1], LinearRegressionModel)


def test_param_maps_copy_and_change(data):
    ridge = Ridge(["x1", "x2"], "y", 10.0)
    other = ridge.copy({ridge.getParam("alpha"): 0.5})
    assert (ridge.alpha, other.alpha, other.uid) == (10.0, 0.5, ridge.uid)
    assert ridge.fit(data, {ridge.getParam("alpha"): 0.5}).coef.tolist() == Ridge(["x1", "x2"], "y", 0.5).fit(data).coef.tolist()
    many = ridge.fit(data, [{ridge.getParam("alpha"): a} for a in (0.1, 10.0)])
    assert [m.alpha for m in many] == [0.1, 10.0]
    other.alpha = 3.0
    assert other.getOrDefault("alpha") == 3.0 and ridge.alpha == 10.0
    with pytest.raises(ValueError):
        ridge.getParam("nothing")
    lasso = Lasso(["x1"], "y", 0.1)
    assert {p.name for p in lasso.params} == {"features", "label", "alpha", "prediction_col"}
    assert Ridge(["x1"]).fit(data.withColumn("label", F.col("y"))).copy().features == ["x1"]


def test_wrong_class_is_refused(data, spark, tmp_path):
    RobustScaler(["x1"]).fit(data).save(f"file://{tmp_path}/s")
    assert isinstance(RobustScalerModel.load(f"file://{tmp_path}/s"), RobustScalerModel)
    with pytest.raises(TypeError):
        LinearRegressionModel.load(f"file://{tmp_path}/s")


@pytest.mark.parametrize("kind", [Ridge, Lasso])
def test_cross_validator_with_fold_column_equals_fold_scores(data, kind):
    estimator = kind(["x1", "x2"], "y", 1.0)
    alphas = [0.01, 1.0, 100.0]
    grid = ParamGridBuilder().addGrid(estimator.getParam("alpha"), alphas).build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"),
                        numFolds=4, foldCol="fold", parallelism=4).fit(data)
    for a, got in zip(alphas, cv.avgMetrics):
        oof = LinearCV(kind(["x1", "x2"], "y", a)).fit(data).oof(data)
        assert abs(score_summary(fold_scores(oof, "y", "oof")).first()["mean_rmse"] - got) < 1e-9
    best = alphas[min(range(3), key=lambda i: cv.avgMetrics[i])]
    assert cv.bestModel.alpha == best


def test_cross_validator_over_a_pipeline(data):
    ridge = Ridge(["x1", "seg"], "y", 1.0)
    pipe = Pipeline(stages=[TargetEncoder(["seg"], "y"), ridge])
    grid = ParamGridBuilder().addGrid(ridge.getParam("alpha"), [0.1, 50.0]).build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=4, foldCol="fold").fit(data)
    for a, got in zip((0.1, 50.0), cv.avgMetrics):
        errors = []
        for k in range(4):
            train, test = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
            te = TargetEncoder(["seg"], "y").fit(train)
            out = Ridge(["x1", "seg"], "y", a).fit(te.transform(train)).transform(te.transform(test))
            errors.append(out.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0])
        assert abs(sum(errors) / 4 - got) < 1e-9
