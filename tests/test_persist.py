from pyspark.sql import functions as F

from tabforge.operators.clean import GroupMedianImputer, RoleImputer
from tabforge.operators.encode import OneHotEncoder, RobustScaler, TargetEncoder
from tabforge.operators.linear import Ridge
from tabforge.operators.persist import load_model, save_model
from tabforge.operators.power import YeoJohnson
from tabforge.session import scratch_dir


def test_models_round_trip(spark):
    rows = [(i, f"g{i % 3}", None if i % 5 == 0 else float(i % 11), float(i) * 1.5 - 7, ("a", "b", None)[i % 3])
            for i in range(60)]
    df = spark.createDataFrame(rows, "id long, g string, x double, y double, c string")
    models = [
        Ridge(["y"], "x", 3.0).fit(df.na.drop()),
        RobustScaler(["x", "y"]).fit(df),
        OneHotEncoder(["g"]).fit(df),
        TargetEncoder(["g"], "y").fit(df),
        YeoJohnson(["y"]).fit(df),
        GroupMedianImputer("x", "g").fit(df),
        RoleImputer(["c"], [], ["g"]).fit(df),
    ]
    for i, m in enumerate(models):
        path = scratch_dir(spark, f"model{i}")
        save_model(m, path, spark)
        back = load_model(path, spark)
        a = m.transform(df).orderBy("id")
        b = back.transform(df).orderBy("id")
        assert a.columns == b.columns
        diff = a.exceptAll(b).count() + b.exceptAll(a).count()
        assert diff == 0, type(m).__name__
    # a loaded model also works inside an expression pipeline
    assert load_model(path, spark).transform(df).where(F.col("c").isNull()).count() == 0
