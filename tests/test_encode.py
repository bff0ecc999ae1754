import math

from tabforge.operators.encode import OneHotEncoder, RobustScaler, TargetEncoder, first_appearance_codes


def test_one_hot_unseen_and_null_are_zero(spark):
    fit = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "id int, c string")
    score = spark.createDataFrame([(4, "a"), (5, "zz"), (6, None)], "id int, c string")
    m = OneHotEncoder(["c"]).fit(fit)
    assert m.output_cols == ["c_a", "c_b"]
    got = {r.id: (r.c_a, r.c_b) for r in m.transform(score).collect()}
    assert got == {4: (1.0, 0.0), 5: (0.0, 0.0), 6: (0.0, 0.0)}


def test_robust_scaler_zero_iqr_divides_by_one(spark):
    df = spark.createDataFrame([(i, float(i), 0.0 if i < 9 else 5.0) for i in range(10)], "id int, x double, z double")
    m = RobustScaler(["x", "z"]).fit(df)
    assert m.center["x"] == 4.5 and abs(m.scale["x"] - 4.5) < 1e-12
    assert m.center["z"] == 0.0 and m.scale["z"] == 1.0
    got = {r.id: r.z for r in m.transform(df).collect()}
    assert got[9] == 5.0


def test_target_encoder(spark):
    rows = [(i, "a", 1.0) for i in range(30)] + [(100, "b", 5.0)] + [(101, "c", 2.0), (102, "c", 4.0)]
    df = spark.createDataFrame(rows, "id int, k string, y double")
    prior = sum(r[2] for r in rows) / len(rows)
    m = TargetEncoder(["k"], "y").fit(df)
    w30 = 1 / (1 + math.exp(-(30 - 20) / 10))
    w2 = 1 / (1 + math.exp(-(2 - 20) / 10))
    assert abs(m.maps["k"]["a"] - (prior * (1 - w30) + 1.0 * w30)) < 1e-12
    assert m.maps["k"]["b"] == prior  # a level seen once gets the prior
    assert abs(m.maps["k"]["c"] - (prior * (1 - w2) + 3.0 * w2)) < 1e-12
    score = spark.createDataFrame([(1, "unseen", 0.0), (2, None, 0.0)], "id int, k string, y double")
    assert all(abs(r.k - prior) < 1e-12 for r in m.transform(score).collect())


def test_first_appearance_codes(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, None), (4, "y"), (5, "z")], "id int, c string")
    got = {r.value: r.code for r in first_appearance_codes(df, "c", "id").collect()}
    assert got == {"y": 0, "x": 1, "z": 2}
