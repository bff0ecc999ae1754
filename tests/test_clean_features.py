from pyspark.sql import functions as F

from tabforge.functions.exprs import null_safe_sum, presence_flag
from tabforge.operators.audit import modes
from tabforge.operators.clean import GroupMedianImputer, ModeImputer, RoleImputer, drop_where
from tabforge.operators.features import CastColumns, DerivedColumns, DerivedSpec, OrdinalMapper


def test_drop_where_keeps_null_operands(spark):
    df = spark.createDataFrame([(1, 5000.0, 1.0), (2, 5000.0, None), (3, None, 1.0), (4, 10.0, 1.0)],
                               "id int, a double, b double")
    kept = sorted(r.id for r in drop_where(df, (F.col("a") > 4000) & (F.col("b") < 3)).collect())
    assert kept == [2, 3, 4]


def test_mode_tie_takes_smallest_and_all_null(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, "b", None), (4, "a", None), (5, None, None)],
                               "id int, k string, z string")
    m = {r["column"]: r["mode"] for r in modes(df, ["k", "z"]).collect()}
    assert m == {"k": "a"}
    out = ModeImputer(["k", "z"]).fit(df).transform(df)
    assert out.where("id = 5").first()["k"] == "a"
    assert out.where("z is null").count() == 5


def test_numeric_mode_tie_is_numeric(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 9.0), (3, 10.0), (4, 9.0), (5, None)], "id int, x double")
    out = ModeImputer(["x"]).fit(df).transform(df)
    assert out.where("id = 5").first()["x"] == 9.0


def test_group_median_edges(spark):
    fit = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, 10.0),
                                 (6, "c", 4.0)], "id int, g string, x double")
    score = spark.createDataFrame([(7, "a", None), (8, "b", None), (9, "zz", None), (10, None, None), (11, "c", 2.0)],
                                  "id int, g string, x double")
    model = GroupMedianImputer("x", "g").fit(fit)
    got = {r.id: r.x for r in model.transform(score).collect()}
    overall = 3.5  # median of 1, 3, 10, 4
    assert got == {7: 2.0, 8: overall, 9: overall, 10: overall, 11: 2.0}


def test_role_imputer(spark):
    df = spark.createDataFrame([(1, None, None, "x", None, 1), (2, "q", 2.0, None, "k", None), (3, "q", 1.0, "x", None, 3)],
                               "id int, sc string, sn double, gc string, other string, n int")
    out = RoleImputer(["sc"], ["sn"], ["gc"]).fit(df).transform(df)
    r = {x.id: x for x in out.collect()}
    assert r[1].sc == "None" and r[1].sn == 0.0 and r[1].other == "None"
    assert r[2].gc == "x" and r[2].n == 0


def test_derived_and_ordinal(spark):
    df = spark.createDataFrame([(1, 1.0, None, 2, 2000, "Gd"), (2, None, None, None, 1990, "Zz")],
                               "id int, a double, b double, c int, yb int, q string")
    spec = DerivedSpec(sums={"s": [("a", 1.0), ("b", 0.5), ("missing_col", 1.0)]}, diffs={"age": ("c", "yb")},
                       flags={"has_a": "a", "has_b": "b"})
    out = OrdinalMapper({"q": {"Ex": 5, "Gd": 4}, "absent": {"x": 1}}).transform(DerivedColumns(spec).transform(df))
    r = {x.id: x for x in out.collect()}
    assert r[1].s == 1.0 and r[2].s == 0.0
    assert r[1].age == 2 - 2000 and r[2].age is None
    assert (r[1].has_a, r[1].has_b, r[2].has_a) == (1, 0, 0)
    assert (r[1].q, r[2].q) == (4.0, 0.0)
    assert CastColumns(["c", "nope"]).transform(df).schema["c"].dataType.simpleString() == "string"


def test_expr_helpers(spark):
    df = spark.createDataFrame([(None, 2.0), (1.0, None)], "a double, b double")
    got = df.select(null_safe_sum(["a", "b"], [1.0, 0.5]).alias("s"), presence_flag("a").alias("f")).collect()
    assert [(r.s, r.f) for r in got] == [(1.0, 0), (1.0, 1)]
