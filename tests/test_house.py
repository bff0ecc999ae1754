"""House preset on a small generated table with the reference schema (subset of columns)."""

import numpy as np
from pyspark.sql import functions as F

from tabforge.plans import house

COLS = ("Id int, MSSubClass int, MSZoning string, LotFrontage double, LotArea double, Neighborhood string, "
        "Utilities string, OverallQual double, YearBuilt int, YearRemodAdd int, Exterior1st string, "
        "Exterior2nd string, ExterQual string, BsmtQual string, BsmtExposure string, TotalBsmtSF double, "
        "`1stFlrSF` double, `2ndFlrSF` double, GrLivArea double, FullBath double, HalfBath double, "
        "BsmtFullBath double, BsmtHalfBath double, KitchenQual string, Fireplaces double, GarageArea double, "
        "PoolArea double, PoolQC string, LotShape string, YrSold int, SaleType string, SalePrice double")


def _rows(n, seed, labelled=True, start=1):
    rng = np.random.default_rng(seed)
    nb = ["NAmes", "CollgCr", "OldTown", "Edwards", "Somerst"]
    rows = []
    for i in range(n):
        idx = start + i
        area = float(rng.integers(600, 3000))
        if labelled and i == 0:
            area = 4500.0                      # outlier: huge and cheap
        first = float(rng.integers(500, 1500))
        second = float(rng.choice([0.0, float(rng.integers(300, 900))]))
        bsmt = None if i % 17 == 0 else float(rng.integers(0, 1500))
        qual = float(rng.integers(3, 10))
        price = 20000 + 60 * area + 9000 * qual + float(rng.normal(0, 8000))
        if labelled and i == 0:
            price = 150000.0
        rows.append((idx, int(rng.choice([20, 60, 120])), None if i % 13 == 5 else str(rng.choice(["RL", "RM"])),
                     None if i % 6 == 0 else float(rng.integers(40, 110)), float(rng.integers(5000, 15000)),
                     nb[i % 5] if i != 3 else ("Blueste" if not labelled else nb[0]), "AllPub", qual,
                     int(rng.integers(1900, 2008)), int(rng.integers(1950, 2009)),
                     None if i % 19 == 7 else str(rng.choice(["VinylSd", "HdBoard", "MetalSd"])),
                     str(rng.choice(["VinylSd", "HdBoard", "Plywood"])), str(rng.choice(["Gd", "TA", "Ex"])),
                     None if i % 9 == 0 else str(rng.choice(["Gd", "TA"])),
                     None if i % 9 == 0 else str(rng.choice(["No", "Av", "Gd"])), bsmt, first, second, area,
                     float(rng.integers(1, 3)), float(rng.integers(0, 2)), None if i % 9 == 0 else 0.0, 0.0,
                     None if i % 23 == 11 else str(rng.choice(["Gd", "TA", "Zz"])), float(rng.integers(0, 2)),
                     float(rng.integers(0, 800)), 0.0, None, str(rng.choice(["Reg", "IR1"])), 2008,
                     str(rng.choice(["WD", "New"])), price if labelled else None))
    return rows


def test_house_variants_run_and_score(spark):
    train = spark.createDataFrame(_rows(60, 1), COLS)
    test = spark.createDataFrame(_rows(15, 2, labelled=False, start=1001), COLS).drop("SalePrice")
    prepared = house.prepare_labelled(train, house.HouseConfig())
    assert prepared.count() == 59                              # the outlier row is gone
    for variant in ("baseline", "final"):
        cfg = house.HouseConfig(variant=variant)
        pre = house.HousePreprocessor(cfg).fit(prepared)
        x = pre.transform(prepared)
        assert x.where(F.col("LotFrontage").isNull() | F.col("MSZoning").isNull()).count() == 0
        assert dict(x.dtypes)["MSSubClass"] == "string" and dict(x.dtypes)["ExterQual"] == "double"
        assert "TotalSF" in x.columns and "HasFireplace" in x.columns
        scored = house.refit_and_score(train, test, cfg)
        rows = scored.collect()
        assert len(rows) == 15 and all(r.SalePrice is not None and r.SalePrice > 0 for r in rows)
    table = house.ablation(train).collect()
    assert {r.model for r in table} == {"baseline_ridge", "final_ridge"}
    assert all(r.mean_rmse > 0 for r in table)


def test_three_switches(spark):
    train = spark.createDataFrame(_rows(80, 3), COLS).withColumn("SaleCondition", F.when(F.col("Id") % 4 == 0, "Partial").otherwise("Normal"))
    rows = house.switch_scores(train, k=2, switches=("normal_only",)).collect()
    n = {}
    for r in rows:
        n[r["model"]] = n.get(r["model"], 0) + r["n"]
    assert n == {"base": 79, "normal_only": 59, "all": 59}
    assert all(r["rmse"] > 0 for r in rows)
    pre = house.HousePreprocessor(house.HouseConfig(knn=False)).fit(house.prepare_labelled(train, house.HouseConfig()))
    assert not any(type(s).__name__ == "KNNImputerModel" for s in pre.stages)


def test_stack_of_the_preset(spark):
    train = spark.createDataFrame(_rows(70, 5), COLS)
    test = spark.createDataFrame(_rows(10, 6, labelled=False, start=1001), COLS).drop("SalePrice")
    cfg = house.HouseConfig(yeo_johnson=False, knn=False)
    model = house.fit_stack(train, cfg, {}, k=2)   # nested scores: tests/test_faults.py
    rows = model.transform(test.drop("Utilities")).collect()
    assert len(rows) == 10 and all(9 < r["prediction"] < 15 for r in rows)
    assert list(house.stack_makers(train, cfg)) == ["ridge", "lasso", "xgb", "lgbm"]
