import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tecframe.operators.quantiles import grouped_quantiles, quantile_by_rank


def sample(seed: int):
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        n = rng.choice([0, 1, 2, 7, 400])
        for _ in range(n):
            kind = rng.randint(0, 4)
            v = [rng.gauss(0, 1), 1e9 + rng.random() * 1e-3, float(rng.randint(-3, 3)), -rng.random() * 1e-9, None][kind]
            rows.append((g if g else None, v))
    rows += [("hot", None)] * 0
    return rows


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.77, 1.0])
def test_ranks_match_numpy(spark, p):
    rows = sample(3) + sample(4)
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["q"] for r in quantile_by_rank(df, ["g"], "v", p, "q").collect()}
    frame = pd.DataFrame(rows, columns=["g", "v"]).dropna(subset=["v"])
    want = {(None if pd.isna(k) else int(k)): np.percentile(v["v"], p * 100) for k, v in frame.groupby("g", dropna=False)}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == pytest.approx(w, rel=1e-12, abs=1e-12)


def test_both_ways_agree_for_one_huge_group_nan_and_infinities(spark):
    rng = random.Random(9)
    inf, nan = float("inf"), float("nan")
    rows = [("hot", rng.gauss(50, 20), rng.random()) for _ in range(5000)]
    rows += [(f"g{i % 40}", rng.random(), None) for i in range(800)] + [(None, 2.5, 1.0)] * 3
    rows += [("nan", v, v) for v in (1.0, 2.0, 3.0, nan, 5.0, 6.0, 7.0)] + [("inf", v, v) for v in (-inf, -0.0, 0.0, 4.0, inf, inf)] + [("none", nan, None)]
    rows += [("bunched", 1e6 + i * 1e-9, -1e6 - i * 1e-9) for i in range(500)] + [("bunched", 1e300, -1e300)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    wanted = {"ma": ("a", 0.5), "qb": ("b", 0.05)}
    extra = [F.count("a").alias("n")]
    plain = {r["g"]: tuple(r)[1:] for r in grouped_quantiles(df, ["g"], wanted, extra=extra, bounded=True).collect()}
    ranked = {r["g"]: tuple(r)[1:] for r in grouped_quantiles(df, ["g"], wanted, extra=extra).collect()}
    assert plain == ranked
    assert ranked["nan"][0] == 4.0 and ranked["inf"][0] == 2.0 and ranked["none"][:2] == (None, None)
    assert ranked["bunched"][0] == np.percentile([a for g, a, _ in rows if g == "bunched"], 50)


def test_all_metrics_share_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS g", "CAST(id AS DOUBLE) AS a", "CAST(id % 13 AS DOUBLE) AS b", "IF(id % 3 = 0, NULL, id) AS c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = grouped_quantiles(df, ["g"], {"x": ("a", 0.5), "y": ("b", 0.9), "z": ("a", 0.1)}, counts={"n": "c"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    frame = df.toPandas().groupby("g")
    got = out.toPandas().set_index("g").sort_index()
    for name, column, p in (("x", "a", 0.5), ("y", "b", 0.9), ("z", "a", 0.1)):
        assert np.allclose(got[name], frame[column].quantile(p))
    assert got["n"].tolist() == frame["c"].count().tolist()
    scans = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window") <= 6 and scans.count("FileScan") <= 2  # the second one reads a reused exchange


def test_no_job_runs_while_planning(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
    spark.sparkContext.setJobGroup("planning", "planning")
    grouped_quantiles(df, ["g"], {"m": ("v", 0.5)})
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("tests", "tests")
