"""The scalable running totals equal a brute-force ordered cumulative sum."""
import random

import pandas as pd
from pyspark.sql import functions as F

from cohort_spark.operators import profile
from cohort_spark.operators.ordered import md5_key, positions, quantiles, running_totals


def test_running_totals_match_bruteforce(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["g1", "g2", "g3"]), i, rnd.random() * 100, rnd.randint(0, 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long, x double, v long")
    for desc in (False, True):
        got = running_totals(df, F.col("x"), [F.col("x"), F.col("id")], {"cum": F.col("v")}, ["g"],
                             descending=desc, n_buckets=7).toPandas()
        pdf = pd.DataFrame(rows, columns=["g", "id", "x", "v"]).sort_values(
            ["g", "x", "id"], ascending=[True, not desc, not desc])
        pdf["cum"] = pdf.groupby("g")["v"].cumsum()
        m = got.merge(pdf, on="id", suffixes=("", "_bf"))
        assert len(m) == len(rows)
        assert (m["cum"] == m["cum_bf"]).all()


def test_positions_are_row_numbers_in_hash_order(spark):
    df = spark.range(2000).withColumn("cls", (F.col("id") % 3).cast("int"))
    h, pre = md5_key(42, F.col("id"))
    got = positions(df.withColumns({"h": h, "hp": pre}), F.col("hp"), [F.col("h")], ["cls"],
                    n_buckets=5).toPandas()
    for _, grp in got.groupby("cls"):
        assert list(grp.sort_values("h")["pos"]) == list(range(1, len(grp) + 1))


def test_quantiles_are_exact_at_every_size(spark):
    n = 1_200_000
    df = spark.range(n).select((F.col("id") * F.col("id")).cast("double").alias("x"), F.lit(1.0).alias("one"),
                               F.when(F.col("id") < 4, F.col("id")).alias("few"))
    got = {r["column"]: r for r in profile.numeric_summary(df, ["x", "one", "few"]).collect()}
    at = 0.25 * (n - 1)
    low = int(at)
    assert got["x"]["p25"] == (low + 1 - at) * low ** 2 + (at - low) * (low + 1) ** 2
    assert (got["one"]["p01"], got["few"]["median"]) == (1.0, 1.5)


def test_quantiles_match_percentile(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, float("inf"), -0.0, 0.0, rnd.random()]), rnd.randint(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b int")
    probs = [i / 10 for i in range(11)]
    got = {r["column"]: r["q"] for r in quantiles(df, ["a", "b"], probs).collect()}
    for c in ("a", "b"):
        assert got[c] == df.agg(F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, probs)))).first()[0]


def test_null_groups_and_keys_have_running_totals(spark):
    rows = [(None if i % 3 else "g", None if i < 5 else float(i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, x double, id long")
    got = {r["id"]: r["c"] for r in running_totals(df, F.col("x"), [F.col("x"), F.col("id")], {"c": F.lit(1)}, ["g"], n_buckets=4).collect()}
    for rest in ([i for i in range(200) if i % 3], [i for i in range(200) if not i % 3]):
        assert [got[i] for i in rest] == list(range(1, len(rest) + 1))


def test_constant_key_single_bucket(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(50)], "id long, x double")
    got = running_totals(df, F.col("x"), [F.col("x"), F.col("id")], {"c": F.lit(1)},
                         n_buckets=5).toPandas()
    assert sorted(got["c"]) == list(range(1, 51))


def test_two_level_top_k_is_exact(spark):
    from cohort_spark.operators.common import top_k_per_group
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b"]), f"v{i}", rnd.randint(0, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v string, n long")
    got = top_k_per_group(df, ["g"], [F.desc("n"), F.asc("v")], 30, buckets=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "v", "n"]).sort_values(["g", "n", "v"], ascending=[True, False, True])
    want = pdf.groupby("g").head(30)
    assert sorted(zip(got.g, got.v)) == sorted(zip(want.g, want.v))
    assert set(got["rank"]) == set(range(1, 31))


def test_hash_split_mode_is_disjoint_deterministic(spark):
    from cohort_spark.operators.split import stratified_split
    df = spark.range(20000).withColumn("target", (F.col("id") % 10 == 0).cast("int"))
    a = stratified_split(df, "id", "target", mode="hash")
    b = stratified_split(df, "id", "target", mode="hash")
    assert a.exceptAll(b).count() == 0
    share = a.where("split = 'test'").count() / 20000
    assert 0.18 < share < 0.22


def test_approx_roles_match_exact_roles_on_low_cardinality(spark, sf_dir):
    from cohort_spark.operators.profile import infer_roles
    from cohort_spark.plans.jobs_profile import eda_frame
    df = eda_frame(spark, sf_dir)
    ex = {r.column: r.role for r in infer_roles(df).collect()}
    ap = {r.column: r.role for r in infer_roles(df, approx=True).collect()}
    assert ex == ap
