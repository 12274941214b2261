"""The shared stages on larger tables: how they are written and shuffled."""
import pytest
from pyspark.sql import functions as F

from cohort_spark.sources import encounters, order_stats


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(i, i % 3 if i else None) for i in range(12)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 5, 2.0), (1, 5, 3.0), (1, 6, 1.0), (2, None, 4.0), (None, 7, 9.0)],
                          "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_order_lines_are_shuffled_once(spark, tables):
    df = order_stats(spark, tables)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    rows = {r.l_orderkey: (r.n_li, r.qty, r.n_part) for r in df.where("l_orderkey IS NOT NULL").collect()}
    assert rows == {1: (3, 6, 2), 2: (1, 4, 0)}


def test_clean_stage_writes_facts_not_the_wide_view(spark, tables, monkeypatch):
    from cohort_spark.plans import catalog
    written = {}
    real = catalog.materialize

    def noted(df, name):
        written[name] = df
        return real(df, name)

    monkeypatch.setattr(catalog, "materialize", noted)
    catalog.clean_scored(spark, tables, "coalesce")
    assert sorted(written) == ["clean-coalesce", "encounter-facts"]
    assert len(written["encounter-facts"].columns) == 5
    assert "REBALANCE" in written["encounter-facts"]._jdf.queryExecution().executedPlan().toString()  # patients lie together
    # the view is the same rows as before, with every column
    view = catalog.encounter_table(spark, tables)
    wanted = encounters(spark, tables)
    assert view.columns == wanted.columns
    assert view.exceptAll(wanted).isEmpty() and wanted.exceptAll(view).isEmpty() and view.where(F.col("patient_nbr").isNull()).count() == 1
