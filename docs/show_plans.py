"""Print the static physical plan of registered jobs (AQE off)."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohort_spark import get_spark  # noqa: E402
from cohort_spark.plans.catalog import QUERIES  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or ["flagship_diag_rates", "first_encounter_coalesce", "roc_auc"]
    spark = get_spark()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for k in keys:
        print(f"=== {k}")
        QUERIES[k](spark, sf_dir).explain("formatted")
