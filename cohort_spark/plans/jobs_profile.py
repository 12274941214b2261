"""Jobs: profiling, dataset facts and cross-column association (EDA frame)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..operators import assoc as A
from ..operators import profile as PR
from ..sources.readers import apply_missing_mode
from .catalog import encounter_view, memo_plan, raw, register


@memo_plan
def eda_frame(spark, sf_dir):
    """Raw encounters in the profiling missing mode + binary label."""
    return PR.add_binary_target(raw(spark, sf_dir, "eda").drop("score"))


@register("infer_roles")
def infer_roles(spark, sf_dir):
    return PR.infer_roles(eda_frame(spark, sf_dir)).select("column", "role", "n_unique")


@register("column_profile")
def column_profile(spark, sf_dir):
    return PR.column_profile(eda_frame(spark, sf_dir))


@register("level_stats")
def level_stats(spark, sf_dir):
    return PR.level_stats(eda_frame(spark, sf_dir))


@register("numeric_summary")
def numeric_summary(spark, sf_dir):
    s = PR.numeric_summary(eda_frame(spark, sf_dir))
    return s.select("column", *[round_half_up(F.col(c), 6).alias(c) for c in
                                ["min", "p01", "p05", "p25", "median", "mean", "p75", "p95",
                                 "p99", "max", "std", "skew"]], "zeros_pct")


@register("decile_rates")
def decile_rates(spark, sf_dir):
    d = PR.decile_rates(eda_frame(spark, sf_dir))
    return d.select("column", "bin", round_half_up(F.col("left"), 6).alias("left"),
                    round_half_up(F.col("right"), 6).alias("right"), "count", "positive_rate")


@register("fact_pack")
def fact_pack(spark, sf_dir):
    """The nested fact documents, their main members laid flat."""
    d = PR.fact_pack(eda_frame(spark, sf_dir))
    six = lambda c: round_half_up(F.col(f"numeric.{c}"), 6).alias(c)
    told = F.transform("levels", lambda s: F.concat(s["label"], F.lit("="), s["count"].cast("string")))
    return d.select("column", "family", "role", "n", "n_missing", "pct_missing", "n_unique", "is_constant", "constant_value", "unique_key",
                    "target_lift", six("mean"), six("median"), six("std"), "numeric.zeros_pct", F.array_join(told, "; ").alias("top_levels"))


@register("target_lift")
def target_lift(spark, sf_dir):
    return PR.target_lift(eda_frame(spark, sf_dir))


@register("target_facts")
def target_facts(spark, sf_dir):
    return PR.target_facts(eda_frame(spark, sf_dir))


@register("grouping_facts")
def grouping_facts(spark, sf_dir):
    return PR.grouping_facts(eda_frame(spark, sf_dir))


@register("discharge_facts")
def discharge_facts(spark, sf_dir):
    return PR.discharge_facts(eda_frame(spark, sf_dir))


@register("co_missing")
def co_missing(spark, sf_dir):
    return PR.co_missing(eda_frame(spark, sf_dir))


@register("histogram")
def histogram(spark, sf_dir):
    return PR.histogram(eda_frame(spark, sf_dir), "num_lab_procedures", 40)


@register("missingness_rank")
def missingness_rank(spark, sf_dir):
    return PR.missingness_rank(eda_frame(spark, sf_dir))


# ---------------------------------------------------------------- association
@memo_plan
def eda_view(spark, sf_dir):
    """``eda_frame`` computed where it is read: for jobs that take one pass over few columns."""
    return PR.add_binary_target(apply_missing_mode(encounter_view(spark, sf_dir), "eda").drop("score"))


@register("corr_pearson")
def corr_pearson(spark, sf_dir):
    return A.corr_pearson(eda_view(spark, sf_dir))


@register("corr_spearman")
def corr_spearman(spark, sf_dir):
    return A.corr_spearman(eda_frame(spark, sf_dir))


@register("corr_top_pairs")
def corr_top_pairs(spark, sf_dir):
    return A.corr_top_pairs(A.corr_pearson(eda_frame(spark, sf_dir)), 8)


@register("corr_neighbors")
def corr_neighbors(spark, sf_dir):
    return A.corr_neighbors(A.corr_pearson(eda_frame(spark, sf_dir)), "number_inpatient", 6)


@register("cramers_v")
def cramers_v(spark, sf_dir):
    df = eda_frame(spark, sf_dir)
    cols = ["race", "gender", "age", "payer_code", "medical_specialty", "A1Cresult",
            "max_glu_serum", "admission_type_id"]
    v = A.cramers_v_table(A.categorical_cells(df, cols))
    return v.select("column", round_half_up(F.col("cramers_v"), 6).alias("cramers_v"), "n",
                    "n_levels")


@register("feature_association")
def feature_association(spark, sf_dir):
    return A.feature_association(eda_frame(spark, sf_dir))


@register("chapter_rates")
def chapter_rates(spark, sf_dir):
    return A.chapter_rates(eda_frame(spark, sf_dir), "diag_1")


@register("diabetes_anywhere")
def diabetes_anywhere(spark, sf_dir):
    return A.diabetes_anywhere(eda_frame(spark, sf_dir))


@register("comorbidity_rates")
def comorbidity_rates(spark, sf_dir):
    return A.comorbidity_rates(eda_frame(spark, sf_dir))


@register("medication_landscape")
def medication_landscape(spark, sf_dir):
    return A.medication_landscape(eda_frame(spark, sf_dir))


@register("medication_signal")
def medication_signal(spark, sf_dir):
    return A.medication_signal(eda_frame(spark, sf_dir))


@register("wilson_ci")
def wilson_ci(spark, sf_dir):
    return A.wilson_table(eda_frame(spark, sf_dir), "payer_code")


@register("subgroup_rates")
def subgroup_rates(spark, sf_dir):
    return A.subgroup_rates(eda_frame(spark, sf_dir), ["age", "gender", "race"])


@register("encounter_distribution")
def encounter_distribution(spark, sf_dir):
    return A.encounter_distribution(eda_frame(spark, sf_dir))


@register("leakage_overlap")
def leakage_overlap(spark, sf_dir):
    return A.leakage_overlap(eda_frame(spark, sf_dir))


@register("group_split_overlap")
def group_split_overlap(spark, sf_dir):
    return A.group_split_overlap(eda_frame(spark, sf_dir))


@register("prior_visit_signal")
def prior_visit_signal(spark, sf_dir):
    return A.prior_visit_signal(eda_frame(spark, sf_dir))


@register("factorize_codes")
def factorize_codes(spark, sf_dir):
    """Categorical levels coded by first appearance (encounter order); null -> -1."""
    from ..operators.encode import factorize
    cols = ["race", "payer_code", "medical_specialty", "A1Cresult"]
    df = eda_frame(spark, sf_dir).select("encounter_id", *cols)
    return factorize(df, cols, "encounter_id").select("encounter_id", *[f"{c}_code" for c in cols])


# ---------------------------------------------------------------- second target (documents)
def labelled_documents(spark, sf_dir):
    """Documents with their quality / toxicity labels (inner join on doc_id)."""
    from ..sources import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id")


@register("label_subgroup_rates")
def label_subgroup_rates(spark, sf_dir):
    """Quality rate with Wilson CI per language and per source (one GROUPING SETS pass)."""
    return A.subgroup_rates(labelled_documents(spark, sf_dir), ["lang", "source"], y="quality")


@register("label_association")
def label_association(spark, sf_dir):
    """Bias-corrected Cramér's V of language and source against toxicity."""
    cells = A.categorical_cells(labelled_documents(spark, sf_dir), ["lang", "source"], y="toxic")
    v = A.cramers_v_table(cells)
    return v.select("column", round_half_up(F.col("cramers_v"), 6).alias("cramers_v"), "n", "n_levels")
