"""Column profiling: roles, missingness, level statistics, numeric summaries,
decile rates, target lift and dataset facts.

Per-column loops are replaced by ``unpivot`` + one ``groupBy(column, value)``:
49 columns cost one shuffle (map-side combined), not 49 jobs.  Row-scale
statistics (min/max/percentiles/moments) are single aggregations whose
partial buffers are combined map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.columns import col, pearson_pairs, round_half_up
from ..sources import dimensions as D
from .common import attach_row, top_k_per_group
from .ordered import frequency_quantiles, quantiles

TARGET_BINARY = "readmitted_30d"
QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def add_binary_target(df: DataFrame) -> DataFrame:
    return df.withColumn(TARGET_BINARY, F.coalesce(F.col(C.TARGET_RAW) == C.POSITIVE_LABEL,
                                                   F.lit(False)).cast("int"))


def _is_numeric(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def profiled_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in (C.TARGET_RAW, TARGET_BINARY)]


def level_table(df: DataFrame, columns: list[str], target: str = TARGET_BINARY) -> DataFrame:
    """(column, value, count, positives) for every non-null level of ``columns``.

    One unpivot + one hash aggregate; its size is the number of distinct levels.
    """
    long = df.select(F.col(target).alias("_y"),
                     *[col(c).cast("string").alias(c) for c in columns])
    long = long.unpivot(["_y"], columns, "column", "value")
    return (long.where(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("_y").cast("long").alias("positives")))


def profile_levels(df: DataFrame) -> DataFrame:
    """Level table of every non-identifier profiled column, checkpointed once
    per input plan and shared by roles, profiles, level stats, lift and
    association (its size is the number of distinct levels, not of rows)."""
    from ..session import cut_lineage
    kept = getattr(df, "_profile_levels", None)  # as long as the frame itself
    if kept is not None:
        return kept
    src = add_binary_target(df) if TARGET_BINARY not in df.columns else df
    names = [f.name for f in profiled_columns(df) if f.name not in C.KEY_COLS]
    df._profile_levels = cut_lineage(level_table(src, names))
    return df._profile_levels


def column_basics(df: DataFrame) -> DataFrame:
    """(column, n, n_missing, n_unique) for every profiled column.

    Missing counts come from one aggregation, the cardinality of each identifier from one over
    it alone (distinct counts beside others would expand every row), other distinct counts
    from the shared level table.  Checkpointed once per input
    plan, as roles, profiles, level stats and lift all ask for it (one row a column).
    """
    from ..session import cut_lineage
    kept = getattr(df, "_column_basics", None)  # as long as the frame itself
    if kept is not None:
        return kept
    fields = profiled_columns(df)
    names = [f.name for f in fields]
    ids = [c for c in names if c in C.KEY_COLS]
    miss = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)])
    for i, c in enumerate(ids):
        miss = attach_row(miss, df.select(col(c).alias("_u")).where("_u is not null").distinct().agg(F.count(F.lit(1)).alias(f"u{i}")))
    miss_long = miss.select("n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"),
                 (F.col(f"u{ids.index(c)}") if c in ids else F.lit(None)).cast("long").alias("id_unique"))
        for i, c in enumerate(names)])).alias("r")).select("r.column", "n", "r.n_missing", "r.id_unique")
    uniq = profile_levels(df).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    df._column_basics = cut_lineage(miss_long.join(uniq, "column", "left")
                                    .withColumn("n_unique", F.coalesce("id_unique", "n_unique", F.lit(0)).cast("long"))
                                    .drop("id_unique"))
    return df._column_basics


def approx_basics(df: DataFrame) -> DataFrame:
    """(column, n, n_missing, n_unique) with ``approx_count_distinct`` (HLL,
    relative error ~2 %): one aggregation, no level table (A36)."""
    names = [f.name for f in profiled_columns(df)]
    one = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)],
                 *[F.approx_count_distinct(col(c)).alias(f"u{i}") for i, c in enumerate(names)])
    return one.select("n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"),
                 F.col(f"u{i}").cast("long").alias("n_unique")) for i, c in enumerate(names)])).alias("r")
    ).select("r.column", "n", "r.n_missing", "r.n_unique")


def infer_roles(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, role, n_unique): identifier, coded_id, constant, numeric,
    binary_flag, high_card_cat, categorical -- checked in that order.
    ``approx`` uses HyperLogLog distinct counts (one pass, no level table)."""
    basics = approx_basics(df) if approx else column_basics(df)
    numeric = [f.name for f in profiled_columns(df) if _is_numeric(f)]
    u = F.col("n_unique")
    role = (F.when(F.col("column").isin(*C.KEY_COLS), "identifier")
            .when(F.col("column").isin(*C.ADMINISTRATIVE_ID_COLS), "coded_id")
            .when(u <= 1, "constant")
            .when(F.col("column").isin(*numeric) if numeric else F.lit(False), "numeric")
            .when(u == 2, "binary_flag")
            .when(u > C.HIGH_CARD_THRESHOLD, "high_card_cat")
            .otherwise("categorical"))
    return basics.select("column", role.alias("role"), "n_unique", "n", "n_missing")


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: family, role, n, missing count and % (3 dp), distinct, constant."""
    roles = infer_roles(df)
    fam = D.family_table(df.sparkSession)
    pct = round_half_up(F.lit(100.0) * F.col("n_missing") / F.col("n"), 3)
    return (roles.join(F.broadcast(fam), "column", "left")
            .select("column", F.coalesce("family", F.lit("Other")).alias("family"), "role",
                    "n", "n_missing", pct.alias("pct_missing"), "n_unique",
                    (F.col("n_unique") <= 1).alias("is_constant")))


def level_stats(df: DataFrame, top_k: int = C.TOP_LEVELS) -> DataFrame:
    """Top-k levels per categorical-like column with count, pct of ALL rows,
    positives and positive rate; coded ids are decoded to labels."""
    roles = infer_roles(df).where(F.col("role").isin("coded_id", "binary_flag", "high_card_cat", "categorical"))
    levels = profile_levels(df).join(F.broadcast(roles.select("column")), "column", "left_semi")  # one row per column
    n_all = df.agg(F.count(F.lit(1)).alias("_n"))
    totals = levels.groupBy("column").agg(F.count(F.lit(1)).alias("n_levels_total"))
    top = top_k_per_group(levels, ["column"], [F.desc("count"), F.asc("value")], top_k)
    top = top.join(F.broadcast(totals), "column")          # one row per column
    dec = D.decoder_table(df.sparkSession).select(
        F.col("column").alias("_dc"), F.col("code").cast("string").alias("_code"), "label")
    top = top.join(F.broadcast(dec), (top.column == dec._dc) & (top.value == dec._code), "left")
    top = attach_row(top, n_all)
    return top.select(
        "column", "rank", F.coalesce("label", "value").alias("label"), "count",
        round_half_up(F.lit(100.0) * F.col("count") / F.col("_n"), 3).alias("pct"),
        "positives", round_half_up(F.col("positives") / F.col("count"), 5).alias("positive_rate"),
        "n_levels_total")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in profiled_columns(df) if _is_numeric(f)
            and f.name not in C.KEY_COLS + C.ADMINISTRATIVE_ID_COLS]


def numeric_summary(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """min, p01..p99, mean, max, std (ddof 1), bias-corrected skew, zeros % (2 dp).

    ``exact`` takes the quantiles (linear interpolation) from running counts
    over distinct values; ``exact=False`` uses ``percentile_approx``.
    """
    columns = columns or numeric_columns(df)
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                 F.avg(x).alias(f"av{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                 F.skewness(x).alias(f"sk{i}"), F.count(x).alias(f"n{i}"),
                 F.count_if(x == 0).alias(f"z{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, QUANTILES, 100000).alias(f"q{i}"))
    one = df.agg(*aggs)
    names = ["p01", "p05", "p25", "median", "p75", "p95", "p99"]
    rows = []
    for i, c in enumerate(columns):
        n = F.col(f"n{i}").cast("double")
        adj = F.when(n > 2, F.col(f"sk{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"mn{i}").alias("min"),
            *([] if exact else [F.col(f"q{i}").alias("q")]),
            F.col(f"av{i}").alias("mean"), F.col(f"mx{i}").alias("max"),
            F.col(f"sd{i}").alias("std"), adj.alias("skew"),
            round_half_up(F.lit(100.0) * F.col(f"z{i}") / n, 2).alias("zeros_pct")))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if exact:
        out = out.join(F.broadcast(quantiles(df, columns, QUANTILES)), "column", "left")
    return out.select("column", "min", *[F.col("q")[j].alias(name) for j, name in enumerate(names)],
                      "mean", "max", "std", "skew", "zeros_pct")


def decile_edges(values: DataFrame, n_bins: int = 10) -> DataFrame:
    """(column, edges) -- distinct quantile edges at 0, 1/n, ..., 1 (exact) of (column, x, n)."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    return frequency_quantiles(values, ["column"], "x", "n", probs).select("column", F.array_distinct("q").alias("edges"))


def decile_rates(df: DataFrame, columns: list[str] | None = None,
                 target: str = TARGET_BINARY) -> DataFrame:
    """Positive rate per quantile bin: right-closed bins, lowest value included.

    Rows are unpivoted and counted by distinct value once; edges (<= 11 per column, broadcast)
    and bins (an array lookup) come from those counts.
    """
    from ..session import cut_lineage
    columns = columns or numeric_columns(df)
    y = F.col("_y").cast("double")
    values = cut_lineage(df.select(F.col(target).alias("_y"), *[col(c).cast("double").alias(c) for c in columns])
                         .unpivot(["_y"], columns, "column", "x").where(F.col("x").isNotNull())
                         .groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("_s"), F.count(y).alias("_ny")))
    j = values.join(F.broadcast(decile_edges(values)), "column")
    n_below = F.size(F.filter("edges", lambda e: e < F.col("x")))
    binned = j.withColumn("bin", F.greatest(n_below, F.lit(1))).where(F.size("edges") >= 2)
    agg = binned.groupBy("column", "bin").agg(F.sum("n").alias("count"),
                                              F.try_divide(F.sum("_s"), F.sum("_ny")).alias("rate"),
                                              F.first("edges").alias("edges"))
    left = F.element_at("edges", F.col("bin"))
    left = F.when(F.col("bin") == 1, left - F.lit(0.001)).otherwise(left)
    return agg.select("column", "bin", left.alias("left"),
                      F.element_at("edges", F.col("bin") + 1).alias("right"), "count",
                      round_half_up(F.col("rate"), 5).alias("positive_rate"))


def target_lift(df: DataFrame, target: str = TARGET_BINARY) -> DataFrame:
    """Numeric: max decile rate / base; categorical: max rate among the top-30
    levels with count >= 30, / base (3 dp).  Identifiers and constants: none."""
    base = df.agg(F.avg(F.col(target).cast("double")).alias("_base"))
    num = (decile_rates(df).groupBy("column").agg(F.max("positive_rate").alias("_mx"))
           .withColumn("kind", F.lit("numeric")))
    cat = (level_stats(df).where(F.col("count") >= C.MIN_LEVEL_COUNT)
           .groupBy("column").agg(F.max("positive_rate").alias("_mx"))
           .withColumn("kind", F.lit("categorical")))
    both = attach_row(num.unionByName(cat), base)
    return both.select("column", "kind", round_half_up(
        F.when(F.col("_base") > 0, F.col("_mx") / F.col("_base")), 3).alias("target_lift"))


def fact_pack(df: DataFrame, top: int = 5) -> DataFrame:
    """One nested document per profiled column (A7): the column's profile, ``numeric`` (summary of
    numeric columns), ``levels`` (its top levels by rank), ``target_lift``, ``constant_value`` of a
    constant column, and whether an identifier is a key (``unique_key``).  Identifiers and
    constants have no levels, summary or lift."""
    numeric = numeric_summary(df)
    numeric = numeric.select("column", F.struct(*[c for c in numeric.columns if c != "column"]).alias("numeric"))
    levels = level_stats(df, top).groupBy("column").agg(F.sort_array(F.collect_list(F.struct(
        "rank", "label", "count", "pct", "positives", "positive_rate"))).alias("levels"))  # at most ``top``
    constants = profile_levels(df).groupBy("column").agg(F.min("value").alias("constant_value"))
    docs = column_profile(df).join(numeric, "column", "left").join(levels, "column", "left") \
        .join(target_lift(df).select("column", "target_lift"), "column", "left").join(constants, "column", "left")
    plain = ~F.col("role").isin("identifier", "constant")
    return docs.select("column", "family", "role", "n", "n_missing", "pct_missing", "n_unique", "is_constant",
                       F.when(plain, F.col("numeric")).alias("numeric"), F.when(plain, F.col("levels")).alias("levels"),
                       F.when(plain, F.col("target_lift")).alias("target_lift"),
                       F.when(F.col("role") == "constant", F.col("constant_value")).alias("constant_value"),
                       F.when(F.col("role") == "identifier", F.col("n_unique") == F.col("n")).alias("unique_key"))


# ------------------------------------------------------------------ dataset facts
def target_facts(df: DataFrame) -> DataFrame:
    """Raw label distribution (null included) with positives, base rate and
    majority-class accuracy repeated on each row."""
    pos = F.coalesce(F.col(C.TARGET_RAW) == C.POSITIVE_LABEL, F.lit(False)).cast("long")
    facts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(pos).alias("binary_positives"),
                   F.avg(pos.cast("double")).alias("_b"))
    dist = df.groupBy(F.col(C.TARGET_RAW).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    out = attach_row(dist, facts)
    return out.select("value", "count", "n_rows", "binary_positives",
                      round_half_up(F.col("_b"), 5).alias("base_rate"),
                      round_half_up(F.lit(1.0) - F.col("_b"), 5).alias("majority_baseline_accuracy"))


def encounters_per_entity(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("k"))


def grouping_facts(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    per = encounters_per_entity(df, key)
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    agg = per.agg(F.count(F.lit(1)).alias("n_unique_patients"),
                  F.count_if(F.col("k") > 1).alias("n_patients_multi_encounter"),
                  F.max("k").alias("max_encounters_per_patient"),
                  F.sum(F.when(F.col("k") > 1, F.col("k")).otherwise(0)).alias("_rep"))
    return attach_row(agg, n).select(
        "n_rows", "n_unique_patients", "n_patients_multi_encounter", "max_encounters_per_patient",
        round_half_up(F.lit(100.0) * F.col("_rep") / F.col("n_rows"), 2)
        .alias("pct_rows_from_repeat_patients"))


def discharge_facts(df: DataFrame, column: str = "discharge_disposition_id") -> DataFrame:
    """Per drop code (zero-row codes included): count and %; plus totals."""
    spark = df.sparkSession
    codes = D.drop_disposition_table(spark)
    counts = (df.where(col(column).isin(*C.EXPIRED_HOSPICE_IDS))
              .groupBy(col(column).alias("code")).agg(F.count(F.lit(1)).alias("count")))
    tot = df.agg(F.count(F.lit(1)).alias("_n"),
                 F.count_if(col(column).isin(*C.EXPIRED_IDS)).alias("n_expired_rows"),
                 F.count_if(col(column).isin(*C.HOSPICE_IDS)).alias("n_hospice_rows"),
                 F.count_if(col(column).isin(*C.EXPIRED_HOSPICE_IDS)).alias("n_drop_rows"))
    per = codes.join(counts, "code", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    out = attach_row(per, tot)
    return out.select(
        "code", "label", "kind", F.col("count").cast("long").alias("count"),
        round_half_up(F.lit(100.0) * F.col("count") / F.col("_n"), 3).alias("pct"),
        "n_expired_rows", "n_hospice_rows", "n_drop_rows",
        round_half_up(F.lit(100.0) * F.col("n_drop_rows") / F.col("_n"), 3).alias("pct_drop"),
        (F.col("_n") - F.col("n_drop_rows")).alias("rows_after_filter"))


def co_missing(df: DataFrame, min_pct: float = 1.0) -> DataFrame:
    """Pearson correlation of null indicators for columns >= min_pct missing.

    Column selection needs the per-column missing share (one small collect of
    one number per column); the pairwise correlations are one aggregation.
    A pair involving a column with no variance gives null.
    """
    fields = profiled_columns(df)
    names = [f.name for f in fields]
    shares = df.agg(*[F.avg(col(c).isNull().cast("double")).alias(f"s{i}")
                      for i, c in enumerate(names)]).first()
    keep = [c for i, c in enumerate(names) if 100 * shares[f"s{i}"] >= min_pct]
    pairs = [(a, b) for i, a in enumerate(keep) for b in keep[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    ind = df.select(*[col(c).isNull().cast("double").alias(c) for c in keep])
    return (pearson_pairs(ind, pairs, 3)
            .select(F.col("a").alias("column_a"), F.col("b").alias("column_b"), "corr"))


def histogram(df: DataFrame, column: str, n_bins: int = 40) -> DataFrame:
    """Equal-width histogram between min and max; the max falls in the last bin."""
    x = col(column).cast("double")
    mm = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    j = attach_row(df.select(x.alias("x")).where(F.col("x").isNotNull()), mm)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - F.col("_lo")) / width) + 1, F.lit(n_bins)))
    agg = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins))
    return agg.select(F.col("bin").cast("int").alias("bin"),
                      round_half_up(F.col("_lo") + (F.col("bin") - 1) * w, 6).alias("lo"),
                      round_half_up(F.col("_lo") + F.col("bin") * w, 6).alias("hi"), "count")


# Handling decided by the cleaning stage for each column that can be missing.
HANDLING = {
    "weight": "dropped in cleaning",
    "race": "null -> Unknown level",
    "payer_code": "null -> Unknown level",
    "medical_specialty": "null -> Unknown level",
    "diag_1": "null -> Missing bucket",
    "diag_2": "null -> Missing bucket",
    "diag_3": "null -> Missing bucket",
    "max_glu_serum": "None -> NotMeasured level",
    "A1Cresult": "None -> NotMeasured level",
}


def missingness_rank(df: DataFrame) -> DataFrame:
    """Columns with any missing, by % desc, tiered (>=40 high, >=5 medium, else
    low), joined to the cleaning decision for that column (default ``—``)."""
    prof = column_profile(df).where(F.col("pct_missing") > 0)
    dec = df.sparkSession.createDataFrame(list(HANDLING.items()), "column string, handling string")
    p = F.col("pct_missing")
    return (prof.join(F.broadcast(dec), "column", "left")
            .select("column", "pct_missing",
                    F.when(p >= 40, "high").when(p >= 5, "medium").otherwise("low").alias("tier"),
                    F.coalesce("handling", F.lit("—")).alias("handling")))
