"""Cross-column statistics: correlation matrices, Cramér's V, feature/target
association, diagnosis and medication landscapes, subgroup rates with Wilson
intervals, encounter distribution, split leakage and prior-visit signal."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import (age_ordinal, col, pearson_pairs, round_half_up, safe_corr,
                                 wilson_ci)
from ..functions.icd9 import icd9_chapter
from ..sources import dimensions as D
from .common import attach_row, top_k_per_group
from .ordered import md5_key, positions, running_totals
from .profile import TARGET_BINARY

CORR_COLUMNS = C.UTILIZATION_NUMERIC_COLS + ["age_ordinal", TARGET_BINARY]


def _corr_frame(df: DataFrame, keep: tuple = ()) -> DataFrame:
    return df.select(*[col(k) for k in keep],
                     *[col(c).cast("double").alias(c) for c in C.UTILIZATION_NUMERIC_COLS],
                     age_ordinal(F.col("age")).cast("double").alias("age_ordinal"),
                     F.col(TARGET_BINARY).cast("double").alias(TARGET_BINARY))


def _pairwise_corr(frame: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr) for all i<j in ONE aggregation; Spark's ``corr`` skips rows
    where either side is null (pairwise complete)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    return pearson_pairs(frame, pairs, 3)


def corr_pearson(df: DataFrame) -> DataFrame:
    return _pairwise_corr(_corr_frame(df), CORR_COLUMNS)


def _average_ranks(cells: DataFrame, value: str) -> DataFrame:
    """(a, b, ``value``, its average rank) within each pair of columns."""
    freq = cells.groupBy("a", "b", value).agg(F.sum("n").alias("cnt"))
    cum = running_totals(freq, F.col(value), [F.col(value)], {"upto": F.col("cnt")}, ["a", "b"])
    return cum.select("a", "b", value, (F.col("upto") - (F.col("cnt") - 1) / F.lit(2.0)).alias(f"rank_{value}"))


def corr_spearman(df: DataFrame) -> DataFrame:
    """Spearman = Pearson of average ranks, pairwise complete: each pair is ranked over the
    rows where both columns are present.

    One table of cells (a, b, x, y, n) for all pairs; ranks come from its marginals and are
    joined back to the cells, so a value that most rows share is one row per partner value.
    The mean rank of N rows is (N + 1) / 2 whatever the ties, so one centred aggregation ends it."""
    frame = _corr_frame(df)
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), col(a).alias("x"), col(b).alias("y"))
             for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]]
    cells = (frame.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
             .where(F.col("x").isNotNull() & F.col("y").isNotNull())
             .groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("n")))
    middle = cells.groupBy("a", "b").agg(((F.sum("n") + 1) / F.lit(2.0)).alias("middle"))
    ranked = (cells.join(_average_ranks(cells, "x"), ["a", "b", "x"]).join(_average_ranks(cells, "y"), ["a", "b", "y"])
              .join(F.broadcast(middle), ["a", "b"]))   # one row per pair of columns
    dx, dy = F.col("rank_x") - F.col("middle"), F.col("rank_y") - F.col("middle")
    sums = ranked.groupBy("a", "b").agg(*[F.sum(F.col("n") * p).alias(k) for k, p in (("xy", dx * dy), ("xx", dx * dx), ("yy", dy * dy))])
    return sums.select("a", "b", round_half_up(F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))), 3).alias("corr"))


def corr_top_pairs(corr: DataFrame, k: int = 8) -> DataFrame:
    """Strongest |corr| pairs (rounded values, ties by pair name)."""
    return (corr.orderBy(F.desc(F.abs("corr")), "a", "b").limit(k)
            .withColumn("rank", F.row_number().over(
                Window.orderBy(F.desc(F.abs("corr")), "a", "b"))))  # k rows only


def corr_neighbors(corr: DataFrame, column: str, k: int = 6) -> DataFrame:
    """The k strongest partners of one column."""
    name = "age_ordinal" if column == "age" else column
    both = corr.select(F.col("a").alias("column"), F.col("b").alias("partner"), "corr").unionByName(
        corr.select(F.col("b").alias("column"), F.col("a").alias("partner"), "corr"))
    return (both.where(F.col("column") == name).orderBy(F.desc(F.abs("corr")), "partner").limit(k)
            .select("partner", "corr"))


def cramers_v_table(cells: DataFrame) -> DataFrame:
    """Bias-corrected Cramér's V per ``column`` from (column, x, y, count) cells.

    chi² = n·(Σ o²/(r_x·c_y) − 1) needs only the non-zero cells and the two
    marginals, so no cross product of levels is formed.
    """
    rows = cells.groupBy("column", "x").agg(F.sum("count").alias("rx"))
    cols = cells.groupBy("column", "y").agg(F.sum("count").alias("cy"))
    j = cells.join(rows, ["column", "x"]).join(cols, ["column", "y"])
    s = j.groupBy("column").agg(
        F.sum(F.col("count").cast("double") * F.col("count") / (F.col("rx") * F.col("cy"))).alias("s"),
        F.sum("count").cast("double").alias("n"),
        F.countDistinct("x").alias("r"), F.countDistinct("y").alias("k"))
    n, r, k = F.col("n"), F.col("r").cast("double"), F.col("k").cast("double")
    chi2 = n * (F.col("s") - 1)
    phi2c = F.greatest(F.lit(0.0), chi2 / n - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) * (r - 1) / (n - 1)
    kc = k - (k - 1) * (k - 1) / (n - 1)
    denom = F.least(kc - 1, rc - 1)
    v = (F.when((r < 2) | (k < 2) | (n <= 1), F.lit(0.0))
         .when(denom <= 0, F.lit(0.0)).otherwise(F.sqrt(phi2c / denom)))
    return s.select("column", v.alias("cramers_v"), F.col("n").cast("long").alias("n"),
                    F.col("r").alias("n_levels"))


def categorical_cells(df: DataFrame, columns: list[str], y: str = TARGET_BINARY,
                      max_levels: int = C.TOP_LEVELS) -> DataFrame:
    """(column, x, y, count): null -> «missing»; beyond the top ``max_levels``
    levels -> «other» (only for columns with more levels than that)."""
    long = (df.select(F.col(y).alias("y"), *[col(c).cast("string").alias(c) for c in columns])
            .unpivot(["y"], columns, "column", "x")
            .withColumn("x", F.coalesce("x", F.lit(C.MISSING_LEVEL))))
    cells = long.groupBy("column", "x", "y").agg(F.count(F.lit(1)).alias("count"))
    lv = cells.groupBy("column", "x").agg(F.sum("count").alias("lc"))
    top = (top_k_per_group(lv, ["column"], [F.desc("lc"), F.asc("x")], max_levels, rank_col="_rk")
           .select("column", "x", F.lit(True).alias("_keep")))
    # levels outside the top ``max_levels`` of their column become «other»
    mapped = (cells.join(top, ["column", "x"], "left")
              .withColumn("x", F.when(F.col("_keep"), F.col("x")).otherwise(F.lit(C.OTHER_LEVEL))))
    return mapped.groupBy("column", "x", "y").agg(F.sum("count").alias("count"))


def feature_association(df: DataFrame, y: str = TARGET_BINARY) -> DataFrame:
    """Rank features by association with the label: |point-biserial r| for
    numeric columns, bias-corrected Cramér's V for categorical and coded-id
    columns (top-30 levels + «other»).  Constant columns are skipped."""
    from .profile import infer_roles
    roles = infer_roles(df).collect()          # one row per column
    skip = {C.TARGET_RAW, y, *C.KEY_COLS}
    numeric, categorical = [], []
    types = dict(df.dtypes)
    for r in roles:
        if r.column in skip or r.n_unique <= 1:
            continue
        is_num = types[r.column] not in ("string",) and r.column not in C.ADMINISTRATIVE_ID_COLS
        (numeric if is_num else categorical).append(r.column)
    parts = []
    if numeric:
        one = df.agg(*[safe_corr(col(c).cast("double"), F.col(y).cast("double")).alias(f"r{i}")
                       for i, c in enumerate(numeric)])
        parts.append(one.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"r{i}")).alias("assoc"),
                     F.lit("|point-biserial r|").alias("metric"), F.lit("numeric").alias("kind"))
            for i, c in enumerate(numeric)])).alias("s")).select("s.*"))
    if categorical:
        v = cramers_v_table(categorical_cells(df, categorical, y))
        parts.append(v.select(F.col("column").alias("feature"), F.col("cramers_v").alias("assoc"),
                              F.lit("Cramér's V").alias("metric"), F.lit("categorical").alias("kind")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("assoc", round_half_up(F.col("assoc"), 6))


# ------------------------------------------------------------------ diagnoses / meds
def _rate(y: str = TARGET_BINARY):
    return F.avg(F.col(y).cast("double"))


def chapter_rates(df: DataFrame, which: str = "diag_1", y: str = TARGET_BINARY) -> DataFrame:
    spark = df.sparkSession
    base = df.agg(_rate(y).alias("_base"), F.count(F.lit(1)).alias("_n"))
    g = (df.groupBy(icd9_chapter(col(which)).alias("chapter"))
         .agg(F.count(F.lit(1)).alias("count"), _rate(y).alias("_r")))
    g = attach_row(g, base).join(F.broadcast(D.chapter_order_table(spark)), "chapter")
    return g.select("chapter", "chapter_order", "count",
                    round_half_up(F.lit(100.0) * F.col("count") / F.col("_n"), 2).alias("pct"),
                    round_half_up(F.col("_r"), 5).alias("positive_rate"),
                    round_half_up(F.when(F.col("_base") > 0, F.col("_r") / F.col("_base")), 3)
                    .alias("lift"),
                    (F.col("_r") >= F.col("_base")).alias("above_base"))


def diabetes_anywhere(df: DataFrame, y: str = TARGET_BINARY) -> DataFrame:
    has = None
    for c in C.DIAG_COLS:
        d = icd9_chapter(col(c)) == "Diabetes"
        has = d if has is None else (has | d)
    base = df.agg(round_half_up(_rate(y), 5).alias("base"))
    g = df.groupBy(F.when(has, "with").otherwise("without").alias("group")).agg(
        F.count(F.lit(1)).alias("count"), round_half_up(_rate(y), 5).alias("rate"))
    return attach_row(g, base)


def comorbidity_rates(df: DataFrame, y: str = TARGET_BINARY, min_count: int = 30) -> DataFrame:
    return (df.groupBy(F.col("number_diagnoses").alias("n_diagnoses"))
            .agg(F.count(F.lit(1)).alias("count"), round_half_up(_rate(y), 5).alias("positive_rate"))
            .where(F.col("count") >= min_count))


def medication_landscape(df: DataFrame, y: str = TARGET_BINARY,
                         drugs: list[str] = C.ALL_DRUGS) -> DataFrame:
    """Per drug: level counts, % active (n − No; a null counts as active),
    distinct levels, near-constant flag and the rate among active rows."""
    long = (df.select(F.col(y).alias("_y"), *[col(d).alias(d) for d in drugs])
            .unpivot(["_y"], drugs, "drug", "v"))
    active = F.coalesce(F.col("v") != "No", F.lit(True))
    g = long.groupBy("drug").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("v") == lv).alias(lv) for lv in C.DRUG_VALUES],
        F.countDistinct("v").alias("n_levels"),
        F.avg(F.when(active, F.col("_y").cast("double"))).alias("_ra"))
    base = df.agg(round_half_up(_rate(y), 5).alias("base"))
    g = attach_row(g, base)
    act = F.col("_n") - F.col("No")
    return g.select("drug", round_half_up(F.lit(100.0) * act / F.col("_n"), 3).alias("pct_active"),
                    *C.DRUG_VALUES, "n_levels", (act / F.col("_n") < 0.001).alias("near_constant"),
                    F.when(act > 0, round_half_up(F.col("_ra"), 5)).alias("rate_active"), "base")


def medication_signal(df: DataFrame, y: str = TARGET_BINARY, cap: int = 6,
                      min_count: int = 30) -> DataFrame:
    """Rate per level of change / diabetesMed / insulin, and per active-drug
    count (capped at ``cap``, groups >= ``min_count``)."""
    sig = ["change", "diabetesMed", "insulin"]
    long = (df.select(F.col(y).alias("_y"), *[col(c) for c in sig])
            .unpivot(["_y"], sig, "signal", "level").where(F.col("level").isNotNull())
            .groupBy("signal", "level")
            .agg(F.count(F.lit(1)).alias("count"), round_half_up(F.avg(F.col("_y").cast("double")), 5)
                 .alias("positive_rate")))
    n_active = None
    for d in C.ALL_DRUGS:
        a = F.coalesce(col(d) != "No", F.lit(True)).cast("int")
        n_active = a if n_active is None else n_active + a
    act = (df.groupBy(F.least(n_active, F.lit(cap)).cast("string").alias("level"))
           .agg(F.count(F.lit(1)).alias("count"),
                round_half_up(F.avg(F.col(y).cast("double")), 5).alias("positive_rate"))
           .where(F.col("count") >= min_count).withColumn("signal", F.lit("n_active_meds")))
    return long.unionByName(act)


# ------------------------------------------------------------------ subgroups
def subgroup_rates(df: DataFrame, attributes: list[str], y: str = TARGET_BINARY) -> DataFrame:
    """Rate and Wilson 95 % CI per level of several attributes in ONE pass
    (``GROUPING SETS``); null levels become «missing»."""
    sel = df.select(F.col(y).cast("long").alias("_y"),
                    *[F.coalesce(col(a).cast("string"), F.lit(C.MISSING_LEVEL)).alias(a)
                      for a in attributes])
    g = (sel.groupingSets([[col(a)] for a in attributes], *[col(a) for a in attributes])
         .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"),
              F.sum("_y").alias("k")))
    full = (1 << len(attributes)) - 1
    attr, level = None, None
    for i, a in enumerate(attributes):
        hit = F.col("gid") == (full ^ (1 << (len(attributes) - 1 - i)))
        attr = F.when(hit, F.lit(a)) if attr is None else attr.when(hit, F.lit(a))
        level = F.when(hit, col(a)) if level is None else level.when(hit, col(a))
    lo, hi = wilson_ci(F.col("k"), F.col("n"))
    base = df.agg(round_half_up(_rate(y), 5).alias("base"))
    out = g.select(attr.alias("attribute"), level.alias("level"), F.col("n").alias("count"),
                   round_half_up(F.col("k") / F.col("n"), 5).alias("positive_rate"),
                   round_half_up(lo, 5).alias("ci_low"), round_half_up(hi, 5).alias("ci_high"))
    return attach_row(out, base)


def wilson_table(df: DataFrame, by: str, y: str = TARGET_BINARY) -> DataFrame:
    g = (df.groupBy(F.coalesce(col(by).cast("string"), F.lit(C.MISSING_LEVEL)).alias("level"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("k")))
    lo, hi = wilson_ci(F.col("k"), F.col("n"))
    return g.select("level", "k", "n", round_half_up(lo, 6).alias("ci_low"),
                    round_half_up(hi, 6).alias("ci_high"))


# ------------------------------------------------------------------ grouping / leakage
def encounter_distribution(df: DataFrame, key: str = "patient_nbr", cap: int = 5) -> DataFrame:
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("k"))
    capped = F.least(F.col("k"), F.lit(cap))
    g = per.groupBy(capped.alias("_c")).agg(F.count(F.lit(1)).alias("n_patients"))
    tot = per.agg(F.count(F.lit(1)).alias("n_patients_total"))
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    out = attach_row(attach_row(g, tot), rows)
    return out.select(F.when(F.col("_c") == cap, F.lit(f"{cap}+"))
                      .otherwise(F.col("_c").cast("string")).alias("encounters"),
                      "n_patients", "n_patients_total", "n_rows")


def _leak_metrics(test: DataFrame, train_keys: DataFrame, key: str) -> DataFrame:
    """Share of test rows / test entities whose entity also appears in train."""
    tk = train_keys.select(F.col(key).alias("_k")).distinct().withColumn("_in", F.lit(True))
    t = test.join(tk, test[key] == tk["_k"], "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
    rows = t.agg(F.count(F.lit(1)).alias("n_test_rows"), F.avg(F.col("_in").cast("double")).alias("_lr"))
    pats = (t.groupBy(key).agg(F.max(F.col("_in").cast("int")).alias("_l"))
            .agg(F.count(F.lit(1)).alias("n_test_patients"), F.sum("_l").alias("n_leaked_patients")))
    out = attach_row(rows, pats)
    return out.select(
        "n_test_rows", "n_test_patients", F.col("n_leaked_patients").cast("long").alias("n_leaked_patients"),
        round_half_up(F.lit(100.0) * F.col("_lr"), 2).alias("pct_test_rows_leaked"),
        round_half_up(F.lit(100.0) * F.col("n_leaked_patients")
                      / F.greatest(F.col("n_test_patients"), F.lit(1)), 2).alias("pct_test_patients_leaked"))


def hash_row_split(df: DataFrame, row_key: str, seed: int = C.SPLIT_SEED,
                   test_frac: float = C.TEST_FRACTION) -> DataFrame:
    """Exact-size random-order split: rows ordered by md5('<seed>:<key>'); the
    first int(n·(1−f)) are train.  Positions come from the scalable running
    count, not a global window."""
    h, pre = md5_key(seed, F.col(row_key))
    d = df.withColumns({"_h": h, "_hp": pre})
    d = positions(d, F.col("_hp"), [F.col("_h")], out="_pos")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    d = attach_row(d, n)
    cut = F.floor(F.col("_n") * F.lit(1.0 - test_frac))
    return d.withColumn("is_test", F.col("_pos") > cut).drop("_h", "_hp", "_pos", "_n")


def leakage_overlap(df: DataFrame, key: str = "patient_nbr", row_key: str = "encounter_id",
                    test_frac: float = C.TEST_FRACTION, seed: int = C.SPLIT_SEED) -> DataFrame:
    s = hash_row_split(df.select(row_key, key), row_key, seed, test_frac)
    return _leak_metrics(s.where("is_test"), s.where("NOT is_test"), key).withColumn(
        "test_frac", F.lit(test_frac))


def group_split_overlap(df: DataFrame, key: str = "patient_nbr",
                        test_frac: float = C.TEST_FRACTION, seed: int = C.SPLIT_SEED) -> DataFrame:
    """Split on entities (hash order of the key): no entity can land on both sides."""
    ents = df.where(F.col(key).isNotNull()).select(key).distinct()
    s = hash_row_split(ents, key, seed, test_frac)
    rows = df.join(s, key)
    return _leak_metrics(rows.where("is_test"), rows.where("NOT is_test"), key).withColumn(
        "test_frac", F.lit(test_frac))


def prior_visit_signal(df: DataFrame, y: str = TARGET_BINARY) -> DataFrame:
    cols = ["number_inpatient", "number_emergency", "number_outpatient"]
    long = (df.select(F.col(y).alias("_y"), *[col(c).cast("long").alias(c) for c in cols])
            .unpivot(["_y"], cols, "signal", "v").where(F.col("v").isNotNull()))
    capped = F.least(F.col("v"), F.lit(3))
    g = long.groupBy("signal", capped.alias("_c")).agg(
        F.count(F.lit(1)).alias("count"),
        round_half_up(F.avg(F.col("_y").cast("double")), 5).alias("positive_rate"))
    return g.select("signal", F.when(F.col("_c") == 3, "3+").otherwise(F.col("_c").cast("string"))
                    .alias("bucket"), "count", "positive_rate")
