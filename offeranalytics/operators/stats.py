"""Hypothesis tests, effect sizes and correlations from distributed sufficient statistics."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ordered, special
from ..functions.constants import COMPLETED
from ..functions.scalars import effect_label, is_completed, is_event, is_received, is_transaction
from ..functions.scale import durable, small_side
from .funnel import customer_transactions, per_offer_event, responders, with_offer


def moments(value, when: Column, name: str) -> list[Column]:
    """Count, mean and sample variance of the rows that satisfy ``when``."""
    v = F.when(when, F.col(value) if isinstance(value, str) else value)
    return [F.count(v).alias(f"n_{name}"), F.avg(v).alias(f"mean_{name}"), F.var_samp(v).alias(f"var_{name}")]


def cohens_d(n1="n_1", mean1="mean_1", var1="var_1", n2="n_2", mean2="mean_2", var2="var_2") -> Column:
    """Difference of means over the pooled deviation; 0 where it cannot be formed."""
    n1, mean1, var1, n2, mean2, var2 = map(F.col, (n1, mean1, var1, n2, mean2, var2))
    pooled = F.sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / F.when(n1 + n2 > 2, n1 + n2 - 2))
    return F.when((n1 > 1) & (n2 > 1) & (pooled > 0), (mean1 - mean2) / pooled).otherwise(0.0)


def effect_sizes(df: DataFrame, metrics: list[str], group: str) -> DataFrame:
    """Cohen's d of each metric between group = 1 and group = 0, all metrics in one pass."""
    long = ordered.unpivot(df, metrics, [group])
    stats = long.groupBy("metric").agg(*moments("value", F.col(group) == 1, "1"), *moments("value", F.col(group) == 0, "2"))
    return stats.withColumn("cohens_d", cohens_d()).select("metric", "cohens_d", effect_label("cohens_d").alias("magnitude"))


def responder_effect_sizes(profile: DataFrame, events: DataFrame) -> DataFrame:
    """Effect sizes of being a responder on spend, age and income."""
    people = profile.select("id", F.nullif("age", F.lit(118)).alias("age_clean"), "income")
    spend = customer_transactions(events).withColumnRenamed("customer_id", "id")
    return effect_sizes(spend.join(people, "id", "left"), ["trans_count", "trans_avg", "trans_total", "age_clean", "income"], "is_responder")


def two_proportion_z(s1, n1, s2, n2) -> Column:
    """Pooled two-proportion statistic; 0 where the standard error is 0."""
    s1, n1, s2, n2 = (F.col(c).cast("double") if isinstance(c, str) else c for c in (s1, n1, s2, n2))
    pooled = (s1 + s2) / (n1 + n2)
    variance = pooled * (1 - pooled) * (1 / n1 + 1 / n2)
    se = F.sqrt(F.when(variance > 0, variance))
    return F.when(se > 0, (s1 / n1 - s2 / n2) / se).otherwise(0.0)


def with_normal_p(df: DataFrame, z: str = "z_statistic") -> DataFrame:
    return df.withColumn("p_value", special.p_normal(F.col(z))).withColumn("significant", F.col("p_value") < 0.05)


def completion_rate_test(events: DataFrame, portfolio: DataFrame, first: str = "bogo", second: str = "discount") -> DataFrame:
    """Are completion rates (events over receipts) of two offer types equal?"""
    counted = with_offer(per_offer_event(events), portfolio, ["offer_type"])
    count = lambda t, test: F.sum(F.when((F.col("offer_type") == t) & test, F.col("n")).otherwise(0))
    counts = counted.agg(count(first, is_completed()).alias("s1"), count(first, is_received()).alias("n1"),
                         count(second, is_completed()).alias("s2"), count(second, is_received()).alias("n2"))
    tested = counts.select(
        (F.col("s1") / F.when(F.col("n1") > 0, F.col("n1"))).alias("rate_1"), (F.col("s2") / F.when(F.col("n2") > 0, F.col("n2"))).alias("rate_2"),
        two_proportion_z("s1", "n1", "s2", "n2").alias("z_statistic"))
    return with_normal_p(tested)


def _ties(n: str) -> Column:
    t = F.col(n).cast("double")
    return F.sum(t * t * t - t)


def _rank_sum(group_n: str) -> Column:
    """Sum of mid-ranks, exact: twice the rank is whole."""
    twice = (2 * F.col("before") + F.col("n") + 1).cast("decimal(19,0)")
    return F.sum(F.col(group_n).cast("decimal(19,0)") * twice).cast("double") / 2


def mann_whitney(df: DataFrame, value: str, group: Column, weight: str | None = None) -> DataFrame:
    """U of the rows in ``group`` against the rest, two-sided p with tie and continuity correction.

    ``weight`` names a count for rows that stand for several equal ones.
    """
    one = F.col(weight) if weight else F.lit(1)
    counted = ordered.value_counts(df, value, counts={"n": one, "n1": F.coalesce(group, F.lit(False)).cast("int") * one})
    ranked = ordered.prefix_sums(counted, value, {"before": "n"})
    sums = ranked.agg(_rank_sum("n1").alias("r1"), F.sum("n1").cast("double").alias("n1"), F.sum("n").cast("double").alias("n"), _ties("n").alias("ties"))
    n1, n2, n = F.col("n1"), F.col("n") - F.col("n1"), F.col("n")
    u = F.col("r1") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    z = (F.greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    tested = sums.select(n1.cast("long").alias("n_1"), n2.cast("long").alias("n_2"), u.alias("u_statistic"), z.alias("z_statistic"))
    return tested.withColumn("p_value", F.least(F.lit(1.0), 2 * special.normal_cdf(-F.col("z_statistic"))))


def responder_amount_test(events: DataFrame) -> DataFrame:
    """Do transaction amounts of responders and others differ?"""
    paid = events.filter(is_transaction() & F.col("amount").isNotNull()).groupBy("person", "amount").agg(F.count(F.lit(1)).alias("n_rows"))
    flagged = paid.join(responders(events).withColumn("responded", F.lit(True)), "person", "left")
    return mann_whitney(flagged, "amount", F.col("responded"), "n_rows")


def contingency(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Cross-tabulation of counts with one column per value."""
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).fillna(0)


def chi_squared(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence of two columns, with Cramer's V. A two-by-two table gets Yates' correction."""
    cells = durable(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("o")))
    r, c = cells.groupBy(a).agg(F.sum("o").alias("r")), cells.groupBy(b).agg(F.sum("o").alias("c"))
    sizes = cells.agg(F.struct(F.sum("o").alias("n"), F.count_distinct(a).alias("rows"), F.count_distinct(b).alias("columns")).alias("s")).scalar()
    joined = cells.join(r, a).join(c, b)
    o, n = F.col("o"), F.col("n")
    sums = joined.agg(F.sum(o * o / (F.col("r") * F.col("c"))).alias("share"),
                      F.max(F.abs(o * sizes["n"] - F.col("r") * F.col("c"))).alias("gap"))
    marginals = r.agg(F.product("r")).toDF("p").scalar() * c.agg(F.product("c")).toDF("p").scalar()
    plain = sums.select("share", "gap", sizes["n"].alias("n"), ((sizes["rows"] - 1) * (sizes["columns"] - 1)).alias("dof"),
                        F.least(sizes["rows"], sizes["columns"]).alias("k"), marginals.alias("m"))
    yates = n * F.pow(F.greatest(F.lit(0.0), F.col("gap") - n / 2), 2) / F.col("m")
    chi2 = F.when(F.col("dof") == 1, yates).otherwise(n * (F.col("share") - 1))
    tested = plain.select(chi2.alias("chi2_statistic"), F.col("dof").cast("int").alias("dof"),
                          F.when(F.col("k") > 1, F.sqrt(chi2 / (n * (F.col("k") - 1)))).otherwise(0.0).alias("cramers_v"))
    return tested.withColumn("p_value", special.p_chi_squared(F.col("chi2_statistic"), F.col("dof")))


def completion_by_gender(profile: DataFrame, events: DataFrame) -> DataFrame:
    done = responders(events).select(F.col("person").alias("id"), F.lit(1).alias("completed_offer"))
    people = profile.filter(F.col("gender").isNotNull()).select("id", "gender")
    return people.join(done, "id", "left").fillna(0, ["completed_offer"])


def kruskal_wallis(df: DataFrame, value: str, group: str, weight: str | None = None) -> DataFrame:
    """H over k groups with tie correction; ``weight`` as in ``mann_whitney``."""
    one = F.col(weight) if weight else F.lit(1)
    counted = ordered.value_counts(df.filter(F.col(group).isNotNull()), value, [group], {"n": one})
    totals = counted.groupBy(value).agg(F.sum("n").alias("n"))
    ranked = ordered.prefix_sums(durable(totals), value, {"before": "n"})
    per_group = counted.withColumnRenamed("n", "n_group").join(ranked, value).groupBy(group).agg(
        _rank_sum("n_group").alias("r"), F.sum("n_group").cast("double").alias("size"))
    ties = ranked.agg(_ties("n")).toDF("t").scalar()
    sums = per_group.agg(F.sum(F.col("r") * F.col("r") / F.col("size")).alias("s"), F.sum("size").alias("n"), F.count(F.lit(1)).alias("k"))
    n = F.col("n")
    h = (12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / (1 - ties / (n * n * n - n))
    tested = sums.select(h.alias("h_statistic"), (F.col("k") - 1).cast("int").alias("dof"))
    return tested.withColumn("p_value", special.p_chi_squared(F.col("h_statistic"), F.col("dof")))


def income_of_completers(profile: DataFrame, events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Income of the customer behind each completion, with the offer's type and the number of such completions."""
    done = with_offer(events.filter(is_event(COMPLETED)), portfolio, ["offer_type"]).groupBy("person", "offer_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return done.join(profile.select(F.col("id").alias("person"), "income"), "person").filter("income is not null").select("offer_type", "income", "n_rows")


def welch(stats: DataFrame, by=()) -> DataFrame:
    """Welch's t from count, mean and variance of two groups (``n_1, mean_1, var_1, n_2, ...``) per row.

    Reports the pooled degrees of freedom as published, and the Welch ones, which the p-value uses.
    """
    by = list(by)
    e1, e2 = F.col("var_1") / F.col("n_1"), F.col("var_2") / F.col("n_2")
    t = (F.col("mean_1") - F.col("mean_2")) / F.sqrt(e1 + e2)
    dof = F.pow(e1 + e2, 2) / (e1 * e1 / (F.col("n_1") - 1) + e2 * e2 / (F.col("n_2") - 1))
    enough = (F.col("n_1") > 1) & (F.col("n_2") > 1)
    tested = stats.withColumns({
        "t_statistic": F.when(enough, t), "welch_dof": F.when(enough, dof), "cohens_d": F.when(enough, cohens_d()),
        "degrees_freedom": F.when(enough, F.col("n_1") + F.col("n_2") - 2)})
    return tested.select(
        *by, F.col("n_1").alias("treatment_n"), F.col("n_2").alias("control_n"), F.col("mean_1").alias("treatment_mean"),
        F.col("mean_2").alias("control_mean"), "t_statistic", "degrees_freedom", "welch_dof", "cohens_d",
        F.when(enough, effect_label("cohens_d")).alias("effect_size_label"),
        special.p_student(F.col("t_statistic"), F.col("welch_dof")).alias("p_value"))


def two_groups(df: DataFrame, value: str, treated: str, by=()) -> DataFrame:
    """Input of ``welch`` from rows: group 1 where ``treated`` is 1, group 2 where it is 0."""
    return df.groupBy(*by).agg(*moments(value, F.col(treated) == 1, "1"), *moments(value, F.col(treated) == 0, "2"))


def _pairs_of(stats: DataFrame, columns: list[str]) -> DataFrame:
    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"{a}:{b}").alias("r")) for a in columns for b in columns]
    long = stats.select("n", F.explode(F.array(*cells)).alias("c")).select("c.*", "n")
    dof = F.col("n") - 2
    # A correlation within rounding of one is exact: every column with itself, and p is 0.
    t = F.col("r") * F.sqrt(dof / (1 - F.col("r") * F.col("r")))
    p = F.when(F.abs(F.col("r")) > 1 - 1e-12, 0.0).otherwise(special.p_student(F.col("t"), dof.cast("double")))
    exact = F.abs(F.col("r")) > 1 - 1e-12
    return long.withColumn("t", F.when(exact, 0.0).otherwise(t)).withColumn("p_value", p).drop("t")


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairwise correlations with p-values from one aggregation over rows complete in every column."""
    complete = df.dropna(subset=columns)
    stats = complete.agg(F.count(F.lit(1)).alias("n"), *[F.corr(a, b).alias(f"{a}:{b}") for a in columns for b in columns])
    return _pairs_of(stats, columns)


def column_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column replaced by its mid-ranks among rows complete in every column."""
    complete = df.dropna(subset=columns).select(*[F.col(c).cast("double").alias(c) for c in columns])
    counted = ordered.value_counts(ordered.unpivot(complete, columns), "value", ["metric"])
    ranks = durable(ordered.average_ranks(counted, "value", by=["metric"]))
    for c in columns:
        own = ranks.filter(F.col("metric") == c).select(F.col("value").alias(c), F.col("rank").alias(f"_rank_{c}"))
        complete = complete.join(small_side(own), c)
    return complete.select(*[F.col(f"_rank_{c}").alias(c) for c in columns])


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    return pearson(column_ranks(df, columns), columns)
