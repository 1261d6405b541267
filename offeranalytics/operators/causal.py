"""Treatment effects: naive, per segment and matched on a propensity score; experiment planning and readout."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ordered, special
from ..functions.constants import AS_OF, OFFER_TYPES
from ..functions.scalars import is_completed, is_received, is_transaction, money_mean, one_hot, safe_ratio, standardise, tenure_months
from ..functions.scale import durable, small_side
from .bootstrap import difference_interval, slice_sums
from .funnel import attach_offer, with_offer
from .stats import two_proportion_z, with_normal_p

TREATMENTS = ["any_offer", *OFFER_TYPES]


def _cells(columns: dict[str, Column], name: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(k).alias("treatment"), v.cast("int").alias(name)) for k, v in columns.items()]))


def person_exposure(events: DataFrame, portfolio: DataFrame) -> DataFrame:
    """One row per person in the transcript: exposure to any offer and to each type, and spend sums."""
    typed = attach_offer(events, portfolio, ["offer_type"])
    paid = F.when(is_transaction(), F.col("amount").cast("decimal(18,2)"))
    return typed.groupBy("person").agg(
        F.max(F.col("offer_id").isNotNull().cast("int")).alias("any_offer"),
        *[F.max(F.coalesce(F.col("offer_type") == t, F.lit(False)).cast("int")).alias(t) for t in OFFER_TYPES],
        F.count(paid).alias("n"), F.sum(paid).alias("s"), F.sum(paid * paid).alias("q"))


def exposure_arms(exposure: DataFrame, keep=()) -> DataFrame:
    """One row per person and treatment with ``treated`` 0 or 1."""
    cells = _cells({t: F.col(t) for t in TREATMENTS}, "treated")
    return exposure.select("person", *keep, cells.alias("c")).select("person", *keep, "c.*")


def population_sizes(exposure: DataFrame) -> DataFrame:
    arms = exposure_arms(exposure)
    return arms.groupBy("treatment").agg(F.sum("treated").alias("n_treated"), F.sum(1 - F.col("treated")).alias("n_control"))


def arm_moments(exposure: DataFrame) -> DataFrame:
    """Count, mean and variance of transaction amounts in both arms of each treatment, from exact sums per person."""
    arms = exposure_arms(exposure, ["n", "s", "q"])
    sums = arms.groupBy("treatment").agg(*[
        F.sum(F.when(F.col("treated") == flag, F.col(c))).alias(f"{c}_{i}") for i, flag in ((1, 1), (2, 0)) for c in ("n", "s", "q")])
    out = ["treatment"]
    for i in (1, 2):
        n, s, q = F.coalesce(F.col(f"n_{i}"), F.lit(0)), F.col(f"s_{i}").cast("double"), F.col(f"q_{i}").cast("double")
        out += [n.alias(f"n_{i}"), (s / F.when(n > 0, n)).alias(f"mean_{i}"),
                ((q - s * s / F.when(n > 0, n)) / F.when(n > 1, n - 1)).alias(f"var_{i}")]
    return sums.select(*out)


def naive_effects(exposure: DataFrame) -> DataFrame:
    """Difference of mean transaction between exposed and unexposed persons, and in percent of the control."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    stats = arm_moments(exposure).select(
        "treatment", zero("mean_2").alias("control_mean"), zero("mean_1").alias("treatment_mean"),
        F.col("n_2").alias("control_count"), F.col("n_1").alias("treatment_count"))
    ate = F.col("treatment_mean") - F.col("control_mean")
    return stats.withColumn("ate", ate).withColumn("ate_percent", F.when(F.col("control_mean") > 0, F.col("ate") / F.col("control_mean") * 100).otherwise(0.0))


def effect_intervals(events: DataFrame, exposure: DataFrame, replicates: int = 1_000, level: float = 0.95) -> DataFrame:
    """Bootstrap interval of each naive effect. Transactions are summed per person and slice before they meet the arms."""
    paid = events.filter(is_transaction() & F.col("amount").isNotNull())
    per_person = slice_sums(paid, "amount", F.concat_ws(":", "person", "time"), ["person"])
    arms = exposure_arms(per_person.join(exposure.select("person", *TREATMENTS), "person"), ["slice", "cents", "n"])
    sums = arms.groupBy("treatment", "treated", "slice").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    return difference_interval(sums, "treated", ["treatment"], replicates, level)


def segment_effects(exposure: DataFrame, clusters: DataFrame, min_customers: int = 5, min_arm: int = 3) -> DataFrame:
    """Effects inside each segment on customers' mean transaction; null where an arm is too small."""
    people = exposure.join(clusters.select(F.col("id").alias("person"), "cluster"), "person").withColumn(
        "avg_amount", F.col("s").cast("double") / F.when(F.col("n") > 0, F.col("n")))
    arms = exposure_arms(people, ["cluster", "avg_amount"]).filter(F.col("treatment") != "any_offer")
    in_arm = lambda flag: F.col("treated") == flag
    mean = lambda flag: F.coalesce(F.avg(F.when(in_arm(flag), F.col("avg_amount"))), F.lit(0.0))
    stats = arms.groupBy("cluster", F.col("treatment").alias("offer_type")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.count_if(in_arm(1)).alias("treatment_n"), F.count_if(in_arm(0)).alias("control_n"),
        mean(1).alias("t"), mean(0).alias("c")).filter(F.col("n_customers") >= min_customers)
    enough = (F.col("treatment_n") >= min_arm) & (F.col("control_n") >= min_arm)
    ate = F.col("t") - F.col("c")
    return stats.select(
        "cluster", "offer_type", "n_customers", "treatment_n", "control_n", F.when(enough, F.col("t")).alias("treatment_mean"),
        F.when(enough, F.col("c")).alias("control_mean"), F.when(enough, ate).alias("ate"),
        F.when(enough, F.when(F.col("c") > 0, ate / F.col("c") * 100).otherwise(0.0)).alias("ate_percent"))


def best_offers(effects: DataFrame) -> DataFrame:
    """Offer type with the largest effect per segment, ties by name; null where no effect could be formed."""
    order = F.struct(F.round("ate", 6), F.concat(F.lit("-"), F.translate("offer_type", "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba")))
    return effects.groupBy("cluster").agg(
        F.max_by("offer_type", F.when(F.col("ate").isNotNull(), order)).alias("best_offer"), F.max("ate").alias("best_ate"))


def effect_matrix(effects: DataFrame, types=OFFER_TYPES) -> DataFrame:
    return effects.groupBy("cluster").pivot("offer_type", types).agg(F.first("ate"))


COVARIATES = ["age", "income", "tenure_months", "gender_F", "gender_M", "gender_O", "gender_Unknown"]


def propensity_covariates(profile: DataFrame, as_of=AS_OF) -> DataFrame:
    """Age as recorded (the missing marker stays), income and tenure with medians for nulls, gender flags."""
    people = profile.select("id", F.col("age").cast("double").alias("age"), "income", tenure_months(as_of=as_of).alias("tenure_months"),
                            F.coalesce("gender", F.lit("Unknown")).alias("gender"))
    middle = ordered.medians(people, ["age", "income", "tenure_months"])
    filled = people.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in middle.items()})
    return filled.select("id", "age", "income", "tenure_months", *[one_hot("gender", g).alias(f"gender_{g}") for g in ("F", "M", "O", "Unknown")])


def matching_population(exposure: DataFrame, covariates: DataFrame, offer_type: str) -> DataFrame:
    """Customers exposed to the type (treated) and active customers without any offer (controls)."""
    arms = exposure.filter((F.col(offer_type) == 1) | (F.col("any_offer") == 0)).select(F.col("person").alias("id"), F.col(offer_type).alias("treated"))
    return covariates.join(arms, "id")


def propensity_model(population: DataFrame, covariates=COVARIATES, max_iter: int = 1000) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Standardised rows, the logistic model of treatment on them with a unit L2 penalty, and its columns."""
    columns = [c for c in covariates if c in population.columns]
    scaled = durable(standardise(population, columns))
    penalty = 1.0 / max(1, scaled.count())
    assembled = VectorAssembler(inputCols=columns, outputCol="_features")
    model = LogisticRegression(featuresCol="_features", labelCol="treated", regParam=penalty, standardization=False, maxIter=max_iter)
    return scaled, Pipeline(stages=[assembled, model]).fit(scaled), columns


def propensity_scores(population: DataFrame, covariates=COVARIATES, max_iter: int = 1000) -> DataFrame:
    """Adds ``score``, the fitted probability of treatment on standardised covariates with a unit L2 penalty."""
    scaled, model, _ = propensity_model(population, covariates, max_iter)
    scores = model.transform(scaled).select("id", vector_to_array("probability")[1].alias("score"))
    return population.join(scores, "id")


def match_with_replacement(units: DataFrame, caliper: float = 0.2) -> DataFrame:
    """Nearest control by score for each treated unit. Ties: lower score, then smallest id."""
    scores = durable(units.groupBy("score").agg(F.min(F.when(F.col("treated") == 0, F.col("id"))).alias("control_id")))
    near = ordered.nearest_marked(scores, "score", F.col("control_id").isNotNull(), F.struct("score", "control_id"))
    below, above = F.col("score") - F.col("lower.score"), F.col("upper.score") - F.col("score")
    take_lower = F.col("upper").isNull() | (below <= above)
    chosen = near.select("score", F.when(take_lower, F.col("lower")).otherwise(F.col("upper")).alias("match"))
    matched = units.filter("treated = 1").select(F.col("id").alias("treated_id"), "score").join(small_side(chosen), "score")
    distance = F.abs(F.col("score") - F.col("match.score"))
    return matched.filter(distance < caliper).select("treated_id", F.col("match.control_id").alias("control_id"), distance.alias("distance"))


def _positions(units: DataFrame) -> DataFrame:
    """Position of each unit among those of the same score and arm, in md5 order, cut into slices."""
    hashed = units.select("id", "treated", "score", F.md5(F.col("id").cast("string")).alias("_h")).withColumn("_s", F.substring("_h", 1, 3))
    sizes = durable(hashed.groupBy("score", "treated", "_s").agg(F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy("score", "treated").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("score", "treated", "_s", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_b"))
    inside = Window.partitionBy("score", "treated", "_s").orderBy("_h")
    return (hashed.join(before, ["score", "treated", "_s"]).withColumn("position", F.col("_b") + F.row_number().over(inside))
            .select("id", "treated", "score", "position"))


def match_without_replacement(units: DataFrame, caliper: float = 0.2) -> DataFrame:
    """One-to-one matching by score in four steps; each unit is used once, and no unmatched treated unit has an unmatched
    control nearer than ``caliper`` at the end.

    Units of equal score match first, in md5 order of the id. Then those in one cell of the width of the caliper match,
    lowest with lowest. What is left of a cell is of one arm; it meets what is left of the next cell, nearest with nearest and
    as long as the distance allows, first across the upper ends of even cells, then across those of odd ones.
    Units without a score stay unmatched.
    """
    if caliper <= 0:
        raise ValueError("the caliper must be positive")
    units = units.where("score is not null")
    counts = units.groupBy("score").agg(F.count_if(F.col("treated") == 1).alias("t"), F.count_if(F.col("treated") == 0).alias("c"))
    cell = F.floor(F.col("score") / caliper)
    left = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    counts = durable(counts.select("score", cell.alias("cell"), F.least("t", "c").alias("both"), left("t", "c").alias("rest_1"), left("c", "t").alias("rest_0")))
    cells = counts.groupBy("cell").agg(F.sum("rest_1").alias("all_1"), F.sum("rest_0").alias("all_0"))
    levels = ordered.prefix_sums(counts, "score", {"before_1": "rest_1", "before_0": "rest_0"}, by=["cell"])
    levels = durable(levels.join(small_side(cells), "cell").withColumn("paired", F.least("all_1", "all_0")))
    mine = lambda name: F.when(F.col("treated") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    place = F.when(F.col("position") > F.col("both"), mine("before") + F.col("position") - F.col("both"))
    placed = durable(_positions(units).join(small_side(levels), "score").select(
        "id", "treated", "score", "cell", "position", place.alias("place"), (place - F.col("paired")).alias("above"), (mine("all") - F.col("paired")).alias("size")))

    def pairs(rows: DataFrame, key: list[str]) -> DataFrame:
        side = lambda flag, arm: rows.where(F.col("treated") == flag).select(*key, F.col("id").alias(f"{arm}_id"), F.col("score").alias(f"{arm}_score"))
        distance = F.abs(F.col("treated_score") - F.col("control_score"))
        return side(1, "treated").join(side(0, "control"), key).withColumn("distance", distance).where(F.col("distance") < caliper)

    found = ["treated_id", "control_id", "distance"]
    equal = pairs(placed.where("place is null").withColumn("at", F.col("score")), ["at", "position"]).select(*found)
    inside = pairs(placed.where("above <= 0"), ["cell", "place"]).select(*found)
    # the number of a unit from either end of what its cell has left
    rest = placed.where("above > 0").select("id", "treated", "score", "cell", F.col("above").alias("up"), (F.col("size") - F.col("above") + 1).alias("down"))
    even = F.pmod(F.col("cell"), F.lit(2)) == 0
    first = rest.select("*", F.when(even, F.col("cell")).otherwise(F.col("cell") - 1).alias("border"), F.when(even, F.col("down")).otherwise(F.col("up")).alias("turn"))
    crossed = durable(pairs(first, ["border", "turn"]))
    used = crossed.groupBy("border").agg(F.count(F.lit(1)).alias("used"))
    still = first.join(small_side(used), "border", "left").where(F.col("turn") > F.coalesce("used", F.lit(0)))
    second = still.select("id", "treated", "score", F.when(even, F.col("cell") - 1).otherwise(F.col("cell")).alias("border"),
                          F.when(even, F.col("up")).otherwise(F.col("down")).alias("turn"))
    return ordered.union_all([equal, inside, crossed.select(*found), pairs(second, ["border", "turn"]).select(*found)])


def mean_spend(events: DataFrame) -> DataFrame:
    return events.filter(is_transaction()).groupBy("person").agg(money_mean("amount").alias("mean_spend"))


def matched_effect(pairs: DataFrame, spend: DataFrame, min_pairs: int = 10) -> DataFrame:
    """Mean difference of customers' mean spend over pairs (no spend is 0); null below ``min_pairs``."""
    of = lambda side: spend.select(F.col("person").alias(f"{side}_id"), F.col("mean_spend").alias(side))
    joined = pairs.join(of("treated"), "treated_id", "left").join(of("control"), "control_id", "left").fillna(0.0, ["treated", "control"])
    means = joined.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("treated").alias("t"), F.avg("control").alias("c"))
    return means.select("n_pairs", F.when(F.col("n_pairs") >= min_pairs, F.col("t") - F.col("c")).alias("ate_matched"))


def balance(population: DataFrame, covariates: list[str], name: str = "smd") -> DataFrame:
    """Standardised mean difference per covariate (population deviations; 0 where neither arm varies)."""
    long = ordered.unpivot(population, covariates, ["treated"])
    arm = lambda f, flag: f(F.when(F.col("treated") == flag, F.col("value")))
    stats = long.groupBy("metric").agg(
        arm(F.avg, 1).alias("m1"), arm(F.avg, 0).alias("m0"), arm(F.var_pop, 1).alias("v1"), arm(F.var_pop, 0).alias("v0"))
    spread = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    return stats.select("metric", F.when(spread > 0, (F.col("m1") - F.col("m0")) / spread).otherwise(0.0).alias(name))


def balance_before_after(population: DataFrame, pairs: DataFrame, covariates=tuple(COVARIATES[:6])) -> DataFrame:
    """Balance of everyone against balance of the matched; a unit counts once however many pairs it is in."""
    used = pairs.select(F.col("treated_id").alias("id")).unionByName(pairs.select(F.col("control_id").alias("id"))).distinct()
    matched = population.join(used, "id", "left_semi")
    return balance(population, list(covariates), "smd_before").join(balance(matched, list(covariates), "smd_after"), "metric")


def propensity_matching(profile: DataFrame, events: DataFrame, portfolio: DataFrame, offer_type: str, caliper: float = 0.2,
                        replace: bool = False) -> dict[str, DataFrame]:
    """The whole design for one offer type: scored population, pairs, effect and balance."""
    exposure = durable(person_exposure(events, portfolio))
    population = durable(propensity_scores(matching_population(exposure, propensity_covariates(profile), offer_type)))
    pairs = durable((match_with_replacement if replace else match_without_replacement)(population, caliper))
    return {"population": population, "pairs": pairs, "effect": matched_effect(pairs, mean_spend(events)),
            "balance": balance_before_after(population, pairs)}


# Standard normal quantiles at 0.975 and 0.8
Z_ALPHA = 1.959963984540054
Z_BETA = 0.8416212335729143


def required_sample(rates: DataFrame, p1: str, p2: str, customers: int | Column) -> DataFrame:
    """Effect size, sample per arm for 5% and 80% power, and whether enough customers exist.

    Rates outside 0 to 1 (more completions than receipts) are no proportions: effect 0, no sample size, not feasible.
    """
    a, b = F.col(p1), F.col(p2)
    mean = (a + b) / 2
    spread = mean * (1 - mean)
    valid = a.between(0, 1) & b.between(0, 1)
    effect = F.when(valid & (spread > 0), F.abs(b - a) / F.sqrt(spread)).otherwise(0.0)
    root = Z_ALPHA * F.sqrt(2 * spread) + Z_BETA * F.sqrt(a * (1 - a) + b * (1 - b))
    n = F.when(valid & (F.abs(a - b) > 1e-10), F.ceil(root * root / ((b - a) * (b - a))))
    people = F.lit(customers) if isinstance(customers, int) else customers
    return rates.withColumn("effect_size", effect).withColumn("n_per_group", n).withColumn(
        "total_sample", 2 * F.col("n_per_group")).withColumn("feasible", F.coalesce(F.col("total_sample") <= people, F.lit(False)))


def power_curve(rates: DataFrame, p1: str, p2: str, sizes: list[int]) -> DataFrame:
    """Power of the two-sided test at each sample size per arm, in closed form; null for rates outside 0 to 1."""
    a, b, n = F.col(p1), F.col(p2), F.col("n_per_group")
    at = rates.withColumn("n_per_group", F.explode(F.array(*[F.lit(s) for s in sizes])))
    shift = at.withColumn("shift", F.abs(b - a) / F.sqrt((a * (1 - a) + b * (1 - b)) / n))
    power = special.normal_cdf(F.col("shift") - Z_ALPHA) + special.normal_cdf(-F.col("shift") - Z_ALPHA)
    valid = a.between(0, 1) & b.between(0, 1)
    return shift.select("n_per_group", (2 * n).alias("total_n"), F.when(valid, power).alias("power"))


def split_readout(events: DataFrame, portfolio: DataFrame, offer_type: str | None = None) -> DataFrame:
    """Readout of a half-half hash split of customers who received an offer: did they complete one?"""
    kept = with_offer(events, portfolio, ["offer_type"])
    if offer_type:
        kept = kept.filter(F.col("offer_type") == offer_type)
    people = kept.groupBy("person").agg(F.max(is_received().cast("int")).alias("received"), F.max(is_completed().cast("int")).alias("done"))
    arm = F.conv(F.substring(F.md5("person"), 1, 8), 16, 10).cast("long") % 2
    counts = people.filter("received = 1").withColumn("arm", arm).agg(*[
        f for i in (0, 1) for f in (F.count_if(F.col("arm") == i).alias(f"n_{i}"), F.count_if((F.col("arm") == i) & (F.col("done") == 1)).alias(f"s_{i}"))])
    tested = counts.select("n_0", "n_1", safe_ratio("s_0", "n_0").alias("rate_0"), safe_ratio("s_1", "n_1").alias("rate_1"),
                           two_proportion_z("s_1", "n_1", "s_0", "n_0").alias("z_statistic"))
    return with_normal_p(tested)
