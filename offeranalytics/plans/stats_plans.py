"""Tests, intervals and treatment effects."""

from pyspark.sql import functions as F

from ..functions import ordered
from ..functions.scalars import is_transaction
from ..operators import bootstrap as b, causal as c, certificates, funnel as f, stats as st
from .registry import Inputs, query


def normal_p(z: str) -> str:
    """Two-sided normal p by Simpson's rule, as SQL."""
    return (f"(SELECT 2 * sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(abs({z}) + i * CAST(0.0025 AS DOUBLE), 2) / 2)) "
            f"* CAST(0.0025 AS DOUBLE) / 3 / sqrt(2 * pi()) FROM range(0, 4001) g(i))")


def student_p(t: str, v: str) -> str:
    """Two-sided Student p by Simpson's rule over the angle, as SQL."""
    start, width = f"atan(abs({t}) / sqrt({v}))", f"least(pi() / 2 - atan(abs({t}) / sqrt({v})), 40 / sqrt(greatest({v}, 1)))"
    return (f"(SELECT least(1, 2 * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt(pi()) * {width} / 4000 / 3 * "
            f"sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(greatest(cos({start} + i * {width} / 4000), 0), {v} - 1))) "
            f"FROM range(0, 4001) g(i))")


def cohen(one: str, two: str) -> str:
    pooled = (f"sqrt(((count({one}) - 1) * var_samp({one}) + (count({two}) - 1) * var_samp({two})) / nullif(count({one}) + count({two}) - 2, 0))")
    return f"CASE WHEN count({one}) > 1 AND count({two}) > 1 AND {pooled} > 0 THEN (avg({one}) - avg({two})) / {pooled} ELSE 0 END"


EFFECTS = """
SELECT c.*, nullif(p.age, 118) age_clean, p.income FROM cust_txn c LEFT JOIN profile p ON c.customer_id = p.id"""


@query("h03_effect_sizes", f"""
SELECT metric, d cohens_d, CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END magnitude FROM (
SELECT metric, {cohen('CASE WHEN is_responder = 1 THEN v END', 'CASE WHEN is_responder = 0 THEN v END')} d FROM (
  SELECT is_responder, 'trans_count' metric, CAST(trans_count AS DOUBLE) v FROM ({EFFECTS}) UNION ALL SELECT is_responder, 'trans_avg', trans_avg FROM ({EFFECTS}) UNION ALL
  SELECT is_responder, 'trans_total', trans_total FROM ({EFFECTS}) UNION ALL SELECT is_responder, 'age_clean', age_clean FROM ({EFFECTS}) UNION ALL
  SELECT is_responder, 'income', income FROM ({EFFECTS})) GROUP BY metric)""", doubles="cohens_d")
def effect_sizes(d: Inputs):
    return st.responder_effect_sizes(d.profile, d.events)


@query("h01_cohens_d_amounts", f"""
SELECT count(CASE WHEN r THEN amount END) n_1, count(CASE WHEN NOT r THEN amount END) n_2,
       {cohen('CASE WHEN r THEN amount END', 'CASE WHEN NOT r THEN amount END')} cohens_d
FROM (SELECT amount, person IN (SELECT person FROM responder) r FROM ev WHERE event = 'transaction')""", doubles="cohens_d")
def cohens_d(d: Inputs):
    paid = d.events.filter(is_transaction()).join(f.responders(d.events).withColumn("r", F.lit(1)), "person", "left").fillna(0, ["r"])
    return st.two_groups(paid, "amount", "r").select("n_1", "n_2", st.cohens_d().alias("cohens_d"))


@query("h02_effect_labels", f"""
SELECT l_returnflag, CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END magnitude FROM (
SELECT l_returnflag, {cohen("CASE WHEN l_linestatus = 'O' THEN l_quantity END", "CASE WHEN l_linestatus <> 'O' THEN l_quantity END")} d FROM lineitem GROUP BY l_returnflag)""")
def labels(d: Inputs):
    lines = d.table("lineitem").select("l_returnflag", (F.col("l_linestatus") == "O").cast("int").alias("g"), "l_quantity")
    return st.two_groups(lines, "l_quantity", "g", ["l_returnflag"]).select("l_returnflag", st.effect_label(st.cohens_d()).alias("magnitude"))


@query("h04_two_proportion_z", f"""
SELECT rate_1, rate_2, z_statistic, {normal_p('z_statistic')} p_value, {normal_p('z_statistic')} < 0.05 significant FROM (
SELECT s1 / n1 rate_1, s2 / n2 rate_2, (s1 + s2) / (n1 + n2) q, CASE WHEN q > 0 AND q < 1 THEN (s1 / n1 - s2 / n2) / sqrt(q * (1 - q) * (1 / n1 + 1 / n2)) ELSE 0 END z_statistic FROM (
SELECT count(*) FILTER (offer_type = 'bogo' AND event = 'offer completed') s1, count(*) FILTER (offer_type = 'bogo' AND event = 'offer received') n1,
       count(*) FILTER (offer_type = 'discount' AND event = 'offer completed') s2, count(*) FILTER (offer_type = 'discount' AND event = 'offer received') n2 FROM oe))""",
       doubles="rate_1 rate_2 z_statistic p_value")
def z_test(d: Inputs):
    return st.completion_rate_test(d.events, d.portfolio)


MIDRANK = """
SELECT *, (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2) rk, count(*) OVER (PARTITION BY v) ties, count(*) OVER () n FROM"""


@query("h05_mann_whitney", f"""
SELECT n1 n_1, n2 n_2, u u_statistic, z z_statistic, least(1, {normal_p('z')}) p_value FROM (
SELECT n1, n2, u, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n + 1 - t / (n * (n - 1)))) z FROM (
SELECT count(*) FILTER (r) n1, count(*) FILTER (NOT r) n2, sum(rk) FILTER (r) - count(*) FILTER (r) * (count(*) FILTER (r) + 1) / 2 u,
       CAST(max(n) AS DOUBLE) n, sum(pow(ties, 2) - 1) t
FROM ({MIDRANK} (SELECT amount v, person IN (SELECT person FROM responder) r FROM ev WHERE event = 'transaction'))))""", doubles="u_statistic z_statistic p_value")
def mann_whitney(d: Inputs):
    return st.responder_amount_test(d.events)


GENDERS = """
SELECT gender, CAST(id IN (SELECT person FROM responder) AS INT) completed_offer FROM profile WHERE gender IS NOT NULL"""


@query("a19_contingency", f"""
SELECT gender, count(*) FILTER (completed_offer = 0) "0", count(*) FILTER (completed_offer = 1) "1" FROM ({GENDERS}) GROUP BY gender""")
def contingency(d: Inputs):
    return st.contingency(st.completion_by_gender(d.profile, d.events), "gender", "completed_offer", [0, 1])


@query("h06_chi_squared", f"""
SELECT chi2 chi2_statistic, CAST(2 AS INT) dof, sqrt(chi2 / n) cramers_v, exp(-chi2 / 2) p_value FROM (
SELECT sum(pow(o - r * c / n, 2) / (r * c / n)) chi2, max(n) n FROM (
SELECT o, sum(o) OVER (PARTITION BY gender) r, sum(o) OVER (PARTITION BY completed_offer) c, sum(o) OVER () n FROM (
SELECT g.gender, k.completed_offer, count(x.gender) o FROM (SELECT DISTINCT gender FROM ({GENDERS})) g CROSS JOIN (VALUES (0), (1)) k(completed_offer)
LEFT JOIN ({GENDERS}) x ON x.gender = g.gender AND x.completed_offer = k.completed_offer GROUP BY ALL)))""", doubles="chi2_statistic cramers_v p_value")
def chi_squared(d: Inputs):
    return st.chi_squared(st.completion_by_gender(d.profile, d.events), "gender", "completed_offer")


@query("h06_chi_squared_two_by_two", f"""
SELECT *, {normal_p('sqrt(chi2_statistic)')} p_value FROM (
SELECT n * pow(greatest(0, abs(a * e - b * c) - n / 2), 2) / ((a + b) * (c + e) * (a + c) * (b + e)) chi2_statistic, CAST(1 AS INT) dof,
       sqrt(chi2_statistic / n) cramers_v FROM (
SELECT count(*) FILTER (l_linestatus = 'O' AND l_quantity > 25)::DOUBLE a, count(*) FILTER (l_linestatus = 'O' AND l_quantity <= 25)::DOUBLE b,
       count(*) FILTER (l_linestatus <> 'O' AND l_quantity > 25)::DOUBLE c, count(*) FILTER (l_linestatus <> 'O' AND l_quantity <= 25)::DOUBLE e, count(*)::DOUBLE n FROM lineitem))""",
       doubles="chi2_statistic cramers_v p_value")
def chi_squared_yates(d: Inputs):
    lines = d.table("lineitem").select((F.col("l_linestatus") == "O").alias("a"), (F.col("l_quantity") > 25).alias("b"))
    return st.chi_squared(lines, "a", "b")


@query("h07_kruskal_wallis", f"""
SELECT h h_statistic, CAST(k - 1 AS INT) dof, CASE k WHEN 2 THEN {normal_p('sqrt(h)')} WHEN 3 THEN exp(-h / 2) END p_value FROM (
SELECT (12 / (n * (n + 1)) * sum(r * r / m) - 3 * (n + 1)) / (1 - max(t) / (n * n * n - n)) h, count(*) k FROM (
SELECT offer_type, sum(rk) r, count(*) m, max(n)::DOUBLE n, max(tt) t FROM (SELECT *, sum(pow(ties, 2) - 1) OVER () tt FROM (
{MIDRANK} (SELECT o.offer_type, p.income v FROM oe o JOIN profile p ON o.person = p.id WHERE o.event = 'offer completed' AND p.income IS NOT NULL AND o.offer_type IS NOT NULL)))
GROUP BY offer_type) GROUP BY n)""", doubles="h_statistic", coarse="p_value")
def kruskal(d: Inputs):
    return st.kruskal_wallis(st.income_of_completers(d.profile, d.events, d.portfolio), "income", "offer_type", "n_rows")


ARMS = """
SELECT t.treatment, amount, CASE t.treatment WHEN 'any_offer' THEN x.a WHEN 'bogo' THEN x.b WHEN 'discount' THEN x.d ELSE x.i END treated, e.person, e.time
FROM ev e JOIN (SELECT person, max(CAST(offer_id IS NOT NULL AS INT)) a, max(CAST(coalesce(p.offer_type = 'bogo', false) AS INT)) b,
     max(CAST(coalesce(p.offer_type = 'discount', false) AS INT)) d, max(CAST(coalesce(p.offer_type = 'informational', false) AS INT)) i
     FROM ev LEFT JOIN portfolio p ON ev.offer_id = p.id GROUP BY person) x ON e.person = x.person
CROSS JOIN (VALUES ('any_offer'), ('bogo'), ('discount'), ('informational')) t(treatment)"""
PAID = f"SELECT * FROM ({ARMS}) WHERE amount IS NOT NULL"


@query("c01_populations", f"""
SELECT treatment, count(DISTINCT person) FILTER (treated = 1) n_treated, count(DISTINCT person) FILTER (treated = 0) n_control FROM ({ARMS}) GROUP BY treatment""")
def populations(d: Inputs):
    return c.population_sizes(c.person_exposure(d.events, d.portfolio))


@query("c02_naive_effects", f"""
SELECT treatment, coalesce(avg(amount) FILTER (treated = 0), 0) control_mean, coalesce(avg(amount) FILTER (treated = 1), 0) treatment_mean,
       count(*) FILTER (treated = 0) control_count, count(*) FILTER (treated = 1) treatment_count, treatment_mean - control_mean ate,
       CASE WHEN control_mean > 0 THEN ate / control_mean * 100 ELSE 0 END ate_percent FROM ({PAID}) GROUP BY treatment""",
       doubles="control_mean treatment_mean ate ate_percent")
def naive(d: Inputs):
    return c.naive_effects(c.person_exposure(d.events, d.portfolio))


TREATED, CONTROL = "CASE WHEN treated = 1 THEN amount END", "CASE WHEN treated = 0 THEN amount END"


@query("h08_welch", f"""
SELECT treatment, treatment_n, control_n, treatment_mean, control_mean, t t_statistic, treatment_n + control_n - 2 degrees_freedom, v welch_dof, d cohens_d,
       CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END effect_size_label,
       {student_p('t', 'v')} p_value FROM (
SELECT treatment, count({TREATED}) treatment_n, count({CONTROL}) control_n, avg({TREATED}) treatment_mean, avg({CONTROL}) control_mean,
       var_samp({TREATED}) / count({TREATED}) e1, var_samp({CONTROL}) / count({CONTROL}) e2, (treatment_mean - control_mean) / sqrt(e1 + e2) t,
       pow(e1 + e2, 2) / (e1 * e1 / (count({TREATED}) - 1) + e2 * e2 / (count({CONTROL}) - 1)) v, {cohen(TREATED, CONTROL)} d FROM ({PAID}) GROUP BY treatment)""",
       doubles="treatment_mean control_mean t_statistic cohens_d p_value", coarse="welch_dof")
def welch(d: Inputs):
    return st.welch(c.arm_moments(c.person_exposure(d.events, d.portfolio)), ["treatment"])


def _pairs(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' column_a, '{z}' column_b, corr({a}, {z}) r, count(*) n FROM {table}" for a in columns for z in columns)


OFFER_COLUMNS = ["difficulty", "reward", "duration", "completion_rate", "view_rate"]


def _with_p(sql: str) -> str:
    t = "(r * sqrt((n - 2) / (1 - r * r)))"
    return f"SELECT column_a, column_b, r, n, CASE WHEN abs(r) > 0.999999999999 THEN 0 ELSE {student_p(t, 'CAST(n - 2 AS DOUBLE)')} END p_value FROM ({sql})"


@query("h09_pearson_offers", _with_p(_pairs("offer_stats", OFFER_COLUMNS)), doubles="r p_value")
def pearson(d: Inputs):
    return st.pearson(f.offer_funnel(d.events, d.portfolio), OFFER_COLUMNS)


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("h09_pearson_lines", _with_p(_pairs("lineitem", LINE_COLUMNS)), doubles="r p_value")
def pearson_lines(d: Inputs):
    return st.pearson(d.table("lineitem").select(*LINE_COLUMNS), LINE_COLUMNS)


def _rank(column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2 AS {column}"


@query("h10_spearman_offers", _with_p(_pairs(f"(SELECT {', '.join(map(_rank, OFFER_COLUMNS))} FROM offer_stats)", OFFER_COLUMNS)), doubles="r p_value")
def spearman(d: Inputs):
    return st.spearman(f.offer_funnel(d.events, d.portfolio), OFFER_COLUMNS)


@query("h10_spearman_lines", _with_p(_pairs(f"(SELECT {', '.join(map(_rank, LINE_COLUMNS))} FROM lineitem)", LINE_COLUMNS)), doubles="r p_value")
def spearman_lines(d: Inputs):
    return st.spearman(d.table("lineitem").select(*LINE_COLUMNS), LINE_COLUMNS)


@query("w03_average_ranks", """
SELECT amount, n, before + (n + 1) / 2 AS rank FROM (SELECT amount, n, coalesce(sum(n) OVER (ORDER BY amount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) before
FROM (SELECT amount, count(*) n FROM ev WHERE event = 'transaction' GROUP BY amount))""")
def average_ranks(d: Inputs):
    return ordered.average_ranks(ordered.value_counts(d.events.filter(is_transaction()), "amount"), "amount").select("amount", "n", "rank")


def _replicates(rows: str, arms: list[str], replicates: int) -> str:
    """Replicate means as SQL; ``rows`` has the arms, ``key`` and ``v``."""
    a = ", ".join(arms)
    steps = " + ".join(f"CAST(h >= {s} AS INT)" for s in b.POISSON_STEPS)
    text = " || ':' || ".join(f"CAST({x} AS VARCHAR)" for x in [*arms, "slice", "i"])
    return f"""
SELECT {a}, i, sum(w * cents) / nullif(sum(w * n), 0) / 100 m FROM (SELECT *, {steps} w FROM (
SELECT {a}, slice, cents, n, i, ('0x' || substr(md5({text}), 1, 8))::BIGINT h FROM (
SELECT {a}, ('0x' || substr(md5(key), 1, 8))::BIGINT % {b.SLICES} slice, CAST(sum(CAST(v AS DECIMAL(18,2))) * 100 AS DOUBLE) cents, count(*) n FROM ({rows}) GROUP BY ALL)
CROSS JOIN range(1, {replicates + 1}) r(i))) GROUP BY {a}, i"""


def _mean_interval(rows: str, arm: str, replicates: int) -> str:
    return f"""
SELECT {arm}, mean, n, ci_lower, ci_upper FROM (SELECT {arm}, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(*) mean, count(*) n FROM ({rows}) GROUP BY {arm})
JOIN (SELECT {arm}, quantile_cont(m, 0.025) ci_lower, quantile_cont(m, 0.975) ci_upper FROM ({_replicates(rows, [arm], replicates)}) GROUP BY {arm}) USING ({arm})"""


INDICATOR_ROWS = """
SELECT offer_type, person AS key, max(CASE WHEN event = 'offer completed' THEN 1 ELSE 0 END) v FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type, person"""


@query("h11_completion_rate_intervals", _mean_interval(INDICATOR_ROWS, "offer_type", 10_000), doubles="mean ci_lower ci_upper")
def rate_intervals(d: Inputs):
    people = f.completion_indicator(d.events, d.portfolio)
    return b.mean_interval(people, "completed", F.col("person"), ["offer_type"])


AMOUNT_ROWS = """
SELECT CAST(person IN (SELECT person FROM responder) AS INT) is_responder, person || ':' || CAST(time AS VARCHAR) AS key, amount v FROM ev WHERE event = 'transaction' AND amount IS NOT NULL"""


@query("h11_amount_intervals", _mean_interval(AMOUNT_ROWS, "is_responder", 10_000), doubles="mean ci_lower ci_upper")
def amount_intervals(d: Inputs):
    paid = d.events.filter(is_transaction()).join(f.responders(d.events).withColumn("is_responder", F.lit(1)), "person", "left")
    return b.mean_interval(paid.fillna(0, ["is_responder"]), "amount", F.concat_ws(":", "person", "time"), ["is_responder"])


@query("h12_effect_intervals", f"""
SELECT treatment, quantile_cont(d, 0.025) ci_lower, quantile_cont(d, 0.975) ci_upper, avg(d) bootstrap_mean, stddev_pop(d) bootstrap_std,
       ci_lower <= 0 AND ci_upper >= 0 ci_includes_zero, NOT (ci_lower <= 0 AND ci_upper >= 0) significant FROM (
SELECT treatment, i, max(m) FILTER (treated = 1) - max(m) FILTER (treated = 0) d FROM (
{_replicates(f"SELECT treatment, treated, person || ':' || CAST(time AS VARCHAR) AS key, amount v FROM ({PAID})", ['treatment', 'treated'], 1_000)}) GROUP BY treatment, i) GROUP BY treatment""",
       coarse="ci_lower ci_upper bootstrap_mean bootstrap_std")
def effect_intervals(d: Inputs):
    return c.effect_intervals(d.events, c.person_exposure(d.events, d.portfolio))


SEGMENT = f"""
SELECT cluster, treatment offer_type, count(*) n_customers, count(*) FILTER (treated = 1) treatment_n, count(*) FILTER (treated = 0) control_n,
       coalesce(avg(a) FILTER (treated = 1), 0) tm, coalesce(avg(a) FILTER (treated = 0), 0) cm, treatment_n >= 3 AND control_n >= 3 ok,
       CASE WHEN ok THEN tm END treatment_mean, CASE WHEN ok THEN cm END control_mean, CASE WHEN ok THEN tm - cm END ate,
       CASE WHEN ok THEN CASE WHEN cm > 0 THEN (tm - cm) / cm * 100 ELSE 0 END END ate_percent
FROM (SELECT k.cluster, treatment, person, max(treated) treated, avg(amount) a FROM ({ARMS}) JOIN clusters k ON person = k.id WHERE treatment <> 'any_offer' GROUP BY ALL)
GROUP BY cluster, treatment HAVING count(*) >= 5"""


@query("c03_segment_effects", f"SELECT * EXCLUDE (tm, cm, ok) FROM ({SEGMENT})", coarse="treatment_mean control_mean ate ate_percent")
def segment_effects(d: Inputs):
    return c.segment_effects(c.person_exposure(d.events, d.portfolio), d.clusters)


@query("w07_best_offer_per_segment", f"""
SELECT cluster, min(offer_type) FILTER (round(ate, 6) = round(b, 6)) best_offer, max(b) best_ate FROM (SELECT *, max(ate) OVER (PARTITION BY cluster) b FROM ({SEGMENT})) GROUP BY cluster""", coarse="best_ate")
def best_offers(d: Inputs):
    return c.best_offers(c.segment_effects(c.person_exposure(d.events, d.portfolio), d.clusters))


@query("v06_effect_matrix", f"""
SELECT cluster, max(ate) FILTER (offer_type = 'bogo') bogo, max(ate) FILTER (offer_type = 'discount') discount, max(ate) FILTER (offer_type = 'informational') informational
FROM ({SEGMENT}) GROUP BY cluster""", coarse="bogo discount informational")
def effect_matrix(d: Inputs):
    return c.effect_matrix(c.segment_effects(c.person_exposure(d.events, d.portfolio), d.clusters))


COVARIATES = """
SELECT id, CAST(profile.age AS DOUBLE) age, coalesce(income, (SELECT median(income) FROM profile)) income, d.tenure_months,
       d."gender_F", d."gender_M", d."gender_O", d."gender_Unknown" FROM profile JOIN (SELECT id, tenure_months, "gender_F", "gender_M", "gender_O", "gender_Unknown" FROM demo) d USING (id)"""


@query("c04_covariates", COVARIATES, doubles="tenure_months income")
def covariates(d: Inputs):
    return c.propensity_covariates(d.profile)


POPULATION = f"""
SELECT v.*, CAST(x.b AS INT) treated, round((v.age / 118 + v.income / 120000) / 2, 3) score FROM ({COVARIATES}) v JOIN (
SELECT person, max(CAST(offer_id IS NOT NULL AS INT)) a, max(CAST(coalesce(p.offer_type = 'bogo', false) AS INT)) b FROM ev LEFT JOIN portfolio p ON ev.offer_id = p.id GROUP BY person) x
ON v.id = x.person WHERE x.b = 1 OR x.a = 0"""
PAIRS = f"""
SELECT treated_id, control_id, distance FROM (
SELECT t.id treated_id, s.control_id, abs(t.score - s.score) distance, row_number() OVER (PARTITION BY t.id ORDER BY abs(t.score - s.score), s.score) k
FROM ({POPULATION}) t, (SELECT score, min(id) control_id FROM ({POPULATION}) WHERE treated = 0 GROUP BY score) s WHERE t.treated = 1) WHERE k = 1 AND distance < 0.2"""


def _population(d: Inputs):
    """Customers with a score that SQL can also compute, in place of a fitted one."""
    people = c.matching_population(c.person_exposure(d.events, d.portfolio), c.propensity_covariates(d.profile), "bogo")
    return people.withColumn("score", F.round((F.col("age") / 118 + F.col("income") / 120000) / 2, 3))


@query("c06_match_with_replacement", PAIRS, doubles="distance")
def matched(d: Inputs):
    return c.match_with_replacement(_population(d))


@query("j14_nearest_score_distance", f"SELECT round(distance, 3) distance, count(*) n FROM ({PAIRS}) GROUP BY 1", doubles="distance")
def match_distances(d: Inputs):
    return c.match_with_replacement(_population(d)).groupBy(F.round("distance", 3).alias("distance")).agg(F.count(F.lit(1)).alias("n"))


@query("c07_matched_effect", f"""
SELECT count(*) n_pairs, CASE WHEN count(*) >= 10 THEN avg(coalesce(a.m, 0)) - avg(coalesce(z.m, 0)) END ate_matched FROM ({PAIRS}) p
LEFT JOIN (SELECT person, avg(amount) m FROM ev WHERE event = 'transaction' GROUP BY person) a ON p.treated_id = a.person
LEFT JOIN (SELECT person, avg(amount) m FROM ev WHERE event = 'transaction' GROUP BY person) z ON p.control_id = z.person""", coarse="ate_matched")
def matched_effect(d: Inputs):
    return c.matched_effect(c.match_with_replacement(_population(d)), c.mean_spend(d.events))


def _smd(name: str, rows: str) -> str:
    def one(x):
        t, k = f"CAST(CASE WHEN treated = 1 THEN {x} END AS DOUBLE)", f"CAST(CASE WHEN treated = 0 THEN {x} END AS DOUBLE)"
        spread = f"sqrt((var_pop({t}) + var_pop({k})) / 2)"
        return f"SELECT '{x}' metric, CASE WHEN {spread} > 0 THEN (avg({t}) - avg({k})) / {spread} ELSE 0 END {name} FROM ({rows})"
    return " UNION ALL ".join(one(x) for x in c.COVARIATES[:6])


@query("c08_balance", f"""
SELECT * FROM ({_smd('smd_before', POPULATION)}) JOIN ({_smd('smd_after', f"SELECT * FROM ({POPULATION}) WHERE id IN (SELECT treated_id FROM ({PAIRS}) UNION SELECT control_id FROM ({PAIRS}))")}) USING (metric)""",
       doubles="smd_before smd_after")
def balance(d: Inputs):
    people = _population(d)
    return c.balance_before_after(people, c.match_with_replacement(people))


@query("u01_treated_and_control", f"SELECT id, treated FROM ({POPULATION})")
def union(d: Inputs):
    exposure = c.person_exposure(d.events, d.portfolio)
    arm = lambda test, flag: exposure.filter(test).select(F.col("person").alias("id"), F.lit(flag).alias("treated"))
    return arm("bogo = 1", 1).unionByName(arm("any_offer = 0", 0)).join(d.profile.select("id"), "id", "left_semi")


@query("c05_propensity_scores")
def propensity(d: Inputs):
    exposure = c.person_exposure(d.events, d.portfolio)
    return c.propensity_scores(c.matching_population(exposure, c.propensity_covariates(d.profile), "bogo")).select("id", "treated", "score")


@query("c05_propensity_check", f"SELECT count(*) n_rows, count(*) FILTER (treated = 1) n_positive, TRUE is_optimal FROM ({POPULATION})")
def propensity_check(d: Inputs):
    """No coefficient of the propensity model can be moved to lower its penalised loss over the population."""
    exposure = c.person_exposure(d.events, d.portfolio)
    scaled, model, columns = c.propensity_model(c.matching_population(exposure, c.propensity_covariates(d.profile), "bogo"))
    found = certificates.logistic_slope(model, scaled, columns, "treated")
    return found.select("n_rows", "n_positive", (F.col("slope") < 1e-3).alias("is_optimal"))


PAIRS_ONCE = f"""
SELECT treated_id, control_id, distance FROM (
WITH u AS (SELECT id, treated, score, floor(score / 0.2) cell, row_number() OVER (PARTITION BY score, treated ORDER BY md5(id)) p FROM ({POPULATION}) WHERE score IS NOT NULL),
b AS (SELECT *, least(count(*) FILTER (treated = 1) OVER (PARTITION BY score), count(*) FILTER (treated = 0) OVER (PARTITION BY score)) both_arms FROM u),
q AS (SELECT *, CASE WHEN p > both_arms THEN row_number() OVER (PARTITION BY cell, treated, p > both_arms ORDER BY score, p) END place FROM b),
m AS (SELECT *, count(place) FILTER (treated = 1) OVER (PARTITION BY cell) n1, count(place) FILTER (treated = 0) OVER (PARTITION BY cell) n0 FROM q),
r AS (SELECT id, treated, score, cell, place - least(n1, n0) up, abs(n1 - n0) - (place - least(n1, n0)) + 1 down FROM m WHERE place > least(n1, n0)),
f AS (SELECT *, CASE WHEN cell % 2 = 0 THEN cell ELSE cell - 1 END border, CASE WHEN cell % 2 = 0 THEN down ELSE up END turn FROM r),
x AS (SELECT border, t.id treated_id, c.id control_id, abs(t.score - c.score) distance FROM f t JOIN f c USING (border, turn)
      WHERE t.treated = 1 AND c.treated = 0 AND abs(t.score - c.score) < 0.2),
g AS (SELECT id, treated, score, CASE WHEN cell % 2 = 0 THEN cell - 1 ELSE cell END border, CASE WHEN cell % 2 = 0 THEN up ELSE down END turn
      FROM f WHERE turn > (SELECT count(*) FROM x WHERE x.border = f.border))
SELECT t.id treated_id, c.id control_id, abs(t.score - c.score) distance FROM m t JOIN m c USING (score, p) WHERE t.treated = 1 AND c.treated = 0 AND t.place IS NULL AND c.place IS NULL
UNION ALL SELECT t.id, c.id, abs(t.score - c.score) FROM m t JOIN m c USING (cell, place) WHERE t.treated = 1 AND c.treated = 0
UNION ALL SELECT treated_id, control_id, distance FROM x
UNION ALL SELECT t.id, c.id, abs(t.score - c.score) FROM g t JOIN g c USING (border, turn) WHERE t.treated = 1 AND c.treated = 0) WHERE distance < 0.2"""


@query("c06_match_without_replacement", PAIRS_ONCE, doubles="distance")
def matched_once(d: Inputs):
    return c.match_without_replacement(_population(d))


@query("c06_propensity_pairs")
def propensity_pairs(d: Inputs):
    return c.propensity_matching(d.profile, d.events, d.portfolio, "bogo")["pairs"]


@query("c07_matched_effect_once", f"""
SELECT count(*) n_pairs, CASE WHEN count(*) >= 10 THEN avg(coalesce(a.m, 0)) - avg(coalesce(z.m, 0)) END ate_matched FROM ({PAIRS_ONCE}) p
LEFT JOIN (SELECT person, avg(amount) m FROM ev WHERE event = 'transaction' GROUP BY person) a ON p.treated_id = a.person
LEFT JOIN (SELECT person, avg(amount) m FROM ev WHERE event = 'transaction' GROUP BY person) z ON p.control_id = z.person""", coarse="ate_matched")
def matched_effect_once(d: Inputs):
    return c.matched_effect(c.match_without_replacement(_population(d)), c.mean_spend(d.events))


@query("c07_propensity_effect_and_balance")
def propensity_balance(d: Inputs):
    result = c.propensity_matching(d.profile, d.events, d.portfolio, "discount")
    return result["balance"].withColumns({"n_pairs": result["effect"].select("n_pairs").scalar(), "ate_matched": result["effect"].select("ate_matched").scalar()})


RATES = """
SELECT (SELECT avg(rate) FROM (SELECT CASE WHEN count(DISTINCT person) FILTER (event = 'offer received') > 0 THEN count(DISTINCT person) FILTER (event = 'offer completed')
        / count(DISTINCT person) FILTER (event = 'offer received') ELSE 0 END rate FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type)) p1,
       (SELECT count(*) FILTER (event = 'offer completed') / count(*) FILTER (event = 'offer received') FROM oe) p2"""


def _rates(d: Inputs):
    people = f.persons_by_type(d.events, d.portfolio).agg(F.avg("completion_rate").alias("p1"))
    return people.withColumn("p2", f.overall_funnel(d.events).select("completion_rate").scalar())


PROPORTIONS = "p1 BETWEEN 0 AND 1 AND p2 BETWEEN 0 AND 1"


@query("c09_required_sample", f"""
SELECT p1, p2, CASE WHEN {PROPORTIONS} THEN abs(p2 - p1) / sqrt(m * (1 - m)) ELSE 0 END effect_size,
       CASE WHEN {PROPORTIONS} THEN CAST(ceil(pow({c.Z_ALPHA}::DOUBLE * sqrt(2 * m * (1 - m)) + {c.Z_BETA}::DOUBLE * sqrt(p1 * (1 - p1) + p2 * (1 - p2)), 2) / pow(p2 - p1, 2)) AS BIGINT) END n_per_group,
       2 * n_per_group total_sample, coalesce(2 * n_per_group <= (SELECT count(*) FROM profile), false) feasible FROM (SELECT *, (p1 + p2) / 2 m FROM ({RATES}))""", doubles="p1 p2 effect_size")
def required_sample(d: Inputs):
    return c.required_sample(_rates(d), "p1", "p2", d.profile.agg(F.count(F.lit(1)).alias("n")).scalar())


@query("c10_power_curve", f"""
SELECT CAST(n AS INT) n_per_group, CAST(2 * n AS INT) total_n, CASE WHEN d IS NULL THEN NULL WHEN d > 0 THEN 1 - {normal_p('d')} / 2 ELSE {normal_p('d')} / 2 END + {normal_p('e')} / 2 AS power FROM (
SELECT n, CASE WHEN {PROPORTIONS} THEN abs(p2 - p1) / sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / n) - {c.Z_ALPHA}::DOUBLE END d, abs(p2 - p1) / sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / n) + {c.Z_ALPHA}::DOUBLE e
FROM ({RATES}) CROSS JOIN (VALUES (100), (500), (1000), (2000), (5000), (10000)) s(n))""", doubles="power")
def power(d: Inputs):
    return c.power_curve(_rates(d), "p1", "p2", [100, 500, 1000, 2000, 5000, 10000])


@query("c10_split_readout", f"""
SELECT n_0, n_1, s_0 / n_0 rate_0, s_1 / n_1 rate_1, z z_statistic, {normal_p('z')} p_value, {normal_p('z')} < 0.05 significant FROM (
SELECT *, (s_0 + s_1) / (n_0 + n_1) q, CASE WHEN q > 0 AND q < 1 THEN (s_1 / n_1 - s_0 / n_0) / sqrt(q * (1 - q) * (1 / n_0 + 1 / n_1)) ELSE 0 END z FROM (
SELECT count(*) FILTER (k = 0) n_0, count(*) FILTER (k = 1) n_1, count(*) FILTER (k = 0 AND done) s_0, count(*) FILTER (k = 1 AND done) s_1 FROM (
SELECT person, ('0x' || substr(md5(person), 1, 8))::BIGINT % 2 k, bool_or(event = 'offer completed') done FROM oe WHERE offer_type = 'bogo' GROUP BY person HAVING bool_or(event = 'offer received'))))""",
       doubles="rate_0 rate_1 z_statistic p_value")
def readout(d: Inputs):
    return c.split_readout(d.events, d.portfolio, "bogo")
