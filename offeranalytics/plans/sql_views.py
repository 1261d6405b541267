"""SQL views over the test tables, in order of dependency: the counterpart of the adapter and of shared inputs."""

VIEWS: dict[str, str] = {
    "profile": """
SELECT CAST(c_custkey AS VARCHAR) id,
       CAST(CASE WHEN c_acctbal < 0 THEN 118 ELSE 18 + c_custkey * 5 % 84 END AS INT) age,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 50 = 0 THEN 'O' WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END gender,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE round(30000 + c_acctbal * 9, 0) END income,
       CAST(strftime(DATE '2013-07-29' + CAST(c_custkey * 37 % 1824 AS INT), '%Y%m%d') AS INT) became_member_on
FROM customer""",
    "portfolio": """
SELECT CAST(i AS VARCHAR) id,
       CASE WHEN i % 5 IN (0,1) THEN 'bogo' WHEN i % 5 IN (2,3) THEN 'discount' ELSE 'informational' END offer_type,
       CAST(CASE WHEN i % 5 = 4 THEN 0 ELSE 5 + (s % 4) * 5 END AS INT) difficulty,
       CAST(CASE WHEN i % 5 = 4 THEN 0 WHEN i % 5 IN (0,1) THEN 5 + (s % 4) * 5 ELSE 2 + s % 4 END AS INT) reward,
       CAST(3 + s % 8 AS DOUBLE) duration,
       list_filter(['email', CASE WHEN i % 5 <> 3 THEN 'mobile' END, CASE WHEN i % 2 = 0 THEN 'social' END,
                    CASE WHEN n % 3 <> 0 THEN 'web' END], lambda x: x IS NOT NULL) channels
FROM (SELECT CAST(substring(p_brand, 7) AS INT) - 1 i, sum(p_size) s, count(*) n FROM part GROUP BY p_brand)""",
    "transcript": """
SELECT CAST(user_id AS VARCHAR) person,
       CASE event_type WHEN 'signup' THEN 'offer received' WHEN 'view' THEN 'offer viewed' WHEN 'click' THEN 'offer completed' WHEN 'purchase' THEN 'transaction' ELSE event_type END event,
       CAST(datesub('hour', TIMESTAMP '2024-01-01', ts) AS INT) time,
       CASE WHEN event_type IN ('signup','view') THEN CAST(k % 25 AS VARCHAR) END value_offer_id_space,
       CASE WHEN event_type = 'click' THEN CAST(k % 25 AS VARCHAR) END value_offer_id,
       CASE WHEN event_type = 'purchase' THEN value END value_amount
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) k FROM events) e
UNION ALL
SELECT CAST(o_custkey AS VARCHAR), 'transaction',
       CAST((date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30) * 24 + o_orderkey % 24 AS INT), NULL, NULL, o_totalprice
FROM orders""",
    "ev": """
SELECT person, event, time, coalesce(nullif(value_offer_id_space, ''), nullif(value_offer_id, '')) offer_id, value_amount amount
FROM transcript""",
    "oe": """
SELECT ev.*, p.offer_type, p.difficulty, p.reward, p.duration, p.channels, p.id portfolio_id
FROM ev LEFT JOIN portfolio p ON ev.offer_id = p.id WHERE ev.offer_id IS NOT NULL""",
    "clusters": """
SELECT id, CAST(CASE WHEN age = 118 THEN 0 ELSE CAST(id AS INT) % 3 + 1 END AS INT) AS cluster FROM profile""",
    "rules": """
SELECT * FROM (VALUES (0, 'informational', NULL), (1, 'discount', 'bogo'), (2, 'bogo', 'discount'), (3, 'informational', NULL))
t(cluster, primary_offer, secondary_offer)""",
    "offer_stats": """
SELECT offer_id, max(offer_type) offer_type, max(difficulty) difficulty, max(reward) reward, max(duration) duration,
       count(*) FILTER (event = 'offer received') n_received, count(*) FILTER (event = 'offer viewed') n_viewed,
       count(*) FILTER (event = 'offer completed') n_completed,
       CASE WHEN n_received > 0 THEN n_viewed / n_received ELSE 0.0 END view_rate,
       CASE WHEN n_received > 0 THEN n_completed / n_received ELSE 0.0 END completion_rate,
       CASE WHEN n_viewed > 0 THEN n_completed / n_viewed ELSE 0.0 END view_to_completion_rate
FROM oe GROUP BY offer_id""",
    "responder": """
SELECT DISTINCT person FROM ev WHERE event = 'offer completed'""",
    "cust_txn": """
SELECT person customer_id, count(amount) trans_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) trans_total,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) trans_avg, stddev_samp(amount) trans_std,
       CAST(max(CASE WHEN r.p IS NOT NULL THEN 1 ELSE 0 END) AS INT) is_responder
FROM ev LEFT JOIN (SELECT person p FROM responder) r ON ev.person = r.p
WHERE event = 'transaction' AND amount IS NOT NULL GROUP BY person""",
    "demo": """
SELECT id, CAST(nullif(age, 118) AS DOUBLE) age, CAST(age = 118 AS INT) age_missing,
       coalesce(CAST(nullif(age, 118) AS DOUBLE), m.a) age_imputed,
       CASE WHEN age_imputed <= 0 THEN NULL WHEN age_imputed <= 25 THEN '18-25' WHEN age_imputed <= 35 THEN '26-35' WHEN age_imputed <= 45 THEN '36-45'
            WHEN age_imputed <= 55 THEN '46-55' WHEN age_imputed <= 65 THEN '56-65' WHEN age_imputed <= 100 THEN '65+' END age_bin,
       income, CAST(income IS NULL AS INT) income_missing, coalesce(income, m.i) income_imputed,
       CASE WHEN income_imputed <= 0 THEN NULL WHEN income_imputed <= 40000 THEN '<40K' WHEN income_imputed <= 60000 THEN '40-60K'
            WHEN income_imputed <= 80000 THEN '60-80K' WHEN income_imputed <= 100000 THEN '80-100K' WHEN income_imputed <= 200000 THEN '100K+' END income_bin,
       coalesce(profile.gender, 'Unknown') gender,
       CAST(coalesce(profile.gender, 'Unknown') = 'M' AS INT) "gender_M", CAST(coalesce(profile.gender, 'Unknown') = 'F' AS INT) "gender_F",
       CAST(coalesce(profile.gender, 'Unknown') = 'O' AS INT) "gender_O", CAST(coalesce(profile.gender, 'Unknown') = 'Unknown' AS INT) "gender_Unknown",
       CAST(date_diff('day', CAST(strptime(CAST(became_member_on AS VARCHAR), '%Y%m%d') AS DATE), DATE '2018-07-26') AS INT) tenure_days,
       tenure_days / CAST(30.44 AS DOUBLE) tenure_months,
       CASE WHEN tenure_months <= 0 THEN NULL WHEN tenure_months <= 6 THEN '0-6M' WHEN tenure_months <= 12 THEN '6-12M'
            WHEN tenure_months <= 24 THEN '1-2Y' WHEN tenure_months <= 60 THEN '2-5Y' WHEN tenure_months <= 1000 THEN '5Y+' END tenure_bin,
       CAST(became_member_on // 10000 AS INT) member_year, CAST(became_member_on // 100 % 100 AS INT) member_month
FROM profile CROSS JOIN (SELECT median(age) FILTER (age <> 118) a, median(income) i FROM profile) m""",
    "beh_txn": """
SELECT person, count(amount) trans_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) trans_total,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) trans_avg, coalesce(stddev_samp(amount), 0) trans_std,
       min(amount) trans_min, max(amount) trans_max
FROM ev WHERE event = 'transaction' GROUP BY person""",
    "beh_cnt": """
SELECT person, count(*) FILTER (event = 'offer received') offers_received, count(*) FILTER (event = 'offer viewed') offers_viewed,
       count(*) FILTER (event = 'offer completed') offers_completed,
       count(*) FILTER (event = 'offer received' AND offer_type = 'bogo') bogo_received,
       count(*) FILTER (event = 'offer viewed' AND offer_type = 'bogo') bogo_viewed,
       count(*) FILTER (event = 'offer completed' AND offer_type = 'bogo') bogo_completed,
       count(*) FILTER (event = 'offer received' AND offer_type = 'discount') discount_received,
       count(*) FILTER (event = 'offer viewed' AND offer_type = 'discount') discount_viewed,
       count(*) FILTER (event = 'offer completed' AND offer_type = 'discount') discount_completed,
       count(*) FILTER (event = 'offer received' AND offer_type = 'informational') info_received,
       count(*) FILTER (event = 'offer viewed' AND offer_type = 'informational') info_viewed
FROM oe GROUP BY person""",
    "beh": """
SELECT p.id, coalesce(trans_count, 0) trans_count, coalesce(trans_total, 0) trans_total, coalesce(trans_avg, 0) trans_avg,
       coalesce(trans_std, 0) trans_std, coalesce(trans_min, 0) trans_min, coalesce(trans_max, 0) trans_max,
       coalesce(c.offers_received, 0) offers_received, coalesce(c.offers_viewed, 0) offers_viewed, coalesce(c.offers_completed, 0) offers_completed,
       CASE WHEN c.offers_received > 0 THEN c.offers_viewed / c.offers_received ELSE 0.0 END view_rate,
       CASE WHEN c.offers_received > 0 THEN c.offers_completed / c.offers_received ELSE 0.0 END completion_rate,
       CASE WHEN c.offers_viewed > 0 THEN c.offers_completed / c.offers_viewed ELSE 0.0 END view_to_completion_rate,
       coalesce(c.bogo_received, 0) bogo_received, coalesce(c.bogo_viewed, 0) bogo_viewed, coalesce(c.bogo_completed, 0) bogo_completed,
       coalesce(c.discount_received, 0) discount_received, coalesce(c.discount_viewed, 0) discount_viewed, coalesce(c.discount_completed, 0) discount_completed,
       coalesce(c.info_received, 0) info_received, coalesce(c.info_viewed, 0) info_viewed,
       CASE WHEN c.bogo_received > 0 THEN c.bogo_viewed / c.bogo_received ELSE 0.0 END bogo_view_rate,
       CASE WHEN c.bogo_received > 0 THEN c.bogo_completed / c.bogo_received ELSE 0.0 END bogo_completion_rate,
       CASE WHEN c.discount_received > 0 THEN c.discount_viewed / c.discount_received ELSE 0.0 END discount_view_rate,
       CASE WHEN c.discount_received > 0 THEN c.discount_completed / c.discount_received ELSE 0.0 END discount_completion_rate,
       CASE WHEN c.info_received > 0 THEN c.info_viewed / c.info_received ELSE 0.0 END info_view_rate
FROM profile p LEFT JOIN beh_txn t ON p.id = t.person LEFT JOIN beh_cnt c ON p.id = c.person""",
    "rf_base": """
SELECT p.id, coalesce(((SELECT max(time) FROM ev) - max(time)) / 24,
                      ((SELECT max(time) FROM ev) - (SELECT min(time) FROM ev WHERE event = 'transaction')) / 24) recency_days,
       count(time) frequency, coalesce(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE), 0) monetary
FROM profile p LEFT JOIN (SELECT * FROM ev WHERE event = 'transaction') t ON p.id = t.person GROUP BY p.id""",
    "rf": """
SELECT id, recency_days, frequency, monetary,
       CAST(6 - greatest(1, ceil(5 * (rr - 1) / (n - 1))) AS INT) r_quintile, CAST(greatest(1, ceil(5 * (fr - 1) / (n - 1))) AS INT) f_quintile,
       CAST(greatest(1, ceil(5 * (mr - 1) / (n - 1))) AS INT) m_quintile, r_quintile + f_quintile + m_quintile rfm_score
FROM (SELECT *, count(*) OVER () n, row_number() OVER (ORDER BY recency_days, md5(id)) rr,
             row_number() OVER (ORDER BY frequency, md5(id)) fr, row_number() OVER (ORDER BY monetary, md5(id)) mr FROM rf_base)""",
    "decay": """
SELECT p.id, coalesce(CAST(sum(CASE WHEN event = 'transaction' AND time >= e.t - 168 THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE), 0) spend_last_7d,
       coalesce(CAST(sum(CASE WHEN event = 'transaction' AND time >= e.t - 336 THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE), 0) spend_last_14d,
       CASE WHEN sum(CASE WHEN event = 'transaction' THEN amount END) > 0 THEN spend_last_14d / 14 /
            (CAST(sum(CASE WHEN event = 'transaction' THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE) / count(CASE WHEN event = 'transaction' THEN amount END))
            ELSE 0.0 END spend_trend,
       coalesce((e.t - max(CASE WHEN event = 'offer received' THEN time END)) / 24,
                (e.t - (SELECT min(time) FROM ev WHERE event = 'offer received')) / 24) offer_recency_days
FROM profile p CROSS JOIN (SELECT max(time) t FROM ev) e LEFT JOIN ev ON p.id = ev.person GROUP BY p.id, e.t""",
    "first_times": """
SELECT person, offer_id, min(time) FILTER (event = 'offer received') rt, min(time) FILTER (event = 'offer viewed') vt,
       min(time) FILTER (event = 'offer completed') ct
FROM ev WHERE offer_id IS NOT NULL GROUP BY person, offer_id""",
    "timing": """
SELECT p.id, coalesce(avg(CASE WHEN vt >= rt THEN vt - rt END), 0) avg_time_to_view,
       coalesce(avg(CASE WHEN ct >= rt THEN ct - rt END), 0) avg_time_to_complete
FROM profile p LEFT JOIN first_times f ON p.id = f.person GROUP BY p.id""",
    "channels_used": """
SELECT person id, CAST(count(DISTINCT channel) AS BIGINT) total_channels_used
FROM (SELECT person, unnest(channels) channel FROM oe WHERE event = 'offer received') GROUP BY person""",
    "cf": """
SELECT d.*, b.* EXCLUDE (id), r.recency_days, r.frequency, r.monetary, r.rfm_score, y.* EXCLUDE (id), t.* EXCLUDE (id),
       b.trans_total * (1 + b.completion_rate) clv_proxy
FROM demo d JOIN beh b USING (id) JOIN rf r USING (id) JOIN decay y USING (id) JOIN timing t USING (id)""",
    "scored": """
SELECT l_orderkey * 10 + l_linenumber row_id, CAST(l_returnflag = 'R' AS INT) AS label,
       round((l_quantity / 50 + l_discount * 10) / 2, 4) score
FROM lineitem""",
}
