"""The registry, the Spark-side derived tables and the shared SQL views of the proof queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.numeric import even_round
from holdfast.operators import features, marts, priority, recommend, snapshot
from holdfast.operators.lifecycle import prediction_band
from holdfast.session import materialize
from holdfast.sources.sample_tables import SAMPLE_DATES, SampleTables

THRESHOLD = 0.14


_STORED: dict[tuple[str, str, str], DataFrame] = {}
# Whole numbers that can be missing are shown as doubles, the only portable nullable number.
_NULLABLE = {"renewal_days_min", "days_since_last_contact", "days_to_churn_after_observation"}


class Tables(SampleTables):
    """Sample tables plus everything the operators derive from them."""

    def _stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived table, written once per session and folder, as a deployment stores it."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            _STORED[key] = materialize(make(), name)
        return _STORED[key]

    def fresh_wide(self) -> DataFrame:
        return snapshot.build_snapshot(self.dim_customer, SAMPLE_DATES, **self.facts())

    def wide_of(self, *names: str, **options) -> DataFrame:
        """The snapshot with only the named facts."""
        facts = self.facts(*names) if names else {}
        return snapshot.build_snapshot(self.dim_customer, SAMPLE_DATES, **facts, **options)

    @cached_property
    def wide(self) -> DataFrame:
        return self._stored("wide_snapshot", self.fresh_wide)

    @cached_property
    def snapshot(self) -> DataFrame:
        return snapshot.snapshot_table(self.wide)

    @cached_property
    def labels(self) -> DataFrame:
        return snapshot.label_table(self.wide)

    def _run(self, base: DataFrame, runs: str = "('run-b', DATE'2001-07-05', 1D)") -> DataFrame:
        """Score rows of the given runs, by a narrow explode of the run list."""
        key, p = "CAST(substring(customer_id, 6, 9) AS BIGINT)", "(raw_churn_probability * _factor)"
        rows = base.selectExpr("*", f"inline(array({runs})) AS (mlflow_run_id, _day, _factor)")
        return rows.withColumns({
            "churn_probability": F.expr(f"rint({p} * 1000000D) / 1000000D"),
            "predicted_churn_label": F.expr(f"CAST({p} >= {THRESHOLD}D AS INT)"),
            "churn_risk_band": prediction_band(F.expr(p)),
            "model_name": F.lit("rule_score"),
            "model_version": F.lit(None).cast("string"),
            "scored_at": F.expr(f"CAST(date_add(_day, CAST({key} % 10 AS INT)) AS TIMESTAMP)"),
        }).drop("_day", "_factor")

    @cached_property
    def predictions(self) -> DataFrame:
        """Two scoring runs over the later splits; the second one is the latest."""
        return self._run(
            self.wide.filter("split_name <> 'train'"), "('run-a', DATE'2001-06-01', 0.9D), ('run-b', DATE'2001-07-05', 1D)"
        ).select(
            "observation_date", "customer_id", "split_name", "churn_probability", "predicted_churn_label",
            "churn_risk_band", "model_name", "model_version", "mlflow_run_id", "scored_at",
        )

    @cached_property
    def context(self) -> DataFrame:
        return marts.customer_context(self.dim_customer, self.dim_channel, self.dim_agency, self.dim_geography)

    @cached_property
    def candidates(self) -> DataFrame:
        """Scored snapshot rows of the candidate splits with their context: one pass, no self-join."""
        scored = self._run(self.wide.filter("split_name IN ('test', 'backtest')"))
        return scored.join(self.context, "customer_id")

    @cached_property
    def queue(self) -> DataFrame:
        return self._stored("queue", lambda: priority.score(self.candidates))

    @cached_property
    def recommendations(self) -> DataFrame:
        """Recommendations for the whole queue; every third customer key is already approved."""
        key = F.substring("customer_id", 6, 9).cast("long")
        return recommend.recommend(self.queue).withColumns({
            "human_review_status": F.when(key % 3 == 0, "APPROVED").otherwise(F.col("human_review_status")),
            "created_at": F.date_add(F.lit("2001-07-05").cast("date"), (key % 10).cast("int")).cast("timestamp"),
        })

    @cached_property
    def scores(self) -> DataFrame:
        """(split_name, label, score) of the rule-based model on every split."""
        return self.wide.select(
            "split_name", "customer_id", "observation_date", F.col("churn_label").alias("label"),
            even_round("raw_churn_probability", 6).alias("score"),
        )

    @cached_property
    def mart(self) -> DataFrame:
        return marts.training_mart(self.snapshot, self.labels, self.dim_customer, self.dim_agency, self.dim_geography)

    @cached_property
    def panel(self) -> DataFrame:
        """The training mart's columns from one pass over the wide snapshot, without the self-join."""
        people = self.dim_customer.select(
            "customer_id", "birth_date", "acquisition_date", "customer_segment", "estimated_income_band",
            "digital_profile", "price_sensitivity_score", "service_sensitivity_score", "digital_engagement_score",
            "loyalty_score", "claim_propensity_score", F.col("home_agency_id").alias("agency_id"), "geography_id",
        )
        return (
            self.wide.withColumnRenamed("customer_age_years", "snapshot_customer_age_years")
            .join(people, "customer_id")
            .join(self.dim_agency.select("agency_id", "agency_type"), "agency_id")
            .join(self.dim_geography.select("geography_id", "region", "urbanicity"), "geography_id")
            .drop("agency_id", "geography_id")
        )


    @cached_property
    def engineered(self) -> DataFrame:
        return self._stored("engineered_panel", lambda: features.engineer(self.panel))


Build = Callable[[Tables], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def register(key: str, build: Build, sql: str | None = None, digits: Mapping[str, int] | int | None = None) -> None:
    """Register a query; ``sql`` is appended to the shared views. ``digits`` rounds doubles on the Spark side."""
    QUERIES[key] = lambda t: finish(build(t), digits)
    if sql is not None:
        ORACLES[key] = f"WITH {VIEWS}\n{sql.strip()}" if not sql.lstrip().upper().startswith("WITH ") else (
            f"WITH {VIEWS},\n{sql.strip()[5:]}"
        )


def finish(df: DataFrame, digits: Mapping[str, int] | int | None = None) -> DataFrame:
    """Portable types: long, double, text and boolean; lists as text."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if f.name in _NULLABLE:
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
            d = digits if isinstance(digits, int) else (digits or {}).get(f.name)
            if d is not None:
                c = F.round(c, d) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(kind, T.NullType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def build(key: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[key](Tables(spark, folder))


def ev(x: str, n: int) -> str:
    """SQL text of half-even rounding on the scaled double."""
    return f"(round_even(CAST({x} AS DOUBLE) * 1e{n}, 0) / 1e{n})"


def fx(x: str, n: int) -> str:
    """SQL text of a number with fixed digits."""
    return f"printf('%.{n}f', {ev(x, n)})"




def pick(values: str, index: str) -> str:
    return "(['" + "','".join(values.split()) + f"'])[CAST({index} AS INTEGER) + 1]"


_CHANNELS = "CH_WEB CH_MOBILE CH_BRANCH CH_CALL_CENTER CH_BROKER CH_PARTNER CH_EMAIL CH_SMS CH_RETENTION_OUTBOUND"
_FAMILIES = "AUTO HOME HEALTH LIFE TRAVEL PET PERSONAL_ACCIDENT"

# The same derived tables in SQL, written against the declared semantics.
VIEWS = f"""
dates(o, split_name) AS (VALUES (DATE '1996-12-31', 'train'), (DATE '1997-12-31', 'train'), (DATE '1998-12-31', 'train'),
  (DATE '1999-12-31', 'validation'), (DATE '2000-12-31', 'test'), (DATE '2001-06-30', 'backtest')),
cust AS (
  SELECT c_custkey AS k, printf('CUST_%09d', c_custkey) AS customer_id, c_name AS source_customer_id,
    'First' || (c_custkey % 211) AS first_name, 'Last' || (c_custkey % 389) AS last_name,
    DATE '1940-01-01' + CAST(c_custkey * 7919 % 20000 AS INTEGER) AS birth_date,
    {pick('F M OTHER', 'c_custkey % 3')} AS gender, 'c' || c_custkey || '@example.org' AS email,
    CASE WHEN c_custkey % 29 <> 0 THEN printf('+33%09d', c_custkey) END AS phone,
    printf('GEO_%03d', c_nationkey) AS geography_id, printf('AGY_%03d', c_custkey * 7 % 25) AS home_agency_id,
    DATE '1994-01-01' + CAST(c_custkey * 131 % 1800 AS INTEGER) AS acquisition_date,
    {pick(_CHANNELS, 'c_custkey * 5 % 9')} AS acquisition_channel_id,
    {pick(_CHANNELS, 'c_custkey % 9')} AS preferred_channel_id,
    CAST(c_custkey % 7 + 1 AS BIGINT) AS household_size,
    {pick('LOW LOWER_MID MID UPPER_MID HIGH', 'c_custkey * 3 % 5')} AS estimated_income_band,
    {pick('LOW MEDIUM HIGH', 'c_custkey * 2 % 3')} AS digital_profile,
    c_custkey % 3 <> 0 AS consent_email, c_custkey % 5 = 0 AS consent_sms, c_custkey % 2 = 0 AS consent_phone,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PRICE_SENSITIVE' WHEN 'BUILDING' THEN 'DIGITAL_FIRST'
      WHEN 'FURNITURE' THEN 'FAMILY_PROTECTOR' WHEN 'HOUSEHOLD' THEN 'HIGH_VALUE' ELSE 'LOW_ENGAGEMENT' END AS customer_segment,
    CAST(c_custkey * 53 % 100 AS DOUBLE) / 100 AS price_sensitivity_score,
    CAST(c_custkey * 61 % 100 AS DOUBLE) / 100 AS service_sensitivity_score,
    CAST(c_custkey * 67 % 100 AS DOUBLE) / 100 AS digital_engagement_score,
    CAST(c_custkey * 37 % 100 AS DOUBLE) / 100 AS loyalty_score,
    CAST(c_custkey * 71 % 100 AS DOUBLE) / 100 AS claim_propensity_score
  FROM customer),
geo AS (
  SELECT printf('GEO_%03d', n_nationkey) AS geography_id, r_name AS region, n_name AS city,
    {pick('URBAN SUBURBAN RURAL', 'n_nationkey % 3')} AS urbanicity
  FROM nation JOIN region ON n_regionkey = r_regionkey),
agency AS (
  SELECT printf('AGY_%03d', n_nationkey) AS agency_id, 'Agency ' || n_name AS agency_name,
    printf('GEO_%03d', n_nationkey) AS geography_id,
    {pick('BRANCH CALL_CENTER BROKER_HUB RETENTION_CENTER', 'n_nationkey % 4')} AS agency_type, n_nationkey + 5 AS employee_count
  FROM nation),
channel AS (
  SELECT unnest AS channel_id, substr(unnest, 4) AS channel_code, 'Channel ' || substr(unnest, 4) AS channel_name
  FROM unnest(['{"','".join(_CHANNELS.split())}'])),
policy AS (
  SELECT o_orderkey AS k, printf('POL_%010d', o_orderkey) AS policy_id, printf('CUST_%09d', o_custkey) AS customer_id,
    {pick(_FAMILIES, '(o_orderkey % 21) // 3')} AS family, {pick('BASIC STANDARD PREMIUM', 'o_orderkey % 3')} AS coverage_tier,
    CASE WHEN o_orderkey % 33 <> 0 THEN printf('AGT_%04d', o_orderkey % 168) END AS agent_id,
    CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 1095 AS end_date,
    CASE o_orderstatus WHEN 'F' THEN 'CANCELLED' WHEN 'O' THEN 'ACTIVE' ELSE 'EXPIRED' END AS status,
    {pick('MONTHLY QUARTERLY ANNUAL', 'o_orderkey % 3')} AS frequency,
    CAST(CAST(floor(o_totalprice) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS premium,
    CAST(o_orderkey % 23 - 4 AS DOUBLE) / 100 AS increase,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 335 AS INTEGER) END AS cancelled_on
  FROM orders),
lines AS (
  SELECT l.*, printf('CUST_%09d', o_custkey) AS customer_id, CAST(l_shipdate AS DATE) AS day
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
payment AS (
  SELECT customer_id, day, CASE l_returnflag WHEN 'A' THEN 'LATE' WHEN 'R' THEN 'REJECTED' ELSE 'PAID' END AS status,
    printf('PAY_%010d', l_orderkey) || '_' || l_linenumber AS payment_id, printf('POL_%010d', l_orderkey) AS policy_id
  FROM lines),
claim AS (
  SELECT customer_id, day,
    CAST(CAST(floor(l_extendedprice) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(14,2)) AS amount
  FROM lines WHERE l_linestatus = 'F'),
contact AS (
  SELECT event_id AS e, event_type, printf('CUST_%09d', user_id * 10 + event_id % 10) AS customer_id,
    DATE '1996-01-01' + CAST(event_id * 61 % 2007 AS INTEGER) AS day
  FROM events),
svc AS (
  SELECT customer_id, day, event_type = 'error' AS complaint, e % 5 IN (0, 1, 3) AS unresolved,
    CASE WHEN e % 7 <> 0 THEN CAST(e % 5 + 1 AS DOUBLE) ELSE 3 END AS score
  FROM contact WHERE event_type IN ('error', 'signup')),
a_pol AS (
  SELECT customer_id, o, count(*) FILTER (act) AS n, count(DISTINCT family) FILTER (act) AS n_prod,
    count(*) FILTER (act AND family = 'AUTO') AS n_auto, count(*) FILTER (act AND family = 'HOME') AS n_home,
    count(*) FILTER (act AND family = 'HEALTH') AS n_health, count(*) FILTER (act AND family = 'LIFE') AS n_life,
    CAST(sum(premium) FILTER (act) AS DOUBLE) AS premium, max(increase) FILTER (act) AS increase,
    max(CASE coverage_tier WHEN 'PREMIUM' THEN 3 WHEN 'STANDARD' THEN 2 ELSE 1 END) FILTER (act) AS tier,
    CAST(sum(greatest(0, (year(o) - year(start_date)) * 12 + month(o) - month(start_date))) FILTER (act) AS DOUBLE) AS months,
    min(date_diff('day', o, end_date)) FILTER (act) AS renewal, count(*) FILTER (cancelled_on <= o) AS n_cancelled,
    min(cancelled_on) FILTER (cancelled_on > o AND cancelled_on <= o + 90) AS churn_date
  FROM (SELECT p.*, d.o, p.status = 'ACTIVE' AND p.end_date >= d.o AS act FROM policy p JOIN dates d ON p.start_date <= d.o)
  GROUP BY ALL),
a_pay AS (
  SELECT customer_id, o, count(*) AS late, count(*) FILTER (status = 'REJECTED') AS rejected,
    count(*) FILTER (day >= o - 183) AS incidents
  FROM payment JOIN dates ON day BETWEEN o - 365 AND o WHERE status <> 'PAID' GROUP BY ALL),
a_clm AS (
  SELECT customer_id, o, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount
  FROM claim JOIN dates ON day BETWEEN o - 365 AND o GROUP BY ALL),
a_int AS (
  SELECT customer_id, o, max(day) AS last_day, count(*) FILTER (day >= o - 92) AS n,
    count(*) FILTER (day >= o - 30 AND e % 9 < 2) AS digital
  FROM contact JOIN dates ON day <= o GROUP BY ALL),
a_svc AS (
  SELECT customer_id, o, count(*) AS n, count(*) FILTER (unresolved) AS unresolved,
    count(*) FILTER (complaint AND day >= o - 183) AS complaints, sum(score) AS score
  FROM svc JOIN dates ON day BETWEEN o - 365 AND o GROUP BY ALL),
a_cmp AS (
  SELECT customer_id, o, count(*) AS n, count(*) FILTER (event_type = 'click') AS opened, count(*) FILTER (e % 3 = 0) AS responded
  FROM contact JOIN dates ON day BETWEEN o - 183 AND o WHERE event_type IN ('click', 'view') GROUP BY ALL),
a_quo AS (
  SELECT customer_id, o, count(*) AS n, CAST(sum(e % 30 + 85) AS DOUBLE) / 100 AS idx
  FROM contact JOIN dates ON day BETWEEN o - 183 AND o WHERE event_type = 'purchase' GROUP BY ALL),
a_act AS (
  SELECT customer_id, o, count(*) AS n, count(*) FILTER (e % 2 = 0) AS accepted
  FROM contact JOIN dates ON day BETWEEN o - 365 AND o WHERE event_type = 'signup' GROUP BY ALL),
measured AS (
  SELECT s.o AS observation_date, c.*, s.split_name,
    greatest(0, (year(s.o) - year(acquisition_date)) * 12 + month(s.o) - month(acquisition_date)) AS tenure_months,
    coalesce(p.n, 0) AS active_policy_count, coalesce(p.n_prod, 0) AS number_of_products,
    coalesce(p.n_auto, 0) AS n_auto, coalesce(p.n_home, 0) AS n_home, coalesce(p.n_health, 0) AS n_health, coalesce(p.n_life, 0) AS n_life,
    coalesce(p.premium, 0) AS total_annual_premium, coalesce(p.increase, 0) AS increase, coalesce(p.tier, 0) AS tier,
    CASE WHEN coalesce(p.n, 0) > 0 THEN p.months / p.n ELSE 0 END AS policy_age, CAST(p.renewal AS DOUBLE) AS renewal_days_min,
    coalesce(p.n_cancelled, 0) AS n_cancelled, p.churn_date,
    coalesce(y.late, 0) AS late, coalesce(y.rejected, 0) AS rejected, coalesce(y.incidents, 0) AS incidents,
    coalesce(l.n, 0) AS claims, coalesce(l.amount, 0) AS claim_amount,
    coalesce(i.n, 0) AS interactions, CAST(date_diff('day', i.last_day, s.o) AS DOUBLE) AS days_since, coalesce(i.digital, 0) AS digital,
    coalesce(v.n, 0) AS cases, coalesce(v.unresolved, 0) AS unresolved, coalesce(v.complaints, 0) AS complaints,
    {ev('v.score / v.n', 2)} AS satisfaction,
    CASE WHEN m.n > 0 THEN CAST(m.opened AS DOUBLE) / m.n ELSE 0 END AS open_rate,
    CASE WHEN m.n > 0 THEN CAST(m.responded AS DOUBLE) / m.n ELSE 0 END AS response_rate,
    coalesce(q.n, 0) AS quotes, CASE WHEN q.n > 0 THEN q.idx / q.n ELSE 1 END AS competitor,
    coalesce(r.n, 0) AS offers, CASE WHEN r.n > 0 THEN CAST(r.accepted AS DOUBLE) / r.n ELSE 0 END AS acceptance
  FROM cust c CROSS JOIN dates s
  LEFT JOIN a_pol p ON p.customer_id = c.customer_id AND p.o = s.o
  LEFT JOIN a_pay y ON y.customer_id = c.customer_id AND y.o = s.o
  LEFT JOIN a_clm l ON l.customer_id = c.customer_id AND l.o = s.o
  LEFT JOIN a_int i ON i.customer_id = c.customer_id AND i.o = s.o
  LEFT JOIN a_svc v ON v.customer_id = c.customer_id AND v.o = s.o
  LEFT JOIN a_cmp m ON m.customer_id = c.customer_id AND m.o = s.o
  LEFT JOIN a_quo q ON q.customer_id = c.customer_id AND q.o = s.o
  LEFT JOIN a_act r ON r.customer_id = c.customer_id AND r.o = s.o),
valued AS (
  SELECT *, least(greatest(total_annual_premium / 2200 * 0.55e0 + CAST(number_of_products AS DOUBLE) * 0.12e0 + loyalty_score * 0.35e0, 0), 1) AS value
  FROM measured),
scored AS (
  SELECT *, least(greatest(1 / (1 + exp(-(-3.05e0 + price_sensitivity_score * 1.35e0 + service_sensitivity_score * 0.55e0
      + CAST(incidents AS DOUBLE) * 0.22e0 + CAST(late AS DOUBLE) * 0.08e0 + CAST(rejected AS DOUBLE) * 0.18e0
      + CAST(complaints AS DOUBLE) * 0.34e0 + CAST(unresolved AS DOUBLE) * 0.14e0 + increase * 3e0
      + CASE WHEN competitor < 0.92e0 AND quotes > 0 THEN 0.28e0 ELSE 0e0 END
      + loyalty_score * -1.25e0 + CAST(number_of_products AS DOUBLE) * -0.16e0 + value * -0.28e0 + acceptance * -0.35e0
      + response_rate * -0.16e0 + CASE WHEN digital_profile = 'LOW' THEN 0.22e0 ELSE 0e0 END))), 0.008e0), 0.62e0) AS prob
  FROM valued),
snap AS (
  SELECT observation_date, customer_id, split_name, tenure_months, active_policy_count, number_of_products, total_annual_premium,
    claims AS total_claims_12m, claim_amount AS total_claim_amount_12m, incidents AS payment_incidents_6m,
    complaints AS complaints_6m, interactions AS interactions_3m, days_since AS days_since_last_contact,
    digital AS digital_sessions_30d, {ev('open_rate', 4)} AS email_open_rate_6m,
    {ev('increase', 4)} AS premium_increase_pct_max_12m, satisfaction AS avg_satisfaction_score_12m, renewal_days_min,
    {ev('value', 4)} AS customer_value_score,
    {ev("date_diff('day', birth_date, observation_date) / 365.25e0", 2)} AS customer_age_years,
    n_auto AS active_auto_policy_count, n_home AS active_home_policy_count, n_health AS active_health_policy_count,
    n_life AS active_life_policy_count, n_cancelled AS cancelled_policy_count_to_date, {ev('policy_age', 2)} AS policy_age_avg_months,
    late AS late_payment_count_12m, rejected AS rejected_payment_count_12m, cases AS service_case_count_12m,
    unresolved AS unresolved_case_count_12m, offers AS retention_offer_count_12m, {ev('acceptance', 4)} AS retention_acceptance_rate_12m,
    quotes AS quote_count_6m, {ev('competitor', 4)} AS competitor_price_index_avg_6m, {ev('response_rate', 4)} AS campaign_response_rate_6m,
    CASE WHEN active_policy_count = 0 THEN 'NONE'
      WHEN n_life >= greatest(n_home, n_health, n_auto) THEN 'LIFE' WHEN n_home >= greatest(n_health, n_auto) THEN 'HOME'
      WHEN n_health >= n_auto THEN 'HEALTH' ELSE 'AUTO' END AS main_product_family,
    {pick('NONE BASIC STANDARD PREMIUM', 'tier')} AS highest_coverage_tier,
    CASE WHEN prob >= 0.18e0 THEN 'VERY_HIGH' WHEN prob >= 0.12e0 THEN 'HIGH' WHEN prob >= 0.07e0 THEN 'MEDIUM' ELSE 'LOW' END AS latent_churn_risk_band
  FROM scored),
lab AS (
  SELECT observation_date, customer_id, split_name, 90 AS prediction_horizon_days,
    CASE WHEN churn_date IS NULL THEN 0 ELSE 1 END AS churn_label, churn_date,
    CASE WHEN churn_date IS NULL THEN 'ACTIVE_OBSERVED' ELSE 'CHURNED_WITHIN_HORIZON' END AS customer_lifecycle_status,
    {ev('prob', 4)} AS churn_probability,
    CASE WHEN prob >= 0.18e0 THEN 'VERY_HIGH' WHEN prob >= 0.12e0 THEN 'HIGH' WHEN prob >= 0.07e0 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk_band,
    CASE WHEN incidents >= 2 THEN 'PAYMENT_INCIDENT' WHEN complaints >= 1 OR satisfaction < 2.8e0 THEN 'SERVICE_DISSATISFACTION'
      WHEN increase >= 0.08e0 THEN 'PREMIUM_INCREASE' WHEN price_sensitivity_score >= 0.72e0 THEN 'PRICE_SENSITIVITY'
      WHEN digital_engagement_score < 0.35e0 THEN 'LOW_ENGAGEMENT' ELSE 'BASELINE_RISK' END AS label_reason
  FROM scored),
pred AS (
  SELECT observation_date, customer_id, split_name, {ev('p', 6)} AS churn_probability,
    CASE WHEN p >= 0.14e0 THEN 1 ELSE 0 END AS predicted_churn_label,
    CASE WHEN p >= 0.08e0 THEN 'VERY_HIGH' WHEN p >= 0.05e0 THEN 'HIGH' WHEN p >= 0.035e0 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk_band,
    'rule_score' AS model_name, CAST(NULL AS VARCHAR) AS model_version, mlflow_run_id, CAST(day + CAST(k % 10 AS INTEGER) AS TIMESTAMP) AS scored_at
  FROM (SELECT observation_date, customer_id, split_name, k, r.run AS mlflow_run_id, prob * r.factor AS p, r.day
        FROM scored CROSS JOIN (VALUES ('run-a', DATE '2001-06-01', 0.9e0), ('run-b', DATE '2001-07-05', 1e0)) r(run, day, factor)
        WHERE split_name <> 'train')),
cand AS (
  SELECT p.*, s.* EXCLUDE (observation_date, customer_id, split_name), c.first_name, c.last_name, c.customer_segment,
    c.estimated_income_band, c.digital_profile, c.price_sensitivity_score, c.service_sensitivity_score, c.digital_engagement_score,
    c.loyalty_score, c.claim_propensity_score, c.consent_email, c.consent_sms, c.consent_phone, h.channel_code AS preferred_channel_code,
    h.channel_name AS preferred_channel_name, a.agency_name, a.agency_type, g.region, g.urbanicity
  FROM pred p JOIN snap s USING (observation_date, customer_id) JOIN cust c USING (customer_id)
  JOIN channel h ON h.channel_id = c.preferred_channel_id JOIN agency a ON a.agency_id = c.home_agency_id
  JOIN geo g ON g.geography_id = c.geography_id
  WHERE p.mlflow_run_id = (SELECT arg_max(mlflow_run_id, scored_at) FROM pred) AND p.split_name IN ('test', 'backtest')),
ranked AS (
  SELECT *, greatest((rank() OVER (ORDER BY total_annual_premium) + (count(*) OVER (PARTITION BY total_annual_premium) - 1) / 2e0) / count(*) OVER (),
      least(greatest(customer_value_score, 0), 1)) AS value_score,
    least(greatest(0.18e0 + 0.28e0 * loyalty_score + 0.22e0 * retention_acceptance_rate_12m + 0.16e0 * campaign_response_rate_6m
      - 0.06e0 * price_sensitivity_score - 0.025e0 * CAST(least(service_case_count_12m, 6) AS DOUBLE)
      - 0.04e0 * CAST(least(unresolved_case_count_12m, 4) AS DOUBLE), 0.05e0), 0.9e0) AS propensity,
    CASE WHEN renewal_days_min <= 15 THEN 1 WHEN renewal_days_min <= 45 THEN 0.75e0 WHEN renewal_days_min <= 90 THEN 0.45e0 ELSE 0.2e0 END AS urgency,
    least(0.35e0 + CASE customer_segment WHEN 'HIGH_VALUE' THEN 0.35e0 WHEN 'FAMILY_PROTECTOR' THEN 0.2e0 ELSE 0e0 END
      + CASE WHEN highest_coverage_tier = 'PREMIUM' THEN 0.15e0 ELSE 0e0 END, 1) AS business,
    total_annual_premium * (1 + 0.04e0 * CAST(active_policy_count AS DOUBLE)) AS yearly
  FROM cand),
priced AS (
  SELECT *, {ev('yearly', 2)} AS estimated_annual_value, {ev('propensity', 4)} AS retention_propensity,
    {ev('100 * (0.42e0 * churn_probability + 0.24e0 * value_score + 0.16e0 * propensity + 0.12e0 * urgency + 0.06e0 * business)', 2)} AS priority_score,
    {ev('yearly * churn_probability * propensity', 2)} AS expected_saved_value
  FROM ranked),
tiered AS (
  SELECT *, CASE WHEN priority_score >= 65 THEN 'CRITICAL' WHEN priority_score >= 50 THEN 'HIGH' WHEN priority_score >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS priority_tier,
    CASE WHEN premium_increase_pct_max_12m >= 0.1e0 OR competitor_price_index_avg_6m < 0.95e0 THEN 'LOYALTY_DISCOUNT_REVIEW'
      WHEN complaints_6m >= 2 OR unresolved_case_count_12m >= 1 THEN 'SERVICE_RECOVERY_CALL'
      WHEN renewal_days_min <= 45 THEN 'RENEWAL_SAVE_CALL'
      WHEN payment_incidents_6m >= 1 OR rejected_payment_count_12m >= 1 THEN 'PAYMENT_PLAN_PROPOSAL'
      WHEN digital_sessions_30d <= 1 AND email_open_rate_6m >= 0.25e0 THEN 'DIGITAL_REENGAGEMENT'
      ELSE 'PROACTIVE_RETENTION_CHECK' END AS recommended_action_type,
    CASE WHEN consent_phone THEN 'PHONE' WHEN consent_email THEN 'EMAIL' WHEN consent_sms THEN 'SMS' ELSE 'AGENCY_TASK' END AS recommended_channel,
    coalesce(nullif(array_to_string(list_filter([
      CASE WHEN premium_increase_pct_max_12m >= 0.1e0 THEN 'recent premium increase' END,
      CASE WHEN competitor_price_index_avg_6m < 0.95e0 THEN 'competitor price pressure' END,
      CASE WHEN complaints_6m >= 2 THEN 'recent complaints' END,
      CASE WHEN unresolved_case_count_12m >= 1 THEN 'unresolved service case' END,
      CASE WHEN renewal_days_min <= 45 THEN 'upcoming renewal' END,
      CASE WHEN payment_incidents_6m >= 1 THEN 'payment incident' END,
      CASE WHEN digital_sessions_30d <= 1 THEN 'low digital engagement' END], lambda x: x IS NOT NULL)[1:4], '; '), ''),
      'high churn risk and significant customer value') AS action_reason
  FROM priced),
queue AS (
  SELECT observation_date, customer_id, split_name, first_name, last_name, customer_segment, region, agency_name, main_product_family,
    churn_probability, churn_risk_band, estimated_annual_value, retention_propensity, expected_saved_value, priority_score, priority_tier,
    recommended_action_type, recommended_channel,
    {ev('''CASE priority_tier WHEN 'CRITICAL' THEN least(estimated_annual_value * 0.12e0, 300) WHEN 'HIGH' THEN least(estimated_annual_value * 0.08e0, 180)
      WHEN 'MEDIUM' THEN least(estimated_annual_value * 0.05e0, 90) ELSE least(estimated_annual_value * 0.03e0, 40) END''', 2)} AS estimated_offer_value,
    action_reason,
    customer_segment || ' | ' || main_product_family || ' | ' || region || ' | estimated annual value ' || printf('%.2f', estimated_annual_value) || ' EUR' AS business_context,
    model_name, model_version, mlflow_run_id, scored_at
  FROM tiered),
strategy(action, offer, message, step) AS (VALUES
  ('LOYALTY_DISCOUNT_REVIEW', 'Controlled loyalty discount', 'Contact the customer to acknowledge price sensitivity and propose a loyalty discount aligned with portfolio value.', 'Retention manager approval before commercial proposal.'),
  ('SERVICE_RECOVERY_CALL', 'Priority resolution call', 'Call the customer to address service pain points, clarify the open case, and confirm a corrective action.', 'Assign a senior service advisor within 24 hours.'),
  ('RENEWAL_SAVE_CALL', 'Renewal save call', 'Contact the customer before renewal to explain coverage value and propose an adjustment if needed.', 'Schedule an outbound call before the next renewal date.'),
  ('PAYMENT_PLAN_PROPOSAL', 'Payment plan adjustment', 'Offer a more flexible payment solution to reduce churn risk linked to payment incidents.', 'Check eligibility for split payment.'),
  ('DIGITAL_REENGAGEMENT', 'Assisted digital reactivation', 'Send a digital re-engagement sequence with reminders about useful services and offer an appointment if needed.', 'Trigger a personalized email campaign.'),
  ('PROACTIVE_RETENTION_CHECK', 'Proactive retention check', 'Review the customer''s situation and propose a preventive contact point before risk worsens.', 'Create an advisor task for qualification.')),
rec AS (
  SELECT 'REC_' || upper(substr(sha1(CAST(observation_date AS VARCHAR) || '|' || customer_id || '|' || mlflow_run_id), 1, 16)) AS recommendation_id,
    observation_date, customer_id, split_name, first_name, last_name, priority_tier, priority_score, churn_probability, expected_saved_value,
    recommended_action_type, recommended_channel, offer || ' - max budget ' || printf('%.2f', estimated_offer_value) || ' EUR' AS recommended_offer,
    estimated_offer_value, first_name || ' ' || last_name || ': ' || message || ' Recommended channel: ' || recommended_channel || '.' AS advisor_message,
    'Priority ' || priority_tier || ' with score ' || printf('%.2f', priority_score) || '. Churn probability ' || {fx('churn_probability * 100', 1)}
      || '%. Expected saved value ' || printf('%.2f', expected_saved_value) || ' EUR. Reasons: ' || action_reason || '.' AS decision_rationale,
    step AS next_best_step, CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 = 0 THEN 'APPROVED' ELSE 'PENDING_REVIEW' END AS human_review_status,
    CAST(NULL AS VARCHAR) AS approval_decision, CAST(NULL AS VARCHAR) AS approval_comment, mlflow_run_id,
    CAST(DATE '2001-07-05' + CAST(CAST(substr(customer_id, 6) AS BIGINT) % 10 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM queue JOIN strategy ON action = recommended_action_type),
scores AS (SELECT split_name, customer_id, observation_date, CASE WHEN churn_date IS NULL THEN 0 ELSE 1 END AS label, {ev('prob', 6)} AS score FROM scored),
mart AS (
  SELECT s.* RENAME (customer_age_years AS snapshot_customer_age_years), l.churn_label, l.churn_date, l.customer_lifecycle_status, l.label_reason,
    l.churn_probability AS synthetic_churn_probability, l.churn_risk_band, c.birth_date, c.acquisition_date, c.customer_segment,
    c.estimated_income_band, c.digital_profile, c.price_sensitivity_score, c.service_sensitivity_score, c.digital_engagement_score,
    c.loyalty_score, c.claim_propensity_score, a.agency_type, g.region, g.urbanicity
  FROM snap s JOIN lab l USING (observation_date, customer_id) JOIN cust c USING (customer_id)
  JOIN agency a ON a.agency_id = c.home_agency_id JOIN geo g ON g.geography_id = c.geography_id),
eng AS (
  SELECT *, {ev("date_diff('day', birth_date, observation_date) / 365.25e0", 2)} AS customer_age_years,
    greatest(date_diff('day', acquisition_date, observation_date), 0) AS customer_lifetime_days, year(observation_date) AS observation_year,
    month(observation_date) AS observation_month, quarter(observation_date) AS observation_quarter,
    coalesce(total_annual_premium / nullif(active_policy_count, 0), 0) AS premium_per_policy,
    coalesce(total_claim_amount_12m / nullif(total_claims_12m, 0), 0) AS claim_amount_per_claim_12m,
    coalesce(CAST(payment_incidents_6m AS DOUBLE) / nullif(active_policy_count, 0), 0) AS payment_incident_rate_per_policy,
    coalesce(CAST(complaints_6m AS DOUBLE) / nullif(interactions_3m, 0), 0) AS complaint_rate_per_interaction,
    digital_engagement_score - email_open_rate_6m AS digital_engagement_gap,
    customer_value_score - price_sensitivity_score AS value_minus_price_sensitivity,
    coalesce(1 - CASE WHEN renewal_days_min IS NOT NULL THEN least(greatest(renewal_days_min, 0), 365) END / 365, 0) AS renewal_urgency_score,
    CASE WHEN renewal_days_min IS NULL OR renewal_days_min <= -1 THEN 'NO_ACTIVE_POLICY' WHEN renewal_days_min <= 30 THEN '0_30_DAYS'
      WHEN renewal_days_min <= 90 THEN '31_90_DAYS' WHEN renewal_days_min <= 180 THEN '91_180_DAYS'
      WHEN renewal_days_min <= 365 THEN '181_365_DAYS' ELSE 'NO_NEAR_RENEWAL' END AS renewal_window
  FROM mart)
""".strip()

