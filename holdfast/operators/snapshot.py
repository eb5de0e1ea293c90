"""Point-in-time customer snapshots and forward-looking churn labels.

All facts meet in ONE shuffle: each fact row is narrowly expanded to the snapshot dates whose window
holds it, projected to a few fixed-width measures, and the union of all facts and of the customer
spine is aggregated once by (customer, date). Contacts, whose window is open to the past, are combined
per customer first, in a narrow shuffle of their own, instead of being copied to every later date. Rows are dealt by customer
before they combine: a small file holds many customers, and combining where it is read would keep a wide row for each of
them in one task. The number of tasks follows the customers, so that a task's memory is bounded. No measure
is a string, which keeps the aggregate on the hash path. No date-by-date join exists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import band, clip, even_round, sigmoid
from holdfast.session import parts_for

KEYS = ("customer_id", "observation_date")
#: Wide rows (customer and date) that a task combines, and how many at most, on average; each takes about half a kilobyte.
ROWS_PER_TASK, MOST_PER_TASK = 20_000, 500_000
Dates = Sequence[tuple[dt.date, str]]

# Default snapshot calendar, windows in days and status groups.
SNAPSHOT_DATES: Dates = (
    (dt.date(2021, 12, 31), "train"),
    (dt.date(2022, 12, 31), "train"),
    (dt.date(2023, 12, 31), "train"),
    (dt.date(2024, 12, 31), "validation"),
    (dt.date(2025, 12, 31), "test"),
    (dt.date(2026, 6, 30), "backtest"),
)
YEAR_DAYS, HALF_YEAR_DAYS, QUARTER_DAYS, MONTH_DAYS, HORIZON_DAYS = 365, 183, 92, 30, 90
LATE_STATUSES = ("LATE", "REJECTED", "WRITTEN_OFF")
REJECTED_STATUSES = ("REJECTED", "WRITTEN_OFF")
UNRESOLVED_STATUSES = ("OPEN", "IN_PROGRESS", "ESCALATED")
DIGITAL_CHANNELS = ("CH_MOBILE", "CH_WEB")
FAMILIES = ("AUTO", "HOME", "HEALTH", "LIFE", "TRAVEL", "PET", "PERSONAL_ACCIDENT")
COUNTED_FAMILIES = ("AUTO", "HOME", "HEALTH", "LIFE")
TIER_RANKS = ("NONE", "BASIC", "STANDARD", "PREMIUM")
LABEL_BANDS = ((0.18, "VERY_HIGH"), (0.12, "HIGH"), (0.07, "MEDIUM"))


@dataclass(frozen=True)
class ChurnWeights:
    """The rule-based churn score's weights and clamp."""

    intercept: float = -3.05
    price_sensitivity: float = 1.35
    service_sensitivity: float = 0.55
    payment_incidents: float = 0.22
    late_payments: float = 0.08
    rejected_payments: float = 0.18
    complaints: float = 0.34
    unresolved_cases: float = 0.14
    premium_increase: float = 3.0
    cheap_competitor: float = 0.28
    cheap_competitor_index: float = 0.92
    loyalty: float = -1.25
    products: float = -0.16
    customer_value: float = -0.28
    retention_acceptance: float = -0.35
    campaign_response: float = -0.16
    low_digital_profile: float = 0.22
    floor: float = 0.008
    ceiling: float = 0.62


def _dates_sql(dates: Dates) -> str:
    return "array(" + ", ".join(f"DATE'{day.isoformat()}'" for day, _ in dates) + ")"


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def spine(customers: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    """Every customer at every snapshot date, by a narrow explode."""
    entries = ", ".join(f"(DATE'{day.isoformat()}', '{name}')" for day, name in dates)
    return customers.selectExpr(f"inline(array({entries})) AS (observation_date, split_name)", *customers.columns)


def expand_to_dates(
    fact: DataFrame, day: str, dates: Dates = SNAPSHOT_DATES, lookback_days: int | None = None, ahead_days: int = 0
) -> DataFrame:
    """One row per snapshot date whose window ``[date - lookback, date]`` holds the fact's day.

    With ``ahead_days`` the window is ``(date, date + ahead]`` instead. Every row meets the few constant dates in
    a narrow explode and a filter, both inside generated code; no join and no shuffle.
    """
    inside = f"{day} <= observation_date"
    if ahead_days:
        inside = f"{day} > observation_date AND {day} <= date_add(observation_date, {ahead_days})"
    elif lookback_days is not None:
        inside += f" AND {day} >= date_sub(observation_date, {lookback_days})"
    return fact.withColumn("observation_date", F.expr(f"explode({_dates_sql(dates)})")).filter(inside)


def _by_customer(rows: DataFrame, customers: DataFrame, dates: Dates) -> DataFrame:
    """The rows, dealt by customer to as many tasks as the snapshot's size asks for; one alone would not be dealt by a key."""
    return rows.repartition(max(2, parts_for(customers.count() * len(dates), ROWS_PER_TASK, MOST_PER_TASK)), "customer_id")


def _one_if(condition: str, alias: str) -> str:
    return f"CASE WHEN {condition} THEN 1 END AS {alias}"


def _within(day: str, days: int) -> str:
    return f"{day} >= date_sub(observation_date, {days})"


def policy_measures(
    policies: DataFrame, products: DataFrame, dates: Dates = SNAPSHOT_DATES, status_as_of: bool = False,
    horizon_days: int = HORIZON_DAYS,
) -> DataFrame:
    """Policies that had started by each date. ``status_as_of`` reads the status at the date instead of the
    stored final status (which leaks the future, but is the reference rule and the default)."""
    catalog = products.select("product_id", "product_family", "coverage_tier")
    rows = expand_to_dates(policies, "policy_start_date", dates).join(catalog, "product_id", "left")
    o, cancelled = "observation_date", "cancellation_date"
    in_force = f"({cancelled} IS NULL OR {cancelled} > {o})" if status_as_of else "policy_status = 'ACTIVE'"
    active = f"{in_force} AND policy_end_date >= {o}"
    bits = " ".join(f"WHEN '{f}' THEN {1 << i}" for i, f in enumerate(FAMILIES))
    ranks = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIER_RANKS) if i)
    age = f"(year({o}) - year(policy_start_date)) * 12 + month({o}) - month(policy_start_date)"
    return rows.withColumn("_active", F.expr(active)).selectExpr(
        *KEYS,
        _one_if("_active", "p_active"),
        f"CASE WHEN _active THEN CASE product_family {bits} END END AS p_family_bit",
        *[_one_if(f"_active AND product_family = '{f}'", f"p_{f.lower()}") for f in COUNTED_FAMILIES],
        f"CASE WHEN _active THEN CASE coverage_tier {ranks} END END AS p_tier_rank",
        "CASE WHEN _active THEN CAST(annual_premium AS DECIMAL(12,2)) END AS p_premium",
        "CASE WHEN _active THEN CAST(premium_increase_pct_last_renewal AS DOUBLE) END AS p_increase",
        f"CASE WHEN _active THEN greatest(0, {age}) END AS p_age_months",
        f"CASE WHEN _active THEN datediff(policy_end_date, {o}) END AS p_renewal_days",
        _one_if(f"{cancelled} <= {o}", "p_cancelled"),
        f"CASE WHEN {cancelled} > {o} AND {cancelled} <= date_add({o}, {horizon_days}) THEN {cancelled} END AS p_churn_date",
    )


def payment_measures(payments: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    late = payments.filter(f"payment_status IN ({_listed(LATE_STATUSES)})")
    return expand_to_dates(late, "due_date", dates, YEAR_DAYS).selectExpr(
        *KEYS,
        "1 AS y_late",
        _one_if(f"payment_status IN ({_listed(REJECTED_STATUSES)})", "y_rejected"),
        _one_if(_within("due_date", HALF_YEAR_DAYS), "y_incident_6m"),
    )


def claim_measures(claims: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    return expand_to_dates(claims, "claim_date", dates, YEAR_DAYS).selectExpr(
        *KEYS, "1 AS c_claim", "CAST(claim_amount AS DECIMAL(14,2)) AS c_amount"
    )


def interaction_measures(interactions: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    """Contacts per customer and date: the last day, and the counts of the quarter and of the month's digital ones.

    A contact is not copied to the dates. It is the latest candidate of one date only, the first on or after its day;
    the last contact of a date is then the candidate of the nearest date not later that has one. All contacts of a
    customer combine to one row, in the task that holds the customer where they were dealt so, and only that row is spread to dates.
    """
    days = sorted({day for day, _ in dates})
    literal = [f"DATE'{day.isoformat()}'" for day in days]
    digital = f"channel_id IN ({_listed(DIGITAL_CHANNELS)})"
    columns = []
    for i, at in enumerate(literal):
        after = f"_day > {literal[i - 1]} AND " if i else ""
        quarter, month = (f"_day <= {at} AND _day >= date_sub({at}, {n})" for n in (QUARTER_DAYS, MONTH_DAYS))
        columns += [
            f"max(CASE WHEN {after}_day <= {at} THEN _day END) AS _last{i}",
            f"sum(CASE WHEN {quarter} THEN 1 END) AS _quarter{i}",
            f"sum(CASE WHEN {digital} AND {month} THEN 1 END) AS _digital{i}",
        ]
    known = interactions.select("customer_id", "channel_id", F.to_date("interaction_datetime").alias("_day"))
    combined = known.filter(f"_day <= {literal[-1]}").groupBy("customer_id").agg(*map(F.expr, columns))
    carried = ["coalesce(" + ", ".join(f"_last{k}" for k in range(i, -1, -1)) + ")" for i in range(len(days))]
    entries = ", ".join(
        f"named_struct('observation_date', {at}, 'i_last_day', {carried[i]}, 'i_3m', _quarter{i}, 'i_digital_30d', _digital{i})"
        for i, at in enumerate(literal)
    )
    spread = combined.selectExpr("customer_id", f"inline(array({entries}))")
    return spread.filter("i_last_day IS NOT NULL")


def case_measures(cases: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    rows = expand_to_dates(cases.withColumn("_day", F.to_date("opened_datetime")), "_day", dates, YEAR_DAYS)
    return rows.selectExpr(
        *KEYS,
        "1 AS s_case",
        _one_if(f"case_status IN ({_listed(UNRESOLVED_STATUSES)})", "s_unresolved"),
        _one_if(f"case_type = 'COMPLAINT' AND {_within('_day', HALF_YEAR_DAYS)}", "s_complaint_6m"),
        "CAST(coalesce(satisfaction_score, 3) AS DECIMAL(4,2)) AS s_score",
    )


def campaign_measures(campaigns: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    rows = expand_to_dates(campaigns.withColumn("_day", F.to_date("contact_datetime")), "_day", dates, HALF_YEAR_DAYS)
    return rows.selectExpr(*KEYS, "1 AS m_contact", _one_if("responded_flag", "m_responded"), _one_if("opened_flag", "m_opened"))


def quote_measures(quotes: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    return expand_to_dates(quotes, "quote_date", dates, HALF_YEAR_DAYS).selectExpr(
        *KEYS, "1 AS q_quote", "CAST(competitor_price_index AS DECIMAL(6,4)) AS q_index"
    )


def action_measures(actions: DataFrame, dates: Dates = SNAPSHOT_DATES) -> DataFrame:
    return expand_to_dates(actions, "action_date", dates, YEAR_DAYS).selectExpr(
        *KEYS, "1 AS a_offer", _one_if("accepted_flag", "a_accepted")
    )


def _spine_measures(customers: DataFrame, dates: Dates) -> DataFrame:
    return spine(customers, dates).selectExpr(
        *KEYS, "1 AS k_present", "acquisition_date", "birth_date",
        *[f"nanvl(try_cast({c} AS DOUBLE), CAST(NULL AS DOUBLE)) AS {c}" for c in _CARRIED_SCORES],
        _one_if("digital_profile = 'LOW'", "k_low_digital"),
    )


_CARRIED_SCORES = (
    "price_sensitivity_score", "service_sensitivity_score", "digital_engagement_score", "loyalty_score",
)
# How each measure is combined; every combiner is map-side and order-independent.
_COMBINERS = {
    "sum": (
        "p_active", "p_auto", "p_home", "p_health", "p_life", "p_premium", "p_age_months", "p_cancelled",
        "y_late", "y_rejected", "y_incident_6m", "c_claim", "c_amount", "i_3m", "i_digital_30d", "s_case",
        "s_unresolved", "s_complaint_6m", "s_score", "m_contact", "m_responded", "m_opened", "q_quote", "q_index",
        "a_offer", "a_accepted",
    ),
    "max": ("p_tier_rank", "p_increase", "i_last_day", "k_present", "k_low_digital", "acquisition_date", "birth_date")
    + _CARRIED_SCORES,
    "min": ("p_renewal_days", "p_churn_date"),
    "bit_or": ("p_family_bit",),
}


def aggregate_measures(
    customers: DataFrame,
    dates: Dates = SNAPSHOT_DATES,
    *,
    policies: DataFrame | None = None,
    products: DataFrame | None = None,
    payments: DataFrame | None = None,
    claims: DataFrame | None = None,
    interactions: DataFrame | None = None,
    cases: DataFrame | None = None,
    campaigns: DataFrame | None = None,
    quotes: DataFrame | None = None,
    actions: DataFrame | None = None,
    status_as_of: bool = False,
    horizon_days: int = HORIZON_DAYS,
) -> DataFrame:
    """The raw measures per (customer, date); facts left out contribute nothing."""
    parts = [_spine_measures(customers, dates)]
    if policies is not None:
        parts.append(policy_measures(policies, products, dates, status_as_of, horizon_days))
    if interactions is not None:
        interactions = _by_customer(interactions.select("customer_id", "channel_id", "interaction_datetime"), customers, dates)
    for fact, build in (
        (payments, payment_measures), (claims, claim_measures), (interactions, interaction_measures),
        (cases, case_measures), (campaigns, campaign_measures), (quotes, quote_measures),
        (actions, action_measures),
    ):
        if fact is not None:
            parts.append(build(fact, dates))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    known = set(rows.columns)
    combined = [
        F.expr(f"{how}({name}) AS {name}") for how, names in _COMBINERS.items() for name in names if name in known
    ]
    return _by_customer(rows, customers, dates).groupBy(*KEYS).agg(*combined).filter("k_present IS NOT NULL")


def build_snapshot(
    customers: DataFrame, dates: Dates = SNAPSHOT_DATES, *, weights: ChurnWeights = ChurnWeights(),
    horizon_days: int = HORIZON_DAYS, **facts,
) -> DataFrame:
    """Snapshot, label and rule-based score columns of every (customer, date) in one wide row.

    ``facts`` are the keyword arguments of :func:`aggregate_measures`.
    """
    measures = aggregate_measures(customers, dates, horizon_days=horizon_days, **facts)
    known = set(measures.columns)

    def count(name: str) -> str:
        return f"coalesce(CAST({name} AS INT), 0)" if name in known else "0"

    def value(name: str, kind: str = "DOUBLE") -> str:
        return f"CAST({name} AS {kind})" if name in known else f"CAST(NULL AS {kind})"

    def share(part: str, whole: str, default: str = "0D") -> str:
        return f"coalesce(try_divide({value(part)}, {value(whole)}), {default})"

    o = "observation_date"
    splits = " ".join(f"WHEN DATE'{day.isoformat()}' THEN '{name}'" for day, name in dates)
    # Ties between counts go to the last family by name; only other families active gives LIFE.
    by_name = sorted(COUNTED_FAMILIES, reverse=True)
    top_count = "greatest(" + ", ".join(count(f"p_{f.lower()}") for f in by_name) + ")"
    families = " ".join(f"WHEN {count(f'p_{f.lower()}')} = {top_count} THEN '{f}'" for f in by_name)
    raw = measures.selectExpr(
        *KEYS, *_CARRIED_SCORES,
        f"CASE {o} {splits} END AS split_name",
        f"greatest(0, (year({o}) - year(acquisition_date)) * 12 + month({o}) - month(acquisition_date)) AS tenure_months",
        f"rint(datediff({o}, birth_date) / 365.25D * 100D) / 100D AS customer_age_years",
        f"{count('p_active')} AS active_policy_count",
        f"bit_count({count('p_family_bit')}) AS number_of_products",
        *[f"{count(f'p_{f.lower()}')} AS active_{f.lower()}_policy_count" for f in COUNTED_FAMILIES],
        f"coalesce({value('p_premium')}, 0D) AS total_annual_premium",
        f"coalesce({value('p_increase')}, 0D) AS _increase",
        f"CASE WHEN {count('p_active')} = 0 THEN 'NONE' {families} END AS main_product_family",
        f"element_at(array({_listed(TIER_RANKS)}), {count('p_tier_rank')} + 1) AS highest_coverage_tier",
        f"{share('p_age_months', 'p_active')} AS _policy_age",
        f"{count('p_cancelled')} AS cancelled_policy_count_to_date",
        f"{value('p_renewal_days', 'INT')} AS renewal_days_min",
        f"{value('p_churn_date', 'DATE')} AS churn_date",
        f"{count('y_late')} AS late_payment_count_12m",
        f"{count('y_rejected')} AS rejected_payment_count_12m",
        f"{count('y_incident_6m')} AS payment_incidents_6m",
        f"{count('c_claim')} AS total_claims_12m",
        f"coalesce({value('c_amount')}, 0D) AS total_claim_amount_12m",
        f"{count('i_3m')} AS interactions_3m",
        f"datediff({o}, {value('i_last_day', 'DATE')}) AS days_since_last_contact",
        f"{count('i_digital_30d')} AS digital_sessions_30d",
        f"{count('s_case')} AS service_case_count_12m",
        f"{count('s_unresolved')} AS unresolved_case_count_12m",
        f"{count('s_complaint_6m')} AS complaints_6m",
        f"rint(try_divide({value('s_score')}, {value('s_case')}) * 100D) / 100D AS avg_satisfaction_score_12m",
        f"{share('m_opened', 'm_contact')} AS _open_rate",
        f"{share('m_responded', 'm_contact')} AS _response_rate",
        f"{count('q_quote')} AS quote_count_6m",
        f"{share('q_index', 'q_quote', '1D')} AS _competitor_index",
        f"{count('a_offer')} AS retention_offer_count_12m",
        f"{share('a_accepted', 'a_offer')} AS _acceptance_rate",
        f"{count('k_low_digital')} AS _low_digital",
    )
    valued = raw.withColumn("_value", customer_value(
        F.col("total_annual_premium"), F.col("number_of_products"), F.col("loyalty_score"),
    ))
    scored = valued.withColumn("_probability", churn_probability(weights))
    return scored.select(
        "observation_date", "customer_id", "split_name", "tenure_months", "active_policy_count",
        "number_of_products", "total_annual_premium", "total_claims_12m", "total_claim_amount_12m",
        "payment_incidents_6m", "complaints_6m", "interactions_3m", "days_since_last_contact",
        "digital_sessions_30d",
        even_round("_open_rate", 4).alias("email_open_rate_6m"),
        even_round("_increase", 4).alias("premium_increase_pct_max_12m"),
        "avg_satisfaction_score_12m", "renewal_days_min",
        even_round("_value", 4).alias("customer_value_score"),
        "customer_age_years",
        *[f"active_{f.lower()}_policy_count" for f in COUNTED_FAMILIES],
        "cancelled_policy_count_to_date",
        even_round("_policy_age", 2).alias("policy_age_avg_months"),
        "late_payment_count_12m", "rejected_payment_count_12m", "service_case_count_12m",
        "unresolved_case_count_12m", "retention_offer_count_12m",
        even_round("_acceptance_rate", 4).alias("retention_acceptance_rate_12m"),
        "quote_count_6m",
        even_round("_competitor_index", 4).alias("competitor_price_index_avg_6m"),
        even_round("_response_rate", 4).alias("campaign_response_rate_6m"),
        "main_product_family", "highest_coverage_tier",
        label_band(F.col("_probability")).alias("latent_churn_risk_band"),
        F.lit(horizon_days).alias("prediction_horizon_days"),
        F.when(F.col("churn_date").isNotNull(), 1).otherwise(0).alias("churn_label"),
        "churn_date",
        lifecycle_status(F.col("churn_date").isNotNull()).alias("customer_lifecycle_status"),
        F.col("_probability").alias("raw_churn_probability"),
        label_reason().alias("label_reason"),
    )


def customer_value(premium: Column, products: Column, loyalty: Column) -> Column:
    return clip(premium / F.lit(2200.0) * F.lit(0.55) + products * F.lit(0.12) + loyalty * F.lit(0.35), 0.0, 1.0)


def churn_probability(weights: ChurnWeights = ChurnWeights()) -> Column:
    """Rule-based churn score over the columns :func:`build_snapshot` holds before rounding."""
    cheap = (F.col("_competitor_index") < weights.cheap_competitor_index) & (F.col("quote_count_6m") > 0)
    terms = (
        F.col("price_sensitivity_score") * F.lit(weights.price_sensitivity),
        F.col("service_sensitivity_score") * F.lit(weights.service_sensitivity),
        F.col("payment_incidents_6m") * F.lit(weights.payment_incidents),
        F.col("late_payment_count_12m") * F.lit(weights.late_payments),
        F.col("rejected_payment_count_12m") * F.lit(weights.rejected_payments),
        F.col("complaints_6m") * F.lit(weights.complaints),
        F.col("unresolved_case_count_12m") * F.lit(weights.unresolved_cases),
        F.col("_increase") * F.lit(weights.premium_increase),
        F.when(cheap, F.lit(weights.cheap_competitor)).otherwise(F.lit(0.0)),
        F.col("loyalty_score") * F.lit(weights.loyalty),
        F.col("number_of_products") * F.lit(weights.products),
        F.col("_value") * F.lit(weights.customer_value),
        F.col("_acceptance_rate") * F.lit(weights.retention_acceptance),
        F.col("_response_rate") * F.lit(weights.campaign_response),
        F.col("_low_digital") * F.lit(weights.low_digital_profile),
    )
    return clip(sigmoid(reduce(lambda a, b: a + b, terms, F.lit(weights.intercept))), weights.floor, weights.ceiling)


def label_band(probability: Column) -> Column:
    return band(probability, LABEL_BANDS, "LOW")


def lifecycle_status(churned: Column) -> Column:
    return F.when(churned, "CHURNED_WITHIN_HORIZON").otherwise("ACTIVE_OBSERVED")


def label_reason() -> Column:
    """First business reason that applies."""
    return (
        F.when(F.col("payment_incidents_6m") >= 2, "PAYMENT_INCIDENT")
        .when((F.col("complaints_6m") >= 1) | (F.col("avg_satisfaction_score_12m") < 2.8), "SERVICE_DISSATISFACTION")
        .when(F.col("_increase") >= 0.08, "PREMIUM_INCREASE")
        .when(F.col("price_sensitivity_score") >= 0.72, "PRICE_SENSITIVITY")
        .when(F.col("digital_engagement_score") < 0.35, "LOW_ENGAGEMENT")
        .otherwise("BASELINE_RISK")
    )


def snapshot_table(wide: DataFrame) -> DataFrame:
    """The stored snapshot's columns."""
    from holdfast.schemas import table_schema

    return wide.select(*table_schema("customer_360_snapshot").fieldNames())


def label_table(wide: DataFrame) -> DataFrame:
    """The stored label's columns, probability at four digits."""
    return wide.select(
        "observation_date", "customer_id", "split_name", "prediction_horizon_days", "churn_label", "churn_date",
        "customer_lifecycle_status", even_round("raw_churn_probability", 4).alias("churn_probability"),
        F.col("latent_churn_risk_band").alias("churn_risk_band"), "label_reason",
    )
