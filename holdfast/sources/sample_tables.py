"""The insurance star schema as views over the sample parquet tables.

Every column is integer arithmetic on the keys of the given tables, so another engine reproduces the
same rows. Orders become policies, line items become payments and claims, events become contacts.
Columns are SQL expressions: one parsed string per column is far cheaper to plan than nested calls.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from holdfast.session import parts_for

# Snapshot dates that lie inside the sample tables' order and ship dates.
SAMPLE_DATES = (
    (dt.date(1996, 12, 31), "train"),
    (dt.date(1997, 12, 31), "train"),
    (dt.date(1998, 12, 31), "train"),
    (dt.date(1999, 12, 31), "validation"),
    (dt.date(2000, 12, 31), "test"),
    (dt.date(2001, 6, 30), "backtest"),
)
# Channel and product catalogs.
CHANNELS = (
    ("CH_WEB", "WEB", "DIGITAL"), ("CH_MOBILE", "MOBILE", "DIGITAL"), ("CH_BRANCH", "BRANCH", "HUMAN"),
    ("CH_CALL_CENTER", "CALL_CENTER", "HUMAN"), ("CH_BROKER", "BROKER", "PARTNER"),
    ("CH_PARTNER", "PARTNER", "PARTNER"), ("CH_EMAIL", "EMAIL", "OUTBOUND"), ("CH_SMS", "SMS", "OUTBOUND"),
    ("CH_RETENTION_OUTBOUND", "RETENTION_OUTBOUND", "OUTBOUND"),
)
CHANNEL_IDS = tuple(c[0] for c in CHANNELS)
FAMILIES = ("AUTO", "HOME", "HEALTH", "LIFE", "TRAVEL", "PET", "PERSONAL_ACCIDENT")
TIERS = ("BASIC", "STANDARD", "PREMIUM")
#: Lines that a task of the join with their orders sorts, and how many at most, on average.
LINES_PER_TASK, MOST_LINES = 500_000, 4_000_000


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} AS INT) + 1)"


def _padded(prefix: str, key: str, width: int = 9) -> str:
    return f"concat('{prefix}', lpad(CAST({key} AS STRING), {width}, '0'))"


def _percent(key: str, factor: int) -> str:
    return f"CAST(({key} * {factor}) % 100 AS DOUBLE) / 100D"


def _cents(c: str) -> str:
    return f"CAST(CAST(floor({c}) AS DECIMAL(12,0)) * 0.01BD AS DECIMAL(12,2))"


class SampleTables:
    """Lazily built views; each property is a DataFrame with the declared table's column names."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def dim_geography(self) -> DataFrame:
        region = self.raw("region").selectExpr("r_regionkey AS n_regionkey", "r_name")
        return self.raw("nation").join(region, "n_regionkey").selectExpr(
            f"{_padded('GEO_', 'n_nationkey', 3)} AS geography_id",
            "'FR' AS country",
            "r_name AS region",
            f"{_padded('DEP_', 'n_nationkey % 10', 2)} AS department",
            "n_name AS city",
            f"{_padded('', 'n_nationkey * 1000', 5)} AS postal_code",
            f"{_pick(('URBAN', 'SUBURBAN', 'RURAL'), 'n_nationkey % 3')} AS urbanicity",
        )

    @cached_property
    def dim_agency(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            f"{_padded('AGY_', 'n_nationkey', 3)} AS agency_id",
            f"{_padded('A', 'n_nationkey', 3)} AS agency_code",
            "concat('Agency ', n_name) AS agency_name",
            f"{_padded('GEO_', 'n_nationkey', 3)} AS geography_id",
            f"{_pick(('BRANCH', 'CALL_CENTER', 'BROKER_HUB', 'RETENTION_CENTER'), 'n_nationkey % 4')} AS agency_type",
            "n_nationkey + 5 AS employee_count",
        )

    @cached_property
    def dim_channel(self) -> DataFrame:
        rows = ", ".join(f"('{i}', '{c}', 'Channel {c}', '{f}')" for i, c, f in CHANNELS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(channel_id, channel_code, channel_name, channel_family)")

    @cached_property
    def dim_product(self) -> DataFrame:
        rows = ", ".join(f"('PROD_{f}_{t}', '{f}', '{t}')" for f in FAMILIES for t in TIERS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_id, product_family, coverage_tier)")

    @cached_property
    def dim_customer(self) -> DataFrame:
        k = "c_custkey"
        return self.raw("customer").selectExpr(
            f"{_padded('CUST_', k)} AS customer_id",
            "c_name AS source_customer_id",
            f"concat('First', {k} % 211) AS first_name",
            f"concat('Last', {k} % 389) AS last_name",
            f"date_add(DATE'1940-01-01', CAST({k} * 7919 % 20000 AS INT)) AS birth_date",
            f"{_pick(('F', 'M', 'OTHER'), f'{k} % 3')} AS gender",
            f"concat('c', {k}, '@example.org') AS email",
            f"CASE WHEN {k} % 29 <> 0 THEN {_padded('+33', k)} END AS phone",
            f"{_padded('GEO_', 'c_nationkey', 3)} AS geography_id",
            f"{_padded('AGY_', f'{k} * 7 % 25', 3)} AS home_agency_id",
            f"date_add(DATE'1994-01-01', CAST({k} * 131 % 1800 AS INT)) AS acquisition_date",
            f"{_pick(CHANNEL_IDS, f'{k} * 5 % 9')} AS acquisition_channel_id",
            f"{_pick(CHANNEL_IDS, f'{k} % 9')} AS preferred_channel_id",
            f"{_pick(('STUDENT', 'EMPLOYED', 'SELF_EMPLOYED', 'RETIRED', 'UNEMPLOYED'), f'{k} % 5')} AS employment_status",
            f"CAST({k} % 7 + 1 AS INT) AS household_size",
            f"{_pick(('LOW', 'LOWER_MID', 'MID', 'UPPER_MID', 'HIGH'), f'{k} * 3 % 5')} AS estimated_income_band",
            f"{_pick(('LOW', 'MEDIUM', 'HIGH'), f'{k} * 2 % 3')} AS digital_profile",
            f"{k} % 3 <> 0 AS consent_email",
            f"{k} % 5 = 0 AS consent_sms",
            f"{k} % 2 = 0 AS consent_phone",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PRICE_SENSITIVE' WHEN 'BUILDING' THEN 'DIGITAL_FIRST' "
            "WHEN 'FURNITURE' THEN 'FAMILY_PROTECTOR' WHEN 'HOUSEHOLD' THEN 'HIGH_VALUE' ELSE 'LOW_ENGAGEMENT' END AS customer_segment",
            f"{_percent(k, 41)} AS risk_affinity_score",
            f"{_percent(k, 53)} AS price_sensitivity_score",
            f"{_percent(k, 61)} AS service_sensitivity_score",
            f"{_percent(k, 67)} AS digital_engagement_score",
            f"{_percent(k, 37)} AS loyalty_score",
            f"{_percent(k, 71)} AS claim_propensity_score",
        )

    @cached_property
    def fact_policy(self) -> DataFrame:
        k, start = "o_orderkey", "to_date(o_orderdate)"
        family = _pick(FAMILIES, f"({k} % 21) DIV 3")
        return self.raw("orders").selectExpr(
            f"{_padded('POL_', k, 10)} AS policy_id",
            f"{_padded('SRC_', k, 10)} AS source_policy_id",
            f"{_padded('CUST_', 'o_custkey')} AS customer_id",
            f"concat('PROD_', {family}, '_', {_pick(TIERS, f'{k} % 3')}) AS product_id",
            f"{_pick(CHANNEL_IDS, f'{k} % 9')} AS sales_channel_id",
            f"CASE WHEN {k} % 33 <> 0 THEN {_padded('AGT_', f'{k} % 168', 4)} END AS agent_id",
            f"{_padded('AGY_', f'{k} % 25', 3)} AS agency_id",
            f"{start} AS policy_start_date",
            f"date_add({start}, 1095) AS policy_end_date",
            "CASE o_orderstatus WHEN 'F' THEN 'CANCELLED' WHEN 'O' THEN 'ACTIVE' ELSE 'EXPIRED' END AS policy_status",
            f"{_pick(('MONTHLY', 'QUARTERLY', 'ANNUAL'), f'{k} % 3')} AS payment_frequency",
            f"{_cents('o_totalprice')} AS annual_premium",
            f"CAST({k} % 23 - 4 AS DOUBLE) / 100D AS premium_increase_pct_last_renewal",
            f"CASE WHEN o_orderstatus = 'F' THEN date_add({start}, CAST({k} % 335 + 30 AS INT)) END AS cancellation_date",
            "CASE WHEN o_orderstatus = 'F' THEN 'CUSTOMER_REQUEST' END AS cancellation_reason",
        )

    def _lines(self) -> DataFrame:
        """Lines with their customers. The number of tasks follows the lines: a task that gathers narrow rows up to a size in
        bytes would sort tens of millions of them at a time."""
        lines, owners = self.raw("lineitem"), self.raw("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        parts = parts_for(lines.count(), LINES_PER_TASK, MOST_LINES)
        return lines.repartition(parts, "l_orderkey").join(owners.repartition(parts, "l_orderkey"), "l_orderkey")

    @cached_property
    def fact_payment(self) -> DataFrame:
        late = "CAST(l_orderkey % 43 + 3 AS INT)"
        return self._lines().selectExpr(
            f"concat({_padded('PAY_', 'l_orderkey', 10)}, '_', l_linenumber) AS payment_id",
            f"{_padded('POL_', 'l_orderkey', 10)} AS policy_id",
            f"{_padded('CUST_', 'o_custkey')} AS customer_id",
            "to_date(l_shipdate) AS due_date",
            f"CASE l_returnflag WHEN 'A' THEN date_add(to_date(l_shipdate), {late}) WHEN 'N' THEN to_date(l_shipdate) END AS payment_date",
            f"{_cents('l_extendedprice')} AS payment_amount",
            "CASE l_returnflag WHEN 'A' THEN 'LATE' WHEN 'R' THEN 'REJECTED' ELSE 'PAID' END AS payment_status",
            f"{_pick(('CARD', 'DIRECT_DEBIT', 'BANK_TRANSFER', 'CHECK', 'CASH', 'WALLET'), 'l_linenumber % 6')} AS payment_method",
            f"CASE WHEN l_returnflag = 'A' THEN {late} ELSE 0 END AS days_late",
        )

    @cached_property
    def fact_claim(self) -> DataFrame:
        statuses = ("OPEN", "UNDER_REVIEW", "APPROVED", "REJECTED", "CLOSED")
        return self._lines().filter("l_linestatus = 'F'").selectExpr(
            f"concat({_padded('CLM_', 'l_orderkey', 10)}, '_', l_linenumber) AS claim_id",
            f"{_padded('POL_', 'l_orderkey', 10)} AS policy_id",
            f"{_padded('CUST_', 'o_custkey')} AS customer_id",
            "to_date(l_shipdate) AS claim_date",
            f"{_pick(statuses, '(l_orderkey + l_linenumber) % 5')} AS claim_status",
            f"{_cents('l_extendedprice')} AS claim_amount",
        )

    def _contacts(self, condition: str | None = None) -> DataFrame:
        events = self.raw("events")
        return (events if condition is None else events.filter(condition)).selectExpr(
            "event_id AS e", "event_type",
            f"{_padded('CUST_', '(user_id * 10 + event_id % 10)')} AS customer_id",
            "date_add(DATE'1996-01-01', CAST(event_id * 61 % 2007 AS INT)) AS day",
        )

    @cached_property
    def fact_interaction(self) -> DataFrame:
        return self._contacts().selectExpr(
            f"{_padded('INT_', 'e', 11)} AS interaction_id", "customer_id",
            f"{_pick(CHANNEL_IDS, 'e % 9')} AS channel_id",
            "CAST(day AS TIMESTAMP) AS interaction_datetime", "event_type AS interaction_type",
            "CASE WHEN e % 2 = 0 THEN 'INBOUND' ELSE 'OUTBOUND' END AS direction",
        )

    @cached_property
    def fact_customer_service(self) -> DataFrame:
        return self._contacts("event_type IN ('error', 'signup')").selectExpr(
            f"{_padded('CASE_', 'e', 11)} AS case_id", "customer_id",
            "CAST(day AS TIMESTAMP) AS opened_datetime",
            "CASE WHEN event_type = 'error' THEN 'COMPLAINT' ELSE 'REQUEST' END AS case_type",
            f"{_pick(('OPEN', 'IN_PROGRESS', 'RESOLVED', 'ESCALATED', 'CLOSED'), 'e % 5')} AS case_status",
            "CASE WHEN e % 7 <> 0 THEN CAST(e % 5 + 1 AS DECIMAL(4,2)) END AS satisfaction_score",
        )

    @cached_property
    def fact_campaign_contact(self) -> DataFrame:
        return self._contacts("event_type IN ('click', 'view')").selectExpr(
            f"{_padded('CMP_', 'e', 11)} AS campaign_contact_id", "customer_id",
            "CAST(day AS TIMESTAMP) AS contact_datetime", "event_type = 'click' AS opened_flag", "e % 3 = 0 AS responded_flag",
        )

    @cached_property
    def fact_quote(self) -> DataFrame:
        return self._contacts("event_type = 'purchase'").selectExpr(
            f"{_padded('QUO_', 'e', 11)} AS quote_id", "customer_id", "day AS quote_date",
            "CAST(CAST(e % 30 + 85 AS DECIMAL(6,0)) * 0.01BD AS DECIMAL(6,4)) AS competitor_price_index",
        )

    @cached_property
    def fact_retention_action(self) -> DataFrame:
        return self._contacts("event_type = 'signup'").selectExpr(
            f"{_padded('RET_', 'e', 11)} AS retention_action_id", "customer_id", "day AS action_date", "e % 2 = 0 AS accepted_flag",
        )

    def facts(self, *names: str) -> dict[str, DataFrame]:
        """Keyword arguments of the snapshot operator; all facts, or the named ones."""
        tables = {
            "policies": "fact_policy", "products": "dim_product", "payments": "fact_payment", "claims": "fact_claim",
            "interactions": "fact_interaction", "cases": "fact_customer_service", "campaigns": "fact_campaign_contact",
            "quotes": "fact_quote", "actions": "fact_retention_action",
        }
        wanted = names or tuple(tables)
        return {n: getattr(self, a) for n, a in tables.items() if n in wanted or (n == "products" and "policies" in wanted)}
