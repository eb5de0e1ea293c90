"""Group B (data quality)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators import quality
from holdfast.schemas import TABLE_RULES
from proof.base import Tables, register


def _one(table: str, rule: str, column: str, violations: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"CAST(coalesce({violations}, 0) AS BIGINT) AS violations, count(*) AS total FROM {source}"
    )


register("b01_not_null", lambda t: quality.not_null(t.dim_customer, "dim_customer", ["customer_id", "email", "phone"]).unionByName(
    quality.not_null(t.fact_policy, "fact_policy", ["agent_id", "policy_start_date", "cancellation_date"])
), " UNION ALL ".join(
    _one(t, "not_null", c, f"count(*) - count({x})", v) for t, c, x, v in (
        ("dim_customer", "customer_id", "customer_id", "cust"), ("dim_customer", "email", "email", "cust"), ("dim_customer", "phone", "phone", "cust"),
        ("fact_policy", "agent_id", "agent_id", "policy"), ("fact_policy", "policy_start_date", "start_date", "policy"),
        ("fact_policy", "cancellation_date", "cancelled_on", "policy"),
    )
))
register("b02_unique_keys", lambda t: quality.unique_key(t.dim_customer, "dim_customer", ["customer_id"]).unionByName(
    quality.unique_key(t.fact_payment, "fact_payment", ["payment_id"])
).unionByName(quality.unique_key(t.labels, "churn_label", ["observation_date", "customer_id"])), " UNION ALL ".join((
    _one("dim_customer", "unique", "customer_id", "count(*) - count(DISTINCT customer_id)", "cust"),
    _one("fact_payment", "unique", "payment_id", "count(*) - count(DISTINCT payment_id)", "payment"),
    _one("churn_label", "unique", "observation_date,customer_id", "count(*) - count(DISTINCT (observation_date, customer_id))", "lab"),
)))
register("b02_duplicate_keys", lambda t: quality.duplicate_keys(t.fact_payment, ["payment_id"]),
         "SELECT payment_id, count(*) AS rows FROM payment GROUP BY ALL HAVING count(*) > 1")


def _known_policies(t: Tables) -> DataFrame:
    return t.fact_policy.filter("policy_status <> 'EXPIRED'")


register("b03_foreign_key", lambda t: quality.foreign_key(t.fact_payment, "fact_payment", "policy_id", _known_policies(t), "policy_id").unionByName(
    quality.foreign_key(t.fact_policy, "fact_policy", "customer_id", t.dim_customer, "customer_id")
), _one("fact_payment", "foreign_key", "policy_id", "count(*) FILTER (policy_id NOT IN (SELECT policy_id FROM policy WHERE status <> 'EXPIRED'))", "payment")
    + " UNION ALL " + _one("fact_policy", "foreign_key", "customer_id", "count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM cust))", "policy"))
register("b03_orphans", lambda t: quality.orphans(t.fact_payment, "policy_id", _known_policies(t), "policy_id"), """
SELECT y.policy_id, count(*) AS rows FROM payment y ANTI JOIN (SELECT * FROM policy WHERE status <> 'EXPIRED') p ON p.policy_id = y.policy_id GROUP BY ALL""")
register("b04_domain", lambda t: quality.in_domain(t.dim_customer, "dim_customer", {
    "estimated_income_band": ("LOW", "MID"), "gender": TABLE_RULES["dim_customer"].domains["gender"],
}), _one("dim_customer", "domain", "estimated_income_band", "count(*) FILTER (estimated_income_band NOT IN ('LOW', 'MID'))", "cust")
    + " UNION ALL " + _one("dim_customer", "domain", "gender", "count(*) FILTER (gender NOT IN ('F', 'M', 'OTHER'))", "cust"))
register("b05_range", lambda t: quality.in_range(t.dim_customer, "dim_customer", {"household_size": (1, 5)}).unionByName(
    quality.in_range(t.dim_agency, "dim_agency", {"employee_count": (1, 10)})
), _one("dim_customer", "range", "household_size", "count(*) FILTER (household_size NOT BETWEEN 1 AND 5)", "cust")
    + " UNION ALL " + _one("dim_agency", "range", "employee_count", "count(*) FILTER (employee_count NOT BETWEEN 1 AND 10)", "agency"))
register("b06_cancellation_consistency", lambda t: quality.holds(
    t.fact_policy.withColumn("policy_status", F.when(F.col("policy_end_date") < "2000-01-01", "LAPSED").otherwise(F.col("policy_status"))),
    "fact_policy", "cancellation_consistency", F.expr(TABLE_RULES["fact_policy"].checks["cancellation_consistency"]),
), _one("fact_policy", "check", "cancellation_consistency", """count(*) FILTER (CASE WHEN end_date < DATE '2000-01-01' THEN cancelled_on IS NULL
    ELSE (status = 'CANCELLED') <> (cancelled_on IS NOT NULL) END)""", "policy"))
register("b07_label_consistency", lambda t: quality.holds(
    t.labels.withColumn("churn_date", F.when(F.col("split_name") != "test", F.col("churn_date"))),
    "churn_label", "churn_label_date_consistency", F.expr(TABLE_RULES["churn_label"].checks["churn_label_date_consistency"]),
), _one("churn_label", "check", "churn_label_date_consistency", "count(*) FILTER (split_name = 'test' AND churn_label = 1)", "lab"))


def _holed(t: Tables) -> DataFrame:
    return t.labels.withColumns({
        "churn_date": F.when(F.col("split_name") != "test", F.col("churn_date")),
        "customer_lifecycle_status": F.when(F.col("split_name") != "train", F.col("customer_lifecycle_status")),
    })


register("b08_backfill", lambda t: quality.backfill_labels(_holed(t)).select("observation_date", "customer_id", "churn_label", "churn_date", "customer_lifecycle_status"), """
SELECT CAST(observation_date AS VARCHAR) AS observation_date, customer_id, churn_label,
  CAST(CASE WHEN split_name = 'test' AND churn_label = 1 THEN observation_date + 90 ELSE churn_date END AS VARCHAR) AS churn_date, customer_lifecycle_status FROM lab""")
register("b09_schema_evolution", lambda t: quality.ensure_columns(
    t.labels.select("observation_date", "customer_id", "churn_label"), {"churn_date": "date", "customer_lifecycle_status": "string"}
).groupBy("churn_label").agg(F.count(F.lit(1)).alias("rows"), F.count("churn_date").alias("dates"), F.count("customer_lifecycle_status").alias("statuses")),
         "SELECT churn_label, count(*) AS rows, 0 AS dates, 0 AS statuses FROM lab GROUP BY ALL")
def _stamped(t: Tables) -> DataFrame:
    """Half of the customers come with a creation time; the others get the current one."""
    known = F.when(F.col("customer_id").rlike("[02468]$"), F.col("acquisition_date").cast("timestamp"))
    given = t.dim_customer.select("customer_id", "phone", known.alias("created_at"))
    filled = quality.with_defaults(given, {"phone": "none", "country": "FR", "is_active": True}, ["created_at", "updated_at"])
    now = F.current_timestamp()  # one instant per query
    return filled.select("customer_id", "phone", "country", "is_active", (F.col("updated_at") == now).alias("updated_now"), F.when(
        F.col("created_at") == now, "now").otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).alias("created_at"))


register("b10_defaults", _stamped, """
SELECT customer_id, coalesce(phone, 'none') AS phone, 'FR' AS country, true AS is_active, true AS updated_now,
  CASE WHEN regexp_matches(customer_id, '[02468]$') THEN strftime(acquisition_date, '%Y-%m-%d 00:00:00') ELSE 'now' END AS created_at FROM cust""")
register("b11_table_volumes", lambda t: quality.table_volumes({
    "dim_customer": t.dim_customer, "dim_agency": t.dim_agency, "fact_policy": t.fact_policy, "fact_payment": t.fact_payment, "fact_claim": t.fact_claim,
    "fact_interaction": t.fact_interaction, "fact_customer_service": t.fact_customer_service, "fact_quote": t.fact_quote,
}), " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {v}" for n, v in (
    ("dim_customer", "cust"), ("dim_agency", "agency"), ("fact_policy", "policy"), ("fact_payment", "payment"), ("fact_claim", "claim"),
    ("fact_interaction", "contact"), ("fact_customer_service", "svc"), ("fact_quote", "(SELECT * FROM contact WHERE event_type = 'purchase')"),
)))
register("b13_missing_counts", lambda t: quality.missing_counts(t.snapshot, only_missing=True), """
SELECT 'renewal_days_min' AS column_name, count(*) - count(renewal_days_min) AS missing FROM snap
UNION ALL SELECT 'avg_satisfaction_score_12m', count(*) - count(avg_satisfaction_score_12m) FROM snap
UNION ALL SELECT 'days_since_last_contact', count(*) - count(days_since_last_contact) FROM snap""")
register("b00_integrity_report", lambda t: quality.integrity_report({
    "dim_customer": t.dim_customer, "dim_agency": t.dim_agency, "dim_geography": t.dim_geography, "fact_policy": t.fact_policy,
    "fact_payment": t.fact_payment, "churn_label": t.labels,
}).filter("violations > 0"), _one("fact_payment", "unique", "payment_id", "count(*) - count(DISTINCT payment_id)", "payment"))
