"""Per-customer risk signals, for the whole profile table at once. Everything is row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import band, even_round, fixed_text, number

# Fixed values: (field, threshold, label, low value is the risk, unit shown).
SIGNALS = (
    ("price_sensitivity_score", 0.65, "sensibilite prix elevee", False, ""),
    ("avg_satisfaction_score_12m", 3.5, "satisfaction faible sur 12 mois", True, ""),
    ("renewal_days_min", 45.0, "renouvellement proche", True, "jours"),
    ("days_since_last_contact", 90.0, "pas de contact recent", False, "jours"),
    ("payment_incidents_6m", 0.0, "incidents de paiement recents", False, ""),
    ("complaints_6m", 0.0, "reclamations recentes", False, ""),
)
REASON_SEVERITY = 0.95
REASONING_BANDS = ((0.75, "VERY_HIGH"), (0.5, "HIGH"), (0.25, "MEDIUM"))
INTERPRETATIONS = ((0.75, "risque tres eleve"), (0.5, "risque eleve"), (0.25, "risque moyen"))
BAND_LABELS = (("VERY_HIGH", "tres eleve"), ("HIGH", "eleve"), ("MEDIUM", "moyen"), ("LOW", "faible"))
DEFAULT_ACTION_TEXT = "faire revoir ce client par un conseiller retention"
FEATURE_LABELS = (
    ("price_sensitivity_score", "sensibilite au prix"), ("loyalty_score", "score de fidelite"),
    ("service_sensitivity_score", "sensibilite au service"), ("customer_segment", "segment client"),
    ("claim_propensity_score", "propension aux sinistres"),
    ("days_since_last_contact", "anciennete du dernier contact"),
    ("digital_engagement_score", "engagement digital"), ("avg_satisfaction_score_12m", "satisfaction moyenne"),
)


def _signal(position: int, field: str, label: Column, value: Column, severity: Column) -> Column:
    return F.struct(
        severity.alias("severity"), F.lit(position).alias("position"), F.lit(field).alias("field"),
        label.alias("label"), value.alias("value"),
    )


def _threshold_signal(position: int, field: str, threshold: float, label: str, low_is_risk: bool, unit: str) -> Column:
    value = number(field)
    risky = value <= threshold if low_is_risk else value > threshold
    strength = even_round(
        F.least(F.abs(value - F.lit(threshold)) / F.lit(max(abs(threshold), 1.0)) + F.lit(0.5), F.lit(1.0)), 3
    )
    shown = (
        F.concat(fixed_text(value, 0), F.lit(f" {unit}")) if unit else even_round(value, 3).cast("string")
    )
    return F.when(risky, _signal(position, field, F.lit(label), shown, strength))


def signal_array(columns: list[str]) -> Column:
    """All signals of a row, strongest first; equal strengths keep their declared order."""
    found = []
    if "action_reason" in columns:
        reason = F.col("action_reason")
        found.append(F.when(reason.isNotNull() & (reason != ""), _signal(
            0, "action_reason", reason, reason, F.lit(REASON_SEVERITY)
        )))
    found += [_threshold_signal(i, *s) for i, s in enumerate(SIGNALS, start=1) if s[0] in columns]
    return F.array_sort(
        F.array_compact(F.array(*found)),
        lambda a, b: F.when(a["severity"] > b["severity"], -1).when(a["severity"] < b["severity"], 1)
        .otherwise(a["position"] - b["position"]),
    )


def customer_signals(profiles: DataFrame, top: int | None = None) -> DataFrame:
    """One row per signal with its rank inside the profile row."""
    signals = signal_array(profiles.columns)
    if top is not None:
        signals = F.slice(signals, 1, top)
    keys = [c for c in ("customer_id", "observation_date") if c in profiles.columns]
    return profiles.select(*keys, F.posexplode(signals).alias("_i", "_s")).select(
        *keys, (F.col("_i") + 1).alias("rank"), "_s.field", "_s.label", "_s.value", "_s.severity",
        F.lit("risk").alias("direction"),
    )


def probability_view(profiles: DataFrame) -> DataFrame:
    """Probability with its derived band, texts and whether the stored band agrees."""
    p = number("churn_probability")
    derived = band(p, REASONING_BANDS, "LOW")
    stored = F.coalesce(F.col("churn_risk_band"), derived)

    chain = F.when(stored.isNull(), "non estime")
    for name, text in BAND_LABELS:
        chain = chain.when(stored == name, text)
    label = chain.otherwise(F.lower(F.replace(stored, F.lit("_"), F.lit(" "))))
    keys = [c for c in ("customer_id", "observation_date", "mlflow_run_id") if c in profiles.columns]
    disagrees = F.coalesce(stored != derived, F.lit(False))
    # The note's wording.
    note = F.concat(
        F.lit("La table retourne une bande "), stored, F.lit(", alors que la probabilite correspond a "), derived,
        F.lit("; verifier la calibration ou la definition de la bande."),
    )
    return profiles.select(
        *keys, p.alias("probability"),
        F.coalesce(F.concat(fixed_text(p * 100, 0), F.lit("%")), F.lit("non estimee")).alias("probability_label"),
        stored.alias("risk_band"), label.alias("risk_band_label"),
        F.coalesce(band(p, INTERPRETATIONS, "risque faible a surveiller"), F.lit("score non disponible")).alias("probability_interpretation"),
        derived.alias("derived_risk_band"), F.when(disagrees, note).alias("consistency_note"),
    )


def band_agreement(profiles: DataFrame) -> DataFrame:
    """Rows per (stored, derived) band with the disagreement flag."""
    view = probability_view(profiles)
    return view.groupBy("risk_band", "derived_risk_band").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "consistent", F.coalesce(F.col("risk_band") == F.col("derived_risk_band"), F.lit(True))
    )


def feature_label(feature: Column) -> Column:
    chain = F.when(F.lit(False), "")
    for name, text in FEATURE_LABELS:
        chain = chain.when(feature == name, text)
    return chain.otherwise(F.replace(feature, F.lit("_"), F.lit(" ")))


def customer_drivers(profiles: DataFrame, summary: DataFrame, top: int) -> DataFrame:
    """The top global drivers with each customer's own value; ``summary`` has one row per feature.

    The driver names are few (at most ``top``, read while the plan is built), so only their columns are read.
    """
    keys = [c for c in ("customer_id", "observation_date") if c in profiles.columns]
    drivers = summary.filter(F.col("rank") <= top).select(
        "rank", "feature", "impact_direction", even_round("normalized_importance_pct", 1).alias("importance_pct")
    )
    names = {r.feature for r in drivers.select("feature").collect()}  # at most ``top``
    own = F.lit(None).cast("string")
    for c in profiles.columns:
        if c in names and c not in keys:
            own = F.when(F.col("_d.feature") == c, F.col(c).cast("string")).otherwise(own)
    listed = drivers.agg(F.array_sort(F.collect_list(F.struct(*drivers.columns)))).scalar()
    rows = profiles.select(*keys, *[c for c in profiles.columns if c in names and c not in keys], F.explode(listed).alias("_d"))
    return rows.select(
        *keys, F.col("_d.rank").alias("rank"), F.col("_d.feature").alias("feature"),
        feature_label(F.col("_d.feature")).alias("label"), F.col("_d.impact_direction").alias("impact_direction"),
        F.col("_d.importance_pct").alias("importance_pct"), own.alias("customer_value"),
        own.isNotNull().alias("feature_available_for_customer"),
    )


def recommended_action(columns: list[str]) -> Column:
    """First field that is neither null nor empty."""
    candidates = [F.nullif(F.col(c), F.lit("")) for c in ("next_best_step", "advisor_message", "recommended_action_type") if c in columns]
    return F.coalesce(*candidates, F.lit(DEFAULT_ACTION_TEXT))
