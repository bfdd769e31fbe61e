"""Risk scores, pillars, class, trend and ranked drivers.

Everything but history is computed inside the row; history needs one window
per contract, whose size is the contract's number of months.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens import config


def _limit(limit, params: dict) -> Column:
    return F.lit(params[limit] if limit in params else Decimal(str(limit)))


def band_score(band: config.Band, params: dict) -> Column:
    """Points of the first (worst) band the observed value falls into.

    For upward bands a NULL counts as zero; for downward ones it scores
    nothing.
    """
    value = F.col(band.column)
    if band.direction == ">=":
        value = F.coalesce(value, F.lit(0))
    compare = {
        ">=": lambda limit: value >= limit,
        "<": lambda limit: value < limit,
        "<=": lambda limit: value <= limit,
    }[band.direction]
    score = F
    for limit, points in band.limits:
        test = value > 0 if limit == "> 0" else compare(_limit(limit, params))
        score = score.when(test, F.lit(points))
    return score.otherwise(F.lit(band.floor))


def margin_gap_score(params: dict) -> Column:
    """Distance below target; losing money is always the worst band."""
    gap = F.col("margin_gap_pct")
    short = F.abs(gap)
    return (
        F.when(gap >= 0, 0)
        .when((F.col("contribution_margin_pct") < 0) | (short >= params["margin_gap_critical"]), 100)
        .when(short >= params["margin_gap_high"], 75)
        .when(short >= params["margin_gap_warn"], 40)
        .otherwise(15)
    )


def sla_score(params: dict) -> Column:
    kept = F.coalesce(F.col("sla_compliance_rate"), F.lit(0))
    return (
        F.when(F.col("incident_count") == 0, 0)
        .when(kept >= params["sla_target"], 0)
        .when(kept >= params["sla_high"], 40)
        .when(kept >= params["sla_critical"], 75)
        .otherwise(100)
    )


def sub_scores(params: dict) -> dict[str, Column]:
    scores = {name: band_score(band, params) for name, band in config.BANDS.items()}
    scores["margin_gap"] = margin_gap_score(params)
    scores["sla_compliance"] = sla_score(params)
    return {f"score_{name}": score for name, score in scores.items()}


def pillar_scores() -> dict[str, Column]:
    """Weighted pillars, each rounded to two decimals before the final weighting."""
    out = {}
    for pillar, parts in config.PILLARS.items():
        weighted = [F.col(f"score_{name}") * F.lit(Decimal(share)) for name, share in parts]
        out[f"{pillar}_risk_score"] = sum(weighted[1:], weighted[0]).cast("decimal(9,2)")
    return out


def composite_score(params: dict) -> Column:
    parts = [F.col(f"{pillar}_risk_score") * params[f"weight_{pillar}"] for pillar in config.PILLARS]
    return sum(parts[1:], parts[0]).cast("decimal(9,2)")


def risk_class(params: dict) -> Column:
    score = F.col("contract_risk_score")
    return (
        F.when(score >= params["risk_critical_min"], "CRITICAL")
        .when(score >= params["risk_high_min"], "HIGH")
        .when(score >= params["risk_attention_min"], "ATTENTION")
        .otherwise("LOW")
    )


def margin_trend() -> Column:
    fast, slow = Decimal(config.TREND_LIMITS["fast"]), Decimal(config.TREND_LIMITS["slow"])
    change = F.col("margin_change_3m")
    return (
        F.when(F.col("months_in_history") < 3, "INSUFFICIENT_HISTORY")
        .when(change <= -fast, "DETERIORATING_FAST")
        .when(change < -slow, "DETERIORATING")
        .when(change >= fast, "IMPROVING_FAST")
        .when(change > slow, "IMPROVING")
        .otherwise("STABLE")
    )


HISTORY = ["months_in_history", "margin_change_3m"]


def with_history(months: DataFrame) -> DataFrame:
    """Months seen so far and margin change over two rows (rows, not calendar)."""
    by_month = Window.partitionBy("contract_key").orderBy("reference_month")
    margin = F.col("contribution_margin_pct")
    return months.withColumns(
        {
            "months_in_history": F.count("*").over(by_month.rowsBetween(Window.unboundedPreceding, 0)),
            "margin_change_3m": margin - F.lag(margin, 2).over(by_month),
        }
    )


def latest_with_history(months: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Rows of the latest month with their history.

    Earlier months go through the window as key and margin alone: their other
    columns would be shuffled and sorted only to be dropped.  ``source`` may name
    a frame of all months that has no more than these, if ``months`` lacks earlier ones.
    """
    source = months if source is None else source
    slim = ["contract_key", "reference_month", "contribution_margin_pct"]
    newest = F.col("reference_month") == source.agg(F.max("reference_month")).scalar()
    now = months.filter(newest).select(*slim, F.struct(*[c for c in months.columns if c not in slim]).alias("_row"))
    earlier = source.filter(~F.coalesce(newest, F.lit(False))).select(*slim, F.lit(None).cast(now.schema["_row"].dataType).alias("_row"))
    kept = with_history(now.unionByName(earlier)).filter("_row is not null")
    return kept.select(*slim, "_row.*", *HISTORY)


def risk_scores(performance: DataFrame, params: dict | None = None) -> DataFrame:
    """Risk mart: performance rows with sub-scores, pillars, score, class, trend.

    Rows that bring their history (`latest_with_history`) keep it.
    """
    params = params or config.parameter_values()
    literals = {k: F.lit(v) for k, v in params.items()}
    known = set(HISTORY) <= set(performance.columns)
    return (
        (performance if known else with_history(performance))
        .withColumns(sub_scores(params))
        .withColumns(pillar_scores())
        .withColumn("contract_risk_score", composite_score(literals))
        .withColumns({"risk_class": risk_class(params), "margin_trend": margin_trend()})
    )


DRIVER_INPUTS = sorted(
    {observed for _, _, _, observed, *_ in config.DRIVERS}
    | {f"score_{score}" for *_, score, _ in config.DRIVERS}
    | {f"loss_{impact}" if impact.isupper() else impact for *_, impact in config.DRIVERS if impact}
)


def risk_drivers(risk: DataFrame, params: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Drivers with a score, ranked inside their contract-month.

    The fourteen candidates live in the row, so they are ranked by sorting a
    small array: no shuffle and no window.  ``risk`` carries the loss columns.
    """
    params = params or config.parameter_values()
    value = "decimal(18,4)"
    items = []
    for pillar, code, name, observed, reference, score, impact in config.DRIVERS:
        if reference is None:
            limit = F.lit(Decimal(0))
        else:
            sign = -1 if reference.startswith("-") else 1
            limit = F.lit(params[reference.lstrip("-")] * sign)
        if impact is None:
            amount = F.lit(Decimal(0))
        else:
            amount = F.col(f"loss_{impact}" if impact.isupper() else impact)
        points = F.col(f"score_{score}")
        items.append(
            F.struct(
                (-points).alias("by_score"),
                (-amount).cast("decimal(28,6)").alias("by_impact"),
                F.lit(code).alias("driver_code"),
                F.lit(pillar).alias("risk_pillar"),
                F.lit(name).alias("driver_name_pt"),
                F.col(observed).cast(value).alias("observed_value"),
                limit.cast("decimal(28,6)").alias("reference_value"),
                points.alias("driver_score"),
                amount.cast("decimal(28,6)").alias("estimated_impact_amount"),
            )
        )
    ranked = F.array_sort(F.filter(F.array(*items), lambda d: d["driver_score"] > 0))
    keys = ["reference_month", "date_key", "contract_key", "contract_code", *keep]
    return (
        risk.select(*keys, F.posexplode(ranked).alias("_pos", "_d"))
        .select(*keys, "_d.*", (F.col("_pos") + 1).alias("driver_rank"))
        .drop("by_score", "by_impact")
    )
