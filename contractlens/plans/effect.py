"""Before/after effect of completed management actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import label
from contractlens.operators.temporal import month_offsets

# Months compared on each side of an action.
BEFORE, AFTER = range(-3, 0), range(1, 4)
INDICATORS = {"margin": "contribution_margin_pct", "overtime": "overtime_rate", "coverage": "coverage_rate", "sla": "sla"}


def action_effect(actions: DataFrame, performance: DataFrame) -> DataFrame:
    """Mean indicators before the start and after the completion of an action.

    Each action becomes six contract-months, so the comparison is one equality
    join with the performance mart instead of a range join per side.
    """
    done = actions.filter(
        (F.col("action_status") == "COMPLETED")
        & F.col("start_date").isNotNull()
        & F.col("completion_date").isNotNull()
    )
    anchors = {"before": (F.col("start_date"), BEFORE), "after": (F.col("completion_date"), AFTER)}
    slots = month_offsets(done, anchors, "side", "reference_month")
    # a month without incidents kept its agreement
    kept = F.when(F.col("incident_count") == 0, F.lit(1).cast("decimal(18,4)")).otherwise(F.col("sla_compliance_rate"))
    months = performance.select(
        "contract_key", "reference_month", *[c for c in INDICATORS.values() if c != "sla"], kept.alias("sla")
    )
    # the key decides the rest of an action's columns, so they ride along as first()
    carried = [c for c in actions.columns if c != "management_action_key"]
    on = lambda side, c: F.when(F.col("side") == side, F.col(c))
    effect = slots.join(months, ["contract_key", "reference_month"]).groupBy("management_action_key").agg(
        *[F.first(c).alias(c) for c in carried],
        *[F.count_if(F.col("side") == side).alias(f"months_{side}") for side in anchors],
        *[
            F.avg(on(side, source)).cast("decimal(18,4)").alias(f"{name}_{side}_pct")
            for name, source in INDICATORS.items()
            for side in anchors
        ],
        ((F.avg(on("after", "contribution_margin_pct")) - F.avg(on("before", "contribution_margin_pct"))) * 100)
        .cast("decimal(18,2)")
        .alias("margin_delta_pp"),
    )
    names = {code: name for code, name, *_ in config.ACTIONS}
    return effect.filter((F.col("months_before") > 0) & (F.col("months_after") > 0)).withColumn(
        "action_name_pt", label("action_code", names)
    )
