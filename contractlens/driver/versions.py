"""Scores under stored parameters, and expectations held against them."""

from __future__ import annotations

from pyspark.sql import functions as F

from contractlens import config
from contractlens.driver import facts
from contractlens.driver.facts import with_marts
from contractlens.driver.registry import query, table
from contractlens.functions.scalar import month_of
from contractlens.operators import expectations
from contractlens.plans import loss as loss_plan
from contractlens.plans import parameters
from contractlens.plans import performance as performance_plan
from contractlens.plans import risk as risk_plan
from contractlens.session import scratch_dir

# Stand-in first day, and deliveries: code, value, day.
FIRST_DAY = "1990-01-01"
DELIVERIES = [
    [("OVERTIME_HIGH", "0.08", "1996-03-01"), ("OVERTIME_CRITICAL", "0.16", "1996-03-01"), ("RECOVERY_OVERTIME_EXCESS", "0.40", "1996-03-15")],
    [
        ("WEIGHT_FINANCIAL", "0.25", "1997-01-01"), ("WEIGHT_PEOPLE", "0.20", "1997-01-01"), ("RISK_HIGH_MIN", "45", "1998-06-01"),
        ("RECOVERY_OVERTIME_EXCESS", "0.55", "1999-01-01"), ("OVERTIME_CRITICAL", "0.10", "1997-01-01"),
    ],
]


def version_rows() -> str:
    used = {code for delivery in DELIVERIES for code, *_ in delivery} | {"OVERTIME_WARN", "RISK_ATTENTION_MIN", "RISK_CRITICAL_MIN"}
    used |= {code for code, *_ in config.RISK_PARAMETERS if code.startswith("WEIGHT_")}
    first = [(code, value, FIRST_DAY) for code, value, *_ in config.RISK_PARAMETERS if code in used]
    first += [(parameters.RATE + code, rate, FIRST_DAY) for code, _, rate, *_ in config.LOSS_CAUSES]
    later = [version for delivery in DELIVERIES for version in delivery]
    return ", ".join(f"('{code}', CAST({value} AS DECIMAL(18,6)), CAST(date_trunc('month', DATE '{day}') AS DATE))" for code, value, day in [*first, *later])


DATED_SQL = f"""
version(code, value, valid_from) AS (VALUES {version_rows()}),
held AS (
  SELECT reference_month, code, arg_max(value, valid_from) AS value
  FROM (SELECT DISTINCT reference_month FROM risk) JOIN version ON valid_from <= reference_month GROUP BY ALL),
recovered AS (
  SELECT contract_key, l.reference_month, SUM(CAST(CAST(size * CAST(value AS DECIMAL(5,4)) AS DECIMAL(30,6)) AS DECIMAL(18,2))) AS amount
  FROM leak l JOIN held h ON h.reference_month = l.reference_month AND h.code = '{parameters.RATE}' || loss_code GROUP BY ALL),
wide AS (PIVOT held ON code IN ({", ".join(f"'{c}'" for c in ("OVERTIME_WARN", "OVERTIME_HIGH", "OVERTIME_CRITICAL", "WEIGHT_FINANCIAL", "WEIGHT_OPERATIONAL", "WEIGHT_QUALITY", "WEIGHT_CONTRACTUAL", "WEIGHT_PEOPLE", "RISK_ATTENTION_MIN", "RISK_HIGH_MIN", "RISK_CRITICAL_MIN"))}) USING MAX(value) GROUP BY reference_month),
rescored AS (
  SELECT r.*, w.* EXCLUDE (reference_month), CASE WHEN overtime_rate >= OVERTIME_CRITICAL THEN 100 WHEN overtime_rate >= OVERTIME_HIGH THEN 75 WHEN overtime_rate >= OVERTIME_WARN THEN 40 ELSE 0 END AS overtime_points
  FROM risk r JOIN wide w ON w.reference_month = r.reference_month),
repillared AS (SELECT *, CAST(overtime_points * 0.45 + score_coverage * 0.35 + score_scope_overrun * 0.20 AS DECIMAL(9,2)) AS operational FROM rescored),
total AS (
  SELECT *, CAST(CAST(financial_risk_score AS DECIMAL(9,2)) * WEIGHT_FINANCIAL + operational * WEIGHT_OPERATIONAL + CAST(quality_risk_score AS DECIMAL(9,2)) * WEIGHT_QUALITY
    + CAST(contractual_risk_score AS DECIMAL(9,2)) * WEIGHT_CONTRACTUAL + CAST(people_risk_score AS DECIMAL(9,2)) * WEIGHT_PEOPLE AS DECIMAL(9,2)) AS composite
  FROM repillared)"""


@query(
    "dated_parameters",
    with_marts(
        "risk",
        """
SELECT t.contract_key, t.reference_month, CAST(overtime_points AS BIGINT) AS score_overtime, CAST(operational AS DOUBLE) AS operational_risk_score,
  CAST(composite AS DOUBLE) AS contract_risk_score, CAST(COALESCE(amount, 0) AS DOUBLE) AS recoverable_amount,
  CASE WHEN composite >= RISK_CRITICAL_MIN THEN 'CRITICAL' WHEN composite >= RISK_HIGH_MIN THEN 'HIGH' WHEN composite >= RISK_ATTENTION_MIN THEN 'ATTENTION' ELSE 'LOW' END AS risk_class
FROM total t LEFT JOIN recovered v ON v.contract_key = t.contract_key AND v.reference_month = t.reference_month""",
        DATED_SQL,
    ),
)
def dated_parameters(spark, sf):
    """Every month scored with the limits, weights and rates that held in it, read back from the stored table."""
    root = scratch_dir(spark, "parameters")
    parameters.run_parameters(spark, root, first_day=FIRST_DAY)
    for delivery in DELIVERIES:
        rows = spark.createDataFrame(delivery, "parameter_code string, parameter_value string, day string")
        parameters.run_parameters(spark, root, rows.withColumn("valid_from", F.col("day").cast("date")))
    months = facts.stored_months(spark, sf)
    measured = performance_plan.monthly_performance(months, facts.adjustments(spark, sf))
    rows = parameters.attach(measured, parameters.read_parameters(spark, root), months)
    scored = risk_plan.risk_scores(loss_plan.with_loss_columns(rows, rates=parameters.rates()), parameters.params())
    return scored.select(
        "contract_key", "reference_month", "score_overtime", "operational_risk_score", "contract_risk_score", "recoverable_amount", "risk_class"
    )


# --- expectations ------------------------------------------------------------

@query(
    "golden_actions",
    with_marts(
        "action",
        """
SELECT m.contract_key, m.reference_month, expected, code AS actual, CAST(COALESCE(code = expected, false) AS BIGINT) AS passed
FROM asked m LEFT JOIN action a ON a.contract_key = m.contract_key AND a.reference_month = m.reference_month""",
        """
asked AS (
  SELECT o_custkey AS contract_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month,
    CASE MIN(o_orderkey) % 3 WHEN 0 THEN 'REVIEW_SCHEDULE' WHEN 1 THEN 'REINFORCE_COVERAGE' ELSE 'ASSESS_NON_RENEWAL' END AS expected
  FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY ALL)""",
    ),
)
def golden_actions(spark, sf):
    """An expected action per contract and month, held against the recommended one."""
    kind = F.min("o_orderkey") % 3
    code = F.when(kind == 0, "REVIEW_SCHEDULE").when(kind == 1, "REINFORCE_COVERAGE").otherwise("ASSESS_NON_RENEWAL")
    expected = (
        table(spark, sf, "orders").filter("o_orderpriority = '4-NOT SPECIFIED'")
        .groupBy(F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month"))
        .agg(code.alias("recommended_action_code"))
    )
    return expectations.differences(facts.recommended(spark, sf), expected, ["contract_key", "reference_month"], "recommended_action_code")


@query(
    "expected_directions",
    with_marts(
        "base",
        """
SELECT check_name, s.contract_key, relation, CASE relation WHEN 'rises' THEN COALESCE(a > b, false) WHEN 'falls' THEN COALESCE(a < b, false) ELSE COALESCE(a > 0 AND b > 0, false) END::BIGINT AS passed
FROM asked s LEFT JOIN means m USING (check_name)""",
        """
asked AS (
  SELECT 'action ' || o_orderkey AS check_name, o_custkey AS contract_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    CASE o_orderkey % 3 WHEN 0 THEN 'rises' WHEN 1 THEN 'falls' ELSE 'both_positive' END AS relation
  FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'),
means AS (
  SELECT check_name, SUM(v) FILTER (side = 0) * COUNT(v) FILTER (side = 1) AS b, SUM(v) FILTER (side = 1) * COUNT(v) FILTER (side = 0) AS a
  FROM (
    SELECT check_name, 0 AS side, CAST(net_revenue AS DECIMAL(24,6)) AS v FROM asked s JOIN base b ON b.contract_key = s.contract_key AND b.reference_month >= month - INTERVAL 12 MONTH AND b.reference_month < month
    UNION ALL SELECT check_name, 1, CAST(CASE WHEN relation = 'both_positive' THEN contribution_margin ELSE net_revenue END AS DECIMAL(24,6)) FROM asked s
      JOIN base b ON b.contract_key = s.contract_key AND b.reference_month >= month AND b.reference_month < month + INTERVAL 12 MONTH)
  GROUP BY 1)""",
    ),
)
def expected_directions(spark, sf):
    """How revenue and margin should move over the twelve months before and from each management action."""
    month, kind = month_of("o_orderdate"), F.col("o_orderkey") % 3
    expected = table(spark, sf, "orders").filter("o_orderpriority = '4-NOT SPECIFIED'").select(
        F.concat(F.lit("action "), F.col("o_orderkey").cast("string")).alias("check_name"), F.col("o_custkey").alias("contract_key"),
        F.when(kind == 0, "rises").when(kind == 1, "falls").otherwise("both_positive").alias("relation"),
        F.lit("net_revenue").alias("measure_before"), F.when(kind == 2, "contribution_margin").otherwise("net_revenue").alias("measure_after"),
        F.add_months(month, -12).alias("before_from"), F.add_months(month, -1).alias("before_to"),
        month.alias("after_from"), F.add_months(month, 11).alias("after_to"),
    )
    measures = {c: F.col(c) for c in ("net_revenue", "contribution_margin")}
    moved = expectations.directions(facts.base(spark, sf), expected, "contract_key", "reference_month", measures)
    return moved.select("check_name", "contract_key", "relation", "passed")
