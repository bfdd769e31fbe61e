"""Projections, filters, joins, aggregates, windows and row changes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from contractlens import config
from contractlens.driver import facts
from contractlens.driver.registry import query, table
from contractlens.functions.scalar import code_lookup, fold, money, month_of, rate
from contractlens.operators import changes, checks, constraints, overlay, shape, temporal
from contractlens.operators.constraints import Constraints, Reference
from contractlens.plans import base as base_plan
from contractlens.session import materialize
from contractlens.sources.calendar import calendar_between

MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


def orders(spark, sf):
    return table(spark, sf, "orders").withColumn("total", money("o_totalprice"))


# --- scans and projections ---------------------------------------------------

@query(
    "scan_project",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity > 10",
)
def scan_project(spark, sf):
    recent = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return table(spark, sf, "lineitem").filter(recent & (F.col("l_quantity") > 10)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "inline_values",
    f"""SELECT label, COUNT(*) AS orders, CAST(SUM({TOTAL} * weight) AS DOUBLE) AS weighted_total FROM orders
  JOIN (VALUES ('1-URGENT', 'critical', 4), ('2-HIGH', 'high', 3), ('3-MEDIUM', 'medium', 2), ('5-LOW', 'low', 1)) v(priority, label, weight)
    ON priority = o_orderpriority GROUP BY 1""",
)
def inline_values(spark, sf):
    rows = [("1-URGENT", "critical", 4), ("2-HIGH", "high", 3), ("3-MEDIUM", "medium", 2), ("5-LOW", "low", 1)]
    literal = spark.createDataFrame(rows, "o_orderpriority string, label string, weight int")
    joined = orders(spark, sf).join(F.broadcast(literal), "o_orderpriority")  # four literal rows
    return joined.groupBy("label").agg(
        F.count("*").alias("orders"), F.sum(F.col("total") * F.col("weight")).alias("weighted_total")
    )


@query(
    "materialize_mart",
    f"""SELECT {MONTH} AS reference_month, COUNT(DISTINCT o_custkey) AS contracts, CAST(SUM({TOTAL}) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def materialize_mart(spark, sf):
    months = orders(spark, sf).groupBy("o_custkey", month_of("o_orderdate").alias("reference_month")).agg(
        F.sum("total").alias("total")
    )
    stored = materialize(months, "order_months")
    return stored.groupBy("reference_month").agg(F.count("*").alias("contracts"), F.sum("total").alias("total"))


@query(
    "project_rename",
    f"WITH{facts.CONTRACT_CTE} SELECT contract_key AS chave_contrato, contract_code AS codigo_contrato, client_name AS cliente, business_segment AS segmento, service_name AS servico, manager_name AS gestor, complexity_level AS complexidade, renewal_date AS data_renovacao, CAST(target_margin_pct AS DOUBLE) AS meta_margem_pct FROM contract",
)
def project_rename(spark, sf):
    from contractlens.plans.bi import vw_contratos

    return vw_contratos(facts.contracts(spark, sf))


@query(
    "case_band",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(CASE WHEN l_discount >= 0.08 THEN 100 WHEN l_discount >= 0.05 THEN 75 WHEN l_discount >= 0.02 THEN 40 ELSE 0 END AS BIGINT) AS points FROM lineitem",
)
def case_band(spark, sf):
    from contractlens.plans.risk import band_score

    band = config.Band("rate", (("extra_cost_critical", 100), ("extra_cost_high", 75), ("extra_cost_warn", 40)))
    lines = table(spark, sf, "lineitem").withColumn("rate", F.col("l_discount").cast("decimal(18,4)"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", band_score(band, config.parameter_values()).alias("points"))


@query(
    "code_map",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'O' THEN 'REQUESTED' END AS process_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' END AS severity FROM orders""",
)
def code_map(spark, sf):
    status = {"P": " pendente ", "O": "Solicitado", "F": "desconhecido"}
    priority = {"1-URGENT": "Crítica", "2-HIGH": "ALTA", "3-MEDIUM": "média", "5-LOW": "Baixa"}
    word = lambda c, m: F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col(c))
    return orders(spark, sf).select(
        "o_orderkey",
        code_lookup(word("o_orderstatus", status), config.CODE_MAPS["process_status"]).alias("process_status"),
        code_lookup(word("o_orderpriority", priority), config.CODE_MAPS["severity"]).alias("severity"),
    )


@query(
    "computed_cols",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(price AS DOUBLE) AS gross_revenue, CAST(price - CAST(price * disc AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) AS payment_days, CAST(CASE WHEN q > 25 THEN q - 25 ELSE 0 END AS DOUBLE) AS uncovered_positions
FROM (SELECT l.*, o_orderdate, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_quantity AS DECIMAL(10,2)) AS q FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)""",
)
def computed_cols(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = money(price * F.col("l_discount").cast("decimal(4,2)"))
    lines = table(spark, sf, "lineitem").join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        price.alias("gross_revenue"), (price - discount).alias("net_revenue"),
        F.datediff("l_shipdate", "o_orderdate").alias("payment_days"),
        F.greatest(F.col("l_quantity").cast("decimal(10,2)") - 25, F.lit(0)).alias("uncovered_positions"),
    )


@query(
    "derived_chain",
    f"""WITH a AS (SELECT o_orderkey, o_custkey, {TOTAL} AS gross, CAST({TOTAL} * 0.045 AS DECIMAL(18,2)) AS discount,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST({TOTAL} * 0.01 AS DECIMAL(18,2)) ELSE 0 END AS sla_loss, last_day(o_orderdate) AS invoice_date FROM orders),
  b AS (SELECT *, CAST(sla_loss * 0.4 AS DECIMAL(18,2)) AS deduction FROM a)
SELECT o_orderkey, CAST(gross AS DOUBLE) AS gross_revenue, CAST(discount AS DOUBLE) AS commercial_discount, CAST(deduction AS DOUBLE) AS deduction_amount,
  CAST(sla_loss - deduction AS DOUBLE) AS penalty_amount, CAST(gross - discount - sla_loss AS DOUBLE) AS net_revenue, invoice_date,
  invoice_date + CAST(24 + o_custkey % 18 AS INTEGER) AS payment_date, CAST(24 + o_custkey % 18 AS BIGINT) AS payment_days FROM b""",
)
def derived_chain(spark, sf):
    from contractlens.plans.history import revenue_amounts

    plan = orders(spark, sf).select(
        "o_orderkey",
        F.col("total").alias("contracted_amount"),
        money(F.lit(0)).alias("additional_services"),
        money(F.lit(0)).alias("reimbursements"),
        F.lit(Decimal("0.0450")).alias("commercial_discount_rate"),
        F.when(F.col("o_orderpriority") == "1-URGENT", money(F.col("total") * F.lit(Decimal("0.01")))).otherwise(money(F.lit(0))).alias("sla_financial_loss"),
        F.trunc("o_orderdate", "MM").alias("reference_month"),
        F.col("o_custkey").alias("contract_number"),
    )
    return revenue_amounts(plan).select(
        "o_orderkey", "gross_revenue", F.col("commercial_discounts").alias("commercial_discount"),
        F.col("deductions").alias("deduction_amount"), F.col("penalties").alias("penalty_amount"), "net_revenue",
        "invoice_date", "payment_date", "payment_days",
    )


# --- filters -----------------------------------------------------------------

@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 AND o_orderstatus IN ('P', 'F')
  AND o_orderpriority NOT IN ('3-MEDIUM') AND (o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate >= TIMESTAMP '2000-01-01') AND o_custkey IS NOT NULL""",
)
def filter_predicates(spark, sf):
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    return table(spark, sf, "orders").filter(
        F.col("o_totalprice").between(100000, 200000)
        & F.col("o_orderstatus").isin("P", "F")
        & ~F.col("o_orderpriority").isin("3-MEDIUM")
        & ((F.col("o_orderdate") < day("1996-01-01")) | (F.col("o_orderdate") >= day("2000-01-01")))
        & F.col("o_custkey").isNotNull()
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "like_class",
    """SELECT p_partkey, p_name, CASE WHEN upper(p_name) LIKE '%SMALL%' THEN 'CRITICAL' WHEN upper(p_name) LIKE '%RED%' OR upper(p_name) LIKE '%BLUE%' THEN 'HIGH'
  WHEN upper(p_name) LIKE '%RING%' THEN 'ATTENTION' ELSE 'INFORMATION' END AS severity FROM part""",
)
def like_class(spark, sf):
    from contractlens.plans.timeline import word_severity

    words = (("CRITICAL", ("SMALL",)), ("HIGH", ("RED", "BLUE")), ("ATTENTION", ("RING",)))
    return table(spark, sf, "part").select("p_partkey", "p_name", word_severity(F.upper("p_name"), words).alias("severity"))


@query(
    "latest_period",
    f"SELECT o_orderkey, o_custkey, {MONTH} AS reference_month FROM orders WHERE {MONTH} = (SELECT MAX({MONTH}) FROM orders)",
)
def latest_period(spark, sf):
    months = table(spark, sf, "orders").select("o_orderkey", "o_custkey", month_of("o_orderdate").alias("reference_month"))
    return temporal.latest_period(months, "reference_month")


# --- joins -------------------------------------------------------------------

@query(
    "star_join",
    f"""SELECT r_name, c_mktsegment, {MONTH} AS reference_month, COUNT(*) AS lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
)
def star_join(spark, sf):
    customer, nation, region = (table(spark, sf, n) for n in ("customer", "nation", "region"))
    client = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select("c_custkey", "c_mktsegment", "r_name")
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(client, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name", "c_mktsegment", month_of("o_orderdate").alias("reference_month"))
        .agg(F.count("*").alias("lines"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("gross_revenue"))
    )


@query(
    "multi_fact_left",
    f"""WITH revenue AS (SELECT o_custkey AS contract_key, {MONTH} AS reference_month, SUM({TOTAL}) AS net_revenue FROM orders GROUP BY 1, 2),
  cost AS (SELECT o_custkey AS contract_key, CAST(date_trunc('month', l_shipdate) AS DATE) AS reference_month, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total_cost FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT contract_key, reference_month, CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(COALESCE(total_cost, 0) AS DOUBLE) AS total_cost FROM revenue LEFT JOIN cost USING (contract_key, reference_month)""",
)
def multi_fact_left(spark, sf):
    """Months with cost but no revenue vanish; one aggregation serves both facts."""
    revenue = orders(spark, sf).select(
        F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month"),
        F.lit(1).alias("revenue_rows"), F.col("total").alias("net_revenue"),
    )
    cost = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("o_custkey").alias("contract_key"), month_of("l_shipdate").alias("reference_month"),
        money("l_extendedprice").alias("total_cost"),
    )
    entries = base_plan.as_entries(revenue).unionByName(base_plan.as_entries(cost), allowMissingColumns=True)
    months = base_plan.roll_up(entries).filter("revenue_rows > 0")
    return months.select(
        "contract_key", "reference_month", "net_revenue", F.coalesce("total_cost", F.lit(0)).alias("total_cost")
    )


@query(
    "dependent_lookup",
    """SELECT c_nationkey, COUNT(*) AS lines, COUNT(s_suppkey) AS lines_with_own_supplier FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey GROUP BY 1""",
)
def dependent_lookup(spark, sf):
    """The supplier is found only if it belongs to the customer's nation."""
    supplier = table(spark, sf, "supplier")
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    both = (F.col("s_suppkey") == F.col("l_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey"))
    return lines.join(supplier, both, "left").groupBy("c_nationkey").agg(
        F.count("*").alias("lines"), F.count("s_suppkey").alias("lines_with_own_supplier")
    )


@query(
    "ci_ai_join",
    """SELECT p_partkey, p_type AS type_name, first_part FROM part JOIN (SELECT p_type, MIN(p_partkey) AS first_part FROM part GROUP BY 1) USING (p_type)""",
)
def ci_ai_join(spark, sf):
    """Types typed with accents and mixed case still find their catalogue entry."""
    part = table(spark, sf, "part")
    catalogue = part.groupBy("p_type").agg(F.min("p_partkey").alias("first_part")).withColumn("k", fold("p_type"))
    typed = part.select(
        "p_partkey",
        F.concat(F.lit(" "), F.translate(F.initcap("p_type"), "aeioucAEIOUC", "áêíõúçÁÊÍÕÚÇ"), F.lit(" ")).alias("typed"),
    )
    return typed.withColumn("k", fold("typed")).join(catalogue, "k").select(
        "p_partkey", F.col("p_type").alias("type_name"), "first_part"
    )


VERSION_SQL = """
version AS (
  SELECT o_custkey AS contract_key, CAST(o_orderdate AS DATE) AS valid_from, MAX(o_orderkey) AS version_key,
    LEAD(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) - 1 AS valid_to
  FROM orders GROUP BY 1, 2)"""


def order_versions(spark, sf):
    """Each customer's orders as versions: valid until the day before the next order."""
    w = Window.partitionBy("contract_key").orderBy("valid_from")
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("contract_key"), F.col("o_orderdate").cast("date").alias("valid_from"))
        .agg(F.max("o_orderkey").alias("version_key"))
        .withColumn("valid_to", F.date_sub(F.lead("valid_from").over(w), 1))
    )


@query(
    "effective_dated_join",
    f"""WITH{VERSION_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, version_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN version v ON v.contract_key = o_custkey AND CAST(l_shipdate AS DATE) BETWEEN v.valid_from AND COALESCE(v.valid_to, DATE '9999-12-31')""",
)
def effective_dated_join(spark, sf):
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("contract_key"), F.col("l_shipdate").cast("date").alias("day"))
    )
    joined = temporal.effective_dated_join(lines, order_versions(spark, sf), ["contract_key"], "day", columns=["version_key"])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "version_key")


@query(
    "cross_params",
    f"""SELECT o_orderkey, round(CAST({TOTAL} AS DOUBLE) / CAST(largest AS DOUBLE) * 10000) / 10000.0 AS share_of_largest, {TOTAL} >= largest * 0.8 AS above_limit_flag
FROM orders CROSS JOIN (SELECT MAX({TOTAL}) AS largest FROM orders)""".replace(f"{TOTAL} >= largest * 0.8 AS above_limit_flag", f"CAST({TOTAL} >= largest * 0.8 AS BIGINT) AS above_limit"),
)
def cross_params(spark, sf):
    """A one-row configuration taken from the data, applied to every row."""
    all_orders = orders(spark, sf)
    largest = all_orders.agg(F.max("total")).scalar()
    return all_orders.select(
        "o_orderkey", rate("total", largest).alias("share_of_largest"),
        (F.col("total") >= largest * F.lit(Decimal("0.8"))).alias("above_limit"),
    )


@query(
    "grid_cross",
    f"""WITH bounds AS (SELECT MIN({MONTH}) AS first_month FROM orders)
SELECT c_custkey AS contract_key, CAST(m AS DATE) AS reference_month,
  CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * CASE date_diff('year', first_month, CAST(m AS DATE)) WHEN 0 THEN 0.96 WHEN 1 THEN 1.00 ELSE 1.045 END AS DECIMAL(18,2)) AS DOUBLE) AS contracted_amount,
  CASE WHEN month(m) IN (1, 12) THEN 1.04 ELSE 1.0 END AS material_factor
FROM customer, bounds, LATERAL (SELECT unnest(generate_series(first_month, first_month + INTERVAL 23 MONTH, INTERVAL 1 MONTH)) AS m)""",
)
def grid_cross(spark, sf):
    from contractlens.plans.history import month_grid

    contracts = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("contract_key"), F.col("c_acctbal").cast("decimal(18,2)").alias("base_monthly_amount")
    )
    first = table(spark, sf, "orders").agg(F.min(month_of("o_orderdate"))).scalar()
    return month_grid(contracts, first, 24).select("contract_key", "reference_month", "contracted_amount", "material_factor")


@query(
    "expand_by_count",
    """WITH plan AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month, CAST(o_orderkey % 4 AS INTEGER) AS incident_count, CAST(o_orderkey % 2 AS INTEGER) AS sla_miss_count FROM orders)
SELECT o_orderkey, CAST(k AS BIGINT) AS incident_sequence, strftime(reference_month + to_days(CAST(2 + 6 * k AS INTEGER)) + to_minutes(30 * k), '%Y-%m-%d %H:%M:%S') AS opened_at,
  CAST(CASE WHEN k <= sla_miss_count THEN 18 + 4 * k ELSE 4 + k END AS BIGINT) AS resolution_hours, CAST(k > sla_miss_count AS BIGINT) AS resolved_within_sla
FROM plan, LATERAL (SELECT unnest(generate_series(1, incident_count)) AS k) WHERE incident_count > 0""",
)
def expand_by_count(spark, sf):
    from contractlens.plans.history import expand_incidents

    plan = table(spark, sf, "orders").select(
        "o_orderkey", month_of("o_orderdate").alias("reference_month"),
        (F.col("o_orderkey") % 4).cast("int").alias("incident_count"),
        (F.col("o_orderkey") % 2).cast("int").alias("sla_miss_count"),
    )
    return expand_incidents(plan).select(
        "o_orderkey", "incident_sequence", "opened_at", "resolution_hours", "resolved_within_sla"
    )


@query(
    "semi_exists",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')",
)
def semi_exists(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return table(spark, sf, "customer").join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "anti_not_exists",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')",
)
def anti_not_exists(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return table(spark, sf, "customer").join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


def order_calendar(spark, sf):
    """Calendar over the days the orders span."""
    bounds = table(spark, sf, "orders").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first"), F.max(F.col("o_orderdate").cast("date")).alias("last")
    )
    return calendar_between(bounds, "first", "last")


CALENDAR_SQL = """
calendar AS (SELECT CAST(d AS DATE) AS full_date FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
  LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d))"""


@query(
    "role_dates",
    f"""WITH{facts.ADJUSTMENT_CTE},{CALENDAR_SQL}
SELECT adjustment_number, strftime(e.full_date, '%Y-%m') AS expected_month, strftime(r.full_date, '%Y-%m') AS requested_month, strftime(p.full_date, '%Y-%m') AS approved_month
FROM adjustment a JOIN calendar e ON e.full_date = a.expected_date LEFT JOIN calendar r ON r.full_date = a.requested_date LEFT JOIN calendar p ON p.full_date = a.approved_date""",
)
def role_dates(spark, sf):
    from contractlens.plans.loading import join_role_dates

    roles = {"expected": ("expected_date", "inner"), "requested": ("requested_date", "left"), "approved": ("approved_date", "left")}
    joined = join_role_dates(facts.adjustments(spark, sf), order_calendar(spark, sf), roles, "year_month", "month")
    return joined.select("adjustment_number", "expected_month", "requested_month", "approved_month")


# --- aggregates --------------------------------------------------------------

@query(
    "agg_month",
    f"SELECT o_custkey AS contract_key, {MONTH} AS reference_month, COUNT(*) AS measurements, CAST(SUM({TOTAL}) AS DOUBLE) AS gross_revenue FROM orders GROUP BY 1, 2",
)
def agg_month(spark, sf):
    return orders(spark, sf).groupBy(F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month")).agg(
        F.count("*").alias("measurements"), F.sum("total").alias("gross_revenue")
    )


@query(
    "agg_conditional",
    """SELECT l_suppkey, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS returned_amount,
  COUNT(*) FILTER (WHERE l_linestatus = 'O') AS open_lines, COUNT(*) AS lines FROM lineitem GROUP BY 1""",
)
def agg_conditional(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(F.lit(0))).alias("returned_amount"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.count("*").alias("lines"),
    )


@query(
    "agg_avg",
    """SELECT l_suppkey, floor(CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / COUNT(*) * 10000 + 0.5) / 10000.0 AS average_quantity,
  floor(CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS DOUBLE) / COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) * 10000 + 0.5) / 10000.0 AS average_returned FROM lineitem GROUP BY 1""",
)
def agg_avg(spark, sf):
    """Unweighted mean over entries; NULL entries are skipped, zeros count."""
    quantity = F.col("l_quantity").cast("decimal(10,2)")
    mean = lambda c: rate(F.sum(c), F.count(c).cast("decimal(18,0)"))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        mean(quantity).alias("average_quantity"),
        mean(F.when(F.col("l_returnflag") == "R", quantity)).alias("average_returned"),
    )


@query(
    "agg_incidents",
    """SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS reference_month, COUNT(*) AS incident_count, COUNT(*) FILTER (WHERE value >= 100) AS critical_incident_count,
  CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS penalty_amount FROM events WHERE event_type = 'error' GROUP BY 1, 2""",
)
def agg_incidents(spark, sf):
    return table(spark, sf, "events").filter("event_type = 'error'").groupBy("user_id", month_of("ts").alias("reference_month")).agg(
        F.count("*").alias("incident_count"), F.count_if(F.col("value") >= 100).alias("critical_incident_count"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("penalty_amount"),
    )


@query(
    "agg_open_items",
    f"""WITH{facts.ADJUSTMENT_CTE} SELECT contract_key, COUNT(*) FILTER (WHERE process_status IN ('PENDING', 'REQUESTED')) AS open_adjustment_count,
  MAX(expected_date) FILTER (WHERE process_status IN ('PENDING', 'REQUESTED')) AS latest_open_adjustment_expected_date,
  CAST(SUM(CASE WHEN process_status = 'APPROVED' THEN retroactive_amount ELSE 0 END) AS DOUBLE) AS approved_retroactive_amount FROM adjustment GROUP BY 1""",
)
def agg_open_items(spark, sf):
    return base_plan.adjustment_summary(facts.adjustments(spark, sf))


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@query(
    "pivot_params",
    f"SELECT {', '.join(f'''MAX(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END) AS largest_{n}''' for p, n in PRIORITIES.items())} FROM orders",
)
def pivot_params(spark, sf):
    """Key/value rows to one wide row: the largest order of every priority."""
    wide = shape.pivot_max(table(spark, sf, "orders"), [], "o_orderpriority", "o_totalprice", list(PRIORITIES))
    return wide.select(*[F.col(f"`{p}`").alias(f"largest_{n}") for p, n in PRIORITIES.items()])


@query(
    "count_distinct",
    "SELECT l_returnflag, COUNT(*) AS lines, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS order_lines FROM lineitem GROUP BY 1",
)
def count_distinct(spark, sf):
    pair = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("lines"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct(pair).alias("order_lines")
    )


@query(
    "having_dupes",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def having_dupes(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).filter("copies > 1")


@query(
    "global_agg",
    f"SELECT CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day, COUNT(*) AS orders, CAST(SUM({TOTAL}) AS DOUBLE) AS total FROM orders",
)
def global_agg(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return orders(spark, sf).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("orders"), F.sum("total").alias("total"))


@query(
    "ratio_of_sums",
    f"""SELECT reference_month, {facts.ratio_sql('discounted', 'gross')} AS discount_share FROM (
  SELECT {MONTH} AS reference_month, SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))) AS discounted,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)""",
)
def ratio_of_sums(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(month_of("o_orderdate").alias("reference_month")).agg(
        rate(F.sum(money(price * F.col("l_discount").cast("decimal(4,2)"))), F.sum(price)).alias("discount_share")
    )


@query(
    "latest_per_group",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders JOIN (SELECT o_custkey AS k, MAX(o_orderkey) AS latest FROM orders GROUP BY 1) ON k = o_custkey AND latest = o_orderkey""",
)
def latest_per_group(spark, sf):
    """Newest batch of every source: the maximum carries its row along."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.max_by("o_orderstatus", "o_orderkey").alias("o_orderstatus")
    )


# --- windows -----------------------------------------------------------------

@query(
    "win_dup_count",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS duplicate_count FROM lineitem",
)
def win_dup_count(spark, sf):
    keys = [F.upper(F.trim(F.col(c).cast("string"))) for c in ("l_orderkey", "l_linenumber")]
    counted = shape.duplicate_count(table(spark, sf, "lineitem"), keys)
    return counted.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "duplicate_count")


def month_totals(spark, sf):
    return agg_month(spark, sf).select("contract_key", "reference_month", F.col("gross_revenue").cast("decimal(18,2)").alias("revenue"))


MONTH_TOTAL_SQL = f"month_total AS (SELECT o_custkey AS contract_key, {MONTH} AS reference_month, SUM({TOTAL}) AS revenue FROM orders GROUP BY 1, 2)"


@query(
    "win_running_count",
    f"WITH {MONTH_TOTAL_SQL} SELECT contract_key, reference_month, COUNT(*) OVER (PARTITION BY contract_key ORDER BY reference_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS months_in_history FROM month_total",
)
def win_running_count(spark, sf):
    w = Window.partitionBy("contract_key").orderBy("reference_month").rowsBetween(Window.unboundedPreceding, 0)
    return month_totals(spark, sf).select("contract_key", "reference_month", F.count("*").over(w).alias("months_in_history"))


@query(
    "win_lag2",
    f"WITH {MONTH_TOTAL_SQL} SELECT contract_key, reference_month, CAST(revenue - LAG(revenue, 2) OVER (PARTITION BY contract_key ORDER BY reference_month) AS DOUBLE) AS change_2_rows FROM month_total",
)
def win_lag2(spark, sf):
    w = Window.partitionBy("contract_key").orderBy("reference_month")
    return month_totals(spark, sf).select(
        "contract_key", "reference_month", (F.col("revenue") - F.lag("revenue", 2).over(w)).alias("change_2_rows")
    )


@query(
    "win_change",
    f"""SELECT contract_key, reference_month, status FROM (SELECT contract_key, reference_month, status, LAG(status) OVER (PARTITION BY contract_key ORDER BY reference_month) AS prev
  FROM (SELECT o_custkey AS contract_key, {MONTH} AS reference_month, MAX(o_orderstatus) AS status FROM orders GROUP BY 1, 2)) WHERE prev IS NULL OR prev <> status""",
)
def win_change(spark, sf):
    months = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month")
    ).agg(F.max("o_orderstatus").alias("status"))
    return shape.change_rows(months, ["contract_key"], "reference_month", "status")


@query(
    "win_rank_partition",
    f"""WITH {MONTH_TOTAL_SQL} SELECT contract_key, reference_month, ROW_NUMBER() OVER (PARTITION BY contract_key ORDER BY revenue DESC, reference_month) AS place FROM month_total""",
)
def win_rank_partition(spark, sf):
    w = Window.partitionBy("contract_key").orderBy(F.desc("revenue"), "reference_month")
    return month_totals(spark, sf).select("contract_key", "reference_month", F.row_number().over(w).alias("place"))


@query(
    "win_rank_global",
    """SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer""",
)
def win_rank_global(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return shape.dense_number(customers, "place", [F.desc("c_acctbal"), F.asc("c_custkey")]).drop("c_acctbal")


@query(
    "win_max_norm",
    f"""WITH {MONTH_TOTAL_SQL} SELECT contract_key, reference_month, {facts.ratio_sql('revenue', 'largest')} AS share_of_largest FROM (SELECT *, MAX(revenue) OVER (PARTITION BY reference_month) AS largest FROM month_total)""",
)
def win_max_norm(spark, sf):
    months = materialize(month_totals(spark, sf), "month_totals")
    largest = months.groupBy("reference_month").agg(F.max("revenue").alias("largest"))
    joined = months.join(F.broadcast(largest), "reference_month")  # one row per calendar month
    return joined.select("contract_key", "reference_month", rate("revenue", "largest").alias("share_of_largest"))


# --- sorts and sets ----------------------------------------------------------

@query(
    "sort_multi",
    "SELECT n_name, c_mktsegment, COUNT(*) AS customers, MAX(c_acctbal) AS best FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 ORDER BY n_name, customers DESC, c_mktsegment",
)
def sort_multi(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("customers"), F.max("c_acctbal").alias("best")).orderBy(
        "n_name", F.desc("customers"), "c_mktsegment"
    )


@query("top_n", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40")
def top_n(spark, sf):
    """The forty largest orders (the limit is the report)."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(40)


@query("distinct_rows", f"SELECT DISTINCT o_orderstatus, o_orderpriority, {MONTH} AS reference_month FROM orders")
def distinct_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", month_of("o_orderdate").alias("reference_month")).distinct()


@query(
    "dim_date",
    f"""WITH{CALENDAR_SQL}, names AS (SELECT unnest(range(1, 13)) AS n, unnest({config.MONTH_NAMES_PT!r}) AS name)
SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date, CAST(day(full_date) AS BIGINT) AS day_number, CAST(month(full_date) AS BIGINT) AS month_number, name AS month_name_pt,
  CAST(quarter(full_date) AS BIGINT) AS quarter_number, CAST(year(full_date) AS BIGINT) AS year_number, strftime(full_date, '%Y-%m') AS year_month,
  CAST(date_trunc('month', full_date) AS DATE) AS month_start_date, last_day(full_date) AS month_end_date, CAST(isodow(full_date) >= 6 AS BIGINT) AS is_weekend, COUNT(o_orderkey) AS orders
FROM calendar JOIN names ON n = month(full_date) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = full_date GROUP BY ALL""",
)
def dim_date(spark, sf):
    """Calendar of the days the orders span, with the orders of each day."""
    per_day = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(F.count("*").alias("orders"))
    return order_calendar(spark, sf).join(per_day, "full_date", "left").fillna(0, subset=["orders"])


@query(
    "bi_calendar",
    f"""WITH{CALENDAR_SQL}, names AS (SELECT unnest(range(1, 13)) AS n, unnest({config.MONTH_NAMES_PT!r}) AS name)
SELECT full_date AS data, CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS chave_data, CAST(date_trunc('month', full_date) AS DATE) AS inicio_mes, CAST(month(full_date) AS BIGINT) AS numero_mes,
  name AS mes, CAST(quarter(full_date) AS BIGINT) AS trimestre, CAST(year(full_date) AS BIGINT) AS ano, strftime(full_date, '%Y-%m') AS ano_mes, CAST(isodow(full_date) < 6 AS BIGINT) AS dia_util
FROM calendar JOIN names ON n = month(full_date)""",
)
def bi_calendar(spark, sf):
    from contractlens.plans.bi import vw_calendario

    return vw_calendario(order_calendar(spark, sf))


# --- row changes -------------------------------------------------------------

SLICE_SQL = f"""
stored AS (SELECT o_custkey AS contract_key, {MONTH} AS reference_month, 1 AS batch_id, o_orderkey AS measurement, {TOTAL} AS amount FROM orders WHERE o_orderstatus <> 'P'),
delivered AS (SELECT o_custkey AS contract_key, {MONTH} AS reference_month, 2 AS batch_id, o_orderkey AS measurement, CAST({TOTAL} * 1.1 AS DECIMAL(18,2)) AS amount FROM orders WHERE o_orderstatus = 'P')"""


@query(
    "replace_slice",
    f"""WITH{SLICE_SQL} SELECT contract_key, reference_month, CAST(batch_id AS BIGINT) AS batch_id, measurement, CAST(amount AS DOUBLE) AS amount FROM (
  SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM delivered d WHERE d.contract_key = s.contract_key AND d.reference_month = s.reference_month) UNION ALL SELECT * FROM delivered)""",
)
def replace_slice(spark, sf):
    rows = lambda pending, batch, amount: orders(spark, sf).filter((F.col("o_orderstatus") == "P") == pending).select(
        F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month"),
        F.lit(batch).alias("batch_id"), F.col("o_orderkey").alias("measurement"), amount.alias("amount"),
    )
    stored = rows(F.lit(False), 1, F.col("total"))
    delivered = rows(F.lit(True), 2, money(F.col("total") * F.lit(Decimal("1.1"))))
    return changes.replace_slice(stored, delivered, ["contract_key", "reference_month"])


@query(
    "upsert_type1",
    """WITH source AS (SELECT o_custkey AS k, MAX(o_totalprice) AS acctbal, 'ACTIVE' AS segment FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000 GROUP BY 1
    UNION ALL SELECT s_suppkey + 10000000, s_acctbal, 'SUPPLIER' FROM supplier)
SELECT COALESCE(c_custkey, k) AS c_custkey, c_name, CASE WHEN k IS NOT NULL THEN acctbal ELSE c_acctbal END AS c_acctbal, CASE WHEN k IS NOT NULL THEN segment ELSE c_mktsegment END AS c_mktsegment
FROM customer FULL JOIN source ON k = c_custkey""",
)
def upsert_type1(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    revised = table(spark, sf, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal"), F.lit("ACTIVE").alias("c_mktsegment")
    )
    added = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment")
    )
    return changes.upsert_type1(target, revised.unionByName(added), "c_custkey")


@query(
    "insert_missing",
    """SELECT c_custkey AS code, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer) AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def insert_missing(spark, sf):
    named = lambda t, k, n: table(spark, sf, t).select(F.col(k).alias("code"), F.col(n).alias("name"))
    merged = changes.insert_missing(named("customer", "c_custkey", "c_name"), named("supplier", "s_suppkey", "s_name"), ["code"])
    return changes.insert_missing(merged, named("part", "p_partkey", "p_name"), ["code"])


@query(
    "overlay_rules",
    f"""WITH grid AS (SELECT DISTINCT o_custkey AS contract_key, {MONTH} AS reference_month, 0.99 AS coverage_rate, 10 AS replacement_days, 'ROUTINE' AS event_code FROM orders),
rule AS (SELECT o_custkey AS contract_key, o_orderkey AS rule_no, {MONTH} AS first_month, CAST({MONTH} + INTERVAL 3 MONTH AS DATE) AS last_month,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(0.9 + (o_orderkey % 9) * 0.01 AS DECIMAL(9,4)) END AS coverage_rate,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 10 + o_orderkey % 30 END AS replacement_days, o_orderpriority AS event_code
  FROM orders WHERE o_orderstatus = 'P'),
hit AS (SELECT g.contract_key AS k, g.reference_month AS m, arg_max(r.coverage_rate, CASE WHEN r.coverage_rate IS NOT NULL THEN rule_no END) AS cov,
    arg_max(r.replacement_days, CASE WHEN r.replacement_days IS NOT NULL THEN rule_no END) AS rep, arg_max(r.event_code, rule_no) AS ev
  FROM grid g JOIN rule r ON r.contract_key = g.contract_key AND g.reference_month BETWEEN first_month AND last_month GROUP BY 1, 2)
SELECT contract_key, reference_month, CAST(COALESCE(cov, coverage_rate) AS DOUBLE) AS coverage_rate, CAST(COALESCE(rep, replacement_days) AS BIGINT) AS replacement_days, COALESCE(ev, event_code) AS event_code
FROM grid LEFT JOIN hit ON k = contract_key AND m = reference_month""",
)
def overlay_rules(spark, sf):
    grid = table(spark, sf, "orders").select(F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month")).distinct().select(
        "*", F.lit(Decimal("0.9900")).cast("decimal(9,4)").alias("coverage_rate"), F.lit(10).cast("long").alias("replacement_days"), F.lit("ROUTINE").alias("event_code")
    )
    priority, key, month = F.col("o_orderpriority"), F.col("o_orderkey"), month_of("o_orderdate")
    rules = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("contract_key"), key.alias("rule_no"), month.alias("first_month"), F.add_months(month, 3).alias("last_month"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), ((F.col("o_orderkey") % 9 + 90).cast("decimal(4,0)") / 100).cast("decimal(9,4)")).alias("coverage_rate"),
        F.when(priority == "2-HIGH", key % 30 + 10).alias("replacement_days"), priority.alias("event_code"),
    )
    return overlay.overlay_rules(grid, rules, "contract_key", "reference_month", ["coverage_rate", "replacement_days", "event_code"])


# --- checks ------------------------------------------------------------------

@query(
    "check_report",
    """SELECT 'orders per line' AS check_name, 0.0 AS expected, CAST(COUNT(*) AS DOUBLE) AS actual, CAST(COUNT(*) = 0 AS BIGINT) AS passed FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'unique order', 0.0, CAST(COUNT(*) AS DOUBLE), CAST(COUNT(*) = 0 AS BIGINT) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'unique line', 0.0, CAST(COUNT(*) AS DOUBLE), CAST(COUNT(*) = 0 AS BIGINT) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
UNION ALL SELECT 'nations', 25.0, CAST(COUNT(*) AS DOUBLE), CAST(COUNT(*) = 25 AS BIGINT) FROM nation
UNION ALL SELECT 'order columns', 0.0, 0.0, 1""",
)
def check_report(spark, sf):
    all_orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    renamed = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    return checks.report(
        checks.no_orphans(renamed, all_orders.select("o_orderkey"), "orders per line", ["o_orderkey"]),
        checks.unique_grain(all_orders, "unique order", ["o_orderkey"]),
        checks.unique_grain(lines, "unique line", ["l_orderkey", "l_linenumber"]),
        checks.row_count(table(spark, sf, "nation"), "nations", 25),
        checks.columns_present(all_orders, "order columns", ["o_orderkey", "o_custkey", "o_orderdate"]),
    )


@query(
    "check_bounds",
    """SELECT unnest(['discount', 'tax', 'quantity', 'price']) AS check_name, 0.0 AS expected, unnest([CAST(a AS DOUBLE), b, c, d]) AS actual, unnest([CAST(a = 0 AS BIGINT), CAST(b = 0 AS BIGINT), CAST(c = 0 AS BIGINT), CAST(d = 0 AS BIGINT)]) AS passed
FROM (SELECT COUNT(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.05) AS a, COUNT(*) FILTER (WHERE NOT l_tax BETWEEN 0 AND 1) AS b, COUNT(*) FILTER (WHERE NOT l_quantity > 0) AS c, COUNT(*) FILTER (WHERE NOT l_extendedprice <= 100000) AS d FROM lineitem)""",
)
def check_bounds(spark, sf):
    return checks.many_rules(
        table(spark, sf, "lineitem"),
        {
            "discount": F.col("l_discount").between(0, 0.05), "tax": F.col("l_tax").between(0, 1),
            "quantity": F.col("l_quantity") > 0, "price": F.col("l_extendedprice") <= 100000,
        },
    )


@query(
    "expectations",
    """SELECT unnest(['status domain', 'positive total', 'closed order has a past date']) AS check_name, 0.0 AS expected, unnest([CAST(a AS DOUBLE), b, c]) AS actual, unnest([CAST(a = 0 AS BIGINT), CAST(b = 0 AS BIGINT), CAST(c = 0 AS BIGINT)]) AS passed
FROM (SELECT COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('P', 'O')) AS a, COUNT(*) FILTER (WHERE NOT o_totalprice > 0) AS b, COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-01-01') AS c FROM orders)""",
)
def expectations(spark, sf):
    closed_late = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return checks.many_rules(
        table(spark, sf, "orders"),
        {"status domain": F.col("o_orderstatus").isin("P", "O"), "positive total": F.col("o_totalprice") > 0, "closed order has a past date": ~closed_late},
    )


ORDER_RULES = {
    "region": Constraints(["r_regionkey"], {"name is set": "r_name <> ''"}, {"region key": ["r_regionkey"], "region name": ["r_name"]}),
    "nation": Constraints(["n_nationkey"], {}, {"nation key": ["n_nationkey"]}, {"region": Reference(["n_regionkey"], "region", ["r_regionkey"])}),
    "customer": Constraints(
        ["c_custkey"], {"balance is positive": "c_acctbal > 0"}, {"customer key": ["c_custkey"], "one customer per nation and segment": ["c_nationkey", "c_mktsegment"]},
        {"nation": Reference(["c_nationkey"], "nation", ["n_nationkey"])}, required=["c_name"],
    ),
    "supplier": Constraints(["s_suppkey"], {"balance is positive": "s_acctbal > 0"}, {"supplier key": ["s_suppkey"]}, {"nation": Reference(["s_nationkey"], "large_nation", ["n_nationkey"])}),
    "orders": Constraints(
        ["o_orderkey"], {"status is known": "o_orderstatus IN ('P', 'O')", "urgent orders are large": "o_orderpriority <> '1-URGENT' OR o_totalprice >= 100000"},
        {"order key": ["o_orderkey"], "one order per customer and day": ["o_custkey", "o_orderdate"]}, {"rich customer": Reference(["o_custkey"], "rich_customer", ["c_custkey"])},
    ),
    "lineitem": Constraints(
        ["l_orderkey", "l_linenumber"], {"discount is a share": "l_discount BETWEEN 0 AND 1", "large lines have a discount": "l_quantity < 40 OR l_discount > 0"},
        {"line key": ["l_orderkey", "l_linenumber"], "one line per part and supplier": ["l_partkey", "l_suppkey"]}, {"order": Reference(["l_orderkey"], "orders", ["o_orderkey"])},
    ),
}


def _sql_conditions() -> list[str]:
    """One SELECT of (table, constraint, kind, row) per constraint."""
    parents = {"rich_customer": "(SELECT * FROM customer WHERE c_acctbal > 5000)", "large_nation": "(SELECT * FROM nation WHERE n_nationkey < 20)"}
    out = []
    for name, rules in ORDER_RULES.items():
        row = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in rules.identity)
        head = lambda what, kind: f"SELECT '{name}' AS table_name, '{what}' AS constraint_name, '{kind}' AS kind, {row} AS row_id FROM {name} t"  # noqa: B023, E731
        out += [f"{head(n, 'check')} WHERE NOT ({rule})" for n, rule in rules.rules().items()]
        out += [f"{head(n, 'unique')} QUALIFY COUNT(*) OVER (PARTITION BY {', '.join(c)}) > 1" for n, c in rules.unique.items()]
        for n, ref in rules.references.items():
            pairs = " AND ".join(f"p.{b} = t.{a}" for a, b in zip(ref.columns, ref.parent_columns))
            out.append(f"{head(n, 'reference')} WHERE NOT EXISTS (SELECT 1 FROM {parents.get(ref.parent, ref.parent)} p WHERE {pairs})")
    return out


def _constrained(spark, sf):
    tables = {name: table(spark, sf, name) for name in ORDER_RULES}
    return tables | {"rich_customer": tables["customer"].filter("c_acctbal > 5000"), "large_nation": tables["nation"].filter("n_nationkey < 20")}


@query(
    "constraints",
    "WITH broken AS (" + " UNION ALL ".join(f"({c})" for c in _sql_conditions()) + """),
declared(table_name, constraint_name, kind) AS (VALUES """ + ", ".join(
        f"('{t}', '{n}', '{kind}')" for t, r in ORDER_RULES.items() for kind, names in (("check", r.rules()), ("unique", r.unique), ("reference", r.references)) for n in names
    ) + """)
SELECT d.*, COUNT(row_id) AS broken_rows, CAST(COUNT(row_id) = 0 AS BIGINT) AS passed FROM declared d LEFT JOIN broken USING (table_name, constraint_name, kind) GROUP BY ALL""",
)
def constraints_report(spark, sf):
    return constraints.report(_constrained(spark, sf), ORDER_RULES)


@query("constraint_rows", " UNION ALL ".join(f"({c})" for c in _sql_conditions()))
def constraint_rows(spark, sf):
    return constraints.broken_rows(_constrained(spark, sf), ORDER_RULES)


@query(
    "reconcile",
    f"""SELECT reference_month, CAST(a AS DOUBLE) AS left_total, CAST(b AS DOUBLE) AS right_total, CAST(abs(a - b) AS DOUBLE) AS difference, CAST(abs(a - b) <= 0.01 AS BIGINT) AS passed FROM (
  SELECT {MONTH} AS reference_month, SUM({TOTAL}) AS a, SUM(CASE WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P' THEN {TOTAL} ELSE 0 END) AS b FROM orders GROUP BY 1)""",
)
def reconcile(spark, sf):
    months = orders(spark, sf).withColumn("reference_month", month_of("o_orderdate"))
    partial = months.filter("o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'")
    return checks.reconcile(months, partial, ["reference_month"], "total")
