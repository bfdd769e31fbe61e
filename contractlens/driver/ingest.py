"""Typing, validation and loading over whole order tables.

Typed values are first written out as localized text, every few rows with
something that does not parse, and read back by the parsers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from contractlens import config
from contractlens.driver import facts
from contractlens.driver.registry import query, table
from contractlens.functions import parse, scalar
from contractlens.functions.scalar import money, month_of
from contractlens.operators import changes
from contractlens.operators.quarantine import split_valid, with_reasons
from contractlens.plans import history
from contractlens.plans.loading import batch_audit as audit_row
from contractlens.plans.staging import resolution_hours as hours_between

MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


def orders(spark, sf):
    return table(spark, sf, "orders").withColumn("total", money("o_totalprice"))


def every(n: int):
    return F.col("o_orderkey") % n == 0


def typed_text(spark, sf):
    """Orders as a raw text table, in the formats that occur in files."""
    local = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    day = F.col("o_orderdate")
    flags = F.when(F.col("o_orderstatus") == "P", "Sim").when(F.col("o_orderstatus") == "O", "NÃO").otherwise("?")
    return orders(spark, sf).select(
        "o_orderkey",
        F.when(every(7), "valor inválido").when(every(5), F.concat(F.lit(" R$ "), local)).otherwise(local).alias("amount"),
        F.when(every(11), "").otherwise(F.concat((F.col("o_orderkey") % 41 * 5).cast("string"), F.lit(",5%"))).alias("share"),
        F.when(every(13), "31/02/2024").when(every(3), F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd/MM/yyyy")).alias("day"),
        F.when(every(13), "mês inválido").when(every(3), F.date_format(day, "yyyy-MM"))
        .when(every(2), F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/yyyy")).alias("period"),
        F.when(every(13), "ontem").when(every(3), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T06:30:15")))
        .when(every(2), F.date_format(day, "dd/MM/yyyy")).otherwise(F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 06:30"))).alias("moment"),
        flags.alias("flag"),
        F.when(F.col("o_orderstatus") == "P", " débito").when(F.col("o_orderstatus") == "O", "Estorno").otherwise("x").alias("entry"),
        F.when(every(17), "   ").otherwise(F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))).alias("code"),
    )


TYPING = {
    "amount": "decimal(18,2)", "share": "percent", "day": "date", "period": "month", "moment": "timestamp",
    "flag": "flag", "entry": "entry_type", "code": "code",
}


def parsed(spark, sf, column: str, name: str):
    typed = parse.parse_localized(typed_text(spark, sf), {name: (TYPING[column], column)}, keep=["o_orderkey"])
    return typed


@query("parse_decimal_br", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM orders")
def parse_decimal_br(spark, sf):
    return parsed(spark, sf, "amount", "amount")


@query(
    "parse_percent_br",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CASE WHEN o_orderkey % 41 = 0 THEN 0.5 ELSE (o_orderkey % 41 * 50 + 5) * 0.001 END AS DOUBLE) END AS share FROM orders",
)
def parse_percent_br(spark, sf):
    return parsed(spark, sf, "share", "share")


@query("parse_date_br", "SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def parse_date_br(spark, sf):
    return parsed(spark, sf, "day", "day")


@query("parse_month_br", f"SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0 AND year(o_orderdate) < 2000 THEN NULL ELSE {MONTH} END END AS period FROM orders")
def parse_month_br(spark, sf):
    return parsed(spark, sf, "period", "period")


@query(
    "parse_datetime_br",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE strftime(o_orderdate + CASE WHEN o_orderkey % 3 = 0 THEN INTERVAL '06:30:15' HOUR_SECOND
  WHEN o_orderkey % 2 = 0 THEN INTERVAL 0 SECOND ELSE INTERVAL 390 MINUTE END, '%Y-%m-%d %H:%M:%S') END AS moment FROM orders""".replace("INTERVAL '06:30:15' HOUR_SECOND", "INTERVAL 23415 SECOND"),
)
def parse_datetime_br(spark, sf):
    return parsed(spark, sf, "moment", "moment")


@query("parse_bit_pt", "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN CAST(1 AS BIGINT) WHEN 'O' THEN 0 END AS flag FROM orders")
def parse_bit_pt(spark, sf):
    return parsed(spark, sf, "flag", "flag")


@query("entry_type", "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'DEBIT' WHEN 'O' THEN 'REVERSAL' END AS entry FROM orders")
def entry_type(spark, sf):
    return parsed(spark, sf, "entry", "entry")


@query("normalize_code", "SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN upper(o_orderpriority) END AS code FROM orders")
def normalize_code(spark, sf):
    return parsed(spark, sf, "code", "code")


@query(
    "string_fns",
    """SELECT p_partkey, left(p_name, 3) AS head, right(p_name, 3) AS tail, substring(p_name, 2, 4) AS middle, CAST(length(p_name) AS BIGINT) AS letters, reverse(p_name) AS backwards,
  CAST(instr(p_name, ' ') AS BIGINT) AS first_space, replace(p_name, ' ', '_') AS underscored, lower(p_brand) AS brand, p_brand || '-' || COALESCE(CASE WHEN p_size > 25 THEN p_type END, '') || '-' || right('0' || (p_size % 10), 2) AS label FROM part""",
)
def string_fns(spark, sf):
    name = F.col("p_name")
    label = scalar.join_text(
        F.col("p_brand"), F.lit("-"), F.when(F.col("p_size") > 25, F.col("p_type")), F.lit("-"),
        F.right(F.concat(F.lit("0"), (F.col("p_size") % 10).cast("string")), F.lit(2)),
    )
    return table(spark, sf, "part").select(
        "p_partkey", F.left(name, F.lit(3)).alias("head"), F.right(name, F.lit(3)).alias("tail"), F.substring(name, 2, 4).alias("middle"),
        F.length(name).alias("letters"), F.reverse(name).alias("backwards"), F.instr(name, " ").alias("first_space"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("underscored"), F.lower("p_brand").alias("brand"), label.alias("label"),
    )


REASON_SQL = """concat_ws('; ', CASE WHEN o_totalprice > 450000 THEN 'Valor inválido' END, CASE WHEN o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-01-01' THEN 'Data inválida' END,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Prioridade inválida' END)"""


def order_rules():
    late = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    return [
        (F.col("o_totalprice") > 450000, "Valor inválido"),
        ((F.col("o_orderstatus") == "F") & late, "Data inválida"),
        ((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), "Prioridade inválida"),
    ]


@query("concat_reasons", f"SELECT o_orderkey, {REASON_SQL} AS rejection_reason FROM orders")
def concat_reasons(spark, sf):
    return with_reasons(table(spark, sf, "orders"), order_rules()).select("o_orderkey", "rejection_reason")


@query(
    "quarantine",
    f"SELECT o_orderkey, CASE WHEN reason = '' THEN 'valid' ELSE 'rejected' END AS outcome, CASE WHEN reason <> '' THEN reason END AS rejection_reason FROM (SELECT o_orderkey, {REASON_SQL} AS reason FROM orders)",
)
def quarantine(spark, sf):
    valid, rejected = split_valid(table(spark, sf, "orders"), order_rules())
    return valid.select("o_orderkey", F.lit("valid").alias("outcome"), F.lit(None).cast("string").alias("rejection_reason")).unionByName(
        rejected.select("o_orderkey", F.lit("rejected").alias("outcome"), "rejection_reason")
    )


@query(
    "batch_audit",
    f"""SELECT CAST(7 AS BIGINT) AS batch_id, 'orders' AS source_name, COUNT(*) AS rows_received, COUNT(*) FILTER (WHERE reason = '') AS rows_loaded, COUNT(*) FILTER (WHERE reason <> '') AS rows_rejected,
  CASE WHEN COUNT(*) FILTER (WHERE reason <> '') > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM (SELECT {REASON_SQL} AS reason FROM orders)""",
)
def batch_audit(spark, sf):
    received = table(spark, sf, "orders")
    valid, rejected = split_valid(received, order_rules())
    return audit_row(7, "orders", received, valid, rejected)


@query(
    "row_hash",
    f"SELECT o_orderkey, sha256(concat_ws('|', o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, strftime(o_orderdate, '%Y-%m-%d'), CAST({TOTAL} AS VARCHAR))) AS row_hash FROM orders",
)
def row_hash(spark, sf):
    attributes = orders(spark, sf).select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"), "total",
    )
    return attributes.select("o_orderkey", F.lower(F.hex(scalar.row_hash(["o_orderstatus", "priority", "day", "total"]))).alias("row_hash"))


@query(
    "date_fns",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(day(o_orderdate) AS BIGINT) AS d, CAST(quarter(o_orderdate) AS BIGINT) AS q,
  make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start, last_day(o_orderdate) AS month_end, CAST(o_orderdate AS DATE) + 45 AS plus_45_days,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_3_months, strftime(o_orderdate + INTERVAL 90 MINUTE + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS later FROM orders""",
)
def date_fns(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d"), F.quarter(day).alias("q"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("month_start"), F.last_day(day).alias("month_end"),
        F.date_add(day, 45).alias("plus_45_days"), F.add_months(day, 3).alias("plus_3_months"),
        F.timestamp_add("HOUR", F.lit(5), F.timestamp_add("MINUTE", F.lit(90), F.col("o_orderdate"))).alias("later"),
    )


@query(
    "datediff_day",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(date_diff('day', o_orderdate, l_shipdate) AS BIGINT) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def datediff_day(spark, sf):
    return _line_dates(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", F.datediff("l_shipdate", "o_orderdate").alias("days"))


def _line_dates(spark, sf):
    return table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )


@query(
    "datediff_month",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(date_diff('month', o_orderdate, l_shipdate) AS BIGINT) AS months FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def datediff_month(spark, sf):
    months = scalar.calendar_months_between("o_orderdate", "l_shipdate")
    return _line_dates(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", months.alias("months"))


@query(
    "resolution_hours",
    """WITH e AS (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey * 421 % 86400) AS opened, o_orderdate + to_seconds(o_orderkey * 421 % 86400 + o_orderkey % 50000) AS closed FROM orders)
SELECT o_orderkey, CAST(CAST((date_diff('minute', opened, closed) * 1000 + 30) // 60 AS DECIMAL(18,0)) AS DOUBLE) / 1000 AS hours, CAST(date_diff('minute', opened, closed) <= 480 AS BIGINT) AS within_8_hours FROM e""",
)
def resolution_hours(spark, sf):
    seconds = F.col("o_orderkey") * 421 % 86400
    moment = lambda s: F.timestamp_add("SECOND", s, F.col("o_orderdate"))
    both = table(spark, sf, "orders").select(
        "o_orderkey", moment(seconds).alias("opened"), moment(seconds + F.col("o_orderkey") % 50000).alias("closed")
    )
    hours = hours_between("opened", "closed")
    return both.select("o_orderkey", hours.cast("decimal(18,3)").alias("hours"), (hours <= 8).alias("within_8_hours"))


@query(
    "date_key",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%d/%m/%Y') AS day_text FROM orders",
)
def date_key(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.date_key(day).alias("date_key"), F.date_format(day, "yyyy-MM").alias("year_month"), F.date_format(day, "dd/MM/yyyy").alias("day_text")
    )


@query(
    "null_fns",
    """SELECT p_partkey, COALESCE(NULLIF(p_type, 'ECONOMY'), p_brand) AS kind, NULLIF(p_size, 10) AS size_not_10, CAST(COALESCE(CASE WHEN p_size > 20 THEN p_size END, 0) AS BIGINT) AS large_size,
  CAST(p_retailprice AS DOUBLE) / NULLIF(CAST(p_size % 4 AS DOUBLE), 0) AS price_share FROM part""".replace("NULLIF(p_size, 10) AS", "CAST(NULLIF(p_size, 10) AS BIGINT) AS"),
)
def null_fns(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.coalesce(F.nullif(F.col("p_type"), F.lit("ECONOMY")), F.col("p_brand")).alias("kind"),
        F.nullif(size, F.lit(10)).alias("size_not_10"), F.coalesce(F.when(size > 20, size), F.lit(0)).alias("large_size"),
        F.try_divide(F.col("p_retailprice"), (size % 4).cast("double")).alias("price_share"),
    )


@query(
    "try_cast_fns",
    f"""SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CASE WHEN trunc(o_totalprice / 1000) <= 127 THEN CAST(trunc(o_totalprice / 1000) AS BIGINT) END AS tiny,
  CAST(CAST({TOTAL} AS DECIMAL(18,1)) AS DOUBLE) AS one_decimal, CAST(NULL AS BIGINT) AS not_a_number FROM orders""",
)
def try_cast_fns(spark, sf):
    """Decimals to whole numbers are cut, to fewer decimals are rounded; misfits are NULL."""
    return orders(spark, sf).select(
        "o_orderkey", F.col("total").try_cast("long").alias("whole"), (F.col("total") / 1000).try_cast("tinyint").alias("tiny"),
        F.col("total").try_cast("decimal(18,1)").alias("one_decimal"), F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@query(
    "math_fns",
    """SELECT c_custkey, abs(c_acctbal) AS size, CAST(ceil(c_acctbal) AS BIGINT) AS rounded_up, CAST(c_custkey % 18 AS BIGINT) AS remainder, CASE WHEN c_acctbal < 0 THEN 'debit' ELSE 'credit' END AS side,
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 1.045 - 100 AS DOUBLE) AS adjusted FROM customer""",
)
def math_fns(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.abs(balance).alias("size"), F.ceil(balance).alias("rounded_up"), (F.col("c_custkey") % 18).alias("remainder"),
        F.when(balance < 0, "debit").otherwise("credit").alias("side"),
        (balance.cast("decimal(12,2)") * F.lit(Decimal("1.045")) - 100).alias("adjusted"),
    )


@query(
    "positive_part",
    "SELECT o_orderkey, CASE WHEN v > 0 THEN v ELSE 0 END AS excess FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) - 200000 AS DOUBLE) END AS v FROM orders)",
)
def positive_part(spark, sf):
    gap = F.when(F.col("o_orderstatus") != "F", F.col("total") - 200000)
    return orders(spark, sf).select("o_orderkey", scalar.positive_part(gap).alias("excess"))


@query(
    "int_ratio",
    f"""SELECT o_custkey AS contract_key, {MONTH} AS reference_month, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') // COUNT(*) AS DOUBLE) AS whole_ratio,
  {facts.ratio_sql("COUNT(*) FILTER (WHERE o_orderstatus = 'F')", "COUNT(*)", scale=0)} AS exact_ratio FROM orders GROUP BY 1, 2""",
)
def int_ratio(spark, sf):
    months = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("contract_key"), month_of("o_orderdate").alias("reference_month")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("kept"), F.count("*").alias("n")
    )
    return months.select(
        "contract_key", "reference_month", scalar.whole_ratio("kept", "n").alias("whole_ratio"), scalar.whole_ratio("kept", "n", exact=True).alias("exact_ratio")
    )


SCD_SQL = """
dim AS (SELECT code, d AS valid_from, p AS priority, sha256(p) AS h, ROW_NUMBER() OVER (ORDER BY code) AS contract_key FROM (
  SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1),
staged AS (SELECT code, d AS valid_from, p AS priority, sha256(p) AS h FROM (
  SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'P') WHERE rn = 1),
pair AS (SELECT d.code AS code, d.contract_key, d.valid_from AS old_from, d.priority AS old_priority, s.valid_from AS new_from, s.priority AS new_priority, d.h <> s.h AS changed FROM dim d LEFT JOIN staged s ON s.code = d.code),
kept AS (SELECT code, contract_key, CASE WHEN changed AND new_from = old_from THEN new_priority ELSE old_priority END AS priority, old_from AS valid_from,
    CASE WHEN changed AND new_from > old_from THEN new_from - 1 END AS valid_to, NOT COALESCE(changed AND new_from > old_from, FALSE) AS is_current FROM pair),
opened AS (SELECT code, priority, valid_from FROM staged WHERE code NOT IN (SELECT code FROM dim)
  UNION ALL SELECT code, new_priority, new_from FROM pair WHERE changed AND new_from > old_from)"""


@query(
    "scd2_merge",
    f"""WITH{SCD_SQL}
SELECT code, CAST(contract_key AS BIGINT) AS contract_key, priority, valid_from, valid_to, CAST(is_current AS BIGINT) AS is_current FROM kept
UNION ALL SELECT code, (SELECT MAX(contract_key) FROM dim) + ROW_NUMBER() OVER (ORDER BY code), priority, valid_from, NULL, 1 FROM opened""",
)
def scd2_merge(spark, sf):
    """First closed order of a customer is stored; the newest pending one arrives."""
    day = F.col("o_orderdate").cast("date")
    base = table(spark, sf, "orders").withColumn("day", day)
    pick = lambda status, choose: (
        base.filter(F.col("o_orderstatus") == status)
        .groupBy(F.col("o_custkey").alias("code"))
        .agg(choose(F.struct("day", "o_orderkey", "o_orderpriority")).alias("v"))
        .select("code", F.col("v.o_orderpriority").alias("priority"), F.col("v.day").alias("valid_from"))
        .withColumn("row_hash", scalar.row_hash(["priority"]))
    )
    from contractlens.operators.shape import dense_number

    stored = dense_number(pick("F", F.min), "contract_key", [F.asc("code")]).select(
        "contract_key", "code", "priority", "valid_from", F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"), "row_hash",
    )
    merged = changes.scd2_merge(stored, pick("P", F.max), "code", "contract_key", ["priority"])
    return merged.drop("row_hash")


@query(
    "cost_from_template",
    f"""WITH bounds AS (SELECT MIN({MONTH}) AS first_month FROM orders),
template AS (SELECT o_custkey AS code, l_returnflag AS flag, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS baseline FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {MONTH} = (SELECT first_month FROM bounds) GROUP BY 1, 2),
plan AS (SELECT DISTINCT o_custkey AS code, {MONTH} AS reference_month FROM orders),
budget AS (SELECT code, reference_month, flag, CAST(baseline * CASE date_diff('year', first_month, reference_month) WHEN 0 THEN 0.9650 WHEN 1 THEN 1.0000 ELSE 1.0450 END * CASE WHEN flag <> 'N' THEN 1.1000 ELSE 1.0000 END AS DECIMAL(18,2)) AS budget_amount
  FROM plan JOIN template USING (code), bounds)
SELECT 'CT-' || code AS contract_code, reference_month, flag, CAST(budget_amount AS DOUBLE) AS budget_amount,
  CAST(CAST(budget_amount * 0.9500 * CASE flag WHEN 'R' THEN 1.8000 WHEN 'A' THEN 2.3000 ELSE 1.0500 END AS DECIMAL(18,2)) AS DOUBLE) AS actual_amount FROM budget""",
)
def cost_from_template(spark, sf):
    """Costs of every planned month from the first month's lines."""
    code = F.concat(F.lit("CT-"), F.col("o_custkey").cast("string")).alias("contract_code")
    lines = _line_dates(spark, sf).select(
        code, month_of("o_orderdate").alias("reference_month"), F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").cast("decimal(12,2)").alias("amount")
    )
    template = (
        history.earliest_month(lines).groupBy("contract_code", "flag").agg(F.sum("amount").cast("decimal(18,2)").alias("baseline_budget_amount"))
        .withColumns(
            {
                "cost_subcategory": F.when(F.col("flag") == "R", config.OVERTIME_SUBCATEGORY).when(F.col("flag") == "A", config.COVERAGE_SUBCATEGORY).otherwise(config.ONE_OFF_SUBCATEGORY),
                "cost_category": F.lit("Equipamentos"),
                "is_labor_cost": F.col("flag") != "N",
            }
        )
    )
    factor = lambda text: F.lit(Decimal(text)).cast("decimal(9,4)")
    months = table(spark, sf, "orders").select(code, month_of("o_orderdate").alias("reference_month")).distinct()
    plan = months.withColumns(
        {
            "position_factor": factor("1.1"), "base_cost_factor": factor("0.95"), "overtime_factor": factor("1.8"),
            "coverage_factor": factor("2.3"), "labor_factor": factor("1"), "material_factor": factor("1"), "other_cost_factor": factor("1.05"),
        }
    )
    first_year = table(spark, sf, "orders").agg(F.min(F.year("o_orderdate"))).scalar()
    return history.cost_from_template(plan, template, first_year).select(
        "contract_code", "reference_month", "flag", "budget_amount", "actual_amount"
    )
