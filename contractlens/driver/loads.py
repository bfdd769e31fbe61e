"""Raw files and monthly loads over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractlens.driver.registry import query, table
from contractlens.driver.relational import VERSION_SQL, order_versions
from contractlens.functions.scalar import money, month_of
from contractlens.plans import monthly_load
from contractlens.plans.dimensions import Dimension, run_dimensions
from contractlens.session import cut_points, materialize, scratch_dir, setting
from contractlens.sources.calendar import calendar
from contractlens.sources.delimited import read_delimited
from contractlens.sources.store import read_table

BLOCK_BYTES = (1 << 16, 1 << 27)


@query(
    "src_csv",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE nullif(trim(lang), '') END AS lang, nullif(trim(source), '') AS source,
  sha256(nullif(trim(text), '')) AS text_sha256, 1 AS in_order FROM documents""",
)
def src_csv(spark, sf):
    """Documents written as delimited files, with their quotes and line breaks, and read back in blocks."""
    docs = table(spark, sf, "documents").withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    folder = scratch_dir(spark, "csv")
    files = docs.select("source", "text", "doc_id", "lang").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files.write.csv(folder, sep=";", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    low, high = BLOCK_BYTES
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(min(high, max(low, size // 256)))):  # a small table too has many blocks
        read = read_delimited(spark, folder, ["doc_id", "lang", "source", "text"], 1, file_column="file")
    number = F.col("doc_id").cast("long")
    earlier = Window.partitionBy("file").orderBy("source_row_number")
    follows = (F.lag("source_row_number").over(earlier) == F.col("source_row_number") - 1) & (F.lag(number).over(earlier) < number)
    return read.select(
        number.alias("doc_id"), "lang", "source", F.sha2("text", 256).alias("text_sha256"),
        F.coalesce(follows, F.col("source_row_number") == 1).alias("in_order"),
    )


# --- five fact loads, each of two deliveries -----------------------------------
#
# contract = customer, its client the customer's nation; unit = supplier, whose
# client is the supplier's nation; pending orders are the second delivery.

CALENDAR = ("1995-03-01", "2001-06-30")
PENDING = "P"
KINDS = ["1-URGENT", "2-HIGH"]


def contracts(spark, sf):
    client = table(spark, sf, "customer").select(F.col("c_custkey").alias("contract_key"), F.concat(F.lit("N"), "c_nationkey").alias("client_code"))
    versions = order_versions(spark, sf).join(client, "contract_key")
    return versions.select(
        F.concat(F.lit("CT-"), F.col("contract_key").cast("string")).alias("contract_code"), "client_code",
        F.col("version_key").alias("contract_key"), "valid_from", "valid_to",
    )


def dimensions(spark, sf):
    units = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("unit_code"), F.concat(F.lit("N"), "s_nationkey").alias("client_code"))
    line_kinds = [(flag, status) for flag in "AR" for status in "FO"]
    return {
        "contracts": contracts(spark, sf),
        "calendar": calendar(spark, *CALENDAR),
        "units": units,
        "categories": spark.createDataFrame([(f, s, "general") for f, s in line_kinds], "cost_group string, cost_category string, cost_subcategory string"),
        "incident_types": spark.createDataFrame(
            [(k, f, s) for k in KINDS for f, s in line_kinds], "incident_category string, incident_subcategory string, root_cause string"
        ),
    }


def deliver(spark, name: str, deliveries, dims):
    """Load the deliveries one after the other and read back what is stored; the contract versions are built once."""
    root = scratch_dir(spark, "load")
    target = monthly_load.FACTS[name]
    with cut_points(spark):
        dims = dims | {"contracts": materialize(dims["contracts"], "contracts")}
        for staged in deliveries:
            monthly_load.load_facts(spark, root, target, staged, dims)
    return monthly_load.fact(spark, root, target.name)


def deliver_joined(spark, name: str, staged, split, dims):
    """Deliveries that ``split`` cuts from joined rows: these are stored first, as a batch is, so the join runs once."""
    with cut_points(spark):
        return deliver(spark, name, split(materialize(staged, "staged")), dims)


def order_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit("CT-"), F.col("o_custkey").cast("string")).alias("contract_code"), month_of("o_orderdate").alias("reference_month"),
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderdate", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("amount"),
    )


def line_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.join(order_rows(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("unit_code", F.col("l_suppkey").cast("string"))


def by_status(staged):
    pending = F.col("o_orderstatus") == PENDING
    return [staged.filter(~pending).drop("o_orderstatus"), staged.filter(pending).drop("o_orderstatus")]


LOAD_SQL = f"""{VERSION_SQL},
o AS (SELECT *, 'CT-' || o_custkey AS contract_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month, CAST(o_orderdate AS DATE) AS day FROM orders),
l AS (SELECT * FROM lineitem JOIN o ON l_orderkey = o_orderkey),
unit AS (SELECT s_suppkey, s_nationkey, c_custkey FROM supplier JOIN customer ON c_nationkey = s_nationkey)"""
DATED = "v.contract_key = o_custkey AND {day} BETWEEN v.valid_from AND COALESCE(v.valid_to, DATE '9999-12-31') AND {day} BETWEEN DATE '" + CALENDAR[0] + "' AND DATE '" + CALENDAR[1] + "'"
OWN_UNIT = "JOIN unit ON s_suppkey = l_suppkey AND c_custkey = o_custkey"


def replaced_sql(columns: str, source: str, slice_columns: str, keep: str = "TRUE", joins: str = "", day: str = "reference_month") -> str:
    """First delivery without the slices of the second, and the second."""
    dated = DATED.format(day=day)
    return f"""WITH{LOAD_SQL},
loaded AS (SELECT {columns}, o_orderstatus FROM {source} JOIN version v ON {dated} {joins} WHERE {keep}),
again AS (SELECT DISTINCT {slice_columns} FROM {source} WHERE o_orderstatus = '{PENDING}')
SELECT * EXCLUDE (o_orderstatus) FROM loaded WHERE o_orderstatus = '{PENDING}'
UNION ALL SELECT * EXCLUDE (o_orderstatus) FROM loaded ANTI JOIN again USING ({slice_columns}) WHERE o_orderstatus <> '{PENDING}'"""


KEY = "CAST(strftime(reference_month, '%Y%m%d') AS BIGINT) AS date_key"


@query(
    "load_revenue",
    replaced_sql(f"contract_code, reference_month, o_orderkey AS measurement, round(o_totalprice, 2) AS amount, version_key AS contract_key, {KEY}", "o", "contract_code, reference_month"),
)
def load_revenue(spark, sf):
    staged = order_rows(spark, sf).select("contract_code", "reference_month", F.col("o_orderkey").alias("measurement"), "amount", "o_orderstatus")
    return deliver(spark, "monthly_measurements", by_status(staged), dimensions(spark, sf)).select(
        "contract_code", "reference_month", "measurement", "amount", "contract_key", "date_key"
    )


LINE = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"


@query(
    "load_cost",
    replaced_sql(
        f"contract_code, reference_month, CAST(l_suppkey AS VARCHAR) AS unit_code, l_returnflag AS cost_group, l_linestatus AS cost_category, {LINE}, round(l_extendedprice, 2) AS amount, version_key AS contract_key, {KEY}",
        "l", "contract_code, reference_month", "l_returnflag IN ('A', 'R')", OWN_UNIT,
    ),
)
def load_cost(spark, sf):
    staged = line_rows(spark, sf).select(
        "contract_code", "reference_month", "unit_code", F.col("l_returnflag").alias("cost_group"), F.col("l_linestatus").alias("cost_category"),
        F.lit("general").alias("cost_subcategory"), "l_orderkey", "l_linenumber", money("l_extendedprice").alias("amount"), "o_orderstatus",
    )
    return deliver_joined(spark, "operational_costs", staged, by_status, dimensions(spark, sf)).select(
        "contract_code", "reference_month", "unit_code", "cost_group", "cost_category", "l_orderkey", "l_linenumber", "amount", "contract_key", "date_key"
    )


@query(
    "load_operation",
    replaced_sql(
        f"contract_code, reference_month, CAST(l_suppkey AS VARCHAR) AS unit_code, l_returnflag AS role_code, {LINE}, l_quantity AS planned_hours, version_key AS contract_key, {KEY}",
        "(SELECT *, CAST(l_suppkey AS VARCHAR) AS unit_code, l_returnflag AS role_code FROM l)", "contract_code, unit_code, role_code, reference_month", joins=OWN_UNIT,
    ),
)
def load_operation(spark, sf):
    staged = line_rows(spark, sf).select(
        "contract_code", "reference_month", "unit_code", F.col("l_returnflag").alias("role_code"), "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("planned_hours"), "o_orderstatus",
    )
    return deliver_joined(spark, "workforce_control", staged, by_status, dimensions(spark, sf)).select(
        "contract_code", "reference_month", "unit_code", "role_code", "l_orderkey", "l_linenumber", "planned_hours", "contract_key", "date_key"
    )


AGAIN = 10  # every tenth order of the first delivery comes again, with a later date
DELAY = 45


def twice(staged, day: str):
    """First all but the pending orders; then those, and every tenth of the others ``DELAY`` days later."""
    first, second = by_status(staged)
    late = first.filter(F.col("o_orderkey") % AGAIN == 0).withColumn(day, F.col(day) + F.expr(f"INTERVAL {DELAY} DAYS"))
    return [first, second.unionByName(late)]


TWICE = f"""WITH{LOAD_SQL},
moved AS (SELECT *, o_orderstatus <> '{PENDING}' AND o_orderkey % {AGAIN} = 0 AS late FROM o),
dated AS (SELECT *, CASE WHEN late THEN o_orderdate + INTERVAL {DELAY} DAY ELSE o_orderdate END AS moment FROM moved)"""
DAY_KEY = "CAST(strftime({0}, '%Y%m%d') AS BIGINT)"


@query(
    "load_incidents",
    f"""{TWICE}
SELECT l_orderkey || '-' || l_linenumber AS incident_number, contract_code, CAST(l_suppkey AS VARCHAR) AS unit_code, o_orderpriority AS incident_category,
  strftime(moment, '%Y-%m-%d %H:%M:%S') AS opened_at, version_key AS contract_key, {DAY_KEY.format("moment")} AS opened_date_key, {DAY_KEY.format("l_shipdate")} AS closed_date_key
FROM dated JOIN lineitem ON l_orderkey = o_orderkey JOIN version v ON {DATED.format(day="CAST(moment AS DATE)")} {OWN_UNIT}
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND l_returnflag IN ('A', 'R')""",
)
def load_incidents(spark, sf):
    """Numbers that come again with a later opening leave their old month."""
    staged = line_rows(spark, sf).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_number"), "contract_code", "unit_code", "o_orderkey",
        F.col("o_orderpriority").alias("incident_category"), F.col("l_returnflag").alias("incident_subcategory"), F.col("l_linestatus").alias("root_cause"),
        F.col("o_orderdate").alias("opened_at"), F.col("l_shipdate").alias("closed_at"), "o_orderstatus",
    )
    return deliver_joined(spark, "sla_incidents", staged, lambda rows: twice(rows, "opened_at"), dimensions(spark, sf)).select(
        "incident_number", "contract_code", "unit_code", "incident_category", "opened_at", "contract_key", "opened_date_key", "closed_date_key"
    )


@query(
    "load_adjustments",
    f"""{TWICE},
number AS (SELECT *, 'ADJ-' || o_orderkey AS adjustment_number FROM dated),
first AS (SELECT adjustment_number, ROW_NUMBER() OVER (ORDER BY adjustment_number) AS k FROM number JOIN version v ON {DATED.format(day="day")} WHERE o_orderstatus <> '{PENDING}'),
final AS (SELECT number.*, version_key FROM number JOIN version v ON {DATED.format(day="CAST(moment AS DATE)")}),
later AS (SELECT adjustment_number, (SELECT MAX(k) FROM first) + ROW_NUMBER() OVER (ORDER BY adjustment_number) AS k
  FROM final WHERE (late OR o_orderstatus = '{PENDING}') AND adjustment_number NOT IN (SELECT adjustment_number FROM first))
SELECT adjustment_number, contract_code, CAST(moment AS DATE) AS expected_date, version_key AS contract_key, COALESCE(first.k, later.k) AS adjustment_key,
  {DAY_KEY.format("moment")} AS expected_date_key,
  CASE WHEN o_orderpriority <> '5-LOW' AND day + 30 BETWEEN DATE '{CALENDAR[0]}' AND DATE '{CALENDAR[1]}' THEN {DAY_KEY.format("day + 30")} END AS requested_date_key
FROM final LEFT JOIN first USING (adjustment_number) LEFT JOIN later USING (adjustment_number)""",
)
def load_adjustments(spark, sf):
    """A process that comes again keeps its key."""
    staged = order_rows(spark, sf).select(
        F.concat(F.lit("ADJ-"), F.col("o_orderkey").cast("string")).alias("adjustment_number"), "contract_code", "o_orderkey", F.col("day").alias("expected_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add("day", 30)).alias("requested_date"), F.lit(None).cast("date").alias("approved_date"), "o_orderstatus",
    )
    return deliver(spark, "contract_adjustments", twice(staged, "expected_date"), dimensions(spark, sf)).select(
        "adjustment_number", "contract_code", "expected_date", "contract_key", "adjustment_key", "expected_date_key", "requested_date_key"
    )


# --- dimensions with lasting keys ------------------------------------------------

PLACES = {
    "customer": Dimension(("customer_code",), "customer_key"),
    "supplier": Dimension(("supplier_code",), "supplier_key"),
    "part_kind": Dimension(("brand", "kind"), "part_kind_key", update=False),
}


@query(
    "dimension_upsert",
    """WITH one AS (
  SELECT 'customer' AS dimension, 'C' || c_custkey AS code, c_mktsegment AS label, c_custkey % 3 <> 0 AS early, c_custkey % 2 = 0 AS late, lower(c_mktsegment) AS relabel FROM customer
  UNION ALL SELECT 'supplier', 'S' || s_suppkey, s_name, TRUE, s_suppkey % 5 = 0, upper(s_name) FROM supplier
  UNION ALL SELECT 'part_kind', p_brand || '/' || p_type, CAST(MIN(p_size) FILTER (WHERE p_size <= 25) AS VARCHAR), MIN(p_size) <= 25, MAX(p_size) > 10, CAST(MAX(p_size) FILTER (WHERE p_size > 10) AS VARCHAR) FROM part GROUP BY p_brand, p_type),
keyed AS (SELECT *, CASE WHEN early THEN ROW_NUMBER() OVER (PARTITION BY dimension, early ORDER BY code) END AS k1, COUNT(*) FILTER (WHERE early) OVER (PARTITION BY dimension) AS n1 FROM one WHERE early OR late)
SELECT dimension, code, COALESCE(k1, n1 + ROW_NUMBER() OVER (PARTITION BY dimension, k1 IS NULL ORDER BY code)) AS key,
  CASE WHEN late AND (dimension <> 'part_kind' OR NOT early) THEN relabel ELSE label END AS label FROM keyed""",
)
def dimension_upsert(spark, sf):
    """Two deliveries of three dimensions; the second renames, adds, and leaves out."""
    root = scratch_dir(spark, "dimensions")
    customer, supplier, part = (table(spark, sf, n) for n in ("customer", "supplier", "part"))
    code = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    kinds = lambda rows, size: rows.groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")).agg(size("p_size").cast("string").alias("label"))
    first = {
        "customer": customer.filter("c_custkey % 3 <> 0").select(code("C", "c_custkey").alias("customer_code"), F.col("c_mktsegment").alias("label")),
        "supplier": supplier.select(code("S", "s_suppkey").alias("supplier_code"), F.col("s_name").alias("label")),
        "part_kind": kinds(part.filter("p_size <= 25"), F.min),
    }
    second = {
        "customer": customer.filter("c_custkey % 2 = 0").select(code("C", "c_custkey").alias("customer_code"), F.lower("c_mktsegment").alias("label")),
        "supplier": supplier.filter("s_suppkey % 5 = 0").select(code("S", "s_suppkey").alias("supplier_code"), F.upper("s_name").alias("label")),
        "part_kind": kinds(part.filter("p_size > 10"), F.max),
    }
    for delivered in (first, second):
        run_dimensions(spark, root, delivered, PLACES)
    named = lambda name, d: read_table(spark, root, name).select(
        F.lit(name).alias("dimension"), F.concat_ws("/", *d.codes).alias("code"), F.col(d.key).alias("key"), "label"
    )
    return reduce(DataFrame.unionByName, [named(name, d) for name, d in PLACES.items()])
