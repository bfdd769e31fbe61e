"""Operators on tiny frames, against values worked out by hand or by brute force."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions import parse, scalar
from contractlens.operators import changes, checks, constraints, overlay, quarantine, shape, temporal
from contractlens.plans import actions, base, performance, risk, timeline
from contractlens.plans.base import hundredths
from contractlens.plans.measures import rolling_12_months, with_prior_month
from contractlens.sources.calendar import calendar
from tests.conftest import rows

D = dt.date


def values(spark, kind, texts, expr):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r[0] for r in df.select(expr("s").alias("v")).collect()]


def test_parse_decimal(spark):
    texts = ["R$ 580.000,00", "18.040", "1.5", "valor inválido", "-2", "1.234.567", "", None, " 82 ", "1.23"]
    assert values(spark, "d", texts, parse.parse_decimal) == [
        Decimal("580000"), Decimal("18040"), Decimal("1.5"), None, Decimal("-2"), Decimal("1234567"), None, None, Decimal("82"), Decimal("1.23"),
    ]


def test_parse_percent(spark):
    assert values(spark, "p", ["14,5%", "150%", "1%", "0,5%", "x"], parse.parse_percent) == [
        Decimal("0.145"), Decimal("1.5"), Decimal("1"), Decimal("0.5"), None,
    ]


def test_parse_dates(spark):
    assert values(spark, "d", ["01/01/2024", "2023-07-01", "31/02/2024", "x", "2023-07-01T10:00"], parse.parse_date) == [
        D(2024, 1, 1), D(2023, 7, 1), None, None, D(2023, 7, 1),
    ]
    assert values(spark, "m", ["01/2025", "2025-01", "15/01/2025", "13/2025", "01/1999", "mês"], parse.parse_month) == [
        D(2025, 1, 1), D(2025, 1, 1), D(2025, 1, 1), None, None, None,
    ]
    assert values(spark, "t", ["03/01/2025 06:30", "2025-01-03", "x"], parse.parse_timestamp) == [
        dt.datetime(2025, 1, 3, 6, 30), dt.datetime(2025, 1, 3), None,
    ]


def test_parse_flag(spark):
    assert values(spark, "f", ["Sim", "NÃO", "talvez", "1", "0", "?", ""], parse.parse_flag) == [True, False, True, True, False, None, None]


def test_fold_ignores_case_and_accents(spark):
    assert values(spark, "k", [" Média", "CRÍTICA ", "não"], scalar.fold) == ["MEDIA", "CRITICA", "NAO"]


@pytest.mark.parametrize("n,d,whole,exact", [(0, 0, None, None), (1, 3, 0, "0.3333"), (3, 3, 1, "1.0000"), (2, 3, 0, "0.6667")])
def test_whole_ratio(spark, n, d, whole, exact):
    r = spark.range(1).select(scalar.whole_ratio(F.lit(n), F.lit(d)).alias("w"), scalar.whole_ratio(F.lit(n), F.lit(d), exact=True).alias("e")).first()
    assert r.w == whole and r.e == (Decimal(exact) if exact else None)


def test_month_boundaries_and_minutes(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 2, 1))], "a date, b date")
    assert df.select(scalar.calendar_months_between("a", "b")).first()[0] == 1
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert t.select(scalar.minutes_between("a", "b")).first()[0] == 2


def test_hundredths_are_exact(spark):
    amounts = [Decimal("0.07"), Decimal("-1234567890.12"), Decimal("580000.00"), Decimal("1.15")]
    df = spark.createDataFrame([(a,) for a in amounts], "a decimal(18,2)")
    assert [r[0] for r in df.select(hundredths("a")).collect()] == [int(a * 100) for a in amounts]


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 1826
    r = days.filter("full_date = '2024-03-02'").first()
    assert (r.date_key, r.month_name_pt, r.is_weekend, r.month_end_date) == (20240302, "Março", True, D(2024, 3, 31))


# --- temporal ------------------------------------------------------------------

MONTHS = [("a", D(2024, m, 1)) for m in range(1, 7)] + [("b", D(2024, 3, 1))]
PROCESSES = [
    ("a", 1, D(2024, 2, 29)), ("a", 2, D(2024, 2, 29)), ("a", 3, D(2024, 5, 10)), ("a", 9, None), ("b", 4, D(2024, 4, 1)),
]


def test_asof_first_and_last_match_brute_force(spark):
    left = spark.createDataFrame(MONTHS, "k string, month date")
    right = spark.createDataFrame(PROCESSES, "k string, id int, day date")
    first = temporal.asof_first(left, right, ["k"], F.last_day("month"), "day", "id", {"id": "first_id"})
    last = temporal.asof_last_by_month(left, right, ["k"], "month", "day", "id", {"id": "last_id"})

    def brute(pick):
        out = []
        for k, m in MONTHS:
            end = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
            due = [(d, i) for kk, i, d in PROCESSES if kk == k and d and d <= end]
            out.append((k, m, pick(due)[1] if due else None))
        return sorted(out, key=lambda t: tuple(map(str, t)))

    assert rows(first) == brute(min)
    assert rows(last) == brute(max)


def test_effective_dated_join_matches_brute_force(spark):
    versions = [("a", 1, D(2023, 5, 1), D(2024, 1, 14)), ("a", 2, D(2024, 1, 15), D(2024, 3, 31)), ("a", 3, D(2024, 4, 1), None), ("b", 4, D(2024, 6, 1), None)]
    facts = [("a", D(2024, 1, 14)), ("a", D(2024, 1, 15)), ("a", D(2024, 12, 1)), ("b", D(2024, 5, 31)), ("b", D(2024, 6, 1)), ("a", D(2023, 4, 30)), ("c", D(2024, 1, 1))]
    v = spark.createDataFrame(versions, "k string, v int, valid_from date, valid_to date")
    f = spark.createDataFrame(facts, "k string, day date")
    got = temporal.effective_dated_join(f, v, ["k"], "day", columns=["v"])
    want = sorted(((k, d, i) for k, d in facts for kk, i, s, e in versions if kk == k and s <= d <= (e or D(9999, 12, 31))), key=lambda t: tuple(map(str, t)))
    assert rows(got, "k", "day", "v") == want


def test_effective_dated_join_on_random_ranges(spark):
    rng = random.Random(9)
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    versions, facts = [], []
    for k in range(40):
        at = rng.randrange(300)
        for n in range(rng.randrange(1, 6)):
            end = at + rng.randrange(0, 200)
            last = rng.random() < 0.2
            versions.append((f"k{k}", n, day(at), rng.choice([None, D(9999, 12, 31)]) if last else day(end)))
            at = end + 1 + rng.choice([0, 0, 40])
            if last:
                break
        facts += [(f"k{k}", day(rng.randrange(-100, 3000))) for _ in range(20)] + [(f"k{k}", v[2]) for v in versions[-2:]]
    v = spark.createDataFrame(versions, "k string, v int, valid_from date, valid_to date")
    f = spark.createDataFrame([(n, *x) for n, x in enumerate(facts)], "n int, k string, day date")
    got = rows(temporal.effective_dated_join(f, v, ["k"], "day", columns=["v"]), "n", "v")
    want = [(n, i) for n, (k, d) in enumerate(facts) for kk, i, s, e in versions if kk == k and s <= d and (e is None or d <= e)]
    assert got == sorted(want, key=lambda t: tuple(map(str, t)))


def test_a_long_version_is_joined_by_its_years(spark):
    versions = [("a", 1, D(2015, 6, 15), D(2024, 5, 31)), ("a", 2, D(2024, 6, 1), None), ("a", 3, D(2023, 12, 31), D(2024, 1, 1)), ("b", 4, None, None), (None, 5, D(2020, 1, 1), None)]
    facts = [("a", D(2015, 6, 14)), ("a", D(2015, 6, 15)), ("a", D(2023, 12, 31)), ("a", D(2024, 1, 1)), ("a", D(2024, 6, 1)), ("a", D(2031, 2, 3)), ("b", D(2024, 1, 1)), (None, D(2024, 1, 1)), ("a", None)]
    v = spark.createDataFrame(versions, "k string, v int, valid_from date, valid_to date")
    f = spark.createDataFrame(facts, "k string, day date")
    joined = temporal.effective_dated_join(f, v, ["k"], "day", columns=["v"])
    assert rows(joined, "day", "v") == [
        (D(2015, 6, 15), 1), (D(2023, 12, 31), 1), (D(2023, 12, 31), 3), (D(2024, 1, 1), 1), (D(2024, 1, 1), 3), (D(2024, 6, 1), 2), (D(2031, 2, 3), 2),
    ]
    side = temporal.version_years(v, "valid_from", "valid_to", F.lit(D(2024, 6, 1)))
    assert rows(side.groupBy("v").count()) == [(1, 10), (2, 1), (3, 2), (5, 5)]  # by months the first alone would be 108


def test_latest_month_with_history_needs_no_other_columns_of_earlier_months(spark):
    data = [("a", D(2024, 1, 1), "0.10", "x"), ("a", D(2024, 2, 1), "0.20", "x"), ("a", D(2024, 4, 1), "0.35", "now"), ("b", D(2024, 4, 1), None, None), ("c", D(2024, 2, 1), "0.50", "x"), ("b", None, "0.1", "x")]
    months = spark.createDataFrame([(k, m, p and Decimal(p), t) for k, m, p, t in data], "contract_key string, reference_month date, contribution_margin_pct decimal(18,4), text string")
    got = risk.latest_with_history(months)
    want = risk.with_history(months).filter(F.col("reference_month") == D(2024, 4, 1))
    assert rows(got, "contract_key", "text", *risk.HISTORY) == rows(want, "contract_key", "text", *risk.HISTORY) == [("a", "now", 3, Decimal("0.2500")), ("b", None, 2, None)]
    assert got.schema[:3] == months.schema[:3] and sorted(got.columns) == sorted(want.columns)
    assert risk.latest_with_history(months.filter("contract_key = 'z'")).count() == 0


def test_latest_month_is_completed_alone(spark):
    """Sums of all months, and the base of the latest one made from its own sums, as the base of all months has it."""
    sums = ["revenue_rows", *base.REVENUE_MEASURES, *base.COST_MEASURES, *base.OPERATION_MEASURES, *base.INCIDENT_MEASURES, *base.AVERAGES]
    data = [("a", D(2024, 1, 1), 3), ("a", D(2024, 3, 1), 7), ("a", D(2024, 3, 1), -50), ("a", D(2024, 3, 1), None), ("b", D(2024, 3, 1), 1234567890),
            ("twice", D(2024, 2, 1), 5), ("twice", D(2024, 3, 1), 9), ("unknown", D(2024, 4, 1), 1), (None, D(2024, 4, 1), 1), ("c", D(2024, 2, 1), 0)]
    entries = spark.createDataFrame(
        [(k, m, 1, *(None if n is None else n * (i % 5 + 1) + i % 3 for i in range(len(sums) - 1))) for k, m, n in data],
        f"contract_key string, reference_month date, {', '.join(f'{c} long' for c in sums)}",
    )
    contracts = spark.createDataFrame([(k, Decimal("0.2")) for k in ("a", "b", "c", "twice", "twice")], "contract_key string, target_margin_pct decimal(9,4)")
    processes = spark.createDataFrame(
        [("a", 1, "p1", "APPROVED", D(2024, 1, 1), D(2024, 1, 5)), ("a", 2, "p2", "APPROVED", D(2024, 2, 1), D(2024, 2, 5)), ("a", 3, "p3", "PENDING", D(2024, 2, 1), None), ("b", 4, "p4", "APPROVED", D(2024, 5, 1), D(2024, 5, 2))],
        "contract_key string, adjustment_key long, adjustment_number string, process_status string, expected_date date, approved_date date",
    ).withColumn("retroactive_amount", F.lit(Decimal("1.50")))
    every = base.monthly_base(entries, contracts, processes)
    stored = base.sum_up(entries).filter("revenue_rows > 0")
    assert {t for c, t in stored.dtypes if c not in base.KEYS} == {"bigint"}  # nothing is derived before the months are stored
    march = F.col("reference_month") == D(2024, 3, 1)
    now = base.complete(base.amounts(stored.filter(march)), contracts, processes)
    assert now.schema == every.schema and rows(now) == rows(every.filter(march)) and now.count() == 4
    slim = base.amounts(stored).select(*base.KEYS, base.margin_pct().cast("decimal(18,4)").alias("contribution_margin_pct")).join(contracts.select("contract_key"), "contract_key")
    assert rows(slim) == rows(every, *slim.columns)
    got, want = risk.latest_with_history(now, slim), risk.latest_with_history(every)
    assert rows(got) == rows(want, *got.columns) and rows(got, "contract_key", "months_in_history") == [("a", 2), ("b", 1), ("twice", 3), ("twice", 4)]
    cents = base.amounts(stored).filter("contract_key = 'b'").select("contracted_amount", "net_revenue").first()
    assert cents == (Decimal("12345678.90"), Decimal("37037036.71"))


def test_pivot_is_one_aggregate_by_key(spark, capsys):
    data = [("a", "x", 1), ("a", "x", 3), ("a", "y", None), ("b", "other", 5), ("c", None, 7), (None, "y", 2)]
    wide = shape.pivot_max(spark.createDataFrame(data, "k string, code string, n int"), ["k"], "code", "n", ["x", "y"], fill=0)
    assert wide.columns == ["k", "x", "y"]
    assert rows(wide) == [(None, 0, 2), ("a", 3, 0), ("b", 0, 0), ("c", 0, 0)]
    wide.explain()
    assert "pivotfirst" not in capsys.readouterr().out.lower()


def test_latest_period(spark):
    df = spark.createDataFrame(MONTHS, "k string, month date")
    assert rows(temporal.latest_period(df, "month")) == [("a", D(2024, 6, 1))]


# --- shape -----------------------------------------------------------------------

def test_change_rows_go_by_row_not_by_calendar(spark):
    data = [("a", 1, "x"), ("a", 2, "x"), ("a", 5, "y"), ("a", 6, "x")]
    df = spark.createDataFrame(data, "k string, m int, v string")
    assert rows(shape.change_rows(df, ["k"], "m", "v")) == [("a", 1, "x"), ("a", 5, "y"), ("a", 6, "x")]


def test_duplicates_count_all_copies_and_blank_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    got = shape.duplicate_count(df, [F.col("k")])
    assert rows(got) == sorted([("a", 3)] * 3 + [("b", 1)] + [(None, 2)] * 2, key=lambda t: tuple(map(str, t)))


def test_dense_number_over_many_partitions(spark):
    df = spark.range(1000).repartition(7).withColumn("v", (F.col("id") * 7919) % 101)
    got = shape.dense_number(df, "n", [F.desc("v"), F.asc("id")]).orderBy("n").collect()
    want = sorted(((i * 7919 % 101, i) for i in range(1000)), key=lambda t: (-t[0], t[1]))
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.v, r.id) for r in got] == want


def test_expand_by_count_drops_zero(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", None)], "k string, n int")
    assert rows(shape.expand_by_count(df, "n", "i"), "k", "i") == [("a", 1), ("a", 2)]


# --- changes -----------------------------------------------------------------------

DIM = "key long, code string, attr string, valid_from date, valid_to date, is_current boolean, row_hash string"


def test_scd2_merge_cases(spark):
    dim = spark.createDataFrame(
        [
            (1, "same", "x", D(2024, 1, 1), None, True, "h1"), (2, "rewrite", "x", D(2024, 1, 1), None, True, "h1"),
            (3, "later", "x", D(2024, 1, 1), None, True, "h1"), (4, "earlier", "x", D(2024, 1, 1), None, True, "h1"),
            (5, "later", "w", D(2023, 1, 1), D(2023, 12, 31), False, "h0"), (6, "absent", "x", D(2024, 1, 1), None, True, "h1"),
        ],
        DIM,
    )
    staged = spark.createDataFrame(
        [
            ("same", "x", D(2024, 5, 1), "h1"), ("rewrite", "y", D(2024, 1, 1), "h2"), ("later", "y", D(2024, 5, 1), "h2"),
            ("earlier", "y", D(2023, 5, 1), "h2"), ("new", "z", D(2024, 5, 1), "h3"),
        ],
        "code string, attr string, valid_from date, row_hash string",
    )
    got = changes.scd2_merge(dim, staged, "code", "key", ["attr"])
    assert rows(got, "code", "key", "attr", "valid_from", "valid_to", "is_current") == sorted(
        [
            ("same", 1, "x", D(2024, 1, 1), None, True), ("rewrite", 2, "y", D(2024, 1, 1), None, True),
            ("later", 3, "x", D(2024, 1, 1), D(2024, 4, 30), False), ("later", 7, "y", D(2024, 5, 1), None, True),
            ("earlier", 4, "x", D(2024, 1, 1), None, True), ("later", 5, "w", D(2023, 1, 1), D(2023, 12, 31), False),
            ("absent", 6, "x", D(2024, 1, 1), None, True), ("new", 8, "z", D(2024, 5, 1), None, True),
        ],
        key=lambda t: tuple(map(str, t)),
    )


def test_replace_slice_is_idempotent(spark):
    stored = spark.createDataFrame([("a", 1, 10), ("a", 1, 11), ("b", 1, 5)], "k string, m int, v int")
    new = spark.createDataFrame([("a", 1, 99)], "k string, m int, v int")
    once = changes.replace_slice(stored, new, ["k", "m"])
    assert rows(once) == [("a", 1, 99), ("b", 1, 5)]
    assert rows(changes.replace_slice(once, new, ["k", "m"])) == rows(once)


def test_upsert_and_insert_missing(spark):
    target = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q")], "k string, v int, w string")
    source = spark.createDataFrame([("a", None), ("c", 3)], "k string, v int")
    assert rows(changes.upsert_type1(target, source, "k")) == [("a", None, "p"), ("b", 2, "q"), ("c", 3, None)]
    assert rows(changes.insert_missing(target, source, ["k"])) == [("a", 1, "p"), ("b", 2, "q"), ("c", 3, None)]


def test_overlay_last_rule_wins_per_column(spark):
    grid = spark.createDataFrame([("a", D(2024, m, 1), 0, "r") for m in (1, 2, 3)], "k string, month date, x int, e string")
    rules = spark.createDataFrame(
        [("a", 1, D(2024, 1, 1), D(2024, 2, 1), 5, "one"), ("a", 2, D(2024, 2, 1), D(2024, 3, 1), None, "two")],
        "k string, rule_no int, first_month date, last_month date, x int, e string",
    )
    got = overlay.overlay_rules(grid, rules, "k", "month", ["x", "e"])
    assert rows(got) == [("a", D(2024, 1, 1), 5, "one"), ("a", D(2024, 2, 1), 5, "two"), ("a", D(2024, 3, 1), 0, "two")]


def test_quarantine_is_an_exact_complement(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None), (4, 500)], "id int, v int")
    rules = [(F.col("v").isNull() | (F.col("v") < 0), "bad"), (F.col("v") > 100, "high")]
    ok, bad = quarantine.split_valid(df, rules)
    assert rows(ok, "id") == [(1,)]
    assert rows(bad, "id", "rejection_reason") == [(2, "bad"), (3, "bad"), (4, "high")]


def test_checks(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 200.0)], "k int, v double")
    report = checks.report(
        checks.unique_grain(df, "grain", ["k"]), checks.no_row_breaks(df, "bounds", F.col("v") <= 100),
        checks.row_count(df, "count", 2), checks.columns_present(df, "columns", ["k", "z"]),
    )
    assert dict(rows(report, "check_name", "passed")) == {"grain": False, "bounds": False, "count": True, "columns": False}


# --- scoring ------------------------------------------------------------------------

PARAMS = config.parameter_values()


def test_parameters_are_complete():
    assert len(PARAMS) == 42
    assert sum(PARAMS[f"weight_{p}"] for p in config.PILLARS) == 1
    assert all(sum(Decimal(s) for _, s in parts) == 1 for parts in config.PILLARS.values())


@pytest.mark.parametrize(
    "name,cases",
    [
        ("overtime", [("0.1", 100), ("0.0999", 75), ("0.06", 75), ("0.03", 40), ("0.0299", 0), (None, 0)]),
        ("coverage", [("0.8999", 100), ("0.90", 75), ("0.95", 40), ("0.98", 0), (None, 0)]),
        ("renewal_proximity", [("-5", 100), ("60", 100), ("61", 75), ("120", 75), ("180", 40), ("181", 0), (None, 0)]),
        ("recurrence", [("0.5", 100), ("0.25", 60), ("0.01", 30), ("0", 0), (None, 0)]),
    ],
)
def test_bands_at_their_limits(spark, name, cases):
    band = config.BANDS[name]
    df = spark.createDataFrame([(Decimal(v) if v else None, s) for v, s in cases], f"{band.column} decimal(18,4), want int")
    assert df.filter(risk.band_score(band, PARAMS) != F.col("want")).count() == 0


def test_margin_gap_and_sla_guards(spark):
    df = spark.createDataFrame(
        [("0.10", "0.30", 0), ("-0.01", "0.05", 15), ("-0.02", "0.05", 40), ("-0.06", "0.05", 75), ("-0.1", "0.05", 100), ("-0.01", "-0.001", 100)],
        "g string, m string, want int",
    ).selectExpr("cast(g as decimal(18,4)) margin_gap_pct", "cast(m as decimal(18,4)) contribution_margin_pct", "want")
    assert df.filter(risk.margin_gap_score(PARAMS) != F.col("want")).count() == 0
    sla = spark.createDataFrame([(0, None, 0), (2, "0", 100), (2, "0.75", 75), (2, "0.9", 40), (2, "1", 0)], "incident_count int, s string, want int")
    sla = sla.withColumn("sla_compliance_rate", F.col("s").cast("decimal(18,4)"))
    assert sla.filter(risk.sla_score(PARAMS) != F.col("want")).count() == 0


def test_trend_needs_three_rows(spark):
    df = spark.createDataFrame(
        [("a", m, v) for m, v in zip((1, 2, 7), ("0.10", "0.20", "0.12"))], "contract_key string, reference_month int, v string"
    ).withColumn("contribution_margin_pct", F.col("v").cast("decimal(18,4)"))
    got = rows(risk.with_history(df).withColumn("t", risk.margin_trend()), "reference_month", "months_in_history", "t")
    assert got == [(1, 1, "INSUFFICIENT_HISTORY"), (2, 2, "INSUFFICIENT_HISTORY"), (7, 3, "IMPROVING")]


def test_unbilled_scope_needs_overrun_and_no_extra_billing(spark):
    df = spark.createDataFrame([(100, 110, 0, 1000), (100, 110, 5, 1000), (100, 90, 0, 1000), (0, 5, 0, 1000)], "p int, r int, a int, c int").selectExpr(
        "cast(p as decimal(18,2)) planned_hours", "cast(r as decimal(18,2)) regular_hours", "cast(a as decimal(18,2)) additional_services", "cast(c as decimal(18,2)) contracted_amount"
    )
    assert [float(r[0]) if r[0] is not None else None for r in df.select(performance.unbilled_scope()).collect()] == [100.0, 0.0, 0.0, None]


def test_first_rule_falls_through_null(spark):
    df = spark.createDataFrame([(None,), (5,)], "v int")
    assert [r[0] for r in df.select(actions.first_rule([("A", F.col("v") > 3)], "Z")).collect()] == ["Z", "A"]


def test_override_by_completion_date(spark):
    queue = spark.createDataFrame(
        [(1, D(2025, m, 1), "REVIEW_RETROACTIVE", Decimal("5.00")) for m in (1, 2, 3)] + [(1, D(2025, 4, 1), "EXPAND", Decimal("5.00")), (2, D(2025, 3, 1), "REVIEW_RETROACTIVE", Decimal("5.00"))],
        "contract_key int, reference_month date, recommended_action_code string, action_impact_amount decimal(18,2)",
    )
    done = spark.createDataFrame([(1, "REVIEW_RETROACTIVE", "COMPLETED", D(2025, 2, 28)), (2, "REVIEW_RETROACTIVE", "IN_PROGRESS", None)], "contract_key int, action_code string, action_status string, completion_date date")
    got = rows(actions.close_completed(queue, done), "contract_key", "reference_month", "recommended_action_code")
    assert got == [
        (1, D(2025, 1, 1), "REVIEW_RETROACTIVE"), (1, D(2025, 2, 1), "MAINTAIN"), (1, D(2025, 3, 1), "MAINTAIN"),
        (1, D(2025, 4, 1), "EXPAND"), (2, D(2025, 3, 1), "REVIEW_RETROACTIVE"),
    ]


def test_event_severity_words(spark):
    codes = ["COVERAGE_CRITICAL", "SCOPE_CREEP_HIGH", "STRUCTURAL_DEFICIT", "SLA_ACTION", "SCOPE_CREEP"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    assert [r[0] for r in df.select(timeline.word_severity(F.col("c"))).collect()] == ["CRITICAL", "HIGH", "HIGH", "ATTENTION", "INFORMATION"]


def test_prior_month_and_rolling_year_follow_the_calendar(spark):
    months = [(D(2024, 1, 1), Decimal("0.10")), (D(2024, 2, 1), Decimal("0.15")), (D(2025, 1, 1), Decimal("0.20"))]
    df = spark.createDataFrame(months, "reference_month date, v decimal(18,4)")
    assert [r.prior_value for r in with_prior_month(df, "v").orderBy("reference_month").collect()] == [None, Decimal("0.1000"), None]
    rolled = rolling_12_months(df.withColumn("g", F.lit(1)), "v", ["g"]).orderBy("reference_month").collect()
    assert [float(r.v_12m) for r in rolled] == [0.10, 0.25, 0.35]


def test_constraints_treat_null_as_a_database_does(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    child = spark.createDataFrame([(1, 1, 5), (2, None, None), (3, 9, -1), (None, 2, 3), (None, 2, 4), (3, 1, 0)], "id int, parent int, amount int")
    declared = {"child": constraints.Constraints(
        ["id", "amount"], {"not negative": "amount >= 0"}, {"id": ["id"]}, {"parent": constraints.Reference(["parent"], "parent", ["k"])}, required=["id"],
    )}
    tables = {"child": child, "parent": parent}
    assert rows(constraints.report(tables, declared), "constraint_name", "broken_rows", "passed") == [
        ("id", 4, False), ("id is set", 2, False), ("not negative", 1, False), ("parent", 1, False)]
    assert rows(constraints.broken_rows(tables, declared), "constraint_name", "row_id") == [
        ("id", "3|-1"), ("id", "3|0"), ("id", "NULL|3"), ("id", "NULL|4"), ("id is set", "NULL|3"), ("id is set", "NULL|4"),
        ("not negative", "3|-1"), ("parent", "3|-1"),
    ]
    with pytest.raises(ValueError, match="child: parent"):
        constraints.enforce(tables, declared)
    constraints.enforce({"child": child.filter("id = 1"), "parent": parent}, declared)


def test_exponents_are_no_numbers(spark):
    assert values(spark, "d", ["1e3", "1.5E2", "+7", "-.5", "7.", ".", "1,5e1"], parse.parse_decimal) == [
        None, None, Decimal("7.0000"), Decimal("-0.5000"), Decimal("7.0000"), None, None]
