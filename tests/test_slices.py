"""Facts by month: what a load reads, writes, and leaves when it dies."""

from __future__ import annotations

import os
import shutil

import pytest

from contractlens.driver import loads
from contractlens.plans import monthly_load
from contractlens.session import materialize
from contractlens.sources import slices
from contractlens.sources.calendar import calendar
from tests.conftest import rows

FACT = "contract string, amount long, fact_month int"
KEYS = ["contract"]


def frame(spark, data):
    return spark.createDataFrame(data, FACT)


def load(spark, root, data, delivered=None, **how):
    new = frame(spark, data)
    asked = new if delivered is None else frame(spark, delivered)
    return slices.replace_slices(spark, root, new, asked, KEYS, **how)


def test_only_delivered_months_are_read(spark, tmp_path):
    root = str(tmp_path)
    assert slices.state(spark, root).latest_month is None
    load(spark, root, [("a", 1, 202401), ("b", 2, 202401), ("a", 3, 202402), ("a", 4, 202403)])
    before = slices.state(spark, root)
    for month in (202402, 202403):  # unreadable from here on: a load that looks at them fails
        for d, _, names in os.walk(f"{root}/data/{before.months[month][0]}/_slice={month}"):
            for n in names:
                if n.endswith(".parquet"):
                    with open(os.path.join(d, n), "wb") as f:
                        f.write(b"broken")
                    if os.path.exists(os.path.join(d, f".{n}.crc")):
                        os.remove(os.path.join(d, f".{n}.crc"))
    assert load(spark, root, [("a", 10, 202401), ("c", 11, 202404)]) == 2
    after = slices.state(spark, root)
    assert after.latest_month == 202404 and after.months[202401] != before.months[202401]
    assert {m: f for m, f in after.months.items() if m in (202402, 202403)} == {m: before.months[m] for m in (202402, 202403)}
    assert rows(slices.read(spark, root, [202401, 202404, 209912])) == [("a", 10, 202401), ("b", 2, 202401), ("c", 11, 202404)]


def test_delivered_slices_are_not_written(spark, tmp_path, monkeypatch):
    """They are nearly as many as the delivered rows, and read once: against the stored months, if there are any."""
    written = []
    monkeypatch.setattr(slices, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    root = str(tmp_path)
    load(spark, root, [("a", 1, 202401), ("b", 2, 202402)], [("a", 0, 202401), ("a", 0, 202401), ("z", 0, None), (None, 0, 202401)])
    assert load(spark, root, [("a", 3, 202401)], [("a", 0, 202401), ("a", 0, 202401), (None, 0, 202401)]) == 1
    assert load(spark, root, [("a", 4, 202403)]) == 1
    assert rows(slices.read(spark, root)) == [("a", 3, 202401), ("a", 4, 202403), ("b", 2, 202402)]
    assert written == ["new_facts"] * 3


def test_joined_rows_are_stored_before_they_are_split(spark, monkeypatch):
    """Every delivery is read several times; the join behind it runs once."""
    left = spark.createDataFrame([(1, "P"), (2, "F"), (2, "F"), (None, "P"), (3, None)], "k int, o_orderstatus string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    monkeypatch.setattr(loads, "deliver", lambda _spark, _name, deliveries, _dims: [(rows(d), d.inputFiles()) for d in deliveries])
    first, second = loads.deliver_joined(spark, "workforce_control", left.join(right, "k"), loads.by_status, {})
    assert (first[0], second[0]) == ([(2, "y"), (2, "y")], [(1, "x")])
    assert first[1] == second[1] and all("/contractlens/staged-" in f for f in first[1])


def test_processes_are_dated_and_looked_up_once(spark, tmp_path, monkeypatch):
    written, looked_up, known_months = [], [], slices.known_months
    record = lambda df, name: written.append(name) or materialize(df, name)
    monkeypatch.setattr(slices, "materialize", record)
    monkeypatch.setattr(monthly_load, "materialize", record)
    monkeypatch.setattr(slices, "known_months", lambda *a: looked_up.append(1) or known_months(*a))
    root, dims = str(tmp_path), {
        "contracts": spark.createDataFrame([("c", 7, "x")], "contract_code string, contract_key long, client_code string")
        .selectExpr("*", "date '2024-01-01' AS valid_from", "cast(null as date) AS valid_to"),
        "calendar": calendar(spark, "2024-01-01", "2024-12-31"),
    }

    def deliver(*data):
        staged = spark.createDataFrame(data, "adjustment_number string, contract_code string, day string").selectExpr(
            "adjustment_number", "contract_code", "cast(day as date) AS expected_date", "cast(null as date) AS requested_date", "cast(null as date) AS approved_date"
        )
        monthly_load.load_facts(spark, root, monthly_load.FACTS["contract_adjustments"], staged, dims)
        stored = monthly_load.fact(spark, root, "adjustments")
        return rows(stored.selectExpr("adjustment_number", "cast(expected_date as string)", "adjustment_key"))

    assert deliver(("b", "c", "2024-03-01"), ("a", "c", "2024-02-01"), ("d", "c", "2025-01-01")) == [("a", "2024-02-01", 1), ("b", "2024-03-01", 2)]
    assert deliver(("b", "c", "2024-05-01"), ("d", "c", "2024-02-03"), ("a", "unknown", "2024-02-01")) == [("b", "2024-05-01", 2), ("d", "2024-02-03", 3)]
    assert deliver(("a", "c", "2024-06-01")) == [("a", "2024-06-01", 4), ("b", "2024-05-01", 2), ("d", "2024-02-03", 3)]
    assert slices.state(spark, f"{root}/dw/adjustments").last_key == 4
    assert written == ["adjustments"] * 3 and len(looked_up) == 3


def test_cleared_months_leave_and_columns_join(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, [("a", 1, 202401), ("a", 3, 202402)])
    load(spark, root, [], [("a", 0, 202401)])
    assert sorted(slices.state(spark, root).months) == [202402]
    wider = spark.createDataFrame([("b", 5, 202402, "x")], "contract string, amount long, fact_month int, note string")
    slices.replace_slices(spark, root, wider, wider, KEYS)
    assert rows(slices.read(spark, root), "contract", "amount", "note") == [("a", 3, None), ("b", 5, "x")]
    load(spark, root, [], [("a", 0, 202402), ("b", 0, 202402)])
    assert slices.read(spark, root).count() == 0 and slices.state(spark, root).latest_month is None
    with pytest.raises(FileNotFoundError):
        slices.read(spark, f"{root}/elsewhere")


def test_a_load_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load(spark, root, [("a", 1, 202401), ("b", 2, 202401)])
    with monkeypatch.context() as m:
        m.setattr(slices, "_commit", lambda *_: (_ for _ in ()).throw(OSError("killed before the swap")))
        with pytest.raises(OSError):
            load(spark, root, [("a", 9, 202401)])
    os.makedirs(f"{root}/manifest/v00000002")  # a manifest whose write did not end
    assert rows(slices.read(spark, root)) == [("a", 1, 202401), ("b", 2, 202401)]
    load(spark, root, [("a", 9, 202401)])
    assert slices.state(spark, root).version == 3
    assert rows(slices.read(spark, root)) == [("a", 9, 202401), ("b", 2, 202401)]


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load(spark, root, [("a", 1, 202401)])
    stale = slices.state(spark, root)
    load(spark, root, [("b", 2, 202402)])
    monkeypatch.setattr(slices, "state", lambda *_: stale)
    with pytest.raises(RuntimeError, match="meanwhile"):
        load(spark, root, [("c", 3, 202403)])


def test_numbers_find_their_month(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, [("n1", 1, 202401), ("n2", 2, 202402), ("n3", 3, 202403)], numbered=True, last_key=3)
    load(spark, root, [("n1", 10, 202405)], numbered=True)  # moves to another month
    assert sorted(slices.state(spark, root).months) == [202402, 202403, 202405]
    assert slices.state(spark, root).last_key == 3
    load(spark, root, [], [("n2", 0, 0)], numbered=True)  # withdrawn
    load(spark, root, [("n2", 20, 202403), ("n1", 30, 202405)], numbered=True)
    assert rows(slices.read(spark, root)) == [("n1", 30, 202405), ("n2", 20, 202403), ("n3", 3, 202403)]
    now = slices.state(spark, root)
    asked = frame(spark, [("n1", 0, 0), ("n2", 0, 0), ("zz", 0, 0)])
    assert rows(slices.known_months(spark, root, now, asked, "contract")) == [("n1", 202405), ("n2", 202403)]


def test_vacuum_keeps_what_is_used(spark, tmp_path):
    root = str(tmp_path)
    for amount in range(4):
        load(spark, root, [("a", amount, 202401), *([("b", 0, 202402)] if not amount else [])])
    kept = slices.versions(spark, root)[-1]
    gone = slices.vacuum(spark, root, keep=1)
    assert len([g for g in gone if g.startswith("data/")]) == 3 and slices.versions(spark, root) == [kept]
    assert rows(slices.read(spark, root)) == [("a", 3, 202401), ("b", 0, 202402)]
    shutil.rmtree(root)
