"""The reader of raw files and the monthly load as a job."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from contractlens.functions.scalar import exposure, fold
from contractlens.operators import checks, constraints
from contractlens.plans import measures, monthly_load
from contractlens.plans.base import hundredths
from contractlens.plans.constraints import DECLARED
from contractlens.sources.calendar import calendar
from contractlens.sources.delimited import read_delimited
from contractlens.sources.store import publish, read_table
from tests import company
from tests.conftest import rows


def written(folder, name, text):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_columns_are_found_by_name(spark, tmp_path):
    path = written(tmp_path, "a.csv", '﻿b;extra;a\r\n1;x;"say ""hi"""\r\n;y;"two\nlines; one"\r\n 3 ;z;\r\n')
    out = read_delimited(spark, path, ["a", "b"], 7)
    assert rows(out, "source_row_number", "a", "b", "batch_id") == [
        (1, 'say "hi"', "1", 7), (2, "two\nlines; one", None, 7), (3, None, "3", 7),
    ]
    with pytest.raises(ValueError, match="no column c"):
        read_delimited(spark, path, ["a", "c"], 7)
    with pytest.raises(ValueError, match="no rows"):
        read_delimited(spark, written(tmp_path, "b.csv", "a;b\n"), ["a"], 7)


def test_large_files_may_be_split(spark, tmp_path):
    path = written(tmp_path, "c.csv", "n;m\n" + "".join(f"{i};x\n" for i in range(1, 3001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = read_delimited(spark, path, ["n"], 1, multi_line=False)
        assert out.filter(F.col("n").cast("long") != F.col("source_row_number")).count() == 0 and out.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def quoted_rows(many):
    rng = random.Random(3)
    odd = ["plain", "two\nlines", 'say ""hi""', "a;b", "\n\n;\n", '""', "x" * 300, "1\n2\r\n3\n4\n5", ""]
    for n in range(1, many + 1):
        value = rng.choice(odd)
        yield n, value.replace('""', '"'), f'"{value}"' if rng.random() < 0.8 or set(value) & set('\n;"') else value


def test_quoted_line_breaks_across_blocks(spark, tmp_path):
    kept = list(quoted_rows(700))
    folder = tmp_path / "many"
    folder.mkdir()
    for name, part in (("a.csv", kept), ("b.csv", kept[:7]), ("c.csv", kept[:200])):
        body = "".join(f'{n};{raw};{n}" inch\n' + "\n" * (n % 11 == 0) for n, _, raw in part)
        written(folder, name, f"\ufeffn;v;w\n{body}" + ("\n" if name == "b.csv" else ""))
    trimmed = lambda v: v.strip(" ") or None
    for size in ("97", "1024", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            out = read_delimited(spark, str(folder), ["n", "v", "w"], 1, file_column="file")
            got = {(r.file[-5:], r.source_row_number): (r.n, r.v, r.w) for r in out.collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == {
            (name, n): (str(n), trimmed(v), f'{n}" inch')
            for name, part in (("a.csv", kept), ("b.csv", kept[:7]), ("c.csv", kept[:200])) for n, v, _ in part
        }


def test_odd_quotes(spark, tmp_path):
    with pytest.raises(ValueError, match="ends inside a quoted value"):
        read_delimited(spark, written(tmp_path, "open.csv", 'a;b\n1;"x\n2;y\n'), ["a"], 1)
    folder = tmp_path / "heads"
    folder.mkdir()
    written(folder, "a.csv", "a;b\n1;2\n")
    written(folder, "b.csv", "a;c\n1;2\n")
    with pytest.raises(ValueError, match="differs"):
        read_delimited(spark, str(folder), ["a"], 1)


def test_amounts_beyond_a_trillion(spark):
    one = spark.range(1).select(
        exposure(F.lit("2000000000000.00").cast("decimal(18,2)") * 12).alias("e"),
        hundredths(F.lit("9999999999999999.99").cast("decimal(18,2)")).alias("h"),
    )
    assert [str(x) for x in one.first()] == ["24000000000000.000000", "999999999999999999"]


def test_fold_knows_every_accent(spark):
    words = ["ação", "acaõ", "AÇÃO", "Žlutý kůň", "plain"]
    out = spark.createDataFrame([(w,) for w in words], "w string").select(fold("w")).collect()
    assert [r[0] for r in out] == ["ACAO", "ACAO", "ACAO", "ZLUTY KUN", "PLAIN"]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    paths = company.write_files(str(tmp_path_factory.mktemp("raw")))
    dims = company.dimensions(spark) | {"calendar": calendar(spark)}
    for i, name in enumerate(paths, 1):
        monthly_load.run_load(spark, root, i, name, paths[name], dims, company.PERIOD)
    return root, paths, dims


def files_of(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_load_leaves_facts_and_audit(spark, store):
    root, paths, _ = store
    audit = {r.source_name: (r.rows_received, r.rows_loaded, r.rows_rejected, r.status) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit == {
        "contract_register": (12, 10, 2, "PARTIAL"), "monthly_measurements": (12, 10, 2, "PARTIAL"), "operational_costs": (58, 56, 2, "PARTIAL"),
        "workforce_control": (23, 21, 2, "PARTIAL"), "sla_incidents": (17, 15, 2, "PARTIAL"), "contract_adjustments": (7, 5, 2, "PARTIAL"),
    }
    counts = {t.name: monthly_load.fact(spark, root, t.name).count() for t in monthly_load.FACTS.values()}
    assert counts == {"revenue": 10, "cost": 56, "operation": 21, "incidents": 15, "adjustments": 5}
    assert rows(monthly_load.fact(spark, root, "adjustments"), "adjustment_key") == [(i,) for i in range(1, 6)]
    assert monthly_load.contracts(spark, root).filter("is_current").count() == 10


def test_stored_tables_keep_their_constraints(spark, store):
    root, _, dims = store
    tables = {t.name: monthly_load.fact(spark, root, t.name) for t in monthly_load.FACTS.values()} | dims
    tables |= {"contract": monthly_load.contracts(spark, root), "bridge": monthly_load.bridge(spark, root)}
    assert tables["bridge"].count() == 10 and monthly_load.latest_month(spark, root, "revenue") == 202501
    constraints.enforce(tables, DECLARED)
    with pytest.raises(ValueError, match="revenue: contract exists"):
        constraints.enforce(tables | {"contract": tables["contract"].limit(3)}, DECLARED)


def test_second_run_of_a_batch_changes_nothing(spark, store):
    root, paths, dims = store
    before = rows(monthly_load.fact(spark, root, "adjustments"), "adjustment_number", "adjustment_key")
    for i, name in ((6, "contract_adjustments"), (2, "monthly_measurements"), (1, "contract_register")):
        monthly_load.run_load(spark, root, i, name, paths[name], dims, company.PERIOD)
    assert rows(monthly_load.fact(spark, root, "adjustments"), "adjustment_number", "adjustment_key") == before
    assert monthly_load.fact(spark, root, "revenue").count() == 10
    assert monthly_load.contracts(spark, root).count() == 10
    assert spark.read.parquet(f"{root}/rejected/monthly_measurements").count() == 2
    assert spark.read.parquet(f"{root}/audit").count() == 6


def test_another_month_leaves_stored_files_alone(spark, store, tmp_path):
    root, paths, dims = store
    folder = f"{root}/dw/revenue"
    held = files_of(folder)
    with open(paths["monthly_measurements"], encoding="utf-8-sig") as f:
        header, *lines = f.read().splitlines()
    lines = [x.replace(";01/2025;", ";02/2025;") for x in lines if ";01/2025;" in x]
    later = written(tmp_path, "feb.csv", "\n".join([header, *lines]) + "\n")
    monthly_load.run_load(spark, root, 20, "monthly_measurements", later, dims, company.PERIOD)
    assert set(held) <= set(files_of(folder))
    assert monthly_load.fact(spark, root, "revenue").count() > 10


def test_a_contract_delivered_twice_fails_the_batch(spark, store, tmp_path):
    root, paths, dims = store
    with open(paths["contract_register"], encoding="utf-8-sig") as f:
        lines = f.read().splitlines()
    twice = written(tmp_path, "twice.csv", "\n".join([lines[0], lines[1], lines[1]]) + "\n")
    with pytest.raises(ValueError, match="delivered twice"):
        monthly_load.run_load(spark, root, 30, "contract_register", twice, dims, company.PERIOD)
    failed = spark.read.parquet(f"{root}/audit").filter("batch_id = 30").first()
    assert failed.status == "FAILED" and "delivered twice" in failed.error_message
    assert monthly_load.contracts(spark, root).count() == 10


def test_preflight_stops(spark):
    tables = {"contract": spark.range(10), "revenue": spark.range(3)}
    checks.preflight({"contract": 10, "revenue": 3}, tables)
    with pytest.raises(ValueError, match="missing tables: cost"):
        checks.preflight({"contract": 1, "cost": 1}, tables)
    with pytest.raises(ValueError, match="revenue .needs 4"):
        checks.preflight({"contract": 10, "revenue": 4}, tables)


def test_a_published_version_is_not_overwritten(spark, tmp_path):
    publish(spark, str(tmp_path), "v1", {"t": spark.range(2)})
    with pytest.raises(ValueError, match="already published"):
        publish(spark, str(tmp_path), "v1", {"t": spark.range(3)})
    publish(spark, str(tmp_path), "v2", {"t": spark.range(3)})
    assert read_table(spark, str(tmp_path), "t").count() == 3


def test_contracts_are_counted_once(spark):
    months = spark.createDataFrame(
        [("m", 1, "2025-01-01", "EXPAND", 2), ("m", 1, "2025-02-01", "REVIEW_SCHEDULE", 3), ("m", 2, "2025-01-01", "REVIEW_SCHEDULE", 5),
         ("m", 1, "2025-03-01", "REVIEW_SCHEDULE", 3), (None, 3, "2025-01-01", "MAINTAIN", 4)],
        "manager_name string, contract_key long, reference_month string, recommended_action_code string, open_adjustment_count long",
    ).withColumn("reference_month", F.to_date("reference_month"))
    for c in ("net_revenue", "total_cost", "contribution_margin", "target_margin_pct", "contract_risk_score", "quality_risk_score"):
        months = months.withColumn(c, F.lit(1).cast("decimal(18,2)"))
    names = {"a": "Contratos com Ação", "o": "Reajustes Abertos", "c": "Contratos com Reajuste Aberto"}
    assert rows(measures.measure(months, names, ["manager_name"]), "manager_name", "a", "o", "c") == [(None, 0, 4, 1), ("m", 2, 3, 2)]
    assert rows(measures.measure(months, names), "a", "o", "c") == [(2, 3, 3)]


def test_contract_versions_are_built_once_for_all_deliveries(spark, monkeypatch):
    from contractlens.driver import loads

    seen = []
    monkeypatch.setattr(loads.monthly_load, "load_facts", lambda spark, root, target, staged, dims: seen.append(dims))
    monkeypatch.setattr(loads.monthly_load, "fact", lambda *_: None)
    versions = spark.range(3).withColumn("built_by", F.uuid())  # another text on every evaluation
    loads.deliver(spark, "monthly_measurements", ["first", "second"], {"contracts": versions, "calendar": "kept"})
    assert [d["calendar"] for d in seen] == ["kept", "kept"] and seen[0]["contracts"] is seen[1]["contracts"]
    assert all("uuid" not in d["contracts"]._jdf.queryExecution().toString() for d in seen)
