"""The registry with and without the optional subpackage."""

import sys

import __spark_entry__


def test_registry_without_the_optional_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("contractlens.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "contractlens.llm", None)
    names = __spark_entry__.queries()
    assert "executive_summary" in names and not [n for n in names if n.startswith("op") and n[2].isdigit()]
    assert set(__spark_entry__.oracle_sql()) == set(names)


def test_every_check_names_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
