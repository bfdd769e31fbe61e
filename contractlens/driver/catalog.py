"""Imports every query module so that the registry is complete."""

from contractlens.driver import ingest, loads, marts, relational, semantic, versions  # noqa: F401
from contractlens.driver.registry import ORACLE, QUERIES  # noqa: F401
