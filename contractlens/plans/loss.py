"""Margin loss bridge: seven causes per contract-month."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import config
from contractlens.functions.scalar import exposure, money
from contractlens.operators.shape import unpivot_structs

BRIDGE_KEYS = ["reference_month", "date_key", "contract_key", "contract_code"]


def share_of(code: str, rate: str, rates: dict[str, Column] | None) -> Column:
    """Recovery rate of a cause: that of ``rates`` (columns of the row), else the configured one."""
    return F.lit(Decimal(rate)) if rates is None else rates[code]


def loss_bridge(performance: DataFrame, causes=config.LOSS_CAUSES, rates: dict[str, Column] | None = None) -> DataFrame:
    """One row per cause with a positive amount; one scan of the performance mart.

    The amount is tested before it is rounded, so a fraction of a cent is kept.
    """
    structs = []
    for code, name, rate, nature, is_estimate, note in causes:
        amount = F.col(config.LOSS_AMOUNT_COLUMNS[code])
        share = share_of(code, rate, rates)
        structs.append(
            F.struct(
                F.lit(code).alias("loss_code"),
                F.lit(name).alias("loss_name_pt"),
                F.lit(nature).alias("loss_nature"),
                F.lit(is_estimate).alias("is_estimate"),
                (amount > 0).alias("is_loss"),
                money(amount).alias("loss_amount"),
                share.cast("decimal(9,4)").alias("recovery_rate"),
                money(exposure(amount * share)).alias("recoverable_amount"),
                F.lit(note).alias("calculation_note"),
            )
        )
    long = unpivot_structs(performance, structs, BRIDGE_KEYS)
    return long.filter("is_loss").drop("is_loss")


def loss_of(code: str) -> Column:
    """Amount of one cause on a performance row (0 when there is none)."""
    amount = F.col(config.LOSS_AMOUNT_COLUMNS[code])
    return F.when(amount > 0, money(amount)).otherwise(F.lit(0).cast("decimal(18,2)"))


def recoverable_of(code: str, share: Column) -> Column:
    amount = F.col(config.LOSS_AMOUNT_COLUMNS[code])
    return F.when(amount > 0, money(exposure(amount * share))).otherwise(F.lit(0).cast("decimal(18,2)"))


def with_loss_columns(performance: DataFrame, causes=config.LOSS_CAUSES, rates: dict[str, Column] | None = None) -> DataFrame:
    """The same bridge kept wide, so later steps need no join back to it.

    Amounts are rounded once per cause; the totals add the rounded columns.
    """
    losses = {f"loss_{code}": loss_of(code) for code, *_ in causes}
    shares = {f"_share_{code}": recoverable_of(code, share_of(code, rate, rates)) for code, _, rate, *_ in causes}
    estimates = {f"loss_{c}" for c, _, _, _, is_estimate, _ in causes if is_estimate}

    def total(columns) -> Column:
        first, *rest = [F.col(c) for c in columns]
        return sum(rest, first).cast("decimal(18,2)")

    return (
        performance.withColumns(losses | shares)
        .withColumns(
            {
                "identified_loss_amount": total(losses),
                "direct_loss_amount": total(c for c in losses if c not in estimates),
                "estimated_exposure_amount": total(c for c in losses if c in estimates),
                "recoverable_amount": total(shares),
            }
        )
        .drop(*shares)
    )
