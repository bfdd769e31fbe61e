"""Constraints of the stored contract tables.

`enforce` of `operators.constraints` takes them with the tables of the same names
and stops a run whose state breaks one.
"""

from __future__ import annotations

from contractlens.operators.constraints import Constraints, Reference


def not_negative(*columns: str) -> dict[str, str]:
    return {f"{c} is not negative": f"{c} >= 0" for c in columns}


def a_share(*columns: str) -> dict[str, str]:
    return {f"{c} is a share": f"{c} BETWEEN 0 AND 1" for c in columns}


def one_of(column: str, *values: str) -> dict[str, str]:
    return {f"{column} is known": f"{column} IN ({', '.join(repr(v) for v in values)})"}


CONTRACT = Reference(["contract_key"], "contract")


def day(column: str) -> Reference:
    return Reference([column], "calendar", ["date_key"])


DECLARED = {
    "contract": Constraints(
        ["contract_code", "valid_from"],
        checks=a_share("target_margin_pct") | not_negative("contracted_positions", "contracted_hours") | {
            "amount is positive": "base_monthly_amount > 0",
            "version ends after it starts": "valid_to IS NULL OR valid_to >= valid_from",
            "adjustment month is a month": "adjustment_base_month IS NULL OR adjustment_base_month BETWEEN 1 AND 12",
            "current version is open": "NOT is_current OR valid_to IS NULL",
        },
        unique={"one key per version": ["contract_key"], "one version per start": ["contract_code", "valid_from"]},
        required=["contract_key", "contract_code", "valid_from"],
    ),
    "bridge": Constraints(
        ["contract_key", "service_code"],
        checks=a_share("revenue_share_pct", "cost_share_pct") | {"share ends after it starts": "valid_to IS NULL OR valid_to >= valid_from"},
        unique={"one share per service": ["contract_key", "service_code", "valid_from"]},
        references={"contract exists": CONTRACT},
    ),
    "revenue": Constraints(
        ["contract_code", "reference_month", "measurement_number"],
        checks=not_negative("contracted_amount", "additional_services", "reimbursements", "commercial_discounts", "deductions", "penalties", "invoiced_amount", "received_amount"),
        unique={"one row per measurement": ["contract_key", "date_key", "measurement_number"]},
        references={"day exists": day("date_key"), "contract exists": CONTRACT},
        required=["contract_key", "date_key"],
    ),
    "cost": Constraints(
        ["contract_code", "reference_month", "cost_category"],
        checks=one_of("entry_type", "DEBIT", "REVERSAL") | {
            "sign follows the entry": "(entry_type = 'DEBIT' AND actual_amount >= 0) OR (entry_type = 'REVERSAL' AND actual_amount <= 0)",
        },
        references={"day exists": day("date_key"), "contract exists": CONTRACT, "unit exists": Reference(["unit_code"], "units")},
        required=["contract_key", "date_key", "unit_code"],
    ),
    "operation": Constraints(
        ["contract_code", "unit_code", "role_code", "reference_month"],
        checks=not_negative("planned_positions", "filled_positions", "planned_hours", "regular_hours", "overtime_hours", "absence_hours", "open_positions", "emergency_coverage_cost"),
        unique={"one row per unit, role and month": ["contract_key", "unit_code", "role_code", "date_key"]},
        references={"day exists": day("date_key"), "contract exists": CONTRACT, "unit exists": Reference(["unit_code"], "units")},
        required=["contract_key", "date_key", "unit_code", "role_code"],
    ),
    "incidents": Constraints(
        ["incident_number"],
        checks=one_of("severity", "LOW", "MEDIUM", "HIGH", "CRITICAL") | not_negative("agreed_deadline_hours", "deduction_amount", "penalty_amount", "emergency_cost") | {
            "closed after it was opened": "closed_at IS NULL OR closed_at >= opened_at",
        },
        unique={"one row per incident": ["incident_number"]},
        references={"opening day exists": day("opened_date_key"), "closing day exists": day("closed_date_key"), "contract exists": CONTRACT},
    ),
    "adjustments": Constraints(
        ["adjustment_number"],
        checks=not_negative("previous_amount", "approved_amount", "retroactive_amount"),
        unique={"one row per process": ["adjustment_number"], "one key per process": ["adjustment_key"]},
        references={
            "expected day exists": day("expected_date_key"), "requested day exists": day("requested_date_key"),
            "approved day exists": day("approved_date_key"), "contract exists": CONTRACT,
        },
    ),
}
