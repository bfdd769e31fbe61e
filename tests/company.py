"""A small company: dimensions, six raw files, templates and plan rules.

The amounts, dates and counts that decide the expected actions are fixed
values; names and the cost file are our own.
"""

from __future__ import annotations

import os
from decimal import Decimal


PERIOD = "2025-01-01"

# Fixed values.
CLIENTS = [(f"C{i:03d}", f"Cliente {i}", "SEGMENTO") for i in range(1, 9)]
UNIT_CLIENT = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 8}
UNITS = [(f"U{u:03d}", f"C{c:03d}") for u, c in UNIT_CLIENT.items()]
SERVICES = [(s, s.title()) for s in ("LIMPEZA", "PORTARIA", "RECEP", "MANUT", "APOIO", "FACINT")]
MANAGERS = [(f"G{i:03d}", f"Gestor {i}") for i in range(1, 9)]
ROLES = [(r,) for r in ("AUX_LIMP", "PORT", "RECEP", "TEC_MANUT", "SUPERV", "ASSIST_ADM")]
# (group, category, subcategory, labor)
# Fixed values.
CATEGORIES = [
    ("Mão de obra", "Folha", "Salários", True),
    ("Mão de obra", "Encargos", "Encargos sociais", True),
    ("Mão de obra", "Benefícios", "Benefícios", True),
    ("Mão de obra", "Custos extraordinários", "Horas adicionais", True),
    ("Mão de obra", "Cobertura", "Cobertura emergencial", True),
    ("Operação", "Materiais", "Materiais de limpeza", False),
    ("Operação", "Equipamentos", "Manutenção de equipamentos", False),
    ("Operação", "Transporte", "Deslocamentos", False),
]
# Fixed values.
INCIDENT_TYPES = [
    ("Cobertura", "Posto descoberto", "Ausência"),
    ("Cobertura", "Atraso na substituição", "Equipe reduzida"),
    ("Qualidade", "Falha de limpeza", "Procedimento"),
    ("Manutenção", "Atraso no atendimento", "Escala"),
    ("Atendimento", "Solicitação", "Demanda pontual"),
]

# contract, client, unit, service, manager, billing, complexity, start, renewal, amount, positions, hours, target %, base month
# Fixed values.
CONTRACTS = [
    (1, 1, 1, "FACINT", 1, "Mensal fixo", "Alta", "01/01/2024", "31/12/2026", 580000, 82, 18040, "14,5%", 1),
    (2, 2, 2, "LIMPEZA", 2, "Mensal fixo", "Média", "15/02/2023", "14/02/2027", 210000, 28, 6160, "16,0%", 5),
    (3, 3, 3, "FACINT", 3, "Mensal fixo", "Alta", "2023-07-01", "2026-06-30", 320000, 40, 8800, "15,0%", 7),
    (4, 4, 4, "MANUT", 4, "Mensal fixo", "Alta", "01/04/2022", "31/03/2026", 460000, 60, 13200, "15,0%", 4),
    (5, 5, 5, "LIMPEZA", 5, "Por posto", "Alta", "10/09/2023", "09/09/2025", 128000, 16, 3520, "13,0%", 9),
    (6, 6, 6, "PORTARIA", 6, "Por posto", "Média", "01/11/2022", "31/10/2026", 185000, 24, 5280, "14,0%", 11),
    (7, 7, 7, "APOIO", 7, "Mensal fixo", "Baixa", "01/03/2024", "28/02/2027", 265000, 30, 6600, "15,0%", 3),
    (8, 8, 8, "RECEP", 8, "Mensal fixo", "Média", "01/09/2022", "31/08/2026", 410000, 52, 11440, "16,0%", 9),
    (9, 8, 9, "LIMPEZA", 1, "Mensal fixo", "Alta", "01/05/2024", "30/04/2027", 340000, 46, 10120, "15,0%", 5),
    (10, 8, 10, "FACINT", 2, "Mensal fixo", "Alta", "01/01/2023", "31/12/2026", 690000, 90, 19800, "14,0%", 1),
]

# contract -> (contracted, additional, reimbursed, discount, deduction, penalty)
# Fixed values.
MEASUREMENTS = {
    1: (580000, 12000, 1800, 0, 8000, 12000), 2: (210000, 0, 0, 0, 0, 0), 3: (320000, 0, 0, 0, 0, 0),
    4: (460000, 0, 0, 0, 9500, 22000), 5: (128000, 0, 0, 6000, 0, 2000), 6: (185000, 0, 0, 0, 0, 0),
    7: (265000, 0, 0, 0, 0, 0), 8: (410000, 0, 0, 0, 0, 0), 9: (340000, 0, 0, 0, 0, 0), 10: (690000, 15000, 3000, 0, 0, 0),
}
PERIOD_TEXT = {2: "2025-01", 3: "01/01/2025"}

# contract, role, planned, filled, headcount, planned h, regular h, overtime h, absence h, leave, hires, exits, open, replacement, coverage cost
# Fixed values.
WORKFORCE = [
    (1, "AUX_LIMP", 60, 52, 53, 13200, 12350, 950, 760, 14, 4, 6, 8, 38, 14000),
    (1, "TEC_MANUT", 14, 13, 13, 3080, 2890, 180, 140, 4, 1, 1, 1, 28, 3500),
    (1, "SUPERV", 8, 7, 7, 1760, 1620, 70, 80, 2, 0, 1, 1, 22, 2500),
    (2, "AUX_LIMP", 26, 26, 26, 5720, 5680, 140, 85, 2, 1, 1, 0, 12, 1000),
    (2, "SUPERV", 2, 2, 2, 440, 438, 20, 6, 0, 0, 0, 0, 0, 0),
    (3, "AUX_LIMP", 30, 33, 33, 6600, 7150, 320, 120, 2, 3, 1, 0, 8, 0),
    (3, "PORT", 10, 10, 10, 2200, 2250, 90, 40, 1, 1, 0, 0, 0, 0),
    (4, "TEC_MANUT", 52, 49, 49, 11440, 10780, 560, 340, 8, 2, 4, 3, 31, 7500),
    (4, "SUPERV", 8, 8, 8, 1760, 1740, 90, 80, 2, 0, 1, 0, 14, 1200),
    (5, "AUX_LIMP", 16, 14, 14, 3520, 3080, 180, 160, 5, 1, 2, 2, 29, 3800),
    (6, "PORT", 22, 22, 22, 4840, 4810, 80, 40, 1, 0, 0, 0, 0, 500),
    (6, "SUPERV", 2, 2, 2, 440, 438, 10, 4, 0, 0, 0, 0, 0, 0),
    (7, "ASSIST_ADM", 28, 28, 28, 6160, 6100, 60, 30, 1, 1, 1, 0, 9, 0),
    (7, "SUPERV", 2, 2, 2, 440, 440, 5, 2, 0, 0, 0, 0, 0, 0),
    (8, "RECEP", 48, 47, 47, 10560, 10300, 240, 160, 3, 1, 2, 1, 19, 2600),
    (8, "SUPERV", 4, 4, 4, 880, 870, 35, 10, 0, 0, 0, 0, 0, 0),
    (9, "AUX_LIMP", 42, 37, 38, 9240, 8250, 470, 320, 9, 2, 5, 4, 36, 8000),
    (9, "SUPERV", 4, 4, 4, 880, 860, 30, 40, 1, 0, 1, 0, 18, 2000),
    (10, "AUX_LIMP", 60, 58, 58, 13200, 12850, 420, 250, 5, 2, 3, 2, 21, 3500),
    (10, "PORT", 20, 20, 20, 4400, 4390, 120, 80, 2, 1, 0, 0, 0, 0),
    (10, "TEC_MANUT", 10, 9, 9, 2200, 2030, 160, 110, 3, 0, 1, 1, 24, 1800),
]

# contract, type, opened, closed, deadline h, severity, recurrent, deduction, penalty, emergency
# Fixed values.
INCIDENTS = [
    (1, 0, "03/01/2025 06:30", "03/01/2025 18:40", 8, "Alta", "Sim", 2000, 4000, 1200),
    (1, 1, "12/01/2025 07:10", "13/01/2025 11:30", 12, "Crítica", "Sim", 3500, 6000, 2500),
    (2, 2, "18/01/2025 09:00", "18/01/2025 13:20", 8, "Baixa", "Não", 0, 0, 0),
    (3, 4, "08/01/2025 10:00", "09/01/2025 16:00", 24, "Média", "Sim", 0, 0, 900),
    (4, 3, "04/01/2025 02:10", "05/01/2025 12:30", 6, "Crítica", "Sim", 2500, 8000, 4000),
    (4, 3, "11/01/2025 14:20", "13/01/2025 18:00", 12, "Alta", "Sim", 3000, 7000, 5500),
    (4, 3, "22/01/2025 08:00", "24/01/2025 17:30", 8, "Crítica", "Sim", 4000, 7000, 3000),
    (5, 0, "07/01/2025 08:00", "07/01/2025 19:00", 8, "Alta", "Não", 0, 2000, 1000),
    (6, 4, "15/01/2025 18:00", "15/01/2025 20:30", 4, "Baixa", "Não", 0, 0, 0),
    (7, 4, "09/01/2025 11:00", "09/01/2025 12:15", 4, "Baixa", "Não", 0, 0, 0),
    (8, 4, "20/01/2025 08:30", "20/01/2025 11:15", 4, "Média", "Não", 0, 0, 0),
    (9, 0, "06/01/2025 06:00", "06/01/2025 17:00", 8, "Alta", "Sim", 0, 0, 1500),
    (9, 2, "19/01/2025 07:00", "19/01/2025 20:20", 8, "Alta", "Sim", 0, 0, 1000),
    (10, 3, "26/01/2025 15:00", "26/01/2025 19:00", 8, "Média", "Não", 0, 0, 500),
    (10, 4, "29/01/2025 10:00", "29/01/2025 12:00", 4, "Baixa", "Não", 0, 0, 0),
]

# number, contract, type, expected, requested, approved, requested %, approved %, previous, approved amount, retroactive, amount, status
# Fixed values.
ADJUSTMENTS = [
    ("AJ-002", 2, "Reajuste", "15/05/2024", "10/05/2024", "20/01/2025", "6,50%", "6,00%", 198113.21, 210000, "Sim", 71320.74, "Aprovado"),
    ("AJ-008", 8, "Reajuste", "01/09/2024", "20/08/2024", "", "7,10%", "", 410000, None, "Não", 0, "Solicitado"),
    ("AJ-005", 5, "Renegociação", "10/09/2024", "15/08/2024", "", "18,00%", "", 128000, None, "Não", 0, "Pendente"),
    ("AJ-007", 7, "Reajuste", "01/03/2025", "20/01/2025", "", "5,20%", "", 265000, None, "Não", 0, "Solicitado"),
    ("AJ-010", 10, "Repactuação", "01/01/2025", "02/12/2024", "15/01/2025", "4,80%", "4,50%", 660287.08, 690000, "Sim", 29712.92, "Aprovado"),
]

# Our own cost file: contract -> (subcategory index, actual, budget, extraordinary) lines, 56 in all.
S, E, B, H, C, M, Q, D = range(8)
# Fixed values.
COSTS = {
    1: [(S, 300000, 295000, 0), (E, 130000, 128000, 0), (B, 48000, 47000, 0), (H, 38000, 18000, 1), (C, 24000, 9000, 1), (M, 15000, 15000, 0), (Q, 6000, 6000, 0)],
    2: [(S, 100000, 100000, 0), (E, 44000, 44000, 0), (B, 17000, 17000, 0), (M, 8000, 8500, 0), (H, 3000, 3000, 0)],
    3: [(S, 160000, 158000, 0), (E, 70000, 69000, 0), (B, 26000, 26000, 0), (H, 14000, 9000, 1), (M, 9000, 9000, 0), (C, 0, 1000, 0)],
    4: [(S, 210000, 208000, 0), (E, 92000, 91000, 0), (B, 35000, 35000, 0), (H, 21000, 12000, 1), (C, 12000, 6000, 1), (Q, 16000, 12000, 0)],
    5: [(S, 66000, 62000, 0), (E, 29000, 27000, 0), (B, 11000, 10500, 0), (H, 8000, 4000, 1), (C, 6000, 2500, 1), (D, 12000, 5000, 1)],
    6: [(S, 88000, 88000, 0), (E, 39000, 39000, 0), (B, 15000, 15000, 0), (H, 3000, 3000, 0), (Q, 11000, 11000, 0)],
    7: [(S, 118000, 120000, 0), (E, 52000, 53000, 0), (B, 20000, 20000, 0), (H, 2000, 3000, 0), (M, 8000, 8500, 0)],
    8: [(S, 205000, 200000, 0), (E, 90000, 88000, 0), (B, 33000, 32000, 0), (H, 7000, 6500, 0), (M, 12000, 12000, 0)],
    9: [(S, 172000, 168000, 0), (E, 76000, 74000, 0), (B, 28000, 27500, 0), (H, 17000, 9000, 1), (C, 11000, 5000, 1), (M, 9000, 9000, 0)],
    10: [(S, 350000, 350000, 0), (E, 154000, 154000, 0), (B, 57000, 57000, 0), (H, 16000, 15000, 0), (M, 22000, 22000, 0)],
}

# Fixed values.
EXPECTED_ACTIONS = {
    "CT-001": "REINFORCE_COVERAGE", "CT-002": "REVIEW_RETROACTIVE", "CT-003": "FORMALIZE_SCOPE",
    "CT-004": "SLA_RECOVERY_PLAN", "CT-005": "ASSESS_NON_RENEWAL", "CT-007": "EXPAND",
    "CT-008": "REQUEST_ADJUSTMENT", "CT-009": "REINFORCE_COVERAGE",
}


def code(n: int) -> str:
    return f"CT-{n:03d}"


def brl(v) -> str:
    if v is None:
        return ""
    text = f"{v:,.2f}".replace(",", "_").replace(".", ",").replace("_", ".")
    return f"R$ {text}"


def grouped(v: int) -> str:
    return f"{v:,}".replace(",", ".")


def raw_files() -> dict[str, list[list[str]]]:
    """Rows of each raw file; the last two of every file are invalid."""
    contracts = [
        [code(n), f"C{c:03d}", f"Cliente {c}", f"U{u:03d}", s, f"G{g:03d}", "Ativo", bill, cx, start, "", renew, brl(amount), str(p), grouped(h), target, str(m), "IPCA", "SP"]
        for n, c, u, s, g, bill, cx, start, renew, amount, p, h, target, m in CONTRACTS
    ]
    contracts.append(["", *contracts[0][1:]])
    contracts.append(["CT-099", "C999", "Cliente 999", "U999", "LIMPEZA", "G999", "Ativo", "Mensal fixo", "Média", "31/02/2024", "", "31/12/2026", "valor inválido", "-2", "abc", "150%", "13", "IPCA", "XX"])

    measurements = []
    for n, (a, extra, back, disc, ded, pen) in MEASUREMENTS.items():
        net = a + extra + back - disc - ded - pen
        measurements.append([code(n), PERIOD_TEXT.get(n, "01/2025"), f"MED-{n:03d}", *map(brl, (a, extra, back, disc, ded, pen, net, net)), "31/01/2025", "05/03/2025"])
    measurements.append(["CT-999", "01/2025", "MED-999", *map(brl, (100000, 0, 0, 0, 0, 0, 100000)), "", "31/01/2025", ""])
    measurements.append(["CT-001", "mês inválido", "MED-ERR", "valor inválido", *map(brl, (0, 0, 0, 0, 0, 0)), "", "31/01/2025", ""])

    costs = [
        [code(n), f"U{n:03d}", "01/2025", *CATEGORIES[k][:3], brl(actual), brl(budget), "folha", "Sim", "Sim" if extra else "Não", "Não", "Débito"]
        for n, lines in COSTS.items() for k, actual, budget, extra in lines
    ]
    costs.append(["CT-999", "U999", *costs[0][2:]])
    costs.append([*costs[0][:2], "99/2025", *costs[0][3:6], "abc", *costs[0][7:]])

    workforce = [
        [code(n), f"U{n:03d}", role, "01/2025", *map(str, (p, f, hc)), grouped(ph), grouped(rh), *map(str, (ot, ab, lv, hi, ex, op, rp)), brl(cc)]
        for n, role, p, f, hc, ph, rh, ot, ab, lv, hi, ex, op, rp, cc in WORKFORCE
    ]
    workforce.append(["CT-999", "U999", *workforce[0][2:]])
    workforce.append([*workforce[0][:3], "período inválido", *workforce[0][4:7], "abc", *workforce[0][8:]])

    incidents = [
        [f"INC-{i:04d}", code(n), f"U{n:03d}", *INCIDENT_TYPES[t], opened, closed, str(dl), sev, "Fechada", rec, *map(brl, (d, p, e))]
        for i, (n, t, opened, closed, dl, sev, rec, d, p, e) in enumerate(INCIDENTS, 1)
    ]
    incidents.append(["INC-9999", "CT-999", "U999", *incidents[0][3:]])
    incidents.append(["INC-ERR", *incidents[0][1:6], "10/01/2025 10:00", "09/01/2025 09:00", *incidents[0][8:]])

    adjustments = [
        [num, code(n), kind, exp, req, app, rp, ap, brl(prev), brl(new), retro, brl(amount), status, "Em análise"]
        for num, n, kind, exp, req, app, rp, ap, prev, new, retro, amount, status in ADJUSTMENTS
    ]
    adjustments.append(["AJ-999", "CT-999", *adjustments[1][2:]])
    adjustments.append(["AJ-ERR", "CT-001", "Reajuste", "data inválida", "", "", "abc", "", brl(580000), "", "Não", brl(0), "Pendente", ""])
    return {
        "contract_register": contracts, "monthly_measurements": measurements, "operational_costs": costs,
        "workforce_control": workforce, "sla_incidents": incidents, "contract_adjustments": adjustments,
    }


def write_files(folder: str) -> dict[str, str]:
    """Write the raw files (semicolon, BOM, header) and return their paths."""
    from contractlens.plans.staging import SOURCES
    from contractlens.sources.delimited import raw_columns

    paths = {}
    for name, lines in raw_files().items():
        paths[name] = os.path.join(folder, f"{name}.csv")
        with open(paths[name], "w", encoding="utf-8-sig", newline="") as out:
            for line in [raw_columns(SOURCES[name]), *lines]:
                out.write(";".join(line) + "\n")
    return paths


def dimensions(spark) -> dict:
    make = spark.createDataFrame
    return {
        "clients": make(CLIENTS, "client_code string, client_name string, business_segment string"),
        "units": make(UNITS, "unit_code string, client_code string"),
        "services": make(SERVICES, "service_code string, service_name string"),
        "managers": make(MANAGERS, "manager_code string, manager_name string"),
        "roles": make(ROLES, "role_code string"),
        "categories": make(CATEGORIES, "cost_group string, cost_category string, cost_subcategory string, is_labor_cost boolean"),
        "incident_types": make(INCIDENT_TYPES, "incident_category string, incident_subcategory string, root_cause string"),
    }


# --- history -------------------------------------------------------------------

FIRST_MONTH, MONTHS = "2024-07-01", 24
# Fixed values.
NORMAL_COST = {1: "1.0000", 2: "0.9400", 3: "0.9750", 4: "1.1000", 5: "1.1800", 6: "1.0150", 7: "0.9800", 8: "0.9950", 9: "1.1070", 10: "1.0430"}

# contract, first month, last month, values; later rules win per column.
# Fixed values.
PLAN_RULES = [
    (1, "2024-07-01", "2025-12-01", dict(coverage_rate="0.92", overtime_rate="0.08", vacancy_rate="0.08", overtime_factor="2.2", coverage_factor="3.2", incident_count=2, critical_incident_count=1, recurrent_incident_count=1, sla_miss_count=1, sla_financial_loss="8000", event_code="COVERAGE_DETERIORATION")),
    (1, "2026-01-01", "2026-06-01", dict(coverage_rate="0.97", overtime_rate="0.03", overtime_factor="1.2", event_code="COVERAGE_RECOVERY")),
    (2, "2024-07-01", "2024-12-01", dict(event_code="ADJUSTMENT_DELAY")),
    (3, "2025-07-01", "2025-11-01", dict(execution_overrun_rate="0.08", event_code="SCOPE_CREEP_HIGH")),
    (3, "2025-12-01", "2026-06-01", dict(additional_services="25000", execution_overrun_rate="0.02", event_code="SCOPE_FORMALIZED")),
    (4, "2025-01-01", "2025-07-01", dict(incident_count=3, critical_incident_count=2, recurrent_incident_count=2, sla_miss_count=2, sla_financial_loss="22000", other_cost_factor="1.3", event_code="SLA_CRITICAL")),
    (5, "2024-07-01", "2026-06-01", dict(commercial_discount_rate="0.045", labor_factor="1.12", overtime_factor="1.5", other_cost_factor="1.35", coverage_rate="0.9", overtime_rate="0.07", absenteeism_rate="0.04", vacancy_rate="0.08", replacement_days="30", incident_count=1, sla_miss_count=1, sla_financial_loss="1500", event_code="STRUCTURAL_DEFICIT")),
    (6, "2024-11-01", "2024-11-01", dict(one_time_extra_cost="48000", event_code="ONE_OFF_EVENT")),
    (7, "2024-07-01", "2026-06-01", dict(labor_factor="0.98", overtime_factor="0.8", coverage_rate="0.995", overtime_rate="0.01", incident_count=0, event_code="HEALTHY_REFERENCE")),
    (7, "2026-01-01", "2026-06-01", dict(contracted_amount="292000", position_factor="1.1", event_code="CONTROLLED_EXPANSION")),
    (8, "2024-07-01", "2026-06-01", dict(contracted_amount="410000", coverage_rate="0.98", overtime_rate="0.025", event_code="ADJUSTMENT_PENDING")),
    (9, "2026-01-01", "2026-06-01", dict(contracted_amount="375000", coverage_rate="0.89", overtime_rate="0.09", vacancy_rate="0.12", replacement_days="40", overtime_factor="2.2", coverage_factor="3", incident_count=2, critical_incident_count=1, recurrent_incident_count=1, sla_miss_count=1, sla_financial_loss="5000", event_code="WORKFORCE_CRITICAL")),
]
RULE_COLUMNS = {
    "contracted_amount": "decimal(18,2)", "additional_services": "decimal(18,2)", "execution_overrun_rate": "decimal(9,4)", "commercial_discount_rate": "decimal(9,4)", "labor_factor": "decimal(9,4)",
    "overtime_factor": "decimal(9,4)", "coverage_factor": "decimal(9,4)", "other_cost_factor": "decimal(9,4)",
    "position_factor": "decimal(9,4)", "coverage_rate": "decimal(9,4)", "overtime_rate": "decimal(9,4)",
    "absenteeism_rate": "decimal(9,4)", "vacancy_rate": "decimal(9,4)", "replacement_days": "decimal(10,2)",
    "incident_count": "int", "critical_incident_count": "int", "recurrent_incident_count": "int",
    "sla_miss_count": "int", "sla_financial_loss": "decimal(18,2)", "one_time_extra_cost": "decimal(18,2)",
    "event_code": "string",
}
# Fixed values.
EXPECTED_LAST_ACTIONS = {
    "CT-002": "MAINTAIN", "CT-005": "ASSESS_NON_RENEWAL", "CT-007": "EXPAND", "CT-008": "REQUEST_ADJUSTMENT",
    "CT-009": "REINFORCE_COVERAGE",
}
# contract, action, recommended, started, completed, status, estimate, actual, result
# Fixed values.
ACTION_EVENTS = [
    (2, "REVIEW_RETROACTIVE", "2025-01-20", "2025-01-20", "2025-02-10", "COMPLETED", "71320.74", "71320.74", "RECOVERED"),
    (4, "SLA_RECOVERY_PLAN", "2025-07-20", "2025-08-01", "2025-08-30", "COMPLETED", "65000", "51000", "IMPROVED"),
    (1, "REINFORCE_COVERAGE", "2025-12-15", "2026-01-01", "2026-03-31", "COMPLETED", "90000", "72000", "IMPROVED"),
    (8, "REQUEST_ADJUSTMENT", "2026-01-10", "2026-01-10", None, "IN_PROGRESS", "220000", None, "PENDING_CLIENT"),
]


def plan_rules(spark):
    rows = []
    for i, (n, first, last, values) in enumerate(PLAN_RULES, 1):
        cells = []
        for c, kind in RULE_COLUMNS.items():
            v = values.get(c)
            cells.append(Decimal(v) if v is not None and kind.startswith("decimal") else v)
        rows.append((i, code(n), first, last, *cells))
    typed = ", ".join(f"{c} {t}" for c, t in RULE_COLUMNS.items())
    return spark.createDataFrame(rows, f"rule_no int, contract_code string, first_month string, last_month string, {typed}").selectExpr(
        "rule_no", "contract_code", "cast(first_month as date) first_month", "cast(last_month as date) last_month", *RULE_COLUMNS
    )
