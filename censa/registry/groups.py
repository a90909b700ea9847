"""Record groups, states and facility columns, and the argument checks built on them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from censa.registry.schemas import default_groups

# Group code -> description.
GROUP_DESCRIPTIONS = {
    "AB": "APAC_de_Cirurgia_Bariatrica",
    "ABO": "APAC_de_Acompanhamento_Pos_Cirurgia_Bariatrica",
    "ACF": "APAC_de_Confeccao_de_Fistula",
    "AD": "APAC_de_Laudos_Diversos",
    "AM": "APAC_de_Medicamentos",
    "AMP": "APAC_de_Acompanhamento_Multiprofissional",
    "AN": "APAC_de_Nefrologia",
    "AQ": "APAC_de_Quimioterapia",
    "AR": "APAC_de_Radioterapia",
    "ATD": "APAC_de_Tratamento_Dialitico",
    "BI": "Boletim_de_Producao_Ambulatorial_individualizado",
    "IMPBO": "IMPBO",
    "PA": "Producao_Ambulatorial",
    "PAM": "PAM",
    "PAR": "PAR",
    "PAS": "PAS",
    "PS": "RAAS_Psicossocial",
    "SAD": "RAAS_de_Atencao_Domiciliar",
    "RD": "AIH_Reduzida",
    "RJ": "AIH_Rejeitada",
    "ER": "AIH_Rejeitada_com_erro",
    "SP": "Servicos_Profissionais",
    "CH": "Cadastro_Hospitalar",
    "CM": "CM",
    "DC": "Dados_Complementares",
    "EE": "Estabelecimento_de_Ensino",
    "EF": "Estabelecimento_Filantropico",
    "EP": "Equipes",
    "EQ": "Equipamentos",
    "GM": "Gestao_Metas",
    "HB": "Habilitacao",
    "IN": "Incentivos",
    "LT": "Leitos",
    "PF": "Profissional",
    "RC": "Regra_Contratual",
    "SR": "Servico_Especializado",
    "ST": "Estabelecimentos",
}

# IBGE state code -> abbreviation.
STATE_CODES = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA",
    "31": "MG", "32": "ES", "33": "RJ", "35": "SP",
    "41": "PR", "42": "SC", "43": "RS",
    "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}
STATES = sorted(STATE_CODES.values())

# The two source systems and the groups each one publishes.
BASES = {
    "SIH": ["RD", "RJ", "ER", "SP", "CH"],
    "SIA": ["PA", "BI", "AB", "ABO", "ACF", "AD", "AM", "AMP", "AN", "AQ", "AR", "ATD", "PS", "SAD"],
}

# The column that holds the seven-digit facility code.  The authorisation groups
# also carry a patient card number, which never matches a facility code.
FACILITY_COLUMNS = {
    "RD": "CNES",
    "RJ": "CNES",
    "ER": "CNES",
    "SP": "SP_CNES",
    "PA": "PA_CODUNI",
    "BI": "CODUNI",
    **{g: "AP_CODUNI" for g in ["AB", "ABO", "ACF", "AD", "AM", "AMP", "AN", "AQ", "AR", "ATD"]},
}

ALL_FACILITIES = ["*"]


def facility_column(group: str, overrides: dict[str, str] | None = None) -> str:
    """The facility column of ``group``; ``overrides`` replaces registry entries."""
    columns = {**FACILITY_COLUMNS, **(overrides or {})}
    if group.upper() not in columns:
        raise ValueError(f"group {group} has no facility column")
    return columns[group.upper()]


def group_info(group: str, groups: dict[str, dict] | None = None) -> dict:
    """Exact group, else the first group whose code starts with the given one, else empty."""
    groups = default_groups() if groups is None else groups
    wanted = group.strip().upper()
    if wanted in groups:
        return groups[wanted]
    return next((info for code, info in groups.items() if code.startswith(wanted)), {})


def group_types(group: str) -> dict[str, str]:
    """Column types of a group; an unknown group is an error."""
    groups = default_groups()
    if group not in groups:
        raise ValueError(f"unknown group {group}")
    return groups[group]["columns"]


def parse_period(text: str) -> date:
    """First day of the month written as ``MM/YYYY``."""
    match = re.fullmatch(r"(0?[1-9]|1[0-2])/(\d{4})", text)
    if not match:
        raise ValueError(f"period {text!r} is not MM/YYYY")
    return date(int(match.group(2)), int(match.group(1)), 1)


def invalid_groups(groups: Sequence[str], base: str) -> list[str]:
    """Groups the source system does not publish."""
    return sorted(set(groups) - set(BASES.get(base, [])))


def columns_declared(group: str, columns: Sequence[str]) -> bool:
    """Whether every column belongs to the declared schema of the group."""
    declared = group_info(group).get("columns", {}) if group in default_groups() else {}
    return bool(declared) and all(c.lower() in declared for c in columns)


@dataclass
class Request:
    """Checked arguments of an extraction."""

    base: str
    group: str
    facilities: list[str]
    fields: list[str]
    period_start: str
    period_end: str
    states: list[str] = field(default_factory=lambda: list(STATES))
    table_name: str | None = None

    def __post_init__(self) -> None:
        if self.base not in BASES:
            raise ValueError(f"base must be one of {sorted(BASES)}")
        if self.group not in BASES[self.base]:
            raise ValueError(f"group {self.group} is not published by {self.base}")
        if self.group not in default_groups() or self.group not in FACILITY_COLUMNS:
            raise ValueError(f"group {self.group} has no declared columns to extract")
        if not self.facilities or not self.fields:
            raise ValueError("facilities and fields must not be empty")
        if self.facilities != ALL_FACILITIES:
            bad = [f for f in self.facilities if not re.fullmatch(r"[0-9]{7}", f)]
            if bad:
                raise ValueError(f"facility codes must be seven digits or '*': {bad}")
        unknown = sorted(set(self.states) - set(STATES))
        if unknown or not self.states:
            raise ValueError(f"unknown states: {unknown}")
        if parse_period(self.period_end) < parse_period(self.period_start):
            raise ValueError(f"the period ends ({self.period_end}) before it starts ({self.period_start})")

    @property
    def months(self) -> list[date]:
        """Every month of the period, both ends included."""
        first, last = parse_period(self.period_start), parse_period(self.period_end)
        count = (last.year - first.year) * 12 + last.month - first.month + 1
        return [
            date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1)
            for i in range(count)
        ]

    @property
    def target_table(self) -> str:
        return self.table_name or f"{self.base}_{self.group}".lower()
