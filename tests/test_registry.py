from datetime import date

import pytest

from censa.registry import groups as g
from censa.registry.schemas import default_groups, load_type_map, loader_types

VALID = {
    "base": "SIH",
    "group": "RD",
    "facilities": ["2077485", "2077493"],
    "fields": ["CNES", "ANO_CMPT"],
    "period_start": "11/2022",
    "period_end": "02/2023",
}


def test_hospital_request():
    request = g.Request(**VALID)
    assert request.months == [date(2022, 11, 1), date(2022, 12, 1), date(2023, 1, 1), date(2023, 2, 1)]
    assert request.target_table == "sih_rd" and len(request.states) == 27


def test_ambulatory_request():
    assert g.Request(**{**VALID, "base": "SIA", "group": "PA", "facilities": ["*"], "table_name": "mine"}).target_table == "mine"


@pytest.mark.parametrize(
    "change",
    [
        {"base": "CNES"},
        {"group": "PA"},
        {"period_start": "2022-01"},
        {"period_end": "13/2022"},
        {"facilities": []},
        {"facilities": ["123"]},
        {"facilities": ["20774a5"]},
        {"fields": []},
        {"states": ["XX"]},
        {"states": []},
    ],
)
def test_bad_requests(change):
    with pytest.raises(ValueError):
        g.Request(**{**VALID, **change})


def test_reversed_period_and_groups_without_columns_are_errors():
    with pytest.raises(ValueError, match="before it starts"):
        g.Request(**{**VALID, "period_start": "03/2023"})
    for base, group in (("SIH", "CH"), ("SIA", "PS"), ("SIA", "SAD")):
        with pytest.raises(ValueError, match="no declared columns"):
            g.Request(**{**VALID, "base": base, "group": group})


def test_group_lookup():
    assert g.group_info(" rd ")["table"] == "sih_aih_reduzida"
    assert g.group_info("AT")["table"] == "sia_apac_tratamento_dialitico"
    assert g.group_info("ZZ") == {}
    with pytest.raises(ValueError):
        g.group_types("ZZ")


def test_facility_columns():
    assert g.facility_column("sp") == "SP_CNES" and g.facility_column("AQ") == "AP_CODUNI"
    assert g.facility_column("AQ", {"AQ": "AP_CNSPCN"}) == "AP_CNSPCN"
    with pytest.raises(ValueError):
        g.facility_column("CH")


def test_group_checks():
    assert g.invalid_groups(["RD", "XX", "PA"], "SIH") == ["PA", "XX"]
    assert g.columns_declared("RD", ["CNES", "val_tot"]) and not g.columns_declared("RD", ["nope"])
    assert not g.columns_declared("ZZ", ["cnes"])


def test_declared_schemas():
    sizes = {code: len(info["columns"]) for code, info in default_groups().items()}
    assert sizes == {
        "RD": 113, "RJ": 91, "ER": 13, "SP": 36, "PA": 75, "BI": 38, "AB": 60, "ABO": 80, "ACF": 58, "AD": 48,
        "AM": 53, "AMP": 67, "AN": 62, "AQ": 76, "AR": 76, "ATD": 67,
    }
    assert default_groups()["AQ"]["columns"]["ap_obito"] == "BOOLEAN"
    assert default_groups()["AB"]["columns"]["ab_dtcirur"] == "CHAR(8)"
    assert loader_types("RD")["n_aih"] == "BIGINT" and loader_types("RD")["uf_zi"] == "INTEGER"
    assert loader_types("PA") == default_groups()["PA"]["columns"]


def test_type_map_file(tmp_path):
    path = tmp_path / "types.json"
    path.write_text('{"t": {"a": "CHAR(2)"}}')
    assert load_type_map(str(path)) == {"t": {"a": "CHAR(2)"}}
