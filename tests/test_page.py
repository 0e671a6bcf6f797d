from datetime import date

import pytest

from registria.plans import page
from registria.plans.resolve import Registry
from workloads import adapters

SF_DIR = "/root/testdata/sf0.01"
RANGE = ("1997-01-01", "1998-12-31")


@pytest.fixture(scope="module")
def registry(spark):
    return Registry(**{
        name: getattr(adapters, source)(spark, SF_DIR)
        for name, source in {
            "fact": "estabelecimento", "empresas": "empresas", "simples": "simples",
            "natureza_juridica": "natureza_juridica", "municipio": "municipio",
        }.items()
    })


def test_page_of_a_selection(registry):
    frames = page.geography(registry, *RANGE, selected=["sp", "RJ"], yearly=("1990-01-01", "2000-12-31"))
    found = {name: df.collect() for name, df in frames.items()}
    assert page.missing_tables(registry) == []
    stock = {r["uf"]: r["qty"] for r in found["stock"]}
    assert found["kpis"][0]["establishments"] == stock["SP"] + stock["RJ"]
    assert {r["uf"] for r in found["state_summary"][:2]} == {"SP", "RJ"}
    assert len(found["openings_last_12mo"]) == 12 and len(found["openings_by_year"]) > 2
    assert sum(r["openings"] for r in found["openings_last_12mo"]) <= stock["RJ"]
    assert [r["uf"] for r in found["top5_concentration"]] == ["RJ"]
    assert found["top5_concentration"][0]["total"] <= stock["RJ"]
    coastal = found["coastal_inland"][0]
    assert coastal["coastal"] + coastal["inland"] == sum(stock.values())
    assert len(found["cities"]) == 15 and len(found["nature"]) == 8


def test_page_with_tables_missing(registry):
    bare = Registry(registry.fact, None, None, None, None)
    frames = page.geography(bare, *RANGE, selected=["SP"])
    assert page.missing_tables(bare) == ["empresas", "simples", "natureza_juridica", "municipio"]
    assert "top5_concentration" not in frames and frames["cities"].count() == 15
    assert {r["label"] for r in frames["nature"].collect()} == {"Active", "Inactive"}
    gap = {r["metric"]: r for r in frames["region_gap"].collect()}
    assert gap["avg_capital"]["gap"] == gap["mei_density"]["gap"] == 0 and gap["active_rate"]["first_value"] > 0
    assert "cities" not in page.geography(bare, *RANGE)
    with pytest.raises(ValueError):
        page.geography(Registry(None, None, None, None, None), *RANGE)


def test_yearly_range():
    assert page.yearly_range(date(2025, 3, 1)) == (date(2015, 3, 1), date(2025, 3, 1))
    assert page.yearly_range(date(2004, 2, 29)) == (date(2000, 2, 29), date(2004, 2, 29))
    assert page.yearly_range(date(2024, 2, 29))[0] == date(2014, 2, 28)
