import random
import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registria.functions import clean, formats, regions
from registria.sources.layouts import family_of, layout_of


def values(spark, expr, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


D = date(2024, 1, 5)
DATES = {
    "20240229": (date(2024, 2, 29), date(2024, 2, 29)),
    "2024-01-05": (D, D), "2024/01/05 ": (D, D), "2024010599": (D, None),
    "00000000": (None, None), "20231345": (None, None), "20230230": (None, None),
    "": (None, None), "0": (None, None), "abc": (None, None), "1024": (None, None), "2024-1-5": (None, None),
    "2024-01": (None, None), None: (None, None),
}


def test_dates(spark):
    assert values(spark, clean.parse_date_prefix8, DATES) == [p for p, _ in DATES.values()]
    assert values(spark, clean.parse_date_exact8, DATES) == [e for _, e in DATES.values()]


def test_dates_of_random_text(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("0000111222399-/. x\n\u0663") for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += [f"{rng.randrange(1900, 2100)}{rng.randrange(14):02}{rng.randrange(33):02}" for _ in range(2000)]

    def parse(text, lengths):
        digits = re.sub(r"[^0-9]", "", text)
        if len(digits) not in lengths:
            return None
        try:
            return date(int(digits[:4]), int(digits[4:6]), int(digits[6:8]))
        except ValueError:
            return None

    texts = [t for t in texts if not re.sub(r"[^0-9]", "", t).startswith("0000")]  # Python has no year 0
    assert values(spark, clean.parse_date_prefix8, texts) == [parse(t, range(8, 99)) for t in texts]
    assert values(spark, clean.parse_date_exact8, texts) == [parse(t, [8]) for t in texts]


def test_date_of_a_date_column(spark):
    assert values(spark, clean.parse_date_prefix8, [D, None], "date") == [D, None]


def test_date_class(spark):
    got = values(spark, clean.date_class, ["20240229", "", "0", None, "--", "00000000", "2024010599"])
    assert got == ["valid", "empty", "empty", "empty", "empty", "garbage", "garbage"]


@pytest.mark.parametrize("expr, cases", [
    (clean.norm_uf, {" sp ": "SP", "Sp": "SP", "": "", None: None}),
    (clean.norm_code4, {"206-2": "2062", "20622": "2062", "62": "0062", "": None, "abc": None, None: None}),
    (clean.norm_status, {"2": "02", " 02": "02", "": "00", "123": "12", None: ""}),
    (clean.parse_capital, {"1000,50": Decimal("1000.50"), "": None, "x": None, "7": Decimal("7.00"), None: None}),
    (clean.size_bucket, {"01": "micro", "ME": "micro", "2 ": "small", "3": "medium", "05": "large", "9": None, None: None}),
    (clean.cnae_division, {"47.1-200": "47", "7": None, "": None, None: None}),
    (clean.strip_nul, {"a\x00b\x00": "ab", "": "", None: None}),
    (clean.or_missing, {"x": "x", "": "", None: "Unknown"}),
    (clean.is_blank, {"x": False, "  ": True, "": True, None: True}),
    (clean.to_number, {"1.5": 1.5, "x": 0.0, "nan": 0.0, None: 0.0}),
    (clean.status_label, {"02": "Active", "08": "Inactive", None: "Inactive"}),
    (regions.region_of, {"SP": "SE", "RO": "N", "EX": None, None: None}),
    (regions.is_coastal, {"sp": True, "SP": True, "MG": False, "EX": False, None: False}),
])
def test_text_rules(spark, expr, cases):
    assert values(spark, expr, cases) == list(cases.values())


def test_formats(spark):
    assert values(spark, formats.fmt_num, [1234567.9, -1234.5, 0.0, float("nan"), None], "double") == ["1.234.567", "-1.234", "0", "—", "—"]
    assert values(spark, formats.fmt_money, [1234.5, 0.0, None], "double") == ["R$ 1 234,50", "R$ 0,00", "—"]
    assert values(spark, formats.fmt_percent, [12.5, 0.0], "double") == ["12.50%", "0.00%"]
    assert values(spark, formats.tick, [True, False], "boolean") == ["✓", ""]


def test_region_maps_are_whole():
    states = [s for group in regions.REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27
    assert set(regions.COASTAL_STATES) <= set(states) and len(regions.COASTAL_STATES) == 17


LAYOUTS = {
    "Empresas0_K3241.K03200Y0.D50308.EMPRECSV.csv": "empresas",
    "/in/x/Socios1_K3241.SOCIOCSV.csv": "socios_original",
    "Naturezas_F.NATJUCSV.csv": "natureza_juridica",
    "Paises_F.PAISCSV.csv": "pais",
    "Qualificacoes_QUALSCSV.csv": "qualificacao_socio",
    "cnaes_secundarias.csv": "cnae",
    "Simples_F.csv": "simples",
    "/estabelecimento/foo.csv": None,
    "Estabelecimentos0_K.ESTABELE.csv": "estabelecimento",
    "x.MOTICCSV.csv": "motivo",
    "Municipios_F.MUNICCSV.csv": "municipio",
    "trailer.csv": "trailler",
    "Cabecalho.csv": "header",
    None: None,
}


def test_layout_of(spark):
    assert values(spark, layout_of, LAYOUTS) == list(LAYOUTS.values())


def test_family_of(spark):
    names = ["Estabelecimentos0.zip", "http://x/empresas/Socios1.zip", "Qualificacoes.zip", "readme.zip"]
    assert values(spark, family_of, names) == ["estabelecimento", "socios_original", "qualificacao_socio", None]
