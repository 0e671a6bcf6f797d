"""Operators against plain Python on small inputs, hot keys included."""

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from registria.operators import (
    city_reports, company_reports, joins, quality, quantile, ranking, scope, sets, state_reports,
)
from registria.plans import products


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def registry(spark):
    """Establishments where one state, one city and one company hold a third of the rows."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        rows.append((
            "hot" if hot else f"c{rng.randrange(80)}",
            rng.choice(["SP", " sp"]) if hot else rng.choice(["RJ", "AM", "rs", "", None, "EX"]),
            "7107" if hot else rng.choice(["0001", " 0002", "0003", "0099", "", None]),
            rng.choice(["2", "02", "08", None]),
            rng.choice(["19980105", "1998-12-31", "19970101", "20010101", "00000000", "", None]),
            rng.choice(["4711", "62", "7", None]),
        ))
    schema = ("cnpj_basico string, uf string, municipio string, situacao_cadastral string,"
              " data_inicio_atividades string, cnae_fiscal string")
    return rows, spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def masters(spark):
    """Company master and tax regime with the hot company listed many times."""
    rng = random.Random(8)
    emp = [("hot", rng.choice(["2062", "206-2", None]), rng.choice(["10,5", "20", "x", ""]), rng.choice(["01", "2 ", "05"]))
           for _ in range(60)]
    emp += [(f"c{i}", "2135", f"{i * 10},00", "03") for i in range(0, 80, 2)]
    simples = [("hot", rng.choice("SN")) for _ in range(40)] + [(f"c{i}", "S") for i in range(0, 80, 3)]
    return (
        emp, spark.createDataFrame(emp, "cnpj_basico string, natureza_juridica string, capital_social string, porte_empresa string"),
        simples, spark.createDataFrame(simples, "cnpj_basico string, opcao_mei string"),
    )


START, END = "1997-01-01", "1998-12-31"
KNOWN = {"19980105": date(1998, 1, 5), "1998-12-31": date(1998, 12, 31), "19970101": date(1997, 1, 1), "20010101": date(2001, 1, 1)}


def in_range(rows):
    low, high = date.fromisoformat(START), date.fromisoformat(END)
    return [r for r in rows if low <= KNOWN.get(r[4], date.min) <= high]


def state(row):
    return None if row[1] is None else row[1].strip().upper()


def test_stock(registry):
    rows, fact = registry
    want = Counter(state(r) for r in in_range(rows) if state(r))
    got = tuples(state_reports.uf_stock(fact, START, END))
    assert dict(got) == want
    assert [q for _, q in got] == sorted(want.values(), reverse=True)


def test_spine_always_has_twelve_rows(registry):
    rows, fact = registry
    got = tuples(state_reports.openings_last_12mo(fact, "sp", "1998-12-02"))
    assert len(got) == 12 and got[0][0] == date(1998, 1, 1)
    # the whole last month counts, past the day of the end date
    assert got[-1][1] == sum(state(r) == "SP" and r[4] == "1998-12-31" for r in rows)
    assert all(n == 0 for _, n in tuples(state_reports.openings_last_12mo(fact, "XX", "1998-12-02")))


def test_status_sums_to_range(registry):
    rows, fact = registry
    got = dict(tuples(state_reports.status_share(fact, None, START, END)))
    assert sum(got.values()) == len(in_range(rows))
    assert got["Active"] == sum((r[3] or "").zfill(2) == "02" for r in in_range(rows))


def test_missing_dimensions_give_none(registry):
    _, fact = registry
    assert company_reports.enterprise_profile(fact, None, None, "SP", START, END) is None
    assert city_reports.top5_concentration(fact, None, START, END) is None


def test_years_limit_keeps_oldest(registry):
    _, fact = registry
    assert [y for y, _ in tuples(state_reports.openings_by_year(fact, None, "1990-01-01", "2030-01-01", 2))] == [1997, 1998]


def test_activity_column_fallback(spark, registry):
    _, fact = registry
    assert scope.activity_column(fact.withColumn("cnae_fiscal_principal", F.lit("01"))) == "cnae_fiscal_principal"
    assert state_reports.cnae_profile(fact.drop("cnae_fiscal"), "SP", START, END) is None


def test_left_join_keeps_fan_out(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("z", 4), (None, 5)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("a", 20), ("a", 30), ("b", 40), (None, 50)], "k string, y int")
    want = left.join(right, "k", "left")
    assert sorted(tuples(joins.left_join(left, right, "k")), key=repr) == sorted(tuples(want), key=repr)


def legal_nature_brute(rows, emp, dim, top_n=8):
    code = lambda v: None if v is None else "".join(c for c in v if c.isdigit())[:4].zfill(4) or None
    counts = Counter()
    for company in {r[0] for r in in_range(rows)}:
        for master in [e for e in emp if e[0] == company] or [(company, None, None, None)]:
            names = [d[1] for d in dim if master[1] and code(d[0]) == code(master[1])] or [None]
            for name in names:
                counts[name or "Unknown"] += 1
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]


def test_legal_nature_fans_out_on_duplicates(spark, registry, masters):
    rows, fact = registry
    emp, empresas, _, _ = masters
    dim = [("206-2", "LTDA"), ("2062", "LTDA again"), ("2135", "MEI"), ("2135", None)]
    natureza = spark.createDataFrame(dim, "codigo string, descricao string")
    got = tuples(company_reports.legal_nature_share(fact, empresas, natureza, None, START, END))
    assert got == legal_nature_brute(rows, emp, dim)
    assert company_reports.legal_nature_share(fact, None, natureza, None, START, END) is None


def money(text):
    try:
        return float(text.replace(",", "."))
    except (AttributeError, ValueError):
        return None


def test_enterprise_profile_multiplies_duplicates(registry, masters):
    rows, fact = registry
    emp, empresas, simples, regime = masters
    scoped = {r[0] for r in in_range(rows) if state(r) == "SP"}
    sizes = {"01": "micro", "2": "small", "03": "medium", "05": "large"}
    for table, frame in ((simples, regime), (None, None)):
        n = mei = 0
        caps, buckets = [], Counter()
        for company in scoped:
            for master in [e for e in emp if e[0] == company] or [(company, None, None, None)]:
                for flag in [s[1] for s in table or [] if s[0] == company] or [None]:
                    n += 1
                    mei += flag == "S"
                    buckets[sizes.get((master[3] or "").strip())] += 1
                    caps += [money(master[2])] if money(master[2]) is not None else []
        got = company_reports.enterprise_profile(fact, empresas, frame, "SP", START, END).first()
        assert (got["n_emp"], got["n_mei"]) == (n, mei)
        assert got["avg_cap_raw"] == pytest.approx(np.mean(caps))
        assert [got[s] for s in ("micro", "small", "medium", "large")] == [buckets[s] for s in ("micro", "small", "medium", "large")]


def test_mei_density(registry, masters):
    rows, fact = registry
    _, _, simples, regime = masters
    mei, total = Counter(), Counter()
    region = {"SP": "SE", "RJ": "SE", "AM": "N", "RS": "S"}
    for uf, company in {(state(r), r[0]) for r in in_range(rows)}:
        for flag in [s[1] for s in simples if s[0] == company] or [None]:
            if uf in region:
                total[region[uf]] += 1
                mei[region[uf]] += flag == "S"
    got = {r["region"]: (r["mei"], r["total"]) for r in company_reports.region_mei_density(fact, regime, START, END).collect()}
    assert got == {k: (mei[k], total[k]) for k in total}
    assert {r["mei"] for r in company_reports.region_mei_density(fact, None, START, END).collect()} == {0}


def test_winsorized_capital(registry, masters):
    rows, fact = registry
    emp, empresas, _, _ = masters
    caps = {}
    for r in in_range(rows):
        for master in [e for e in emp if e[0] == r[0]]:
            if money(master[2]) is not None and state(r) is not None:
                caps.setdefault(state(r), []).append(money(master[2]))
    got = {r["uf"]: r for r in company_reports.winsorized_capital(fact, empresas, START, END).collect()}
    assert set(got) == set(caps)
    for uf, values in caps.items():
        p90 = np.percentile(values, 90)
        assert got[uf]["n"] == len(values)
        assert got[uf]["p90"] == pytest.approx(p90)
        assert got[uf]["avg_cap_w"] == pytest.approx(np.minimum(values, p90).mean())


@pytest.mark.parametrize("q", ["0.99995", "0.00", "0.50", "0.90", "1.00"])
def test_percentile_of_any_amount(spark, q):
    rng = random.Random(3)
    values = {
        "one": [Decimal("5.00")],
        "small": [Decimal(rng.randrange(1000)) / 100 for _ in range(200)],
        "signed": [Decimal(rng.randrange(-10**6, 10**6)) / 100 for _ in range(101)],
        "ends": [Decimal("-999999999999999999.99"), Decimal("-0.01"), Decimal("0.00"), Decimal("999999999999999999.99")],
        "wide": [Decimal(rng.randrange(10 ** rng.randrange(1, 17))) / 100 for _ in range(300)],
    }
    hist = [(g, v, n) for g, vs in values.items() for v, n in Counter(vs).items()]
    df = spark.createDataFrame(hist, "g string, v decimal(20,2), n long")
    for row in quantile.weighted_percentile(df, "g", "v", "n", q).collect():
        want = np.percentile([float(v) for v in values[row["g"]]], float(q) * 100)
        assert row["p"] == pytest.approx(want) and row["rows"] == len(values[row["g"]])


def test_percentiles_of_a_state_with_most_amounts(spark):
    """All q at once; one state holds most rows, and one range of amounts most of these."""
    rng = random.Random(11)
    values = {
        "SP": [Decimal(rng.choice([rng.randrange(1000000, 1000010), 500, rng.randrange(10**9)])) / 100 for _ in range(3000)],
        "AC": [Decimal(7)] * 3,
    }
    hist = [(g, v, n) for g, vs in values.items() for v, n in Counter(vs).items()]
    df = spark.createDataFrame(hist, "g string, v decimal(20,2), n long")
    qs = ["0.1", "0.5", "0.9", "0.90"]
    got = {(r["g"], r["q"]): (r["rows"], r["p"]) for r in quantile.weighted_percentiles(df, "g", "v", "n", qs).collect()}
    assert set(got) == {(g, q) for g in values for q in qs}
    for (g, q), (rows, p) in got.items():
        assert rows == len(values[g]) and p == pytest.approx(np.percentile([float(v) for v in values[g]], float(q) * 100))
    assert quantile.weighted_percentiles(df.where("false"), "g", "v", "n", qs).count() == 0
    with pytest.raises(ValueError):
        quantile.weighted_percentiles(df, "g", "v", "n", ["1.5"])


def test_amount_ranges_never_fall(spark):
    cents = sorted({s * (10**e + d) for e in range(18) for d in (-1, 0, 1, 7) for s in (-1, 1)})
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "v decimal(20,2)")
    got = [r[0] for r in df.select(quantile.amount_range(F.col("v"))).collect()]
    assert got == sorted(got) and len(set(got)) > 60


def test_row_numbers_with_hot_group_and_ties(spark):
    rng = random.Random(5)
    rows = [("SP" if i % 3 else rng.choice(["RJ", None]), f"city{i:04}", rng.randrange(4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "uf string, city string, qty long").repartition(6)
    got = tuples(ranking.row_number_all(df, "uf", [F.desc("qty"), F.col("city")]))
    want, seen = [], Counter()
    for uf, city, qty in sorted(rows, key=lambda r: (str(r[0]), -r[2], r[1])):
        seen[uf] += 1
        want.append((uf, city, qty, seen[uf]))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_city_reports(spark, registry):
    rows, fact = registry
    dim = [("7107", "SAO PAULO"), ("0001", "A"), ("0001 ", "A"), ("0002", ""), ("0003", None)]
    municipio = spark.createDataFrame(dim, "codigo string, descricao string")
    want = Counter()
    for r in in_range(rows):
        for code, name in dim:
            if name and (r[2] or "").strip() == code.strip() and r[2] is not None:
                want[state(r), name] += 1
    got = {(r["uf"], r["municipio"]): r["qty"] for r in city_reports.city_counts(fact, municipio, None, START, END).collect()}
    assert got == want
    assert tuples(city_reports.city_ranking(fact, municipio, " sp ", START, END)) == [("SAO PAULO", want["SP", "SAO PAULO"])]
    raw = tuples(city_reports.city_ranking(fact, None, "SP", START, END, 0))
    assert raw == [("7107", want["SP", "SAO PAULO"])]
    # raw keys: no trimming, and an empty name is a name
    raw_counts = city_reports.city_counts(fact, municipio, None, START, END, trimmed=False)
    assert {r["municipio"] for r in raw_counts.collect()} <= {"SAO PAULO", "A", ""}
    for r in city_reports.top5_concentration(fact, municipio, START, END).collect():
        assert 0 < r["top5"] <= r["total"]


def test_kpis_and_scale(spark):
    stock = spark.createDataFrame([("SP", 5), ("RJ", 5), ("AM", 2), ("EX", 1)], "uf string, qty long")
    assert tuples(state_reports.kpi_totals(stock)) == [(13, "RJ", 5)]
    assert tuples(state_reports.kpi_totals(stock, ["am", "ex"])) == [(3, "AM", 2)]
    assert tuples(state_reports.coastal_inland(stock)) == [(10, 3)]
    assert tuples(state_reports.value_range(stock)) == [(1, 5)]
    assert tuples(state_reports.value_range(stock.where("uf = 'EX'"))) == [(0, 2)]
    assert tuples(state_reports.value_range(stock.where("qty < 0"))) == [(0, 1)]


def test_empty_input_gives_zero_not_null(registry, masters):
    _, fact = registry
    none = fact.where("false")
    assert tuples(state_reports.active_rate(none, START, END)) == [(0, 0, 0.0)]
    assert tuples(quality.data_quality(none)) == [(0, 0, 0, 0)]
    assert tuples(quality.coverage_pct(quality.data_quality(none))) == [(0.0, 0.0, 0.0)]
    assert tuples(quality.last_available_month(none)) == [(None,)]
    gap = company_reports.region_gap(none, None, None, START, END).collect()
    assert len(gap) == 3 and all(r["gap"] == 0 for r in gap)


def test_state_summary_filters(spark):
    stock = spark.createDataFrame([("SP", 50), ("RJ", 30), ("RS", 30), ("EX", 0)], "uf string, qty long")
    assert [r["uf"] for r in products.state_summary(stock, ["rj"]).collect()] == ["RJ", "SP", "RS", "EX"]
    assert [r["rank"] for r in products.state_summary(stock).collect()] == [1, 2, 2, 3]
    assert [r["uf"] for r in products.state_summary(stock, ["RJ", "SP"], only_selected=True, top_n=1).collect()] == ["SP"]
    only = products.state_summary(stock, region="S", search=" rs ").collect()
    assert [(r["uf"], r["rank"], r["share_percent"]) for r in only] == [("RS", 2, 27.27)]
    assert [r["share_percent"] for r in products.state_summary(stock.where("qty = 0")).collect()] == [0.0]


def test_city_rank_after_search_and_cut(spark):
    cities = spark.createDataFrame([("Aa", 9), ("Ab", 9), ("Ba", 8), ("aC", 7)], "municipio string, qty long")
    assert tuples(city_reports.city_rank(cities, "^a", 3)) == [(1, "Aa", 9), (1, "Ab", 9), (2, "aC", 7)]
    assert tuples(city_reports.top_city_share(cities.where("qty < 9"))) == [(15, "Ba", 8, 8 / 15 * 100)]


def test_sets(spark):
    df = spark.createDataFrame([("Sp", 3), ("SP", 1), ("sp", 2), ("RJ", 4)], "k string, p int")
    assert sorted(tuples(sets.first_of_each(df, "k", "p"))) == [("RJ", 4), ("SP", 1)]
    a, b = df.select("k"), df.where("p > 2").select("k")
    assert sorted(tuples(sets.added(a, b))) == [("SP",), ("sp",)]
    assert sets.union_parts(df, df.select("p", "k")).count() == 8


def test_violations(spark):
    df = spark.createDataFrame([("00000001", "A", "20 "), (None, None, "2000"), ("1", "B", "2")], "k string, n string, w string")
    assert dict(tuples(quality.violations(df, ["k", "n"], {"w": 2}))) == {"null:k": 1, "null:n": 1, "length:w": 1}
    sound, rest = quality.split_sound(df, ["k", "n"], {"w": 2})
    assert sound.count() == 2 and rest.first()["reasons"] == ["null:k", "null:n", "length:w"]


@pytest.mark.parametrize("end, first, last", [
    ("1998-12-02", date(1998, 1, 1), date(1998, 12, 31)),
    ("2024-02-29", date(2023, 3, 1), date(2024, 2, 29)),
    (date(2023, 1, 31), date(2022, 2, 1), date(2023, 1, 31)),
])
def test_last_months(end, first, last):
    assert scope.last_months(end, 12) == (first, last)


def test_default_range():
    assert scope.default_range(date(2025, 1, 1)) == (date(2024, 1, 7), date(2025, 1, 1))


def test_range_of_text_and_of_dates_agree(spark):
    texts = ["19961231", "19970101", "1998-06-30", "19981231", "19990101", "0", None]
    staged = spark.createDataFrame([(t,) for t in texts], "data_inicio_atividades string")
    stored = staged.select(scope.clean.parse_date_exact8("data_inicio_atividades").alias("data_inicio_atividades"))
    for bounds, n in ((("1997-01-01", "1998-12-31"), 3), (("1998-12-31", "1998-12-31"), 1), (("1999-01-01", "1996-12-31"), 5)):
        for df in (staged, stored):
            assert scope.in_range(scope.prepare_fact(df), *bounds).count() == n


def test_search_and_range(spark):
    df = spark.createDataFrame([("São Paulo", date(2020, 1, 1)), (None, date(2020, 1, 2)), ("Rio", None)], "c string, dt date")
    assert scope.text_search(df, "c", "PAULO").count() == 1
    assert scope.text_search(df, "c", "  ").count() == 3
    assert scope.in_range(df, "2020-01-02", "2020-01-01").count() == 2
    assert scope.clean_states([" sp", "SP", None, "", "rj "]) == ["SP", "RJ"]
    assert scope.in_states(df, [" "], "c").count() == 3
