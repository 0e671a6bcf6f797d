"""Every registered query next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from registria.functions import clean, formats, regions
from registria.operators import city_reports, company_reports, joins, quality, ranking, scope, sets, state_reports
from registria.plans import products, publish
from registria.sources import layouts, links

from . import adapters

START, END, STATE = "1997-01-01", "1998-12-31", "SP"
RANGE = (START, END)
BETWEEN = f"dt between date '{START}' and date '{END}'"
SOME = ["sp", " RJ ", "MG", "SP"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The registry tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    @cached_property
    def fact(self) -> DataFrame:
        return adapters.estabelecimento(self.spark, self.sf_dir)

    @cached_property
    def emp(self) -> DataFrame:
        return adapters.empresas(self.spark, self.sf_dir)

    @cached_property
    def simples(self) -> DataFrame:
        return adapters.simples(self.spark, self.sf_dir)

    @cached_property
    def mun(self) -> DataFrame:
        return adapters.municipio(self.spark, self.sf_dir)

    @cached_property
    def nat(self) -> DataFrame:
        return adapters.natureza_juridica(self.spark, self.sf_dir)

    @property
    def stock(self) -> DataFrame:
        return state_reports.uf_stock(self.fact, *RANGE)


# ── SQL building blocks (DuckDB) ────────────────────────────────────────────

def _digits(col: str) -> str:
    return f"regexp_replace({col}, '\\D', '', 'g')"


def _prefix8(col: str) -> str:
    d = _digits(col)
    return f"case when length({d}) >= 8 then cast(try_strptime(substring({d}, 1, 8), '%Y%m%d') as date) end"


def _exact8(col: str) -> str:
    d = _digits(col)
    return f"case when length({d}) = 8 then cast(try_strptime({d}, '%Y%m%d') as date) end"


def _code4(col: str) -> str:
    d = _digits(col)
    return (f"case when length({d}) >= 4 then substring({d}, 1, 4)"
            f" when {d} <> '' then lpad({d}, 4, '0') end")


def _money(col: str) -> str:
    return f"try_cast(nullif(replace({col}, ',', '.'), '') as decimal(20,2))"


FACT = f"""select *, {_prefix8('data_inicio_atividades')} as dt, upper(trim(uf)) as uf_norm,
  trim(municipio) as mun_code, coalesce(lpad(trim(situacao_cadastral), 2, '0'), '') as status2
from estabelecimento"""
# Fixed values, written out so that the SQL does not follow the package's own maps.
REGIONS = """select * from (values
  ('RO', 'N'), ('AC', 'N'), ('AM', 'N'), ('RR', 'N'), ('PA', 'N'), ('AP', 'N'), ('TO', 'N'),
  ('MA', 'NE'), ('PI', 'NE'), ('CE', 'NE'), ('RN', 'NE'), ('PB', 'NE'), ('PE', 'NE'), ('AL', 'NE'), ('SE', 'NE'), ('BA', 'NE'),
  ('MT', 'CO'), ('MS', 'CO'), ('GO', 'CO'), ('DF', 'CO'),
  ('SP', 'SE'), ('RJ', 'SE'), ('ES', 'SE'), ('MG', 'SE'),
  ('PR', 'S'), ('SC', 'S'), ('RS', 'S')) v(uf, region)"""
COASTAL = """('AP', 'PA', 'MA', 'PI', 'CE', 'RN', 'PB', 'PE', 'AL', 'SE', 'BA', 'ES', 'RJ', 'SP', 'PR', 'SC', 'RS')"""

VIEWS = {
    **adapters.ORACLE_TABLES,
    "fact": FACT,
    "regions": REGIONS,
    "stock": f"select uf_norm as uf, count(*) as qty from fact where {BETWEEN} and uf_norm <> '' group by 1",
    "companies": f"select distinct cnpj_basico from fact where {BETWEEN}",
    "cities_raw": f"""select f.uf_norm as uf, m.descricao as municipio, count(*) as qty
        from fact f join municipio m on m.codigo = f.municipio
        where {BETWEEN} and m.descricao is not null group by 1, 2""",
    "cities_sp": f"""select m.descricao as municipio, count(*) as qty
        from fact f join municipio m on trim(m.codigo) = f.mun_code
        where {BETWEEN} and f.uf_norm = '{STATE}' and m.descricao is not null and m.descricao <> ''
        group by 1 order by qty desc, municipio limit 100""",
    "region_active": f"""select region, sum(case when status2 = '02' then 1 else 0 end) as actives, count(*) as total
        from fact join regions on regions.uf = uf_norm where {BETWEEN} group by 1""",
    "region_mei": f"""select region, sum(case when s.opcao_mei = 'S' then 1 else 0 end) as mei, count(*) as total
        from (select distinct uf_norm, cnpj_basico from fact where {BETWEEN}) d
        left join simples s using (cnpj_basico) join regions on regions.uf = d.uf_norm group by 1""",
    "capital": f"""select uf_norm as uf, {_money('capital_social')} as cap
        from fact left join empresas using (cnpj_basico) where {BETWEEN} and uf_norm is not null""",
    "p90": "select uf, quantile_cont(cast(cap as double), 0.9) as p90 from capital where cap is not null group by 1",
    "winsorized": """select c.uf, count(*) as n, any_value(p90.p90) as p90,
        avg(least(cast(cap as double), p90.p90)) as avg_cap_w
        from capital c join p90 on p90.uf = c.uf where cap is not null group by 1""",
    "region_cap": "select region, avg(avg_cap_w) as avg_cap from winsorized join regions using (uf) group by 1",
}
NEEDS = {
    "fact": ["estabelecimento"], "stock": ["fact"], "companies": ["fact"],
    "cities_raw": ["fact", "municipio"], "cities_sp": ["fact", "municipio"],
    "region_active": ["fact", "regions"], "region_mei": ["fact", "simples", "regions"],
    "capital": ["fact", "empresas"], "p90": ["capital"], "winsorized": ["capital", "p90"],
    "region_cap": ["winsorized", "regions"],
}


def _with(views: str, body: str) -> str:
    """``body`` after a WITH list of the named views and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in order) + "\n" + body


def query(name: str, views: str = "", sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: run(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = _with(views, sql)
        return run

    return register


def _per_value(df: DataFrame, raw: str, **columns) -> DataFrame:
    """Each distinct input with its results and how many rows have it."""
    return df.groupBy(F.col(raw).alias("raw"), *[c.alias(n) for n, c in columns.items()]).agg(
        F.count(F.lit(1)).alias("qty")
    )


def _text(column) -> F.Column:
    return column.cast("string")


# ── functions ───────────────────────────────────────────────────────────────

@query("parse_date_prefix8", "estabelecimento", f"""
select data_inicio_atividades as raw, cast({_prefix8('data_inicio_atividades')} as varchar) as parsed, count(*) as qty
from estabelecimento group by 1, 2""")
def _(t):
    return _per_value(t.fact, "data_inicio_atividades", parsed=_text(clean.parse_date_prefix8("data_inicio_atividades")))


@query("parse_date_exact8", "estabelecimento", f"""
select data_inicio_atividades as raw, cast({_exact8('data_inicio_atividades')} as varchar) as parsed, count(*) as qty
from estabelecimento group by 1, 2""")
def _(t):
    return _per_value(t.fact, "data_inicio_atividades", parsed=_text(clean.parse_date_exact8("data_inicio_atividades")))


@query("date_validity", "estabelecimento", f"""
select case when {_exact8('data_inicio_atividades')} is not null then 'valid'
  when coalesce({_digits('data_inicio_atividades')}, '') in ('', '0') then 'empty' else 'garbage' end as class,
  count(*) as qty from estabelecimento group by 1""")
def _(t):
    return quality.date_classes(t.fact, "data_inicio_atividades")


@query("norm_uf", "estabelecimento",
       "select uf as raw, upper(trim(uf)) as norm, count(*) as qty from estabelecimento group by 1, 2")
def _(t):
    return _per_value(t.fact, "uf", norm=clean.norm_uf("uf"))


@query("norm_code4", "empresas", f"""
select natureza_juridica as raw, {_code4('natureza_juridica')} as norm, count(*) as qty from empresas group by 1, 2""")
def _(t):
    return _per_value(t.emp, "natureza_juridica", norm=clean.norm_code4("natureza_juridica"))


@query("norm_status", "estabelecimento", """
select situacao_cadastral as raw, coalesce(lpad(trim(situacao_cadastral), 2, '0'), '') as norm, count(*) as qty
from estabelecimento group by 1, 2""")
def _(t):
    return _per_value(t.fact, "situacao_cadastral", norm=clean.norm_status("situacao_cadastral"))


@query("parse_capital", "empresas", f"""
select cnpj_basico, capital_social, cast({_money('capital_social')} as double) as capital from empresas""")
def _(t):
    return t.emp.select("cnpj_basico", "capital_social", clean.parse_capital("capital_social").cast("double").alias("capital"))


@query("size_bucket", "empresas", """
select porte_empresa as raw, case when rtrim(porte_empresa) in ('01','1','ME','M') then 'micro'
  when rtrim(porte_empresa) in ('02','2','EPP','P') then 'small' when rtrim(porte_empresa) in ('03','3') then 'medium'
  when rtrim(porte_empresa) in ('05','5','04','4') then 'large' end as bucket, count(*) as qty
from empresas group by 1, 2""")
def _(t):
    return _per_value(t.emp, "porte_empresa", bucket=clean.size_bucket("porte_empresa"))


@query("cnae_division", "estabelecimento", f"""
select cnae_fiscal as raw, case when length({_digits('cnae_fiscal')}) >= 2
  then substring({_digits('cnae_fiscal')}, 1, 2) end as division2, count(*) as qty
from estabelecimento group by 1, 2""")
def _(t):
    return _per_value(t.fact, "cnae_fiscal", division2=clean.cnae_division("cnae_fiscal"))


@query("null_defaults", "empresas estabelecimento", """
select coalesce(e.natureza_juridica, 'Unknown') as nature,
  case when coalesce(nullif(trim(f.municipio), ''), '') = '' then 1 else 0 end as blank_city, count(*) as qty
from estabelecimento f join (select cnpj_basico, min(natureza_juridica) as natureza_juridica from empresas group by 1) e
  using (cnpj_basico) group by 1, 2""")
def _(t):
    one = t.emp.groupBy("cnpj_basico").agg(F.min("natureza_juridica").alias("natureza_juridica"))
    blank = clean.is_blank("municipio").cast("int").alias("blank_city")
    per_company = t.fact.groupBy("cnpj_basico", blank).agg(state_reports.rows())
    return (
        per_company.join(one, "cnpj_basico")
        .groupBy(clean.or_missing("natureza_juridica").alias("nature"), "blank_city").agg(F.sum("qty").alias("qty"))
    )


@query("region_lookup", "fact regions", f"""
select uf_norm as uf, region, case region when 'N' then 'North' when 'NE' then 'Northeast' when 'CO' then 'Center-West'
  when 'SE' then 'Southeast' when 'S' then 'South' end as label, count(*) as qty
from fact left join regions on regions.uf = uf_norm group by 1, 2, 3""")
def _(t):
    return scope.prepare_fact(t.fact).groupBy(F.col("uf_norm").alias("uf")).agg(state_reports.rows()).select(
        "uf", regions.region_of("uf").alias("region"), regions.region_label(regions.region_of("uf")).alias("label"), "qty"
    )


@query("coastal_flag", "fact", f"""
select coalesce(upper(uf_norm) in {COASTAL}, false) as coastal, count(*) as qty from fact group by 1""")
def _(t):
    return scope.prepare_fact(t.fact).groupBy(regions.is_coastal("uf_norm").alias("coastal")).agg(state_reports.rows())


@query("uf_in_filter", "fact", "select cnpj_basico, cnpj_ordem, uf from fact where uf_norm in ('SP', 'RJ', 'MG')")
def _(t):
    return scope.in_states(scope.prepare_fact(t.fact), SOME).select("cnpj_basico", "cnpj_ordem", "uf")


@query("date_range_filter", "fact", f"""
select cnpj_basico, cnpj_ordem, cast(dt as varchar) as dt from fact where {BETWEEN}""")
def _(t):
    # bounds reversed on purpose: they are swapped
    return scope.in_range(scope.prepare_fact(t.fact), END, START).select("cnpj_basico", "cnpj_ordem", _text(F.col("dt")).alias("dt"))


@query("city_search", "municipio", """
select codigo, descricao from municipio where regexp_matches(descricao, 're.* 1[0-9]$', 'i')""")
def _(t):
    return scope.text_search(t.mun, "descricao", "RE.* 1[0-9]$").select("codigo", "descricao")


@query("fmt_num", "", """
select o_orderkey, coalesce(replace(format('{:,}', cast(trunc(x) as bigint)), ',', '.'), '—') as shown
from (select o_orderkey, case when o_custkey % 41 = 0 then null else o_totalprice end as x from orders)""")
def _(t):
    price = F.expr("case when o_custkey % 41 = 0 then null else o_totalprice end")
    return t.raw("orders").select("o_orderkey", formats.fmt_num(price).alias("shown"))


@query("fmt_money", "", """
select o_orderkey, coalesce('R$ ' || translate(format('{:,.2f}', x), ',.', ' ,'), '—') as shown
from (select o_orderkey, case when o_custkey % 41 = 0 then null else o_totalprice end as x from orders)""")
def _(t):
    price = F.expr("case when o_custkey % 41 = 0 then null else o_totalprice end")
    return t.raw("orders").select("o_orderkey", formats.fmt_money(price).alias("shown"))


EVENT_TEXT = """case when event_id % 7 = 0 then 'n/a' when event_id % 11 = 0 then null
    when event_id % 13 = 0 then '-5' else cast(value as string) end"""


@query("clean_series", "", f"""
select event_type, count(*) as kept, round(sum(v), 3) as total
from (select event_type, coalesce(try_cast({EVENT_TEXT} as double), 0) as v from events) where v > 0 group by 1""")
def _(t):
    series = products.positive_series(t.raw("events").selectExpr("event_type", f"{EVENT_TEXT} as v"), "event_type", "v")
    return series.groupBy("event_type").agg(state_reports.rows("kept"), F.round(F.sum("v"), 3).alias("total"))


@query("dated_series", "", """
select try_cast(y as int) as year, coalesce(try_cast(v as double), 0) as openings
from (select case when year(o_orderdate) = 1995 then 'n/a' else cast(year(o_orderdate) as varchar) end as y,
  case when year(o_orderdate) = 1996 then 'many' else cast(count(*) as varchar) end as v from orders group by year(o_orderdate))
where try_cast(y as int) is not null""")
def _(t):
    per_year = t.raw("orders").groupBy(F.year("o_orderdate").alias("y")).agg(state_reports.rows("v"))
    texts = per_year.select(
        F.when(F.col("y") == 1995, "n/a").otherwise(_text(F.col("y"))).alias("year"),
        F.when(F.col("y") == 1996, "many").otherwise(_text(F.col("v"))).alias("openings"),
    )
    return products.dated_series(texts)


# ── sources and table operations ────────────────────────────────────────────

@query("strip_nul", "", """
select event_id, replace(props || chr(0) || event_type || chr(0), chr(0), '') as cleaned from events""")
def _(t):
    dirty = F.concat("props", F.lit("\u0000"), "event_type", F.lit("\u0000"))
    return t.raw("events").select("event_id", clean.strip_nul(dirty).alias("cleaned"))


FILE_NAMES = [
    "K3241.K03200Y0.D50308.EMPRECSV", "K3241.K03200Y0.D50308.ESTABELE", "K3241.SOCIOCSV", "F.K03200.SIMPLES.CSV",
    "F.K03200.CNAECSV", "F.K03200.MOTICCSV", "F.K03200.MUNICCSV", "F.K03200.NATJUCSV", "F.K03200.PAISCSV",
    "F.K03200.QUALSCSV", "cnaes_secundarias", "trailer", "cabecalho", "foo",
]
FILE_PATH = ("concat('/in/', cast(l_orderkey as string), '/', case l_partkey % 14 "
             + " ".join(f"when {i} then '{n}'" for i, n in enumerate(FILE_NAMES)) + " end, '.csv')")


def _layout_sql(name: str) -> str:
    rules = [(k, k) for k in layouts.LAYOUTS] + [(p, k) for k, ps in layouts.ALIASES.items() for p in ps]
    return "case " + " ".join(f"when contains({name}, '{p}') then '{k}'" for p, k in rules) + " end"


@query("layout_key", "", f"""
select layout, count(*) as qty from (select {_layout_sql("lower(split_part(path, '/', -1))")} as layout
  from (select {FILE_PATH} as path from lineitem)) group by 1""")
def _(t):
    paths = t.raw("lineitem").selectExpr(f"{FILE_PATH} as path")
    return paths.groupBy(layouts.layout_of("path").alias("layout")).agg(state_reports.rows())


@query("harden_dates", "estabelecimento", f"""
select cnpj_basico, cnpj_ordem, cast({_exact8('data_inicio_atividades')} as varchar) as data_inicio_atividades
from estabelecimento""")
def _(t):
    hard = publish.harden_dates("estabelecimento", t.fact)
    return hard.select("cnpj_basico", "cnpj_ordem", _text(F.col("data_inicio_atividades")).alias("data_inicio_atividades"))


@query("param_sql", "fact", f"""
select status2, count(*) as qty from fact where uf_norm = '{STATE}' and {BETWEEN} group by 1""")
def _(t):
    return t.spark.sql(
        "select status2, count(*) as qty from {fact}"
        " where uf_norm = :uf and dt between cast(:start as date) and cast(:end as date) group by status2",
        args={"uf": STATE, "start": START, "end": END}, fact=scope.prepare_fact(t.fact),
    )


@query("page_links", "", r"""
select page_id, cast(pos - 1 as int) as pos, case when starts_with(href, 'http') then href else 'https://example.org' || href end as link
from (select page_id, unnest(hrefs) as href, unnest(range(1, len(hrefs) + 1)) as pos
  from (select page_id, regexp_extract_all(html, '<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1) as hrefs from pages))
where href <> '' and lower(href) like '%.'""")
def _(t):
    return links.page_links(t.raw("pages"), suffix=".", base="https://example.org")


@query("latest_month", "", """
select month, count(*) as qty from (select strftime(o_orderdate, '%Y%m') || '/' as month from orders)
where month = (select max(strftime(o_orderdate, '%Y%m') || '/') from orders where strftime(o_orderdate, '%Y%m') like '19%')
group by 1""")
def _(t):
    months = t.raw("orders").select(F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("/")).alias("month"))
    return links.latest(months.groupBy("month").agg(state_reports.rows()), "month", prefix="19")


FAMILY_LINK = """concat(case page_id % 7 when 0 then 'Empresas' when 1 then 'Estabelecimentos' when 2 then 'Socios'
    when 3 then 'Simples' when 4 then 'Naturezas' when 5 then 'Qualificacoes' else 'Other' end,
    cast(page_id as string), '.zip')"""
PRESENT_NAME = """concat(case when n_regionkey % 2 = 0 then 'SIMPLES' else 'Socios' end, cast(n_nationkey as string), '.zip')"""


def _family_sql(name: str) -> str:
    return "case " + " ".join(f"when contains(lower({name}), '{p}') then '{k}'" for p, k in layouts.FAMILIES.items()) + " end"


@query("one_per_family", "", f"""
select family, arg_min(link, page_id) as link from (
  select page_id, link, {_family_sql('link')} as family from (select page_id, {FAMILY_LINK} as link from pages))
where family is not null and family not in (
  select f from (select {_family_sql('name')} as f from (select {PRESENT_NAME} as name from nation)) where f is not null)
group by 1""")
def _(t):
    found = t.raw("pages").selectExpr("page_id as pos", f"{FAMILY_LINK} as link")
    present = t.raw("nation").selectExpr(f"{PRESENT_NAME} as name")
    return links.one_per_family(found, present)


@query("set_difference", "municipio estabelecimento",
       "select codigo from municipio except select municipio from estabelecimento")
def _(t):
    return sets.added(t.mun.select("codigo"), t.fact.select(F.col("municipio").alias("codigo")))


@query("union_parts", "", """
select nation, count(*) as qty from (
  select c_nationkey as nation, c_name as name from customer union all select s_nationkey, s_name from supplier) group by 1""")
def _(t):
    parts = [
        t.raw("customer").selectExpr("c_nationkey as nation", "c_name as name"),
        t.raw("supplier").selectExpr("s_nationkey as nation", "s_name as name"),
    ]
    return sets.union_parts(*parts).groupBy("nation").agg(state_reports.rows())


POSITION = "concat(cnpj_basico, '-', cnpj_ordem, '-', municipio, '-', coalesce(data_inicio_atividades, ''), uf)"


@query("ordered_dedup", "estabelecimento", f"""
select arg_min(uf, pos) as uf, min(pos) as pos from (select uf, {POSITION} as pos from estabelecimento where uf is not null)
group by lower(uf)""")
def _(t):
    named = t.fact.where(F.col("uf").isNotNull()).selectExpr("uf", f"{POSITION} as pos")
    return sets.first_of_each(named, "uf", "pos")


@query("not_null_violations", "empresas", """
select 'null:natureza_juridica' as reason, count(*) as qty from empresas where natureza_juridica is null""")
def _(t):
    return quality.violations(t.emp, required=["cnpj_basico", "natureza_juridica"])


@query("length_violations", "empresas estabelecimento", """
select 'length:municipio' as reason, count(*) as qty from estabelecimento where length(rtrim(municipio)) > 4
union all select 'length:uf', count(*) from estabelecimento where length(rtrim(uf)) > 2
union all select 'length:situacao_cadastral', count(*) from estabelecimento where length(rtrim(situacao_cadastral)) > 2""")
def _(t):
    return quality.violations(t.fact, widths={"municipio": 4, "uf": 2, "situacao_cadastral": 2})


# ── joins ───────────────────────────────────────────────────────────────────

@query("distinct_companies", "companies", "select cnpj_basico from companies")
def _(t):
    return scope.distinct_companies(t.fact, None, *RANGE)


@query("join_left_company", "companies empresas", """
select cnpj_basico, natureza_juridica, capital_social, porte_empresa from companies left join empresas using (cnpj_basico)""")
def _(t):
    return joins.left_company(scope.distinct_companies(t.fact, None, *RANGE), t.emp)


@query("join_left_dim_unknown", "empresas natureza_juridica", f"""
select coalesce(n.descricao, 'Unknown') as nature, count(*) as qty
from empresas e left join natureza_juridica n on {_code4('n.codigo')} = {_code4('e.natureza_juridica')} group by 1""")
def _(t):
    counts = t.emp.groupBy(clean.norm_code4("natureza_juridica").alias("code4")).agg(state_reports.rows())
    return joins.left_dim_unknown(counts, t.nat)


@query("join_inner_dim_trim", "fact municipio", f"""
select f.uf_norm as uf, m.descricao as municipio, count(*) as qty from fact f join municipio m on trim(m.codigo) = f.mun_code
where {BETWEEN} and m.descricao is not null and m.descricao <> '' group by 1, 2""")
def _(t):
    return city_reports.city_counts(t.fact, t.mun, None, *RANGE)


@query("join_calendar_spine", "fact", f"""
select cast(m.month as varchar) as month, coalesce(f.openings, 0) as openings
from (select cast(unnest(generate_series(timestamp '1990-01-01', timestamp '2000-12-01', interval 1 month)) as date) as month) m
left join (select cast(date_trunc('month', dt) as date) as month, count(*) as openings from fact
  where dt between date '1990-01-01' and date '2000-12-31' group by 1) f on f.month = m.month""")
def _(t):
    first, last = scope.day("1990-01-01"), scope.day("2000-12-31")
    monthly = (
        scope.in_range(scope.prepare_fact(t.fact), "1990-01-01", "2000-12-31")
        .groupBy(clean.month_floor("dt").alias("month")).agg(state_reports.rows("openings"))
    )
    return joins.calendar_spine(monthly, first, last).withColumn("month", _text(F.col("month")))


@query("month_spine", "", """
select cast(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), interval 1 month)) as date)::varchar as month
from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders)""")
def _(t):
    bounds = t.raw("orders").agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    months = F.sequence(clean.month_floor("lo"), clean.month_floor("hi"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("month")).select(_text(F.col("month")).alias("month"))


@query("join_left_simples", "companies simples", """
select cnpj_basico, case when s.opcao_mei = 'S' then 1 else 0 end as is_mei from companies left join simples s using (cnpj_basico)""")
def _(t):
    return joins.left_simples(scope.distinct_companies(t.fact, None, *RANGE), t.simples)


SUPPLIER_STATE = adapters.state_of("s_suppkey")


@query("join_semi_selected", "stock", f"""
select uf, qty from stock where uf in (select {SUPPLIER_STATE} from supplier where s_acctbal < 0)""")
def _(t):
    selected = t.raw("supplier").where("s_acctbal < 0").selectExpr(f"{SUPPLIER_STATE} as uf")
    return joins.semi_join(t.stock, selected, "uf")


@query("join_anti", "empresas estabelecimento", """
select cnpj_basico, capital_social from empresas where cnpj_basico not in (select cnpj_basico from estabelecimento)""")
def _(t):
    return joins.anti_join(t.emp.select("cnpj_basico", "capital_social"), t.fact, "cnpj_basico")


# ── reports ─────────────────────────────────────────────────────────────────

@query("uf_stock", "stock", "select uf, qty from stock")
def _(t):
    return t.stock


@query("legal_nature_share", "companies empresas natureza_juridica", f"""
select coalesce(n.descricao, 'Unknown') as nature, count(*) as qty
from companies left join empresas e using (cnpj_basico)
left join natureza_juridica n on {_code4('n.codigo')} = {_code4('e.natureza_juridica')}
group by 1 order by qty desc, nature limit 8""")
def _(t):
    return company_reports.legal_nature_share(t.fact, t.emp, t.nat, None, *RANGE)


@query("top_naturezas", "fact empresas natureza_juridica", f"""
select coalesce(n.descricao, 'Unknown') as natureza, count(*) as qty
from (select distinct cnpj_basico from fact where {BETWEEN} and uf_norm in ('SP', 'RJ', 'MG'))
left join empresas e using (cnpj_basico)
left join natureza_juridica n on {_code4('n.codigo')} = {_code4('e.natureza_juridica')}
group by 1 order by qty desc, natureza limit 5""")
def _(t):
    return company_reports.top_naturezas(t.fact, t.emp, t.nat, SOME, *RANGE, top_n=5)


@query("city_ranking", "cities_sp", "select municipio, qty from cities_sp order by qty desc, municipio limit 50")
def _(t):
    return city_reports.city_ranking(t.fact, t.mun, STATE, *RANGE)


@query("city_ranking_no_dim", "fact", f"""
select mun_code as municipio, count(*) as qty from fact where {BETWEEN} and uf_norm = '{STATE}' and mun_code <> ''
group by 1 order by qty desc, municipio limit 50""")
def _(t):
    return city_reports.city_ranking(t.fact, None, STATE, *RANGE)


@query("openings_by_year", "fact", """
select cast(year(dt) as int) as year, count(*) as openings from fact
where dt between date '1990-01-01' and date '2030-12-31' and uf_norm in ('SP', 'RJ', 'MG') group by 1 order by 1 limit 30""")
def _(t):
    return state_reports.openings_by_year(t.fact, SOME, "1990-01-01", "2030-12-31")


@query("openings_last_12mo", "fact", f"""
select cast(m.month as varchar) as month, count(f.month) as openings
from (select cast(unnest(generate_series(timestamp '1998-01-01', timestamp '1998-12-01', interval 1 month)) as date) as month) m
left join (select cast(date_trunc('month', dt) as date) as month from fact where uf_norm = '{STATE}') f on f.month = m.month
group by 1""")
def _(t):
    monthly = state_reports.openings_last_12mo(t.fact, STATE, "1998-12-15")
    return monthly.withColumn("month", _text(F.col("month")))


@query("status_share", "fact", f"""
select case when status2 = '02' then 'Active' else 'Inactive' end as status, count(*) as qty
from fact where {BETWEEN} group by 1""")
def _(t):
    return state_reports.status_share(t.fact, None, *RANGE)


@query("cnae_profile", "fact", f"""
select substring(c, 1, 2) as division2, count(*) as qty
from (select {_digits('cnae_fiscal')} as c from fact where uf_norm = '{STATE}' and {BETWEEN})
where length(c) >= 2 group by 1 order by qty desc, division2 limit 10""")
def _(t):
    return state_reports.cnae_profile(t.fact, STATE, *RANGE)


@query("enterprise_profile", "fact empresas simples", f"""
select count(*) as n_emp, sum(case when s.opcao_mei = 'S' then 1 else 0 end)::bigint as n_mei,
  round(avg(cast({_money('capital_social')} as double)), 2) as avg_cap_raw,
  sum(case when rtrim(porte_empresa) in ('01','1','ME','M') then 1 else 0 end)::bigint as micro,
  sum(case when rtrim(porte_empresa) in ('02','2','EPP','P') then 1 else 0 end)::bigint as small,
  sum(case when rtrim(porte_empresa) in ('03','3') then 1 else 0 end)::bigint as medium,
  sum(case when rtrim(porte_empresa) in ('05','5','04','4') then 1 else 0 end)::bigint as large
from (select distinct cnpj_basico from fact where uf_norm = '{STATE}' and {BETWEEN})
left join empresas using (cnpj_basico) left join simples s using (cnpj_basico)""")
def _(t):
    profile = company_reports.enterprise_profile(t.fact, t.emp, t.simples, STATE, *RANGE)
    return profile.withColumn("avg_cap_raw", F.round("avg_cap_raw", 2))


@query("data_quality", "estabelecimento", f"""
select count(*) as total, count(*) filter (where coalesce(trim(uf), '') = '') as miss_uf,
  count(*) filter (where coalesce(trim(municipio), '') = '') as miss_mun,
  count(*) filter (where coalesce(length({_digits('data_inicio_atividades')}), 0) < 8) as miss_dt from estabelecimento""")
def _(t):
    return quality.data_quality(t.fact)


@query("coverage_pct", "estabelecimento", f"""
select round(count(*) filter (where coalesce(trim(uf), '') = '') * 100.0::double / count(*), 6) as miss_uf_pct,
  round(count(*) filter (where coalesce(trim(municipio), '') = '') * 100.0::double / count(*), 6) as miss_mun_pct,
  round(count(*) filter (where coalesce(length({_digits('data_inicio_atividades')}), 0) < 8) * 100.0::double / count(*), 6) as miss_dt_pct
from estabelecimento""")
def _(t):
    pct = quality.coverage_pct(quality.data_quality(t.fact))
    return pct.select(*[F.round(c, 6).alias(c) for c in pct.columns])


@query("last_available_month", "fact", "select strftime(max(dt), '%Y-%m') as last_month from fact")
def _(t):
    return quality.last_available_month(t.fact)


@query("active_rate", "fact", f"""
select count(*) filter (where status2 = '02') as active, count(*) as total,
  round(count(*) filter (where status2 = '02') * 100.0::double / count(*), 6) as active_pct from fact where {BETWEEN}""")
def _(t):
    return state_reports.active_rate(t.fact, *RANGE).withColumn("active_pct", F.round("active_pct", 6))


@query("top5_concentration", "cities_raw", """
select uf, sum(case when rn <= 5 then qty else 0 end)::bigint as top5, sum(qty)::bigint as total,
  round(sum(case when rn <= 5 then qty else 0 end) * 100.0::double / sum(qty), 6) as top5_pct
from (select *, row_number() over (partition by uf order by qty desc, municipio) as rn from cities_raw) group by 1""")
def _(t):
    return city_reports.top5_concentration(t.fact, t.mun, *RANGE).withColumn("top5_pct", F.round("top5_pct", 6))


@query("city_row_number", "cities_raw", """
select uf, municipio, qty, row_number() over (partition by uf order by qty desc, municipio) as rn from cities_raw""")
def _(t):
    return city_reports.city_row_number(t.fact, t.mun, *RANGE)


@query("region_active_rate", "region_active", """
select region, actives::bigint as actives, total, round(actives * 100.0::double / total, 6) as active_pct from region_active""")
def _(t):
    return state_reports.region_active_rate(t.fact, *RANGE).withColumn("active_pct", F.round("active_pct", 6))


@query("region_mei_density", "region_mei", """
select region, mei::bigint as mei, total, round(mei * 100.0::double / total, 6) as mei_pct from region_mei""")
def _(t):
    return company_reports.region_mei_density(t.fact, t.simples, *RANGE).withColumn("mei_pct", F.round("mei_pct", 6))


@query("winsorized_capital", "winsorized", """
select uf, n, round(p90, 2) as p90, round(avg_cap_w, 2) as avg_cap_w from winsorized""")
def _(t):
    by_state = company_reports.winsorized_capital(t.fact, t.emp, *RANGE)
    return by_state.select("uf", F.col("n").cast("bigint").alias("n"), F.round("p90", 2).alias("p90"), F.round("avg_cap_w", 2).alias("avg_cap_w"))


@query("capital_percentiles", "capital", """
select uf, n, q, round(p, 2) as p from (
  select uf, count(*) as n, unnest(['0.25', '0.50', '0.999']) as q, unnest(quantile_cont(cast(cap as double), [0.25, 0.5, 0.999])) as p
  from capital where cap is not null group by uf)""")
def _(t):
    found = company_reports.capital_percentiles(t.fact, t.emp, *RANGE, ["0.25", "0.50", "0.999"])
    return found.select("uf", F.col("n").cast("bigint").alias("n"), "q", F.round("p", 2).alias("p"))


@query("region_capital", "region_cap","select region, round(avg_cap, 2) as avg_cap from region_cap")
def _(t):
    by_state = company_reports.winsorized_capital(t.fact, t.emp, *RANGE)
    return company_reports.region_capital(by_state).withColumn("avg_cap", F.round("avg_cap", 2))


@query("region_gap", "region_active region_mei region_cap", """
select metric, round(n, 2) as first_value, round(se, 2) as second_value, round(n - se, 2) as gap from (
  select 'active_rate' as metric, max(case when region = 'N' then actives * 100.0::double / total end) as n,
    max(case when region = 'SE' then actives * 100.0::double / total end) as se from region_active
  union all select 'mei_density', max(case when region = 'N' then mei * 100.0::double / total end),
    max(case when region = 'SE' then mei * 100.0::double / total end) from region_mei
  union all select 'avg_capital', max(case when region = 'N' then avg_cap end),
    max(case when region = 'SE' then avg_cap end) from region_cap)""")
def _(t):
    gap = company_reports.region_gap(t.fact, t.emp, t.simples, *RANGE)
    return gap.select("metric", *[F.round(c, 2).alias(c) for c in ("first_value", "second_value", "gap")])


@query("kpi_totals", "stock", """
select sum(qty)::bigint as establishments, (select uf from stock where uf in ('SP','RJ','MG') order by qty desc, uf limit 1) as leader_uf,
  max(qty) as leader_qty from stock where uf in ('SP', 'RJ', 'MG')""")
def _(t):
    return state_reports.kpi_totals(t.stock, SOME)


@query("coastal_inland", "stock", f"""
select sum(case when uf in {COASTAL} then qty else 0 end)::bigint as coastal,
  sum(case when uf in {COASTAL} then 0 else qty end)::bigint as inland from stock""")
def _(t):
    return state_reports.coastal_inland(t.stock)


@query("value_range", "stock", """
select case when min(qty) = max(qty) then greatest(min(qty) - 1, 0) else min(qty) end as vmin,
  case when min(qty) = max(qty) then max(qty) + 1 else max(qty) end as vmax from stock""")
def _(t):
    return state_reports.value_range(t.stock)


@query("top_city_share", "cities_sp", """
select sum(qty)::bigint as uf_total, (select municipio from cities_sp order by qty desc, municipio limit 1) as top_city,
  max(qty) as top_qty, round(max(qty) * 100.0::double / sum(qty), 6) as top_pct from cities_sp""")
def _(t):
    cities = city_reports.city_ranking(t.fact, t.mun, STATE, *RANGE, limit_n=100)
    return city_reports.top_city_share(cities).withColumn("top_pct", F.round("top_pct", 6))


@query("state_rank", "stock", "select uf, qty, cast(dense_rank() over (order by qty desc) as int) as rank from stock")
def _(t):
    return ranking.dense_rank_by(t.stock)


@query("state_share", "stock", """
select uf, qty, round_even(qty * 100.0::double / sum(qty) over (), 2)::double as share_percent from stock""")
def _(t):
    return ranking.share_of_total(t.stock)


@query("city_rank", "cities_sp", """
select cast(dense_rank() over (order by qty desc) as int) as rank, municipio, qty
from (select * from cities_sp where regexp_matches(municipio, 'e', 'i') order by qty desc, municipio limit 15)""")
def _(t):
    cities = city_reports.city_ranking(t.fact, t.mun, STATE, *RANGE, limit_n=100)
    return city_reports.city_rank(cities, "E", 15)


# ── products ────────────────────────────────────────────────────────────────

STATE_TABLE = f"""
select cast(dense_rank() over (order by qty desc) as int) as rank, uf, region, uf in {COASTAL} as coastal, qty,
  round_even(qty * 100.0::double / sum(qty) over (), 2)::double as share_percent, uf in ('SP', 'RJ', 'MG') as selected
from stock left join regions using (uf)"""


@query("state_summary", "stock regions", f"""
select * from ({STATE_TABLE}) order by selected desc, qty desc, uf limit 15""")
def _(t):
    return products.state_summary(t.stock, SOME)


@query("state_summary_filtered", "stock regions", f"""
select * from ({STATE_TABLE}) where region = 'SE' and regexp_matches(uf, 'S|J') order by selected desc, qty desc, uf limit 15""")
def _(t):
    return products.state_summary(t.stock, SOME, region="SE", search="s|j")


@query("state_summary_pretty", "stock regions", f"""
select rank as "Rank", uf as "UF", region as "Region", case when coastal then 'Coastal' else 'Interior' end as "Coastal",
  replace(format('{{:,}}', qty), ',', '.') as "Establishments", format('{{:.2f}}%', share_percent) as "Share",
  case when selected then '✓' else '' end as "Selected"
from (select * from ({STATE_TABLE}) order by selected desc, qty desc, uf limit 15)""")
def _(t):
    return products.state_summary_pretty(products.state_summary(t.stock, SOME))


@query("state_summary_export", "stock regions", f"""
select rank as "Rank", uf as "UF", region as "Region", coastal as "Coastal", qty as "Establishments",
  share_percent as "Share_percent", selected as "Selected"
from (select * from ({STATE_TABLE}) order by selected desc, qty desc, uf limit 15)""")
def _(t):
    return products.state_summary_export(products.state_summary(t.stock, SOME))


@query("city_drilldown", "cities_sp", """
select cast(dense_rank() over (order by qty desc) as int) as rank, municipio, qty, uf_total, top_city, top_qty, round(top_pct, 6) as top_pct
from (select c.*, sum(qty) over ()::bigint as uf_total, first(municipio) over (order by qty desc, municipio) as top_city,
    max(qty) over () as top_qty, max(qty) over () * 100.0::double / sum(qty) over () as top_pct from cities_sp c)
where regexp_matches(municipio, 'e', 'i') order by qty desc, municipio limit 15""")
def _(t):
    view = products.city_drilldown(t.fact, t.mun, STATE, *RANGE, search="e")
    return view.withColumn("top_pct", F.round("top_pct", 6))


@query("nature_or_status", "fact", f"""
select case when status2 = '02' then 'Active' else 'Inactive' end as label, count(*) as qty
from fact where {BETWEEN} and uf_norm in ('SP', 'RJ', 'MG') group by 1""")
def _(t):
    return products.nature_or_status(t.fact, t.emp, None, SOME, *RANGE)


@query("nature_or_status_with_dims", "fact empresas natureza_juridica", f"""
select coalesce(n.descricao, 'Unknown') as label, count(*) as qty
from (select distinct cnpj_basico from fact where {BETWEEN} and uf_norm in ('SP', 'RJ', 'MG'))
left join empresas e using (cnpj_basico)
left join natureza_juridica n on {_code4('n.codigo')} = {_code4('e.natureza_juridica')}
group by 1 order by qty desc, label limit 8""")
def _(t):
    return products.nature_or_status(t.fact, t.emp, t.nat, SOME, *RANGE)
