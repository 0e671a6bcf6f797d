"""Registry tables made from the driver's tables, with the registry's dirt.

Line items play establishments, orders play companies, parts play cities. Each
table is a list of ``(column, expression)`` in SQL that Spark and DuckDB both
read, so the queries and their oracles start from the same text. Every source
row is kept; rows meant to miss a join carry a key that matches nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

Columns = list[tuple[str, str]]


def _padded(expr: str, width: int) -> str:
    """Zero-padded to ``width``, never cut, so keys stay distinct at any scale."""
    text = f"cast({expr} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _ymd(col: str) -> str:
    return f"replace(cast(cast({col} as date) as string), '-', '')"


DIRT = "(l_orderkey + l_linenumber)"

# State codes.
STATES = [
    "RO", "AC", "AM", "RR", "PA", "AP", "TO", "MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA",
    "MT", "MS", "GO", "DF", "SP", "RJ", "ES", "MG", "PR", "SC", "RS",
]


def state_of(key: str) -> str:
    """A state by the key's remainder; one remainder has none and gives a blank."""
    return f"split_part('{','.join(STATES)},', ',', cast({key} % {len(STATES) + 1} as int) + 1)"


UF_BASE: Columns = [
    *[(c, c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag", "l_quantity")],
    ("ymd", _ymd("l_shipdate")),
    ("iso", "cast(cast(l_shipdate as date) as string)"),
    ("u", state_of("l_suppkey")),
]

ESTABELECIMENTO: Columns = [
    ("cnpj_basico", _padded("l_orderkey", 8)),
    ("cnpj_ordem", _padded("l_linenumber", 4)),
    ("uf", f"""case when l_linenumber % 3 = 0 then lower(u) when l_linenumber % 5 = 0 then concat(' ', u, ' ')
        when {DIRT} % 211 = 0 then null else u end"""),
    ("municipio", f"""case when l_partkey % 37 = 0 then '' when l_partkey % 11 = 0
        then concat(' ', {_padded('l_partkey', 7)}) else {_padded('l_partkey', 7)} end"""),
    ("situacao_cadastral", """case when l_quantity < 2 then null when l_linestatus = 'O' then '2'
        when l_returnflag = 'A' then ' 02' else '08' end"""),
    ("data_inicio_atividades", f"""case when {DIRT} % 101 = 0 then '00000000' when {DIRT} % 97 = 0 then ''
        when {DIRT} % 89 = 0 then '0' when {DIRT} % 83 = 0 then '20231345'
        when {DIRT} % 79 = 0 then concat(ymd, '99') when {DIRT} % 73 = 0 then null
        when {DIRT} % 7 = 0 then iso else ymd end"""),
    ("cnae_fiscal", """case when l_partkey % 29 = 0 then '7'
        else concat(lpad(cast(l_partkey % 99 as string), 2, '0'), '.1-',
                    lpad(cast(l_partkey % 1000 as string), 3, '0')) end"""),
]

EMPRESAS: Columns = [
    ("cnpj_basico", _padded("o_orderkey", 8)),
    ("natureza_juridica", """case when o_custkey % 41 = 0 then null
        when o_custkey % 5 = 0 then concat('20', substring(o_orderpriority, 1, 1), '-', cast(o_custkey % 7 as string))
        when o_custkey % 13 = 0 then concat(substring(o_orderpriority, 1, 1), cast(o_custkey % 7 as string))
        else concat('20', substring(o_orderpriority, 1, 1), cast(o_custkey % 7 as string)) end"""),
    ("capital_social", """case when o_orderkey % 53 = 0 then '' when o_orderkey % 59 = 0 then 'x'
        else replace(cast(cast(o_totalprice as decimal(20,2)) as string), '.', ',') end"""),
    ("porte_empresa", """case when o_orderkey % 17 = 0 then '2 ' when o_orderstatus = 'F' then '01'
        when o_orderstatus = 'O' then '3' else '05' end"""),
]

SIMPLES: Columns = [
    ("cnpj_basico", f"case when o_orderkey % 10 = 0 then concat('x', {_padded('o_orderkey', 8)})"
                    f" else {_padded('o_orderkey', 8)} end"),
    ("opcao_simples", "case when o_custkey % 2 = 0 then 'S' else 'N' end"),
    ("opcao_mei", "case when o_custkey % 3 = 0 then 'S' else 'N' end"),
    ("data_opcao_simples", _ymd("o_orderdate")),
]

MUNICIPIO: Columns = [
    ("codigo", f"case when p_partkey % 50 = 0 then concat('x', {_padded('p_partkey', 7)})"
               f" else {_padded('p_partkey', 7)} end"),
    ("descricao", "case when p_partkey % 67 = 0 then '' else concat(p_name, ' ', cast(p_partkey % 40 as string)) end"),
]

NATUREZA: Columns = [
    ("codigo", """case when o_custkey % 7 = 6 then 'none'
        when o_custkey % 7 = 1 then concat('20', substring(o_orderpriority, 1, 1), '-', cast(o_custkey % 7 as string))
        else concat('20', substring(o_orderpriority, 1, 1), cast(o_custkey % 7 as string)) end"""),
    ("descricao", "concat('NAT ', substring(o_orderpriority, 3, 20), ' ', cast(o_custkey % 7 as string))"),
]


def _exprs(columns: Columns) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def estabelecimento(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_exprs(UF_BASE)).selectExpr(*_exprs(ESTABELECIMENTO))


def empresas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 499th company is listed twice, so joins must keep the fan-out."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "*", "explode(case when o_orderkey % 499 = 0 then array(1, 2) else array(1) end) as copy"
    )
    return orders.selectExpr(*_exprs(EMPRESAS))


def simples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(SIMPLES))


def municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_exprs(MUNICIPIO))


def natureza_juridica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(NATUREZA)).distinct()


def _select(columns: Columns, source: str) -> str:
    return "select " + ",\n  ".join(_exprs(columns)) + f"\nfrom {source}"


# The same tables for DuckDB.
ORACLE_TABLES = {
    "estabelecimento": _select(ESTABELECIMENTO, f"({_select(UF_BASE, 'lineitem')}) uf_base"),
    "empresas": _select(
        EMPRESAS,
        "(select * from orders union all select * from orders where o_orderkey % 499 = 0) o",
    ),
    "simples": _select(SIMPLES, "orders"),
    "municipio": _select(MUNICIPIO, "part"),
    "natureza_juridica": "select distinct" + _select(NATUREZA, "orders").removeprefix("select"),
}
