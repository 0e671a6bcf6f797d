"""Record layouts, their file names and their integrity rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..functions.clean import _c

# Column order of each record kind. Files have no header, so the
# order is the contract; the kinds are tried in this order against a file name.
LAYOUTS: dict[str, list[str]] = {
    "header": [
        "tipo_do_registro", "filler", "nome_do_arquivo", "data_de_gravacao",
        "numero_da_remessa", "filler2", "fim_de_registro",
    ],
    "cnae": ["codigo", "descricao"],
    "empresas": [
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
        "capital_social", "porte_empresa", "ente_federativo_responsavel",
    ],
    "estabelecimento": [
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
        "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
        "nome_cidade_exterior", "pais", "data_inicio_atividades", "cnae_fiscal",
        "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
        "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2",
        "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
    ],
    "motivo": ["codigo", "descricao"],
    "municipio": ["codigo", "descricao"],
    "natureza_juridica": ["codigo", "descricao"],
    "pais": ["codigo", "descricao"],
    "qualificacao_socio": ["codigo", "descricao"],
    "simples": [
        "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
        "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
    ],
    "socios_original": [
        "cnpj_basico", "identificador_de_socio", "nome_socio", "cnpj_cpf_socio",
        "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
        "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
    ],
    "cnaes_secundarias": [
        "tipo_do_registro", "indicador_full_diario", "tipo_de_atualizacao", "cnpj",
        "cnae_secundaria", "filler", "fim_de_registro",
    ],
    "trailler": [
        "tipo_do_registro", "filler", "total_de_registros_t1", "total_de_registros_t2",
        "total_de_registros_t3", "total_de_registros", "filler2", "fim_de_registro",
    ],
}

# Kinds that have a table; the other three are named but never stored.
TABLES = [
    "cnae", "empresas", "estabelecimento", "motivo", "municipio", "natureza_juridica",
    "pais", "qualificacao_socio", "simples", "socios_original",
]

# Abbreviations in file names, tried in this order after the kinds.
ALIASES: dict[str, list[str]] = {
    "natureza_juridica": ["natju", "natureza"],
    "qualificacao_socio": ["quals", "qualific"],
    "socios_original": ["socio", "socios"],
    "estabelecimento": ["estabelec", "estab"],
    "empresas": ["empre", "empresa", "empresas"],
    "cnae": ["cnae"],
    "motivo": ["motic", "motivo"],
    "municipio": ["munic", "municipio"],
    "pais": ["pais"],
    "cnaes_secundarias": ["secundaria", "secundarias"],
    "trailler": ["trailler", "trailer"],
    "header": ["header", "cabecalho"],
}

# Name parts that mark an archive's family, tried in this order.
FAMILIES = {
    "header": "header",
    "cnae": "cnae",
    "empresas": "empresas",
    "estabelec": "estabelecimento",
    "motivo": "motivo",
    "municipio": "municipio",
    "natureza": "natureza_juridica",
    "pais": "pais",
    "qualific": "qualificacao_socio",
    "simples": "simples",
    "socios": "socios_original",
    "secundaria": "cnaes_secundarias",
    "trailler": "trailler",
}

# Declared column widths.
WIDTHS: dict[str, dict[str, int]] = {
    "cnae": {"codigo": 7},
    "empresas": {
        "cnpj_basico": 8, "natureza_juridica": 4, "qualificacao_responsavel": 2,
        "capital_social": 20, "porte_empresa": 2,
    },
    "estabelecimento": {
        "cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "matriz_filial": 1,
        "situacao_cadastral": 2, "motivo_situacao_cadastral": 2, "pais": 3, "cnae_fiscal": 7,
        "numero": 10, "cep": 8, "uf": 2, "municipio": 4, "ddd1": 4, "telefone1": 8,
        "ddd2": 4, "telefone2": 8, "ddd_fax": 4, "fax": 8,
    },
    "motivo": {"codigo": 2},
    "municipio": {"codigo": 4},
    "natureza_juridica": {"codigo": 4},
    "pais": {"codigo": 3},
    "qualificacao_socio": {"codigo": 2},
    "simples": {"cnpj_basico": 8, "opcao_simples": 1, "opcao_mei": 1},
    "socios_original": {
        "cnpj_basico": 8, "identificador_de_socio": 1, "cnpj_cpf_socio": 14,
        "qualificacao_socio": 2, "pais": 3, "representante_legal": 11,
        "qualificacao_representante_legal": 2, "faixa_etaria": 1,
    },
}

# Columns that must not be NULL.
REQUIRED: dict[str, list[str]] = {
    **{dim: ["descricao"] for dim in (
        "cnae", "motivo", "municipio", "natureza_juridica", "pais", "qualificacao_socio",
    )},
    "empresas": ["razao_social", "natureza_juridica", "qualificacao_responsavel"],
}

# Text dates, where a quoted blank means NULL and which become DATE.
DATE_COLUMNS: dict[str, list[str]] = {
    "estabelecimento": ["data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial"],
    "simples": ["data_opcao_simples", "data_exclusao_simples", "data_opcao_mei", "data_exclusao_mei"],
    "socios_original": ["data_entrada_sociedade"],
}


def text_schema(layout: str) -> T.StructType:
    """All columns as text. Plain strings, since Spark's CHAR would pad the codes."""
    return T.StructType([T.StructField(name, T.StringType()) for name in LAYOUTS[layout]])


def _base_name(path: Column | str) -> Column:
    return F.lower(F.element_at(F.split(F.rtrim(_c(path), F.lit("/")), "/"), -1))


def _first_match(name: Column, rules: list[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(F.contains(name, F.lit(part)), F.lit(kind)) for part, kind in rules])


def layout_of(path: Column | str) -> Column:
    """Layout of a file by its name, NULL if unknown. The first matching part wins,
    so a ``cnaes_secundarias`` file resolves to ``cnae``."""
    rules = [(kind, kind) for kind in LAYOUTS]
    rules += [(part, kind) for kind, parts in ALIASES.items() for part in parts]
    return _first_match(_base_name(path), rules)


def family_of(path: Column | str) -> Column:
    """Archive family by file name, NULL if unknown."""
    return _first_match(_base_name(path), list(FAMILIES.items()))
