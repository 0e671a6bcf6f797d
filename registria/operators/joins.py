"""Joins that stay whole and balanced when one key holds much of a table.

No side is broadcast by hint. Spark broadcasts a side only when its size, planned
(``spark.sql.autoBroadcastJoinThreshold``) or measured by AQE, is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean


def splittable_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` whose skewed partitions AQE can split.

    AQE splits a join's input only where it is shuffled for that join. A side
    that was just aggregated by ``key`` would be joined where it lies, so the
    key's hash joins along: both sides are then shuffled for the join itself.
    """
    hashed = F.xxhash64(key).alias("_hash")
    joined = left.select("*", hashed).join(right.select("*", hashed), [key, "_hash"], how)
    return joined.drop("_hash")


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """LEFT JOIN that keeps duplicates on both sides and tolerates hot keys on both.

    AQE can split a skewed partition on either side of an inner join but only on
    the kept side of an outer one. So the matches come from an inner join and the
    rest from an anti join against the distinct keys, which have no hot key. Rows
    without a key match nothing and go around both, so that both joins read one
    shuffle of ``left``.
    """
    keyed = left.where(F.col(key).isNotNull())
    matched = splittable_join(keyed, right, key)
    alone = anti_join(keyed, right, key).unionByName(left.where(F.col(key).isNull()))
    return matched.unionByName(alone, allowMissingColumns=True)


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return splittable_join(left, right.select(key).distinct(), key, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return splittable_join(left, right.select(key).distinct(), key, "left_semi")


def left_company(companies: DataFrame, empresas: DataFrame) -> DataFrame:
    """Companies with their master rows; companies without one keep NULLs."""
    return left_join(
        companies.select("cnpj_basico"),
        empresas.select("cnpj_basico", "natureza_juridica", "capital_social", "porte_empresa"),
        "cnpj_basico",
    )


def left_simples(companies: DataFrame, simples: DataFrame | None) -> DataFrame:
    """Companies with ``is_mei``; no tax-regime row, or no such table, means 0."""
    if simples is None:
        return companies.select("cnpj_basico", F.lit(0).alias("is_mei"))
    regime = simples.select("cnpj_basico", (F.col("opcao_mei") == "S").cast("int").alias("is_mei"))
    joined = left_join(companies.select("cnpj_basico"), regime, "cnpj_basico")
    return joined.select("cnpj_basico", F.coalesce("is_mei", F.lit(0)).alias("is_mei"))


def dimension(dim: DataFrame, code: Column) -> DataFrame:
    """``(code, descricao, copies)``: the dimension with duplicate rows counted, not repeated."""
    return dim.groupBy(code.alias("code"), "descricao").agg(F.count(F.lit(1)).alias("copies"))


def left_dim_unknown(counts: DataFrame, dim: DataFrame) -> DataFrame:
    """Counts per ``code4`` LEFT the dimension, labelled ``Unknown`` where it has no name.

    ``counts`` is ``(code4, qty)``. A code listed twice in the dimension counts twice.
    """
    named = dimension(dim, clean.norm_code4("codigo")).withColumnRenamed("code", "code4")
    return (
        counts.join(named, "code4", "left")
        .groupBy(clean.or_missing("descricao").alias("nature"))
        .agg(F.sum(F.col("qty") * F.coalesce("copies", F.lit(1))).cast("bigint").alias("qty"))
    )


def inner_dim(counts: DataFrame, municipio: DataFrame, trimmed: bool = True) -> DataFrame:
    """Counts per ``(uf, code)`` with the municipality name; unnamed ones drop out.

    ``trimmed`` trims both keys and drops blank names; otherwise keys match raw
    and an empty name is a name. Output ``(uf, municipio, qty)``.
    """
    code = clean.trim_code("codigo") if trimmed else F.col("codigo")
    named = dimension(municipio.where(F.col("descricao").isNotNull()), code)
    if trimmed:
        named = named.where(F.col("descricao") != "")
    return (
        counts.join(named, "code")
        .groupBy("uf", F.col("descricao").alias("municipio"))
        .agg(F.sum(F.col("qty") * F.col("copies")).cast("bigint").alias("qty"))
    )


def calendar_spine(monthly: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every month from ``first`` to ``last`` with its ``openings``, 0 where none."""
    spine = month_spine(monthly, first, last)
    return spine.join(monthly, "month", "left").select(
        "month", F.coalesce("openings", F.lit(0)).cast("bigint").alias("openings")
    )


def month_spine(df: DataFrame, first: Column, last: Column) -> DataFrame:
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    return df.sparkSession.range(1).select(F.explode(months).alias("month"))
