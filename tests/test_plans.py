"""Physical plans: what reaches the scan, what is shuffled, what can be split."""

import contextlib

import pytest
from pyspark.sql import functions as F

from registria.operators import city_reports, company_reports, joins, state_reports
from registria.plans import publish
from workloads import adapters, registered

SF_DIR = "/root/testdata/sf0.01"
RANGE = ("1997-01-01", "1998-12-31")


def plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@contextlib.contextmanager
def conf(spark, **settings):
    keys = {k.replace("_", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(registered.QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert bad not in text


def test_scan_reads_needed_columns_only(spark):
    text = plan(registered.QUERIES["uf_stock"](spark, SF_DIR))
    schema = next(l for l in text.splitlines() if "ReadSchema" in l)
    assert sorted(c.split(":")[0] for c in schema.split("<")[1].rstrip(">").split(",")) == [
        "l_linenumber", "l_orderkey", "l_shipdate", "l_suppkey"]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """The fact as it is published: hardened, typed columns stored, clustered by date."""
    path = str(tmp_path_factory.mktemp("published") / "fact")
    publish.clustered(publish.curated("estabelecimento", adapters.estabelecimento(spark, SF_DIR)), 4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("report, wanted", [
    (lambda f: state_reports.uf_stock(f, *RANGE), ["GreaterThanOrEqual(data_inicio_atividades,1997-01-01)"]),
    (lambda f: state_reports.openings_by_year(f, ["SP", "RJ"], *RANGE), ["In(uf_norm", "LessThanOrEqual(data_inicio_atividades,1998-12-31)"]),
    (lambda f: state_reports.openings_last_12mo(f, "SP", "1998-12-31"), ["uf_norm", "GreaterThanOrEqual(data_inicio_atividades,1998-01-01)"]),
    (lambda f: city_reports.city_ranking(f, None, "SP", *RANGE), ["uf_norm", "GreaterThanOrEqual(data_inicio_atividades"]),
])
def test_filters_reach_the_published_scan(published, report, wanted):
    pushed = next(l for l in plan(report(published)).splitlines() if "PushedFilters" in l)
    assert all(w in pushed for w in wanted)


def test_published_rows_are_clustered_by_date(published):
    ranges = (
        published.where("data_inicio_atividades is not null").groupBy(F.input_file_name())
        .agg(F.min("data_inicio_atividades").alias("lo"), F.max("data_inicio_atividades").alias("hi")).orderBy("lo", "hi").collect()
    )
    assert len(ranges) > 1 and all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_published_fact_gives_the_same_reports(spark, published):
    staged = adapters.estabelecimento(spark, SF_DIR)
    # one value differs by design: ten digits are a date to a report, but not to hardening
    staged = staged.where(F.length(F.regexp_replace("data_inicio_atividades", r"\D", "")) == 8)
    emp, simples, mun = (f(spark, SF_DIR) for f in (adapters.empresas, adapters.simples, adapters.municipio))
    for report in (
        lambda f: state_reports.uf_stock(f, *RANGE),
        lambda f: state_reports.active_rate(f, *RANGE),
        lambda f: state_reports.status_share(f, ["SP", "RJ"], *RANGE),
        lambda f: state_reports.openings_by_year(f, None, "1990-01-01", "2030-01-01"),
        lambda f: state_reports.openings_last_12mo(f, "SP", "1998-12-31"),
        lambda f: state_reports.cnae_profile(f, "SP", *RANGE),
        lambda f: city_reports.city_ranking(f, mun, "SP", *RANGE),
        lambda f: company_reports.enterprise_profile(f, emp, simples, "SP", *RANGE).drop("avg_cap_raw"),
        lambda f: company_reports.region_mei_density(f, simples, *RANGE).orderBy("region"),
    ):
        rows = report(staged).collect()
        assert rows and rows == report(published).collect()


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(registered.QUERIES["city_ranking"](spark, SF_DIR))
    assert "WindowGroupLimit" in plan(registered.QUERIES["top5_concentration"](spark, SF_DIR))


def test_big_dimension_is_not_broadcast(spark):
    with conf(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        for name in ("city_ranking", "legal_nature_share", "region_mei_density"):
            df = registered.QUERIES[name](spark, SF_DIR)
            df.collect()
            assert "Broadcast" not in plan(df, "simple").split("Initial Plan")[0]


SMALL_PIECES = {
    "spark_sql_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "16KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "32KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "2",
}


def test_hot_keys_are_split_on_either_side(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    many = spark.range(0, 90000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    few = spark.range(0, 90000, 1, 8).select(hot.alias("k")).distinct()
    with conf(spark, **SMALL_PIECES):
        for df in (joins.left_join(few, many, "k"), joins.anti_join(many, few.where("k <> 'hot'"), "k"), joins.semi_join(many, few, "k")):
            df.collect()
            assert "skew=true" in plan(df, "simple")


def test_pair_counts_beyond_a_long(spark):
    held = spark.createDataFrame([("SP", "hot", 10**11), ("SP", "a", 5)], "uf string, cnpj_basico string, establishments long")
    master = spark.createDataFrame([("hot", "10,00"), ("a", "99,00")], "cnpj_basico string, capital_social string")
    hist = company_reports.capital_histogram(held, master).withColumn("times", F.col("times") * 10**11)
    by_state = company_reports._winsorized(hist, "0.90").first()
    assert (int(by_state["n"]), by_state["p90"]) == ((10**11 + 5) * 10**11, 10.0)
    assert by_state["avg_cap_w"] == pytest.approx(10.0)


def test_hot_company_is_one_row_before_the_capital_join(spark):
    """A company with a third of all establishments and of all master rows."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    held = spark.range(0, 60000, 1, 8).select(F.lit("SP").alias("uf"), key.alias("cnpj_basico")).groupBy("uf", "cnpj_basico").agg(
        F.count(F.lit(1)).alias("establishments"))
    master = spark.range(0, 60000, 1, 8).select(key.alias("cnpj_basico"), F.lit("10,00").alias("capital_social"))
    rows = company_reports.capital_histogram(held, master).collect()
    # 20,000 x 20,000 pairs of the hot company, counted without being produced
    assert [(r["uf"], float(r["cap"]), r["times"]) for r in rows] == [("SP", 10.0, 20000 ** 2 + 40000)]
