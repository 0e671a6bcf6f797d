"""Files as the registry delivers them, written into a fresh folder."""

import random
import zipfile
from datetime import date

import pytest

from registria.plans import ingest, publish, resolve
from registria.sources import archives, content, delimited, files, geometry, links
from registria.streaming.intake import start_intake

EMPRESAS = (
    '"00000001";"ACME ""X"" \\ LTDA";"2062";"49";"1000,50";"01";""\n'
    '"00000002";;"2062";"49";"";"";\n'
    '"00000003";"B";"206-2";"49";"";"";""\n'
    '"00000004";"C";"2062";"49";"5,00";"03";\n'
)


def estab(key, order="0001", name="N", start="20200101", uf="SP", city="7107"):
    row = [key, order, "00", "1", name, "02", "20200101", "00", "", "", start, "4711301", "", "RUA", "X", "1",
           "", "B", "01000000", uf, city, "11", "12345678", "", "", "", "", "a@b.c", "", ""]
    return ";".join(f'"{v}"' for v in row) + "\n"


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return path


@pytest.mark.parametrize("chunks, want", [
    (["ÃO".encode("latin-1")], "latin-1"),
    (["ÃO".encode()], "utf-8"),
    ([b"\xef\xbb\xbfA"], "utf-8-sig"),
    ([b"plain"], "utf-8"),
    ([b"a" * 9 + "Ã".encode()[:1], "Ã".encode()[1:]], "utf-8"),  # straddles two chunks
    ([b"a" * 9 + "Ã".encode()[:1]], "latin-1"),  # the file really ends there
    ([], "utf-8"),
])
def test_detect_encoding(chunks, want):
    assert delimited.detect_encoding(iter(chunks)) == want


def test_encodings_read_whole_files(spark, tmp_path):
    size = content.CHUNK_BYTES
    write(tmp_path, "cut.csv", b"a" * (size - 1) + "Ã".encode() + b"b" * 50)
    write(tmp_path, "late.csv", b"a" * (size + 10) + b"\xff")
    write(tmp_path, "latin.csv", "SÃO", "latin-1")
    got = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in delimited.encodings(files.list_files(spark, str(tmp_path), ".csv")).collect()}
    assert got == {"cut.csv": "utf-8", "late.csv": "latin-1", "latin.csv": "latin-1"}


@pytest.mark.parametrize("encoding, kind", [("latin-1", "latin-1"), ("utf-8", "utf-8"), ("utf-8-sig", "utf-8-sig")])
def test_encodings_give_the_same_text(spark, tmp_path, encoding, kind):
    path = write(tmp_path, "munic.csv", '"7107";"SÃO PAULO"\n', encoding)
    for multiline in (False, True):
        rows = delimited.read_files(spark, "municipio", [(str(path), kind, multiline)]).collect()
        assert [(r["codigo"], r["descricao"]) for r in rows] == [("7107", "SÃO PAULO")]


def test_quotes_blanks_and_nulls(spark, tmp_path):
    path = write(tmp_path, "e.csv", EMPRESAS)
    rows = {r["cnpj_basico"]: r for r in delimited.read_files(spark, "empresas", [(str(path), "utf-8", False)]).collect()}
    assert rows["00000001"]["razao_social"] == 'ACME "X" \\ LTDA'
    assert rows["00000001"]["ente_federativo_responsavel"] == ""
    assert rows["00000002"]["razao_social"] is None and rows["00000002"]["capital_social"] == ""
    assert rows["00000002"]["ente_federativo_responsavel"] is None
    assert all(r[delimited.CORRUPT] is None for r in rows.values())


def test_blank_dates_are_null(spark, tmp_path):
    path = write(tmp_path, "s.csv", '"00000001";"S";"20200101";"";"N";"";""\n')
    row = delimited.read_files(spark, "simples", [(str(path), "utf-8", False)]).first()
    assert (row["data_opcao_simples"], row["data_exclusao_simples"], row["data_opcao_mei"]) == ("20200101", None, None)


def test_breaks_and_nuls(spark, tmp_path):
    broken = write(tmp_path, "b.csv", estab("1", name="two\nlines") + estab("2", name="nul\x00"))
    plain = write(tmp_path, "p.csv", estab("3"))
    found = {r["path"].rsplit("/", 1)[1]: r["multiline"] for r in content.contents(files.list_files(spark, str(tmp_path), '.csv')).collect()}
    assert found == {"b.csv": True, "p.csv": False}
    profile = [(str(broken), "utf-8", True), (str(plain), "utf-8", False)]
    names = sorted(r["nome_fantasia"] for r in delimited.read_files(spark, "estabelecimento", profile).collect())
    assert names == ["N", "nul", "two\nlines"]


@pytest.fixture
def tiny_blocks(spark):
    """Reads files in blocks of a few hundred bytes."""
    small = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_broken_records_over_many_blocks(spark, tmp_path, tiny_blocks, encoding):
    rng = random.Random(11)
    want, texts = [], ["", ""]
    for i in range(400):
        name = rng.choice(["plain", 'q"uote', "two\nlines", "a\n\nb;c", "ÃO\r\nx", '"\n"', "long\n" * rng.randrange(1, 120), ""])
        want.append((f"{i:08}", name, None if i % 2 else ""))
        last = "" if i % 2 else '""'
        texts[i % 2] += f'"{i:08}";"{name.replace(chr(34), chr(34) * 2)}";"2062";"49";"1,00";"01";{last}\n'
    paths = [str(write(tmp_path, f"empre{n}.csv", t, encoding)) for n, t in enumerate(texts)]
    assert all(r["multiline"] and not r["unterminated"] for r in content.contents(files.list_files(spark, str(tmp_path), '.csv'), 100).collect())
    got = delimited.read_files(spark, "empresas", [(p, encoding, True) for p in paths]).collect()
    assert sorted((r["cnpj_basico"], r["razao_social"], r["ente_federativo_responsavel"]) for r in got) == want
    assert all(r[delimited.CORRUPT] is None for r in got)


def test_broken_records_with_windows_line_ends_and_bare_values(spark, tmp_path, tiny_blocks):
    rng = random.Random(12)
    want, text = [], ""
    for i in range(300):
        kind = rng.randrange(4)
        name, shown = [("bare", "bare"), (None, ""), ("", '""'), ("in\r\nside", '"in\r\nside"')][kind]
        last, end = rng.choice([("x", "x"), ("x", '"x"'), (None, ""), ("", '""')])
        want.append((f"{i:08}", name, last))
        text += f"{i:08};{shown};2062;49;;01;{end}\r\n"
    path = str(write(tmp_path, "empre.csv", text))
    got = delimited.read_files(spark, "empresas", [(path, "utf-8", True)]).collect()
    assert sorted((r["cnpj_basico"], r["razao_social"], r["ente_federativo_responsavel"]) for r in got) == want
    assert all(r[delimited.CORRUPT] is None and r["capital_social"] is None for r in got)


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    for multiline in (False, True):
        path = write(tmp_path, f"munic{multiline}.csv", b'"7107";"S\xffO"\n')
        row = delimited.read_files(spark, "municipio", [(str(path), "utf-8", multiline)]).first()
        assert row["descricao"] == "S\ufffdO"


@pytest.mark.parametrize("size", [1, 3, 1000])
@pytest.mark.parametrize("text, multiline, never_ends", [
    ('"a";"b"\n"c""d";"e"\n', False, False),
    ('"a\nb"\n', True, False), ('"a\rb"', True, False), ('"a"\n"b', False, True), ("", False, False), ('"x\n', True, True),
])
def test_quote_state(text, multiline, never_ends, size):
    state = content.content_of(text[i:i + size].encode() for i in range(0, len(text), size))
    assert (state.multiline, state.unterminated) == (multiline, never_ends)


def test_load_takes_the_manifest_at_its_word(spark, tmp_path):
    (tmp_path / "zip").mkdir()
    for name, text in {"a": '"01";"two\nlines"\n"02";"x"\n', "b": '"03";"never\n', "c": '"04";"y"\n'}.items():
        with zipfile.ZipFile(tmp_path / "zip" / f"{name}.zip", "w") as z:
            z.writestr("MOTICCSV", text)
    manifest = archives.expand(spark, str(tmp_path / "zip"), str(tmp_path / "csv"), str(tmp_path / "m"))
    flags = {r["archive"][-5:]: (r["multiline"], r["unterminated"]) for r in manifest.collect()}
    assert flags == {"a.zip": (True, False), "b.zip": (True, True), "c.zip": (False, False)}
    again = archives.expand(spark, str(tmp_path / "zip"), str(tmp_path / "csv"), str(tmp_path / "m2"))
    for known in (manifest, again, None):  # the second knows nothing, as all members existed
        staged = ingest.load(spark, str(tmp_path / "csv"), str(tmp_path / "staging"), database="told", manifest=known)
        assert [r["status"] for r in staged.report.collect()] == ["ok", "failed", "ok"]
        assert {r["descricao"] for r in staged.tables["motivo"].collect()} == {"two\nlines", "x", "y"}


def test_unterminated_file_fails_alone(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder, "motivo1.csv", '"01";"ok"\n')
    write(folder, "motivo2.csv", '"02";"never closed\n"03";"x"\n')
    staged = ingest.load(spark, str(folder), str(tmp_path / "staging"))
    assert not staged.ok and staged.tables["motivo"].count() == 1
    assert [r["status"] for r in staged.report.collect()] == ["ok", "failed"]


def make_zips(folder):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / "Empresas0.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K3241.EMPRECSV", EMPRESAS)
        z.writestr("sub/K3242.EMPRECSV", '"00000005";"D";"2062";"49";"1,00";"01";""\n')
    with zipfile.ZipFile(folder / "Estabelecimentos0.ZIP", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K1.ESTABELE", "".join(estab(f"{i:08}", start=s) for i, s in enumerate(["20200101", "0", "20211301", "20190315"])))
    with zipfile.ZipFile(folder / "Municipios.zip", "w") as z:
        z.writestr("F.MUNICCSV", '"7107";"SÃO PAULO"\n'.encode("latin-1"))


def test_expand(spark, tmp_path):
    source = tmp_path / "zip"
    make_zips(source)
    write(source, "b.zip", "<html>not a zip</html>")
    got = {(r["archive"].rsplit("/", 1)[1], r["status"]): r for r in
           archives.expand(spark, str(source), str(tmp_path / "csv"), str(tmp_path / "m1")).collect()}
    assert ("b.zip", "corrupt") in got and len(got) == 4
    names = sorted(p.name for p in (tmp_path / "csv").iterdir() if not p.name.startswith("."))
    assert names == [
        "Empresas0_K3241.EMPRECSV.csv", "Empresas0_K3242.EMPRECSV.csv",
        "Estabelecimentos0_K1.ESTABELE.csv", "Municipios_F.MUNICCSV.csv",
    ]
    assert (tmp_path / "csv" / "Municipios_F.MUNICCSV.csv").read_bytes() == '"7107";"SÃO PAULO"\n'.encode("latin-1")
    again = archives.expand(spark, str(source), str(tmp_path / "csv"), str(tmp_path / "m2"))
    assert sorted(r["status"] for r in again.collect()) == ["corrupt"] + ["exists"] * 4
    first = archives.expand(spark, str(source), str(tmp_path / "csv2"), str(tmp_path / "m3"), limit=1)
    assert {r["archive"].rsplit("/", 1)[1] for r in first.collect()} == {"Empresas0.zip"}


def test_members_of_one_name_are_all_extracted(spark, tmp_path):
    for folder, rows in (("p", "12"), ("q", "3")):
        (tmp_path / "zip" / folder).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "zip" / folder / "a.zip", "w") as z:
            for row in rows:
                z.writestr(f"{row}/EMPRE", row)
    listed = spark.createDataFrame([(f"{tmp_path}/zip/{f}/a.zip",) for f in "pq"], "path string")
    done = archives.extract(listed, str(tmp_path / "csv")).collect()
    assert [r["status"] for r in done] == ["extracted"] * 3
    assert sorted(open(files.resolve(r["out_path"])[1]).read() for r in done) == ["1", "2", "3"]


def test_damaged_member_is_reported(spark, tmp_path):
    source = tmp_path / "zip"
    make_zips(source)
    damaged = bytearray((source / "Estabelecimentos0.ZIP").read_bytes())
    damaged[60:90] = b"\xff" * 30  # inside the compressed data
    (source / "Estabelecimentos0.ZIP").write_bytes(damaged)
    got = archives.expand(spark, str(source), str(tmp_path / "csv"), str(tmp_path / "m"))
    found = {r["archive"].rsplit("/", 1)[1]: r["status"] for r in got.collect()}
    assert found == {"Empresas0.zip": "extracted", "Estabelecimentos0.ZIP": "failed", "Municipios.zip": "extracted"}
    assert not [p.name for p in (tmp_path / "csv").iterdir() if "Estabele" in p.name and not p.name.startswith(".")]


def test_largest_member(spark, tmp_path):
    source = tmp_path / "zip"
    make_zips(source)
    with zipfile.ZipFile(source / "mixed.zip", "w") as z:
        z.writestr("big.txt", "x" * 999)
        z.writestr("a.csv", "x" * 5)
        z.writestr("dir/ESTABELE", "x" * 50)
    listed = archives.members(files.list_files(spark, str(source), ".zip"))
    got = {r["archive"].rsplit("/", 1)[1]: (r["member"], r["out_name"]) for r in archives.largest_member(listed).collect()}
    assert got["mixed.zip"] == ("dir/ESTABELE", "mixed__ESTABELE.csv")
    assert got["Estabelecimentos0.ZIP"] == ("K1.ESTABELE", "Estabelecimentos0__K1.ESTABELE")
    write(source, "b.zip", "<html>")
    done = archives.extract_largest(files.list_files(spark, str(source), ".zip"), str(tmp_path / "csv")).collect()
    assert {r["archive"].rsplit("/", 1)[1]: r["status"] for r in done} == {
        "mixed.zip": "extracted", "Estabelecimentos0.ZIP": "extracted", "b.zip": "corrupt",
        "Empresas0.zip": "no csv member", "Municipios.zip": "no csv member",
    }
    assert (tmp_path / "csv" / "mixed__ESTABELE.csv").read_text() == "x" * 50


def test_inventory(spark, tmp_path):
    write(tmp_path, "a.ZIP", b"x" * 1048576)
    write(tmp_path, "b.txt", b"x")
    assert [(r["name"], r["size_mb"]) for r in files.inventory(spark, str(tmp_path)).collect()] == [("a.ZIP", 1.0)]


def test_ingest_end_to_end(spark, tmp_path):
    source = tmp_path / "zip"
    make_zips(source)

    def run(run_id, **options):
        return ingest.run_ingest(spark, str(source), str(tmp_path / "work"), str(tmp_path / "out"), run_id, **options)

    for run_id in ("r1", "r2"):  # publishing twice gives the same tables
        _, report, done, _ = run(run_id)
        assert {r["file"]: (r["layout"], r["rows"], r["rejected"], r["status"]) for r in report.collect()} == {
            "Empresas0_K3241.EMPRECSV.csv": ("empresas", 2, 2, "ok"),
            "Empresas0_K3242.EMPRECSV.csv": ("empresas", 1, 0, "ok"),
            "Estabelecimentos0_K1.ESTABELE.csv": ("estabelecimento", 4, 0, "ok"),
            "Municipios_F.MUNICCSV.csv": ("municipio", 1, 0, "ok"),
        }
        assert {r["table"] for r in done.where("action = 'promoted'").collect()} == {"empresas", "estabelecimento", "municipio", "quarantine"}
        assert {r["error"] for r in done.where("action = 'skipped'").collect()} == {"nothing staged"} and done.count() == 11
        fact = spark.table("curated.estabelecimento")
        assert dict(fact.dtypes)["data_inicio_atividades"] == "date"
        assert sorted((r[0] for r in fact.select("data_inicio_atividades").collect()), key=str) == [
            date(2019, 3, 15), date(2020, 1, 1), None, None]
        assert {r["uf_norm"] for r in fact.collect()} == {"SP"}
        assert spark.table("curated.empresas").count() == 3
        assert spark.table("curated.municipio").first()["descricao"] == "SÃO PAULO"

    found = resolve.Registry.find(spark)
    assert found.fact.count() == 4 and found.simples is None and found.empresas.count() == 3
    assert resolve.fact_table(spark) == "curated.estabelecimento"
    assert resolve.first_table(spark, ["nothing", "temp_empresas"]) == "staging.temp_empresas"
    names = resolve.fact_candidates(spark)
    assert len(names) == len({n.lower() for n in names}) and names[-1] != names[0]
    for name in ("archive.estabelecimento_2019", "warehouse.estabelecimento"):  # before and after by name
        spark.sql(f"create database if not exists {name.split('.')[0]}")
        spark.table("curated.estabelecimento").limit(1).write.mode("overwrite").saveAsTable(name)
    names = resolve.fact_candidates(spark)
    assert names.index("warehouse.estabelecimento") < names.index("staging.temp_estabelecimento") < names.index("archive.estabelecimento_2019")
    assert resolve.fact_table(spark, ["warehouse"]) == "warehouse.estabelecimento"
    spark.sql("drop database archive cascade")
    spark.sql("drop database warehouse cascade")

    # rejected rows clear the gate when asked to; nothing is published then
    _, report, done, _ = run("r3", strict=True)
    assert {r["action"] for r in done.collect()} == {"skipped"}
    assert spark.table("curated.empresas").count() == 3
    assert "rejected rows" in {r["status"] for r in report.collect()}

    # so does a file nobody knows, unless allowed
    run("r4", strict=True)
    write(tmp_path / "work" / "csv" / "r4", "foo.csv", "a;b\n")
    manifest, report, done, _ = run("r4")
    assert {r["status"] for r in manifest.collect()} == {"exists"}
    assert {r["status"] for r in report.collect()} == {"ok", "unknown layout"}
    assert {r["action"] for r in done.collect()} == {"skipped"}
    _, _, done, _ = run("r4", allow_unknown=True)
    assert done.where("action = 'promoted'").count() == 4


def test_malformed_rows_are_set_aside(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder, "motivo.csv", '"01";"ok"\n"02";"too";"many"\n"03"\n')
    staged = ingest.load(spark, str(folder), str(tmp_path / "staging"))
    assert staged.ok and staged.tables["motivo"].count() == 1
    rejected = staged.rejected["motivo"].collect()
    assert len(rejected) == 2 and all(r["reasons"] == ["malformed"] for r in rejected)


def test_mixed_encodings_and_odd_names_in_one_load(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    names = {"F.K03200$Z.D50308.MUNICCSV.csv": "latin-1", "Munic\u00edpios 1+2%20.csv": "utf-8", "z municipio [1]{a}.csv": "utf-8-sig"}
    for i, (name, encoding) in enumerate(names.items()):
        text = f'"710{i}";"S\u00c3O PAULO"\n' + ('"7200";"two\nlines"\n' if encoding == "utf-8" else "")
        write(folder, name, text, encoding)
    staged = ingest.load(spark, str(folder), str(tmp_path / "staging"), database="mixed")
    assert {r["file"]: (r["rows"], r["status"]) for r in staged.report.collect()} == {
        n: (2 if e == "utf-8" else 1, "ok") for n, e in names.items()}
    found = {r["codigo"]: r["descricao"] for r in staged.tables["municipio"].collect()}
    assert found == {"7100": "S\u00c3O PAULO", "7101": "S\u00c3O PAULO", "7102": "S\u00c3O PAULO", "7200": "two\nlines"}
    assert ingest.load(spark, str(folder), str(tmp_path / "s2"), limit_files=1, database="mixed").report.count() == 1
    assert spark.table("mixed.temp_municipio").count() == 1
    (tmp_path / "none").mkdir()
    assert not ingest.load(spark, str(tmp_path / "none"), str(tmp_path / "s3"), database="mixed").ok
    assert not spark.catalog.tableExists("mixed.temp_municipio")


def test_no_file_is_not_ok(spark, tmp_path):
    assert not ingest.load(spark, str(tmp_path), str(tmp_path / "staging")).ok


def test_failed_table_does_not_stop_the_rest(spark, tmp_path):
    good = spark.createDataFrame([("1", "a")], "codigo string, descricao string")
    bad = good.selectExpr("raise_error('boom') as codigo", "descricao")
    done = publish.promote(spark, {"motivo": bad, "pais": good}, True, str(tmp_path), "r1", database="promo")
    found = {r["table"]: r["action"] for r in done.collect()}
    assert (found["motivo"], found["pais"], found["simples"]) == ("failed", "promoted", "skipped")


def test_harden_leaves_dates_and_missing_columns(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), "0")], "data_opcao_simples date, data_opcao_mei string")
    hard = publish.harden_dates("simples", df)
    assert hard.dtypes == [("data_opcao_simples", "date"), ("data_opcao_mei", "date")]
    assert tuple(hard.first()) == (date(2020, 1, 1), None)
    assert publish.harden_dates("pais", df) is df


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "municipio string, qty long")
    publish.export_csv(publish.city_export(df).coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "city,companies\nA,1\n"
    assert publish.city_export_name("SP", "2020-01-01", "2020-12-31") == "cities_sp_2020-01-01_to_2020-12-31"


def test_links(spark):
    html = """<a href="202401/">x</a><a class=z HREF='a.ZIP'>a</a><a href="http://h/b.zip">b</a><a name="q">c</a><a href="">d</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = [r["link"] for r in links.page_links(pages, ".zip", "http://base/").orderBy("pos").collect()]
    assert got == ["http://base/a.ZIP", "http://h/b.zip"]
    assert links.page_links(pages, ".zip", max_links=1).count() == 1
    odd = """<a data-href="x" href="1.zip"><a href=2.zip><a href="d'3.zip"><a title="a>b" href='4.zip'><!-- <a href="no.zip"> -->
        <a\nhref = "5.zip?a=1&amp;b=.zip"><area href="no.zip"><a class hreflang="no.zip">"""
    pages = spark.createDataFrame([(1, odd)], "page_id int, html string")
    got = [r["link"] for r in links.page_links(pages, ".zip").orderBy("pos").collect()]
    assert got == ["1.zip", "2.zip", "d'3.zip", "4.zip", "5.zip?a=1&b=.zip"]
    root = "http://h/data/"
    stored = spark.createDataFrame([
        (1, root, '<a href="202312/">a</a><a href="202403/">b</a><a href="../">c</a>'),
        (2, root + "202312/", '<a href="old.zip">x</a>'),
        (3, root + "202403/", '<a href="x.txt">x</a><a href="A.zip">x</a><a href="http://o/B.ZIP">x</a><a href="C.zip">x</a>'),
    ], "page_id int, url string, html string")
    newest = links.newest_month_links(stored, root, max_links=2)
    assert [r["link"] for r in newest.collect()] == [root + "202403/A.zip", "http://o/B.ZIP"]
    assert links.newest_month_links(stored, "http://nowhere/").count() == 0
    months = spark.createDataFrame([("202312/",), ("202403/",), ("old/",)], "href string")
    assert links.latest(months, "href").first()[0] == "202403/"
    found = spark.createDataFrame([(1, "Empresas1.zip"), (2, "Empresas0.zip"), (3, "Simples.zip"), (4, "z.zip")], "pos int, link string")
    present = spark.createDataFrame([("SIMPLES_old.zip",)], "name string")
    assert [tuple(r) for r in links.one_per_family(found, present).collect()] == [("empresas", "Empresas1.zip")]


GEO = """{"type": "FeatureCollection", "features": [
 {"type": "Feature", "properties": {"sigla": "SP"}, "geometry": {"type": "Polygon", "coordinates": [[[-50, -20], [-48.5, -22, 7], [-49, -2.1e1]]]}},
 {"type": "Feature", "properties": {"sigla": "RJ"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 2]]], [[[4, 1]]]]}},
 {"type": "Feature", "properties": {"sigla": "AM"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
 {"type": "Feature", "properties": {"sigla": "RS"}, "geometry": null},
 {"type": "Feature", "properties": {}, "geometry": null}]}"""


def test_geometry(spark, tmp_path):
    from registria.plans import products

    path = write(tmp_path, "states.geojson", GEO)
    points = geometry.centroids(geometry.read_features(spark, str(path)))
    got = {r["uf"]: (r["lon"], r["lat"]) for r in points.collect()}
    assert got["SP"] == pytest.approx((-147.5 / 3, -21.0)) and got["RJ"] == pytest.approx((2.0, 1.0))
    assert got["AM"] == got["RS"] == (-53.1, -14.2) and len(got) == 4
    stock = spark.createDataFrame([("SP", 9), ("RJ", 4), ("EX", 1)], "uf string, qty long")
    rows = {r["uf"]: r for r in products.map_frame(stock, points, ["rj", "EX"]).collect()}
    assert set(rows) == {"SP", "RJ"} and rows["RJ"]["selected"] and not rows["SP"]["selected"]
    assert (rows["SP"]["vmin"], rows["SP"]["vmax"]) == (1, 9)
    with pytest.raises(ValueError):
        geometry.read_features(spark, str(write(tmp_path, "bad.geojson", '{"type": "Feature"}')))


def test_intake_takes_only_new_archives(spark, tmp_path):
    source = tmp_path / "zip"
    make_zips(source)

    def run():
        args = [str(tmp_path / p) for p in ("zip", "csv", "manifest", "checkpoint")]
        query = start_intake(spark, *args)
        query.awaitTermination()
        if not (tmp_path / "manifest").exists():
            return []
        rows = spark.read.parquet(str(tmp_path / "manifest")).collect()
        return sorted((r["batch"], r["archive"].rsplit("/", 1)[1], r["status"]) for r in rows)

    first = run()
    assert len(first) == 4 and {b for b, _, _ in first} == {0}
    with zipfile.ZipFile(source / "Paises.zip", "w") as z:
        z.writestr("PAISCSV", '"1";"X"\n')
    assert run() == first + [(1, "Paises.zip", "extracted")]
    assert run() == first + [(1, "Paises.zip", "extracted")]
