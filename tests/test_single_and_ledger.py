"""One archive with its count as a gate, and the ledger that lets each archive count once."""

import zipfile

import pytest

from registria.plans import single
from registria.sources import delimited
from registria.streaming import ledger

from .test_sources import estab, make_zips

LINES = [estab(f"{i:08}", name="a\nb" if i % 3 == 0 else "N") for i in range(20)]


def zip_of(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("_", "."), text)
    return str(path)


@pytest.mark.parametrize("expected, ok", [(None, True), (21, True), (20, False), (22, False)])
def test_counts_are_the_gate(spark, tmp_path, expected, ok):
    """20 sound rows, some over two lines, and one that breaks a rule; the smaller member is left out."""
    archive = zip_of(tmp_path / "E0.zip", K1_ESTABELE="".join(LINES) + '"1";"x"\n\n', small_csv="x")
    got = single.load_archive(spark, archive, str(tmp_path / "w"), expected)
    row = got.report.collect()[0]
    assert (got.ok, got.report.count()) == (ok, 1)
    assert (row["file"], row["counted"], row["read"], row["staged"], row["rejected"]) == ("E0__K1.ESTABELE", 21, 21, 20, 1)
    assert row["status"] == ("ok" if ok else "lost rows") and ("expected" in (row["error"] or "")) != ok
    assert got.tables["estabelecimento"].count() == 20 and got.quarantine.count() == 1
    assert got.tables["estabelecimento"].where("nome_fantasia = 'a\nb'").count() == 7


def test_rows_the_reader_loses_close_the_gate(spark, tmp_path, monkeypatch):
    whole = delimited.read_files
    monkeypatch.setattr(delimited, "read_files", lambda *args: whole(*args).where("cnpj_basico <> '00000004'"))
    got = single.load_archive(spark, zip_of(tmp_path / "E0.zip", K1_ESTABELE="".join(LINES)), str(tmp_path / "w"))
    row = got.report.collect()[0]
    assert not got.ok and (row["status"], row["counted"], row["read"]) == ("lost rows", 20, 19)


def test_archives_that_cannot_be_loaded(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        single.load_archive(spark, str(tmp_path / "none.zip"), str(tmp_path / "w0"))
    (tmp_path / "html.zip").write_text("<html>")
    cases = {"html": str(tmp_path / "html.zip"), "text": zip_of(tmp_path / "t.zip", a_txt="x"), "layout": zip_of(tmp_path / "l.zip", a_csv="x"),
             "quote": zip_of(tmp_path / "q.zip", K_ESTABELE='"1;2\n')}
    for name, status in (("html", "corrupt"), ("text", "no csv member"), ("layout", "unknown layout"), ("quote", "failed")):
        got = single.load_archive(spark, cases[name], str(tmp_path / f"w-{name}"))
        assert not got.ok and [r["status"] for r in got.report.collect()] == [status] and not got.tables
    named = single.load_archive(spark, zip_of(tmp_path / "m.zip", a_csv='"1";"X"\n'), str(tmp_path / "w1"), 1, layout="motivo")
    assert named.ok and named.tables["motivo"].count() == 1
    empty = single.load_archive(spark, zip_of(tmp_path / "e.zip", K_ESTABELE=""), str(tmp_path / "w2"), 0)
    assert empty.ok and empty.report.collect()[0]["counted"] == 0


def test_each_archive_counts_once(spark, tmp_path, monkeypatch):
    """A driver lost between load and commit, a repeated batch, a lost checkpoint: the same rows."""
    make_zips(tmp_path / "zip")
    paths = [str(tmp_path / p) for p in ("zip", "work", "root")]

    def run(checkpoint="checkpoint"):
        query = ledger.start_loading(spark, *paths, str(tmp_path / checkpoint))
        query.awaitTermination()
        return sorted(r["status"] for r in spark.read.parquet(f"{paths[2]}/outcomes").collect())

    def rows():
        found = {name: ledger.table(spark, paths[2], name) for name in ("empresas", "estabelecimento", "municipio")}
        return {name: df.count() if df is not None else 0 for name, df in found.items()}

    class Lost(BaseException):
        pass

    def lost(*args):  # nothing after the load is done
        raise Lost

    def late(*args):  # all is entered, but the batch itself is not done
        load(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "commit", lost)
        with pytest.raises(Lost):
            ledger.load_archives(spark, ledger.pending(spark, paths[0], paths[2]), paths[1], paths[2])
    assert set(rows().values()) == {0}
    load = ledger.load_archives
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "load_archives", late)
        with pytest.raises(Exception, match="driver lost"):
            run()
    want = rows()
    assert want["estabelecimento"] == 4 and want["municipio"] == 1 and want["empresas"] >= 1
    assert run() == ["known"] * 3 and rows() == want  # the same batch again
    assert run("another checkpoint") == ["known"] * 3 and rows() == want  # the batch's outcomes are replaced
    (tmp_path / "zip" / "Paises.zip").write_text("<html>")
    run()
    assert rows() == want and [a["path"].rsplit("/", 1)[1] for a in ledger.pending(spark, paths[0], paths[2])] == ["Paises.zip"]
    zip_of(tmp_path / "zip" / "Paises.zip", PAISCSV='"1";"X"\n')
    done = ledger.load_archives(spark, ledger.pending(spark, paths[0], paths[2]), paths[1], paths[2])
    assert [r["status"] for r in done.collect()] == ["entered"] and ledger.table(spark, paths[2], "pais").count() == 1
    assert rows() == want and not ledger.pending(spark, paths[0], paths[2])


def test_an_archive_entered_twice_at_once(spark, tmp_path):
    assert ledger.commit(spark, str(tmp_path), "0" * 24, {"a": "x"}) is True
    assert ledger.commit(spark, str(tmp_path), "0" * 24, {"a": "y"}) is False
    assert ledger.entries(spark, str(tmp_path)) == {"0" * 24: {"a": "x"}}
