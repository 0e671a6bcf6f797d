"""Content facts by stretch, files staged one by one, quarantine and replay, versions of published tables."""

import random
import threading

import pytest

from registria.plans import ingest, publish, quarantine, resolve, versions
from registria.sources import content, files
from registria.sources.content import Content


# Facts of bytes that can be joined

def plainly(data: bytes) -> tuple:
    try:
        data.decode("utf-8")
        encoding = "utf-8-sig" if data.startswith(b"\xef\xbb\xbf") else "utf-8"
    except UnicodeDecodeError:
        encoding = "latin-1"
    inside = breaks = False
    for b in data:
        inside ^= b == ord('"')
        breaks |= inside and b in b"\r\n"
    return encoding, breaks, inside


@pytest.mark.parametrize("seed", range(6))
def test_content_of_any_cut_and_grouping(seed):
    draw = random.Random(seed)
    alphabet = ["a", '"', "\n", "é", "漢", "🙂", "﻿", ";"]
    for _ in range(400):
        data = b"".join(draw.choice(alphabet).encode() for _ in range(draw.randint(0, 9)))
        if draw.random() < 0.4 and data:  # damaged somewhere
            at = draw.randrange(len(data))
            data = data[:at] + bytes([draw.randrange(128, 256)]) * draw.randint(0, 5) + data[at + draw.randint(0, 1):]
        cuts = sorted(draw.randint(0, len(data)) for _ in range(draw.randint(0, 6)))
        parts = [Content.unpacked(Content.of(data[a:b]).packed()) for a, b in zip([0, *cuts], [*cuts, len(data)])]
        while len(parts) > 1:  # in any grouping
            i = draw.randrange(len(parts) - 1)
            parts[i:i + 2] = [Content.unpacked((parts[i] + parts[i + 1]).packed())]
        assert (parts[0].encoding, parts[0].multiline, parts[0].unterminated) == plainly(data), (data, cuts)


def test_contents_of_files_by_block(spark, tmp_path):
    texts = {"a": "Ãé漢🙂".encode() * 500, "b": b"\xef\xbb\xbf" + b'"x\ny"' * 300, "c": b"ok" * 900 + b"\xff", "d": b"", "e": b'"' + "ü".encode() * 700}
    for name, data in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    listed = files.list_files(spark, str(tmp_path), ".csv").select("path", "length").union(
        spark.createDataFrame([(str(tmp_path / "gone.csv"), 10), (str(tmp_path / "d.csv"), 0)], "path string, length long"))
    for block in (97, 1 << 20):
        got = {r["path"].rsplit("/", 1)[1][:-4]: r for r in content.contents(listed, block).collect()}
        assert {k: (r["encoding"], r["multiline"], r["unterminated"]) for k, r in got.items() if k != "gone"} == {k: plainly(d) for k, d in texts.items()}
        assert "FileNotFound" in got["gone"]["error"]


# Staging file by file

def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_one_bad_file_among_ten(spark, tmp_path, monkeypatch):
    folder = tmp_path / "csv"
    for i in range(10):
        write(folder, f"motivo{i}.csv", f'"0{i}";"x"\n')
    whole, staged_files = ingest.marked_rows, []

    def broken(spark, layout, profile):
        staged_files.append(profile[0][0].rsplit("/", 1)[1])
        if "motivo4" in profile[0][0]:
            raise OSError("disk gone")
        return whole(spark, layout, profile)

    monkeypatch.setattr(ingest, "marked_rows", broken)
    staged = ingest.load(spark, str(folder), str(tmp_path / "staging"), database="ten")
    report = {r["file"]: (r["rows"], r["status"], r["error"]) for r in staged.report.collect()}
    assert report.pop("motivo4.csv") == (0, "failed", "OSError: disk gone")
    assert set(report.values()) == {(1, "ok", None)} and len(report) == 9 and not staged.ok
    assert staged.tables["motivo"].count() == spark.table("ten.temp_motivo").count() == 9
    assert len(staged_files) == 10

    monkeypatch.setattr(ingest, "marked_rows", whole)
    write(folder, "motivo7.csv", '"07";"changed"\n"77";"y"\n')
    times = {p: p.stat().st_mtime_ns for p in (tmp_path / "staging" / "motivo").glob("unit=*/_SUCCESS")}
    staged = ingest.load(spark, str(folder), str(tmp_path / "staging"), database="ten")
    assert staged.ok and staged.tables["motivo"].count() == spark.table("ten.temp_motivo").count() == 11
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "staging" / "motivo").glob("unit=*/_SUCCESS")}
    assert len(after) == len(times) + 2 and all(after[p] == t for p, t in times.items())  # only two were staged


def test_a_layout_without_a_good_file(spark, tmp_path):
    write(tmp_path / "csv", "motivo.csv", '"1\n')
    write(tmp_path / "csv", "pais.csv", '"1"\n')  # malformed: no sound row
    staged = ingest.load(spark, str(tmp_path / "csv"), str(tmp_path / "staging"), database="bare")
    assert {r["file"]: (r["read"], r["rows"], r["rejected"], r["status"]) for r in staged.report.collect()} == {
        "motivo.csv": (0, 0, 0, "failed"), "pais.csv": (1, 0, 1, "ok")}
    assert "motivo" not in staged.tables and staged.tables["pais"].count() == 0
    assert not spark.catalog.tableExists("bare.temp_pais")


# Quarantine

@pytest.mark.parametrize("multiline", [False, True])
def test_quarantine_knows_file_and_record(spark, tmp_path, multiline):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # many blocks a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        draw, want, total = random.Random(3), set(), {}
        for name in ("motivo a+b%20.csv", "motivo z.csv"):
            lines = []
            for i in range(1, 301):
                kind = draw.choice(["good"] * 5 + ["null", "more"] + ["broken"] * multiline)
                lines.append({"good": f'"0{i % 10}";"text"', "null": '"01";', "more": '"01";"a";"b"', "broken": '"02";"two\nlines\n"'}[kind])
                if kind in ("null", "more"):
                    want.add((name, i, "null:descricao" if kind == "null" else "malformed"))
            write(tmp_path / "csv", name, "\n".join(lines) + "\n")
            total[name] = 300
        staged = ingest.load(spark, str(tmp_path / "csv"), str(tmp_path / "staging"), run_id="r", database="aside")
        got = staged.quarantine.collect()
        assert {(r["file"], r["record"], *r["reasons"]) for r in got} == want and len(got) == len(want)
        assert {r["file"]: r["read"] for r in staged.report.collect()} == total
        assert all(r["rows"] + r["rejected"] == r["read"] for r in staged.report.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_replay_of_corrected_rows(spark, tmp_path):
    import zipfile

    (tmp_path / "zip").mkdir()
    with zipfile.ZipFile(tmp_path / "zip" / "m.zip", "w") as z:
        z.writestr("MOTICCSV", '"01";"ok"\n"02";\n"03";"a";"b"\n"04";\n')
    run = lambda **kw: ingest.run_ingest(spark, str(tmp_path / "zip"), str(tmp_path / "w"), str(tmp_path / "p"), "m1", **kw)
    first = run()
    assert [(r["read"], r["rows"], r["rejected"]) for r in first.report.collect()] == [(4, 1, 3)]
    published = versions.current(spark, str(tmp_path / "p"))
    assert published.table(spark, "motivo").count() == 1 and published.table(spark, "quarantine").count() == 3
    name = first.quarantine.first()["file"]
    corrections = spark.createDataFrame(
        [(name, 2, ["02", "mended"]), (name, 3, ["03"]), (name, 1, ["01", "not in quarantine"]), (name, 2, ["02", "other"])],
        "file string, record long, fields array<string>")
    again = run(corrections=corrections)
    assert [(r["read"], r["rows"], r["rejected"], r["status"]) for r in again.report.collect()] == [(4, 2, 2, "ok")]
    rows = sorted(tuple(r) for r in versions.current(spark, str(tmp_path / "p")).table(spark, "motivo").collect())
    assert rows == [("01", "ok"), ("02", "mended")]
    left = {r["record"]: (r["reasons"], r["fields"]) for r in again.quarantine.collect()}
    assert left == {3: (["malformed"], ["03"]), 4: (["null:descricao"], ["04", None])}
    sound, rest = quarantine.replay(again.quarantine.where("false"), corrections, "motivo")
    assert sound.count() == rest.count() == 0


# Versions

def tables(spark, month, more=False):
    columns = "cast(id as string) as codigo, '%s' as descricao%s" % (month, ", 'new' as note" if more else "")
    return {"motivo": spark.range(50).selectExpr(*columns.split(", ")), "pais": spark.range(60).selectExpr(*columns.split(", "))}


def test_readers_see_whole_runs_while_the_schema_changes(spark, tmp_path):
    root, stop, seen, failures = str(tmp_path), threading.Event(), set(), []
    publish.promote(spark, tables(spark, "m0"), True, root, "m0", database="live")

    def read():
        while not stop.is_set():
            try:
                version = versions.current(spark, root)
                months = {r[0] for t in ("motivo", "pais") for r in version.table(spark, t).select("descricao").distinct().collect()}
                assert months == {version.run_id}, months
                named = [r[0] for r in spark.sql("select descricao, count(*) from live.motivo group by 1").collect()]
                assert len(named) == 1, named
                seen.add(version.run_id)
            except Exception as error:
                failures.append(repr(error))

    readers = [threading.Thread(target=read) for _ in range(3)]
    for reader in readers:
        reader.start()
    for i in range(1, 7):
        done = publish.promote(spark, tables(spark, f"m{i}", more=i % 2 == 1), True, root, f"m{i}", database="live")
        assert done.where("action = 'promoted'").count() == 2
    stop.set()
    for reader in readers:
        reader.join()
    assert not failures and len(seen) > 1
    assert spark.table("live.motivo").columns == ["codigo", "descricao"] and spark.table("live_runs.motivo_m5_" + path_end(spark, root, 6)).columns[-1] == "note"


def path_end(spark, root, number):
    return versions.read(spark, root, number).tables["motivo"].rsplit("-", 1)[1]


def test_a_run_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish.promote(spark, tables(spark, "a"), True, root, "a", database="early")
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish.promote(spark, tables(spark, "b"), True, root, "b", database="early")
    assert versions.current(spark, root).run_id == "a" and spark.table("early.motivo").first()["descricao"] == "a"
    with monkeypatch.context() as m:  # after the pointer, before the views: repeating show() finishes
        m.setattr(versions, "show", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish.promote(spark, tables(spark, "b"), True, root, "b", database="early")
    version = versions.current(spark, root)
    assert version.run_id == "b" and spark.table("early.motivo").first()["descricao"] == "a"
    versions.show(spark, "early", version)
    assert spark.table("early.motivo").first()["descricao"] == spark.table("early.pais").first()["descricao"] == "b"


def test_failed_tables_and_withheld_runs(spark, tmp_path):
    root = str(tmp_path)
    publish.promote(spark, tables(spark, "a"), True, root, "a", database="part")
    bad = tables(spark, "b") | {"pais": spark.range(1).selectExpr("raise_error('boom') as codigo")}
    done = {r["table"]: r["action"] for r in publish.promote(spark, bad, True, root, "b", database="part", all_or_nothing=True).collect()}
    assert (done["motivo"], done["pais"]) == ("withheld", "failed") and versions.current(spark, root).run_id == "a"
    done = {r["table"]: r["action"] for r in publish.promote(spark, bad, True, root, "b", database="part").collect()}
    assert (done["motivo"], done["pais"]) == ("promoted", "failed")
    assert spark.table("part.motivo").first()["descricao"] == "b" and spark.table("part.pais").first()["descricao"] == "a"


def test_restore_mount_and_expire(spark, tmp_path):
    root = str(tmp_path)
    for month in "abc":
        publish.promote(spark, tables(spark, month, more=month == "b"), True, root, month, database="back")
    assert versions.restore(spark, root, 2).number == 4
    version = versions.mount(spark, root)
    assert version.run_id == "b" and spark.table("motivo").first()["note"] == "new"
    assert resolve.Registry.of(spark, version).fact is None
    versions.show(spark, "back", version)
    gone = versions.expire(spark, root, "back", keep=2)
    assert len(gone) == 2 and versions.numbers(spark, root) == [3, 4]
    assert spark.table("back.motivo").first()["note"] == "new" and versions.read(spark, root, 3).table(spark, "pais").count() == 60
    assert not any(db.endswith(versions.RUNS) for db in resolve._databases(spark))
    with pytest.raises(ValueError):
        versions.mount(spark, str(tmp_path / "nothing"))
    for view in ("motivo", "pais"):
        spark.catalog.dropTempView(view)


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    root, whole, held = str(tmp_path), versions.current, []
    versions.publish(spark, root, "a", {"x": "1"})

    def late(spark, root):  # sees the state before the other run published
        if not held:
            held.append(whole(spark, root))
            versions.publish(spark, root, "other", {"y": "2"})
            return held[0]
        return whole(spark, root)

    monkeypatch.setattr(versions, "current", late)
    mine = versions.publish(spark, root, "mine", {"z": "3"})
    assert mine.number == 3 and mine.tables == {"x": "1", "y": "2", "z": "3"}


def test_local_targets_are_refused_on_a_cluster(spark, tmp_path, monkeypatch):
    assert files.qualified(spark, str(tmp_path)).startswith("file:/")
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(ValueError):
        files.qualified(spark, str(tmp_path))
