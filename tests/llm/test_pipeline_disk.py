"""What the stages of the pipeline leave on disk, and that reading a table again gives what a stored copy gives."""

import contextlib
import io
import os
import random
from collections import Counter

import pytest

import corpus_pipeline
from registria.llm import common, dedup_tree, mixing, near_paths

from .fixtures import SCHEMA, odd_rows, rows_of, save


def corpus(spark, n: int = 400, ids=lambda i: i):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(draw.choices(words, k=draw.randint(30, 120))) for _ in range(n // 2)]
    texts += [t if i % 2 else t + " tail" for i, t in enumerate(texts)]  # half are copies, exact or near
    rows = [(ids(i), t, "en", f"s{i % 3}", len(t), -1, -1, False, "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "n_chars")


def stored_tables(spark) -> set[str]:
    folder = common.shared_folder(spark)
    return {f"{folder}/{x}" for x in os.listdir(folder)} if os.path.isdir(folder) else set()


@pytest.mark.parametrize("stage", ["exact dedup", "near dedup", "mixing"])
def test_stages_leave_no_texts_and_nothing_of_their_way(spark, tmp_path, stage):
    folder = save(corpus(spark), tmp_path)
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), stored_tables(spark)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, folder)
    out.write.parquet(f"{folder}/out")
    assert 0 < spark.read.parquet(f"{folder}/out").count() != docs.count()
    left = stored_tables(spark) - before
    assert len(left) == 1 and not any("text" in spark.read.parquet(x).columns for x in left)


@pytest.mark.parametrize("dedup", [dedup_tree.deduplicated, near_paths.deduplicated])
def test_few_rows_that_go_shuffle_no_text(spark, tmp_path, dedup):
    docs = spark.read.parquet(f"{save(corpus(spark), tmp_path)}/documents.parquet")
    with contextlib.redirect_stdout(shown := io.StringIO()):
        dedup(docs, reread=True).explain()
    assert "hashpartitioning" not in shown.getvalue()


@pytest.mark.parametrize("ids", ["own", "repeated", "missing", "odd"])
def test_read_again_gives_the_rows_of_a_copy(spark, tmp_path, ids):
    if ids == "odd":
        docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    else:
        docs = corpus(spark, 120, {"own": lambda i: 1000 - i, "repeated": lambda i: i // 3, "missing": lambda i: None if i == 7 else i}[ids])
    table = spark.read.parquet(f"{save(docs, tmp_path)}/documents.parquet")
    for f in (dedup_tree.deduplicated, near_paths.deduplicated):
        again, copied = (Counter(map(str, rows_of(f(table, reread=r)))) for r in (True, False))
        assert again == copied
    again, copied = (rows_of(mixing.mixed_documents(table, block=64, reread=r)) for r in (True, False))
    assert again == copied and again


def test_rows_are_told_apart_by_whole_ids_only(spark, tmp_path):
    table = spark.read.parquet(f"{save(corpus(spark, 40), tmp_path)}/documents.parquet")
    before = stored_tables(spark)
    common.told_apart(table, True)
    assert stored_tables(spark) == before
    for other in (table.withColumn("doc_id", table["doc_id"].cast("string")), table.union(table)):
        rows, row, _ = common.told_apart(other, True)
        assert rows.select(row).distinct().count() == other.count()
        assert stored_tables(spark) != before
        before = stored_tables(spark)


def test_settled_deletes_what_was_stored_on_the_way(spark):
    before = stored_tables(spark)

    def make():
        inner = common.settled(lambda: common.stored(spark.range(5), "a").where("id > 1"), "b")
        return common.stored(inner.union(inner), "c").where("id < 4")

    table = common.settled(make, "d")
    assert sorted(r["id"] for r in table.collect()) == [2, 2, 3, 3]
    assert len(stored_tables(spark) - before) == 1
    common.stored(spark.range(1), "e")
    assert len(stored_tables(spark) - before) == 2
