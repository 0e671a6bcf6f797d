"""Small document tables with every awkward case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank long, kept boolean, node string"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, copies, ties, repeated rows."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(draw.choice(words) for _ in range(n))

    hot, rows = prose(40), []
    for i in range(60):  # one group of copies and one source hold a third of all rows
        rows.append((i, hot if i % 3 == 0 else prose(draw.randint(1, 90)), "en", f"s{i % 5}" if i % 2 else "s0"))
    rows += [
        (100, None, "en", "s1"), (101, "", None, None), (102, " \t\n ", "de", None), (103, "one", "fr", "s2"),
        (104, prose(30000), "en", "s3"), (105, "x" * 50000, None, "s4"), (106, "é ß   ü\r\n<|endoftext|> 1 22  333", "de", "s4"),
        (107, hot + " ", "en", "s1"), (108, hot.upper(), "en", "s1"), (103, "one", "fr", "s2"), (None, "no id here at all", "en", "s1"),
        (None, None, None, None), (109, "don't  stop\n\n\nit's we'll  ", "en", "S2"), (110, "🙂🙂 漢字かな交じり文" * 50, None, "é"),
    ]
    return [(*r, len(r[1] or ""), -1, -1, False, "n") for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def save(docs, folder) -> str:
    """Writes the table where a registered query reads it."""
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)
