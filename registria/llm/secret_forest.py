"""Secret scan: a random forest over candidates, trained on labelled findings, clears false positives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import source_key, stored
from .toxicity import held_out

AROUND = "\"'`()[]{}<>,.;:!?%&$*|#~^\\"
SPACE = r"[\x20\x09-\x0D]+"

# What credentials are commonly called, and how common ones are written.
NAMES = ["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth"]
FORMATS = [r"^AKIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$", r"^sk_live_[A-Za-z0-9]{16,}$"]
# Words may be very long, so every repeated group below is possessive or bounded and no pattern starts anew within a run.
PREFIXES = r"AKIA|gh[pousr]_|xox[abprs]-|sk_live_"
# What tells a run of ten or more characters from a plain word.
TRIGGER = rf"[0-9]|[a-z][A-Z]|[A-Z]{{2}}[a-z]|{PREFIXES}"
NARROW, WIDE = r"[A-Za-z0-9+_.~-]{10,}+", r"[A-Za-z0-9+/_.~-]{10,}+={0,2}"  # the second one also holds base64 with slashes
INSIDE = r"(?<![A-Za-z0-9])(?:" + "|".join(f.strip("^$") for f in FORMATS) + ")"
WITH_NAME = r"([A-Za-z_-]{2,24})[\"'`\])\\]{0,4}[=:][\"'`]?"
EMAIL = rf"(?<![:=/A-Za-z0-9._%+-])(?!{PREFIXES})[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{{2,}}"
USERINFO = r"://[^/\s:@\"']*+:([^/\s@\"']++)@"
# A known name with what may close it, the sign after it, and its value: quoted, or up to white space, a quote or the next name.
KNOWN = "(?:" + "|".join(n.replace("_", "[_-]?") for n in NAMES) + r")(?:[_-]?key|[0-9]{1,3})?"
CLOSE, SIGN = r"[\"'`\])\\]{0,4}", r"(?::=|=>|==|[=:])"
VALUE = (r"(?:\\++\"[^\"\\]*+|\"(?:[^\"\\]|\\.)*+\"|'(?:[^'\\]|\\.)*+'|`[^`]*+`"
         r"|[\"'`]?(?:[^\s\"'`&,;]|[&,;](?![A-Za-z0-9_.-]{1,40}[\"'`]?[=:]))++)")
ASSIGNED = rf"(?is){KNOWN}{CLOSE}{SIGN}{VALUE}"
APART = rf"(?i)({KNOWN}{CLOSE})[\x20\x09-\x0D]*+({SIGN})[\x20\x09-\x0D]*+"
BLANK, BETWEEN = "\uffff", "\x01"  # stand for a blank within a quoted value, and between a name and its candidate
HARMLESS = [r"@", r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", r"^[0-9. -]+$", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
            r"^[0-9]{4}-[0-9]{2}-[0-9]{2}", r"\.(?:com|org|net|html?|png|jpg)(?:/|$)"]

FEATURES = ["n_chars", "digits", "upper", "lower", "symbols", "turns", "case_turns", "repeats", "distinct", "covered",
            "left_odds", "name_odds", "right_odds", "path_odds", "path_test", "path_depth"]


def _may_name(text: Column) -> Column:
    """Whether the text may hold a known name and a sign; plain searches, as few texts do."""
    low = F.lower(text)
    hit = F.lit(False)
    for stub in ("pass", "pwd", "secret", "token", "key", "auth"):
        hit = hit | F.contains(low, F.lit(stub))
    return (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & hit


def _joined(text: Column) -> Column:
    """The text with every value of a known name in one word with it, blanks within its quotes included."""
    joined = F.regexp_replace(text, APART, "$1$2")
    for quote in "\"'":
        begin = rf"(?i:{KNOWN}{CLOSE}{SIGN}){quote}(?=(?:[^{quote}\\\n]|\\[^\n])*+{quote})"
        joined = F.regexp_replace(joined, rf"((?:{begin}|\G(?!^))(?:[^{quote}\\\s]|\\\S)*+)\x20", f"$1{BLANK}")
    return F.when(_may_name(text), joined).otherwise(text)


def _found(word: Column) -> tuple[Column, Column]:
    """Of named and of other candidates (less the named ones in ``_named``): name, ``BETWEEN`` and candidate, distinct in a word."""

    def runs(pattern: str, group: int = 0, of: Column = word) -> Column:
        return F.regexp_extract_all(of, F.lit(pattern), F.lit(group))

    def trimmed(x: Column) -> Column:
        return F.btrim(x, F.lit(AROUND))

    def likely(x: Column) -> Column:
        return (F.length(x) >= 10) & x.rlike(TRIGGER)

    def known(name: Column) -> Column:  # db-password2 is password, X-Api-Key and apiKey are api_key
        short = F.regexp_extract(F.lower(name), rf"({KNOWN})$", 1)
        short = F.regexp_replace(F.regexp_replace(short, "[0-9]+$", ""), "-", "_")
        short = F.regexp_replace(F.regexp_replace(short, "^(api|access)_?key$", "$1_key"), "(?<!api|access|api_|access_)_?key$", "")
        return F.when(short == "", F.lower(name)).otherwise(short)

    def pair(name: Column, value: Column) -> Column:
        return F.concat(name, F.lit(BETWEEN), value)

    def value_of(m: Column) -> Column:  # without quotes; unquoted, without what closes a list or a sentence
        v = F.regexp_replace(m, rf"(?i)^{KNOWN}{CLOSE}{SIGN}", "")
        quoted = v.rlike("(?s)^([\"'`]).*\\1$") & (F.length(v) > 1)
        bare = F.rtrim(F.regexp_replace(v, "^\\\\*[\"'`]", ""), F.lit(",;.)}]>\\"))
        v = F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(bare)
        return F.translate(v, BLANK, " ")

    def only_if(condition: Column, found: Column) -> Column:
        return F.when(condition, found).otherwise(F.array().cast("array<string>"))

    assigned = F.transform(only_if(_may_name(word), runs(ASSIGNED)), lambda m: pair(known(F.regexp_extract(m, rf"(?i)^({KNOWN})", 1)), value_of(m)))
    userinfo = F.transform(only_if(F.contains(word, F.lit("://")), runs(USERINFO, 1)), lambda v: pair(F.lit("userinfo"), v))
    has_at = F.contains(word, F.lit("@"))
    rest = F.when(has_at, F.regexp_replace(word, EMAIL, " ")).otherwise(word)
    beside = F.filter(
        F.transform(runs(WITH_NAME + NARROW, 0, rest), lambda m: pair(
            known(F.regexp_extract(m, "^" + WITH_NAME, 1)), trimmed(F.regexp_replace(m, "^" + WITH_NAME, "")))),
        lambda x: likely(F.substring_index(x, BETWEEN, -1)))
    named = F.array_distinct(F.filter(F.concat(assigned, userinfo, beside), lambda x: ~F.endswith(x, F.lit(BETWEEN))))
    wide = F.filter(runs(WIDE, 0, rest), lambda x: F.contains(x, F.lit("/")) | F.endswith(x, F.lit("=")))
    plain = F.filter(F.transform(F.concat(runs(NARROW, 0, rest), wide, only_if(has_at, runs(EMAIL)), runs(INSIDE)), trimmed), likely)
    others = F.array_except(plain, F.transform("_named", lambda x: F.substring_index(x, BETWEEN, -1)))
    return named, F.transform(others, lambda x: pair(F.lit(""), x))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """Every candidate of every whole text with the words around it: one row for each distinct name and value of a word.

    Candidates are the values of known names, of any length and characters; passwords in URLs; and every
    run of ten or more credential characters that holds a digit, mixes cases or begins as a known format,
    wherever it stands in a word. Runs end at quotes, commas, ``& ? : = @ /``; one with slashes counts
    as a whole too. ``at`` counts a known name, its sign and its value as one word.
    """
    words = F.split(_joined(F.col("text").cast("string")), SPACE)

    def worth(w: Column) -> Column:
        assigned = F.when(_may_name(w), w.rlike(rf"(?i){KNOWN}{CLOSE}{SIGN}")).otherwise(F.contains(w, F.lit("://")))
        return ((F.length(w) >= 10) & w.rlike(TRIGGER)) | assigned

    def beside(steps: int) -> Column:
        return F.lower(F.translate(F.coalesce(F.get("_w", F.col("at") + steps), F.lit("")), BLANK, " "))

    spots = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: worth(F.get("_w", i)))
    found = (
        docs.where("text is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col(path)).alias("path"), words.alias("_w"))
        .withColumn("at", F.explode(spots))
        .select("doc_id", "path", "at", F.get("_w", F.col("at")).alias("word"), beside(-1).alias("left1"), beside(-2).alias("left2"),
                beside(1).alias("right1"))
    )
    before = F.when(F.col("left1").isin("=", ":", ":=", "=>"), F.col("left2")).otherwise(F.rtrim(F.col("left1"), F.lit("=:")))
    name = F.substring_index("_f", BETWEEN, 1)
    named, others = _found(F.col("word"))
    return (
        found.withColumn("_named", named).withColumn("_f", F.explode(F.concat("_named", others)))
        .withColumn("candidate", F.substring_index("_f", BETWEEN, -1))
        .withColumn("name", F.when(name != "", name).otherwise(before)).drop("word", "left2", "_named", "_f")
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings that plain rules are sure of: 1 for known formats and values of known names with a digit, 0 for addresses, numbers and dates.

    A known name beats the shape of its value: ``pwd=12345678901`` is a password.
    """
    text = F.col("candidate")

    def any_of(patterns: list[str]) -> Column:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | text.rlike(p)
        return hit

    harmless = any_of(HARMLESS)
    return found.withColumn(
        "label", F.when(any_of(FORMATS) | (F.col("name").isin(NAMES) & text.rlike("[0-9]")), 1).when(harmless, 0))


def labelled_by(found: DataFrame, findings: DataFrame) -> DataFrame:
    """``found`` with the ``label`` of ``findings`` (doc_id, word_index, candidate, label); null where they name none.

    A finding listed twice with both labels counts as a secret; null labels count as none.
    """
    known = (
        findings.where("label in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col("word_index").cast("long").alias("at"), "candidate")
        .agg(F.max("label").cast("int").alias("label"))
    )
    return found.withColumn("at", F.col("at").cast("long")).join(known, ["doc_id", "at", "candidate"], "left")


def dictionary(docs: DataFrame, least: int = 5) -> DataFrame:
    """Lower-case words of three or more letters that occur ``least`` times or more in the corpus."""
    letters = F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")
    return (
        docs.select(F.explode(F.filter(letters, lambda w: F.length(w) >= 3)).alias("entry"))
        .groupBy("entry").count().where(F.col("count") >= least).select("entry")
    )


def shaped(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds length, character transitions and dictionary coverage; one dictionary join over runs of letters."""
    c, n = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    runs = (
        found.select("candidate").distinct()
        .withColumn("entry", F.explode(F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: F.length(w) >= 3)))
    )
    known = runs.join(entries, "entry").groupBy("candidate").agg(F.sum(F.length("entry")).alias("known"))
    return (
        found.join(known, "candidate", "left")
        .withColumn("n_chars", n.cast("double"))
        .withColumn("digits", share("[0-9]")).withColumn("upper", share("[A-Z]")).withColumn("lower", share("[a-z]"))
        .withColumn("symbols", share("[^0-9A-Za-z]"))
        .withColumn("turns", share("[0-9](?=[A-Za-z])") + share("[A-Za-z](?=[0-9])"))
        .withColumn("case_turns", share("[a-z](?=[A-Z])") + share("[A-Z](?=[a-z])"))
        .withColumn("repeats", share(r"(.)(?=\1)"))
        .withColumn("distinct", F.size(F.array_distinct(F.split(c, ""))) / n)
        .withColumn("covered", F.coalesce(F.col("known"), F.lit(0)) / n).drop("known")
        .withColumn("path_test", F.lower("path").rlike("test|example|sample|mock|doc").cast("double"))
        .withColumn("path_depth", F.regexp_count("path", F.lit("/")).cast("double"))
    )


@dataclass
class Forest:
    """The trees, the log-odds of neighbours and paths, and the share of secrets they were learned from."""

    trees: RandomForestClassificationModel | None
    odds: dict[str, DataFrame]
    share: float


def _odds(labelled: DataFrame, column: str, least: int = 3) -> DataFrame:
    """Smoothed log-odds of label 1 beside each value of ``column`` seen ``least`` times or more."""
    return (
        labelled.groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("weight").alias("_n"), F.sum(F.col("label") * F.col("weight")).alias("_y"))
        .where(F.col("_rows") >= least)
        .select("_value", F.log((F.col("_y") + 0.5) / (F.col("_n") - F.col("_y") + 0.5)).alias("_o"))
    )


PLACES = {"left1": "left_odds", "name": "name_odds", "right1": "right_odds", "path": "path_odds"}


def _featured(rows: DataFrame, odds: dict[str, DataFrame]) -> DataFrame:
    for column, name in PLACES.items():
        rows = rows.join(odds[column].withColumnsRenamed({"_value": column, "_o": name}), column, "left")
    filled = rows.fillna(0.0, FEATURES)
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(filled)


def fit(labelled: DataFrame, max_rows: int = 20000, trees: int = 30, depth: int = 8) -> Forest:
    """Learns from shaped findings with a ``label``, at most ``max_rows`` of them, drawn by a hash of the finding.

    Each label has half of ``max_rows``, and what the other leaves of its half; the findings drawn weigh as
    many as their label has. A neighbouring word, a name or a path counts as the log-odds of its findings. With findings of one
    label only, or none, there are no trees and every score is that label's share.
    """
    known = labelled.where("label in (0, 1)")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    ones = min(n1, max(max_rows // 2, max_rows - n0))
    taken = {0: min(n0, max_rows - ones), 1: ones}
    drawn = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id", "at", "candidate"), "doc_id", "at").limit(rows)
        .withColumn("weight", F.lit(totals.get(label, 0) / max(rows, 1)))
        for label, rows in taken.items()
    ]
    sample = stored(drawn[0].union(drawn[1]), "findings")
    odds = {column: stored(_odds(sample, column), f"odds-{column}") for column in PLACES}
    if not n0 or not n1:
        return Forest(None, odds, 1.0 if n1 else 0.0)
    grown = RandomForestClassifier(featuresCol="_features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11,
                                   featureSubsetStrategy="sqrt", minInstancesPerNode=3)
    return Forest(grown.fit(_featured(sample, odds).select("_features", "weight", F.col("label").cast("double").alias("label"))), odds, n1 / (n0 + n1))


def scored(found: DataFrame, forest: Forest) -> DataFrame:
    """Shaped findings with ``score``, the trees' share of votes for a secret."""
    if forest.trees is None:
        return found.withColumn("score", F.lit(float(forest.share)))
    return forest.trees.transform(_featured(found, forest.odds)).withColumn("score", vector_to_array("probability")[1])


def secret_scan(docs: DataFrame, max_rows: int = 20000, findings: DataFrame | None = None) -> DataFrame:
    """Every candidate of every document: doc_id, word_index, candidate, name, label, held_out, score, predicted.

    Labels come from ``findings`` (doc_id, word_index, candidate, label; what earlier scans returned, reviewed), which
    may cover any part of the candidates; without them from ``rule_labels``. Findings of documents whose crc32(doc_id) is divisible by 5 are not
    learned from. All work is DataFrame work: extraction, corpus dictionary, joins, trees. Extraction is stored, since
    two joins read it.

    Null and empty texts have no candidate; null paths are a path of their own; words may have any
    length; repeated rows give their findings again. An empty table gives an empty result. Only doc_id, text and source are read.
    """
    raw = stored(candidates(docs), "extracted")
    raw = rule_labels(raw) if findings is None else labelled_by(raw, findings)
    found = stored(shaped(raw, dictionary(docs)), "candidates")
    forest = fit(found.where(~held_out(F.col("doc_id"))), max_rows)
    return scored(found, forest).select(
        "doc_id", F.col("at").cast("long").alias("word_index"), "candidate", "name", "label",
        held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
