"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more letters, digits and +/_- within a word, or what the text assigns
to a credential's name within a word, whatever its length and punctuation. The forest sees its
length, how kinds of characters follow each other, how much of it is made of pieces that words of the
corpus begin with, whether it looks like part of a path, and the words around it. It is trained on
labelled findings: candidates that the text itself assigns to a credential's name are secrets,
candidates without such a name are not. Not labelled, but scored, are short values of one kind of
characters (they may be words or counts) and runs without a name that look like keys. Each finding is learned from twice, the second time as if
it stood between plain words, so that a secret is known by its looks too.

All steps are DataFrame operations and Spark's own forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import as_rows, picked, settle

LEAST_LENGTH = 16
#: Shorter values of a credential's name are scored, but not learned from.
LEAST_LABELLED = 6
#: A run without a name looks like a key, and is not learned from, if so large a share of it are
#: turns between letters and digits, and it has so many different characters.
KEY_TURNS, KEY_CHARACTERS = 0.15, 8
#: Findings of each label that the forest is fitted on, the first by hash.
FIT_FINDINGS = 10_000
TREES, DEPTH, SEED = 40, 8, 5
#: Findings that a leaf holds at least: single wrong labels get no leaf of their own.
LEAF = 8
THRESHOLD = 0.5
#: A three-letter beginning is in the dictionary if so many of a million words have it.
DICTIONARY_PER_MILLION = 200
REDACTED = "[SECRET]"
_RUN = f"[A-Za-z0-9+/_-]{{{LEAST_LENGTH},}}={{0,2}}"
# fixed values: names that secrets are assigned to
_CREDENTIAL = ("(?i)(token|secret|passw|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|"
               "auth|bearer|credential|signature|client[_-]?id|session)")
# a name, what assigns, and as group 2 the value with its opening quote, in the last word of a few
_VALUE = (_CREDENTIAL.replace("|auth|", "|auth(?!or)|")
          + "[A-Za-z0-9_.-]*[\"'`\\])]*\\s*(?::=|=>|=|:)\\s*"
          + "(\"[^\"\\s]+|'[^'\\s]+|`[^`\\s]+|[^\\s\"'`=:>][^\\s\"'`]*)(?=\\S*$)")
_ASSIGNS = _VALUE[:_VALUE.index("(\"[^")] + "[\"'`]?"
# fixed values: published formats of keys that need no name
_KEY_FORMAT = ("^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}"
               "|xox[abprs]-[0-9A-Za-z-]{10,}|[rs]k_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}"
               "|glpat-[0-9A-Za-z_-]{20,}|npm_[A-Za-z0-9]{36})$")
_NAME_ENDS = "(?i)[\"']?\\s*(=|:|:=|=>)\\s*[\"'`]?$"

_LOOKS = ("length", "digits", "capitals", "smalls", "others", "digit_turns", "case_turns", "distinct",
          "longest_kind", "is_hex", "is_number", "coverage", "slashes", "path_around")
_AROUND = ("named", "assigned", "quoted", "named_before", "plain_before", "plain_after")


def _words(text: Column) -> Column:
    """Words are runs of anything but ASCII white space; null is empty."""
    return F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")


def dictionary(documents: DataFrame) -> list[str]:
    """Common beginnings of words of all documents, at most 26 ** 3."""
    begun = (
        picked(documents, doc_id="long", text="string")
        .select(F.explode(_words(F.col("text"))).alias("word"))
        .groupBy(F.lower(F.substring("word", 1, 3)).alias("begin")).agg(F.count("*").alias("n"))
    )
    common = settle(begun, "secret-beginnings")
    total = common.agg(F.sum("n")).first()[0] or 0
    return [r["begin"] for r in common.where(F.col("begin").rlike("^[a-z]{3}$"))
            .where(F.col("n") * 1_000_000 >= DICTIONARY_PER_MILLION * total)
            .select("begin").orderBy("begin").collect()]


def _mixed(run: Column) -> Column:
    """Neither all letters nor all digits and punctuation."""
    return run.rlike("[0-9]") & run.rlike("\\p{L}")


def candidates(documents: DataFrame) -> DataFrame:
    """``doc_id, word_at, run_at, run, before, word, ...`` of every candidate of every text.

    ``word_at`` counts words from 0, ``run_at`` within a word first runs, then values that are no run.
    """
    placed = picked(documents, doc_id="long", text="string") \
        .select("doc_id", _words(F.col("text")).alias("words"),
                F.coalesce(F.col("text").rlike(_CREDENTIAL), F.lit(False)).alias("names")) \
        .select("doc_id", "words", "names", F.posexplode("words").alias("word_at", "word"))

    def near(offset: int) -> Column:
        return F.coalesce(F.get("words", F.col("word_at") + offset), F.lit(""))

    wide = F.when(F.col("names"), F.concat_ws(" ", near(-2), near(-1), "word")).otherwise("")
    is_run = (F.length("word") >= LEAST_LENGTH) & F.col("word").rlike(_RUN)
    runs = F.when(is_run, F.transform(
        F.regexp_extract_all("word", F.lit(f"({_RUN})"), F.lit(1)),
        lambda run: F.struct(run.alias("run"), F.substr(
            "word", F.lit(1), F.instr("word", run) - 1).alias("before")))).otherwise(F.array())

    def value(whole: Column, raw: Column) -> Column:
        quoted = raw.rlike("^[\"'`]")
        lead = F.substr(whole, F.lit(1), F.length(whole) - F.length(raw))
        return F.struct(
            F.when(quoted, F.substr(raw, F.lit(2)))
            .otherwise(F.regexp_replace(raw, "[,;.)\\]}]+$", "")).alias("run"),
            F.when(quoted, F.concat(lead, F.substr(raw, F.lit(1), F.lit(1)))).otherwise(lead)
            .alias("before"))

    values = F.when(F.col("wide").rlike(_VALUE), F.zip_with(
        F.regexp_extract_all("wide", F.lit(_VALUE), F.lit(0)),
        F.regexp_extract_all("wide", F.lit(_VALUE), F.lit(2)), value)).otherwise(F.array())
    found = placed.withColumn("wide", wide) \
        .where(is_run | F.col("wide").rlike(_VALUE)) \
        .withColumns({"runs": runs, "values": values}) \
        .withColumn("values", F.filter("values", lambda v: (v["run"] != "")
                                       & ~F.startswith(F.lit(REDACTED), v["run"])
                                       & ~F.array_contains(F.col("runs.run"), v["run"])))
    return found.select(
        "doc_id", "word_at", "word", near(-1).alias("one_before"), near(-2).alias("two_before"),
        near(1).alias("after"), F.posexplode(F.concat("runs", "values")).alias("run_at", "place")) \
        .select("doc_id", "word_at", "word", "one_before", "two_before", "after", "run_at",
                "place.run", "place.before")


def featured(found: DataFrame, beginnings: list[str]) -> DataFrame:
    """Candidates with their features and ``label``: 1 if assigned to a credential's name or of a
    published key format, 0 if there is no such name and they do not look like a key, else null."""
    run, n = F.col("run"), F.length("run")

    def share(pattern: str) -> Column:
        return F.size(F.regexp_extract_all("run", F.lit(pattern), F.lit(0))) / n

    known = F.split(F.lit(" ".join(beginnings)), " ")
    n_pieces = F.greatest(n - 2, F.lit(1))
    pieces = F.transform(F.sequence(F.lit(1), n_pieces),
                         lambda at: F.lower(F.substr(run, at, F.lit(3))))
    kinds = F.regexp_extract_all("run", F.lit("[0-9]+|[a-z]+|[A-Z]+|[^0-9a-zA-Z]+"), F.lit(0))
    lead = F.concat_ws(" ", "one_before", "before")  # what stands right before the run
    wide = F.concat_ws(" ", "two_before", "one_before", "before")
    named = wide.rlike(_CREDENTIAL)
    assigned = lead.rlike(_NAME_ENDS)
    plain = "^[\"'(]*\\p{L}+[\\p{Punct}]*$"
    features = {
        "length": F.least(n, F.lit(200)), "digits": share("[0-9]"), "capitals": share("[A-Z]"),
        "smalls": share("[a-z]"), "others": share("[^0-9a-zA-Z]"),
        "digit_turns": share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "case_turns": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "distinct": F.size(F.array_distinct(F.split("run", ""))) / n,
        "longest_kind": F.array_max(F.transform(kinds, F.length)) / n,
        "is_hex": run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "is_number": run.rlike("^[0-9]+$"),
        "coverage": F.size(F.filter(pieces, lambda p: F.array_contains(known, p))) / n_pieces,
        "slashes": share("/"),
        "path_around": F.col("word").rlike("://|^[./~]|\\.[a-z]{2,4}(/|$)"),
        "named": named, "assigned": assigned, "quoted": F.col("before").rlike("[\"'`]$"),
        "named_before": F.col("one_before").rlike(_CREDENTIAL),
        "plain_before": F.col("one_before").rlike(plain), "plain_after": F.col("after").rlike(plain),
    }
    return found.withColumns({k: v.cast("double") for k, v in features.items()}).withColumn(
        "label", F.when(run.rlike(_KEY_FORMAT), 1.0).when((F.col("named") == 1) & (F.col("assigned") == 1) & (
            (n >= LEAST_LENGTH) | _mixed(run) & (n >= LEAST_LABELLED)), 1.0)
        .when((F.col("named") == 0) & ~(
            _mixed(run) & (F.col("digit_turns") >= KEY_TURNS)
            & (F.col("distinct") * n >= KEY_CHARACTERS)), 0.0))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*_LOOKS, *_AROUND], outputCol="features").transform(rows)


def train(found: DataFrame):
    """A forest of at most ``FIT_FINDINGS`` findings of each label; None if a label is missing."""
    columns = [*_LOOKS, *_AROUND]
    order = [F.xxhash64("run", "doc_id", "word_at"), *columns]
    some = None
    for label in (0.0, 1.0):
        part = found.where(F.col("label") == label).orderBy(*order).limit(FIT_FINDINGS) \
            .select("label", *columns)
        some = part if some is None else some.union(part)
    bare = some.select("label", *_LOOKS, *[F.lit(float(c.startswith("plain"))).alias(c)
                                           for c in _AROUND])
    # a bounded sample in one partition, sorted: the forest is the same on every cluster
    rows = settle(some.union(bare).coalesce(1).sortWithinPartitions("label", *columns),
                  "secret-findings").coalesce(1)
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES,
                                  maxDepth=DEPTH, seed=SEED, minInstancesPerNode=LEAF) \
        .fit(_vectors(rows))


def scan(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every candidate: ``doc_id, word_at, run_at, run, score, secret``.

    Null and empty texts have no candidates. Without labelled findings of both kinds there is no
    forest: findings labelled as secrets then have score 1, all others 0. A run of a published key
    format has score 1 in any case. Repeated rows give repeated findings; other columns are ignored; rows without a doc_id are
    left out. An empty table gives an empty result. Texts are read whole, however long.
    """
    found = settle(featured(settle(candidates(documents), "secret-candidates"),
                            dictionary(documents)), "secret-features")
    forest = train(found)
    if forest is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = forest.transform(_vectors(found)) \
            .withColumn("score", F.when(F.col("run").rlike(_KEY_FORMAT), 1.0)
                        .otherwise(vector_to_array("probability")[1]))
    return scored.select("doc_id", "word_at", "run_at", "run", "score",
                         (F.col("score") >= threshold).alias("secret"))


def findings(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``scan`` without the secrets themselves: their length and a digest take their place."""
    return scan(documents, threshold).select(
        "doc_id", F.col("word_at").cast("long").alias("word_at"),
        F.col("run_at").cast("long").alias("run_at"),
        F.length("run").cast("long").alias("length"), F.sha2("run", 256).alias("sha256"), "score",
        "secret")


def redacted(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All documents with the same columns; in ``text`` each secret is replaced by ``[SECRET]``,
    wherever it stands: a short one where no letter or digit joins it, one of a single kind of
    characters (which may be a word) only where it is assigned to a credential's name. Documents
    without a doc_id stay as they are."""
    secrets = scan(documents, threshold).where("secret") \
        .groupBy("doc_id").agg(F.collect_set("run").alias("runs"))  # of one text

    def placed(run: Column) -> Column:
        exact = F.concat(F.lit("\\Q"), F.replace(run, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        alone = F.when(_mixed(run), "((?<![A-Za-z0-9]))").otherwise(f"({_ASSIGNS})")
        return F.concat(alone, exact, F.lit("(?![A-Za-z0-9])"))

    longest_first = F.sort_array(F.transform("runs", lambda r: F.struct(
        F.length(r).alias("n"), r.alias("run"))), asc=False)
    clean = F.aggregate(longest_first, F.col("row.text").cast("string"),
                        lambda t, r: F.when(r["n"] >= LEAST_LENGTH,
                                            F.replace(t, r["run"], F.lit(REDACTED)))
                        .otherwise(F.regexp_replace(t, placed(r["run"]), F.lit(f"$1{REDACTED}"))))
    return as_rows(documents) \
        .join(secrets, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left") \
        .withColumn("row", F.when(F.col("runs").isNotNull(), F.col("row").withField("text", clean))
                    .otherwise(F.col("row"))) \
        .select("row.*")
