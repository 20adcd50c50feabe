"""Secrets in documents: broad candidates, then a random forest against false
positives.

Candidates are all runs of twelve or more key characters in a word that have a
digit or are very long; a word can hold several (``NAME=value``, minified JSON,
URL parameters). Features of a candidate are its length, the shares of
character classes, the transitions between classes, its distinct characters, how
much of its letters the corpus dictionary covers, the document's path (its
source), the name before it in its word and the neighbouring words, of which the
``NEAR`` characters next to the candidate count. The forest is trained on labelled
findings, drawn for each label on its own; where none are given, they come from the
documents by the strict formats and the plain negatives of ``weak_label``, and
candidates that no rule decides, such as a key that stands alone, are left for the
forest.

The dictionary holds the most frequent lower-case words over all documents. All
steps are DataFrame expressions and Spark ML's forest.

Defined results: null and empty texts have no candidates; a null source is a path
of its own; equal words of one text, and equal runs of one word, are findings each; rows that repeat an id
and a text share their findings; without labelled findings of both kinds every
candidate is kept with score 1; extra columns, whatever their names, are ignored by
the scan and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm.common import saved, scratch, unused, words

# '=' ends a key only where no value follows it
CORE = r"""[A-Za-z0-9_+/-]{12,}(?:={1,2}(?![A-Za-z0-9_+/"'`<(\[{$=-]))?"""
# the name that a value is given to: name=, "name":", name=>, <name>
NAME = r"""([A-Za-z0-9_.-]+)["'`\])]*(?:[=:]+>?|>)["'`(\[{<]*$"""
# Formats of common keys (fixed values); such a candidate is a secret by itself.
STRICT = r"""^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^glpat-[0-9A-Za-z_-]{20}$""" \
         r"""|^AIza[0-9A-Za-z_-]{35}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^sk_(live|test)_[0-9A-Za-z]{24,}$"""
NEAR = 100  # characters looked at beside a candidate, and of the words around
KEYWORDS = r"(?i)(key|token|secret|passw|pwd|auth|credential|bearer)"
MASK = "<SECRET>"
DICTIONARY_WORDS = 5000
MAX_LABELLED = 20_000
PATH_BUCKETS = 8
CUT = 0.5

FEATURES = ["length", "digit_share", "upper_share", "lower_share", "other_share", "transitions",
            "distinct_share", "hex_only", "covered_share", "path_bucket", "path_is_test",
            "key_before", "key_inside", "assigned", "quoted", "before_common", "after_common"]


def candidates(docs: DataFrame) -> DataFrame:
    """One row for each candidate: doc_id, text_key, source, word_index, nth (of the
    runs in its word), core, lead and trail (the word's text beside it), and the
    words around."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                       words(F.col("text").cast("string")).alias("w"))

    def around(i: Column) -> Column:
        def word(j):
            return F.coalesce(F.get(F.col("w"), j), F.lit(""))
        return F.struct(i.alias("word_index"), word(i).alias("word"),
                        F.right(word(i - 1), F.lit(NEAR)).alias("before"),
                        F.right(word(i - 2), F.lit(NEAR)).alias("before2"),
                        F.left(word(i + 1), F.lit(NEAR)).alias("after"))

    at = F.filter(F.transform("w", lambda x, i: F.when((F.length(x) >= 12) & x.rlike(CORE), i)),
                  lambda i: i.isNotNull())
    held = rows.withColumn("at", at).select(
        "doc_id", "text_key", "source", F.explode(F.transform("at", around)).alias("c"))
    # gaps[j] stands before cores[j], the last gap after the last core
    held = held.select("doc_id", "text_key", "source", "c.*",
                       F.regexp_extract_all("c.word", F.lit(CORE), 0).alias("cores"),
                       F.split("c.word", CORE, -1).alias("gaps")).drop("word")

    def run(core: Column, j: Column) -> Column:
        lead = F.concat(F.coalesce(F.get("cores", j - 1), F.lit("")), F.get("gaps", j))
        return F.struct(j.alias("nth"), core.alias("core"), F.right(lead, F.lit(NEAR)).alias("lead"),
                        F.left(F.get("gaps", j + 1), F.lit(1)).alias("trail"))

    runs = F.filter(F.transform("cores", run),
                    lambda r: r["core"].rlike("[0-9]") | (F.length(r["core"]) >= 20))
    return (held.withColumn("r", F.explode(runs)).select(
        "doc_id", "text_key", "source", "word_index", "r.*", "before", "before2", "after").distinct())


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words of four letters or more over all texts."""
    letters = F.regexp_replace(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))),
                               r"[^\p{L}]+", " ")
    counts = saved(docs.sparkSession, docs.select(F.explode(F.split(letters, " ")).alias("entry"))
                   .where("length(entry) >= 4").groupBy("entry").count(), "secret-words")
    # words by steps of a tenth in their counts: some hundred steps at most
    step = F.floor(F.log(1.1, "count"))
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    least, n = 0, 0
    for r in steps:
        least, n = r.step, n + r.n
        if n >= size:
            break
    # only words of the last step are too many
    return (counts.where(step >= least).orderBy(F.desc("count"), "entry").limit(size).select("entry"))


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` plus FEATURES and ``id``; ``found`` must be stored."""
    core, n = F.col("core"), F.length("core")

    def share(chars: str) -> Column:
        return F.length(F.regexp_replace(core, f"[^{chars}]+", "")) / n

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        core, "[^A-Za-z0-9]", "."), "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    inside = F.regexp_extract("lead", NAME, 1)
    out = found.select(
        "*", n.cast("double").alias("length"), share("0-9").alias("digit_share"),
        share("A-Z").alias("upper_share"), share("a-z").alias("lower_share"),
        (1 - share("A-Za-z0-9")).alias("other_share"),
        (runs / n).alias("transitions"),
        (F.size(F.array_distinct(F.split(core, ""))) / n).alias("distinct_share"),
        core.rlike("^[0-9a-f]+$").cast("double").alias("hex_only"),
        F.pmod(F.xxhash64("source"), F.lit(PATH_BUCKETS)).cast("double").alias("path_bucket"),
        F.col("source").rlike("(?i)test|example|sample|doc|fixture").cast("double")
        .alias("path_is_test"),
        (F.col("before").rlike(KEYWORDS) | F.col("before2").rlike(KEYWORDS)).cast("double")
        .alias("key_before"),
        inside.rlike(KEYWORDS).cast("double").alias("key_inside"),
        (F.col("before").isin("=", ":", ":=", "=>") | F.col("before").rlike("[=:]$")
         | (inside != "")).cast("double").alias("assigned"),
        (F.col("lead").rlike("""["']$""") | F.col("trail").isin('"', "'")).cast("double")
        .alias("quoted"))

    # dictionary lookups: the letters of the core, and the words beside it
    parts = F.filter(F.split(F.lower(F.regexp_replace("core", "[^A-Za-z]+", " ")), " "),
                     lambda p: F.length(p) >= 4)

    def plain(name: str) -> Column:
        return F.lower(F.regexp_replace(name, r"[^\p{L}]+", ""))

    lookups = F.concat(
        F.transform(parts, lambda p: F.struct(p.alias("entry"), F.lit("core").alias("role"))),
        F.array(F.struct(plain("before").alias("entry"), F.lit("before").alias("role")),
                F.struct(plain("after").alias("entry"), F.lit("after").alias("role"))))
    met = (found.select("id", F.explode(lookups).alias("l")).select("id", "l.*")
           .join(known, "entry").groupBy("id").agg(
               F.sum(F.when(F.col("role") == "core", F.length("entry")).otherwise(0)).alias("_covered"),
               F.max((F.col("role") == "before").cast("double")).alias("before_common"),
               F.max((F.col("role") == "after").cast("double")).alias("after_common")))
    return (out.join(met, "id", "left")
            .withColumn("covered_share", F.coalesce(F.col("_covered") / F.col("length"), F.lit(0.0)))
            .fillna(0.0, ["before_common", "after_common"]).drop("_covered"))


def kind() -> Column:
    core = F.col("core")
    return (F.when(core.rlike(STRICT), "access_key")
            .when(core.rlike("^[0-9a-f]{32,}$"), "hex_token")
            .when(F.col("key_inside") > 0, "password").otherwise("other"))


def weak_label() -> Column:
    """1 secret, 0 not, null undecided: strict formats and plain negatives. A mixed
    run of letters and digits without any context is undecided, not a negative."""
    core = F.col("core")
    mixed = (core.rlike("[0-9]") & core.rlike("[A-Za-z]") & (F.col("transitions") >= 0.15)
             & (F.col("covered_share") < 0.3))
    return (F.when(core.rlike(STRICT), 1)
            .when(core.rlike("^[0-9a-f]{32,}$") & (F.col("key_before") > 0), 1)
            .when(core.rlike("[0-9]") & core.rlike("[A-Za-z]") & (F.col("key_inside") > 0), 1)
            .when(core.rlike("^[0-9_+/=-]+$") | core.rlike("^[A-Za-z_/=-]+$"), 0)
            .when((F.col("key_before") == 0) & (F.col("assigned") == 0) & (F.col("quoted") == 0) & ~mixed, 0))


def train(labelled: DataFrame, max_rows: int = MAX_LABELLED, trees: int = 24, depth: int = 6):
    """A forest from rows of FEATURES and ``label``, or None without both kinds.

    At most about ``max_rows`` rows are used, half of each label where there are
    as many, drawn by a hash of the features and the row's place among equal ones.
    """
    labelled = labelled.where(F.col("label").isin(0, 1)).select(*FEATURES, F.col("label").cast("int"))
    sizes = dict(labelled.groupBy("label").count().collect())
    if len(sizes) < 2:
        return None
    few = min(sizes.values())
    share = {label: max(max_rows - min(few, max_rows // 2), max_rows // 2) if n > few else max_rows // 2
             for label, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.lit("sample"), *FEATURES, F.monotonically_increasing_id()),
                  F.lit(1 << 30)) / float(1 << 30)
    chance = F.when(F.col("label") == 1, share[1] / sizes[1]).otherwise(share[0] / sizes[0])
    rows = labelled.where(draw < chance)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    rows = saved(labelled.sparkSession, rows, "secret-labelled")
    drawn = dict(rows.groupBy("label").count().collect())
    if len(drawn) < 2:
        return None
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, 0.5 / drawn[1]).otherwise(0.5 / drawn[0]))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                    numTrees=trees, maxDepth=depth, seed=11, minWeightFractionPerNode=0.0)
    return forest.fit(rows)


def scan(spark: SparkSession, docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Findings of every text: doc_id, text_key, word_index, nth, core, kind, score.

    ``labelled`` holds findings (FEATURES and label) from reviewed scans.
    """
    with scratch(spark):
        found = saved(spark, candidates(docs).withColumn("id", F.monotonically_increasing_id()),
                      "secret-candidates")
        known = saved(spark, dictionary(docs), "secret-dictionary")
        scored = saved(spark, features(found, known), "secret-features")
        if labelled is None:
            labelled = scored.withColumn("label", weak_label()).where("label is not null")
        model = train(labelled)
        if model is None:
            scored = scored.withColumn("score", F.lit(1.0))
        else:
            vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(scored)
            scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
        return saved(spark, scored.where(F.col("score") >= CUT).select(
            "doc_id", "text_key", "word_index", "nth", "core", kind().alias("kind"), "score"),
            "secret-findings", keep=True)


def redact(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with every finding masked in ``text`` (and ``n_chars`` renewed)."""
    id_, key, held = (unused(c, docs.columns) for c in ("_id", "_key", "_cores"))
    with scratch(spark):
        found = saved(spark, scan(spark, docs).groupBy(
            F.col("doc_id").alias(id_), F.col("text_key").alias(key)).agg(
            F.collect_set("core").alias(held)), "secret-found", keep=True)
    rows = docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found[id_])
                     & F.xxhash64(docs["text"]).eqNullSafe(found[key]), "left")
    # longest first, so that a core inside another leaves no rest
    cores = F.array_sort(held, lambda a, b: F.length(b) - F.length(a))
    masked = F.when(F.col(held).isNotNull(), F.aggregate(
        cores, docs["text"], lambda t, c: F.replace(t, c, F.lit(MASK)))).otherwise(docs["text"])
    rows = rows.withColumn("text", masked)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(held).isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
