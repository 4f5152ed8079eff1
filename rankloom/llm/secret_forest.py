"""Secret scan with a random forest against false positives, in DataFrame operations only.

Candidates are runs of 12 or more characters of keys and tokens that hold a digit. Each
is described by its length, the shares of character classes, how often the class
changes from one character to the next, how many different characters it has, how much
of it dictionary words cover, whether it looks like part of a path or stands in a file
of tests or examples, and by the words and marks beside it. A random forest trained
from labelled findings scores every candidate; those at 0.5 or more are secrets.

The given tables label no findings, so the query labels some by rule: assigned to a
name that speaks of a secret is true, plain numbers and dictionary text is false, the
rest stays open. The forest may be fitted on at most ``TRAIN_ROWS`` findings of each
label, those with the least hash; scoring covers all. If a label has no finding there
is no forest, and the rules decide.

Offsets are code points, the end is exclusive. Null text has no candidates, null paths
are no path. Repeated rows give repeated findings, an empty table none. Further columns
are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.wordlists import STOP_WORDS
from rankloom.llm.common import query, table
from rankloom.llm.personal_data import with_spans
from rankloom.session import cut_lineage

SHORTEST = 12
CANDIDATE = rf"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{{{SHORTEST},}}+={{0,2}}"
TRAIN_ROWS = 10_000
TREES, DEPTH, SEED = 24, 6, 17

#: Words that name secrets, and parts of paths where secrets are samples.
SECRET_NAMES = r"(?i)(?:secret|token|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)"
SAMPLE_PATHS = r"(?i)(?:^|[/._-])(?:tests?|examples?|samples?|mocks?|fixtures?|docs?)(?:$|[/._-])"

FEATURES = ["length", "digits", "uppers", "lowers", "marks", "changes", "different", "covered", "slashes", "sample_path", "named", "assigned", "quoted", "web", "words_before", "plain_after"]


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row per candidate: id, start, end, finding, before, after, path."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    df = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), path.alias("_path"))
    df = with_spans(df, "_text", "_found", CANDIDATE, "[0-9]", shortest=SHORTEST)
    # After the contexts are made: runs without a digit may be the names of what follows.
    kept = F.filter("_found", lambda s: s["text"].rlike("[0-9]"))
    return df.select(id_col, F.coalesce("_path", F.lit("")).alias("path"), F.explode(kept).alias("s")).select(id_col, "path", "s.start", "s.end", F.col("s.text").alias("finding"), "s.before", "s.after")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("finding", pattern, "")) / F.length("finding")


def described(found: DataFrame) -> DataFrame:
    """The findings with FEATURES as columns."""
    n = F.length("finding")
    runs = F.size(F.regexp_extract_all("finding", F.lit("[0-9]+|[a-z]+|[A-Z]+|[^0-9a-zA-Z]+"), F.lit(0)))
    letters = F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{2,}"), F.lit(0))
    words = F.filter(letters, lambda w: w.isin(sorted(STOP_WORDS)))
    cols = {
        "length": F.log(n.cast("double")),
        "digits": _share("[^0-9]"),
        "uppers": _share("[^A-Z]"),
        "lowers": _share("[^a-z]"),
        "marks": _share("[0-9a-zA-Z]"),
        "changes": (runs - 1) / n,
        "different": F.size(F.array_distinct(F.split("finding", ""))) / F.least(n, F.lit(64)),
        "covered": F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)) / n,
        "slashes": F.length(F.regexp_replace("finding", "[^/]", "")).cast("double"),
        "sample_path": F.col("path").rlike(SAMPLE_PATHS).cast("double"),
        "named": F.col("before").rlike(SECRET_NAMES + r"[^\n]{0,24}$").cast("double"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"'`]?$").cast("double"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
        "web": F.col("before").rlike(r"(?:://|www\.|[/@.])[^\s]*$").cast("double"),
        "words_before": F.size(F.regexp_extract_all("before", F.lit(r"[\p{L}]{2,}"), F.lit(0))).cast("double"),
        "plain_after": F.col("after").rlike(r"^[\s.,;]*[\p{L}]").cast("double"),
    }
    return found.select("*", *[c.cast("double").alias(name) for name, c in cols.items()])


def rule_labels(found: DataFrame) -> Column:
    """1, 0 or null for described findings."""
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("changes") > 0.1)
    return F.when((F.col("named") == 1) & (F.col("assigned") == 1) & mixed, 1.0).when((F.col("digits") == 1) | (F.col("covered") > 0.5), 0.0)


def trained(labelled: DataFrame, label_col: str = "label") -> RandomForestClassificationModel | None:
    """A forest for described findings with a 0/1 label, fitted on a bounded sample."""
    marked = labelled.filter(F.col(label_col).isNotNull()).select(F.col(label_col).cast("double").alias("label"), F.xxhash64("finding", "before", "after").alias("_h"), *FEATURES)
    by_label = [marked.filter(F.col("label") == v).orderBy("_h", *FEATURES).limit(TRAIN_ROWS) for v in (0.0, 1.0)]
    sample = cut_lineage(by_label[0].unionAll(by_label[1]).coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Described findings with the forest's score and the verdict."""
    if model is None:
        score = F.coalesce(rule_labels(found), F.lit(0.0))
        scored = found.withColumn("score", score)
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="_vector").transform(found)
        model = model.copy().setFeaturesCol("_vector").setPredictionCol("_class").setRawPredictionCol("_raw").setProbabilityCol("_p")
        scored = model.transform(ready).withColumn("score", F.get(vector_to_array("_p"), F.lit(1)))
    return scored.withColumn("is_secret", F.col("score") >= 0.5).drop("_vector", "_class", "_raw", "_p")


@query("op10_secret_forest")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut_lineage(described(findings(table(spark, sf_dir, "documents"), path_col="source")))
    model = trained(found.withColumn("label", rule_labels(found)))
    return judged(found, model).select("doc_id", "start", "end", F.length("finding").cast("bigint").alias("length"), "score", "is_secret")
