"""Training data, classifiers, learning to rank, saved models, run log."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.functions import wordlists as W
from rankloom.functions.portable import hash32, uniform
from rankloom.operators import extraction as E
from rankloom.operators import terms as I
from rankloom.operators.spread import lookup_join, running_totals

SCORE_FEATURES = ["skills", "experience", "education", "projects", "missing"]
PAIR_FEATURES = ["jaccard", "tfidf_cosine", "resume_length", "jd_length", "resume_readability", "jd_readability", "entity_overlap"]


def synthetic_candidates(ids: DataFrame, key: str) -> DataFrame:
    """One made-up candidate per id: four uniform scores, 0 to 8 missing keywords;
    label 1 from 60 points, 0 below 40, the middle band dropped."""
    names = SCORE_FEATURES[:4]
    rows = ids.select(key, *[(uniform(n, key) * 100).alias(n) for n in names], (hash32("missing", key) % 9).alias("missing"))
    weights = W.OVERALL_WEIGHTS
    total = sum((F.col(n) * weights[n] for n in names[1:]), F.col(names[0]) * weights[names[0]])
    # Weights are percents, so the bounds are in hundredths.
    return rows.withColumn("label", F.when(total >= 6000, 1).when(total < 4000, 0)).filter(F.col("label").isNotNull())


def boosted_trees(features: list[str], label: str = "label", trees: int = 100, depth: int = 6, step: float = 0.3) -> Pipeline:
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=42)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), gbt])


def boosted_trees_on_vectors(label: str = "label", trees: int = 100, depth: int = 6, step: float = 0.3) -> Pipeline:
    return Pipeline(stages=[GBTClassifier(featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=42)])


def with_probability(model: PipelineModel, df: DataFrame, out: str = "probability") -> DataFrame:
    """Positive-class probability, unrounded so that metrics see it whole, and the predicted class."""
    scored = model.transform(df)
    kept = [c for c in df.columns if c != out]
    return scored.select(*kept, vector_to_array("probability")[1].alias(out), F.col("prediction").cast("int").alias("yhat"))


def fit_score_model(training: DataFrame, trees: int = 100, depth: int = 4, step: float = 0.1) -> PipelineModel:
    return boosted_trees(SCORE_FEATURES, trees=trees, depth=depth, step=step).fit(training)


def pair_features(
    pairs: DataFrame, jobs: DataFrame, lexicon: DataFrame, tokens: DataFrame | None = None, terms: DataFrame | None = None
) -> DataFrame:
    """The seven similarity, length, readability and entity features of labelled
    pairs, with the binary label. Posting features are computed once per posting.

    ``terms`` is a vocabulary from :func:`rankloom.operators.terms.fit_terms`, as fitted on
    training pairs; without it one is fitted on these pairs. ``tokens`` are those of the
    pairs, if they are made already.
    """
    resume, text = F.col("resume_text"), F.col("job_text")
    own = pairs.select(
        "pair_id", "job_id", "label", T.word_count(resume).alias("resume_length"), T.reading_ease(resume).alias("resume_readability")
    )
    posts = jobs.select(
        "job_id", T.word_count(text).alias("jd_length"), T.reading_ease(text).alias("jd_readability")
    )
    tokens = I.pair_tokens(pairs, jobs, stop_words=W.STOP_WORDS) if tokens is None else tokens
    cos = I.pair_tfidf_cosine(tokens, I.pair_tfidf(tokens, terms=terms))
    return (
        lookup_join(own, posts, ["job_id"])
        .join(I.ngram_jaccard(tokens), "pair_id")
        .join(cos, "pair_id")
        .join(E.pair_overlap(pairs, jobs, lexicon).select("pair_id", "entity_overlap"), "pair_id")
    )


def ranking_pairs(rows: DataFrame, query: str, key: str, label: str, vector: str, per_row: int = 32) -> DataFrame:
    """Difference vectors of relevant minus other rows of a query.

    Every relevant row meets ``per_row`` others, evenly spaced from a hashed
    start, or all of them if there are fewer; the full product is never built.
    """
    placed = running_totals(
        rows.select(query, key, label, vector), [query, label], [F.col(key)], [key], {"_pos": F.lit(1)}, {"_n": "_pos"}
    )
    others = placed.filter(F.col(label) == 0)
    sizes = others.groupBy(query).agg(F.max("_n").alias("_others"))
    mine = lookup_join(placed.filter(F.col(label) == 1).select(query, key, F.col(vector).alias("_good")), sizes, [query])
    drawn = (
        mine.withColumn("_draws", F.least(F.col("_others"), F.lit(per_row)))
        .withColumn("_i", F.explode_outer(F.expr("sequence(0L, _draws - 1)")))
        .withColumn("_pos", (F.expr("_i * _others div _draws") + hash32("ltr", key)) % F.col("_others") + 1)
    )
    met = drawn.join(others.select(query, "_pos", F.col(vector).alias("_bad"), F.col(key).alias("other")), [query, "_pos"])
    diff = F.zip_with("_good", "_bad", lambda a, b: a - b)
    # Every other pair is turned round, so both classes occur.
    turn = hash32("turn", key, "other") % 2 == 0
    return met.select(
        query,
        F.when(turn, diff).otherwise(F.transform(diff, lambda x: -x)).alias("difference"),
        F.when(turn, 1.0).otherwise(0.0).alias("label"),
    )


def fit_ranker(pairs: DataFrame, iterations: int = 50, regularisation: float = 0.01) -> list[float]:
    """Weights of a linear ranking function from difference vectors."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", fitIntercept=False, standardization=False, maxIter=iterations, regParam=regularisation)
    model = lr.fit(pairs.select("label", array_to_vector("difference").alias("features")))
    return [float(x) for x in model.coefficients.toArray()]


def ranking_scores(rows: DataFrame, vector: str, weights: list[float]) -> DataFrame:
    w = F.array(*[F.lit(x) for x in weights])
    dot = F.aggregate(F.zip_with(vector, w, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return rows.withColumn("score", dot)


def label_codes(train: DataFrame, rows: DataFrame, label: str, out: str) -> DataFrame:
    """Alphabetical label codes fitted on one frame, applied to another; a label not
    met in training is an error."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error").fit(train)
    return model.transform(rows).withColumn(out, F.col(out).cast("int"))


def save_model(model: PipelineModel, root: str, stamp: str) -> str:
    path = f"{root.rstrip('/')}/model_{stamp}"
    model.write().overwrite().save(path)
    return path


def score_saved(path: str, df: DataFrame) -> DataFrame:
    """Load a model once and score a frame with it."""
    return with_probability(PipelineModel.load(path), df)


def log_run(spark: SparkSession, root: str, run: dict) -> None:
    """Append one run (id, experiment, parameters, metrics, start) to the run log."""
    schema = "run_id string, experiment string, params map<string,string>, metrics map<string,double>, start_time timestamp"
    spark.createDataFrame([run], schema).coalesce(1).write.mode("append").parquet(root)


def log_accuracies(runs: DataFrame, root: str) -> None:
    """Append rows (run_id, experiment, accuracy, start_time) to the run log."""
    runs.select(
        F.col("run_id").cast("string").alias("run_id"),
        "experiment",
        F.create_map(F.lit("source"), F.lit("history")).alias("params"),
        F.create_map(F.lit("accuracy"), F.col("accuracy")).alias("metrics"),
        F.col("start_time").cast("timestamp").alias("start_time"),
    ).write.mode("append").parquet(root)
