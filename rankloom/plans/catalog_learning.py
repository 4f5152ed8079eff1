"""Queries for neighbours, classifiers, ranking models."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.functions import vectors as V
from rankloom.functions import wordlists as W
from rankloom.operators import labels as L
from rankloom.operators import learning as G
from rankloom.operators import matching as M
from rankloom.operators import metrics as K
from rankloom.operators import neighbours as N
from rankloom.operators import terms as I
from rankloom.operators.forest_grid import forest_grid
from rankloom.operators.tree_ranker import fit_tree_ranker, ranker_scores
from rankloom.plans import fixtures as X
from rankloom.plans.catalog_text import EASE, ENTS, q, sql_clean, sql_grams, sql_tfidf, sql_words
from rankloom.plans.registry import query
from rankloom.session import cut_lineage, scratch_path

SPLIT = """cut AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || vec_id), 1, 8))::BIGINT, vec_id)
      <= (((SELECT count(*) FROM embeddings) * 20 + 99) // 100) AS is_test FROM embeddings),
    near AS (SELECT * FROM (SELECT q.id AS query_id, p.id AS point_id, p.label, {dist} AS distance,
      row_number() OVER (PARTITION BY q.id ORDER BY {dist}, p.id) AS rank FROM cut q JOIN cut p ON q.is_test AND NOT p.is_test) WHERE rank <= {k})"""
EUCLID = "round(list_distance(q.v, p.v), 6)"
MANHATTAN = "round(list_sum(list_transform(range(1, 65), lambda i: abs(q.v[i] - p.v[i]))), 6)"


def points(spark, d):
    return X.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def neighbours(spark, d, k, metric="euclidean"):
    test, train = N.split_points(points(spark, d))
    found = N.nearest(test.select("id", "vector"), train.select("id", "vector"), k, [], metric)
    return found.join(train.select(F.col("id").alias("point_id"), "label"), "point_id")


@query("d5_nearest_neighbours", f"WITH {SPLIT.format(dist=EUCLID, k=11)} SELECT query_id, point_id, distance, rank FROM near")
def d5(spark, d):
    return neighbours(spark, d, 11).select("query_id", "point_id", "distance", "rank")


@query(
    "d5_knn_uniform",
    f"""WITH {SPLIT.format(dist=EUCLID, k=5)}, votes AS (SELECT query_id, label, count(*) AS n FROM near GROUP BY query_id, label)
    SELECT query_id, arg_max(label, (n, -label)) AS predicted FROM votes GROUP BY query_id""",
)
def d5_uniform(spark, d):
    return N.vote(neighbours(spark, d, 5), ["query_id"])


@query(
    "d5_knn_distance_manhattan",
    f"""WITH {SPLIT.format(dist=MANHATTAN, k=7)}, votes AS (SELECT query_id, label, round(sum(1 / distance), 6) AS n FROM near GROUP BY query_id, label)
    SELECT query_id, arg_max(label, (n, -label)) AS predicted FROM votes GROUP BY query_id""",
)
def d5_distance(spark, d):
    return N.vote(neighbours(spark, d, 7, "manhattan"), ["query_id"], weights="distance")


@query(
    "d2_approximate_search",
    """WITH planes AS MATERIALIZED (SELECT i, list(CASE WHEN ('0x' || substr(md5('plane:' || i || ':' || j), 1, 8))::BIGINT % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END ORDER BY j) AS plane
      FROM range(512) a(i), range(64) b(j) GROUP BY i),
    codes AS MATERIALIZED (SELECT vec_id, string_agg(CASE WHEN list_dot_product(embedding::DOUBLE[], plane) >= 0 THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS code
      FROM embeddings, planes GROUP BY vec_id),
    met AS MATERIALIZED (SELECT a.job_id, a.section, a.candidate_id, a.embedding, v.job_embedding, bit_count(xor(mine.code, theirs.code)) AS bits FROM v_applied a
      JOIN v_job_vectors v ON v.job_id = a.job_id JOIN codes mine ON mine.vec_id = a.vec_id JOIN codes theirs ON theirs.vec_id = a.job_id),
    upto AS (SELECT *, count(*) OVER (PARTITION BY job_id, section ORDER BY bits RANGE UNBOUNDED PRECEDING) AS n_upto, count(*) OVER (PARTITION BY job_id, section) AS n FROM met),
    kept AS (SELECT *, min(bits) FILTER (n_upto >= least(n, greatest(200, ceil(n * 0.2::DOUBLE)))) OVER (PARTITION BY job_id, section) AS radius FROM upto),
    scored AS (SELECT job_id, section, candidate_id, round(list_cosine_similarity(embedding::DOUBLE[], job_embedding::DOUBLE[]), 6) AS similarity FROM kept WHERE bits <= radius)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, section ORDER BY similarity DESC, candidate_id) AS rank FROM scored) WHERE rank <= 100""",
)
def d2(spark, d):
    return N.approximate_matches(X.applied(spark, d), X.job_vectors(spark, d))


@query(
    "l1_oversampling",
    """WITH counts AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM embeddings GROUP BY label),
    minority AS (SELECT e.vec_id AS id, e.embedding::DOUBLE[] AS v, e.label, c.n, c.need,
      row_number() OVER (PARTITION BY e.label ORDER BY ('0x' || substr(md5('smote:' || vec_id), 1, 8))::BIGINT, vec_id) AS pos
      FROM embeddings e JOIN counts c ON c.label = e.label WHERE c.need > 0),
    near AS (SELECT * FROM (SELECT q.id, p.id AS neighbour_id, p.v AS other, row_number() OVER (PARTITION BY q.id ORDER BY round(list_distance(q.v, p.v), 6), p.id) AS rank
      FROM minority q JOIN minority p ON q.label = p.label AND q.id <> p.id) WHERE rank <= 5),
    drawn AS (SELECT *, ('0x' || substr(md5('smote-pick:' || id || ':' || copy), 1, 8))::BIGINT % least(5, n - 1) + 1 AS rank,
      ('0x' || substr(md5('smote-at:' || id || ':' || copy), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS t
      FROM (SELECT *, unnest(range(1, need // n + CASE WHEN pos <= need % n THEN 1 ELSE 0 END + 1)) AS copy FROM minority)),
    made AS (SELECT d.id, d.copy, d.label, x.neighbour_id, d.v[1] + d.t * (x.other[1] - d.v[1]) AS v1, d.v[64] + d.t * (x.other[64] - d.v[64]) AS v64
      FROM drawn d JOIN near x ON x.id = d.id AND x.rank = d.rank)
    SELECT id, copy, label, neighbour_id, round(v1, 6) AS first_value, round(v64, 6) AS last_value FROM made
    UNION ALL SELECT vec_id, 0, label, NULL, round(embedding[1]::DOUBLE, 6), round(embedding[64]::DOUBLE, 6) FROM embeddings""",
)
def l1(spark, d):
    out = N.oversample(points(spark, d))
    return out.select(
        "id", "copy", "label", "neighbour_id", F.round(F.element_at("vector", 1), 6).alias("first_value"), F.round(F.element_at("vector", -1), 6).alias("last_value")
    )


def _near(dist: str) -> str:
    return f"""(SELECT * FROM (SELECT q.id AS query_id, q.label AS actual, p.label, {dist} AS distance, row_number() OVER (PARTITION BY q.id ORDER BY {dist}, p.id) AS rank
      FROM folded q JOIN folded p ON p.fold <> q.fold) WHERE rank <= 11)"""


@query(
    "l2_knn_grid",
    f"""WITH folded AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label,
      (row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5('fold:' || vec_id), 1, 8))::BIGINT, vec_id) - 1) % 3 AS fold FROM embeddings),
    euclid AS MATERIALIZED {_near(EUCLID)}, city AS MATERIALIZED {_near(MANHATTAN)},
    lists AS (SELECT 'euclidean' AS metric, * FROM euclid UNION ALL SELECT 'minkowski', * FROM euclid UNION ALL SELECT 'manhattan', * FROM city),
    grid AS (SELECT l.*, ks.k FROM lists l JOIN (SELECT unnest([3, 5, 7, 9, 11]) AS k) ks ON l.rank <= ks.k),
    weighed AS (SELECT metric, 'uniform' AS weights, k, query_id, actual, label, 1.0::DOUBLE AS wt FROM grid
      UNION ALL SELECT metric, 'distance', k, query_id, actual, label, 1 / distance FROM grid),
    votes AS (SELECT metric, weights, k, query_id, actual, label, round(sum(wt), 6) AS n FROM weighed GROUP BY ALL),
    pred AS (SELECT metric, weights, k, query_id, actual, arg_max(label, (n, -label)) AS predicted FROM votes GROUP BY metric, weights, k, query_id, actual)
    SELECT metric, weights, k::INTEGER AS k, round(avg((predicted = actual)::INTEGER::DOUBLE), 6) AS accuracy FROM pred GROUP BY metric, weights, k""",
)
def l2(spark, d):
    folded = cut_lineage(L.assign_folds(points(spark, d), "label", "id"))
    return N.knn_grid(folded)


U = "(('0x' || substr(md5('{n}:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 100)"


@query(
    "l7_synthetic_candidates",
    f"""SELECT doc_id, round(s, 6) AS skills, round(e, 6) AS experience, round(u, 6) AS education, round(p, 6) AS projects, missing, CASE WHEN total >= 6000 THEN 1 ELSE 0 END AS label FROM
    (SELECT *, s * 40 + e * 30 + u * 15 + p * 15 AS total FROM (SELECT doc_id, {U.format(n='skills')} AS s, {U.format(n='experience')} AS e, {U.format(n='education')} AS u, {U.format(n='projects')} AS p,
      ('0x' || substr(md5('missing:' || doc_id), 1, 8))::BIGINT % 9 AS missing FROM documents)) WHERE total >= 6000 OR total < 4000""",
)
def l7(spark, d):
    rows = G.synthetic_candidates(X.table(spark, d, "documents").select("doc_id"), "doc_id")
    return rows.select("doc_id", *[F.round(c, 6).alias(c) for c in G.SCORE_FEATURES[:4]], "missing", "label")


def score_model(spark, d):
    return G.fit_score_model(G.synthetic_candidates(X.table(spark, d, "documents").select("doc_id"), "doc_id"))


@query("l6_fit_model")
def l6(spark, d):
    rows = cut_lineage(G.synthetic_candidates(X.table(spark, d, "documents").select("doc_id"), "doc_id"))
    scored = G.with_probability(G.fit_score_model(rows), rows)
    return K.confusion(scored.select(F.col("label").alias("y"), "yhat"))


@query("g2_fit_probability")
def g2(spark, d):
    return G.with_probability(score_model(spark, d), X.scores(spark, d), "fit_probability").select("resume_id", "job_id", "fit_probability")


@query("l11_batch_scoring")
def l11(spark, d):
    path = G.save_model(score_model(spark, d), scratch_path(spark, "models"), "20240101_000000")
    scored = G.score_saved(path, X.scores(spark, d))
    return scored.select("job_id", "resume_id", F.col("yhat").alias("prediction"), L.status_of_prediction(F.col("yhat")).alias("status"))


@query("l4_boosted_trees_on_vectors")
def l4(spark, d):
    both = M.pair_features(X.sections(spark, d), X.job_vectors(spark, d), ["job_id"], "embedding", "job_embedding")
    rows = both.select(F.col("vec_id").alias("id"), F.col("features").alias("vector"), F.when(F.col("label") < 3, 1).otherwise(0).alias("label"))
    test, train = N.split_points(rows)
    balanced = cut_lineage(N.oversample(train)).select("label", array_to_vector("vector").alias("features"))
    model = G.boosted_trees_on_vectors().fit(balanced)
    pred = G.with_probability(model, test.select("id", F.col("label").alias("y"), array_to_vector("vector").alias("features")))
    return K.classification_report(pred)


L5_DOCS = f"""SELECT 'resume' AS side, pair_id AS doc_id, {sql_words(sql_clean('resume_text'), True)} AS tok, (split = 'train')::BIGINT AS uses FROM cut
    UNION ALL SELECT 'job', job_id, {sql_words(sql_clean('any_value(job_description_text)'), True)}, count(*) FILTER (split = 'train') FROM cut GROUP BY job_id"""


def _stats(side: str, key: str, text: str, source: str) -> str:
    return f"""SELECT '{side}' AS side, {key} AS doc_id, length(list_filter(regexp_split_to_array({text}, {q(T.WHITE)}), lambda t: t <> '')) AS words,
      length(regexp_extract_all({text}, '[.!?]+')) AS ends, length(regexp_extract_all(lower({text}), '[aeiouy]+')) AS vowels FROM {source}"""


def split_features(spark, d):
    """Features of the labelled pairs and their split; term weights learn from training rows alone."""
    pairs = cut_lineage(L.exact_split(X.pairs(spark, d).filter(F.col("label") != "Potential Fit"), "pair_id"))
    jobs = X.jobs(spark, d)
    tokens = I.pair_tokens(pairs, jobs, stop_words=W.STOP_WORDS)
    fitted = I.fit_terms(I.training_tokens(tokens, pairs.filter("split = 'train'")))
    terms = spark.read.parquet(I.save_terms(fitted, scratch_path(spark, "terms")))
    feats = G.pair_features(pairs, jobs, X.lexicon(spark, d), tokens, terms)
    return feats.join(pairs.select("pair_id", "split"), "pair_id").withColumn("label", L.numeric_target(F.col("label")))


@query(
    "l5_features",
    f"""WITH cut AS MATERIALIZED (SELECT *, CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || pair_id), 1, 8))::BIGINT, pair_id)
      <= (count(*) OVER () * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS split FROM v_pairs WHERE label <> 'Potential Fit'),
    {sql_tfidf(L5_DOCS, 'tok', None, 'HAVING sum(uses) > 0')}, {ENTS},
    dots AS (SELECT p.pair_id, sum(r.weight * j.weight) AS dot FROM cut p JOIN weights r ON r.side = 'resume' AND r.doc_id = p.pair_id
      JOIN weights j ON j.side = 'job' AND j.doc_id = p.job_id AND j.term = r.term GROUP BY p.pair_id),
    sets AS (SELECT side, doc_id, list_distinct({sql_grams('tok', 2, 3)}) AS grams FROM docs),
    sims AS (SELECT c.pair_id, length(list_intersect(a.grams, b.grams))::DOUBLE AS common, length(a.grams) + length(b.grams) AS sizes FROM cut c
      JOIN sets a ON a.side = 'resume' AND a.doc_id = c.pair_id JOIN sets b ON b.side = 'job' AND b.doc_id = c.job_id),
    stats AS (SELECT side, doc_id, words, {EASE} AS ease FROM ({_stats('resume', 'pair_id', 'resume_text', 'cut')} UNION ALL {_stats('job', 'job_id', 'job_text', 'v_jobs')}))
    SELECT c.pair_id, c.split, CASE c.label WHEN 'Good Fit' THEN 1 ELSE 0 END AS label, round(CASE WHEN sizes = 0 THEN 0.0 ELSE common / (sizes - common) END, 6) AS jaccard,
    round(coalesce(dot, 0.0), 6) AS tfidf_cosine, r.words AS resume_length, r.ease AS resume_readability, j.words AS jd_length, j.ease AS jd_readability,
    length(list_intersect(e.r, e.j)) AS entity_overlap FROM cut c JOIN sims s ON s.pair_id = c.pair_id JOIN ents e ON e.pair_id = c.pair_id
    JOIN stats r ON r.side = 'resume' AND r.doc_id = c.pair_id JOIN stats j ON j.side = 'job' AND j.doc_id = c.job_id LEFT JOIN dots x ON x.pair_id = c.pair_id""",
)
def l5_features(spark, d):
    rounded = ["jaccard", "tfidf_cosine", "resume_readability", "jd_readability"]
    rows = split_features(spark, d).select("pair_id", "split", "label", *G.PAIR_FEATURES)
    return rows.withColumns({c: F.round(c, 6) for c in rounded})


@query("l5_pair_classifier")
def l5(spark, d):
    cut = cut_lineage(split_features(spark, d))
    model = G.boosted_trees(G.PAIR_FEATURES).fit(cut.filter("split = 'train'"))
    pred = cut_lineage(G.with_probability(model, cut.filter("split = 'test'"), "score").withColumnRenamed("label", "y"))
    return K.precision_recall_f1(pred).withColumns(
        {"accuracy": K.accuracy(pred).scalar(), "auc": K.roc_auc(pred).scalar(), "log_loss": K.log_loss(pred).scalar()}
    )


@query("l3_random_forest_grid")
def l3(spark, d):
    folded = L.assign_folds(points(spark, d), "label", "id")
    rows = cut_lineage(folded.select("id", "fold", "label", "vector")).select("fold", "label", array_to_vector(V.as_double(F.col("vector"))).alias("features"))
    return spark.createDataFrame(forest_grid(rows), "max_depth int, min_split int, min_leaf int, trees int, accuracy double")


def ranking_rows(spark, d):
    e = X.table(spark, d, "embeddings")
    vector = V.as_double(F.col("embedding"))
    return e.select((F.col("vec_id") % 20).alias("qid"), F.col("vec_id").alias("id"), F.when(F.col("label") < 3, 1).otherwise(0).alias("y"), vector.alias("vector"), array_to_vector(vector).alias("features"))


@query("l8_learning_to_rank")
def l8(spark, d):
    rows = ranking_rows(spark, d)
    return K.average_precision(ranker_scores(rows, fit_tree_ranker(rows, "qid", "y")), "qid", "score", "y", "id", 10**9)


@query("l8_linear_ranker")
def l8_linear(spark, d):
    rows = ranking_rows(spark, d).drop("features")
    weights = G.fit_ranker(cut_lineage(G.ranking_pairs(rows, "qid", "id", "y", "vector")))
    return K.average_precision(G.ranking_scores(rows, "vector", weights), "qid", "score", "y", "id", 10**9)


@query(
    "l9_label_codes",
    "SELECT event_id, label, (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS code FROM v_mixed_labels WHERE label IS NOT NULL",
)
def l9(spark, d):
    rows = L.drop_incomplete(X.mixed_labels(spark, d), ["label"])
    return G.label_codes(rows, rows, "label", "code")


@query("l13_run_log", "SELECT experiment, count(*) AS n_runs, max(accuracy) AS best_accuracy FROM v_runs GROUP BY experiment")
def l13(spark, d):
    root = scratch_path(spark, "runs")
    G.log_accuracies(X.runs(spark, d), root)
    return spark.read.parquet(root).groupBy("experiment").agg(F.count("*").alias("n_runs"), F.max(F.col("metrics")["accuracy"]).alias("best_accuracy"))
