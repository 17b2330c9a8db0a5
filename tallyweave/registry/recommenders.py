"""Registered queries of the content model and the item-item model."""

from pyspark.sql import functions as F

from tallyweave.functions.text import DELETED_MARKS
from tallyweave.operators import evaluation, neighbours, pearson, profiles, tfidf
from tallyweave.operators.skew import tasks_for
from tallyweave.plans import collaborative, content, rating_model
from tallyweave.registry import sql_views as sql
from tallyweave.registry.exploration import stopwords
from tallyweave.sources import readers, stand_ins, writers
from tallyweave.storage import new_path, written

CO_RATED = 3
LEAST_SIM = 0.3
LEAST_SCORE = 0.01
NEIGHBOURS = 3
LINE_ORDER = ["ts", "l_orderkey", "l_linenumber"]


def _model(spark, folder):
    return content.build_content_model(stand_ins.reviews(spark, folder), stopwords(spark))


def _terms(spark, folder):
    return tfidf.top_terms(tfidf.term_weights(stand_ins.reviews(spark, folder), stopwords(spark)))


def _score_pairs(spark, folder):
    """Customers against businesses, with repeats and with customers no review names."""
    return stand_ins.order_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"), (F.col("l_partkey") % 200).alias("business_id")
    )


def business_word_counts(spark, folder):
    return tfidf.business_word_counts(stand_ins.reviews(spark, folder), stopwords(spark))


def common_words(spark, folder):
    counts = tfidf.business_word_counts(stand_ins.reviews(spark, folder), stopwords(spark))
    return tfidf.common_words(counts)


def tfidf_terms(spark, folder):
    weights = tfidf.term_weights(stand_ins.reviews(spark, folder), stopwords(spark))
    return weights.withColumns({name: F.round(name, 6) for name in ("tf", "tfidf")})


def item_profiles(spark, folder):
    return _terms(spark, folder)


def user_profiles(spark, folder):
    users = profiles.user_profiles(stand_ins.reviews(spark, folder), written(_terms(spark, folder), "terms"))
    return users.select("user_id", F.size("profile").alias("n"), F.array_join("profile", " ").alias("profile"))


def content_scores(spark, folder):
    scores = _model(spark, folder).score(_score_pairs(spark, folder), LEAST_SCORE)
    return scores.withColumn("sim", F.round("sim", 6))


def scores_file(spark, folder):
    """Pairs to score and their scores, both through JSON lines."""
    path = new_path(spark, "scores")
    writers.write_json(_score_pairs(spark, folder), f"{path}/pairs")
    pairs = readers.read_pairs(spark, f"{path}/pairs")
    pairs = pairs.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("business_id").cast("bigint").alias("business_id"))
    writers.write_json(_model(spark, folder).score(pairs, LEAST_SCORE), f"{path}/scores")
    back = spark.read.schema("user_id bigint, business_id bigint, sim double").json(f"{path}/scores")
    return back.withColumn("sim", F.round("sim", 6))


def content_precision_recall(spark, folder):
    """Scored pairs against the pairs with a review."""
    found = _model(spark, folder).score(_score_pairs(spark, folder).distinct(), LEAST_SCORE)
    truth = stand_ins.reviews(spark, folder).select("user_id", "business_id").distinct()
    quality = evaluation.precision_recall(found, truth, ["user_id", "business_id"])
    return quality.withColumns({name: F.round(name, 6) for name in ("precision", "recall")})


def model_roundtrip(spark, folder):
    """Content model through parquet and through tagged JSON lines, as (kind, id, words) of both."""
    path = new_path(spark, "content-model")
    model = _model(spark, folder)
    model.save(f"{path}/tables")
    saved = content.load_content_model(spark, f"{path}/tables")
    saved.export_json(f"{path}/lines")
    items, users = readers.read_profiles(spark, f"{path}/lines")
    parts = [
        ("table-business", saved.businesses, "business_id"),
        ("table-user", saved.users, "user_id"),
        ("line-business", items, "business_id"),
        ("line-user", users, "user_id"),
    ]
    rows = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(key).cast("bigint").alias("id"),
            F.array_join(F.array_sort("profile"), " ").alias("words"),
        )
        for kind, df, key in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def legacy_profiles(spark, folder):
    """Content model written in the older one-key lines and read back."""
    path = new_path(spark, "older-lines")
    model = _model(spark, folder)

    def line(prefix, key):
        return F.to_json(F.create_map(F.concat(F.lit(prefix), F.col(key).cast("string")), F.col("profile")))

    items = model.businesses.select(line("b", "business_id").alias("value"))
    users = model.users.select(line("u", "user_id").alias("value"))
    items.unionByName(users).write.text(path)
    items, users = readers.read_profiles(spark, path)
    return items.select(F.lit("business").alias("kind"), F.col("business_id").alias("id"), F.size("profile").alias("n")).unionByName(
        users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.size("profile").alias("n"))
    )


def _ratings(spark, folder):
    return stand_ins.part_ratings(spark, folder)


def _latest(spark, folder):
    return pearson.latest_ratings(_ratings(spark, folder))


def _edges(spark, folder):
    return collaborative.item_similarity(_ratings(spark, folder), CO_RATED, LEAST_SIM)


def latest_ratings(spark, folder):
    return _latest(spark, folder)


def user_mean_ratings(spark, folder):
    means = neighbours.user_means(_latest(spark, folder))
    return means.withColumn("mean_stars", F.round("mean_stars", 6))


def item_iuf(spark, folder):
    return pearson.user_weights(_ratings(spark, folder)).withColumn("iuf", F.round("iuf", 6))


def item_pair_moments(spark, folder):
    ratings = _joined_once(spark, folder)
    tasks = tasks_for(spark, ratings.count())
    return pearson.pair_moments(pearson.latest_ratings(ratings, tasks=tasks), CO_RATED, tasks=tasks)


def item_pearson(spark, folder):
    return _edges(spark, folder).withColumn("sim", F.round("sim", 6))


def raw_duplicate_pairs(spark, folder):
    """The model from all ratings, repeats included."""
    edges = collaborative.item_similarity(_ratings(spark, folder), CO_RATED, LEAST_SIM, dedupe=False, order=LINE_ORDER)
    return edges.withColumn("sim", F.round("sim", 6))


def repeat_rating_moments(spark, folder):
    """Moments of businesses with themselves over users who rated one more than once."""
    return pearson.repeat_moments(_ratings(spark, folder), 1, LINE_ORDER)


def neighbour_lists(spark, folder):
    return neighbours.both_ways(_edges(spark, folder)).withColumn("sim", F.round("sim", 6))


def edges_roundtrip(spark, folder):
    """Item edges through JSON lines."""
    path = new_path(spark, "edges")
    writers.write_json(_edges(spark, folder), path)
    back = readers.read_item_edges(spark, path)
    return back.select(
        F.col("b1").cast("bigint").alias("b1"), F.col("b2").cast("bigint").alias("b2"), F.round("sim", 6).alias("sim"), "num_co_rated"
    )


def _joined_once(spark, folder, *others):
    """The ratings as a table, for queries that read them several times."""
    return written(_ratings(spark, folder).select("user_id", "business_id", "stars", "ts", *others), "part-ratings")


def _latest_once(spark, ratings):
    return written(pearson.latest_ratings(ratings, tasks=tasks_for(spark, ratings.count())), "latest-ratings")


def _predictions(latest, pairs):
    edges = written(collaborative.item_similarity(latest, CO_RATED, LEAST_SIM, deduped=True), "edges")
    return collaborative.predict_ratings(pairs, edges, latest, NEIGHBOURS, deduped=True)


def rating_predictions(spark, folder):
    """A prediction for every order line, repeats included."""
    ratings = _joined_once(spark, folder)
    predicted = _predictions(_latest_once(spark, ratings), ratings.select("user_id", "business_id"))
    return predicted.withColumn("stars", F.round("stars", 6))


def predictions_file(spark, folder):
    """The predictions through JSON lines."""
    path = new_path(spark, "predictions")
    writers.write_json(rating_predictions(spark, folder), path)
    return spark.read.schema("user_id bigint, business_id bigint, stars double").json(path)


def _refreshed_model(spark, ratings):
    """The model of two thirds of the order lines, saved, read back, and the last third added."""
    path = new_path(spark, "rating-model")
    late = F.col("l_orderkey") % 3 == 0
    rating_model.build(ratings.where(~late), f"{path}/first")
    return rating_model.refresh(rating_model.load(spark, f"{path}/first"), ratings.where(late), f"{path}/second")


def item_pearson_refreshed(spark, folder):
    model = _refreshed_model(spark, _joined_once(spark, folder, "l_orderkey"))
    return rating_model.edges(model, CO_RATED, LEAST_SIM).withColumn("sim", F.round("sim", 6))


def rating_predictions_clustered(spark, folder):
    """The predictions from the refreshed model's neighbour lists, stored clustered and read back."""
    path = new_path(spark, "neighbour-model")
    ratings = _joined_once(spark, folder, "l_orderkey")
    model = _refreshed_model(spark, ratings)
    rating_model.save_neighbours(rating_model.edges(model, CO_RATED, LEAST_SIM), path)
    latest = written(model.cells.toDF("user_id", "business_id", "ts", "stars"), "latest-ratings")
    pairs = ratings.select("user_id", "business_id")
    predicted = rating_model.load_neighbours(spark, path).predict(pairs, latest, NEIGHBOURS)
    return predicted.withColumn("stars", F.round("stars", 6))


def rating_rmse(spark, folder):
    latest = _latest_once(spark, _joined_once(spark, folder))
    predictions = _predictions(latest, latest.select("user_id", "business_id"))
    return evaluation.rmse(predictions, latest).withColumn("rmse", F.round("rmse", 6))


QUERIES = {
    "business_word_counts": business_word_counts,
    "common_words": common_words,
    "tfidf_terms": tfidf_terms,
    "item_profiles": item_profiles,
    "user_profiles": user_profiles,
    "content_scores": content_scores,
    "scores_file": scores_file,
    "predictions_file": predictions_file,
    "content_precision_recall": content_precision_recall,
    "model_roundtrip": model_roundtrip,
    "legacy_profiles": legacy_profiles,
    "latest_ratings": latest_ratings,
    "user_mean_ratings": user_mean_ratings,
    "item_iuf": item_iuf,
    "item_pair_moments": item_pair_moments,
    "item_pearson": item_pearson,
    "raw_duplicate_pairs": raw_duplicate_pairs,
    "repeat_rating_moments": repeat_rating_moments,
    "neighbour_lists": neighbour_lists,
    "edges_roundtrip": edges_roundtrip,
    "rating_predictions": rating_predictions,
    "item_pearson_refreshed": item_pearson_refreshed,
    "rating_predictions_clustered": rating_predictions_clustered,
    "rating_rmse": rating_rmse,
}

_MARKS = DELETED_MARKS.replace("'", "''")

_WEIGHTS = f"""WITH reviews AS MATERIALIZED ({sql.REVIEWS}),
counts AS MATERIALIZED (SELECT business_id, word, count(*) AS n FROM (
    SELECT business_id, unnest(regexp_split_to_array(translate(lower(text), '{_MARKS}', ''), '{sql.SPACE}')) AS word
    FROM reviews)
  WHERE word <> '' AND word NOT IN ({sql.STOPWORD_LIST}) GROUP BY business_id, word),
common AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY word
  HAVING sum(n) >= CAST(0.0001 AS DOUBLE) * (SELECT sum(n) FROM counts)),
weights AS MATERIALIZED (SELECT c.business_id, c.word, c.n, c.n / CAST(total AS DOUBLE) AS tf, df,
    c.n / CAST(total AS DOUBLE) * ln((SELECT count(DISTINCT business_id) FROM reviews) / CAST(df AS DOUBLE)) AS tfidf
  FROM counts c SEMI JOIN common USING (word)
  JOIN (SELECT business_id, sum(n) AS total FROM counts SEMI JOIN common USING (word) GROUP BY 1) t USING (business_id)
  JOIN (SELECT word, count(*) AS df FROM counts SEMI JOIN common USING (word) GROUP BY 1) d USING (word)),
terms AS MATERIALIZED (SELECT * FROM (SELECT business_id, word, CAST(row_number() OVER (
    PARTITION BY business_id ORDER BY round(tfidf, 12) DESC, word) AS INTEGER) AS place FROM weights) WHERE place <= 100),
user_words AS MATERIALIZED (SELECT DISTINCT user_id, word FROM reviews JOIN terms USING (business_id)),
businesses AS (SELECT business_id AS id, count(word) AS n, coalesce(string_agg(word, ' ' ORDER BY word), '') AS words
  FROM (SELECT DISTINCT business_id FROM reviews) LEFT JOIN terms USING (business_id) GROUP BY 1),
users AS (SELECT user_id AS id, count(word) AS n, coalesce(string_agg(word, ' ' ORDER BY word), '') AS words
  FROM (SELECT DISTINCT user_id FROM reviews) LEFT JOIN user_words USING (user_id) GROUP BY 1),
pairs AS (SELECT o_custkey AS user_id, l_partkey % 200 AS business_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
shared AS (SELECT p.user_id, p.business_id, count(*) AS inter FROM (SELECT DISTINCT * FROM pairs) p
  JOIN terms t ON t.business_id = p.business_id
  JOIN user_words u ON u.user_id = p.user_id AND u.word = t.word GROUP BY 1, 2),
scores AS (SELECT user_id, business_id, inter / CAST(u.n + b.n - inter AS DOUBLE) AS sim
  FROM shared JOIN users u ON u.id = user_id JOIN businesses b ON b.id = business_id
  WHERE inter / CAST(u.n + b.n - inter AS DOUBLE) >= {LEAST_SCORE})"""

_RATINGS = f"""WITH ratings AS MATERIALIZED ({sql.PART_RATINGS}),
latest AS MATERIALIZED (SELECT user_id, business_id, stars FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, business_id ORDER BY ts DESC, stars DESC) AS r FROM ratings) WHERE r = 1),
iuf AS (SELECT business_id, count(DISTINCT user_id) AS users,
    ln((SELECT count(DISTINCT user_id) FROM ratings) / CAST(count(DISTINCT user_id) AS DOUBLE)) AS iuf
  FROM ratings GROUP BY business_id)"""

_SUMS = """count(*) AS n, sum(r1) AS s1, sum(r2) AS s2, sum(r1 * r1) AS q1, sum(r2 * r2) AS q2, sum(r1 * r2) AS s12"""

_SIM = f"""SELECT b1, b2, CASE WHEN n * q1 - s1 * s1 > 0 AND n * q2 - s2 * s2 > 0
    THEN (n * s12 - s1 * s2) / (sqrt(n * q1 - s1 * s1) * sqrt(n * q2 - s2 * s2)) ELSE 0 END AS sim, n AS num_co_rated"""

_EDGES = f"""{_RATINGS},
moments AS MATERIALIZED (SELECT b1, b2, {_SUMS} FROM (
    SELECT x.business_id AS b1, y.business_id AS b2, x.stars AS r1, y.stars AS r2
    FROM latest x JOIN latest y ON x.user_id = y.user_id AND x.business_id < y.business_id)
  GROUP BY b1, b2 HAVING count(*) >= {CO_RATED}),
edges AS MATERIALIZED (SELECT * FROM ({_SIM} FROM moments) WHERE sim >= {LEAST_SIM}
  AND b1 NOT IN (SELECT business_id FROM iuf WHERE iuf = 0) AND b2 NOT IN (SELECT business_id FROM iuf WHERE iuf = 0)),
lists AS (SELECT b1 AS target, b2 AS other, sim, num_co_rated FROM edges
  UNION ALL SELECT b2, b1, sim, num_co_rated FROM edges),
means AS (SELECT user_id, avg(stars) AS mean_stars FROM latest GROUP BY user_id),
near AS (SELECT user_id, business_id, adjusted, stars FROM (
    SELECT w.user_id, w.business_id, sim * least(1.0, num_co_rated / CAST(50 AS DOUBLE)) AS adjusted, l.stars,
      row_number() OVER (PARTITION BY w.user_id, w.business_id
        ORDER BY abs(sim * least(1.0, num_co_rated / CAST(50 AS DOUBLE))) DESC, other) AS r
    FROM (SELECT DISTINCT user_id, business_id FROM ratings) w JOIN lists ON target = w.business_id
    JOIN latest l ON l.user_id = w.user_id AND l.business_id = other) WHERE r <= {NEIGHBOURS}),
predicted AS (SELECT w.user_id, w.business_id, greatest(1.0, least(5.0, coalesce(p, mean_stars, 3.0))) AS stars
  FROM (SELECT DISTINCT user_id, business_id FROM ratings) w
  LEFT JOIN (SELECT user_id, business_id, sum(adjusted * stars) / sum(abs(adjusted)) AS p FROM near GROUP BY 1, 2) e
    USING (user_id, business_id)
  LEFT JOIN means USING (user_id))"""

_REPEATS = f"""{_RATINGS},
numbered AS (SELECT *, row_number() OVER (ORDER BY ts, l_orderkey, l_linenumber, stars) AS rid FROM ratings),
meetings AS (SELECT x.business_id AS b1, y.business_id AS b2, x.stars AS r1, y.stars AS r2
  FROM numbered x JOIN numbered y ON x.user_id = y.user_id
    AND (x.business_id < y.business_id OR (x.business_id = y.business_id AND x.rid < y.rid)))"""

_EDGE_COLUMNS = "b1, b2, round(sim, 6) AS sim, num_co_rated"

ORACLE_SQL = {
    "business_word_counts": f"{_WEIGHTS} SELECT business_id, word, n FROM counts",
    "common_words": f"{_WEIGHTS} SELECT word, n FROM common",
    "tfidf_terms": f"""{_WEIGHTS} SELECT business_id, word, n, round(tf, 6) AS tf, df, round(tfidf, 6) AS tfidf
FROM weights""",
    "item_profiles": f"{_WEIGHTS} SELECT business_id, word, place FROM terms",
    "user_profiles": f"{_WEIGHTS} SELECT id AS user_id, CAST(n AS INTEGER) AS n, words AS profile FROM users",
    "content_scores": f"""{_WEIGHTS} SELECT user_id, business_id, round(sim, 6) AS sim
FROM pairs JOIN scores USING (user_id, business_id)""",
    "scores_file": f"""{_WEIGHTS} SELECT user_id, business_id, round(sim, 6) AS sim
FROM pairs JOIN scores USING (user_id, business_id)""",
    "predictions_file": f"""{_EDGES} SELECT user_id, business_id, round(p.stars, 6) AS stars
FROM ratings JOIN predicted p USING (user_id, business_id)""",
    "content_precision_recall": f"""{_WEIGHTS}, totals AS (SELECT
  (SELECT count(*) FROM scores SEMI JOIN reviews USING (user_id, business_id)) AS hits,
  (SELECT count(*) FROM scores) AS found,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, business_id FROM reviews)) AS truth)
SELECT hits, found, truth, round(hits / CAST(found AS DOUBLE), 6) AS precision,
  round(hits / CAST(truth AS DOUBLE), 6) AS recall FROM totals""",
    "model_roundtrip": f"""{_WEIGHTS} SELECT kind, id, words FROM (
  SELECT unnest(['table-business', 'line-business']) AS kind, id, words FROM businesses
  UNION ALL SELECT unnest(['table-user', 'line-user']), id, words FROM users)""",
    "legacy_profiles": f"""{_WEIGHTS} SELECT 'business' AS kind, 'b' || id AS id, CAST(n AS INTEGER) AS n FROM businesses
UNION ALL SELECT 'user', 'u' || id, CAST(n AS INTEGER) FROM users""",
    "latest_ratings": f"{_RATINGS} SELECT user_id, business_id, stars FROM latest",
    "user_mean_ratings": f"{_EDGES} SELECT user_id, round(mean_stars, 6) AS mean_stars FROM means",
    "item_iuf": f"{_RATINGS} SELECT business_id, users, round(iuf, 6) AS iuf FROM iuf",
    "item_pair_moments": f"{_EDGES} SELECT b1, b2, n, s1, s2, q1, q2, s12 FROM moments",
    "item_pearson": f"{_EDGES} SELECT {_EDGE_COLUMNS} FROM edges",
    "item_pearson_refreshed": f"{_EDGES} SELECT {_EDGE_COLUMNS} FROM edges",
    "raw_duplicate_pairs": f"""{_REPEATS}, moments AS (SELECT b1, b2, {_SUMS} FROM meetings
  GROUP BY b1, b2 HAVING count(*) >= {CO_RATED})
SELECT {_EDGE_COLUMNS} FROM ({_SIM} FROM moments) WHERE sim >= {LEAST_SIM}
  AND b1 NOT IN (SELECT business_id FROM iuf WHERE iuf = 0) AND b2 NOT IN (SELECT business_id FROM iuf WHERE iuf = 0)""",
    "repeat_rating_moments": f"{_REPEATS} SELECT b1, b2, {_SUMS} FROM meetings WHERE b1 = b2 GROUP BY b1, b2",
    "neighbour_lists": f"{_EDGES} SELECT target, other, round(sim, 6) AS sim, num_co_rated FROM lists",
    "edges_roundtrip": f"{_EDGES} SELECT {_EDGE_COLUMNS} FROM edges",
    "rating_predictions": f"""{_EDGES} SELECT user_id, business_id, round(p.stars, 6) AS stars
FROM ratings JOIN predicted p USING (user_id, business_id)""",
    "rating_predictions_clustered": f"""{_EDGES} SELECT user_id, business_id, round(p.stars, 6) AS stars
FROM ratings JOIN predicted p USING (user_id, business_id)""",
    "rating_rmse": f"""{_EDGES} SELECT count(*) AS pairs, round(sqrt(avg((p.stars - l.stars) * (p.stars - l.stars))), 6) AS rmse
FROM predicted p JOIN latest l USING (user_id, business_id)""",
}
