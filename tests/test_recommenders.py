import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave import storage
from tallyweave.operators import evaluation, neighbours, pearson, products, profiles, skew, tfidf
from tallyweave.plans import collaborative, content
from tallyweave.sources import readers, writers
from tallyweave.storage import tables_written

RATING = "user_id string, business_id string, stars double, ts int"


def _ratings(seed, users=30, items=12, repeats=0, everyone=None, heavy=0):
    draw = random.Random(seed)
    rows = []
    for u in range(users):
        for b in draw.sample(range(items), draw.randint(1, 6)):
            rows.append((f"u{u:02}", f"b{b:02}", float(draw.randint(1, 5))))
    for u in range(heavy):
        rows += [(f"h{u}", f"b{b:02}", float(draw.randint(1, 5))) for b in range(items)]
    if everyone:
        have = {(u, b) for u, b, _ in rows}
        rows += [(u, everyone, float(draw.randint(1, 5))) for u in sorted({r[0] for r in rows}) if (u, everyone) not in have]
    rows += [(u, b, float(draw.randint(1, 5))) for u, b, _ in draw.choices(rows, k=repeats)]
    return [(*row, ts) for ts, row in enumerate(rows)]


def _pearson(pairs):
    n = len(pairs)
    m1, m2 = sum(a for a, _ in pairs) / n, sum(b for _, b in pairs) / n
    v1, v2 = sum((a - m1) ** 2 for a, _ in pairs), sum((b - m2) ** 2 for _, b in pairs)
    if v1 < 1e-9 or v2 < 1e-9:
        return 0.0
    return sum((a - m1) * (b - m2) for a, b in pairs) / math.sqrt(v1 * v2)


def _brute_edges(rows, least, least_sim, dedupe):
    if dedupe:
        rows = [(u, b, s, ts) for (u, b), (ts, s) in {(u, b): (ts, s) for u, b, s, ts in rows}.items()]
    by_user, raters = defaultdict(list), defaultdict(set)
    for u, b, s, _ in sorted(rows, key=lambda r: r[3]):
        by_user[u].append((b, s))
        raters[b].add(u)
    met = defaultdict(list)
    for rated in by_user.values():
        for (b1, r1), (b2, r2) in combinations(rated, 2):
            met[(b1, b2) if b1 <= b2 else (b2, b1)].append((r1, r2) if b1 <= b2 else (r2, r1))
    edges = {}
    for (b1, b2), pairs in met.items():
        constant = len(by_user) in (len(raters[b1]), len(raters[b2]))
        sim = 0.0 if constant else _pearson(pairs)
        if len(pairs) >= least and sim >= least_sim:
            edges[b1, b2] = (round(sim, 9), len(pairs))
    return edges


def _edges(df):
    return {(r.b1, r.b2): (round(r.sim, 9), r.num_co_rated) for r in df.collect()}


@pytest.mark.parametrize("heavy_user", [4, 2000])
@pytest.mark.parametrize("least_sim", [0.3, -2.0])
@pytest.mark.parametrize("dedupe", [True, False])
def test_edges_equal_brute_force(spark, heavy_user, least_sim, dedupe):
    rows = _ratings(3, repeats=25, everyone="b99", heavy=3)
    frame = spark.createDataFrame(rows, RATING)
    found = collaborative.item_similarity(frame, 3, least_sim, dedupe, "ts", heavy_user)
    assert _edges(found) == _brute_edges(rows, 3, least_sim, dedupe)


def test_constant_ratings_are_zero(spark):
    rows = [(f"u{u}", b, s, u) for u in range(5) for b, s in (("a", 4.1), ("b", float(u % 3 + 1)), ("c", 4.1))]
    rows.append(("v", "z", 1.0, 9))  # keeps the three from being rated by everyone
    found = collaborative.item_similarity(spark.createDataFrame(rows, RATING), 3, -1.0)
    assert {r.sim for r in found.collect()} == {0.0}


def test_latest_rating_wins_then_the_highest(spark):
    rows = [("u", "b", 5.0, 1), ("u", "b", 2.0, 2), ("u", "b", 3.0, 2)]
    assert pearson.latest_ratings(spark.createDataFrame(rows, RATING)).first().stars == 3.0


def test_user_weights(spark):
    rows = [("u", "a", 1.0, 0), ("v", "a", 1.0, 0), ("u", "b", 1.0, 0), ("u", "b", 2.0, 0)]
    found = {r.business_id: (r.users, r.iuf) for r in pearson.user_weights(spark.createDataFrame(rows, RATING)).collect()}
    assert found == {"a": (2, 0.0), "b": (1, math.log(2))}


def _brute_predictions(pairs, edges, ratings, n):
    """The prediction formula on matrices: W holds shrunk similarities, R the ratings, NaN where there is none."""
    names = sorted({b for edge in edges for b in edge[:2]} | {b for _, b, _ in ratings} | {b for _, b in pairs})
    users = sorted({u for u, _, _ in ratings} | {u for u, _ in pairs})
    W, R = np.full((len(names),) * 2, np.nan), np.full((len(users), len(names)), np.nan)
    for b1, b2, sim, count in edges:
        i, j = names.index(b1), names.index(b2)
        W[i, j] = W[j, i] = sim * min(1, count / 50)
    for u, b, stars in ratings:
        R[users.index(u), names.index(b)] = stars
    out = []
    for u, b in pairs:
        w, r = W[names.index(b)], R[users.index(u)]
        usable = np.flatnonzero(~np.isnan(w) & ~np.isnan(r))
        top = usable[np.lexsort((usable, -np.abs(w[usable])))][:n]
        mean = 3.0 if np.isnan(r).all() else np.nanmean(r)
        value = w[top] @ r[top] / np.abs(w[top]).sum() if len(top) else mean
        out.append((u, b, round(float(np.clip(value, 1, 5)), 9)))
    return sorted(out)


def test_predictions_equal_brute_force(spark):
    draw = random.Random(8)
    ratings = [(u, b, s) for u, b, s, _ in _ratings(8, users=20, items=15)]
    edges = [
        (f"b{i:02}", f"b{j:02}", draw.choice([-0.9, 0.3, 0.5, 0.8, 0.8]), draw.randint(3, 70))
        for i, j in combinations(range(15), 2)
        if draw.random() < 0.5
    ]
    pairs = [(f"u{draw.randint(0, 24):02}", f"b{draw.randint(0, 17):02}") for _ in range(60)]
    pairs += pairs[:7]
    found = neighbours.predict(
        spark.createDataFrame(pairs, "user_id string, business_id string"),
        spark.createDataFrame(edges, "b1 string, b2 string, sim double, num_co_rated bigint"),
        spark.createDataFrame(ratings, "user_id string, business_id string, stars double"),
        3,
    )
    got = sorted((r.user_id, r.business_id, round(r.stars, 9)) for r in found.collect())
    assert got == _brute_predictions(pairs, edges, ratings, 3)


def test_shrink_clamp_and_fallbacks(spark):
    edges = spark.createDataFrame([("a", "b", 0.8, 25), ("a", "c", -0.5, 50)], "b1 string, b2 string, sim double, num_co_rated bigint")
    ratings = spark.createDataFrame([("u", "b", 5.0), ("u", "c", 5.0), ("v", "d", 2.0)], "user_id string, business_id string, stars double")
    near = neighbours.rated_neighbours(
        spark.createDataFrame([("u", "a")], "user_id string, business_id string"), neighbours.both_ways(edges), ratings
    )
    assert {(r.other, r.adjusted) for r in near.collect()} == {("b", 0.4), ("c", -0.5)}
    pairs = spark.createDataFrame([("u", "a"), ("v", "a"), ("w", "a")], "user_id string, business_id string")
    found = {r.user_id: r.stars for r in neighbours.predict(pairs, edges, ratings).collect()}
    assert found == {"u": 1.0, "v": 2.0, "w": 3.0}


REVIEWS = [
    ("u1", "b1", "Good pizza, good crust!"),
    ("u2", "b1", "the pizza 123"),
    ("u2", "b2", "sushi pizza don't"),
    ("u3", "b3", "the 42 ..."),
]


def _content_frame(spark):
    return spark.createDataFrame(REVIEWS, "user_id string, business_id string, text string")


def _stop(spark):
    return spark.createDataFrame([("the",), ("don't",)], "word string")


def test_term_weights(spark):
    found = {(r.business_id, r.word): (r.n, r.tf, r.df, r.tfidf) for r in tfidf.term_weights(_content_frame(spark), _stop(spark)).collect()}
    assert found["b1", "pizza"] == (2, 0.4, 2, pytest.approx(0.4 * math.log(3 / 2)))
    assert found["b1", "good"] == (2, 0.4, 1, pytest.approx(0.4 * math.log(3)))
    # The apostrophe is deleted first, so the stopword "don't" cannot match.
    assert found["b2", "dont"][0] == 1
    assert not any(business == "b3" for business, _ in found)


def test_a_long_vocabulary_is_not_broadcast_and_changes_nothing(spark):
    reviews, stop = _content_frame(spark), _stop(spark)
    rows = [{tuple(r) for r in tfidf.term_weights(reviews, stop, share).collect()} for share in (1e-5, 1e-9)]
    assert rows[0] == rows[1] and rows[0]


def test_constant_and_lonely_items_form_no_pairs(spark):
    rows = [(f"u{u}", b, s, 0) for u in range(6) for b, s in (("x", 1.0 + u % 3), ("y", 1.0 + u % 3), ("flat", 4.0))]
    rows += [("u0", "lonely", 2.0, 0), ("u1", "lonely", 3.0, 0)]
    frame = spark.createDataFrame(rows, RATING)
    moments = pearson.pair_moments(pearson.latest_ratings(frame, "ts"), 3, correlated=True).collect()
    assert {(m.b1, m.b2) for m in moments} == {("x", "y")}
    plain = pearson.pair_moments(pearson.latest_ratings(frame, "ts"), 3).collect()
    assert {(m.b1, m.b2, m.n) for m in plain} == {("flat", "x", 6), ("flat", "y", 6), ("x", "y", 6)}


@pytest.mark.parametrize("heavy_user", [1, 2000])
def test_users_set_aside_add_their_part(spark, heavy_user):
    draw = random.Random(12)
    rows = [(f"u{u}", f"b{b}", float(draw.randint(1, 5)), 0) for u in range(9) for b in range(8) if draw.random() < 0.8]
    frame = pearson.latest_ratings(spark.createDataFrame(rows, RATING), "ts")
    found = {(m.b1, m.b2): tuple(m)[2:] for m in pearson.pair_moments(frame, 4, heavy_user).collect()}
    stars = defaultdict(dict)
    for u, b, s, _ in rows:
        stars[b][u] = s
    expected = {}
    for a, b in combinations(sorted(stars), 2):
        both = [(stars[a][u], stars[b][u]) for u in stars[a].keys() & stars[b].keys()]
        if len(both) >= 4:
            x, y = np.array(both).T
            expected[a, b] = (len(both), x.sum(), y.sum(), x @ x, y @ y, x @ y)
    assert found == expected and len(found) > 10


def test_rare_words_are_dropped(spark):
    text = " ".join(["common"] * 30 + ["middle"] * 3 + ["rare"])
    frame = spark.createDataFrame([("u", "b", text)], "user_id string, business_id string, text string")
    counts = tfidf.business_word_counts(frame, _stop(spark))
    kept = {r.word: r.n for r in tfidf.common_words(counts, 3 / 34).collect()}
    assert kept == {"common": 30, "middle": 3}


def test_content_model_scores_and_files(spark, tmp_path):
    model = content.build_content_model(_content_frame(spark), _stop(spark), words=2)
    profiles = {r.business_id: r.profile for r in model.businesses.collect()}
    assert profiles == {"b1": ["good", "crust"], "b2": ["dont", "sushi"], "b3": []}
    users = {r.user_id: r.profile for r in model.users.collect()}
    assert users == {"u1": ["crust", "good"], "u2": ["crust", "dont", "good", "sushi"], "u3": []}
    pairs = spark.createDataFrame(
        [("u1", "b1"), ("u1", "b1"), ("u2", "b1"), ("u1", "b2"), ("u3", "b3"), ("x", "b1"), ("u1", "y")],
        "user_id string, business_id string",
    )
    scores = Counter(tuple(r) for r in model.score(pairs).collect())
    assert scores == {("u1", "b1", 1.0): 2, ("u2", "b1", 0.5): 1}
    assert model.score(pairs, 0.0).count() == 7
    model.save(str(tmp_path / "model"))
    loaded = content.load_content_model(spark, str(tmp_path / "model"))
    assert Counter(tuple(r) for r in loaded.score(pairs).collect()) == scores
    model.export_json(str(tmp_path / "lines"))
    businesses, users = readers.read_profiles(spark, str(tmp_path / "lines"))
    assert {r.business_id: r.profile for r in businesses.collect()} == profiles
    assert users.count() == 3


def test_score_equality_is_kept(spark):
    users = spark.createDataFrame([("u", [f"w{i}" for i in range(100)])], "user_id string, profile array<string>")
    businesses = spark.createDataFrame([("b", ["w0"])], "business_id string, profile array<string>")
    model = content.ContentModel(businesses, users)
    pairs = spark.createDataFrame([("u", "b")], "user_id string, business_id string")
    assert model.score(pairs, 0.01).first().sim == 0.01


def test_older_profile_lines(spark, tmp_path):
    lines = ['{"u1": ["a", "b"]}', '{"b7": ["a"]}', '{"business": "b8", "profile": []}', '{"user": "x", "profile": ["c"]}']
    (tmp_path / "m").write_text("\n".join(lines))
    businesses, users = readers.read_profiles(spark, str(tmp_path / "m"))
    assert {r.business_id: r.profile for r in businesses.collect()} == {"b7": ["a"], "b8": []}
    assert {r.user_id: r.profile for r in users.collect()} == {"u1": ["a", "b"], "x": ["c"]}


def test_edges_file(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", 0.5, 3)], "b1 string, b2 string, sim double, num_co_rated bigint")
    writers.write_json(edges, str(tmp_path / "e"))
    assert [tuple(r) for r in readers.read_item_edges(spark, str(tmp_path / "e")).collect()] == [("a", "b", 0.5, 3)]


def test_rmse_and_precision(spark):
    rated = "user_id string, business_id string, stars double"
    predicted = spark.createDataFrame([("u", "a", 3.0), ("u", "b", 5.0), ("u", "z", 1.0)], rated)
    actual = spark.createDataFrame([("u", "a", 4.0), ("u", "b", 3.0)], rated)
    row = evaluation.rmse(predicted, actual).first()
    assert (row.pairs, row.rmse) == (2, math.sqrt(2.5))
    quality = evaluation.precision_recall(predicted, actual, ["user_id", "business_id"]).first()
    assert (quality.hits, quality.precision, quality.recall) == (2, 2 / 3, 1.0)
    empty = predicted.where(F.lit(False))
    assert evaluation.precision_recall(empty, actual, ["user_id", "business_id"]).first().precision is None


def _matrix_frame(spark, stars):
    """(user_id, business_id, stars, ts) of a users x items matrix, zeros left out; made in Spark from its rows."""
    users, items = stars.shape
    rows = [(f"u{u:03}", stars[u].tolist()) for u in range(users)]
    frame = spark.createDataFrame(rows, "user_id string, row array<double>")
    frame = frame.select("user_id", F.posexplode("row").alias("item", "stars")).where("stars > 0")
    frame = frame.select("user_id", F.format_string("b%06d", "item").alias("business_id"), "stars", F.lit(0).alias("ts"))
    # One more user, so that no item is rated by everyone.
    return frame.unionByName(spark.createDataFrame([("other", "lonely", 3.0, 0)], frame.schema))


def _matrix_edges(stars, least, least_sim, step=500):
    """(b1, b2) -> (similarity, co-raters), from products of the whole matrix."""
    there, out = (stars > 0).astype(float), {}
    for a in range(0, stars.shape[1], step):
        one, here = stars[:, a : a + step], there[:, a : a + step]
        n, s1, s2 = here.T @ there, one.T @ there, here.T @ stars
        q1, q2, s12 = (one**2).T @ there, here.T @ stars**2, one.T @ stars
        spread = np.sqrt(np.maximum(n * q1 - s1**2, 0)) * np.sqrt(np.maximum(n * q2 - s2**2, 0))
        sim = np.divide(n * s12 - s1 * s2, spread, out=np.zeros_like(n), where=spread > 1e-9)
        for i, j in zip(*np.nonzero((n >= least) & (sim >= least_sim))):
            if a + i < j:
                out[f"b{a + i:06}", f"b{j:06}"] = (round(float(sim[i, j]), 9), int(n[i, j]))
    return out


def test_fifty_users_of_twenty_thousand_items(spark):
    """10^10 pairs of ratings: they leave the products as no more rows than there are similar pairs."""
    draw = np.random.RandomState(5)
    stars = draw.randint(1, 6, (50, 20_000)).astype(float)
    stars[:, 1000:1010] = np.clip(stars[:, :1] + draw.randint(0, 2, (50, 10)), 1, 5)
    before = len(tables_written(spark))
    found = collaborative.item_similarity(_matrix_frame(spark, stars), 3, 0.62)
    expected = _matrix_edges(stars, 3, 0.62)
    assert len(expected) > 30 and _edges(found) == expected
    made = [path for path in tables_written(spark)[before:] if "/block-products-" in path]
    assert [spark.read.parquet(path).count() for path in made] == [len(expected)]


@pytest.mark.parametrize("least_sim", [0.3, -2.0])
def test_heavy_and_light_users_over_several_blocks(spark, monkeypatch, least_sim):
    monkeypatch.setattr(products, "BLOCK", 16)
    monkeypatch.setattr(products, "CHUNK", 64)
    draw = np.random.RandomState(8)
    stars = draw.randint(1, 11, (150, 120)) / 2 * (draw.rand(150, 120) < np.linspace(0.01, 0.6, 150)[:, None])
    found = collaborative.item_similarity(_matrix_frame(spark, stars), 3, least_sim, heavy_user=10)
    assert _edges(found) == _matrix_edges(stars, 3, least_sim)


def test_blocks_without_enough_common_users_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(products, "BLOCK", 8)
    stars = np.zeros((40, 64))
    for u in range(40):  # eight users a block of items, two of them in the next block too
        block = u % 8
        stars[u, block * 8 : block * 8 + 8] = np.random.RandomState(u).randint(1, 6, 8)
        if u < 16:
            stars[u, (block * 8 + 8) % 64 : (block * 8 + 8) % 64 + 8] = 1 + u % 5
    # Codes go by raters, so that blocks hold the items above: all items have as many.
    before = len(tables_written(spark))
    found = collaborative.item_similarity(_matrix_frame(spark, stars), 3, 0.3, heavy_user=4)
    assert _edges(found) == _matrix_edges(stars, 3, 0.3)
    made = [path for path in tables_written(spark)[before:] if "/block-pairs-" in path]
    assert spark.read.parquet(made[0]).count() == 8  # of 36


@pytest.mark.parametrize("repeats", [False, True])
def test_pairs_of_ratings_are_added_up_where_they_meet(spark, monkeypatch, repeats):
    draw = random.Random(4)
    rows = [(u, draw.randint(0, 25), float(draw.randint(1, 5))) for u in range(40) for _ in range(9)]
    rows += [(None, 1, 2.0), (None, 2, 3.0), (1, None, 4.0)]
    ratings = spark.createDataFrame(rows, "user_id int, business_id int, stars double")
    if not repeats:
        ratings = pearson.latest_ratings(ratings, None)
    expected = {}
    kept = [r for r in ratings.collect() if r.user_id is not None and r.business_id is not None]
    for x in kept:
        for y in kept:
            if x.user_id == y.user_id and x.business_id < y.business_id:
                terms = (1, x.stars, y.stars, x.stars**2, y.stars**2, x.stars * y.stars)
                known = expected.get((x.business_id, y.business_id), (0,) * 6)
                expected[x.business_id, y.business_id] = tuple(a + b for a, b in zip(known, terms))
    expected = {pair: sums for pair, sums in expected.items() if sums[0] >= 2}
    moments = pearson.pair_moments(ratings, 2)
    plan = moments._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(b1" in plan.replace("#", " ") and not re.search(r"hashpartitioning\(b1#\d+, b2#", plan)
    assert {(r.b1, r.b2): tuple(r[2:]) for r in moments.collect()} == expected
    monkeypatch.setattr(pearson, "FIRST_PAIRS", 100)
    monkeypatch.setattr(pearson, "TASK_PAIRS", 50)
    assert {(r.b1, r.b2): tuple(r[2:]) for r in pearson.pair_moments(ratings, 2).collect()} == expected


def test_profiles_meet_pairs_without_moving_with_them(spark, monkeypatch):
    """Neither a profile nor its words are shuffled a pair or a visit; many words take the joins."""
    businesses = spark.createDataFrame(
        [("a", ["x", "y", None]), ("b", []), ("c", None), ("d", ["z"])], "business_id string, profile array<string>"
    )
    users = spark.createDataFrame([("u", ["y", None]), ("v", []), ("w", ["z", "x"])], "user_id string, profile array<string>")
    asked = [(u, b) for u in ("u", "v", "w", "none", None) for b in ("a", "b", "c", "d", "none", None)]
    pairs = spark.createDataFrame(asked * 2, "user_id string, business_id string")
    reviews = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "d"), ("w", "b"), (None, "a")], "user_id string, business_id string")
    terms = spark.createDataFrame([("a", "x"), ("a", "y"), ("d", "x")], "business_id string, word string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = []
        for most in (100, 0):
            monkeypatch.setattr(profiles, "SENT_WORDS", most)
            scores = [profiles.profile_scores(pairs, businesses, users, least) for least in (0.01, 0.0)]
            words = profiles.user_words(reviews, terms)
            seen.append([Counter(tuple(r) for r in df.collect()) for df in (*scores, words)])
            if most:
                plan = words._jdf.queryExecution().executedPlan().toString()
                assert not re.search(r"hashpartitioning\([^)]*word", plan)
                plan = scores[0]._jdf.queryExecution().optimizedPlan().toString()
                assert "strategy=broadcast" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen[0] == seen[1]
    assert seen[0][0] == {("u", "a", 2 / 3): 2, ("w", "a", 1 / 4): 2, ("w", "d", 1 / 2): 2}
    assert sum(seen[0][1].values()) == 40
    assert seen[0][2] == {("u", "x"): 1, ("u", "y"): 1, (None, "x"): 1, (None, "y"): 1}


def test_lists_of_a_user_travel_in_the_narrowest_exact_types(spark):
    cells = "user bigint, item bigint, s double"
    kinds = []
    for item, stars in ((5, 4.0), (2**33, 4.5), (70_000, 0.1), (5, 300.0), (5, float("nan"))):
        rows = [(u, item + i, None if u == 1 and i == 1 else stars) for u in range(3) for i in range(3)]
        frame = spark.createDataFrame(rows, cells)
        lists, _, _ = pearson._by_first(frame, ["s"])
        types = dict(lists.dtypes)
        kinds.append((types["b1"], types["s"]))
        moments = pearson._met_moments(frame, spark.createDataFrame([], "user bigint, cells int"), True)
        assert moments.dtypes[0] == ("b1", "bigint")
        # One exchange by user and one by the first item.
        assert moments._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
        found = {(r.b1, r.b2): r for r in moments.collect()}
        assert set(found) == {(item + i, item + j) for i, j in combinations(range(3), 2)}
        for r in found.values():
            assert r.n == 3 and (r.s1 == pytest.approx((2 if r.b1 == item + 1 else 3) * stars, nan_ok=True))
    assert kinds == [("tinyint", "array<tinyint>"), ("bigint", "array<float>"), ("int", "array<double>"), ("tinyint", "array<float>"), ("tinyint", "array<float>")]


def test_large_tables_are_grouped_in_more_tasks(spark, monkeypatch):
    rows = [(f"u{u}", f"b{(u * 7 + k * k) % 23}", float(1 + (u + k) % 5), u % 3) for u in range(60) for k in range(8)]
    ratings = spark.createDataFrame(rows, RATING)
    expected = sorted(collaborative.item_similarity(ratings, 2, 0.1).collect())
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    before = set(tables_written(spark))
    assert sorted(collaborative.item_similarity(ratings, 2, 0.1).collect()) == expected and expected
    new = [path for path in tables_written(spark) if path not in before]
    for label in ("ratings-", "all-cells-", "user-lists-"):
        path = next(p for p in new if p.rsplit("/", 1)[1].startswith(label))
        # Only partitions that hold rows leave a file; the session has 4.
        assert len(spark.read.parquet(path).inputFiles()) > 4, label
    assert skew.tasks_for(spark, 80) is None and skew.tasks_for(spark, 81) == 5


def test_predictions_group_the_ratings_once(spark, monkeypatch):
    """Similarity and prediction read one table of latest ratings instead of forming one each."""
    rows = [(u, b, float(1 + (u * b) % 5), ts) for u in range(12) for b in range(9) for ts in range(1 + (u + b) % 2)]
    raw = spark.createDataFrame(rows, "user_id int, business_id int, stars double, ts int")
    pairs = raw.select("user_id", "business_id")
    edges = collaborative.item_similarity(raw, 3, -2.0)
    expected = sorted(map(tuple, collaborative.predict_ratings(pairs, edges, raw).collect()))
    latest = storage.written(pearson.latest_ratings(raw), "latest")
    monkeypatch.setattr(pearson, "latest_ratings", None)
    again = collaborative.item_similarity(latest, 3, -2.0, deduped=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, edges.collect()))
    assert sorted(map(tuple, collaborative.predict_ratings(pairs, again, latest, deduped=True).collect())) == expected
