import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import neighbours, pearson, skew
from tallyweave.plans import collaborative, rating_model
from tallyweave.sources.model_tables import read_clustered, write_clustered

RATING = "user_id string, business_id string, stars double, ts int"


def _rows(seed, users=25, items=12, count=260, heavy=3):
    draw = random.Random(seed)
    rows = [
        (f"u{draw.randrange(users):02}", f"b{draw.randrange(items):02}", draw.randint(1, 10) / 2, draw.randrange(40))
        for _ in range(count)
    ]
    rows += [(f"h{u}", f"b{b:02}", draw.randint(1, 10) / 2, draw.randrange(40)) for u in range(heavy) for b in range(items)]
    draw.shuffle(rows)
    return rows


def _edges(df):
    return {(r.b1, r.b2): (round(r.sim, 9), r.num_co_rated) for r in df.collect()}


def _table(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("heavy_user", [3, 8, 2000])
def test_refreshed_equals_built_at_once(spark, heavy_user):
    rows = _rows(heavy_user)
    cuts = [0, 150, 151, len(rows)]
    model = None
    for low, high in zip(cuts, cuts[1:]):
        batch = spark.createDataFrame(rows[low:high], RATING)
        model = rating_model.refresh(model, batch, buckets=4) if model else rating_model.build(batch, heavy_user=heavy_user, buckets=4)
    everything = spark.createDataFrame(rows, RATING)
    once = rating_model.build(everything, heavy_user=heavy_user, buckets=4)
    assert _table(model.cells) == _table(once.cells)
    assert _table(model.moments) == _table(once.moments)
    for least_sim in (0.3, -2.0):
        expected = _edges(collaborative.item_similarity(everything, 3, least_sim))
        assert _edges(rating_model.edges(model, 3, least_sim)) == expected
        assert expected


def test_a_repeated_or_older_batch_changes_nothing(spark):
    rows = _rows(1)
    model = rating_model.build(spark.createDataFrame(rows, RATING), heavy_user=8, buckets=4)
    older = [(u, b, 5.0 if s < 5 else 1.0, -1) for u, b, s, _ in rows[:40]]
    for batch in (rows[:50], older, []):
        again = rating_model.refresh(model, spark.createDataFrame(batch, RATING), buckets=4)
        assert _table(again.cells) == _table(model.cells)
        assert _table(again.moments) == _table(model.moments)


def test_null_ids_stars_and_dates(spark):
    rows = [(u, b, s, ts) for u in ("u", "v", None) for b, s, ts in (("a", 1.0, 1), ("b", None, 2), ("c", 3.0, None), (None, 2.0, 3))]
    more = [("u", "b", 4.0, 3), ("u", "a", None, 5), (None, "a", 2.0, 7), ("w", None, 1.0, 1), ("v", "d", 2.0, None)]
    model = rating_model.build(spark.createDataFrame(rows, RATING), buckets=2)
    model = rating_model.refresh(model, spark.createDataFrame(more, RATING), buckets=2)
    once = rating_model.build(spark.createDataFrame(rows + more, RATING), buckets=2)
    assert _table(model.cells) == _table(once.cells)
    assert _table(model.moments) == _table(once.moments)


def test_only_pairs_with_a_changed_rating_are_formed(spark, monkeypatch):
    """One new rating of a user with 100 of them is 100 changed pairs, whatever the others rated."""
    rows = [(f"u{u}", f"b{b:03}", float(1 + (u + b) % 5), 0) for u in range(20) for b in range(100)]
    model = rating_model.build(spark.createDataFrame(rows, RATING), buckets=2)
    sizes = []
    kept = rating_model.written

    def counting(df, label):
        table = kept(df, label)
        if label == "moment-changes":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(rating_model, "written", counting)
    rating_model.refresh(model, spark.createDataFrame([("u7", "new", 3.0, 1)], RATING), buckets=2)
    assert sizes == [100]


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_move_to_the_model(spark, no_broadcast):
    model = rating_model.build(spark.createDataFrame(_rows(2), RATING), buckets=4)
    changes = spark.createDataFrame([("b00", "b01", 1.0)], "b1 string, b2 string, d double")
    joined = model.moments.join(changes, ["b1", "b2"], "full")
    assert _plan(joined).count("Exchange") == 1


def test_clustered_tables(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"it's {i}", [i]) for i in range(60)]
    frame = spark.createDataFrame(rows, "k int, text string, list array<int>")
    path = str(tmp_path / "a model's table")
    made = write_clustered(frame, path, ["k"], 3)
    back = read_clustered(spark, path)
    assert _table(made) == _table(back) == _table(frame)
    counted = back.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in _plan(counted)
    empty = write_clustered(frame.where("false"), str(tmp_path / "none"), ["k"], 3)
    assert empty.count() == 0 and read_clustered(spark, str(tmp_path / "none")).columns == frame.columns


def test_lists_stay_where_they_are(spark, no_broadcast, tmp_path):
    ratings = spark.createDataFrame(_rows(4), RATING)
    found = collaborative.item_similarity(ratings, 3, -2.0)
    model = rating_model.save_neighbours(found, str(tmp_path / "lists"), 4)
    model = rating_model.load_neighbours(spark, str(tmp_path / "lists"))
    latest = pearson.latest_ratings(ratings)
    pairs = ratings.select("user_id", "business_id")
    predicted = model.predict(pairs, latest)
    assert _table(predicted) == _table(neighbours.predict(pairs, found, latest))
    for lists in (model.by_target, model.by_pair):
        name = next(line for line in _plan(lists).splitlines() if "FileScan" in line).split("tallyweave_")[1][:32]
        lines = _plan(predicted).splitlines()
        places = [i for i, line in enumerate(lines) if name in line and "FileScan" in line]
        assert places
        for place in places:
            # Up from the scan to the join or aggregate that reads it.
            above = []
            depth = lines[place].index("FileScan")
            for line in reversed(lines[:place]):
                at = len(line) - len(line.lstrip(" :+-"))
                if at < depth:
                    above.append(line)
                    depth = at
                    if "Join" in line or "Aggregate" in line:
                        break
            assert not any("Exchange" in line for line in above)


def test_a_hot_key_moves_alone(spark, no_broadcast, tmp_path):
    left = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k int, a int")
    right = spark.createDataFrame([(i, i * 7) for i in range(300)], "k int, b int")
    stored = write_clustered(right, str(tmp_path / "right"), ["k"], 4)
    joined = skew.spread_join(left, stored, ["k"], cell_rows=20)
    assert _table(joined.select("k", "a", "b")) == _table(left.join(right, "k").select("k", "a", "b"))


@pytest.mark.parametrize("first_pairs", [5, 10**6])
@pytest.mark.parametrize("buckets", [None, 3])
def test_moments_never_move(spark, no_broadcast, monkeypatch, tmp_path, first_pairs, buckets):
    """Pairs are added up where the stored moments of their first item lie, so a table has one file a bucket."""
    monkeypatch.setattr(pearson, "FIRST_PAIRS", first_pairs)
    rows = [(int(u[1:]) if u[0] == "u" else 100 + int(u[1:]), int(b[1:]), s, ts) for u, b, s, ts in _rows(6, items=40)]
    frame = spark.createDataFrame(rows, "user_id bigint, business_id bigint, stars double, ts int")
    first, last = (spark.createDataFrame(part, frame.schema) for part in (rows[:170], rows[170:]))
    rating_model.build(first, str(tmp_path / "first"), buckets=4)
    model = rating_model.load(spark, str(tmp_path / "first"))
    model = rating_model.refresh(model, last, str(tmp_path / "second"), buckets=buckets)
    once = rating_model.build(frame, buckets=4)
    assert _table(model.cells) == _table(once.cells) and _table(model.moments) == _table(once.moments)
    assert model.buckets == (buckets or 4)
    for name in ("first", "second"):
        assert len(list((tmp_path / name / "moments-2000" / "rows").glob("part-*"))) <= 4
    assert "Exchange" not in _plan(model.moments.groupBy("b1", "b2").count())
