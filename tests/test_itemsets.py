import random
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tallyweave.operators import baskets as bk
from tallyweave.operators import itemsets
from tallyweave.plans.itemset_report import itemset_report
from tallyweave.storage import tables_written


def _baskets(seed, n=60, items=12, heavy=0):
    draw = random.Random(seed)
    made = {b: {str(draw.randint(1, items)) for _ in range(draw.randint(1, 6))} for b in range(n)}
    for b in range(heavy):
        made[n + b] = {str(i) for i in range(1, items + 1)}
    return made


def _frame(spark, made):
    return spark.createDataFrame([(b, i) for b, s in made.items() for i in s], "basket int, item string")


def _brute(made, need):
    counts = {}
    for basket in made.values():
        for size in range(1, len(basket) + 1):
            for subset in combinations(sorted(basket), size):
                counts[subset] = counts.get(subset, 0) + 1
    return {items: n for items, n in counts.items() if n >= need}


def _found(df):
    return {tuple(r["items"]): r["support"] for r in df.collect()}


@pytest.mark.parametrize("seed, heavy, buckets", [(1, 0, None), (2, 0, 64), (3, 3, None), (4, 6, 16)])
def test_mining_equals_brute_force(spark, seed, heavy, buckets):
    made = _baskets(seed, heavy=heavy)
    # A low heavy limit puts baskets aside and joins the rest of them in cells.
    found = itemsets.frequent_itemsets(_frame(spark, made), 5, buckets=buckets, heavy_basket=5)
    assert _found(found) == _brute(made, 5)


def test_mining_equals_fpgrowth(spark):
    frame = _frame(spark, _baskets(9, n=80))
    arrays = frame.groupBy("basket").agg(F.collect_set("item").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(6 - 0.5) / 80).fit(arrays)
    expected = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}
    assert _found(itemsets.frequent_itemsets(frame, 6)) == expected


@pytest.mark.parametrize("shards, buckets", [(1, None), (3, None), (3, 32)])
def test_shards(spark, shards, buckets):
    made, support = _baskets(5, n=25), 4
    frame = _frame(spark, made).withColumn("shard", F.col("basket") % shards)
    expected = set()
    for shard in range(shards):
        part = {b: s for b, s in made.items() if b % shards == shard}
        need = max(1, -(-support * len(part) // len(made)))
        expected |= set(_brute(part, need))
    found = itemsets.sharded_candidates(frame, support, buckets=buckets)
    rows = found.collect()
    assert {tuple(r["items"]) for r in rows} == expected and len(rows) == len(expected)
    report = itemset_report(frame, support, with_buckets=buckets is not None)
    assert _found(report.frequent) == _brute(made, support)
    assert report.size_counts.agg(F.sum("itemsets")).first()[0] == len(expected)


def test_local_threshold_is_exact(spark):
    # 25 * 7 / 25 is 7 in integers but above 7 in floating point: a local count of 7 is enough.
    rows = [(b, "x") for b in range(25)]
    frame = spark.createDataFrame(rows, "basket int, item string").withColumn("shard", (F.col("basket") >= 7).cast("int"))
    needs = {r.shard: r.need for r in itemsets.shard_needs(frame, 25).collect()}
    assert needs == {0: 7, 1: 18}


def test_support_equality_and_max_size(spark):
    made = {1: {"a", "b"}, 2: {"a", "b"}, 3: {"a", "c"}}
    assert _found(itemsets.frequent_itemsets(_frame(spark, made), 2)) == {("a",): 3, ("b",): 2, ("a", "b"): 2}
    assert _found(itemsets.frequent_itemsets(_frame(spark, made), 2, max_size=1)) == {("a",): 3, ("b",): 2}


def test_no_baskets(spark):
    empty = spark.createDataFrame([], "basket int, item string")
    report = itemset_report(empty, 3)
    assert report.candidates.count() == report.frequent.count() == report.size_counts.count() == 0


def test_basket_size_is_strict(spark):
    rows = [("u", "1"), ("u", "2"), ("u", "2"), ("v", "1"), ("v", "2"), ("v", "3")]
    frame = spark.createDataFrame(rows, "user_id string, business_id string")
    assert {r.basket for r in bk.user_baskets(frame, 2).collect()} == {"v"}


def test_year_baskets(spark):
    rows = [(2016, "u1", "b1", 3), (2016, "u1", "b1", 5), (2016, "u1", "b2", 2), (2015, "u1", "b3", 5)]
    frame = spark.createDataFrame(rows, "year int, user_id string, business_id string, rating int")
    assert {tuple(r) for r in bk.year_baskets(frame, 2016).collect()} == {("u1", "b1"), ("u1", "b2")}
    assert {tuple(r) for r in bk.year_baskets(frame, 2016, 2, 2).collect()} == {("b1", "u1")}


def test_report_files(spark, tmp_path):
    itemset_report(_frame(spark, _baskets(6)), 6, shards=2).write(str(tmp_path / "out"))
    sizes = spark.read.json(str(tmp_path / "out" / "num_candidates_by_size"))
    assert sizes.agg(F.sum("itemsets")).first()[0] == spark.read.json(str(tmp_path / "out" / "candidates")).count()


def test_report_files_in_numeric_order(spark, tmp_path):
    made = {b: {"9", "10", "100"} for b in range(3)}
    itemset_report(_frame(spark, made), 3, shards=1).write(str(tmp_path / "out"), numeric_items=True)
    frequent = [r["items"] for r in spark.read.json(str(tmp_path / "out" / "frequent_itemsets")).collect()]
    assert ["9", "10", "100"] in frequent and ["9", "10"] in frequent
    candidates = [r["items"] for r in spark.read.json(str(tmp_path / "out" / "candidates")).where("size = 2").collect()]
    # Items are text inside a candidate, candidates are ordered by them as numbers.
    assert candidates == [["10", "9"], ["10", "100"], ["100", "9"]]


@pytest.mark.parametrize("support", [1, 4, 9])
def test_any_candidate_list_is_counted(spark, support):
    made = _baskets(6, n=80)
    brute = _brute(made, support)
    wanted = [("1", "2"), ("9", "3"), ("4", "5", "6"), ("7",), ("1", "11", "12", "2"), ("99", "1"), ("1", "2")]
    listed = spark.createDataFrame([(len(w), list(w)) for w in wanted], "size int, items array<string>")
    found = itemsets.count_candidates(_frame(spark, made), listed, support)
    expected = {tuple(sorted(w)): brute[tuple(sorted(w))] for w in wanted if tuple(sorted(w)) in brute}
    assert _found(found) == expected


def test_all_buckets_frequent_or_none(spark):
    made = _baskets(7)
    for buckets in (1, 31, 32, 33, 10_000):
        assert _found(itemsets.frequent_itemsets(_frame(spark, made), 5, buckets=buckets)) == _brute(made, 5)


@pytest.mark.parametrize("words, dense", [(1, 1.0), (4, 0.0)])
def test_bitmap_rows_of_any_width(spark, monkeypatch, words, dense):
    """Several ranges and cells, and baskets far from filling the last range."""
    monkeypatch.setattr(itemsets, "WORDS", words)
    monkeypatch.setattr(itemsets, "DENSE", dense)
    monkeypatch.setattr(itemsets, "CELL_ROWS", 2)
    made = _baskets(21, n=700, items=7, heavy=40)
    expected = {items: n for items, n in _brute(made, 30).items() if len(items) < 5}
    assert _found(itemsets.frequent_itemsets(_frame(spark, made), 30, max_size=4)) == expected
    given = spark.createDataFrame([(list(items),) for items in expected] + [(["1", "x"],), (["9", "1", "1"],)], "items array<string>")
    counted = _found(itemsets.count_candidates(_frame(spark, made), given, 30))
    assert counted == expected


def test_a_level_costs_words(spark, monkeypatch):
    """Baskets that all hold the same items: rows of the levels do not follow the number of baskets."""
    monkeypatch.setattr(itemsets, "DENSE", 0.0)
    before = len(tables_written(spark))
    frame = spark.range(3000).select(F.col("id").cast("int").alias("basket"), F.explode(F.array(*map(F.lit, "abcde"))).alias("item"))
    found = _found(itemsets.frequent_itemsets(frame, 3000))
    assert len(found) == 31 and set(found.values()) == {3000}
    made = [path for path in tables_written(spark)[before:] if "/bitmaps-" in path]
    rows = [spark.read.parquet(path).count() for path in made]
    assert len(made) == 4 and max(rows) <= 10 * (3000 // (64 * itemsets.WORDS) + 1 + 8)


@pytest.mark.parametrize("buckets, formed", [(itemsets.PAIR_BUCKETS, 1), (3, 2)])
def test_pairs_are_formed_once_where_no_bucket_is_shared(spark, monkeypatch, buckets, formed):
    calls = []
    counted = itemsets._counted
    monkeypatch.setattr(itemsets, "_counted", lambda *args: calls.append(1) or counted(*args))
    made = _baskets(6, n=80, heavy=4)
    found = itemsets.frequent_itemsets(_frame(spark, made), 6, buckets=buckets, heavy_basket=5)
    assert _found(found) == _brute(made, 6)
    assert 1 + len(calls) == formed


@pytest.mark.parametrize("fold, dense, words", [(3, 1.0, 1), (3, 0.0, 2)])
def test_folded_and_larger_baskets_add_up(spark, monkeypatch, fold, dense, words):
    """Equal baskets of several weights, small ones as tails or planes of bit maps, others unfolded."""
    monkeypatch.setattr(itemsets, "FOLD_ITEMS", fold)
    monkeypatch.setattr(itemsets, "DENSE", dense)
    monkeypatch.setattr(itemsets, "WORDS", words)
    made = dict(enumerate([basket for basket in _baskets(8, n=40).values() for _ in range(1 + len(basket))]))
    assert _found(itemsets.frequent_itemsets(_frame(spark, made), 9)) == _brute(made, 9)
    listed = spark.createDataFrame([(list(items),) for items in _brute(made, 4)], "items array<string>")
    assert _found(itemsets.count_candidates(_frame(spark, made), listed, 9)) == _brute(made, 9)


def test_levels_do_not_follow_equal_baskets(spark):
    def mined(times):
        before = len(tables_written(spark))
        made = dict(enumerate(list(_baskets(3, n=50, items=40).values()) * times))
        found = _found(itemsets.frequent_itemsets(_frame(spark, made), 2 * times))
        tables = [path for path in tables_written(spark)[before:] if "/bitmaps-" in path or "/tails-" in path]
        return found, [spark.read.parquet(path).count() for path in tables]

    (once, rows), (often, rows_often) = mined(1), mined(200)
    assert often == {items: 200 * n for items, n in once.items()} and max(map(len, once)) > 2
    assert rows and rows_often == rows
