from tallyweave.functions.hashing import fixed_family
from tallyweave.operators import dictionary, minhash


def _words(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def _index(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_old_numbers_stay_and_new_ones_follow(spark, tmp_path):
    path = str(tmp_path / "words")
    known = _index(dictionary.start(_words(spark, ["m", "c", None, "m", "x", ""]), "word", path, buckets=3))
    assert known == {"": 0, "c": 1, "m": 2, "x": 3}
    batches = [["b", "x", "a", "b", None], [], ["x", "m"], ["z", "aa"]]
    for batch in batches:
        grown = _index(dictionary.extend(_words(spark, batch), path))
        fresh = sorted(set(batch) - {None} - known.keys())
        assert grown == known | {w: len(known) + i for i, w in enumerate(fresh)}
        known = grown
    assert _index(dictionary.load(spark, path)) == known
    assert sorted(known.values()) == list(range(len(known)))


def test_an_index_that_starts_empty(spark, tmp_path):
    path = str(tmp_path / "words")
    assert dictionary.start(_words(spark, [None]), "word", path, buckets=2).count() == 0
    assert _index(dictionary.extend(_words(spark, ["b", "a"]), path)) == {"a": 0, "b": 1}


def test_a_batch_added_twice(spark, tmp_path):
    path = str(tmp_path / "words")
    dictionary.start(_words(spark, ["a"]), "word", path, buckets=2)
    once = _index(dictionary.extend(_words(spark, ["c", "b"]), path))
    assert _index(dictionary.extend(_words(spark, ["c", "b"]), path)) == once


def test_the_index_stays_in_place(spark, tmp_path):
    path = str(tmp_path / "words")
    dictionary.start(_words(spark, [f"w{i}" for i in range(100)]), "word", path, buckets=4)
    index = dictionary.extend(_words(spark, [f"v{i}" for i in range(100)]), path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = _words(spark, ["w1", "v1", "no"]).join(index, "word")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        assert joined._jdf.queryExecution().explainString(mode).count("Exchange") == 1
        assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_signatures_by_a_grown_index_stay(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = [(u, f"b{(u * 7 + i * i) % 30:02}") for u in range(10) for i in range(6)]
    pairs = spark.createDataFrame(rows, "user_id int, business_id string")
    family = fixed_family(1009)  # a modulus that does not follow the index

    def signed(index):
        sets, _ = minhash.indexed_sets(pairs, index=index)
        return {r.user: tuple(r.signature) for r in minhash.signatures(sets, family, 20).collect()}

    first = signed(dictionary.start(pairs, "business_id", path, buckets=2))
    more = spark.createDataFrame([("a",), ("b29x",)], "business_id string")
    assert signed(dictionary.extend(more, path)) == first
