import json

import pytest

from tallyweave import storage
from tallyweave.functions.text import strip_edges, words, words_without_marks
from tallyweave.operators import exploration, layout
from tallyweave.plans.review_report import review_report
from tallyweave.sources import readers, writers
from pyspark.sql import functions as F


def _reviews(spark, rows):
    return spark.createDataFrame(rows, "business_id string, stars double, date string, text string")


def _stop(spark, *stopwords):
    return spark.createDataFrame([(w,) for w in stopwords], "word string")


@pytest.mark.parametrize(
    "text, expected",
    [("((it)a.b;.", ["it)a.b"]), ("Hello, World!  (x)", ["hello", "world", "x"]), ("a b c\x1fd", list("abcd")), ("...", [])],
)
def test_edge_cleaning(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "text string").select(F.explode(words(F.col("text"))).alias("w"))
    assert [r.w for r in frame.select(strip_edges(F.col("w")).alias("w")).where("w <> ''").collect()] == expected


def test_mark_deletion(spark):
    frame = spark.createDataFrame([("don't 3x -- A.B",)], "text string")
    cleaned = frame.select(F.explode(words_without_marks(F.col("text"))).alias("w")).where("w <> ''")
    assert [r.w for r in cleaned.collect()] == ["dont", "x", "ab"]


def test_month_tie_takes_the_later_month(spark):
    reviews = _reviews(spark, [("b", 1.0, f"2015-{m}-01", "x") for m in ("03", "07", "03", "07", "12")])
    assert [tuple(r) for r in exploration.top_months(reviews, 2).collect()] == [("07", 2), ("03", 2)]


def test_word_tie_is_alphabetical_and_length_is_strict(spark):
    reviews = _reviews(spark, [("b", 1.0, "2016-01-01", "pear apple abc pear apple abc abc")])
    top = exploration.top_words(reviews, 2015, _stop(spark), longer_than=3, n=2)
    assert [tuple(r) for r in top.collect()] == [("apple", 2), ("pear", 2)]


def test_month_without_words_is_kept(spark):
    reviews = _reviews(
        spark, [("b", 1.0, "2015-02-01", "the THE ..."), ("b", 1.0, "2016-05-01", "good"), ("b", 1.0, "2014-06-01", "old")]
    )
    stop = _stop(spark, "the")
    assert [tuple(r) for r in exploration.words_per_month(reviews, 2015, stop).collect()] == [("02", 0), ("05", 1)]
    assert exploration.average_review_length(reviews, 2015, stop).first()[0] == 0.5


def test_empty_reviews_give_nulls_not_errors(spark):
    reviews = _reviews(spark, [])
    stop = _stop(spark, "the")
    assert exploration.average_stars(reviews).first()[0] is None
    assert exploration.average_review_length(reviews, 2015, stop).first()[0] is None
    assert exploration.top_words(reviews, 2015, stop).count() == 0


def test_states_skip_null_and_blank_and_multiply_duplicates(spark):
    reviews = _reviews(spark, [(b, 1.0, "2015-01-01", "x") for b in "aabcde"])
    states = [("a", "None"), ("a", "None"), ("b", None), ("c", ""), ("d", "  "), ("e", " PA")]
    businesses = spark.createDataFrame(states, "business_id string, state string")
    assert [tuple(r) for r in exploration.top_states(reviews, businesses, 5).collect()] == [("None", 4), (" PA", 1)]


def test_year_threshold_is_strict(spark):
    reviews = _reviews(spark, [("b", 1.0, f"{y}-01-01", "x") for y in (2015, 2015, 2016, 2016, 2016)])
    assert [tuple(r) for r in exploration.years_over(reviews, 2).collect()] == [("2016", 3)]
    assert exploration.count_other_years(reviews, 2015).first()[0] == 3


def test_year_layout_profile_equals_the_real_layout(spark):
    reviews = _reviews(spark, [("b", 1.0, f"{1990 + i % 7}-01-01", "x") for i in range(50)])
    counted = {tuple(r) for r in layout.year_partition_profile(reviews, 5).collect()}
    moved = {tuple(r) for r in layout.partition_profile(layout.lay_out_by_year(reviews, 5)).collect()}
    assert counted == moved and len(counted) == 5


def test_default_profile_counts_every_row_and_empty_partitions(spark):
    profile = layout.partition_profile(spark.range(10).repartition(16))
    assert profile.count() == 16 and profile.agg(F.sum("items")).first()[0] == 10


def test_reviews_without_a_year_are_kept(spark):
    reviews = _reviews(spark, [("b", 1.0, d, "x") for d in ("2016-01-01", None, "soon", "2017-01-01", "2018-05-05")])
    for profile in (layout.year_partition_profile(reviews, 3), layout.keyed_partition_profile(reviews, 3)):
        assert {tuple(r) for r in profile.collect()} == {(0, 3), (1, 1), (2, 1)}


def test_profile_of_a_shuffled_frame_is_that_of_the_frame(spark):
    wide = spark.range(20_000).select(F.col("id"), *[F.sha2((F.col("id") + i).cast("string"), 256).alias(f"c{i}") for i in range(6)])
    frame = wide.groupBy("id").agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(6)])
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        real = frame.rdd.glom().map(len).collect()
        assert [r.items for r in layout.partition_profile(frame).orderBy("partition").collect()] == real
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_local_folders_are_for_local_sessions_only(monkeypatch):
    class Session:
        def __init__(self, master):
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
            self.sparkContext = type(
                "Context",
                (),
                {
                    "master": master,
                    "applicationId": f"test-{master}",
                    "getConf": staticmethod(lambda: {}),
                    "getCheckpointDir": staticmethod(lambda: None),
                },
            )

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            storage.shared_folder(Session(master))
    for master in ("local", "local[4]", "local[*]"):
        assert storage.shared_folder(Session(master))


def test_report_file(spark, tmp_path):
    reviews = _reviews(
        spark, [("b", 4.0, "2015-03-01", "nice place"), ("b", 5.0, "2015-07-02", "nice food"), ("c", 3.0, "2014-07-02", "old")]
    )
    writers.write_review_report(review_report(reviews, _stop(spark), 2015, 3, 5, 2), str(tmp_path / "report"))
    lines = spark.read.text(str(tmp_path / "report")).collect()
    assert json.loads(lines[0][0]) == {
        "A": 4.0, "B": 1, "C": [["07", 2], ["03", 1]], "D": [["03", 2], ["07", 2]], "E": 2.0, "F": ["nice", "food"]
    }


def test_stopword_loaders(spark, tmp_path):
    (tmp_path / "stop").write_text("The\n\u00a0of \ndon't\nof\n")
    path = str(tmp_path / "stop")
    assert {r.word for r in readers.read_stopwords(spark, path, True).collect()} == {"the", "of", "don't"}
    assert {r.word for r in readers.read_stopwords(spark, path, False).collect()} == {"The", "\u00a0of ", "of", "don't"}


def test_json_readers_tolerate_bad_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"user_id": "u", "stars": 4, "date": "2015-01-01"}\nnot json\n')
    reviews = readers.read_reviews(spark, str(tmp_path / "r.json"))
    assert exploration.average_stars(reviews).first()[0] == 4.0


def test_csv_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("y,u,b,r\n2016,1,10,3\n2015,2,11,5\n")
    rows = readers.read_year_baskets(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [(2016, "1", "10", 3), (2015, "2", "11", 5)]
    (tmp_path / "b.csv").write_text("user_id,business_id\nu1,b1  \n  u2,b2\n")
    rows = readers.read_user_business(spark, str(tmp_path / "b.csv")).collect()
    assert [tuple(r) for r in rows] == [("u1", "b1"), ("u2", "b2")]


def test_state_and_partition_files(spark, tmp_path):
    states = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "state string, reviews bigint")
    writers.write_top_states(states, str(tmp_path / "states"))
    assert json.loads(spark.read.text(str(tmp_path / "states")).first()[0]) == {"result": [["c", 9], ["a", 2], ["b", 2]]}
    reviews = _reviews(spark, [("b", 1.0, f"{y}-01-01", "x") for y in (2015, 2016, 2016, 2018)])
    profile = layout.year_partition_profile(reviews, 3)
    writers.write_partition_report(profile, exploration.years_over(reviews, 0), str(tmp_path / "parts"))
    assert json.loads(spark.read.text(str(tmp_path / "parts")).first()[0]) == {
        "n_partitions": 3, "n_items": [2, 0, 2], "result": [["2015", 1], ["2016", 2], ["2018", 1]]
    }


def test_bad_lines_are_set_apart(spark, tmp_path):
    good = [
        '{"review_id": "1", "user_id": "u", "stars": 4, "date": "2015-01-01"}',
        '  {"review_id": "2", "other": [1, {"a": 2}]}',
        "{}",
        '{"review_id": null, "stars": 2.5}',
        '{"text": "' + "long " * 200_000 + '"}',
    ]
    bad = ["not json", '{"review_id": "3"', "[1, 2]", '"text"', "17", "null", '{"stars": "many"}', '{"review_id": "4"} x {', "[{}]", '{"stars": 1}{"stars": 2}', "{},{}", "{}]", "{},0] ", "{},{}] }", "{'stars': 1}"]
    (tmp_path / "r.json").write_text("\n".join([*good, "", " \t", *bad, bad[0]]) + "\n")
    path = str(tmp_path / "r.json")
    reviews = readers.read_reviews(spark, path, quarantine=str(tmp_path / "bad"))
    assert [(r.review_id, r.stars) for r in reviews.collect()] == [("1", 4.0), ("2", None), (None, None), (None, 2.5), (None, None)]
    assert reviews.columns == readers.read_reviews(spark, path).columns
    apart = readers.read_quarantine(spark, str(tmp_path / "bad")).collect()
    assert sorted(r.line for r in apart) == sorted([*bad, bad[0]])
    assert {r.file.rsplit("/", 1)[1] for r in apart} == {"r.json"}


@pytest.mark.parametrize("reader", [readers.read_businesses, readers.read_pairs, readers.read_item_edges])
def test_other_readers_set_bad_lines_apart(spark, tmp_path, reader):
    (tmp_path / "r.json").write_text('{"business_id": "b", "b1": "x"}\n{"business_id"\n')
    rows = reader(spark, str(tmp_path / "r.json"), quarantine=str(tmp_path / "bad"))
    assert rows.count() == 1
    assert readers.read_quarantine(spark, str(tmp_path / "bad")).first().line == '{"business_id"'


def test_a_file_without_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text("")
    assert readers.read_reviews(spark, str(tmp_path / "r.json"), quarantine=str(tmp_path / "bad")).count() == 0
    assert readers.read_quarantine(spark, str(tmp_path / "bad")).count() == 0
