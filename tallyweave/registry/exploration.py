"""Registered queries over reviews, businesses and partition layout."""

from pyspark.sql import functions as F

from tallyweave.functions.dates import month_text, year_text
from tallyweave.operators import exploration, layout
from tallyweave.plans.review_report import review_report
from tallyweave.registry import sql_views as sql
from tallyweave.sources import readers, stand_ins, writers
from tallyweave.storage import new_path

YEAR = 1997
LONGER_THAN = 3
STATES = 5
YEAR_THRESHOLD = 2250
LAYOUT_PARTITIONS = 4


def stopwords(spark):
    return spark.createDataFrame([(word,) for word in sql.STOPWORDS], "word string")


def avg_stars(spark, folder):
    return exploration.average_stars(stand_ins.reviews(spark, folder)).select(
        F.round("avg_stars", 6).alias("avg_stars")
    )


def count_year_not(spark, folder):
    return exploration.count_other_years(stand_ins.review_events(spark, folder), YEAR)


def top_months(spark, folder):
    return exploration.top_months(stand_ins.review_events(spark, folder))


def words_per_month(spark, folder):
    return exploration.words_per_month(stand_ins.reviews(spark, folder), YEAR, stopwords(spark))


def avg_review_length(spark, folder):
    lengths = exploration.average_review_length(stand_ins.reviews(spark, folder), YEAR, stopwords(spark))
    return lengths.select(F.round("avg_words", 6).alias("avg_words"))


def top_words(spark, folder):
    return exploration.top_words(stand_ins.reviews(spark, folder), YEAR, stopwords(spark), LONGER_THAN)


def exploration_report(spark, folder):
    report = review_report(stand_ins.reviews(spark, folder), stopwords(spark), YEAR, LONGER_THAN)
    return report.withColumn("value", F.round("value", 6))


def top_states(spark, folder):
    return exploration.top_states(
        stand_ins.review_events(spark, folder), stand_ins.businesses(spark, folder), STATES
    )


def year_counts_over(spark, folder):
    return exploration.years_over(stand_ins.review_events(spark, folder), YEAR_THRESHOLD)


def partition_profile_default(spark, folder):
    return layout.partition_profile(stand_ins.review_events(spark, folder))


def partition_profile_default_total(spark, folder):
    """What holds for any layout: no partition is negative and together they hold every row."""
    profile = layout.partition_profile(stand_ins.review_events(spark, folder))
    return profile.agg(F.sum("items").alias("items"), (F.min("items") >= 0).alias("counted"))


def partition_profile_keyed(spark, folder):
    """The partitions after every review was moved to that of its year."""
    return layout.keyed_partition_profile(stand_ins.review_events(spark, folder), LAYOUT_PARTITIONS)


def partition_profile_keyed_nulls(spark, folder):
    """As partition_profile_keyed where some reviews have no date."""
    events = stand_ins.review_events(spark, folder)
    dated = F.when(F.col("review_id") % 7 != 0, F.col("date"))
    return layout.keyed_partition_profile(events.withColumn("date", dated), LAYOUT_PARTITIONS)


def _lines(spark, path):
    """The JSON objects of a report file as text."""
    return spark.read.text(path)


def review_report_file(spark, folder):
    """The report written as one JSON object and its words and scalars read back."""
    path = new_path(spark, "review-report")
    writers.write_review_report(review_report(stand_ins.reviews(spark, folder), stopwords(spark), YEAR, LONGER_THAN), path)
    report = _lines(spark, path).select(
        F.from_json("value", "A double, B bigint, C array<array<string>>, D array<array<string>>, E double, F array<string>").alias("r")
    )
    return report.select(
        F.round("r.A", 6).alias("a"),
        F.col("r.B").alias("b"),
        F.round("r.E", 6).alias("e"),
        F.array_join(F.transform("r.C", lambda c: F.array_join(c, ":")), ",").alias("c"),
        F.array_join(F.transform("r.D", lambda d: F.array_join(d, ":")), ",").alias("d"),
        F.array_join("r.F", ",").alias("f"),
    )


def states_file(spark, folder):
    """The top states written as one JSON object and read back by place."""
    path = new_path(spark, "states")
    writers.write_top_states(top_states(spark, folder), path)
    rows = _lines(spark, path).select(F.from_json("value", "result array<array<string>>").alias("r"))
    rows = rows.select(F.posexplode("r.result").alias("place", "row"))
    return rows.select("place", F.col("row")[0].alias("state"), F.col("row")[1].cast("bigint").alias("reviews"))


def partition_file(spark, folder):
    """The keyed layout and the years over a count, written as one JSON object and read back."""
    path = new_path(spark, "partitions")
    writers.write_partition_report(partition_profile_keyed(spark, folder), year_counts_over(spark, folder), path)
    body = "n_partitions bigint, n_items array<bigint>, result array<array<string>>"
    rows = _lines(spark, path).select(F.from_json("value", body).alias("r"))
    return rows.select(
        F.col("r.n_partitions").alias("n_partitions"),
        F.array_join(F.transform("r.n_items", lambda n: n.cast("string")), ",").alias("n_items"),
        F.array_join(F.transform("r.result", lambda y: F.array_join(y, ":")), ",").alias("years"),
    )


def _stopword_file(spark, folder):
    """The states as a word list: blanks around them, mixed case, a word twice."""
    path = new_path(spark, "words")
    names = stand_ins.businesses(spark, folder).where(F.col("state").isNotNull())
    lines = F.concat(F.lit("\u00a0 "), F.col("state"), F.lit("\t"))
    names.select(lines.alias("value")).write.text(path)
    return path


def stopwords_normalised(spark, folder):
    return readers.read_stopwords(spark, _stopword_file(spark, folder), normalise=True)


def stopwords_verbatim(spark, folder):
    return readers.read_stopwords(spark, _stopword_file(spark, folder), normalise=False)


def review_json_scan(spark, folder):
    """Reviews written as JSON lines with text dates, read back and counted per year and month."""
    path = new_path(spark, "reviews-json")
    reviews = stand_ins.reviews(spark, folder)
    writers.write_json(reviews.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")), path)
    back = readers.read_reviews(spark, path)
    return back.groupBy(year_text(back).alias("year"), month_text(back).alias("month")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("stars").alias("stars"),
        F.sum(F.length("text")).alias("characters"),
        F.count_distinct("business_id").alias("businesses"),
    )


def business_json_scan(spark, folder):
    path = new_path(spark, "businesses-json")
    writers.write_json(stand_ins.businesses(spark, folder), path)
    return readers.read_businesses(spark, path).groupBy("state").agg(F.count(F.lit(1)).alias("businesses"))


def _review_lines_with_faults(spark, folder):
    """Reviews as JSON lines of which some are cut off, some no object and some hold a text for the stars."""
    path = new_path(spark, "reviews-with-faults")
    reviews = stand_ins.review_events(spark, folder).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    number, fault = F.col("review_id").cast("string"), F.col("review_id") % 11
    line = (
        F.when(fault == 0, F.concat(F.lit('{"review_id":"'), number, F.lit('","stars":')))
        .when(fault == 1, F.concat(F.lit('{"review_id":"'), number, F.lit('","stars":"many"}')))
        .when(fault == 2, F.concat(F.lit("["), number, F.lit("]")))
        .when(fault == 3, F.lit(" "))
        .otherwise(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("review_id", "business_id", "date")])))
    )
    reviews.select(line.alias("value")).write.text(path)
    return path


def review_json_quarantine(spark, folder):
    """Readable reviews by year, and every line that is not one."""
    bad = new_path(spark, "bad-reviews")
    reviews = readers.read_reviews(spark, _review_lines_with_faults(spark, folder), quarantine=bad)
    years = reviews.groupBy(year_text(reviews).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    lines = readers.read_quarantine(spark, bad).groupBy(F.col("line").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return years.select(F.lit("year").alias("kind"), "label", "n").unionByName(
        lines.select(F.lit("bad line").alias("kind"), "label", "n")
    )


def count_year_not_readable(spark, folder):
    """Reviews of another year among the readable ones; a bad line is of no year."""
    bad = new_path(spark, "bad-reviews")
    reviews = readers.read_reviews(spark, _review_lines_with_faults(spark, folder), quarantine=bad)
    return exploration.count_other_years(reviews, YEAR)


QUERIES = {
    "avg_stars": avg_stars,
    "count_year_not": count_year_not,
    "top_months": top_months,
    "words_per_month": words_per_month,
    "avg_review_length": avg_review_length,
    "top_words": top_words,
    "exploration_report": exploration_report,
    "top_states": top_states,
    "year_counts_over": year_counts_over,
    "partition_profile_default": partition_profile_default,
    "partition_profile_default_total": partition_profile_default_total,
    "partition_profile_keyed": partition_profile_keyed,
    "partition_profile_keyed_nulls": partition_profile_keyed_nulls,
    "review_report_file": review_report_file,
    "states_file": states_file,
    "partition_file": partition_file,
    "stopwords_normalised": stopwords_normalised,
    "stopwords_verbatim": stopwords_verbatim,
    "review_json_scan": review_json_scan,
    "business_json_scan": business_json_scan,
    "review_json_quarantine": review_json_quarantine,
    "count_year_not_readable": count_year_not_readable,
}

_WORDS = f"""reviews AS ({sql.REVIEWS}),
late AS (SELECT strftime(date, '%m') AS month, text FROM reviews WHERE year(date) >= {YEAR}),
late_words AS (SELECT month, word FROM (
    SELECT month, trim(unnest(regexp_split_to_array(lower(text), '{sql.SPACE}')), '([,.!?:;])') AS word FROM late)
  WHERE word <> '' AND word NOT IN ({sql.STOPWORD_LIST})),
month_words AS (SELECT m.month, CAST(coalesce(n, 0) AS BIGINT) AS words
  FROM (SELECT DISTINCT month FROM late) m
  LEFT JOIN (SELECT month, count(*) AS n FROM late_words GROUP BY month) w ON m.month = w.month),
lengths AS (SELECT (SELECT count(*) FROM late_words) / CAST(count(*) AS DOUBLE) AS avg_words FROM late),
frequent AS (SELECT word, count(*) AS n FROM late_words WHERE length(word) > {LONGER_THAN}
  GROUP BY word ORDER BY n DESC, word LIMIT 10)"""

_MONTHS = """SELECT strftime({date}, '%m') AS month, count(*) AS reviews FROM {source}
  GROUP BY 1 ORDER BY reviews DESC, CAST(month AS INTEGER) DESC LIMIT 5"""

ORACLE_SQL = {
    "avg_stars": f"SELECT round(avg(stars), 6) AS avg_stars FROM ({sql.REVIEWS})",
    "count_year_not": f"SELECT count(*) AS reviews FROM orders WHERE year(o_orderdate) <> {YEAR}",
    "top_months": _MONTHS.format(date="o_orderdate", source="orders"),
    "words_per_month": f"WITH {_WORDS} SELECT month, words FROM month_words ORDER BY month",
    "avg_review_length": f"WITH {_WORDS} SELECT round(avg_words, 6) AS avg_words FROM lengths",
    "top_words": f"WITH {_WORDS} SELECT word, n FROM frequent",
    "exploration_report": f"""WITH {_WORDS},
months AS ({_MONTHS.format(date="date", source="reviews")})
SELECT 'A' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(1 AS INTEGER) AS rank, round(avg(stars), 6) AS value FROM reviews
UNION ALL SELECT 'B', NULL, 1, CAST(count(*) AS DOUBLE) FROM reviews WHERE year(date) <> {YEAR}
UNION ALL SELECT 'C', month, CAST(row_number() OVER (ORDER BY reviews DESC, CAST(month AS INTEGER) DESC) AS INTEGER),
  CAST(reviews AS DOUBLE) FROM months
UNION ALL SELECT 'D', month, CAST(row_number() OVER (ORDER BY month) AS INTEGER), CAST(words AS DOUBLE) FROM month_words
UNION ALL SELECT 'E', NULL, 1, round(avg_words, 6) FROM lengths
UNION ALL SELECT 'F', word, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER), CAST(n AS DOUBLE) FROM frequent""",
    "top_states": f"""SELECT state, count(*) AS reviews FROM orders o JOIN ({sql.BUSINESSES}) b ON o.o_custkey = b.business_id
WHERE trim(state) <> '' GROUP BY state ORDER BY reviews DESC, state LIMIT {STATES}""",
    "year_counts_over": f"""SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS reviews FROM orders
GROUP BY 1 HAVING count(*) > {YEAR_THRESHOLD}""",
    "partition_profile_keyed": f"""SELECT CAST(p.partition AS INTEGER) AS partition, coalesce(items, 0) AS items
FROM range({LAYOUT_PARTITIONS}) p(partition)
LEFT JOIN (SELECT year(o_orderdate) % {LAYOUT_PARTITIONS} AS partition, count(*) AS items FROM orders GROUP BY 1) c
  ON p.partition = c.partition""",
    "partition_profile_default_total": "SELECT count(*) AS items, true AS counted FROM orders",
    "partition_profile_keyed_nulls": f"""SELECT CAST(p.partition AS INTEGER) AS partition, coalesce(items, 0) AS items
FROM range({LAYOUT_PARTITIONS}) p(partition)
LEFT JOIN (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE year(o_orderdate) % {LAYOUT_PARTITIONS} END AS partition,
             count(*) AS items FROM orders GROUP BY 1) c ON p.partition = c.partition""",
    "review_report_file": f"""WITH {_WORDS},
months AS ({_MONTHS.format(date="date", source="reviews")})
SELECT (SELECT round(avg(stars), 6) FROM reviews) AS a, (SELECT count(*) FROM reviews WHERE year(date) <> {YEAR}) AS b,
  (SELECT round(avg_words, 6) FROM lengths) AS e,
  (SELECT string_agg(month || ':' || reviews, ',' ORDER BY reviews DESC, CAST(month AS INTEGER) DESC) FROM months) AS c,
  (SELECT string_agg(month || ':' || words, ',' ORDER BY month) FROM month_words) AS d,
  (SELECT string_agg(word, ',' ORDER BY n DESC, word) FROM frequent) AS f""",
    "states_file": f"""SELECT CAST(row_number() OVER (ORDER BY reviews DESC, state) - 1 AS INTEGER) AS place, state, reviews
FROM (SELECT state, count(*) AS reviews FROM orders o JOIN ({sql.BUSINESSES}) b ON o.o_custkey = b.business_id
  WHERE trim(state) <> '' GROUP BY state ORDER BY reviews DESC, state LIMIT {STATES})""",
    "partition_file": f"""SELECT CAST({LAYOUT_PARTITIONS} AS BIGINT) AS n_partitions,
  (SELECT string_agg(coalesce(items, 0)::VARCHAR, ',' ORDER BY p.partition) FROM range({LAYOUT_PARTITIONS}) p(partition)
   LEFT JOIN (SELECT year(o_orderdate) % {LAYOUT_PARTITIONS} AS partition, count(*) AS items FROM orders GROUP BY 1) c
     ON p.partition = c.partition) AS n_items,
  (SELECT coalesce(string_agg(year || ':' || reviews, ',' ORDER BY year), '') FROM (
    SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS reviews FROM orders GROUP BY 1
    HAVING count(*) > {YEAR_THRESHOLD})) AS years""",
    "stopwords_normalised": f"SELECT DISTINCT lower(trim(state)) AS word FROM ({sql.BUSINESSES}) WHERE state IS NOT NULL",
    "stopwords_verbatim": f"""SELECT DISTINCT chr(160) || ' ' || state || chr(9) AS word
FROM ({sql.BUSINESSES}) WHERE state IS NOT NULL""",
    "review_json_quarantine": """SELECT 'year' AS kind, strftime(o_orderdate, '%Y') AS label, count(*) AS n
FROM orders WHERE o_orderkey % 11 > 3 GROUP BY ALL
UNION ALL SELECT 'bad line', CASE o_orderkey % 11 WHEN 0 THEN '{"review_id":"' || o_orderkey || '","stars":'
  WHEN 1 THEN '{"review_id":"' || o_orderkey || '","stars":"many"}' ELSE '[' || o_orderkey || ']' END, count(*)
FROM orders WHERE o_orderkey % 11 < 3 GROUP BY ALL""",
    "count_year_not_readable": f"""SELECT count(*) AS reviews FROM orders
WHERE o_orderkey % 11 > 3 AND year(o_orderdate) <> {YEAR}""",
    "review_json_scan": f"""SELECT strftime(date, '%Y') AS year, strftime(date, '%m') AS month, count(*) AS reviews,
  sum(stars) AS stars, CAST(sum(length(text)) AS BIGINT) AS characters, count(DISTINCT business_id) AS businesses
FROM ({sql.REVIEWS}) GROUP BY 1, 2""",
    "business_json_scan": f"SELECT state, count(*) AS businesses FROM ({sql.BUSINESSES}) GROUP BY state",
}
