"""Registered queries over baskets and itemsets."""

from pyspark.sql import functions as F

from tallyweave.operators import baskets, itemsets
from tallyweave.plans.itemset_report import itemset_report
from tallyweave.registry import sql_views as sql
from tallyweave.sources import readers, stand_ins
from tallyweave.storage import new_path, written

BASKET_SIZE = 2  # brand baskets hold more items than this
SUPPORT = 60
SHARDS = 4
CASE_YEAR = 1997
CASE_RATING = 2
CASE_SUPPORT = 4
SQL_LEVELS = 8


def _brand_baskets(spark, folder):
    return baskets.user_baskets(stand_ins.brand_lines(spark, folder), BASKET_SIZE)


def _sharded(spark, folder):
    return _brand_baskets(spark, folder).withColumn("shard", F.pmod("basket", F.lit(SHARDS)).cast("int"))


def _case_baskets(spark, folder, case):
    return baskets.year_baskets(stand_ins.yearly_ratings(spark, folder), CASE_YEAR, case, CASE_RATING)


def _text(found):
    """Itemsets with their items as one text column."""
    return found.withColumn("items", F.array_join("items", "|"))


def basket_items_by_user(spark, folder):
    return _case_baskets(spark, folder, 1)


def basket_items_by_business(spark, folder):
    return _case_baskets(spark, folder, 2)


def filtered_baskets(spark, folder):
    return _brand_baskets(spark, folder)


def item_support(spark, folder):
    return baskets.item_support(_brand_baskets(spark, folder))


def itemsets_frequent(spark, folder):
    return _text(itemsets.frequent_itemsets(_brand_baskets(spark, folder), SUPPORT))


def itemsets_by_user(spark, folder):
    return _text(itemsets.frequent_itemsets(_case_baskets(spark, folder, 1), CASE_SUPPORT))


def itemsets_by_business(spark, folder):
    return _text(itemsets.frequent_itemsets(_case_baskets(spark, folder, 2), CASE_SUPPORT))


def son_candidates(spark, folder):
    return _text(itemsets.sharded_candidates(_sharded(spark, folder), SUPPORT))


def son_itemsets(spark, folder):
    return _text(itemset_report(_sharded(spark, folder), SUPPORT).frequent)


def itemset_size_counts(spark, folder):
    return itemset_report(_sharded(spark, folder), SUPPORT).size_counts


def pcy_candidates(spark, folder):
    return _text(itemsets.sharded_candidates(_sharded(spark, folder), SUPPORT, itemsets.PAIR_BUCKETS))


def pcy_itemsets(spark, folder):
    return _text(itemset_report(_sharded(spark, folder), SUPPORT, with_buckets=True).frequent)


def pair_bucket_counts(spark, folder):
    return itemsets.bucket_counts(_sharded(spark, folder), SUPPORT)


def candidate_support(spark, folder):
    """Counts of a candidate list that holds pairs and triples but none of their subsets."""
    kept = _brand_baskets(spark, folder)
    items = kept.select("item").distinct()
    number = F.substring_index("item", "#", -1).cast("int")
    named = items.select("item", number.alias("n"))
    later = named.toDF("second", "m")
    pairs = named.join(later, F.col("m") == F.col("n") + 1).select(F.array("item", "second").alias("items"))
    third = named.toDF("third", "k")
    triples = named.join(later, F.col("m") == F.col("n") + 1).join(third, F.col("k") == F.col("n") + 2)
    triples = triples.select(F.array("third", "item", "second").alias("items"))
    return _text(itemsets.count_candidates(kept, pairs.unionByName(triples), 1))


def itemset_files(spark, folder):
    """The itemset report written and read back: candidates, their numbers, frequent itemsets."""
    path = new_path(spark, "itemset-report")
    itemset_report(_sharded(spark, folder), SUPPORT).write(path)

    def part(name, schema, *columns):
        rows = spark.read.schema(schema).json(f"{path}/{name}")
        return rows.select(F.lit(name).alias("part"), *columns)

    none = F.lit(None)
    items = F.array_join("items", "|").alias("items")
    sized = "size int, items array<string>"
    parts = [
        part("candidates", sized, "size", items, none.cast("bigint").alias("n")),
        part("num_candidates_by_size", "size int, itemsets bigint", "size", none.cast("string").alias("items"), F.col("itemsets").alias("n")),
        part("num_candidates", "itemsets bigint", none.cast("int").alias("size"), none.cast("string").alias("items"), F.col("itemsets").alias("n")),
        part("frequent_itemsets", f"{sized}, support bigint", "size", items, F.col("support").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def triple_candidates(spark, folder):
    found = itemsets.frequent_itemsets(_brand_baskets(spark, folder), SUPPORT, max_size=2)
    pairs = written(found.where(F.col("size") == 2), "pairs")
    return _text(itemsets.triple_candidates(pairs))


def basket_csv_scan(spark, folder):
    """Ratings written as CSV with a header, read back by position and counted."""
    path = new_path(spark, "ratings-csv")
    stand_ins.yearly_ratings(spark, folder).write.csv(path, header=True)
    back = readers.read_year_baskets(spark, path)
    return back.groupBy("year", "rating").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )


def pair_csv_scan(spark, folder):
    """User-business pairs written as CSV with a header, read back and made baskets of."""
    path = new_path(spark, "pairs-csv")
    stand_ins.brand_lines(spark, folder).write.csv(path, header=True)
    return baskets.item_support(baskets.user_baskets(readers.read_user_business(spark, path), BASKET_SIZE))


QUERIES = {
    "basket_items_by_user": basket_items_by_user,
    "basket_items_by_business": basket_items_by_business,
    "filtered_baskets": filtered_baskets,
    "item_support": item_support,
    "itemsets_frequent": itemsets_frequent,
    "itemsets_by_user": itemsets_by_user,
    "itemsets_by_business": itemsets_by_business,
    "son_candidates": son_candidates,
    "son_itemsets": son_itemsets,
    "itemset_size_counts": itemset_size_counts,
    "pcy_candidates": pcy_candidates,
    "pcy_itemsets": pcy_itemsets,
    "pair_bucket_counts": pair_bucket_counts,
    "candidate_support": candidate_support,
    "itemset_files": itemset_files,
    "triple_candidates": triple_candidates,
    "basket_csv_scan": basket_csv_scan,
    "pair_csv_scan": pair_csv_scan,
}

_BRANDS = f"""lines AS (SELECT DISTINCT user_id AS basket, business_id AS item FROM ({sql.BRAND_LINES})),
kept AS (SELECT basket, item FROM lines WHERE basket IN
  (SELECT basket FROM lines GROUP BY basket HAVING count(*) > {BASKET_SIZE}))"""


def _case(basket, item):
    return f"""kept AS (SELECT DISTINCT {basket} AS basket, CAST({item} AS VARCHAR) AS item FROM ({sql.YEARLY_RATINGS})
  WHERE year = {CASE_YEAR} AND rating > {CASE_RATING})"""


def _mined(source, shard, support):
    """CTEs f1, f2, ...: frequent itemsets per shard, each level grown from the one before it."""
    parts = [
        source,
        f"rows_ AS (SELECT {shard} AS shard, basket, item FROM kept)",
        f"""needs AS (SELECT shard, greatest(1, ({support} * size + total - 1) // total) AS need FROM (
  SELECT shard, size, sum(size) OVER () AS total FROM (
    SELECT shard, count(DISTINCT basket) AS size FROM rows_ GROUP BY shard)))""",
        "o1 AS (SELECT shard, basket, item AS items, item AS last FROM rows_)",
    ]
    for size in range(1, SQL_LEVELS + 1):
        if size > 1:
            parts.append(
                f"""o{size} AS (SELECT o.shard, o.basket, o.items || '|' || r.item AS items, r.item AS last
  FROM o{size - 1} o JOIN f{size - 1} f ON o.shard = f.shard AND o.items = f.items
  JOIN rows_ r ON r.shard = o.shard AND r.basket = o.basket AND r.item > o.last)"""
            )
        parts.append(
            f"""f{size} AS (SELECT o.shard, {size} AS size, items, count(*) AS support
  FROM o{size} o JOIN needs n ON o.shard = n.shard GROUP BY o.shard, items, need HAVING count(*) >= need)"""
        )
    found = "\n  UNION ALL ".join(f"SELECT * FROM f{size}" for size in range(1, SQL_LEVELS + 1))
    return "WITH " + ",\n".join(parts) + f",\nfound AS ({found})\n"


_FREQUENT = "SELECT CAST(size AS INTEGER) AS size, items, support FROM found"
_CANDIDATES = "SELECT DISTINCT CAST(size AS INTEGER) AS size, items FROM found"
_WHOLE = _mined(_BRANDS, "0", SUPPORT) + _FREQUENT
_SHARDED = _mined(_BRANDS, f"basket % {SHARDS}", SUPPORT)

ORACLE_SQL = {
    "basket_items_by_user": f"WITH {_case('user_id', 'business_id')} SELECT basket, item FROM kept",
    "basket_items_by_business": f"WITH {_case('business_id', 'user_id')} SELECT basket, item FROM kept",
    "filtered_baskets": f"WITH {_BRANDS} SELECT basket, item FROM kept",
    "item_support": f"WITH {_BRANDS} SELECT item, count(*) AS support FROM kept GROUP BY item",
    "itemsets_frequent": _WHOLE,
    "itemsets_by_user": _mined(_case("user_id", "business_id"), "0", CASE_SUPPORT) + _FREQUENT,
    "itemsets_by_business": _mined(_case("business_id", "user_id"), "0", CASE_SUPPORT) + _FREQUENT,
    "son_candidates": _SHARDED + _CANDIDATES,
    "son_itemsets": _WHOLE,
    "itemset_size_counts": _SHARDED
    + f"SELECT size, count(*) AS itemsets FROM ({_CANDIDATES}) GROUP BY size",
    "pcy_candidates": _SHARDED + _CANDIDATES,
    "pcy_itemsets": _WHOLE,
    "pair_bucket_counts": _SHARDED
    + f""", codes AS (SELECT items AS item, row_number() OVER (ORDER BY sum(support), items) - 1 AS code FROM f1 GROUP BY items),
coded AS (SELECT r.shard, r.basket, code FROM rows_ r JOIN f1 ON f1.shard = r.shard AND f1.items = r.item
  JOIN codes ON codes.item = r.item)
SELECT CAST(a.shard AS INTEGER) AS shard,
  CAST((a.code * {itemsets.BUCKET_STEP} + b.code) % {itemsets.PAIR_BUCKETS} AS INTEGER) AS bucket, count(*) AS n
FROM coded a JOIN coded b ON a.shard = b.shard AND a.basket = b.basket AND a.code < b.code GROUP BY 1, 2""",
    "candidate_support": f"""WITH {_BRANDS}, named AS (
  SELECT DISTINCT item, CAST(split_part(item, '#', 2) AS INTEGER) AS n FROM kept)
SELECT 2 AS size, array_to_string(list_sort([a.item, b.item]), '|') AS items,
  (SELECT count(*) FROM kept x JOIN kept y ON x.basket = y.basket WHERE x.item = a.item AND y.item = b.item) AS support
FROM named a JOIN named b ON b.n = a.n + 1
WHERE support > 0
UNION ALL SELECT 3, array_to_string(list_sort([a.item, b.item, c.item]), '|'),
  (SELECT count(*) FROM kept x JOIN kept y ON x.basket = y.basket JOIN kept z ON x.basket = z.basket
   WHERE x.item = a.item AND y.item = b.item AND z.item = c.item) AS support
FROM named a JOIN named b ON b.n = a.n + 1 JOIN named c ON c.n = a.n + 2 WHERE support > 0""",
    "itemset_files": _SHARDED
    + f""", listed AS ({_CANDIDATES}), whole AS ({_mined(_BRANDS, "0", SUPPORT)}{_FREQUENT})
SELECT 'candidates' AS part, size, items, CAST(NULL AS BIGINT) AS n FROM listed
UNION ALL SELECT 'num_candidates_by_size', size, NULL, count(*) FROM listed GROUP BY size
UNION ALL SELECT 'num_candidates', NULL, NULL, count(*) FROM listed
UNION ALL SELECT 'frequent_itemsets', size, items, support FROM whole""",
    "triple_candidates": _mined(_BRANDS, "0", SUPPORT)
    + """, pairs AS (SELECT split_part(items, '|', 1) AS a, split_part(items, '|', 2) AS b FROM f2)
SELECT x.a || '|' || x.b || '|' || y.b AS items FROM pairs x
JOIN pairs y ON x.a = y.a AND x.b < y.b JOIN pairs z ON z.a = x.b AND z.b = y.b""",
    "basket_csv_scan": f"""SELECT year, rating, count(*) AS n, count(DISTINCT user_id) AS users
FROM ({sql.YEARLY_RATINGS}) GROUP BY year, rating""",
    "pair_csv_scan": f"WITH {_BRANDS} SELECT item, count(*) AS support FROM kept GROUP BY item",
}
