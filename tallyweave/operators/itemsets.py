"""Frequent itemsets: level-wise mining, sharded candidates, and exact counting of candidates.

Baskets are (shard, basket, item) rows.  Mining within shards and mining over everything are the
same job; over everything there is one shard.

While mining, items are numbers in ascending order of support and an itemset is the ascending array
of them.  Candidates grow from a stem of the rarest items, so the most common items, which go with
nearly everything, are never what a group of candidates has in common.

Equal baskets of a few items are one row with a weight, and so are equal rests of them: a candidate is
counted from the tails of its prefix, which are what follows the prefix in baskets.  There are no more of
them than different item lists, however many baskets there are.

Larger baskets, and all of them where what folding leaves is still dense, are counted by vertical bit maps
from three items on: baskets are numbered, and an itemset has a row of ``WORDS`` longs for each range of
baskets in which it occurs.  A candidate is its base and one more item, so its rows are those of the base,
AND those of the item; its support is the bits left, each worth the weight of its range.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.ranking import global_position
from tallyweave.operators.skew import CELL_ROWS, pairs_in_groups
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

HEAVY_BASKET = 2000  # items from which a basket may be set aside while pairs are formed
FOLD_ITEMS = 16  # frequent items up to which a basket is an array, and equal baskets are one
SET_ASIDE = 62  # baskets set aside per shard at most: one bit each of a long
PAIR_BUCKETS = 30_000_000
BUCKET_STEP = 1_000_003
MAP_ROWS = 1_000_000  # rows of the bit map of frequent buckets up to which it may be broadcast
WORDS = 16  # longs of a row of a bit map, where items are dense enough; else one
# Share of the baskets that an item is in, on average, from which 64 baskets have a set of three: then
# rows of WORDS are full enough to pay.
DENSE = 1 / 4
_WORD_BITS = 64
_PLANES = 64  # a basket of weight w is in plane p where bit p of w is set
_UNFOLDED = _PLANES  # the plane of larger baskets, of weight 1 each

_SET = ["shard", "items"]


def shard_needs(baskets: DataFrame, support: int) -> DataFrame:
    """(shard, need): the least local count c with c * all_baskets >= support * shard_baskets.

    At most one row a shard, so the total is taken over a window of those rows.
    """
    sizes = (
        baskets.select("shard", "basket")
        .distinct()
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    shares = sizes.select(
        "shard",
        (F.lit(support).cast("decimal(18,0)") * F.col("size")).alias("share"),
        F.sum("size").over(Window.partitionBy(F.lit(1))).alias("total"),
    )
    return shares.select("shard", F.expr("greatest((share + total - 1) div total, 1)").alias("need"))


def _singles(baskets: DataFrame, needs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frequent items per shard as (shard, item, support, code), and the codes as (item, code)."""
    counts = baskets.groupBy("shard", "item").agg(F.count(F.lit(1)).alias("support"))
    frequent = counts.join(F.broadcast(needs), "shard").where(F.col("support") >= F.col("need"))
    frequent = written(frequent.select("shard", "item", "support"), "level-1")
    totals = frequent.groupBy("item").agg(F.sum("support").alias("total"))
    codes = written(global_position(totals, ["total", "item"], "code").select("item", "code"), "codes")
    return frequent.join(codes, "item"), codes


def _decoded(found: DataFrame, codes: DataFrame) -> DataFrame:
    """(shard, size, items, support) with the items as ascending text."""
    rows = found.select("*", F.explode("items").alias("code")).join(codes, "code")
    named = rows.groupBy(*_SET, "support").agg(F.array_sort(F.collect_list("item")).alias("named"))
    return named.select("shard", F.size("named").alias("size"), F.col("named").alias("items"), "support")


def _encoded(itemsets: DataFrame, codes: DataFrame) -> DataFrame:
    """(shard, size, items) of the itemsets whose items all have a code."""
    rows = itemsets.select("*", F.explode("items").alias("item")).join(codes, "item")
    coded = rows.groupBy("shard", "size", "items").agg(F.sort_array(F.collect_list("code")).alias("coded"))
    return coded.where(F.size("coded") == F.col("size")).select("shard", "size", F.col("coded").alias("items"))


def _set_aside(heavy: DataFrame, needs: DataFrame) -> DataFrame:
    """(shard, basket, bit) of up to need-1 heaviest baskets of a shard.

    A frequent itemset is in ``need`` baskets, so at least one of them is not set aside: forming
    pairs in the other baskets alone still meets every frequent pair.
    """
    heaviest = Window.partitionBy("shard").orderBy(F.desc("size"), "basket")
    placed = heavy.withColumn("place", F.row_number().over(heaviest)).where(F.col("place") <= SET_ASIDE)
    chosen = placed.join(F.broadcast(needs), "shard").where(F.col("place") < F.col("need"))
    return written(chosen.select("shard", "basket", (F.col("place") - 1).alias("bit")), "set-aside")


@dataclass(frozen=True)
class _Baskets:
    """The baskets of a run, those of at most ``FOLD_ITEMS`` items folded."""

    small: DataFrame  # shard, items, weight: ascending items and how many baskets have just these
    large: DataFrame | None  # shard, basket, item: rows of the other baskets, None if there are none
    sizes: DataFrame  # shard, basket, size: of the other baskets


def _folded(kept: DataFrame, heavy_basket: int) -> _Baskets:
    """Baskets from their rows (shard, basket, item); those without a key are in no pair."""
    keys = ["shard", "basket"]
    rows = kept.where(F.col("basket").isNotNull())
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    sizes = written(sizes.where(F.col("size") > min(FOLD_ITEMS, heavy_basket)), "large-baskets")
    large = None
    if not sizes.isEmpty():
        large = written(rows.join(sizes, keys, "left_semi"), "large-rows")
        rows = rows.join(sizes, keys, "left_anti")
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))
    small = lists.groupBy(*_SET).agg(F.count(F.lit(1)).alias("weight"))
    return _Baskets(written(small, "folded-baskets"), large, sizes)


def _pairs_in_place(small: DataFrame) -> DataFrame:
    """(shard, item_1, item_2, weight) of the pairs in each row's items."""
    first = small.select("shard", "items", "weight", F.posexplode("items").alias("place", "item_1"))
    later = F.explode(F.slice("items", F.col("place") + 2, F.size("items")))
    pairs = first.select("shard", "item_1", later.alias("item_2"), "weight")
    return pairs.where(F.col("item_1") < F.col("item_2"))


def _light_pairs(baskets: _Baskets, needs: DataFrame, heavy_basket: int):
    """Weighted pairs in the baskets not set aside, the limits they answer to, and what the others add.

    Limits are (shard, need, spare), spare being the number of baskets set aside.  The addition is a
    mask per item, (shard, item, mask), of the set-aside baskets that hold it, or None.
    """
    pairs = _pairs_in_place(baskets.small)
    limits, masks = needs.withColumn("spare", F.lit(0)), None
    if baskets.large is None:
        return pairs, F.broadcast(limits), masks
    kept = baskets.large
    heavy = written(baskets.sizes.where(F.col("size") > heavy_basket), "heavy-baskets")
    light, big = kept, heavy
    if not heavy.isEmpty():
        aside = F.broadcast(_set_aside(heavy, needs))  # at most SET_ASIDE rows a shard
        light = kept.join(aside, ["shard", "basket"], "left_anti")
        big = heavy.join(aside, ["shard", "basket"], "left_anti")
        masks = (
            kept.join(aside, ["shard", "basket"])
            .withColumn("bit", F.expr("shiftleft(1L, bit)"))
            .groupBy("shard", "item")
            .agg(F.bit_or("bit").alias("mask"))
        )
        spare = aside.groupBy("shard").agg(F.count(F.lit(1)).alias("spare"))
        limits = needs.join(spare, "shard", "left").na.fill(0, ["spare"])
    cells = big.select("shard", "basket", F.ceil(F.col("size") / CELL_ROWS).cast("int").alias("cells"))
    joined = pairs_in_groups(light, ["shard", "basket"], "item", big=cells)
    pairs = pairs.unionByName(joined.drop("basket").withColumn("weight", F.lit(1).cast("bigint")))
    return pairs, F.broadcast(limits), masks  # limits: one row a shard


def _pair_counts(baskets: _Baskets, needs: DataFrame, heavy_basket: int, buckets: int | None) -> DataFrame:
    """(shard, items, support) of the frequent pairs."""
    pairs, limits, masks = _light_pairs(baskets, needs, heavy_basket)
    if buckets is None:
        counts = _counted(pairs, limits)
    else:
        counts = _counted_in_buckets(pairs, limits, buckets)
    if masks is not None:
        for number in ("1", "2"):
            side = masks.toDF("shard", f"item_{number}", f"mask_{number}")
            counts = counts.join(side, ["shard", f"item_{number}"], "left")
        added = F.bit_count(F.col("mask_1").bitwiseAND(F.col("mask_2")))
        counts = counts.withColumn("support", F.col("support") + F.coalesce(added, F.lit(0)))
    frequent = counts.where(F.col("support") >= F.col("need"))
    return frequent.select("shard", F.array("item_1", "item_2").alias("items"), "support")


def _counted(pairs: DataFrame, limits: DataFrame) -> DataFrame:
    """(shard, item_1, item_2, support, need) of the pairs that set-aside baskets may make frequent."""
    counts = pairs.groupBy("shard", "item_1", "item_2").agg(F.sum("weight").alias("support"))
    return _within(counts, "support", limits)


def _within(counts: DataFrame, count: str, limits: DataFrame) -> DataFrame:
    return counts.join(limits, "shard").where(F.col(count) + F.col("spare") >= F.col("need")).drop("spare")


def _bucket(buckets: int) -> Column:
    """The bucket of a pair of item codes; plain arithmetic, so that other engines can state it."""
    return F.pmod(F.col("item_1") * F.lit(BUCKET_STEP) + F.col("item_2"), F.lit(buckets)).cast("int")


def pair_buckets(pairs: DataFrame, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """(shard, bucket, n): weights of the pairs per hash bucket, added up where the pairs are formed."""
    return pairs.groupBy("shard", _bucket(buckets).alias("bucket")).agg(F.sum("weight").alias("n"))


def _counted_in_buckets(pairs: DataFrame, limits: DataFrame, buckets: int) -> DataFrame:
    """As :func:`_counted`, through buckets, so that at most ``buckets`` rows a shard leave where pairs are formed.

    A bucket keeps its count, its least and its greatest pair, which merge like the count.  A bucket of one
    pair has counted that pair.  Only for frequent buckets of several pairs, pairs are formed again
    and those in other buckets dropped where they are formed.
    """
    pair = F.struct("item_1", "item_2")
    kept = pairs.groupBy("shard", _bucket(buckets).alias("bucket")).agg(
        F.sum("weight").alias("n"), F.min(pair).alias("least"), F.max(pair).alias("most")
    )
    frequent = written(_within(kept, "n", limits), "frequent-buckets")
    single = F.col("least") == F.col("most")
    counts = frequent.where(single).select("shard", "least.*", F.col("n").alias("support"), "need")
    several = written(_bucket_map(frequent.where(~single)), "shared-buckets")
    if several.isEmpty():
        return counts
    return counts.unionByName(_counted(_in_buckets(pairs, several, buckets), limits))


def _bucket_map(frequent: DataFrame) -> DataFrame:
    """(shard, word, map): the buckets as bits."""
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bucket") % 32)
    word = F.floor(F.col("bucket") / 32).cast("int")
    return frequent.groupBy("shard", word.alias("word")).agg(F.bit_or(mark).alias("map"))


def _in_buckets(pairs: DataFrame, maps: DataFrame, buckets: int) -> DataFrame:
    """Pairs of the marked buckets, before any of them is shuffled if the map is counted to be small."""
    if maps.count() <= MAP_ROWS:
        maps = F.broadcast(maps)
    word, bit = F.floor(F.col("bucket") / 32).cast("int"), F.col("bucket") % 32
    tested = pairs.withColumn("bucket", _bucket(buckets)).withColumn("word", word).join(maps, ["shard", "word"])
    return tested.where(F.call_function("shiftright", "map", bit).bitwiseAND(F.lit(1)) == 1).drop("bucket", "word", "map")


def _rarer_parent(sides: DataFrame) -> DataFrame:
    """(shard, items, base, base_support, extra) from a stem and two last items with supports.

    The base is the rarer of the two parents stem+last, the extra is the item it lacks.
    """
    first = F.col("support_1") <= F.col("support_2")
    of_base = F.when(first, F.col("last_1")).otherwise(F.col("last_2"))
    return sides.select(
        "shard",
        F.concat("stem", F.array("last_1", "last_2")).alias("items"),
        F.concat("stem", F.array(of_base)).alias("base"),
        F.least("support_1", "support_2").alias("base_support"),
        F.when(first, F.col("last_2")).otherwise(F.col("last_1")).alias("extra"),
    )


def _split_last(level: DataFrame, size: int) -> DataFrame:
    """(shard, stem, last, support) of the itemsets one item smaller than ``size``."""
    stem = F.slice("items", 1, size - 2) if size > 2 else F.expr("cast(array() as array<bigint>)")
    return level.select("shard", stem.alias("stem"), F.element_at("items", -1).alias("last"), "support")


def next_candidates(level: DataFrame, size: int) -> DataFrame:
    """Itemsets of ``size`` all of whose subsets of one item less are in ``level``.

    Two parents sharing all but their last item make a candidate; the subsets that drop an earlier
    item are checked by semi joins.
    """
    parents = _split_last(level, size)
    candidates = _rarer_parent(pairs_in_groups(parents, ["shard", "stem"], "last", carry=["support"]))
    known = level.select("shard", F.col("items").alias("subset"))
    for dropped in range(size - 2):
        rest = F.concat(F.slice("items", 1, dropped), F.slice("items", dropped + 2, size - dropped - 1))
        candidates = candidates.withColumn("subset", rest).join(known, ["shard", "subset"], "left_semi").drop("subset")
    return candidates


class _Bitmaps:
    """Bit maps over numbered baskets: rows (shard, items, range, w0, w1, ...), a range being of one plane."""

    def __init__(self, kept: DataFrame, baskets: int, parts: int, items: int):
        """``kept`` gives (shard, item, number, plane), the numbers of ``baskets`` in ``parts`` runs without gaps."""
        dense = kept.count() >= DENSE * baskets * items
        self.words = [f"w{i}" for i in range(WORDS if dense else 1)]
        bits = _WORD_BITS * len(self.words)
        # Ranges of a run of numbers, the last of them perhaps not full.
        self.ranges = -(-baskets // bits) + parts
        place = F.col("number") % bits
        word, bit = F.floor(place / _WORD_BITS), (place % _WORD_BITS).cast("int")
        mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
        columns = [F.coalesce(F.bit_or(F.when(word == i, mark)), F.lit(0)).alias(w) for i, w in enumerate(self.words)]
        of_plane = F.floor(F.col("number") / bits) * (2 * _PLANES) + F.col("plane")
        rows = kept.groupBy("shard", "item", of_plane.alias("range")).agg(*columns)
        self._items = written(rows, "item-bitmaps")

    def singles(self) -> DataFrame:
        return self._items.withColumn("items", F.array("item")).drop("item")

    def grown(self, candidates: DataFrame, bases: DataFrame) -> DataFrame:
        """Bit maps of the candidates, with ``n``, the baskets of each row, from those of their bases.

        A base with very many rows is dealt to cells by range, its candidates repeated a cell.
        """
        cells = F.ceil(F.least("base_support", F.lit(self.ranges)) / CELL_ROWS).cast("int")
        needed = candidates.select("shard", "base", cells.alias("cells")).distinct()
        dealt = spread_small_scan(bases).withColumnRenamed("items", "base").join(needed, ["shard", "base"])
        dealt = dealt.withColumn("cell", F.pmod("range", F.col("cells")).cast("int")).drop("cells")
        repeated = candidates.withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1)))
        rows = dealt.join(repeated, ["shard", "base", "cell"]).select("shard", "items", "extra", "range", *self.words)
        extra = self._items.select("shard", F.col("item").alias("extra"), "range", *[F.col(w).alias(f"{w}_x") for w in self.words])
        both = [F.col(w).bitwiseAND(F.col(f"{w}_x")).alias(w) for w in self.words]
        rows = rows.join(extra, ["shard", "extra", "range"]).select("shard", "items", "range", *both)
        n = reduce(Column.__add__, [F.bit_count(w) for w in self.words])
        weight = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("range") % _PLANES).cast("int"))
        return rows.withColumn("n", n.cast("bigint") * weight).where("n > 0")


def _pairs_grown(pairs: DataFrame, singles: DataFrame) -> DataFrame:
    """(shard, items, base, extra, base_support): pairs as candidates grown from their rarer item."""
    support = singles.select("shard", F.col("items").alias("base"), F.col("support").alias("base_support"))
    rows = pairs.select("shard", "items", F.slice("items", 1, 1).alias("base"), F.col("items")[1].alias("extra"))
    return rows.join(support, ["shard", "base"])


def _bitmap_rows(baskets: _Baskets, small: bool) -> tuple[DataFrame, int, int]:
    """What :class:`_Bitmaps` takes, of the larger baskets and, if ``small``, of the folded ones too."""
    parts = []
    number = F.monotonically_increasing_id()
    if small:
        planes = F.filter(
            F.sequence(F.lit(0), F.lit(_PLANES - 2)),
            lambda p: F.call_function("shiftright", F.col("weight"), p).bitwiseAND(F.lit(1)) == 1,
        )
        rows = baskets.small.select("shard", F.array_distinct("items").alias("items"), F.explode(planes).alias("plane"))
        rows = written(rows.sortWithinPartitions("shard", "plane").withColumn("number", number), "folded-numbered")
        parts.append((rows, rows.select("shard", F.explode("items").alias("item"), "number", "plane")))
    if baskets.large is not None:
        rows = written(baskets.sizes.sortWithinPartitions("shard").withColumn("number", number), "baskets-numbered")
        named = baskets.large.join(rows.select("shard", "basket", "number"), ["shard", "basket"])
        parts.append((rows, named.select("shard", "item", "number", F.lit(_UNFOLDED).alias("plane"))))
    count = sum(rows.count() for rows, _ in parts)
    runs = sum(rows.rdd.getNumPartitions() for rows, _ in parts)
    return reduce(DataFrame.unionByName, [kept for _, kept in parts]), count, runs


def _grown_tails(tails: DataFrame, wanted: DataFrame) -> DataFrame:
    """(shard, items, tail, weight) of the itemsets ``wanted``, from those of the same without their last item."""
    rows = tails.select("shard", "items", "tail", "weight", F.posexplode("tail").alias("place", "next"))
    rest = F.slice("tail", F.col("place") + 2, F.size("tail"))
    rows = rows.select("shard", F.concat("items", F.array("next")).alias("items"), rest.alias("tail"), "weight")
    rows = rows.join(wanted.select(*_SET), _SET, "left_semi")
    return rows.groupBy(*_SET, "tail").agg(F.sum("weight").alias("weight"))


class _Supports:
    """Counts of the candidates of one level after another."""

    def __init__(self, baskets: _Baskets, singles: DataFrame, small: bool, items: int):
        """``small``: folded baskets too are counted by bit maps."""
        self._singles = singles
        self._tails, self._bitmaps, self._rows = None, None, None  # both of the level before
        if not small:
            nothing = F.expr("cast(array() as array<bigint>)")
            tail = F.array_distinct("items")
            self._tails = baskets.small.select("shard", nothing.alias("items"), tail.alias("tail"), "weight")
        if small or baskets.large is not None:
            self._bitmaps = _Bitmaps(*_bitmap_rows(baskets, small), items)
        self._begun = False

    def of(self, candidates: DataFrame, size: int) -> DataFrame:
        """(shard, items, support) of the candidates that some basket holds."""
        counts = []
        if self._tails is not None:
            if not self._begun:
                for begin in range(1, size):
                    wanted = candidates.select("shard", F.slice("items", 1, begin).alias("items")).distinct()
                    self._tails = _grown_tails(self._tails, wanted)
            self._tails = written(_grown_tails(self._tails, candidates), f"tails-{size}")
            counts.append(self._tails.select(*_SET, F.col("weight").alias("n")))
        if self._bitmaps is not None:
            if not self._begun:
                self._rows = self._bitmaps.singles()
                if size == 3:
                    bases = candidates.select("shard", F.col("base").alias("items")).distinct()
                    grown = self._bitmaps.grown(_pairs_grown(bases, self._singles), self._rows)
                    self._rows = written(grown, "bitmaps-2")
            self._rows = written(self._bitmaps.grown(candidates, self._rows.drop("n")), f"bitmaps-{size}")
            counts.append(self._rows.select(*_SET, "n"))
        self._begun = True
        return reduce(DataFrame.unionByName, counts).groupBy(*_SET).agg(F.sum("n").alias("support"))


def _levels(
    baskets: DataFrame,
    needs: DataFrame,
    candidates_of: Callable[[DataFrame, int, DataFrame], DataFrame],
    pair_level: Callable[[_Baskets], DataFrame] | None,
    max_size: int | None,
    heavy_basket: int = HEAVY_BASKET,
) -> DataFrame:
    """Frequent itemsets level by level; every level is a written table, so lineage stays short.

    ``pair_level`` counts the second level where its pairs occur; without it the pairs come from
    ``candidates_of`` like every later level.
    """
    frequent_items, codes = _singles(baskets, needs)
    kept = written(
        baskets.join(frequent_items, ["shard", "item"]).select("shard", "basket", F.col("code").alias("item")), "kept-rows"
    )
    held = _folded(kept, heavy_basket)
    singles = frequent_items.select("shard", F.array("code").alias("items"), "support")
    shape = held.small.select(F.size("items").alias("size"), "weight")
    shape = shape.unionByName(held.sizes.select("size", F.lit(1).alias("weight")))
    shape = shape.agg(F.max("size").alias("longest"), F.sum("size").alias("rows"), F.sum("weight").alias("baskets")).first()

    level, found, size = singles, singles, 1
    supports = None
    while not level.isEmpty() and size < (shape.longest or 0) and (max_size is None or size < max_size):
        size += 1
        if size == 2 and pair_level is not None:
            level = written(pair_level(held), "level-2")
        else:
            candidates = written(candidates_of(level, size, codes), f"candidates-{size}")
            if candidates.isEmpty():
                break
            if supports is None:
                items = codes.count()
                # Where folding pays, few rows are left of the baskets there were.
                supports = _Supports(held, singles, shape.rows >= DENSE * shape.baskets * items, items)
            counts = supports.of(candidates, size)
            frequent = counts.join(F.broadcast(needs), "shard").where(F.col("support") >= F.col("need"))
            level = written(frequent.select("shard", "items", "support"), f"level-{size}")
        found = found.unionByName(level)
    return _decoded(found, codes)


def _grown(level: DataFrame, size: int, codes: DataFrame) -> DataFrame:
    return next_candidates(level, size)


def frequent_itemsets(
    baskets: DataFrame,
    support: int,
    buckets: int | None = None,
    max_size: int | None = None,
    heavy_basket: int = HEAVY_BASKET,
) -> DataFrame:
    """(size, items, support) of the itemsets in at least ``support`` baskets.

    ``buckets`` prunes pairs by hash-bucket counts first; the result is the same.
    """
    rows = written(baskets.select(F.lit(0).alias("shard"), "basket", "item"), "baskets")
    needs = _need_overall(rows, support)
    found = _levels(
        rows, needs, _grown, lambda held: _pair_counts(held, needs, heavy_basket, buckets), max_size, heavy_basket
    )
    return found.drop("shard")


def sharded_candidates(
    baskets: DataFrame,
    support: int,
    buckets: int | None = None,
    max_size: int | None = None,
    heavy_basket: int = HEAVY_BASKET,
) -> DataFrame:
    """(size, items) of the itemsets frequent in some shard at the shard's share of the support."""
    rows = written(baskets.select("shard", "basket", "item"), "baskets")
    needs = written(shard_needs(rows, support), "needs")
    found = _levels(
        rows, needs, _grown, lambda held: _pair_counts(held, needs, heavy_basket, buckets), max_size, heavy_basket
    )
    return found.select("size", "items").distinct()


def bucket_counts(
    baskets: DataFrame, support: int, buckets: int = PAIR_BUCKETS, heavy_basket: int = HEAVY_BASKET
) -> DataFrame:
    """(shard, bucket, n): the bucket counts that prune the pairs of the frequent items of a shard."""
    rows = written(baskets.select("shard", "basket", "item"), "baskets")
    needs = written(shard_needs(rows, support), "needs")
    frequent_items, _ = _singles(rows, needs)
    kept = rows.join(frequent_items, ["shard", "item"]).select("shard", "basket", F.col("code").alias("item"))
    kept = written(kept, "kept-rows")
    pairs, _, _ = _light_pairs(_folded(kept, heavy_basket), needs, heavy_basket)
    return pair_buckets(pairs, buckets)


def count_candidates(baskets: DataFrame, candidates: DataFrame, support: int) -> DataFrame:
    """(size, items, support) of the candidates in at least ``support`` baskets overall.

    Any list of itemsets will do.  A candidate grows from its rarest item by the next rarest; what candidates
    begin with is counted once for all of them, and no candidate is in more baskets than its beginning.
    """
    rows = written(baskets.select(F.lit(0).alias("shard"), "basket", "item"), "baskets")
    items = F.array_sort(F.array_distinct("items"))
    given = candidates.select(F.lit(0).alias("shard"), items.alias("items")).where(F.size("items") > 0).distinct()
    given = written(given.withColumn("size", F.size("items")), "given-candidates")
    singles = given.select("shard", F.explode("items").alias("item")).distinct()
    coded: list[DataFrame] = []

    def of_size(level: DataFrame, size: int, codes: DataFrame) -> DataFrame:
        if not coded:
            coded.append(written(_encoded(given, codes), "coded-candidates"))
        begun = coded[0].where(F.col("size") >= size).select("shard", F.slice("items", 1, size).alias("items")).distinct()
        begun = begun.select("shard", "items", F.slice("items", 1, size - 1).alias("base"), F.col("items")[size - 1].alias("extra"))
        known = level.select("shard", F.col("items").alias("base"), F.col("support").alias("base_support"))
        return begun.join(known, ["shard", "base"])

    wanted = rows.join(singles, ["shard", "item"], "left_semi")
    found = _levels(wanted, _need_overall(rows, support), of_size, None, None)
    return found.join(given.select("shard", "items"), _SET, "left_semi").select("size", "items", "support")


def _need_overall(rows: DataFrame, support: int) -> DataFrame:
    return rows.sparkSession.createDataFrame([(0, support)], "shard int, need bigint")


def triple_candidates(pairs: DataFrame) -> DataFrame:
    """(items) of the triples whose three pairs are all among ``pairs`` (items, support)."""
    level = pairs.select(F.lit(0).alias("shard"), "items", "support")
    totals = level.select(F.explode("items").alias("item"), "support").groupBy("item").agg(F.sum("support").alias("total"))
    codes = written(global_position(totals, ["total", "item"], "code").select("item", "code"), "codes")
    coded = _encoded(level.withColumn("size", F.lit(2)), codes).select("shard", "items", F.lit(0).alias("support"))
    found = next_candidates(coded, 3).select("shard", "items", F.lit(0).alias("support"))
    return _decoded(found, codes).select("items")


def count_by_size(itemsets: DataFrame) -> DataFrame:
    """Number of itemsets of each size."""
    return itemsets.groupBy("size").agg(F.count(F.lit(1)).alias("itemsets"))
