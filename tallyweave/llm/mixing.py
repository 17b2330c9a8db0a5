"""Mixing sources to target weights, block by block.

The words of a source, documents in order of doc_id, are packed into blocks of ``block_words`` words;
its last block may be short.  Every block of the output is a slot; output shards of ``shard_slots``
slots draw how many of them each source fills.  The draws are multinomial given their totals: a
permutation keyed by ``SEED`` (rounds of swap-or-not) deals the slots, so over all shards a source gets
exactly the slots of its target and never more than three passes over its blocks, which independent draws
could not promise.
The i-th slot of a source takes the block that a pseudorandom index permutation of the source, one a
pass, maps i to.  Slots and blocks meet in an equi-join on (source, block).

Sources, ordered by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and share the words of all
documents.  A target stops at three times its source's size and the excess is shared again by weight.

Defined cases: a null or empty text has size 0 and nothing of it is taken; a source of size 0 has
target 0; an empty table gives an empty result; equal rows are documents of their own; further columns
are left out.  All steps are integer arithmetic, so reruns agree.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.llm.running import running_total
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
MOST_PASSES = 3
LOOKUP_BINS = 4096
# Primes below 2^23.  Multiplying by one that does not divide n permutes the indexes
# below n, and the product stays in 64 bits up to n = 2^40.
SEED = 20240229
DEAL_ROUNDS = 48
STEPS = (8388593, 8388587, 8388581, 8388571, 8388547, 8388539)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _step(choice: Column, n: Column) -> Column:
    """One of the primes, by ``choice``, that does not divide n (no n below 2^40 has two of them)."""
    primes = F.array(*[F.lit(p).cast("bigint") for p in STEPS])
    at = F.pmod(choice, F.lit(len(STEPS)))
    first = F.get(primes, at.cast("int"))
    return F.when(n % first != 0, first).otherwise(F.get(primes, F.pmod(at + 1, F.lit(len(STEPS))).cast("int")))


def permuted(i: Column, n: Column, choice: Column) -> Column:
    """The place of index i in permutation number ``choice`` of 0 .. n-1."""
    return F.pmod(_step(choice, n) * i + F.lit(7919).cast("bigint") * choice, n)


def dealt_place(i: Column, n: int) -> Column:
    """The place of index i in a permutation of 0 .. n-1 drawn by ``SEED``.

    Each round pairs x with (key - x) mod n and swaps the two or not by a hash of the larger, so it takes
    every n without a sort.
    """
    size = F.lit(n).cast("bigint")

    def round_of(x: Column, number: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), number), size) - x, size)
        swap = F.pmod(F.xxhash64(F.lit(SEED + 1), number, F.greatest(x, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEAL_ROUNDS)), i.cast("bigint"), round_of)


def source_targets(sizes: DataFrame, block_words: int) -> DataFrame:
    """Rank, weight, target, blocks and slots of each source.

    ``sizes`` has one row a source; only those rows pass through the window that ranks them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order).cast("bigint") - 1)
    ranked = written(ranked.withColumn("weight", F.pmod("rank", F.lit(3)) + 1), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share = None  # words a unit of weight: (numerator, denominator), over the sources not at their limit
    while True:
        free = F.lit(True) if share is None else F.col("weight") * share[0] <= F.col("source_size") * MOST_PASSES * share[1]
        split = ranked.agg(
            F.sum(F.when(free, F.col("weight"))).alias("weights"),
            F.coalesce(F.sum(F.when(~free, F.col("source_size"))), F.lit(0)).alias("held"),
        ).first()
        now = (total - MOST_PASSES * split["held"], split["weights"] or 1)
        if now == share or not split["weights"]:
            break
        # The share only grows from pass to pass, so a source at its limit stays there.
        share = now
    numerator, denominator = share or (0, 1)
    size = F.col("source_size")
    most = size * MOST_PASSES
    held = F.col("weight").cast("decimal(38,0)") * numerator > most.cast("decimal(38,0)") * denominator
    target = F.when(held, most.cast("double")).otherwise(F.lit(numerator / denominator) * F.col("weight"))
    blocks = F.ceil(size / F.lit(block_words)).cast("bigint")
    slots = F.when(held, blocks * MOST_PASSES).otherwise(
        F.coalesce(F.least(F.round(F.try_divide(target * blocks, size)).cast("bigint"), blocks * MOST_PASSES), F.lit(0))
    )
    return ranked.withColumns({"target": target, "blocks": blocks, "slots": slots})


def draw_slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Rows shard, source_key, slot: which block number each slot of the mix takes from its source.

    The slots of the whole mix are dealt by a permutation; the source whose range of dealt numbers
    holds a number gets the slot.  Ranges are found by an equi-join on bins of the numbers.
    """
    spark = sources.sparkSession
    n = sources.agg(F.sum("slots")).first()[0] or 0
    width = max(1, -(-n // LOOKUP_BINS))
    ends = sources.withColumn("end", F.sum("slots").over(Window.orderBy("rank"))).where("slots > 0")
    ranges = ends.withColumn("begin", F.col("end") - F.col("slots")).withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("begin") / width), F.floor((F.col("end") - 1) / width)))
    )
    ranges = ranges.select("source_key", "begin", "end", F.col("bin").cast("bigint").alias("bin"))
    number = dealt_place(F.col("id"), n) if n else F.col("id")
    dealt = spark.range(n).select(
        F.floor(F.col("id") / shard_slots).cast("bigint").alias("shard"), number.alias("number")
    )
    dealt = dealt.withColumn("bin", F.floor(F.col("number") / width).cast("bigint"))
    counts = (
        dealt.join(ranges, "bin")
        .where("number >= begin and number < end")
        .groupBy("shard", "source_key")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    first = running_total(counts, "source_key", ["shard"], "count", "first", "shard-counts")
    slots = F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)
    by_source = sources.select("source_key", "rank", "blocks")
    return (
        first.select("shard", "source_key", F.explode(slots).alias("slot"))
        .join(by_source, "source_key")
        .withColumn("pass", F.floor(F.col("slot") / F.col("blocks")).cast("bigint"))
        .withColumn(
            "block", permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("rank") + F.col("pass") + 1)
        )
        .select("shard", "source_key", "slot", "block")
    )


def placed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, source_key, size and the number of words of the source before the document."""
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
    )
    return running_total(rows, "source_key", ["doc_id", "size"], "size", "start", "placed")


def _with_targets(placed: DataFrame, block_words: int) -> DataFrame:
    sizes = placed.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    return written(source_targets(sizes, block_words), "targets")


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """One row for each block a document reaches into, with its words there."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    first, last = F.floor(start / block_words), F.floor((end - 1) / block_words)
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(start, F.col("block") * block_words)
    stop = F.least(end, (F.col("block") + 1) * block_words)
    return pieces.withColumn("begin", begin).withColumn("words", stop - begin)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words in the mix, repeats counted) of each document."""
    placed = written(placed_documents(docs), "documents")
    sources = _with_targets(placed, block_words)
    times = draw_slots(sources, shard_slots).groupBy("source_key", "block").agg(F.count(F.lit(1)).alias("times"))
    # Only (source, start) of a document with words is unique, so it names the document below.
    taken = (
        _pieces(placed, block_words)
        .select("source_key", "start", "block", "words")
        .join(times, ["source_key", "block"])
        .groupBy("source_key", "start")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        .withColumn("named", F.lit(1))
    )
    named = F.when(F.col("size") > 0, F.lit(1))
    targets = sources.select("source_key", "source_size", "target")
    return (
        placed.withColumn("named", named)
        .join(taken, ["source_key", "start", "named"], "left")
        .join(targets, "source_key")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: shard, source, slot, block and the block's words as an array."""
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        F.coalesce(found, F.array().cast("array<string>")).alias("all_words"),
    )
    placed = written(running_total(rows, "source_key", ["doc_id", "size", "all_words"], "size", "start"), "words")
    sources = _with_targets(placed, block_words)
    cut = F.slice("all_words", (F.col("begin") - F.col("start") + 1).cast("int"), F.col("words").cast("int"))
    blocks = (
        _pieces(placed, block_words)
        .select("source_key", "block", F.struct("start", cut.alias("cut")).alias("piece"))
        .groupBy("source_key", "block")  # at most block_words pieces
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["cut"])).alias("words"))
    )
    return (
        draw_slots(sources, shard_slots)
        .join(blocks, ["source_key", "block"])
        .join(sources.select("source_key", "source"), "source_key")
        .select("shard", "source", "slot", "block", "words")
    )


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text")
    return mix(spread_small_scan(docs))


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM docs
), sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM sizes
), weighed AS (SELECT *, rank % 3 + 1 AS weight FROM ranked),
filled AS (  -- sources in the order in which they reach their limit
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS words_left,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed WINDOW before AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT words_left, weight_left FROM filled WHERE words_left * weight <= 3 * source_size * weight_left
  ORDER BY source_size / weight, rank LIMIT 1
), targets AS (
  SELECT source, source_size, rank, (source_size + 63) // 64 AS blocks,
         CASE WHEN weight * words_left > 3 * source_size * weight_left THEN 3.0::DOUBLE * source_size
              ELSE words_left::DOUBLE / weight_left::DOUBLE * weight END AS target,
         weight * words_left > 3 * source_size * weight_left AS held
  FROM weighed, level
), quotas AS (
  SELECT *, CASE WHEN held THEN 3 * blocks
                 ELSE coalesce(least(round(target * blocks / nullif(source_size, 0))::BIGINT, 3 * blocks), 0) END AS slots
  FROM targets
), times AS (
  SELECT source, unnest(generate_series(0, slots - 1)) AS slot, blocks, rank FROM quotas WHERE slots > 0
), passes AS (SELECT *, slot % blocks AS i, rank + slot // blocks + 1 AS choice FROM times),
primes AS (SELECT [8388593, 8388587, 8388581, 8388571, 8388547, 8388539]::BIGINT[] AS p),
used AS (
  SELECT source, ((CASE WHEN blocks % p[choice % 6 + 1] <> 0 THEN p[choice % 6 + 1]
                        ELSE p[(choice + 1) % 6 + 1] END) * i + 7919 * choice) % blocks AS block, count(*) AS times
  FROM passes, primes GROUP BY ALL
), pieces AS (
  SELECT source, doc_id, size, start, unnest(generate_series(start // 64, (start + size - 1) // 64)) AS block
  FROM placed WHERE size > 0
), taken AS (
  SELECT p.source, p.start,
         sum((least(start + size, (p.block + 1) * 64) - greatest(start, p.block * 64)) * times) AS taken
  FROM pieces p JOIN used u ON p.source IS NOT DISTINCT FROM u.source AND p.block = u.block GROUP BY 1, 2
)
SELECT d.doc_id, d.size, CAST(q.source_size AS BIGINT) AS source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM placed d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
LEFT JOIN taken t ON d.source IS NOT DISTINCT FROM t.source AND d.start = t.start AND d.size > 0
"""
QUERIES = {"op2_source_mix": op2_source_mix}
ORACLE_SQL = {"op2_source_mix": SQL}
