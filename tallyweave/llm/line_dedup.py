"""Line dedup: a line goes when an equal line, or one within one edit, stands earlier in the corpus.

Lines are ordered by doc_id, then by their place in the document.  An edit inserts, deletes or replaces
one code point.  Two least lengths in code points: ``least_chars`` for the match within one edit, and
``exact_chars`` for equal lines, below ``least_chars`` only of lines that are not blank.  ``dedup_lines``,
op3 and its SQL twin remove equal lines of every length; ``removed_lines`` takes ``LEAST_CHARS`` for both
unless told otherwise.

1. Equal lines, by 128 bits of hash, become one row with their first place; map-side, so a line that
   a third of the documents share is a few rows.
2. One edit leaves one half of a line as it is.  Lines emit the hashes of their halves, for their own
   length and the next smaller one; a line that shares no half with a different line is done.
3. The other lines emit their deletion neighbourhood: each line without one code point, hashed.  Two
   lines of one length are within one edit when they agree after deleting the same place; a line is
   within one edit of a shorter one when one of its deletions is that line.  So a group of equal variants
   needs only its earliest line, never pairs of its members.  A line's hash is the exclusive or of a hash
   of each place and its code point; a deletion keeps what stands before the place and moves what stands
   behind it by one, so all variants of a line come from two running values, in time linear in its length.
4. Every pair found is verified on the texts: they are equal once the place found is deleted.

Defined cases: a null text has no lines, an empty one has one line that stays; equal documents lose their
lines to the first of them; rows of one doc_id are ordered by a hash of their text; an empty table gives
an empty result; a very long line has as many variants as code points, and only a line that shares a half
with another has them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.rows import may_be_in, numbered, real_id, set_aside
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import forget, written

LEAST_CHARS = 20
EVERY_LENGTH = 1
_PIECE = 256  # code points hashed as one array; a longer line is several of them
_MARK = r"[^\x09-\x0D\x20]"  # a line or text with none is blank
_PLACE = ("doc_id", "copy", "line_no")


def _lines(docs: DataFrame, least_chars: int, exact_chars: int) -> DataFrame:
    cut = docs.select("doc_id", "copy", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    n = F.length("line")
    return cut.where((n >= least_chars) | ((n >= exact_chars) & F.col("line").rlike(_MARK))).select(
        *_PLACE, "line", n.alias("n"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the halves of a line as it is, and as the longer of two lines."""

    def halves(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [
            F.xxhash64(length, F.lit("first"), F.substring(line, F.lit(1), half)),
            F.xxhash64(length, F.lit("last"), F.substring(line, n - (length - half) + 1, length - half)),
        ]

    return F.array(*halves(n), *halves(n - 1))


def _variants(near: DataFrame) -> DataFrame:
    """One row for each place deleted (``at`` from 0) with the hash of what is left; ``at`` = n is the whole line.

    With a(j) = hash(j, c) and b(j) = hash(j - 1, c), the line without place i hashes to the exclusive or of
    a(0..i-1) and b(i+1..n-1).  Pieces hold b(i) and all a and b before i; the rest of the line's b is added last.
    """

    def marks(piece: Column, k: Column) -> Column:
        def mark(c: Column, j: Column) -> Column:
            return F.struct(F.xxhash64(k * _PIECE + j, c).alias("a"), F.xxhash64(k * _PIECE + j - 1, c).alias("b"))

        return F.transform(F.split(piece, ""), mark)

    zero = F.lit(0).cast("bigint")

    def place(acc: Column, x: Column) -> Column:
        v = F.concat(acc.v, F.array(acc.ab.bitwiseXOR(x.b)))
        return F.struct(v.alias("v"), acc.ab.bitwiseXOR(x.a).bitwiseXOR(x.b).alias("ab"), acc.b.bitwiseXOR(x.b).alias("b"))

    def piece(text: Column, k: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("v"), zero.alias("ab"), zero.alias("b"))
        return F.aggregate(marks(text, k), start, place)

    def carry(acc: Column, x: Column) -> Column:  # numbers only: an accumulator is copied at every step
        return F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x)))

    pieces = F.regexp_extract_all("line", F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    line = near.select("h1", "h2", "first", "n", F.transform(pieces, piece).alias("pieces"))
    ends = F.array(F.struct(F.array(zero).alias("v"), zero.alias("ab"), zero.alias("b")))
    rest = F.aggregate("pieces.b", zero, lambda acc, x: acc.bitwiseXOR(x)).alias("b")
    carried = F.aggregate("pieces.ab", F.array(zero), carry).alias("carried")
    line = line.select("h1", "h2", "first", "n", rest, F.arrays_zip(F.concat("pieces", ends).alias("piece"), carried).alias("out"))
    parts = line.select("h1", "h2", "first", "n", "b", F.posexplode_outer("out").alias("k", "part"))
    last = F.ceil(F.col("n") / _PIECE) == F.col("k")
    begin = F.when(last, F.col("n")).otherwise(F.col("k") * _PIECE)
    parts = parts.select("h1", "h2", "first", "n", begin.alias("begin"), F.col("part.carried").bitwiseXOR(F.col("b")).alias("rest"), "part.piece.v")
    each = parts.select("h1", "h2", "first", "n", "begin", "rest", F.posexplode_outer("v").alias("j", "mark"))
    at, variant = F.col("begin") + F.col("j"), F.col("mark").bitwiseXOR(F.col("rest"))
    return each.select("h1", "h2", "first", "n", at.cast("int").alias("at"), variant.alias("variant"))


def _without(text: str, at: Column) -> Column:
    return F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + 2, F.length(text)))


def _near_lines(docs: DataFrame, distinct: DataFrame, least_chars: int) -> DataFrame:
    """h1 and h2 of the lines within one edit of a line with an earlier first place."""
    keys = distinct.select("h1", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("half")
    lone = keys.join(written(shared, "shared-halves"), "half").select("h1").distinct()
    some = distinct.select("h1", "h2", "first").join(written(lone, "candidates"), "h1")
    some = written(some.select("h1", "h2", "first.*"), "candidate-places")
    held = may_be_in(docs, some).where("listed")
    lines = _lines(held, least_chars, least_chars).select(*_PLACE, "line", "n")
    near = lines.join(some, list(_PLACE)).select("h1", "h2", F.struct(*_PLACE).alias("first"), "line", "n")
    near = written(near, "candidate-lines")

    written_variants = written(_variants(near), "variants")
    variants, whole = written_variants.where("at < n"), written_variants.where("at = n")
    # Same length, same place deleted: all lines of the group differ there only.
    groups = variants.groupBy("n", "at", "variant").agg(
        F.min(F.struct("first", "h1", "h2")).alias("least"), F.count(F.lit(1)).alias("lines")
    )
    groups = written(groups.where("lines > 1").drop("lines"), "variant-groups")
    replaced = variants.join(groups, ["n", "at", "variant"]).where("least.first < first")
    replaced = replaced.select("h1", "h2", F.col("least.h1").alias("e1"), F.col("least.h2").alias("e2"), "at")
    # A deletion that is a whole line.
    whole = whole.select((F.col("n") + 1).alias("n"), "variant", "first", "h1", "h2")
    whole = whole.toDF("n", "variant", "short_first", "s1", "s2")
    both = variants.join(whole, ["n", "variant"])
    long_goes = F.col("short_first") < F.col("first")
    shorter = both.select(
        F.when(long_goes, F.col("h1")).otherwise(F.col("s1")).alias("h1"),
        F.when(long_goes, F.col("h2")).otherwise(F.col("s2")).alias("h2"),
        F.when(long_goes, F.col("s1")).otherwise(F.col("h1")).alias("e1"),
        F.when(long_goes, F.col("s2")).otherwise(F.col("h2")).alias("e2"),
        "at",
    )
    # In a run of equal letters each place gives the same pair; one of them is enough.
    pairs = replaced.unionByName(shorter).groupBy("h1", "h2", "e1", "e2").agg(F.min("at").alias("at"))
    pairs = written(pairs, "line-pairs")
    forget(written_variants, groups)
    texts = near.select("h1", "h2", "line")
    earlier = near.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("earlier"))
    checked = pairs.join(texts, ["h1", "h2"]).join(earlier, ["e1", "e2"])
    n, m = F.length("line"), F.length("earlier")
    one, other = _without("line", F.col("at")), _without("earlier", F.col("at"))
    equal = F.when(n == m, one == other).when(n > m, one == F.col("earlier")).otherwise(F.col("line") == other)
    return checked.where(equal).select("h1", "h2").distinct()


def _removed(docs: DataFrame, least_chars: int, exact_chars: int) -> DataFrame:
    """doc_id, copy and the places of the lines that go, for documents that lose any."""
    lines = _lines(docs, least_chars, exact_chars)
    lines = lines.withColumn("halves", F.when(F.col("n") >= least_chars, _half_keys(F.col("line"), F.col("n"))))
    lines = written(lines.drop("line", "n"), "lines")
    distinct = lines.groupBy("h1", "h2").agg(F.min(F.struct(*_PLACE)).alias("first"), F.first("halves").alias("halves"))
    distinct = written(distinct, "distinct-lines")
    near = written(_near_lines(docs, distinct, least_chars).withColumn("near", F.lit(True)), "near-lines")
    firsts = distinct.drop("halves").join(near, ["h1", "h2"], "left")
    firsts = written(firsts, "first-lines")
    gone = lines.drop("halves").join(firsts, ["h1", "h2"]).where(F.col("near").isNotNull() | (F.struct(*_PLACE) > F.col("first")))
    return gone.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))


def removed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, exact_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (places from 0, comma-joined) of every document."""
    docs = numbered(docs.select("doc_id", "text"))
    removed = written(_removed(docs, least_chars, exact_chars), "removed")
    sizes = docs.select("doc_id", "copy", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    sizes = sizes.withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("bigint"))
    none = F.array().cast("array<int>")
    return sizes.join(removed, ["doc_id", "copy"], "left").select(
        real_id(),
        "n_lines",
        F.size(F.coalesce("removed", none)).cast("bigint").alias("n_removed"),
        F.array_join(F.coalesce("removed", none), ",").alias("removed_lines"),
    )


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, exact_chars: int = EVERY_LENGTH) -> DataFrame:
    """The documents without the lines that go; one that loses its last line that is not blank goes too.

    ``n_chars``, where there is such a column, follows the text.
    """
    docs, back = set_aside(docs, ["doc_id", "text", "n_chars"])
    rows = numbered(docs)
    removed = written(_removed(rows.select("doc_id", "copy", "text"), least_chars, exact_chars), "removed")
    split = may_be_in(rows, removed)
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    cut = F.col("removed").isNotNull()
    out = split.where("listed").join(removed, ["doc_id", "copy"], "left")
    out = out.withColumn("text", F.when(cut, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    out = out.where(~cut | F.col("text").rlike(_MARK)).select(*docs.columns)
    out = split.where("not listed").select(*docs.columns).unionByName(out)
    return back(out.withColumn("doc_id", real_id().cast(docs.schema["doc_id"].dataType)))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return removed_lines(spread_small_scan(docs), exact_chars=EVERY_LENGTH)


SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id) - 1 AS copy,
         coalesce(string_split(text, chr(10)), []) AS l FROM documents
), lines AS (
  SELECT doc_id, copy, line_no, line, length(line) AS n
  FROM (SELECT doc_id, copy, unnest(l) AS line, unnest(generate_series(0, len(l) - 1)) AS line_no FROM docs)
  WHERE length(line) >= 20 OR regexp_matches(line, '[^\x20\x09-\x0D]')
), firsts AS (
  SELECT line, any_value(n) AS n, min((doc_id, copy, line_no)) AS first, string_split(line, '') AS c FROM lines GROUP BY line
), halves AS (  -- one edit leaves one half alone
  SELECT line, first, n, c, k, 1 AS side, left(line, k // 2) AS half FROM firsts, unnest([n, n - 1]) AS t(k) WHERE n >= 20
  UNION ALL
  SELECT line, first, n, c, k, 2, right(line, k - k // 2) FROM firsts, unnest([n, n - 1]) AS t(k) WHERE n >= 20
), pairs AS (
  SELECT a.line, a.c AS x, b.c AS y, a.n AS n, b.n AS m,
         coalesce(list_position(list_transform(generate_series(1, least(a.n, b.n)), lambda i: a.c[i] = b.c[i]), false),
                  least(a.n, b.n) + 1) AS p
  FROM halves a JOIN halves b USING (k, side, half) WHERE b.n BETWEEN a.n - 1 AND a.n + 1 AND b.first < a.first
), near AS (
  SELECT DISTINCT line FROM pairs WHERE
    CASE WHEN n = m THEN x[p + 1:] = y[p + 1:] WHEN n > m THEN x[p + 1:] = y[p:] ELSE x[p:] = y[p + 1:] END
), gone AS (
  SELECT l.doc_id, l.copy, l.line_no FROM lines l JOIN firsts f ON l.line = f.line
  WHERE (l.doc_id, l.copy, l.line_no) > f.first OR l.line IN (SELECT line FROM near)
), removed AS (
  SELECT doc_id, copy, count(*) AS n_removed, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed_lines
  FROM gone GROUP BY ALL
)
SELECT doc_id, len(l)::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM docs LEFT JOIN removed USING (doc_id, copy)
"""
QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLE_SQL = {"op3_line_dedup": SQL}
