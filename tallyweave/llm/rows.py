"""Telling the rows of a table apart, and leaving out early what a join would leave out late."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.storage import written

_WORD_BITS = 32
FILTER_BITS = 1 << 22
NO_ID = -(2**63)  # stands for a null doc_id inside an operator, so that joins meet it; first in order


def numbered(docs: DataFrame) -> DataFrame:
    """Add ``copy``: 0, and a further number for each further row of the same doc_id, by a hash of the text.

    A null doc_id becomes NO_ID; :func:`real_id` takes that back.
    """
    docs = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID).cast("bigint")))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated = written(repeated, "repeated-ids")
    if repeated.isEmpty():
        return docs.withColumn("copy", F.lit(0))
    number = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.md5("text"))
    again = docs.join(repeated, "doc_id", "left_semi").withColumn("copy", F.row_number().over(number) - 1)
    single = docs.join(repeated, "doc_id", "left_anti").withColumn("copy", F.lit(0))
    return written(single.unionByName(again), "numbered")


def real_id(doc_id: str = "doc_id") -> Column:
    return F.nullif(F.col(doc_id), F.lit(NO_ID).cast("bigint")).alias(doc_id.split(".")[-1])


def set_aside(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but those ``used`` under names nothing else has, and the way back."""
    names = {name: name if name in used else f"extra_{i}_" for i, name in enumerate(docs.columns)}
    out = docs.toDF(*names.values())

    def back(df: DataFrame) -> DataFrame:
        return df.select(*names.values()).toDF(*names)

    return out, back


def _bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def may_be_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``listed``: false only where doc_id is certainly not in ``ids``.

    A bit map of fixed size, whatever the number of ids, so it may be broadcast; texts that no join
    needs then stay where they are.
    """
    word = F.floor(_bit(F.col("doc_id")) / _WORD_BITS).cast("int")
    bit = (_bit(F.col("doc_id")) % _WORD_BITS).cast("int")
    marks = ids.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mark"))
    marks = written(marks.groupBy("word").agg(F.bit_or("mark").alias("marks")), "bit-map")
    found = docs.withColumn("word", word).join(F.broadcast(marks), "word", "left")
    listed = F.call_function("shiftright", F.coalesce("marks", F.lit(0).cast("bigint")), bit).bitwiseAND(F.lit(1)) == 1
    return found.withColumn("listed", listed).drop("word", "marks")
