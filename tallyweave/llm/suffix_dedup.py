"""Suffix-array dedup: bytes inside long strings that start more than once in the corpus.

1. Anchors.  The smallest hash of a short string in each ``match`` bytes is an anchor, the last one of
   equals.  It depends on those bytes alone, so equal strings of ``match`` bytes hold the same anchor at
   the same place, and what repeats is found among the neighbourhoods of equal anchors: the bytes in
   reach of a string of ``match`` bytes with the anchor.  Anchors that occur once go.
2. Equal neighbourhoods are one class, one weighted string of the index.  Members of a class of two and
   more repeat as a whole.
3. Of anchors with several classes, one text a class goes to a shard, dealt by anchor.  A shard builds a
   run-length index (:mod:`run_length_index`) and marks long matches from the samples at run ends.
   Neighbourhoods of one document that overlap in a shard are joined first: no position is there twice.
4. An anchor with more than ``MOST_CLASSES`` classes would fill a shard.  Its strings are counted by
   hashes instead: in blocks of starts, by the block's whole span and by what all its strings share, and
   in smaller blocks, at last one by one, only where neither settles it.

Defined cases: a null text is an empty one; texts shorter than ``match`` lose nothing; repeated
documents, also of one doc_id, count as elsewhere for each other; an empty table gives an empty result;
further columns are left out.  Neighbourhoods count as equal by 64-bit hashes.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.rows import may_be_in, numbered, real_id
from tallyweave.llm.run_length_index import RunLengthIndex
from tallyweave.llm.texts import (
    column_of,
    mixed,
    prefix_hash,
    range_hash,
    text_bytes,
    text_chunks,
    text_of,
    tidy,
    tidy_group,
)
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

MATCH = 400
MOST_CLASSES = 2048
SHARD_BYTES = 1 << 20
BLOCK_STARTS = (24, 4)  # neighbouring starts of a block, pass by pass; then single ones
PIECE_BYTES = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def _anchor_bytes(match: int) -> int:
    """Length of the strings that are hashed for anchors: shorter ones are too common, longer ones too many."""
    return max(1, match * 8 // 25)


def anchors(data: np.ndarray, offsets: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in the texts of a piece of less than 16 MB, and their hashes."""
    short = _anchor_bytes(match)
    n = len(data) - short + 1
    window = match - short + 1
    if len(data) < match:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = prefix_hash(data)
    begin = np.arange(n)
    grams = range_hash(total, begin, begin + short)
    # The place in the low bits, falling, makes the smallest value the last of equal hashes.
    value = (grams & ~_PLACE) | (_PLACE - begin.astype(np.uint64))
    blocks = -(-n // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = value
    square = padded.reshape(blocks, window)
    from_left = np.minimum.accumulate(square, axis=1).ravel()
    from_right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - window + 1
    least = np.minimum(from_right[:starts], from_left[window - 1 : window - 1 + starts])
    # Strings that run across the end of a text are none.
    inside = np.arange(starts) + match <= offsets[text_of(np.arange(starts), offsets) + 1]
    places = np.unique((_PLACE - (least[inside] & _PLACE)).astype(np.int64))
    return places, grams[places]


def _anchor_rows(data: np.ndarray, offsets: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """Text, place, begin and end of the neighbourhood (within the text), anchor and class."""
    places, grams = anchors(data, offsets, match)
    texts = text_of(places, offsets)
    start, stop = offsets[texts], offsets[texts + 1]
    begin = np.maximum(start, places - (match - _anchor_bytes(match)))
    end = np.minimum(stop, places + match)
    total = prefix_hash(data)
    around = range_hash(total, begin, end)
    kind = mixed(around * np.uint64(3) + (places - begin).astype(np.uint64))
    return texts, places - start, begin - start, end - start, grams.view(np.int64), kind.view(np.int64)


_ANCHORS = "doc_id bigint, copy int, place bigint, begin bigint, end bigint, anchor bigint, class bigint"


def _find_anchors(match: int):
    names = [c.split()[0] for c in _ANCHORS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = column_of(batch, "doc_id").cast(pa.int64()), column_of(batch, "copy")
            for first, _, data, offsets in text_chunks(column_of(batch, "text")):
                if len(data) <= PIECE_BYTES:
                    texts, *columns = _anchor_rows(data, offsets, match)
                else:  # one long text, in pieces that overlap so far that no string or neighbourhood is cut
                    margin = 2 * match
                    parts = []
                    for a in range(0, len(data), PIECE_BYTES):
                        left, right = max(0, a - margin), min(len(data), a + PIECE_BYTES + margin)
                        part = _anchor_rows(data[left:right], np.array([0, right - left]), match)
                        mine = (part[1] + left >= a) & (part[1] + left < a + PIECE_BYTES)
                        parts.append([part[0][mine], *[c[mine] + left for c in part[1:4]], *[c[mine] for c in part[4:]]])
                    texts, *columns = [np.concatenate(c) for c in zip(*parts)]
                rows = pa.array(first + texts)
                yield pa.RecordBatch.from_arrays([ids.take(rows), copies.take(rows), *map(pa.array, columns)], names)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shard of a document the joined neighbourhoods and their bytes."""
    names = ["shard", "doc_id", "copy", "begin", "piece"]
    for batch in batches:
        data, offsets = text_bytes(column_of(batch, "text"))
        out: list[list] = [[], [], [], [], []]
        rows = zip(column_of(batch, "doc_id").to_pylist(), column_of(batch, "copy").to_pylist(), column_of(batch, "wanted").to_pylist())
        for i, (doc_id, copy, wanted) in enumerate(rows):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            joined: list[list[int]] = []
            for w in sorted(wanted, key=lambda w: (w["shard"], w["begin"])):
                if joined and joined[-1][0] == w["shard"] and w["begin"] < joined[-1][2]:
                    joined[-1][2] = max(joined[-1][2], w["end"])
                else:
                    joined.append([w["shard"], w["begin"], w["end"]])
            for shard, begin, end in joined:
                for column, value in zip(out, (shard, doc_id, copy, begin, text[begin:end])):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


_SPANS = "doc_id bigint, copy int, begin bigint, end bigint"


def _index_shard(match: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        index = RunLengthIndex([bytes(p) for p in rows["piece"]])
        begin, end = index.repeats(match)
        row = np.searchsorted(index.starts, begin, "right") - 1
        shift = rows["begin"].to_numpy()[row] - index.starts[row]
        columns = {"doc_id": rows["doc_id"].to_numpy()[row], "copy": rows["copy"].to_numpy()[row]}
        return pd.DataFrame({**columns, "begin": begin + shift, "end": end + shift})

    return run


_RANGES = "doc_id bigint, copy int, anchor bigint, origin bigint, begin bigint, end bigint, whole bigint, core bigint"


def _hash_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each wanted range (begin to end) and of its core (core to stop)."""
    names = [c.split()[0] for c in _RANGES.split(", ")]
    for batch in batches:
        ids, copies = column_of(batch, "doc_id").to_pylist(), column_of(batch, "copy").to_pylist()
        out: list[list] = [[] for _ in names]
        data, offsets = text_bytes(column_of(batch, "text"))
        for i, ranges in enumerate(column_of(batch, "wanted").to_pylist()):
            total = prefix_hash(data[offsets[i] : offsets[i + 1]])
            fields = ("salt", "begin", "end", "core", "stop", "anchor", "origin")
            salt, begin, end, core, stop, anchor, origin = (np.array([w[k] for w in ranges], np.int64) for k in fields)
            salt = salt.view(np.uint64)
            whole = mixed(range_hash(total, begin, end) ^ salt).view(np.int64)
            middle = mixed(range_hash(total, core, stop) ^ salt).view(np.int64)
            n = len(ranges)
            for column, value in zip(out, ([ids[i]] * n, [copies[i]] * n, anchor, origin, begin, end, whole, middle)):
                column.extend(value)
        kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 6)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents with the list of what is wanted of them, which their length bounds."""
    fields = [c for c in wanted.columns if c not in ("doc_id", "copy")]
    lists = wanted.groupBy("doc_id", "copy").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    lists = written(lists, "wanted")
    return may_be_in(docs, lists).where("listed").drop("listed").join(lists, ["doc_id", "copy"])


def _ranges(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return written(_with_texts(docs, wanted).mapInArrow(tidy(_hash_ranges), _RANGES), "ranges")


def _twice(rows: DataFrame, column: str) -> DataFrame:
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(column)
    return written(counts, "twice")


def _hot_spans(docs: DataFrame, hot: DataFrame, match: int) -> DataFrame:
    """Spans of the classes of hot anchors, by counting their strings without gathering an anchor's.

    Strings are told apart by where they start around the anchor, so only equally placed ones are
    compared and no string meets itself.  Blocks of neighbouring starts get smaller from pass to pass.
    A block whose whole content is there twice is settled.  All strings of a block share its core, also
    where the end of a text cuts the block short, so a block whose core is there once is settled too.
    """
    reach = match - _anchor_bytes(match)
    rows = hot.where(F.col("end") - F.col("begin") >= match)
    rows = rows.select("doc_id", "copy", "anchor", (F.col("place") - reach).alias("origin"), "begin", "end")
    columns = ["doc_id", "copy", "anchor", "origin", "begin", "end"]
    steps = sorted({min(step, max(1, match // 4)) for step in BLOCK_STARTS} | {1}, reverse=True)
    found = None
    for step in steps:
        first = F.floor((F.col("begin") - F.col("origin")) / step)
        last = F.floor((F.col("end") - match - F.col("origin")) / step)
        blocks = rows.withColumn("block", F.explode(F.sequence(first, last)))
        start = F.col("origin") + F.col("block") * step
        blocks = blocks.select(
            "doc_id",
            "copy",
            "anchor",
            "origin",
            F.xxhash64("anchor", F.lit(step), "block").alias("salt"),
            F.greatest("begin", start).alias("begin"),
            F.least("end", start + step - 1 + match).alias("end"),
            (start + step - 1).alias("core"),
            (start + match).alias("stop"),
        )
        full = _ranges(docs, blocks)
        whole = _twice(full, "whole")
        settled = written(full.join(whole, "whole"), "settled")
        found = settled.select("doc_id", "copy", "begin", "end") if found is None else found.unionByName(
            settled.select("doc_id", "copy", "begin", "end")
        )
        if step == 1:
            break
        undecided = full.join(whole, "whole", "left_anti").join(_twice(full, "core"), "core")
        undecided = written(undecided, "undecided")
        # Settled blocks go on as what undecided strings may equal: one block of each content.
        beside = settled.join(written(undecided.select("core").distinct(), "cores"), "core")
        beside = beside.dropDuplicates(["core", "whole"])
        rows = undecided.select(*columns).unionByName(beside.select(*columns))
    return found


def repeated_spans(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """doc_id, copy, begin and end (bytes) of spans that together cover every repeated string.

    ``docs`` has doc_id, copy and text; a document with nothing repeated has no row.
    """
    found = written(docs.mapInArrow(tidy(_find_anchors(match)), _ANCHORS), "anchors")
    often = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    found = written(found.join(written(often, "repeated-anchors"), "anchor"), "shared-anchors")
    classes = found.groupBy("anchor", "class").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("doc_id", "copy", "place", "begin", "end")).alias("one")
    )
    classes = written(classes, "classes")
    equal = classes.where("members > 1").select("anchor", "class")
    direct = found.join(written(equal, "equal-classes"), ["anchor", "class"]).where(F.col("end") - F.col("begin") >= match)
    direct = direct.select("doc_id", "copy", "begin", "end")

    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    several = written(several, "several-classes")
    texts = classes.join(several, "anchor").select("anchor", "classes", "one.*")
    texts = written(texts, "index-texts")
    plain = texts.where(F.col("classes") <= MOST_CLASSES)
    size = plain.agg(F.sum(F.col("end") - F.col("begin"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    plain = plain.select("doc_id", "copy", F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "begin", "end")
    pieces = _with_texts(docs, plain).mapInArrow(tidy(_cut_out), "shard bigint, doc_id bigint, copy int, begin bigint, piece binary")
    indexed = pieces.groupBy("shard").applyInPandas(tidy_group(_index_shard(match)), _SPANS)
    spans = direct.unionByName(indexed)
    hot = texts.where(F.col("classes") > MOST_CLASSES)
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(docs, hot, match))
    return spans


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        data, offsets = text_bytes(column_of(batch, "text"))
        sizes, removed, counts, digests = [], [], [], []
        for i, spans in enumerate(column_of(batch, "spans").to_pylist()):
            text = memoryview(data[offsets[i] : offsets[i + 1]])
            runs = merged([(s["begin"], s["end"]) for s in spans or []])
            digest, at = hashlib.sha256(), 0
            for begin, end in runs:
                digest.update(text[at:begin])
                at = end
            digest.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(e - b for b, e in runs))
            counts.append(len(runs))
            digests.append(digest.hexdigest())
        columns = [pa.array(c, pa.int64()) for c in (sizes, removed, counts)]
        yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id").cast(pa.int64()), *columns, pa.array(digests)], names)


def remove_repeats(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    docs = numbered(docs.select("doc_id", "text"))
    spans = repeated_spans(docs, match)
    spans = spans.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = written(spans, "spans")
    split = may_be_in(docs, spans)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    cut = split.where("listed").join(spans, ["doc_id", "copy"], "left").select("doc_id", "text", "spans")
    whole = split.where("not listed").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
    out = whole.unionByName(cut.mapInArrow(tidy(_assemble), schema))
    return out.withColumn("doc_id", real_id())


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return remove_repeats(spread_small_scan(docs))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE_SQL: dict[str, str] = {}
