"""Benchmark decontamination: test phrases found in training shards by backward search.

A window is ten consecutive words of a benchmark item, or all words of a shorter one.  A shard, a run
of documents inside a task, becomes an FM-index over word numbers.  Only stretches in which every two
neighbouring words are neighbours in some item can hold a window, so the rest of the text stays out of
the index.  All windows are searched backwards at once through wavelet-tree ranks, occurrences are
located by sampled suffix positions and their spans merged.  No document is moved between tasks.

The benchmark goes to the tasks in blocks of bounded size, one pass over a document's row for each.

Defined cases: a null or empty text, or one without words, has no hits; an item without words or
without id is never found; items of the same id are one item; repeated documents are judged row by
row; an empty benchmark hits nothing; further columns are left out of :func:`contamination` and kept
by :func:`decontaminate`.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.fm_index import FMIndex
from tallyweave.llm.rows import set_aside
from tallyweave.llm.texts import (
    ALNUM,
    LOWER,
    column_of,
    found_in,
    hash_bytes,
    prefix_hash,
    range_hash,
    spans,
    text_chunks,
    text_of,
    tidy,
)
from tallyweave.sources.scans import spread_small_scan

WINDOW = 10
BLOCK_BYTES = 16 << 20  # of benchmark text that a task holds at a time
SHARD_BYTES = 1 << 20

_SEPARATORS = bytes(b for b in range(256) if not ALNUM[b])
_TO_WORDS = bytes(32 if b in _SEPARATORS else int(LOWER[b]) for b in range(256))


@dataclass
class Phrases:
    """The windows of a block of benchmark items, as rows of word numbers from 1 that end at the right."""

    words: np.ndarray  # sorted hashes of the words; a word's number is its place plus 1
    pairs: np.ndarray  # sorted codes of neighbouring words
    windows: np.ndarray
    lengths: np.ndarray
    owners: list[list[int]]  # item ids of each window

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else WINDOW


def phrases(items: list[tuple[int, str]], window: int = WINDOW) -> Phrases:
    texts = [(i, t.encode().translate(_TO_WORDS).split()) for i, t in items if i is not None and t is not None]
    vocabulary = sorted({w for _, words in texts for w in words})
    hashes = hash_bytes(vocabulary)
    known = np.unique(hashes)
    number = dict(zip(vocabulary, (np.searchsorted(known, hashes) + 1).tolist()))
    owners: dict[tuple[int, ...], set[int]] = {}
    pairs = set()
    for item, words in texts:
        numbers = [number[w] for w in words]
        pairs.update(a * (len(known) + 1) + b for a, b in zip(numbers, numbers[1:]))
        width = min(window, len(numbers))
        for i in range(len(numbers) - width + 1 if width else 0):
            owners.setdefault(tuple(numbers[i : i + width]), set()).add(item)
    rows = np.zeros((len(owners), window), np.int64)
    lengths = np.zeros(len(owners), np.int64)
    for i, key in enumerate(owners):
        rows[i, window - len(key) :] = key
        lengths[i] = len(key)
    return Phrases(known, np.array(sorted(pairs), np.int64), rows, lengths, [sorted(v) for v in owners.values()])


def find(data: np.ndarray, offsets: np.ndarray, sought: Phrases) -> tuple[np.ndarray, ...]:
    """Words of a shard (begin, end, text), which of them are hit, and (text, window) of occurrences."""
    begin, end = spans(ALNUM[data], offsets)
    texts = text_of(begin, offsets)
    hit = np.zeros(len(begin), bool)
    none = np.zeros(0, np.int64)
    if not len(sought.windows) or not len(begin):
        return begin, end, texts, hit, none, none
    numbers = found_in(sought.words, range_hash(prefix_hash(LOWER[data]), begin, end)) + 1
    # joined[i]: word i and the next one stand side by side in some item, and in one text here.
    joined = np.zeros(len(begin), bool)
    near = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0) & (texts[:-1] == texts[1:]))
    codes = numbers[near] * (len(sought.words) + 1) + numbers[near + 1]
    joined[near[found_in(sought.pairs, codes) >= 0]] = True
    starts = np.flatnonzero((numbers > 0) & ~np.concatenate(([False], joined[:-1])))
    # A stretch ends at its first word that is not joined to the next.
    ends = np.flatnonzero((numbers > 0) & ~joined) + 1
    long = ends - starts >= sought.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return begin, end, texts, hit, none, none
    # The stretches one after another, each followed by a symbol that no window has.
    size = ends - starts + 1
    place = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    gap = np.cumsum(size) - 1
    symbols = numbers[np.minimum(place, len(numbers) - 1)]
    symbols[gap] = len(sought.words) + 1
    index = FMIndex(symbols, len(sought.words) + 1)
    low, high = index.search(sought.windows, sought.lengths)
    count = high - low
    which = np.repeat(np.arange(len(low)), count)
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    at = place[index.locate(rows)]
    edges = np.zeros(len(begin) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + sought.lengths[which], -1)
    return begin, end, texts, np.cumsum(edges[:-1]) > 0, texts[at], which


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, each gathered on its own."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for block in range(count):
        rows = benchmark.where((part == block) & F.col("text").isNotNull()).select("item_id", "text").collect()
        yield [(row[0], row[1]) for row in rows]


def _marks(column: pa.Array, sought: Phrases) -> tuple[list[int], list[list[dict]], list[list[int]]]:
    """Number of words, merged hit spans (bytes and words) and items of every text."""
    n_words, found, items = [], [], []
    for first, last, data, offsets in text_chunks(column, SHARD_BYTES):
        begin, end, texts, hit, text, window = find(data, offsets, sought)
        n_words += np.bincount(texts, minlength=last - first).tolist()
        marks: list[list] = [[] for _ in range(last - first)]
        places = np.cumsum(np.bincount(texts, minlength=last - first)) - np.bincount(texts, minlength=last - first)
        run_begin = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1] & (texts[1:] == texts[:-1])))[: len(hit)])
        last_of = np.concatenate(((texts[1:] != texts[:-1]) | ~hit[1:], [True]))[: len(hit)]
        run_end = np.flatnonzero(hit & last_of)
        for b, e in zip(run_begin.tolist(), run_end.tolist()):
            t = int(texts[b])
            marks[t].append(
                {
                    "first": int(b - places[t]),
                    "last": int(e - places[t]) + 1,
                    "begin": int(begin[b] - offsets[t]),
                    "end": int(end[e] - offsets[t]),
                }
            )
        owned: list[set] = [set() for _ in range(last - first)]
        for t, w in zip(text.tolist(), window.tolist()):
            owned[t].update(sought.owners[w])
        found += marks
        items += [sorted(o) for o in owned]
    return n_words, found, items


def _search(sought: Phrases):
    """Adds a block's merged hit spans (bytes and words) and items to every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found, items = _marks(column_of(batch, "text"), sought)
            names, columns = list(batch.schema.names), list(batch.columns)
            span = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "begin", "end")]))
            added = {"n_words": pa.array(n_words, pa.int64()), "hits": pa.array(found, span)}
            added["items"] = pa.array(items, pa.list_(pa.int64()))
            for name, values in added.items():
                if name not in names:
                    names.append(name)
                    columns.append(values)
                    continue
                at = names.index(name)
                if name != "n_words":  # of an earlier block: both together
                    both = [a + b for a, b in zip(columns[at].to_pylist(), values.to_pylist())]
                    columns[at] = pa.array(both, values.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _searched(docs: DataFrame, sought: list[Phrases]) -> DataFrame:
    hit = T.StructType([T.StructField(k, T.LongType()) for k in ("first", "last", "begin", "end")])
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(hit)),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
    out = docs
    for block in sought:
        schema = T.StructType([*docs.schema.fields, *added])
        out = out.mapInArrow(tidy(_search(block)), schema)
    return out


def _merged(hits: list[dict], first: str, last: str) -> list[list[int]]:
    out: list[list[int]] = []
    for b, e in sorted((h[first], h[last]) for h in hits):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        n_hit, n_items, digests = [], [], []
        for hits, items in zip(column_of(batch, "hits").to_pylist(), column_of(batch, "items").to_pylist()):
            n_hit.append(sum(e - b for b, e in _merged(hits, "first", "last")) if hits else 0)
            names = sorted({str(i) for i in items})
            n_items.append(len(names))
            digests.append(hashlib.sha256(",".join(names).encode()).hexdigest() if names else nothing)
        yield pa.RecordBatch.from_arrays(
            [
                column_of(batch, "doc_id").cast(pa.int64()),
                column_of(batch, "n_words"),
                pa.array(n_hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array([n > 0 for n in n_hit], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    sought = [phrases(block, window) for block in _blocks(benchmark)]
    found = _searched(docs.select("doc_id", "text"), sought).drop("text")
    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return found.mapInArrow(tidy(_digest), schema)


def _without(text: str, hits: list[dict]) -> str:
    raw, at, kept = text.encode(), 0, []
    for b, e in _merged(hits, "begin", "end"):
        kept.append(raw[at:b])
        at = e
    return b"".join([*kept, raw[at:]]).decode()


def _cut(sought: list[Phrases]):
    """Cuts the hits, and what a cut brings together, until no window is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n not in ("n_words", "hits", "items")]
            hits = column_of(batch, "hits")
            if not pc.any(pc.greater(pc.list_value_length(hits), 0)).as_py():
                yield batch.select(names)
                continue
            columns = [column_of(batch, n) for n in names]
            texts, n_words = column_of(batch, "text").to_pylist(), column_of(batch, "n_words").to_pylist()
            counts = column_of(batch, "n_chars").to_pylist() if "n_chars" in names else None
            keep = [True] * len(texts)
            found = {i: row for i, row in enumerate(hits.to_pylist()) if row}
            while found:
                for i, row in found.items():
                    keep[i] = sum(e - b for b, e in _merged(row, "first", "last")) < n_words[i]
                    texts[i] = _without(texts[i], row)
                    if counts is not None:
                        counts[i] = len(texts[i])
                again = [i for i in found if keep[i]]
                changed, found = pa.array([texts[i] for i in again], pa.string()), {}
                for block in sought:
                    sizes, rows, _ = _marks(changed, block)
                    for i, size, row in zip(again, sizes, rows):
                        n_words[i] = size
                        if row:
                            found.setdefault(i, []).extend(row)
            columns[names.index("text")] = pa.array(texts, columns[names.index("text")].type)
            if counts is not None:
                columns[names.index("n_chars")] = pa.array(counts, columns[names.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with every hit span cut out of the text; one left without any word goes.

    Words that a cut brings together can be a window too, so a changed text is searched and cut again until
    nothing is hit.
    ``n_chars``, where there is such a column, follows the text.
    """
    docs, back = set_aside(docs, ["text", "n_chars"])
    sought = [phrases(block, window) for block in _blocks(benchmark)]
    return back(_searched(docs, sought).mapInArrow(tidy(_cut(sought)), docs.schema))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return contamination(spread_small_scan(docs), spark.read.parquet(f"{folder}/benchmark.parquet"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), at_items AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
  FROM items WHERE len(w) > 0
), windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM at_items),
at_docs AS (
  SELECT row_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), found AS (
  SELECT row_id, i, d.k, item_id FROM (SELECT row_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM at_docs) d
  JOIN windows v ON d.k = v.k AND d.s = v.s
), hits AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT row_id, unnest(generate_series(i, i + k - 1)) AS p FROM found) GROUP BY 1
), owners AS (
  SELECT row_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS id FROM found) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_id) LEFT JOIN owners USING (row_id)
"""
QUERIES = {"op7_decontamination": op7_decontamination}
ORACLE_SQL = {"op7_decontamination": SQL}
