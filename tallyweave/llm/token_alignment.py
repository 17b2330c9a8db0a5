"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes, counted externally.

1. One scan encodes each text by both tokenizers, cuts it where tokens of both end, and takes every pair of
   token ids that share a group.  A chunk of documents (about ``CHUNK_BYTES`` of text) sorts its records
   (pair, document, how often) by radix part of the first id, first id, second id, document, and spills a
   run a part: blocks of zstd, the pairs with their numbers of documents apart from the documents.
2. Runs of a part are merged ``FAN_IN`` at a time, block by block through a heap, and counts of equal pairs
   are added, until one run a part is left.  A pair is in a run once, however many documents hold it, and
   a merged run cannot be longer than there are pairs of ids; so no id and no pair is too hot for a task.
3. First-id-major order gives the highest count of a first id as the merged run is read.  Parts and batches
   of ``BATCH_CHUNKS`` chunks meet, each run takes its counts, and what they add to each document goes
   back as one small array a run; the arrays of a chunk are added up.

Tokenizer files are read by the driver, a few megabytes whatever the corpus, and broadcast.

Defined cases: a null or empty text, and one whose tokens do not give its bytes back, has no tokens, all
zeros and an empty groups_sha256.  Special tokens' strings inside a text are plain text.  Repeated rows and
rows of one doc_id, null ones too, are documents of their own.  An empty table gives an empty result;
further columns are left out.  A text is encoded as a whole, so a task's memory follows its longest text
beside the chunk.  A group of many tokens is taken as its different ids with numbers, and piece by piece.
"""

import hashlib
import heapq
import json
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.texts import column_of, tidy, tidy_group
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 21
CHUNK_DOCS = 1 << 14
PARTS = 32
FAN_IN = 64
BATCH_CHUNKS = 64
BLOCK_PAIRS = 1 << 14
WIDE_GROUP = 4096  # links of a group above which its equal ids are folded first
LINKS_AT_ONCE = 1 << 21
# Bits of a sorted record: part, first id, second id, document of the chunk.
DOC_BITS, ID_BITS = 14, 20

# Fixed value: how the byte-level tokenizer splits text before it merges bytes.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- tokenizers -----------------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones as they are, others above 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        described = json.loads(byte_bpe)
        special = {token["content"] for token in described["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): i for piece, i in described["model"]["vocab"].items() if piece not in special
        }
        self._first = tiktoken.Encoding("byte-bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._second = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        self.first_bytes = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.first_bytes[i] = piece
        self.second_bytes = []
        for i in range(self._second.get_piece_size()):
            piece = self._second.id_to_piece(i)
            self.second_bytes.append(bytes([int(piece[3:5], 16)]) if self._second.is_byte(i) else piece.replace("▁", " ").encode())
        self.first_lengths = np.array([len(b) for b in self.first_bytes], np.int64)
        self.second_lengths = np.array([len(b) for b in self.second_bytes], np.int64)
        ids = max(len(self.first_bytes), len(self.second_bytes))
        if ids > 1 << ID_BITS:
            raise ValueError(f"vocabularies of up to {1 << ID_BITS} ids")
        # The decimal of each id with what may follow it; see _groups_text.
        self.written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(ids)]
        self.ids = ids

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both, or none where their bytes are not blank and text."""
        if not text:
            return [], []
        first, second = self._first.encode_ordinary(" " + text), self._second.encode(text)
        whole = (" " + text).encode()
        for ids, pieces in ((first, self.first_bytes), (second, self.second_bytes)):
            if b"".join(map(pieces.__getitem__, ids)) != whole:
                return [], []
        return first, second


def _vocabulary(files: Broadcast) -> Vocabulary:
    """The tokenizers of a worker, made once in its life."""
    kept = sys.modules.setdefault("_tallyweave_vocabularies", types.ModuleType("_tallyweave_vocabularies")).__dict__
    key = hashlib.sha256(b"".join(files.value)).hexdigest()
    if key not in kept:
        kept[key] = Vocabulary(*files.value)
    return kept[key]


def tokenizer_files(spark: SparkSession, folder: str = TOKENIZERS) -> Broadcast:
    """The two files of the tokenizers: of fixed size, so they may be broadcast."""
    contents = []
    for name in (BYTE_BPE, PIECE_BPE):
        with open(f"{folder}/{name}", "rb") as file:
            contents.append(file.read())
    return spark.sparkContext.broadcast(tuple(contents))


# --- runs -------------------------------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    """One block: arrays of unsigned numbers in their least width, as a zstd frame."""
    body = b""
    for array in arrays:
        array = array.astype(np.min_scalar_type(int(array.max(initial=0))))
        body += struct.pack("<cI", array.dtype.char.encode(), len(array)) + array.tobytes()
    frame = zstandard.ZstdCompressor(level=1).compress(body)
    return struct.pack("<I", len(frame)) + frame


def _blocks(run: bytes) -> Iterator[list[np.ndarray]]:
    """The arrays of each block of a run, one block in memory at a time."""
    at, size = 0, struct.calcsize("<cI")
    while at < len(run):
        (length,) = struct.unpack_from("<I", run, at)
        body = zstandard.ZstdDecompressor().decompress(run[at + 4 : at + 4 + length])
        at += 4 + length
        arrays, inside = [], 0
        while inside < len(body):
            kind, count = struct.unpack_from("<cI", body, inside)
            array = np.frombuffer(body, kind.decode(), count, inside + size)
            inside += size + array.nbytes
            arrays.append(array.astype(np.int64))
        yield arrays


def pairs_run(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs and their counts."""
    cuts = range(0, len(pairs), BLOCK_PAIRS)
    parts = ((pairs[i : i + BLOCK_PAIRS], counts[i : i + BLOCK_PAIRS]) for i in cuts)
    return b"".join(_packed(p[:1], np.diff(p), c) for p, c in parts)


def read_pairs(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for first, steps, counts in _blocks(run):
        yield np.cumsum(np.concatenate((first, steps))), counts


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in order with the sums of their counts, from a block of each run at a time.

    A heap holds the last pair of each run's block: up to the least of them every run is at hand.
    """
    readers = [read_pairs(run) for run in runs]
    held: list = [next(reader, None) for reader in readers]
    heap = [(int(block[0][-1]), i) for i, block in enumerate(held) if block is not None]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        pairs, counts = [], []
        for i, block in enumerate(held):
            if block is None:
                continue
            cut = int(np.searchsorted(block[0], bound, "right"))
            pairs.append(block[0][:cut])
            counts.append(block[1][:cut])
            held[i] = (block[0][cut:], block[1][cut:])
        while heap and heap[0][0] <= bound:
            _, i = heapq.heappop(heap)
            held[i] = next(readers[i], None)
            if held[i] is not None:
                heapq.heappush(heap, (int(held[i][0][-1]), i))
        yield _summed(np.concatenate(pairs), np.concatenate(counts))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One run from those of a group."""
    blocks = []
    for pairs, counts in merged(rows["pairs"].tolist()):
        blocks.append(pairs_run(pairs, counts))
    return pd.DataFrame({"part": rows["part"].iloc[:1], "chunk": rows["chunk"].iloc[:1], "pairs": [b"".join(blocks)]})


# --- alignment ----------------------------------------------------------------------------------------------


class Alignment:
    """The groups of some encoded documents: per document numbers, and records of linked ids."""

    def __init__(self, vocabulary: Vocabulary, encoded: list[tuple[list[int], list[int]]]):
        self._vocabulary = vocabulary
        self.docs = len(encoded)
        self.n_first = np.array([len(a) for a, _ in encoded], np.int64)
        self.n_second = np.array([len(b) for _, b in encoded], np.int64)
        self.first = np.array([i for a, _ in encoded for i in a], np.int64)
        self.second = np.array([i for _, b in encoded for i in b], np.int64)
        # Both sides of a document have the same bytes, so ends count on from document to document alike.
        ends, others = np.cumsum(vocabulary.first_lengths[self.first]), np.cumsum(vocabulary.second_lengths[self.second])
        at = np.searchsorted(others, ends)
        meets = others[at] == ends if len(others) else np.zeros(0, bool)
        second_meets = np.zeros(len(others), bool)
        second_meets[at[meets]] = True
        self.group_of_first = np.cumsum(meets) - meets
        self.group_of_second = np.cumsum(second_meets) - second_meets
        self.in_first = np.bincount(self.group_of_first).astype(np.int64)
        self.in_second = np.bincount(self.group_of_second).astype(np.int64)
        self._doc_of_first = np.repeat(np.arange(self.docs), self.n_first)
        self.doc_of_group = self._doc_of_first[meets]
        self.n_groups = np.bincount(self.doc_of_group, minlength=self.docs)
        self.n_links = np.zeros(self.docs, np.int64)
        np.add.at(self.n_links, self.doc_of_group, self.in_first * self.in_second)

    def groups_texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        ids = self._vocabulary.ids
        ends_first = np.cumsum(self.in_first) - 1
        ends_second = np.cumsum(self.in_second) - 1
        size = len(self.first) + len(self.second)
        keys = np.empty(size, np.int64)
        # Of each group the first ids, then the second; marks: "," within a side, "|" between, ";" or nothing after.
        first, second = self.first.copy(), self.second.copy()
        first[ends_first] += ids
        second[ends_second] += 2 * ids
        keys[np.arange(len(first)) + (np.cumsum(self.in_second) - self.in_second)[self.group_of_first]] = first
        keys[np.arange(len(second)) + np.cumsum(self.in_first)[self.group_of_second]] = second
        bounds = np.cumsum(self.n_first + self.n_second)
        filled = (self.n_first + self.n_second) > 0
        keys[bounds[filled] - 1] += ids
        texts, items, at = self._vocabulary.written, keys.tolist(), 0
        out = []
        for end in bounds.tolist():
            out.append("".join(map(texts.__getitem__, items[at:end])))
            at = end
        return out

    def records(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted (part, first id, second id, document) keys and how often the document links the pair."""
        head = ((((self.first % parts) << ID_BITS) | self.first) << (ID_BITS + DOC_BITS)) | self._doc_of_first
        tail = self.second << DOC_BITS
        starts = np.cumsum(self.in_second) - self.in_second
        links = self.in_first * self.in_second
        wide = links > WIDE_GROUP
        narrow = np.flatnonzero(~wide[self.group_of_first])  # places of first ids in ordinary groups
        wanted = self.in_second[self.group_of_first[narrow]]
        pieces = []
        ends = np.cumsum(wanted)
        done = 0
        while done < len(narrow):
            before = int(ends[done - 1]) if done else 0
            last = max(int(np.searchsorted(ends, before + LINKS_AT_ONCE, "right")), done + 1)
            i, n = narrow[done:last], wanted[done:last]
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            keys = np.repeat(head[i], n) + tail[np.repeat(starts[self.group_of_first[i]], n) + place]
            keys.sort()
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            pieces.append((keys[new], np.diff(np.append(new, len(keys)))))
            done = last
        begins = np.cumsum(self.in_first) - self.in_first
        for group in np.flatnonzero(wide).tolist():
            a, times_a = np.unique(head[begins[group] : begins[group] + self.in_first[group]], return_counts=True)
            b, times_b = np.unique(tail[starts[group] : starts[group] + self.in_second[group]], return_counts=True)
            for i in range(0, len(a), step := max(1, LINKS_AT_ONCE // len(b))):
                keys = np.add.outer(a[i : i + step], b).ravel()
                pieces.append((keys, np.multiply.outer(times_a[i : i + step], times_b).ravel()))
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return pieces[0] if len(pieces) == 1 else _summed(*map(np.concatenate, zip(*pieces)))


def chunk_runs(keys: np.ndarray, times: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, run of pairs, run of documents) of sorted records."""
    pairs, docs = keys >> DOC_BITS, keys & ((1 << DOC_BITS) - 1)
    edges = np.searchsorted(pairs, np.arange(parts + 1, dtype=np.int64) << (2 * ID_BITS))
    for part, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if a == b:
            continue
        own = pairs[a:b]
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        counts = np.diff(np.append(starts, b - a))
        yield part, pairs_run(own[starts] & ((1 << (2 * ID_BITS)) - 1), counts), _packed(docs[a:b], times[a:b])


_ALIGNED = (
    "chunk bigint, part int, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs binary, docs binary"
)
_TYPES = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()]


def _batch(columns: dict, rows: int) -> pa.RecordBatch:
    names = [field.split()[0] for field in _ALIGNED.split(", ")]
    arrays = [pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in zip(names, _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _align(files: Broadcast, parts: int, chunk_bytes: int):
    """A row for each document and a row for each run, told apart by ``part``."""

    def chunk_rows(chunk: int, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(files)
        found = Alignment(vocabulary, [vocabulary.encode(text) for text in texts])
        hashes = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.groups_texts()]
        columns = {"chunk": [chunk] * len(ids), "place": range(len(ids)), "doc_id": ids, "groups_sha256": hashes}
        columns |= {"n_a": found.n_first, "n_b": found.n_second, "n_groups": found.n_groups, "n_links": found.n_links}
        yield _batch(columns, len(ids))
        runs = list(chunk_runs(*found.records(parts), parts))
        if runs:
            part, pairs, docs = zip(*runs)
            yield _batch({"chunk": [chunk] * len(runs), "part": part, "pairs": pairs, "docs": docs}, len(runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(column_of(batch, "doc_id").to_pylist(), column_of(batch, "text")):
                text = text.as_py()
                if ids and (size + len(text or "") > chunk_bytes or len(ids) == CHUNK_DOCS):
                    yield from chunk_rows(chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
        if ids:
            yield from chunk_rows(chunk, ids, texts)

    return run


_ADDED = "chunk bigint, added binary"


def _contributions(key, runs: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """What the records of each run add to n_best and count_sum of their documents."""
    if not len(runs):
        return pd.DataFrame({"chunk": pd.Series(dtype="int64"), "added": pd.Series(dtype=object)})
    pairs, counts = map(np.concatenate, zip(*read_pairs(counted["pairs"].iloc[0])))
    # First-id-major order: the counts of a first id stand together.
    first = pairs >> ID_BITS
    starts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    most = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(first))))
    best = (counts == most).astype(np.int64)
    out = []
    for run, docs in zip(runs["pairs"], runs["docs"]):
        own, holders = map(np.concatenate, zip(*read_pairs(run)))
        ((doc, times),) = _blocks(docs)
        at = np.repeat(np.searchsorted(pairs, own), holders)
        sums = np.zeros((2, int(doc.max()) + 1), np.int64)
        np.add.at(sums[0], doc, times * best[at])
        np.add.at(sums[1], doc, times * counts[at])
        out.append(_packed(*sums))
    return pd.DataFrame({"chunk": runs["chunk"].to_numpy(), "added": out})


def _added_up(rows: pd.DataFrame) -> pd.DataFrame:
    found = [next(_blocks(added)) for added in rows["added"]]
    size = max(len(best) for best, _ in found)
    sums = np.zeros((2, size), np.int64)
    for best, count in found:
        sums[0, : len(best)] += best
        sums[1, : len(count)] += count
    chunk = np.full(size, rows["chunk"].iloc[0])
    return pd.DataFrame({"chunk": chunk, "place": np.arange(size), "n_best": sums[0], "count_sum": sums[1]})


def merged_counts(runs: DataFrame) -> DataFrame:
    """part and pairs: one run for each part, from any number of runs (part, chunk, pairs)."""
    level = runs.select("part", "chunk", "pairs")
    while True:
        most = level.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return level.select("part", "pairs")
        groups = -(-most // FAN_IN)
        group = F.pmod(F.xxhash64("chunk"), F.lit(groups))
        level = level.withColumn("group", group).groupBy("part", "group")
        level = written(level.applyInPandas(tidy_group(_merge), "part int, chunk bigint, pairs binary"), "merged-runs")


class TokenAlignment:
    """The alignment of the texts of ``docs`` (doc_id, text): ``documents`` and ``pair_counts``."""

    def __init__(self, docs: DataFrame, files: Broadcast, parts: int = PARTS, chunk_bytes: int = CHUNK_BYTES):
        docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        aligned = written(docs.mapInArrow(tidy(_align(files, parts, chunk_bytes)), _ALIGNED), "aligned")
        self._rows = aligned.where("part is null")
        self._runs = aligned.where("part is not null").select("part", "chunk", "pairs", "docs")
        self._counted = merged_counts(self._runs)

    @property
    def pair_counts(self) -> DataFrame:
        """a, b and n, the number of documents that link a token a of the first with b of the second tokenizer."""

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run in column_of(batch, "pairs").to_pylist():
                    for pairs, counts in read_pairs(run):
                        columns = (pairs >> ID_BITS, pairs & ((1 << ID_BITS) - 1), counts)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n"])

        return self._counted.select("pairs").mapInArrow(listed, "a bigint, b bigint, n bigint")

    @property
    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
        chunks = self._runs.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        batches = max(1, -(-chunks // BATCH_CHUNKS))
        runs = self._runs.withColumn("batch", F.pmod(F.xxhash64("chunk"), F.lit(batches)))
        counted = self._counted.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(batches - 1).cast("bigint"))))
        keys = ["part", "batch"]
        added = runs.groupBy(*keys).cogroup(counted.groupBy(*keys)).applyInPandas(_contributions, _ADDED)
        added = written(added, "contributions")
        sums = added.groupBy("chunk").applyInPandas(tidy_group(_added_up), "chunk bigint, place int, n_best bigint, count_sum bigint")
        zero = F.lit(0).cast("bigint")
        found = self._rows.join(written(sums, "document-sums"), ["chunk", "place"], "left")
        return found.select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            "groups_sha256",
        )


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return TokenAlignment(spread_small_scan(docs), tokenizer_files(spark)).documents


QUERIES = {"op11_token_alignment": op11_token_alignment}
ORACLE_SQL: dict[str, str] = {}  # SQL has no tokenizers; tests compare with brute force
