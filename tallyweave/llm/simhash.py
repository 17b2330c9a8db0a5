"""SimHash near duplicates: fingerprints joined with themselves along binary tries.

1. One scan takes the XXH64 of every word shingle, repeats included, and keeps for each bit whether more
   than half the hashes have it: a fingerprint of 64 bits.  Equal fingerprints are one node with the number
   of its documents, however many copies there are.
2. Two fingerprints that differ in up to ``budget`` bits agree on one of ``budget + 1`` blocks of bits at
   least.  For each block there is a trie that has its bits on top, so pairs of different nodes of those
   first levels need not be met: the budget allows them no error.  A pair counts in the first trie in which
   it meets.
3. A cell is a pair of trie nodes (or one node with itself) with the errors that the bits above have left.
   Within a cell the node pairs are traversed together, level by level: four pairs of children, one more
   differing bit for two of them, and a pair over the budget goes with all below it.  A cell above
   ``CELL_ROWS`` is not traversed in one task: a job takes all such cells ``STEP_BITS`` levels down and
   deals the fingerprints to the cells of their child pairs, again until cells are small enough.
4. Cells give the links of each member as a number and a spanning star, never all pairs; the components
   of the stars are the classes.

Defined cases: null, empty and white texts have fingerprint 0 and are linked like any other; a text with
fewer words than a shingle has one shingle, all its words.  Very long texts are hashed in blocks of
``BLOCK_SHINGLES``.  Rows of one doc_id are documents of their own; a null doc_id is one too but never a
component_id unless the whole component has null ids (then null).  An empty table gives an empty result;
further columns are left out.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.llm.texts import column_of, tidy, tidy_group
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import forget, written

SHINGLE = 3
SEED = 42
BUDGET = 2
BITS = 64
BLOCK_SHINGLES = 1 << 16
CELL_ROWS = 1 << 16
STEP_BITS = 6
BIN_ROWS = 1 << 17
FRONTIER = 1 << 18  # node pairs taken down a level at once
LEAF_PAIRS = 16


# --- fingerprints -----------------------------------------------------------------------------------


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split()  # of bytes: A-Z only, and blank with \x09-\x0D
    if not words:
        return 0
    said = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    held = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, len(starts), BLOCK_SHINGLES):
        block = slice(first, first + BLOCK_SHINGLES)
        places = zip(starts[block].tolist(), ends[block].tolist())
        hashes = np.array([digest(said[a:b], seed) for a, b in places], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        held += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * held > len(starts), bitorder="little").view(np.uint64)[0])


def _sign(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_of(batch, "text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", width, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(tidy(_sign(width, seed)), "doc_id bigint, fp bigint")


# --- tries --------------------------------------------------------------------------------------------


def block_widths(budget: int) -> list[int]:
    """Bits of each block, from the highest; one block more than there may be errors."""
    blocks = budget + 1
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def _rotated(fp, shift: int):
    return fp if shift == 0 else (fp << np.uint64(shift)) | (fp >> np.uint64(BITS - shift))


def trie_pairs(a: np.ndarray, b: np.ndarray, same: bool, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in a, in b) of the pairs that differ in up to ``budget`` bits below ``depth``.

    Both sides are sorted, different values that agree on the first ``depth`` bits within a side; with
    ``same`` they are one side and a pair comes once.  Node pairs wait on a stack and are taken down
    ``FRONTIER`` at a time, so memory does not follow their number.
    """
    whole = [np.array([x], np.int64) for x in (0, len(a), 0, len(b), 0)]
    stack = [(depth, whole)] if len(a) and len(b) else []
    below = np.uint64((1 << (BITS - depth)) - 1)
    while stack:
        depth, nodes = stack.pop()
        if len(nodes[0]) > FRONTIER:
            stack += [(depth, [x[i : i + FRONTIER] for x in nodes]) for i in range(0, len(nodes[0]), FRONTIER)]
            continue
        a0, a1, b0, b1, errors = nodes
        pairs = (a1 - a0) * (b1 - b0)
        leaf = (pairs <= LEAF_PAIRS) | (depth == BITS)
        if leaf.any():
            n, wide = pairs[leaf], (b1 - b0)[leaf]
            of = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            i, j = a0[leaf][of] + place // wide[of], b0[leaf][of] + place % wide[of]
            good = np.bitwise_count((a[i] ^ b[j]) & below) <= budget
            if same:
                good &= i < j
            if good.any():
                yield i[good], j[good]
        a0, a1, b0, b1, errors = (x[~leaf] for x in nodes)
        if not len(a0):
            continue
        bit = np.uint64(BITS - 1 - depth)
        mark = np.uint64(1) << bit
        am = np.searchsorted(a, (a[a0] >> bit << bit) | mark)
        bm = np.searchsorted(b, (b[b0] >> bit << bit) | mark)
        one_node = (a0 == b0) & (a1 == b1) if same else np.zeros(len(a0), bool)
        children = [(a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, errors + 1)]
        children.append(tuple(x[~one_node] for x in (am, a1, b0, bm, errors + 1)))
        down = [np.concatenate(x) for x in zip(*children)]
        keep = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= budget)
        if keep.any():
            stack.append((depth + 1, [x[keep] for x in down]))


def _join_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after linking u with v, a label being the least place of a component."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return labels
        u, v, least = u[apart], v[apart], np.minimum(a, b)[apart]
        np.minimum.at(labels, a[apart], least)
        np.minimum.at(labels, b[apart], least)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _linked(budget: int, shifts: list[int]):
    """node, root and number of linked documents of each member of a cell that has a link."""
    masks = [np.uint64(((1 << w) - 1) << (BITS - s - w)) for s, w in zip(shifts, block_widths(budget))]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, cell in rows.groupby("cell", sort=False):
            fp = cell["fp"].to_numpy().view(np.uint64)
            side, docs = cell["side"].to_numpy(), cell["docs"].to_numpy()
            trie, depth, left = (int(cell[c].iloc[0]) for c in ("trie", "depth", "budget"))
            value = _rotated(fp, shifts[trie])
            sides = [np.flatnonzero(side == s) for s in ((0, 0) if side[0] == 0 else (1, 2))]
            sides = [s[np.argsort(value[s])] for s in sides]
            labels, links = np.arange(len(fp)), np.zeros(len(fp), np.int64)
            for i, j in trie_pairs(*[value[s] for s in sides], bool(side[0] == 0), depth, left):
                i, j = sides[0][i], sides[1][j]
                differ = fp[i] ^ fp[j]
                first = np.ones(len(i), bool)
                for mask in masks[:trie]:
                    first &= (differ & mask) != 0
                i, j = i[first], j[first]
                np.add.at(links, i, docs[j])
                np.add.at(links, j, docs[i])
                labels = _join_labels(labels, i, j)
            met = np.flatnonzero(links)
            out.append((fp[met].view(np.int64), fp[labels[met]].view(np.int64), links[met]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pd.DataFrame(dict(zip(("node", "root", "links"), columns)))

    return run


def _top(value: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, (F.lit(BITS) - bits).cast("int"))


def _first_cells(nodes: DataFrame, budget: int) -> tuple[DataFrame, list[int]]:
    """Each node once a trie, in the cell of the block on top."""
    widths = block_widths(budget)
    shifts = [sum(widths[:i]) for i in range(len(widths))]
    tries = []
    for trie, (shift, width) in enumerate(zip(shifts, widths)):
        fp = F.col("fp")
        value = fp if shift == 0 else F.shiftleft(fp, shift).bitwiseOR(F.shiftrightunsigned(fp, BITS - shift))
        tries.append(F.struct(F.lit(trie).alias("trie"), F.lit(width).alias("depth"), value.alias("value")))
    rows = nodes.select("fp", "docs", F.explode(F.array(*tries)).alias("t")).select("fp", "docs", "t.*")
    cell = F.xxhash64("trie", _top(F.col("value"), F.col("depth")))
    return rows.select("fp", "docs", "trie", "depth", "value", F.lit(budget).alias("budget"), F.lit(0).alias("side"), cell.alias("cell")), shifts


def _child_cells(rows: DataFrame) -> DataFrame:
    """Members of big cells in the cells of their child node pairs, ``STEP_BITS`` levels down."""
    step = F.least(F.lit(STEP_BITS), F.lit(BITS) - F.col("depth"))
    own = F.call_function("shiftrightunsigned", F.call_function("shiftleft", F.col("value"), F.col("depth")), (F.lit(BITS) - step).cast("int"))
    masks = F.array(*[F.lit(m).cast("bigint") for m in range(1 << STEP_BITS)])
    fits = F.filter(masks, lambda m: (F.bit_count(m) <= F.col("budget")) & (m < F.call_function("shiftleft", F.lit(1).cast("bigint"), step)))
    rows = rows.withColumn("own", own).withColumn("step", step).withColumn("mask", F.explode(fits))
    other = F.col("own").bitwiseXOR(F.col("mask"))
    alone = F.col("side") == 0
    # One node with itself: children once with themselves, and pairs of children with the lower one left.
    left = F.when(alone, F.least("own", other)).when(F.col("side") == 1, F.col("own")).otherwise(other)
    right = F.when(alone, F.greatest("own", other)).when(F.col("side") == 1, other).otherwise(F.col("own"))
    side = F.when(alone & (F.col("mask") == 0), 0).when(alone, F.when(F.col("own") < other, 1).otherwise(2)).otherwise(F.col("side"))
    return rows.select(
        "fp",
        "docs",
        "trie",
        (F.col("depth") + F.col("step")).alias("depth"),
        "value",
        (F.col("budget") - F.bit_count("mask")).alias("budget"),
        side.alias("side"),
        F.xxhash64("cell", left, right).alias("cell"),
    )


def _small_cells(rows: DataFrame) -> DataFrame:
    """All cells that can hold a pair, none above ``CELL_ROWS`` unless its tries have no further level."""
    small = []
    while True:
        rows = written(rows, "trie-rows")
        sizes = rows.groupBy("cell").agg(
            F.count(F.lit(1)).alias("rows"), F.min("side").alias("least_side"), F.max("side").alias("most_side"), F.min("depth").alias("deep")
        )
        sizes = sizes.where((F.col("least_side") != F.col("most_side")) | ((F.col("least_side") == 0) & (F.col("rows") > 1)))
        big = (F.col("rows") > CELL_ROWS) & (F.col("deep") < BITS)
        sizes = written(sizes.select("cell", big.alias("big")), "trie-cells")
        known = rows.join(sizes, "cell")
        small.append(written(known.where("not big").drop("big"), "trie-leaves"))
        if sizes.where("big").isEmpty():
            forget(rows)
            break
        rows = _child_cells(known.where("big").drop("big"))
    out = small[0]
    for more in small[1:]:
        out = out.unionByName(more)
    return out


def similar_classes(signed: DataFrame, budget: int = BUDGET) -> DataFrame:
    """fp, component_id and n_links for every fingerprint of ``signed`` (doc_id, fp).

    component_id is the smallest doc_id reachable by links, n_links the number of other documents that a
    document of this fingerprint links with, those of the same fingerprint included.
    """
    nodes = signed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"))
    nodes = written(nodes, "fingerprints")
    rows, shifts = _first_cells(nodes.select("fp", "docs"), budget)
    cells = _small_cells(rows)
    bins = max(1, -(-cells.count() // BIN_ROWS))
    binned = cells.withColumn("bin", F.pmod(F.xxhash64("cell"), F.lit(bins)))
    links = binned.groupBy("bin").applyInPandas(tidy_group(_linked(budget, shifts)), "node bigint, root bigint, links bigint")
    links = written(links, "trie-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    linked = written(components(links.select(F.col("node").alias("u"), F.col("root").alias("v"))), "linked")
    first = nodes.join(linked, F.col("fp") == F.col("node")).groupBy("component").agg(F.min("least").alias("first"))
    first = linked.join(written(first, "first"), "component").select(F.col("node").alias("fp"), "first", F.lit(True).alias("grouped"))
    classes = nodes.join(first, "fp", "left").join(counts.withColumnRenamed("node", "fp"), "fp", "left")
    return classes.select(
        "fp",
        F.when(F.col("grouped"), F.col("first")).otherwise(F.col("least")).alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("docs") - 1).alias("n_links"),
    )


def similar_documents(docs: DataFrame, width: int = SHINGLE, seed: int = SEED, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and n_links of every document."""
    if not 0 <= budget < BITS:
        raise ValueError("a budget of 0 to 63 bits")
    signed = written(fingerprints(docs, width, seed), "signed")
    classes = written(similar_classes(signed, budget), "classes")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return signed.join(classes, "fp").select("doc_id", digits.alias("fingerprint"), "component_id", "n_links")


def op12_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return similar_documents(spread_small_scan(docs))


QUERIES = {"op12_simhash_dedup": op12_simhash_dedup}
ORACLE_SQL: dict[str, str] = {}  # SQL has no seeded XXH64; tests compare with brute force
