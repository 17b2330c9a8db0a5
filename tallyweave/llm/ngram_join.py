"""N-gram Jaccard join: documents linked by similar sets of word shingles, and their components.

1. One scan hashes every document's distinct shingles.  Documents of equal sets are one node, known by
   64 bits of the set's hash; a node of copies is as light as any other.  The same scan counts shingles
   in a fixed number of counters, summed over the whole corpus.
2. Shingles are ordered rare first by the counter they fall into, ties by hash: one total order for all
   documents.  A second scan emits each set's prefix, so that two sets with the wanted similarity share
   a prefix shingle.  Sets of ``BIG`` shingles and more, whose long prefixes would meet by chance, use
   compound tokens: the set is dealt to parts by hash, a token is all a part holds, and as one differing
   shingle changes one part only, similar sets share a token of their prefixes again.  Tokens of a single
   node go.
3. In the group of a shingle, length, positional and suffix filters (upper bounds of the overlap from the
   places of the shingle and from the numbers of shingles in cells of the hash) decide which nodes are
   candidates of each other.  Groups give a spanning forest of their candidates, never all pairs, and
   a group above ``GROUP_ROWS`` is cut into blocks that meet in cells.
4. Only nodes of one candidate component can be linked.  Their sets are fetched again and verified once
   for each pair by exact intersection, inside cells of bounded size; cells give spanning forests again,
   and the components of those are the result.

Defined cases: a null text or one without words has an empty set and is linked with nothing; a text of
fewer words than a shingle has one shingle, all its words; repeated documents, also of one doc_id, are in
one component by their equal sets; an empty table gives an empty result; further columns are left out.
Two different sets count as equal only if their 64-bit hashes meet.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.components import components, forest
from tallyweave.llm.rows import may_be_in, numbered, real_id, set_aside
from tallyweave.llm.texts import (
    LOWER,
    NOT_SPACE,
    column_of,
    mixed,
    prefix_hash,
    range_hash,
    spans,
    text_chunks,
    text_of,
    tidy,
    tidy_group,
)
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import forget, written

SHINGLE = 3
SIMILAR = (90, 100)  # at least 90 of 100: integers, so that equality is exact
COUNTER_BITS = 16
CELLS = 32
GROUP_ROWS = 1024
CELL_SHINGLES = 1 << 20
BIG = 200
# Shingles of a part, at least and less than twice as many on average, by the share of a set that a
# similar set may differ in: parts that hold any must outnumber those shingles by far.
PART_SHINGLES = ((0.12, 2.5), (0.27, 1.25))
BIN_ROWS = 50_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_FULL = 65535


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    begin, end = spans(NOT_SPACE[data], offsets)
    words = range_hash(prefix_hash(LOWER[data]), begin, end)
    texts = text_of(begin, offsets)
    first = np.searchsorted(texts, np.arange(len(offsets)))
    # Shingle i starts at word i; those that run into the next text are not used.
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for place in range(width):
        total += words[place : place + len(total)] * _FACTORS[place]
    shingles = mixed(total)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(shingles[a : b - width + 1])
        elif b > a:
            rest = np.uint64(b - a)
            yield mixed((words[a:b] * _FACTORS[: b - a]).sum(keepdims=True) + rest)
        else:
            yield np.zeros(0, np.uint64)


def _node(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _histogram(hashes: np.ndarray) -> bytes:
    counts = np.bincount((hashes & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return np.minimum(counts, _FULL).astype(np.uint16).tobytes()


_SIGNED = "doc_id bigint, copy int, n_shingles bigint, node bigint, cells binary, counter int, count bigint"


def _sign(width: int):
    """A row for each document; at the end of a task a row for each counter with a count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTER_BITS, np.int64)
        names = [c.split()[0] for c in _SIGNED.split(", ")]
        for batch in batches:
            sizes, nodes, cells = [], [], []
            for _, _, data, offsets in text_chunks(column_of(batch, "text")):
                for hashes in shingle_sets(data, offsets, width):
                    sizes.append(len(hashes))
                    nodes.append(_node(hashes) if len(hashes) else None)
                    cells.append(_histogram(hashes))
                    np.add.at(counters, (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), 1)
            columns = [column_of(batch, "doc_id").cast(pa.int64()), column_of(batch, "copy").cast(pa.int32())]
            columns += [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
            columns += [pa.array(cells, pa.binary()), pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
        used = np.flatnonzero(counters)
        columns = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())]
        columns += [pa.array(used.astype(np.int32)), pa.array(counters[used])]
        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def rare_first(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Hashes renamed so that their order is that of their counters, ties by the other bits: a bijection."""
    low = np.uint64(64 - COUNTER_BITS)
    return (ranks[(hashes >> low).astype(np.int64)] << low) | (hashes & ((np.uint64(1) << low) - np.uint64(1)))


def _least_overlap(total, similar: tuple[int, int]):
    """Smallest intersection of two sets of ``total`` elements together that is similar enough."""
    p, q = similar
    return -(-p * total // (p + q))


def single_prefix(hashes: np.ndarray, ranks: np.ndarray, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a set, n - ceil(similarity * n) + 1 of them, and their places."""
    p, q = similar
    n = len(hashes)
    size = n - (-(-p * n // q)) + 1
    names = rare_first(hashes, ranks)
    if size < n:
        names = np.partition(names, size - 1)[:size]
    return np.sort(names), np.arange(len(names), dtype=np.int32)


def compound_prefix(hashes: np.ndarray, ranks: np.ndarray, parts: int, differ: int) -> np.ndarray:
    """Tokens of ``differ + 1`` parts: two sets with up to ``differ`` shingles in one of them only share
    one, as each of those shingles changes one part.  The parts with most shingles come first, as what
    they hold is the rarest, then those with the rarest shingle."""
    part = (hashes >> np.uint64(20)) & np.uint64(parts - 1)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    content = np.add.reduceat(mixed(hashes[order]), first)
    tokens = mixed(content + (part[first] + np.uint64(parts)) * _FACTORS[0])
    rarest = np.minimum.reduceat(rare_first(hashes, ranks)[order], first)
    held = np.diff(np.append(first, len(part)))
    return tokens[np.lexsort((rarest, -held))[: differ + 1]]


def _level(n: int, part: float) -> int:
    return int(n / part).bit_length() - 1


def prefix_tokens(hashes: np.ndarray, ranks: np.ndarray, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of which two similar sets share one at least, and their places (0 for compound ones)."""
    p, q = similar
    n = len(hashes)
    part = next((size for share, size in PART_SHINGLES if q - p <= share * p), None)
    big = BIG if part else np.inf
    tokens, places = [], []
    if n * p < big * q:  # a similar set may be a small one
        single, place = single_prefix(hashes, ranks, similar)
        tokens.append(single)
        places.append(place)
    if n >= big:
        differ = (q - p) * n // p  # most that a similar set may differ in, either way
        for level in {_level(n, part), _level(max(BIG, -(-n * p // q)), part)}:
            tokens.append(compound_prefix(hashes, ranks, 1 << level, differ))
            places.append(np.zeros(len(tokens[-1]), np.int32))
    return np.concatenate(tokens), np.concatenate(places)


def _prefixes(width: int, similar: tuple[int, int], ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens, nodes, places = [], [], []
            for _, _, data, offsets in text_chunks(column_of(batch, "text")):
                for hashes in shingle_sets(data, offsets, width):
                    node = _node(hashes) if len(hashes) else None
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    token, place = prefix_tokens(hashes, ranks, similar)
                    tokens.append(token)
                    nodes.append(np.full(len(token), node))
                    places.append(place)
            if tokens:
                columns = [np.concatenate(tokens).view(np.int64), np.concatenate(nodes), np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "place"])

    return run


def _may_link(n: np.ndarray, place: np.ndarray, cells: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Which members of a token's group pass the length, positional and suffix filters with each other."""
    p, q = similar
    small, large = np.minimum.outer(n, n), np.maximum.outer(n, n)
    need = _least_overlap(np.add.outer(n, n), similar)
    after = np.minimum.outer(n - place, n - place)
    linked = (small * q >= p * large) & (np.minimum.outer(place, place) + after >= need)
    rows, columns = np.nonzero(np.triu(linked, 1))
    keep = np.zeros(len(rows), bool)
    for a in range(0, len(rows), 1 << 16):
        part = slice(a, a + (1 << 16))
        shared = np.minimum(cells[rows[part]], cells[columns[part]]).astype(np.int64)
        full = (shared == _FULL).any(axis=1)
        keep[part] = full | (shared.sum(axis=1) >= need[rows[part], columns[part]])
    out = np.zeros(linked.shape, bool)
    out[rows[keep], columns[keep]] = out[columns[keep], rows[keep]] = True
    return out


def _candidates(similar: tuple[int, int]):
    """Spanning forests of the candidates of each group of a bin."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["group", "node"], kind="stable")
        group, node = rows["group"].to_numpy(), rows["node"].to_numpy()
        n, place = rows["n_shingles"].to_numpy(), rows["place"].to_numpy().astype(np.int64)
        cells = np.frombuffer(b"".join(rows["cells"]), np.uint16).reshape(-1, CELLS)
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        ends = np.append(starts[1:], len(group))
        out_u, out_v = [], []
        # Groups of two, by far the most, all at once.
        twos = starts[ends - starts == 2]
        if len(twos):
            a, b = twos, twos + 1
            need = _least_overlap(n[a] + n[b], similar)
            ok = np.minimum(n[a], n[b]) * similar[1] >= similar[0] * np.maximum(n[a], n[b])
            ok &= np.minimum(place[a], place[b]) + np.minimum(n[a] - place[a], n[b] - place[b]) >= need
            shared = np.minimum(cells[a], cells[b]).astype(np.int64)
            ok &= (shared == _FULL).any(axis=1) | (shared.sum(axis=1) >= need)
            out_u.append(node[a[ok]])
            out_v.append(node[b[ok]])
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            edges = forest(_may_link(n[s:e], place[s:e], cells[s:e], similar))
            if edges:
                pairs = np.array(edges) + s
                out_u.append(node[pairs[:, 0]])
                out_v.append(node[pairs[:, 1]])
        if not out_u:
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        return pd.DataFrame({"u": np.concatenate(out_u), "v": np.concatenate(out_v)}).drop_duplicates()

    return run


def _in_cells(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Deal the nodes of a key to blocks and repeat them for each cell of two blocks; adds ``group``."""
    block = F.pmod(F.xxhash64("node"), F.col(blocks))
    rows = rows.withColumn("block", block)
    others = F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1)
    return (
        rows.withColumn("other", F.explode(others))
        .withColumn("group", F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other")))
        .drop("block", "other")
    )


def _candidate_edges(prefixes: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    groups = prefixes.groupBy("token").agg(
        F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    groups = groups.where("first <> last").select("token", F.ceil(F.col("rows") / GROUP_ROWS).cast("bigint").alias("blocks"))
    groups = written(groups, "shared-tokens")
    shared = prefixes.join(groups, "token").join(sets.select("node", "n_shingles", "cells"), "node")
    # Copies in different tasks repeat a node's rows.
    shared = written(_in_cells(shared.dropDuplicates(["token", "node"]), "token", "blocks"), "token-groups")
    bins = max(1, -(-shared.count() // BIN_ROWS))
    rows = shared.withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(bins)))
    rows = rows.select("bin", "group", "node", "place", "n_shingles", "cells")
    edges = rows.groupBy("bin").applyInPandas(tidy_group(_candidates(similar)), "u bigint, v bigint").distinct()
    edges = written(edges, "candidate-edges")
    forget(prefixes, groups, shared)
    return edges


def _fetch(width: int):
    """node and set of each document that stands for a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = column_of(batch, "node").to_pylist()
            nodes, sets = [], []
            for first, _, data, offsets in text_chunks(column_of(batch, "text")):
                for i, hashes in enumerate(shingle_sets(data, offsets, width), first):
                    if len(hashes) and _node(hashes) == wanted[i]:
                        nodes.append(wanted[i])
                        sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "hashes"])

    return run


def intersections(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slices of the elements."""
    values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    element = np.cumsum(new) - 1
    shared = np.bincount(element)[element] > 1  # an element of one set adds nothing
    element, owners = np.unique(element[shared], return_inverse=True)[1], owners[shared]
    out = np.zeros((len(sets), len(sets)))
    for first in range(0, int(element.max(initial=-1)) + 1, columns):
        a, b = np.searchsorted(element, [first, first + columns])
        slab = np.zeros((len(sets), columns), np.float32)
        slab[owners[a:b], element[a:b] - first] = 1
        out += slab @ slab.T
    return out.astype(np.int64)


def _verify(similar: tuple[int, int]):
    p, q = similar

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, cell in rows.groupby("group", sort=False):
            cell = cell.drop_duplicates("node")
            nodes = cell["node"].to_numpy()
            if len(nodes) < 2:
                continue
            sets = [np.frombuffer(h, np.uint64) for h in cell["hashes"]]
            sizes = np.array([len(s) for s in sets])
            both = intersections(sets)
            linked = q * both >= p * (np.add.outer(sizes, sizes) - both)
            np.fill_diagonal(linked, False)
            edges += [(nodes[a], nodes[b]) for a, b in forest(linked)]
        return pd.DataFrame(edges, columns=["u", "v"], dtype="int64")

    return run


def _verified_edges(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """Links between the nodes of a candidate component that hold exactly, as spanning forests."""
    members = nodes.join(clusters, "node").select("node", "component", "one.doc_id", "one.copy", "n_shingles")
    members = written(members, "members")
    sizes = members.groupBy("component").agg(F.sum("n_shingles").alias("all"), F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("all") / CELL_SHINGLES), F.ceil(F.col("n") / GROUP_ROWS)).cast("bigint")
    sizes = written(sizes.select("component", "all", blocks.alias("blocks")), "cluster-sizes")
    total = sizes.agg(F.sum(F.col("all") * F.col("blocks"))).first()[0] or 0
    bins = max(1, -(-total // CELL_SHINGLES))
    texts = may_be_in(docs, members).where("listed").join(members.select("doc_id", "copy", "node"), ["doc_id", "copy"])
    sets = texts.select("node", "text").mapInArrow(tidy(_fetch(width)), "node bigint, hashes binary")
    rows = members.select("node", "component").join(sizes.select("component", "blocks"), "component")
    rows = written(rows.join(written(sets, "sets"), "node"), "cluster-sets")
    rows = _in_cells(rows, "component", "blocks").withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(bins)))
    return rows.select("bin", "group", "node", "hashes").groupBy("bin").applyInPandas(tidy_group(_verify(similar)), "u bigint, v bigint")


def similar_classes(docs: DataFrame, width: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, copy, n_shingles and ``least``, the first (doc_id, copy) reachable by links, of every document.

    ``docs`` has doc_id, copy and text.  Two documents link when
    ``similar[1] * intersection >= similar[0] * union`` of their shingle sets.
    """
    if not 1 <= width <= len(_FACTORS) or not 0 < similar[0] <= similar[1]:
        raise ValueError("one to five words a shingle, similarity above 0 and up to 1")
    docs = docs.select("doc_id", "copy", "text")
    signed = written(docs.mapInArrow(tidy(_sign(width)), _SIGNED), "signed")
    rows = signed.where(F.col("counter").isNull())
    counts = signed.where(F.col("counter").isNotNull()).groupBy("counter").agg(F.sum("count").alias("count"))
    counters = np.zeros(1 << COUNTER_BITS, np.int64)  # as many as there are counters, whatever the corpus
    for row in counts.collect():
        counters[row["counter"]] = row["count"]
    ranks = np.empty(len(counters), np.uint64)
    ranks[np.argsort(counters, kind="stable")] = np.arange(len(counters), dtype=np.uint64)

    own = F.struct("doc_id", "copy")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min(own).alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("cells").alias("cells")
    )
    nodes = written(nodes, "nodes")
    prefixes = docs.mapInArrow(tidy(_prefixes(width, similar, ranks)), "token bigint, node bigint, place int")
    prefixes = written(prefixes, "prefixes")
    clusters = components(_candidate_edges(prefixes, nodes, similar))
    linked = written(components(_verified_edges(docs, nodes, clusters, width, similar)), "linked")
    first = nodes.select("node", "one").join(linked, "node").groupBy("component").agg(F.min("one").alias("least"))
    first = linked.join(written(first, "first"), "component").select("node", "least")
    classes = nodes.select("node", "one").join(first, "node", "left")
    classes = written(classes.select("node", F.coalesce("least", "one").alias("least")), "classes")
    return rows.join(classes, "node", "left").select("doc_id", "copy", "n_shingles", F.coalesce("least", own).alias("least"))


def similar_documents(docs: DataFrame, width: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document."""
    classes = similar_classes(numbered(docs.select("doc_id", "text")), width, similar)
    return classes.select(real_id(), "n_shingles", real_id("least.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The documents, all columns as they are, without those linked to one of a smaller doc_id."""
    docs, back = set_aside(docs, ["doc_id", "text"])
    rows = numbered(docs)
    classes = similar_classes(rows, width, similar)
    gone = written(classes.where(F.struct("doc_id", "copy") != F.col("least")).select("doc_id", "copy"), "similar")
    split = may_be_in(rows, gone)
    kept = split.where("listed").join(gone, ["doc_id", "copy"], "left_anti")
    kept = split.where("not listed").select(*docs.columns).unionByName(kept.select(*docs.columns))
    return back(kept.withColumn("doc_id", real_id().cast(docs.schema["doc_id"].dataType)))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return similar_documents(spread_small_scan(docs))


SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT row_id, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), rows AS (SELECT row_id, len(s) AS n, unnest(s) AS g FROM sets),
both_sides AS (
  SELECT a.row_id AS a, b.row_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k
  FROM rows a JOIN rows b ON a.g = b.g AND a.row_id < b.row_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY 1, 2
), links AS (SELECT a, b FROM both_sides WHERE 100 * k >= 90 * (n + m - k)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r AS (SELECT row_id AS a, row_id AS b FROM sets UNION SELECT r.a, e.b FROM r JOIN either e ON r.b = e.a)
  SELECT a, min(doc_id) AS component_id FROM r JOIN sets ON b = row_id GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN reach ON a = row_id
"""
QUERIES = {"op9_ngram_join": op9_ngram_join}
ORACLE_SQL = {"op9_ngram_join": SQL}
