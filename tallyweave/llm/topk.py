"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are dealt to shards.  In a shard, a posting is one component of one vector, its impact the size
of the component; impacts are quantised to powers of two times the shard's smallest step, and the
postings of each impact level form a segment.  Segments are processed by descending impact: each adds
its exact products to the accumulators of all queries at once.  What is still unprocessed of a vector
adds at most |query| * |rest of the vector| to a score (Cauchy-Schwarz), so once a query's k-th best
lower bound passes another vector's upper bound, that vector is out.  A query stops only when few
possible members are left or all segments are done; those left are rescored in 64-bit integers.

Queries are compared with every shard in blocks.  Each cell of a query block and a shard is one task of
bounded size, and only k rows a query and cell go on to the final ranking.

Defined cases: a vector that is null, empty or holds a null or a non-finite component takes no part,
neither as query nor as candidate; vectors of different length compare as if padded with zeros; rows of
one vec_id are vectors of their own, a query leaves out its own row only; ties go to the smaller
vec_id; an empty table gives an empty result; further columns are left out.  Integer components must
keep the score within 64 bits.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 5
SHARD_ROWS = 16384
QUERY_ROWS = 4096
POSSIBLE = 64  # so few possible members of a query are rescored instead of processing on
_TILE = 256  # queries of a cell at a time
_EXACT = 2.0**53

_SCHEMA = "query_id long, query_copy int, vec_id long, copy int, score long"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def impact_segments(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The postings of each impact level, highest first, each with what then remains of every vector.

    A segment is the matrix of its postings, 0 elsewhere; what remains is the Euclidean norm.
    """
    size = np.abs(x)
    level = np.where(size > 0, 1 + np.log2(np.maximum(size, 1)).astype(np.int64), 0)
    # The lowest levels carry little: one segment.
    top = int(level.max(initial=0))
    floor = max(1, top - 4)
    segments = []
    for at in range(top, floor - 1, -1):
        chosen = level == at if at > floor else (level > 0) & (level <= floor)
        rest = np.where(level < at, x, 0) if at > floor else np.zeros_like(x)
        segments.append((np.where(chosen, x, 0).astype(np.float64), np.sqrt((rest.astype(np.float64) ** 2).sum(1))))
    return segments


def _best(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, segments: list) -> list[np.ndarray]:
    """For each query the rows of its k best vectors; ``own`` is the row of the query itself, or -1."""
    n = len(x)
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    scores = np.zeros((len(q), n))
    out: list[np.ndarray | None] = [None] * len(q)
    open_queries = np.arange(len(q))
    for place, (segment, rest) in enumerate(segments or [(np.zeros(x.shape), np.zeros(n))]):
        scores[open_queries] += q[open_queries].astype(np.float64) @ segment.T
        last = place >= len(segments) - 1
        still = []
        for i in open_queries.tolist():
            slack = norms[i] * rest * (1 + 1e-9) + 1e-6 * (rest > 0)
            low = scores[i] - slack
            if own[i] >= 0:
                low[own[i]] = -np.inf
            kth = np.partition(low, n - k)[n - k] if n > k else -np.inf
            possible = np.flatnonzero(scores[i] + slack >= kth)
            if not last and len(possible) > max(POSSIBLE, 4 * k):
                still.append(i)
                continue
            possible = possible[possible != own[i]]
            exact = x[possible] @ q[i]
            out[i] = possible[np.lexsort((ids[possible], -exact))[:k]]
        open_queries = np.array(still, np.int64)
        if not len(open_queries):
            break
    return out


def _cell(k: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({c.split()[0]: [] for c in _SCHEMA.split(", ")})
        width = max(queries["vector"].map(len).max(), vectors["vector"].map(len).max())
        # By id, so that ties in a row order are ties in favour of the smaller id.
        vectors = vectors.sort_values(["vec_id", "copy"], ignore_index=True)
        x, q = _matrix(vectors["vector"], width), _matrix(queries["vector"], width)
        ids, copies = vectors["vec_id"].to_numpy(), vectors["copy"].to_numpy()
        row_of = {key: row for row, key in enumerate(zip(ids.tolist(), copies.tolist()))}
        own = np.array([row_of.get(key, -1) for key in zip(queries["vec_id"].tolist(), queries["copy"].tolist())])
        segments = impact_segments(x)
        reach = np.abs(q).max(initial=0).astype(float) * np.abs(x).max(initial=0) * width
        if reach >= _EXACT:  # sums of products leave the exact range of doubles: rescore all
            segments = []
        parts = []
        for first in range(0, len(q), _TILE):
            tile = slice(first, first + _TILE)
            if segments:
                best = _best(q[tile], x, own[tile], ids, k, segments)
            else:
                best = []
                for query, mine in zip(q[tile], own[tile]):
                    exact = x @ query
                    order = np.lexsort((ids, -exact))
                    best.append(order[order != mine][:k])
            for i, rows in enumerate(best):
                at = first + i
                parts.append(
                    pd.DataFrame(
                        {
                            "query_id": queries["vec_id"].iat[at],
                            "query_copy": queries["copy"].iat[at],
                            "vec_id": ids[rows],
                            "copy": copies[rows],
                            "score": x[rows] @ q[at],
                        }
                    )
                )
        return pd.concat(parts)

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = K, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the k best vectors of every row for which ``queries`` holds.

    ``vectors`` has vec_id and embedding.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select("vec_id", "embedding", queries.alias("asks")).where(
        F.col("vec_id").isNotNull() & whole & (F.size("embedding") > 0)
    )
    # Rows of one id are told apart by a number; ids are few to a key unless a table repeats them.
    number = Window.partitionBy("vec_id").orderBy(F.xxhash64("embedding"), "embedding")
    rows = rows.select(
        "vec_id",
        (F.row_number().over(number) - 1).alias("copy"),
        quantised(F.col("embedding"), scale).alias("vector"),
        F.coalesce("asks", F.lit(False)).alias("asks"),
    )
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(queries, 1)).alias("asking")).first()
    shards, blocks = max(1, -(-sizes["n"] // SHARD_ROWS)), max(1, -(-sizes["asking"] // QUERY_ROWS))
    mixed = F.xxhash64("vec_id", "copy")
    asked = rows.where("asks").select(
        "vec_id",
        "copy",
        "vector",
        F.pmod(mixed, F.lit(blocks)).alias("block"),
        _each(shards).alias("shard"),
    )
    held = rows.select(
        "vec_id",
        "copy",
        "vector",
        _each(blocks).alias("block"),
        F.pmod(mixed, F.lit(shards)).alias("shard"),
    )
    found = (
        asked.groupBy("block", "shard").cogroup(held.groupBy("block", "shard")).applyInPandas(_cell(k), _SCHEMA)
    )
    order = Window.partitionBy("query_id", "query_copy").orderBy(F.col("score").desc(), "vec_id", "copy")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row_id, a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1] * p[2], 0)))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row_id <> b.row_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
QUERIES = {"op6_top_k": op6_top_k}
ORACLE_SQL = {"op6_top_k": SQL}
