"""The item-item model kept between builds: new ratings change it without pairing the old ones again.

The model holds the latest rating of every user and business, clustered by user, and the moments of every
pair of businesses that users of at most ``heavy_user`` ratings rated, clustered by the first one.  Moments are sums
over users, so a batch of ratings changes them by the pairs that hold a changed rating: what the pair adds
now less what it added before.  Heavier users have no pairs in the model; their part is computed with the
edges, by blocks (:mod:`tallyweave.operators.products`).

Defined cases: a rating repeated or older than the known one changes nothing; equally late ones leave the
highest; a user who becomes heavy takes their pairs out of the model; ratings without a user or business
are kept and form no pairs; an empty batch leaves the model as it is.  Sums of half-star ratings are exact,
so a model refreshed many times equals one built at once; with other scales sums can differ in the last digits.
"""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import neighbours, pearson, products
from tallyweave.operators.skew import CELL_ROWS
from tallyweave.sources.model_tables import BUCKETS, buckets_of, read_clustered, write_clustered
from tallyweave.storage import new_path, written

MOMENTS = products.MOMENTS
BUCKET_PAIRS = 500_000  # pairs of ratings for a bucket of a new model, so that it has room to grow
_PAIR = ["b1", "b2"]


@dataclass(frozen=True)
class RatingModel:
    """``cells`` (user, item, late, stars) and ``moments`` (b1, b2, n, s1, s2, q1, q2, s12), in ``buckets`` each."""

    cells: DataFrame
    moments: DataFrame
    heavy_user: int
    buckets: int


def _late_cells(ratings: DataFrame, order: str) -> DataFrame:
    latest = F.max(F.struct(F.col(order).alias("late"), "stars"))
    return ratings.groupBy(F.col("user_id").alias("user"), F.col("business_id").alias("item")).agg(
        latest.alias("latest")
    ).select("user", "item", "latest.*")


def _stored(
    cells: DataFrame, moments: DataFrame, heavy_user: int, path: str, buckets: int, placed: bool
) -> RatingModel:
    kept = write_clustered(moments.select(*_PAIR, *MOMENTS), f"{path}/moments-{heavy_user}", ["b1"], buckets, placed)
    cells = write_clustered(cells.select("user", "item", "late", "stars"), f"{path}/cells", ["user"], buckets)
    return RatingModel(cells, kept, heavy_user, buckets)


def build(
    ratings: DataFrame,
    path: str | None = None,
    order: str = "ts",
    heavy_user: int = pearson.HEAVY_USER,
    buckets: int | None = None,
) -> RatingModel:
    """The model of ``ratings``, written under ``path`` or among the intermediate tables.

    ``buckets`` follow the pairs of ratings unless given.
    """
    cells = written(_late_cells(ratings, order), "model-cells")
    sizes = written(cells.groupBy("user").agg(F.count(F.lit(1)).alias("size")), "model-sizes")
    named = sizes.where((F.col("size") <= heavy_user) & F.col("user").isNotNull())
    if buckets is None:
        pairs = named.agg(F.sum(F.col("size").cast("double") * (F.col("size") - 1) / 2)).first()[0] or 0
        buckets = max(BUCKETS, math.ceil(pairs / BUCKET_PAIRS))
    path = path or new_path(ratings.sparkSession, "model")
    light = cells.join(named.select("user"), "user", "left_semi").select("user", "item", F.col("stars").alias("s"))
    big = named.where(F.col("size") > CELL_ROWS).select("user", F.ceil(F.col("size") / CELL_ROWS).cast("int").alias("cells"))
    if not big.isEmpty():
        return _stored(cells, _zeroed(pearson.met_moments(light, big)), heavy_user, path, buckets, placed=False)
    lists, popular = pearson.first_lists(light.select("*", F.lit(1).alias("sign"), F.lit(True).alias("changed")))
    pairs = pearson.listed_moments(lists, popular, buckets)
    return _stored(cells, _added(pairs), heavy_user, path, buckets, placed=True)


def load(spark: SparkSession, path: str, heavy_user: int = pearson.HEAVY_USER) -> RatingModel:
    """A model of :func:`build` or :func:`refresh` with that ``path`` and ``heavy_user``."""
    cells, moments = f"{path}/cells", f"{path}/moments-{heavy_user}"
    return RatingModel(read_clustered(spark, cells), read_clustered(spark, moments), heavy_user, buckets_of(spark, moments))


def _zeroed(moments: DataFrame) -> DataFrame:
    """Sums over pairs without stars as 0, so they can be added to."""
    sums = [F.coalesce(name, F.lit(0.0)).cast("double").alias(name) for name in MOMENTS[1:]]
    return moments.select(*_PAIR, F.col("n").cast("bigint").alias("n"), *sums)


def _added(moments: DataFrame) -> DataFrame:
    """Moments summed by pair where they lie, without the pairs that nobody rated any more."""
    summed = moments.groupBy(*_PAIR).agg(*[F.sum(name).alias(name) for name in MOMENTS])
    return _zeroed(summed).where("n > 0")


def refresh(
    model: RatingModel, ratings: DataFrame, path: str | None = None, order: str = "ts", buckets: int | None = None
) -> RatingModel:
    """The model with ``ratings`` added, written as a new one; ``model`` stays as it was.

    Only ratings of users in the batch are paired, and of those only pairs with a changed one.  The stored
    moments are copied in their clustering: what changes moves to them as lists, see :func:`pearson.first_lists`.
    Other ``buckets`` than the model's move them.
    """
    batch = _late_cells(ratings, order)
    users = written(batch.select("user").where(F.col("user").isNotNull()).distinct(), "changed-users")
    known = model.cells.join(users, "user", "left_semi")
    # A null user forms no pairs, but their latest ratings are kept like the others'.
    unnamed = model.cells.where(F.col("user").isNull())
    both = known.unionByName(unnamed).withColumn("old", F.lit(True)).unionByName(batch.withColumn("old", F.lit(False)))
    value = F.struct("late", "stars")
    merged = both.groupBy("user", "item").agg(
        F.max(value).alias("now"), F.max(F.when(F.col("old"), value)).alias("then"), F.bool_or("old").alias("before")
    )
    merged = merged.select(
        "user", "item", F.col("now.late").alias("late"), F.col("now.stars").alias("is"),
        F.col("then.stars").alias("was"), "before",
    )
    merged = written(merged, "merged-cells")
    sizes = merged.groupBy("user").agg(F.count(F.lit(1)).alias("size"), F.count_if("before").alias("size_before"))
    sizes = written(sizes.where(F.col("size_before") <= model.heavy_user), "light-users")
    light = F.col("size") <= model.heavy_user
    changed = ~light & F.col("before") | light & (~F.col("before") | ~F.col("is").eqNullSafe(F.col("was")))
    rows = merged.join(sizes, "user").select("user", "item", "is", "was", "before", light.alias("after"), changed.alias("changed"))

    def side(sign: int, there: str, stars: str) -> DataFrame:
        return rows.where(there).select("user", F.lit(sign).alias("sign"), "item", F.col(stars).alias("s"), "changed")

    # What the pairs with a changed rating add now, less what they added before.
    changes = side(1, "after", "is").unionAll(side(-1, "before", "was"))
    lists, popular = pearson.first_lists(changes)
    changes = pearson.listed_moments(written(lists, "moment-changes"), popular, model.buckets)
    moments = _added(model.moments.select(*_PAIR, *MOMENTS).unionAll(changes.select(*_PAIR, *MOMENTS)))
    untouched = model.cells.where(F.col("user").isNotNull()).join(users, "user", "left_anti")
    cells = untouched.unionByName(merged.withColumnRenamed("is", "stars").select("user", "item", "late", "stars"))
    placed = buckets in (None, model.buckets)
    path = path or new_path(ratings.sparkSession, "model")
    return _stored(cells, moments, model.heavy_user, path, buckets or model.buckets, placed)


def edges(model: RatingModel, least_co_rated: int = 3, least_sim: float = 0.3) -> DataFrame:
    """(b1, b2, sim, num_co_rated) as :func:`tallyweave.plans.collaborative.item_similarity` gives them."""
    cells = model.cells.select(F.col("user"), F.col("item"), "stars")
    weights = written(pearson.user_weights(cells.toDF("user_id", "business_id", "stars")), "model-weights")
    constant = weights.where(F.col("iuf") == 0).select("business_id")
    heavy = cells.groupBy("user").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > model.heavy_user)
    heavy = written(heavy.where(F.col("user").isNotNull()).select("user"), "model-heavy-users")
    if heavy.isEmpty():
        moments = model.moments.where(F.col("n") >= least_co_rated)
    else:
        theirs = cells.where(F.col("item").isNotNull()).join(heavy, "user", "left_semi").select(
            "user", "item", F.lit(1).cast("bigint").alias("c"), F.col("stars").alias("s"), (F.col("stars") * F.col("stars")).alias("q")
        )
        bound = least_sim if least_sim > 0 else None
        moments = products.with_heavy_users(model.moments, theirs, least_co_rated, least_co_rated, bound)
    if least_sim > 0:  # 0 would not pass
        for end in _PAIR:
            moments = moments.join(constant.select(F.col("business_id").alias(end)), end, "left_anti")
        found = pearson.pearson(moments)
    else:
        found = pearson.zero_constant(pearson.pearson(moments), constant)
    return found.where(F.col("sim") >= least_sim).select("b1", "b2", "sim", "num_co_rated")


@dataclass(frozen=True)
class NeighbourModel:
    """Neighbour lists (target, other, sim, num_co_rated), once clustered by target and once by both ends."""

    by_target: DataFrame
    by_pair: DataFrame

    def predict(self, pairs: DataFrame, latest: DataFrame, n: int = 3) -> DataFrame:
        """(user_id, business_id, stars) for every row of ``pairs``, from one rating a user and business.

        The lists stay where they are: pairs and ratings move to them, and only the lists of targets
        asked for by very many pairs are repeated.
        """
        return neighbours.predict_listed(pairs, self.by_target, latest, n, self.by_pair)


def save_neighbours(found: DataFrame, path: str, buckets: int = BUCKETS) -> NeighbourModel:
    """The edges ``found`` as neighbour lists under ``path``."""
    lists = written(neighbours.both_ways(found), "neighbour-lists")
    return NeighbourModel(
        write_clustered(lists, f"{path}/by-target", ["target"], buckets),
        write_clustered(lists, f"{path}/by-pair", ["target", "other"], buckets),
    )


def load_neighbours(spark: SparkSession, path: str) -> NeighbourModel:
    return NeighbourModel(read_clustered(spark, f"{path}/by-target"), read_clustered(spark, f"{path}/by-pair"))
