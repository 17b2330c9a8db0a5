"""Two-pass frequent itemsets: candidates from shards, then exact counts over everything."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyweave.operators.baskets import in_shards
from tallyweave.operators.itemsets import (
    HEAVY_BASKET,
    PAIR_BUCKETS,
    count_by_size,
    count_candidates,
    sharded_candidates,
)
from tallyweave.sources.writers import write_itemset_report
from tallyweave.storage import written


@dataclass(frozen=True)
class ItemsetReport:
    candidates: DataFrame  # size, items
    size_counts: DataFrame  # size, itemsets
    frequent: DataFrame  # size, items, support

    def write(self, path: str, numeric_items: bool = False, mode: str = "errorifexists") -> None:
        write_itemset_report(self.candidates, self.size_counts, self.frequent, path, numeric_items, mode)


def itemset_report(
    baskets: DataFrame,
    support: int,
    shards: int = 8,
    with_buckets: bool = False,
    max_size: int | None = None,
    heavy_basket: int = HEAVY_BASKET,
) -> ItemsetReport:
    """Candidates and frequent itemsets of (basket, item) rows.

    A ``shard`` column given with the baskets is used as it is; otherwise baskets are dealt to
    ``shards``.  ``with_buckets`` prunes pairs by hash buckets while candidates are formed.
    """
    sharded = written(baskets if "shard" in baskets.columns else in_shards(baskets, shards), "sharded-baskets")
    buckets = PAIR_BUCKETS if with_buckets else None
    candidates = written(sharded_candidates(sharded, support, buckets, max_size, heavy_basket), "all-candidates")
    frequent = count_candidates(sharded, candidates, support)
    return ItemsetReport(candidates, count_by_size(candidates), frequent)
