"""Queries over the star-schema tables with their SQL twins."""

from tallyweave.registry import exploration, itemsets, recommenders, similarity

QUERIES = {**exploration.QUERIES, **itemsets.QUERIES, **similarity.QUERIES, **recommenders.QUERIES}
ORACLE_SQL = {**exploration.ORACLE_SQL, **itemsets.ORACLE_SQL, **similarity.ORACLE_SQL, **recommenders.ORACLE_SQL}
