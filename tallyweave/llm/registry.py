"""The queries of this subpackage and their SQL twins."""

from tallyweave.llm import (
    conversation_repair,
    decontamination,
    line_dedup,
    mixing,
    ngram_join,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    token_alignment,
    topk,
    toxicity,
    url_rules,
)

MODULES = (
    suffix_dedup,
    mixing,
    line_dedup,
    secrets,
    url_rules,
    topk,
    decontamination,
    toxicity,
    ngram_join,
    quality,
    token_alignment,
    simhash,
    conversation_repair,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
