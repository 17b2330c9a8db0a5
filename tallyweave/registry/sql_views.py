"""The stand-in views as SQL, for the twin statements of the registered queries."""

STOPWORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "was", "with", "be", "as"]

REVIEWS = """SELECT d.doc_id AS review_id, o.o_custkey AS user_id, d.doc_id % 200 AS business_id,
    CAST(1 + d.doc_id % 5 AS DOUBLE) AS stars, o.o_orderdate AS date, d.text AS text
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey"""

BUSINESSES = """SELECT c_custkey AS business_id,
    CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN ' ' ELSE n_name END AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PART_RATINGS = """SELECT o_custkey AS user_id, l_partkey AS business_id,
    CAST(ceil(l_quantity / 10) AS DOUBLE) AS stars, o_orderdate AS ts, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

YEARLY_RATINGS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS user_id,
    l_suppkey AS business_id, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

BRAND_LINES = """SELECT l_orderkey AS user_id, p_brand AS business_id
  FROM lineitem JOIN part ON l_partkey = p_partkey"""

# The white space the word split cuts at.
SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

DOCUMENT_WORDS = f"""SELECT DISTINCT user_id, element FROM (
    SELECT doc_id AS user_id, unnest(regexp_split_to_array(lower(text), '{SPACE}')) AS element FROM documents)
  WHERE element <> ''"""

STOPWORD_LIST = ", ".join(f"'{word}'" for word in STOPWORDS)
