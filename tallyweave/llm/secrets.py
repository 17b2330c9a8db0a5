"""Secret scan: fixed patterns, and character Markov models for what no pattern names.

Base spans come from three patterns.  The method adds tokens that look drawn at random: two first-order
Markov models over characters, one of random strings and one of ordinary identifiers, give each token a
log-likelihood ratio.  Both learn from labelled samples: strings inside base spans are random, words of
other text are ordinary.  Each sample is bounded (``SAMPLE_STRINGS`` strings, the words of
``SAMPLE_DOCUMENTS`` documents, those of the smallest hash), so the models have a fixed size, one number
for two neighbouring characters; the scan itself covers every whole text.

Everything is a column expression on the row itself; no row is moved or split.

Defined cases: a null text is an empty one and has no spans; of tokens that overlap a base span only the
base span counts; without a single base span the model of random strings is the uniform one; repeated
documents are scanned row by row and further columns are left out.
"""

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

# The patterns of the contract, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
# Shorter than any token that is judged, so that no token vouches for itself.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_]{4,15}(?![A-Za-z0-9+/_=-])"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_.=-"
SYMBOLS = len(ALPHABET) + 1  # 0 is any other character
SAMPLE_STRINGS = 5_000
SAMPLE_DOCUMENTS = 1_000
BACK_OFF = 5.0
LEAST_RATIO = 1.0  # a character, natural logarithm
_SPAN = "array<struct<start:int,end:int>>"


def _spans(text: Column, pattern: str, kept: Column | None = None, keep=None) -> Column:
    """Start and end, in code points, of the matches; ``keep`` judges the values of ``kept``, one a match.

    The text between matches and the matches themselves alternate, so their lengths give positions.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(between, F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        (matches if kept is None else kept).alias("value"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(done: Column, part: Column) -> Column:
        start = (done["at"] + part["gap"]).cast("int")
        end = (start + F.coalesce(part["size"], F.lit(0))).cast("int")
        taken = part["size"].isNotNull()
        if keep is not None:
            taken = taken & keep(part["value"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(_SPAN)
        found = F.when(taken, F.concat(done["found"], one)).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = F.aggregate(parts, zero, step, lambda done: done["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each base kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return {
        "assign": _spans(text, ASSIGN, values, lambda v: F.length(v) >= 8),
        "access": _spans(text, ACCESS),
        "hex": _spans(text, HEX),
    }


def _pairs(strings: DataFrame) -> Counter:
    """Neighbouring symbols of the strings of a column ``string``: at most SYMBOLS squared counts."""
    symbols = F.transform(F.split("string", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = strings.select(symbols.alias("s")).where(F.size("s") > 1)
    n = F.size("s")
    pairs = pairs.select(
        F.explode(F.zip_with(F.slice("s", 1, n - 1), F.slice("s", 2, n - 1), lambda a, b: a * SYMBOLS + b)).alias("pair")
    )
    return Counter({row["pair"]: row["count"] for row in pairs.groupBy("pair").count().collect()})


def _probabilities(counts: Counter) -> list[float]:
    """P(next symbol | symbol); rare pairs lean on how frequent the next symbol is by itself."""
    after = [sum(counts.get(a * SYMBOLS + b, 0) for a in range(SYMBOLS)) + 0.5 for b in range(SYMBOLS)]
    alone = [n / sum(after) for n in after]
    out = []
    for a in range(SYMBOLS):
        row = [counts.get(a * SYMBOLS + b, 0) for b in range(SYMBOLS)]
        out += [(n + BACK_OFF * alone[b]) / (sum(row) + BACK_OFF) for b, n in enumerate(row)]
    return out


def markov_ratios(docs: DataFrame) -> list[float]:
    """The log-likelihood ratio, random against ordinary, of each two neighbouring symbols."""
    text = F.coalesce("text", F.lit(""))
    values = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 8),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    some = text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}")
    strings = docs.where(some).select(F.explode(values).alias("string")).distinct()
    strings = strings.orderBy(F.xxhash64("string"), "string").limit(SAMPLE_STRINGS)
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    ids = written(ids, "secret-sample")  # at most SAMPLE_DOCUMENTS ids, a proven bound
    ordinary = docs.join(F.broadcast(ids), "doc_id").where(~some)
    words = ordinary.select(F.explode(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("string"))
    # Random strings are half like the labelled ones, half of any symbols.
    random = [(p + 1 / SYMBOLS) / 2 for p in _probabilities(_pairs(strings))]
    return [math.log(a / b) for a, b in zip(random, _probabilities(_pairs(words)))]


def looks_random(token: Column, ratios: list[float]) -> Column:
    """Whether the ratio of a token is at least ``LEAST_RATIO`` a character; a number has no letter and is none."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    symbols = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    n = F.length(token)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(done: Column, symbol: Column) -> Column:
        ratio = F.get(table, done["last"] * SYMBOLS + symbol)
        total = F.when(done["last"] >= 0, done["sum"] + ratio).otherwise(done["sum"])
        return F.struct(symbol.alias("last"), F.coalesce(total, F.lit(0.0)).alias("sum"))

    ratio = F.aggregate(symbols, start, step, lambda done: done["sum"])
    return token.rlike("[A-Za-z]") & (ratio >= LEAST_RATIO * (n - 1))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``base`` and ``spans``: arrays of start, place (of the kind in KINDS) and end, in order."""
    ratios = markov_ratios(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = base_spans(F.col("text"))
    tokens = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    found["markov"] = _spans(F.col("text"), TOKEN, tokens, lambda t: looks_random(t, ratios))
    rows = rows.select("doc_id", *[column.alias(kind) for kind, column in found.items()])

    def placed(kind: str) -> Column:
        place = F.lit(KINDS.index(kind))
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), place.alias("place"), s["end"].alias("end")))

    base = F.array_sort(F.concat(*[placed(kind) for kind in KINDS[:3]]))
    rows = rows.withColumn("base", base)
    free = F.filter(
        placed("markov"),
        lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
    )
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", free)).alias("spans"))


def _listed(spans: str) -> Column:
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["place"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    rows = secret_spans(docs)

    def count(place: int) -> Column:
        return F.size(F.filter("base", lambda s: s["place"] == place)).cast("bigint")

    return rows.select(
        "doc_id",
        *[count(place).alias(f"n_{kind}") for place, kind in enumerate(KINDS[:3])],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return secrets(spread_small_scan(docs))


QUERIES = {"op4_secrets": op4_secrets}
ORACLE_SQL: dict[str, str] = {}
