"""SimHash classes against fingerprints and all pairs in plain Python."""

import os
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyweave.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(documents, fingerprint=plain_fingerprint, budget=2):
    """(doc_id, fingerprint, component_id, n_links) of all documents, by all pairs."""
    prints = [fingerprint(text) for _, text in documents]
    linked = [[j for j, q in enumerate(prints) if j != i and (p ^ q).bit_count() <= budget] for i, p in enumerate(prints)]
    component = list(range(len(prints)))
    for i in range(len(prints)):
        if component[i] != i:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        for j in seen:
            component[j] = i
    least = {}
    for (doc_id, _), c in zip(documents, component):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    rows = [(d, f"{p:016x}", least.get(c), len(n)) for (d, _), p, c, n in zip(documents, prints, component, linked)]
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id", "n_links").collect()), key=repr)


def test_awkward_documents(spark, awkward, no_docs, monkeypatch):
    documents = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows_of(simhash.similar_documents(awkward)) == brute(documents)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 7)
    assert all(simhash.fingerprint((t or "").encode()) == plain_fingerprint(t) for _, t in documents)
    empty = simhash.similar_documents(no_docs)
    assert empty.columns == ["doc_id", "fingerprint", "component_id", "n_links"] and empty.isEmpty()
    nameless = awkward.where("doc_id is null")
    assert [r["component_id"] for r in simhash.similar_documents(nameless).collect()] == [None]


def close_prints(seed, n, roots=12):
    """Fingerprints in chains of few bits, and others that share a block."""
    draw = random.Random(seed)
    prints = [draw.getrandbits(64) for _ in range(roots)]
    while len(prints) < n:
        p = draw.choice(prints)
        if draw.random() < 0.3:
            p = (p & ~((1 << 40) - 1)) | draw.getrandbits(40)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3])):
            p ^= 1 << draw.randrange(64)
        prints.append(p)
    return prints


def classes_of(spark, prints, budget):
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    signed = spark.createDataFrame(signed, "doc_id bigint, fp bigint")
    found = signed.join(simhash.similar_classes(signed, budget), "fp")
    found = found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
    return rows_of(found)


@pytest.mark.parametrize("budget,cell", [(2, simhash.CELL_ROWS), (2, 4), (0, 4), (3, 16)])
def test_classes_equal_all_pairs(spark, monkeypatch, budget, cell):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell)
    prints = close_prints(cell + budget, 400)
    assert classes_of(spark, prints, budget) == brute(list(enumerate(prints)), lambda p: p, budget)


def test_trie_pairs_prune_and_are_complete(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    values = np.unique(np.array(close_prints(9, 700), np.uint64))
    differ = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(i, j) for i, j in zip(*np.nonzero(differ <= 2)) if i < j}
    got = [pair for i, j in simhash.trie_pairs(values, values, True, 0, 2) for pair in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    left, right = values[::2], values[1::2]
    got = {pair for i, j in simhash.trie_pairs(left, right, False, 0, 2) for pair in zip(i.tolist(), j.tolist())}
    assert got == set(zip(*(x.tolist() for x in np.nonzero(differ[::2, 1::2] <= 2))))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_registered_query(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(simhash.QUERIES["op12_simhash_dedup"](spark, FOLDER)) == brute(documents)
