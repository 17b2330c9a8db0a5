"""Alignment of two tokenizers against their own libraries and plain Python counts."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyweave.llm import token_alignment as align

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(align.TOKENIZERS), reason="tokenizer files are not here")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(f"{align.TOKENIZERS}/{align.BYTE_BPE}")
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=f"{align.TOKENIZERS}/{align.PIECE_BPE}")


def brute(documents, tokenizers):
    """All rows and pair counts, token by token."""
    first, second = tokenizers
    letters = align.byte_letters()
    docs = []
    for _, text in documents:
        groups = []
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [second.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append(([], [], groups))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        place_a, place_b, before = {end: i + 1 for i, end in enumerate(ends_a)}, {end: i + 1 for i, end in enumerate(ends_b)}, (0, 0)
        for end in sorted(place_a.keys() & place_b.keys()):
            groups.append((a[before[0] : place_a[end]], b[before[1] : place_b[end]]))
            before = place_a[end], place_b[end]
        docs.append((a, b, groups))
    links = [Counter((x, y) for g, h in groups for x in g for y in h) for _, _, groups in docs]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for (doc_id, _), (a, b, groups), own in zip(documents, docs, links):
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(times for pair, times in own.items() if counts[pair] == most[pair[0]])
        total = sum(times * counts[pair] for pair, times in own.items())
        digest = hashlib.sha256(said.encode()).hexdigest() if said else ""
        rows.append((doc_id, len(a), len(b), len(groups), own.total(), best, total, digest))
    return sorted(rows, key=repr), counts


def check(spark, docs, documents, tokenizers, **sizes):
    found = align.TokenAlignment(docs, align.tokenizer_files(spark), **sizes)
    rows, counts = brute(documents, tokenizers)
    assert sorted(map(tuple, found.documents.collect()), key=repr) == rows
    assert {(r["a"], r["b"]): r["n"] for r in found.pair_counts.collect()} == counts


ODD = [
    "<|endoftext|> and <s> </s> <unk> are text",
    "a▁b",
    "  two  blanks \t tab\n\nlines ",
    "漢字かな \U0001f600\U0001f1e6 ẞ ﬁ é é",
    "\x00\x01 nul",
    "z" * 3000,
    "ab" * 700 + "漢" * 300,
    "a　b c d",
]


@pytest.mark.parametrize("chunk_bytes,parts", [(4000, 3), (align.CHUNK_BYTES, align.PARTS)])
def test_awkward_documents(spark, awkward, tokenizers, monkeypatch, chunk_bytes, parts):
    for name, value in (("FAN_IN", 2), ("BATCH_CHUNKS", 3), ("BLOCK_PAIRS", 50), ("WIDE_GROUP", 12), ("LINKS_AT_ONCE", 100)):
        monkeypatch.setattr(align, name, value)
    odd = spark.createDataFrame([(100 + i, text) for i, text in enumerate(ODD)], "doc_id bigint, text string")
    docs = awkward.select("doc_id", "text").unionByName(odd)
    check(spark, docs, [tuple(r) for r in docs.collect()], tokenizers, chunk_bytes=chunk_bytes, parts=parts)


def test_empty_table(spark, no_docs):
    found = align.TokenAlignment(no_docs, align.tokenizer_files(spark))
    assert found.documents.isEmpty() and found.pair_counts.isEmpty()
    assert found.documents.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_runs_merge_block_by_block(monkeypatch):
    monkeypatch.setattr(align, "BLOCK_PAIRS", 7)
    draw = np.random.RandomState(4)
    total, runs = Counter(), []
    for _ in range(9):
        pairs = np.unique(draw.randint(0, 400, draw.randint(1, 200)))
        counts = draw.randint(1, 10**6, len(pairs))
        total.update(dict(zip(pairs.tolist(), counts.tolist())))
        runs.append(align.pairs_run(pairs, counts))
    found = [(p, c) for pairs, counts in align.merged(runs) for p, c in zip(pairs.tolist(), counts.tolist())]
    assert found == sorted(total.items())
    assert list(align.merged([])) == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_registered_query(spark, tokenizers):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = align.QUERIES["op11_token_alignment"](spark, FOLDER)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(documents, tokenizers)[0]
