"""Operators on texts against brute force, awkward cases included."""

import hashlib
import random
import re
import string
import time
from collections import Counter

import numpy as np
import pytest

from tallyweave.llm import decontamination, line_dedup, ngram_join, suffix_dedup
from tallyweave.llm.fm_index import FMIndex
from tallyweave.llm.run_length_index import RunLengthIndex

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def texts_of(df):
    return [(row["doc_id"], row["text"] or "") for row in df.select("doc_id", "text").collect()]


# ---- suffix dedup


def repeats_by_force(docs, match):
    texts = [(i, t.encode()) for i, t in docs]
    seen = Counter(t[p : p + match] for _, t in texts for p in range(len(t) - match + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - match + 1):
            if seen[t[p : p + match]] > 1:
                gone[p : p + match] = [True] * match
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(awkward):
    assert rows_of(suffix_dedup.remove_repeats(awkward)) == repeats_by_force(texts_of(awkward), 400)


def test_repeats_of_crowded_anchors(spark, monkeypatch):
    """Both ways of finding repeats agree on either side of the limit."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcd") for _ in range(60))
    shared = [word() + word() for _ in range(3)]
    texts = ["".join(draw.choice([word(), draw.choice(shared)[: draw.randint(30, 120)]]) for _ in range(6)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = repeats_by_force(list(enumerate(texts)), 50)
    assert sum(row[2] for row in expected) > 500
    for most in (1, 3, 1000):
        monkeypatch.setattr(suffix_dedup, "MOST_CLASSES", most)
        assert rows_of(suffix_dedup.remove_repeats(docs, match=50)) == expected


def test_repeats_of_nothing(no_docs):
    assert rows_of(suffix_dedup.remove_repeats(no_docs)) == []


def test_long_text_in_pieces(monkeypatch):
    draw = np.random.RandomState(1)
    text = draw.randint(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.anchors(text, np.array([0, len(text)]), 100)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 700)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([0], pa.int32()), pa.array([text.tobytes().decode()])], ["doc_id", "copy", "text"]
    )
    (rows,) = suffix_dedup._find_anchors(100)([batch])
    assert sorted(rows.column("place").to_pylist()) == whole[0].tolist()


def test_run_length_index():
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 60))).encode() for _ in range(30)]
    index = RunLengthIndex(texts)
    seen = Counter(t[p : p + 8] for t in texts for p in range(len(t) - 7))
    covered = set()
    for start, t in zip(index.starts, texts):
        for p in range(len(t) - 7):
            if seen[t[p : p + 8]] > 1:
                covered.update(range(start + p, start + p + 8))
    found = {k for b, e in zip(*index.repeats(8)) for k in range(b, e)}
    assert found == covered
    copies = RunLengthIndex([b"the same text again and again"] * 50)
    assert copies.runs < 200


# ---- n-gram join


def components_by_force(docs, width=3, similar=(90, 100)):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)} if w else set())
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and similar[1] * len(a & sets[j]) >= similar[0] * len(a | sets[j]):
                group[root(i)] = root(j)
    order = lambda i: (docs[i][0] is not None, docs[i][0] or 0)
    least = {}
    for i in range(len(docs)):
        r = root(i)
        least[r] = min(least.get(r, i), i, key=order)
    return sorted(((d, len(s), docs[least[root(i)]][0]) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def test_similar_documents(awkward):
    assert rows_of(ngram_join.similar_documents(awkward)) == components_by_force(texts_of(awkward))


@pytest.mark.parametrize("rows, size, width, similar", [(2, 150, 3, (90, 100)), (2048, 420, 3, (90, 100)), (1024, 300, 5, (80, 100))])
def test_similar_chains(spark, monkeypatch, rows, size, width, similar):
    """Chains of near copies: components reach further than links, whole groups or cut in blocks."""
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", rows)
    draw = random.Random(4)
    docs = []
    for start in range(4):
        words = [f"w{draw.randint(0, 5000)}" for _ in range(size + 18 * start)]
        for step in range(12):
            docs.append((start * 100 + step, " ".join(words)))
            words = list(words)
            for _ in range(draw.randint(1, size // 50)):
                words[draw.randrange(len(words))] = f"x{draw.randint(0, 5000)}"
    docs.append((999, docs[0][1]))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows_of(ngram_join.similar_documents(frame, width, similar)) == components_by_force(docs, width, similar)


@pytest.mark.parametrize("similar", [(90, 100), (80, 100), (1, 2), (1, 1)])
def test_prefixes_meet(similar):
    """Sets of just the wanted similarity share a token, at every size and on both sides of the limit for big ones."""
    draw = np.random.RandomState(5)
    ranks = draw.permutation(1 << ngram_join.COUNTER_BITS).astype(np.uint64)
    for n in (1, 2, 9, 10, 11, 19, 50, 179, 190, 199, 200, 201, 221, 222, 223, 319, 320, 321, 350, 640, 2000, 5119, 5121):
        p, q = similar
        for extra in {0, n // 30, n // 9, n * (q - p) // p}:  # added to one set only; the rest of what may differ is replaced
            if q * n < p * (n + extra):
                continue
            whole = draw.randint(0, 2**63, n + extra + n, dtype=np.uint64)
            a = whole[:n]
            swap = next(k for k in range(n, -1, -1) if q * (n - k) >= p * (n + extra + k))
            b = np.concatenate([whole[swap : n + extra], whole[n + extra : n + extra + swap]])
            first, _ = ngram_join.prefix_tokens(np.unique(a), ranks, similar)
            second, _ = ngram_join.prefix_tokens(np.unique(b), ranks, similar)
            assert len(np.intersect1d(first, second)), (n, extra, swap)


def test_keep_one(awkward):
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    force = components_by_force(texts_of(awkward))
    ids = Counter(row["doc_id"] for row in kept.collect())
    assert sum(ids.values()) < awkward.count()
    assert set(ids) >= {c for _, n, c in force if n} and ids[0] == ids[1] == ids[2] == 1
    assert ids[3] == 2 and ids[7] == 0  # two texts of one id stay, a copy goes


def test_similar_nothing(no_docs):
    assert rows_of(ngram_join.similar_documents(no_docs)) == []


# ---- line dedup


def lines_by_force(docs):
    order = lambda d: (d[0] is not None, d[0] or 0)
    lines = [(i, k, line) for i, (_, t) in sorted(enumerate(docs), key=lambda d: order(d[1])) for k, line in enumerate(t.split("\n")) if len(line) >= 20]

    def near(a, b):
        if a == b:
            return True
        if len(a) < len(b):
            a, b = b, a
        p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
        return len(a) - len(b) < 2 and (a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + 1 :] == b[p:])

    gone, firsts = Counter(), {}
    for i, _, line in lines:
        close = [e for e in firsts if abs(len(e) - len(line)) < 2 and near(e, line)]
        gone[i] += bool(close)
        firsts[line] = 1
    return gone


def test_lines(spark):
    draw = random.Random(9)
    base = ["".join(draw.choice("abcé ") for _ in range(draw.randint(15, 40))) for _ in range(12)]
    docs = []
    for i in range(30):
        text = []
        for _ in range(6):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 2)):
                at, how = draw.randrange(len(line)), draw.randrange(3)
                line[at : at + 1] = [[], ["z"], [line[at], "y"]][how]
            text.append("".join(line))
        docs.append((i, "\n".join(text)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {row["doc_id"]: row["n_removed"] for row in line_dedup.removed_lines(frame).collect()}
    force = lines_by_force(docs)
    assert found == {i: force[i] for i, _ in docs} and sum(found.values()) > 30


def test_variants_of_a_line(spark):
    draw = random.Random(8)
    lines = ["", "ab", "aab"] + ["".join(draw.choice("xy\U0001f600é") for _ in range(n)) for n in (511, 512, 513, 1030)]
    rows = [(i, i, (i, 0, 0), line, len(line)) for i, line in enumerate(lines) if line]
    near = spark.createDataFrame(rows, "h1 bigint, h2 bigint, first struct<doc_id: bigint, copy: int, line_no: int>, line string, n int")
    hashes = {(r["h1"], r["at"]): r["variant"] for r in line_dedup._variants(near).collect()}
    left = {(i, at): line[:at] + line[at + 1 :] for i, line in enumerate(lines) if line for at in range(len(line) + 1)}
    assert hashes.keys() == left.keys()
    # equal texts have equal hashes, different ones different hashes, whichever line and place they come from
    assert len(set(zip(hashes.values(), (left[k] for k in hashes)))) == len(set(left.values())) == len(set(hashes.values()))


def test_very_long_lines(spark):
    draw = random.Random(9)
    line = "".join(draw.choice("abcdefgh \U0001f600") for _ in range(1_000_000))
    docs = [(1, line), (2, line[:700_000] + "#" + line[700_001:]), (3, line[:5] + line[6:]), (4, line[::-1])]
    begin = time.monotonic()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {row["doc_id"]: row["n_removed"] for row in line_dedup.removed_lines(frame).collect()}
    assert found == {1: 0, 2: 1, 3: 1, 4: 0}
    assert time.monotonic() - begin < 120  # hours, were each variant built as a text


def test_awkward_lines(awkward, no_docs):
    found = sorted((row["doc_id"], row["n_lines"], row["n_removed"]) for row in line_dedup.removed_lines(awkward).collect() if row["doc_id"] is not None)
    counts = Counter(found)
    assert counts[(0, 0, 0)] == counts[(1, 1, 0)] == 1
    assert (17, 2, 1) in counts and (18, 3, 2) in counts
    assert rows_of(line_dedup.removed_lines(no_docs)) == []


def test_dedup_lines_keeps_columns(awkward):
    kept = line_dedup.dedup_lines(awkward)
    assert kept.columns == awkward.columns
    texts = {row["doc_id"]: row for row in kept.collect()}
    assert texts[17]["text"] == "line that is long enough to count" and texts[17]["n_chars"] == 33
    assert texts[18]["text"] == "short" and 7 not in texts and 0 in texts and 1 in texts


def test_short_lines(spark):
    docs = [
        (1, "Home\nHome\n\n \nHomes\nan only line of some length"),
        (2, "Home\n\n \nan only line of same length\nx"),
        (3, "x"),
        (4, "xy\n\n"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = {row["doc_id"]: row["text"] for row in line_dedup.dedup_lines(frame).collect()}
    # "Homes" and "xy" are one edit away only; blank lines stay; the text of 3 is nothing but a repeated line
    assert kept == {1: "Home\n\n \nHomes\nan only line of some length", 2: "\n \nx", 4: "xy\n\n"}
    found = {row["doc_id"]: row["removed_lines"] for row in line_dedup.removed_lines(frame, exact_chars=1).collect()}
    assert found == {1: "1", 2: "0,3", 3: "0", 4: ""}


def test_lines_of_every_length(spark):
    draw = random.Random(4)
    base = ["".join(draw.choice("abé ") for _ in range(draw.randint(0, 24))) for _ in range(25)]
    docs = [(i, "\n".join(draw.choice(base) for _ in range(5))) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {row["doc_id"]: row["n_removed"] for row in line_dedup.removed_lines(frame, exact_chars=1).collect()}
    force, seen = lines_by_force(docs), set()
    for i, text in docs:
        for line in text.split("\n"):
            if len(line) < 20 and line.strip():
                force[i] += line in seen
                seen.add(line)
    assert found == {i: force[i] for i, _ in docs}


# ---- decontamination


def hits_by_force(docs, items):
    found = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    windows = {}
    for item, text in items:
        w = found(text or "")
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w = found(text)
        hit, ids = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    ids |= windows[tuple(w[i : i + k])]
        names = ",".join(sorted(str(i) for i in ids))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, None), (2, ""), (3, "!!"), (4, "TWO words"), (5, "spam spam spam"), (12, "æther ünïcode çafé"), (4, "a third TEXT")]


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_contamination(spark, awkward, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    passage = next(t for i, t in texts_of(awkward) if i == 12)
    items = [*ITEMS, (20, " ".join(passage.split()[5:40])), (21, " ".join(passage.split()[30:45])), (None, passage)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(awkward, benchmark)
    expected = hits_by_force(texts_of(awkward), [i for i in items if i[0] is not None])
    assert rows_of(found) == expected and any(row[5] for row in expected)


def test_decontaminate(spark, awkward, no_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontamination.decontaminate(awkward, benchmark)
    assert kept.columns == awkward.columns
    texts = {row["doc_id"]: row["text"] for row in kept.collect()}
    assert 4 not in texts and 13 not in texts and texts[0] is None and texts[1] == ""
    assert texts[5] == " ÆTHER" or "ÆTHER" in texts[5]
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(no_docs, benchmark).count() == 0
    assert not any(row["contaminated"] for row in decontamination.contamination(awkward, nothing).collect())


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_nothing_left_after_cuts(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    a, b = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(10)]
    nested = [*a[:4], *b[:5], *a, *b[5:], *a[4:]]  # a, then b, then a once more
    docs = [(1, " ".join(["one", *nested, "two"])), (2, " ".join(nested)), (3, " ".join(["one", *a[:4], *b])), (4, "one, two")]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id bigint, text string, n_chars bigint")
    benchmark = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "item_id bigint, text string")
    kept = decontamination.decontaminate(frame, benchmark)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert {i: r["text"].split() for i, r in rows.items()} == {1: ["one", "two"], 3: ["one", *a[:4]], 4: ["one,", "two"]}
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert not any(r["contaminated"] for r in decontamination.contamination(kept, benchmark).collect())


def test_fm_index():
    draw = np.random.RandomState(3)
    text = draw.randint(1, 4, 500)
    index = FMIndex(text, 3)
    for size in (1, 3, 6):
        for start in range(0, 500 - size, 37):
            pattern = text[start : start + size]
            low, high = index.search(pattern[None, :], np.array([size]))
            found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert found == [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern).all()]
