"""Conversation repair against a plain dynamic program over whole conversations."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies int, conv string, chunk bigint, place int"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """conv_id -> gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
    conversations = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        conversations[conv_id].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest(), text))
    out = {}
    for conv_id, turns in conversations.items():
        turns.sort()
        seen, faults = set(), []
        for _, _, role, _, text in turns:
            meaning = text.rstrip(" \t\n\x0b\x0c\r")
            kind = "blank" if not meaning else "duplicate" if (role, text) in seen else "" if meaning[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(kind)
        numbers = {t for known, t, *_ in turns if known}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [role[:1] for _, _, role, _, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        best = {"": (0, "", ())}  # by what of the pattern is said: nothing, s, u, a

        def grow(states):
            for _ in range(2):
                for state, (cost, audit, said) in list(states.items()):
                    new, role = ("a", "assistant") if state == "u" else ("u", "user")
                    option = (cost + 5, audit + "I", (*said, f"{role}:"))
                    states[new] = min(states.get(new, option), option)
            return states

        for (_, _, role, _, text), fault in zip(turns, faults):
            after = {}
            for state, (cost, audit, said) in grow(best).items():
                options = [(state, (cost + 2, audit + "D", said))]
                if fault not in ("blank", "duplicate"):
                    extra = 5 * (fault == "truncated")
                    new, full = ("a", "assistant") if state == "u" else ("u", "user")
                    options.append((new, (cost + 1 + extra, audit + "R", (*said, f"{full}:{text}"))))
                    if role[:1] == new or (role[:1] == "s" and state == ""):
                        options.append((role[:1], (cost + extra, audit + "K", (*said, f"{role}:{text}"))))
                for to, option in options:
                    after[to] = min(after.get(to, option), option)
            best = after
        cost, audit, said = min(value for state, value in grow(best).items() if state in ("", "a"))
        kinds = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        assert LEGAL.match("".join(s[0] for s in said))
        out[conv_id] = (gaps, *kinds, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def rows_of(seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ux"]
    texts = [None, "", " \t", "Well.", "Yes!  ", "cut off", "No?", "more", "a.b", "é ", "done.\n", "\x1c", "x" * 100_000 + "."]
    rows = []
    for conv in [None, *range(30)]:
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[turn % 2]
            turn = draw.choice([turn, turn, turn, turn + 3, None, 0])
            rows += [(conv, turn, role, draw.choice(texts) if draw.random() < 0.5 else f"said {draw.random()}.", 9, "c", 1, None)] * draw.choice([1, 1, 1, 2])
    for turn in range(400):  # far longer than a chunk of the test
        role = draw.choice(["user", "assistant", "assistant", "tool"])
        rows.append((77, turn, role, f"part {turn}" + draw.choice(["", "", "", "."]) if turn < 300 else draw.choice(["again.", f"{turn}?"]), 9, "c", 1, None))
    rows += [(78, 0, "system", "rules.", 9, "c", 1, None)] + [(78, turn, "tool", "cut", 9, "c", 1, None) for turn in range(1, 90)]
    draw.shuffle(rows)
    return rows


def report(df, copies=None):
    rows = repair.repair_report(df, df, copies).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


@pytest.mark.parametrize("chunk", [4, 64, repair.CHUNK_ROWS])
def test_repair_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    rows = rows_of(chunk)
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_copies_and_damage(spark):
    rows = rows_of(3)[:150]
    df = spark.createDataFrame(rows, SCHEMA)
    assert report(df, F.lit(3)) == brute([row for row in rows for _ in range(3)])
    hurt = repair.damaged(df)
    assert report(hurt, F.col("copies")) == brute([tuple(r)[:4] for r in hurt.collect() for _ in range(r["copies"])])


def test_repaired_turns_and_empty_table(spark):
    rows = [(1, 0, "assistant", "late.", 1, "", 1, 1), (1, 1, "user", "so?", 1, "", 1, 1), (2, 0, "user", " ", 1, "", 1, 1)]
    fixed = repair.Repair(spark.createDataFrame(rows, SCHEMA))
    assert [tuple(r) for r in fixed.turns.collect()] == [("=1", 0, "user", "late."), ("=1", 1, "assistant", "so?")]
    assert {r["conv"]: (r["cost"], r["audit"]) for r in fixed.audits.collect()} == {"=1": (2, "RR"), "=2": (2, "D")}
    nothing = spark.createDataFrame([], SCHEMA)
    assert report(nothing) == {}


def test_a_cost_vector_is_one_of_few():
    assert len(repair.VECTORS) < 64
    draw = random.Random(1)
    for _ in range(200):
        codes = [draw.randrange(12) for _ in range(draw.randint(1, 40))]
        run = repair.vector_map(codes)
        assert all(run[v] == repair._STEP_LISTS[codes[0]][repair.stitched(codes, v)[0]] for v in range(len(repair.VECTORS)))
