"""Awkward documents that every operator has to live with."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, copy int, begin string"


def _sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


def awkward_rows():
    draw = random.Random(5)
    base = _sentence(draw, 120)
    passage = _sentence(draw, 90)
    long = "\n".join(_sentence(draw, 12) for _ in range(900))
    texts = [
        None,
        "",
        " \t\n ",
        "one",
        "two words",
        "Æther Ünïcode çafé ÆTHER",
        base,
        base,
        base.replace(" ", "  ", 3),
        base + " tail",
        _sentence(draw, 40) + "\n" + passage + "\n" + _sentence(draw, 30),
        _sentence(draw, 50) + "\n" + passage + "\n" + _sentence(draw, 10),
        passage,
        "spam " * 400,
        "a" * 1500,
        long,
        long + "\nanother last line of some length",
        "line that is long enough to count\nline that is long enough to count",
        "line that is long enough to coumt\nshort\nline that is long enough to ount",
        "the end\x00with \U0001f600 marks",
    ]
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t) if t is not None else None, "n", 7, None) for i, t in enumerate(texts)]
    rows += [rows[6], rows[12], (3, "a third text of id three", None, None, None, None, None, "b"), (None, base, None, "", 1, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
