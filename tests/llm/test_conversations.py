"""Conversation repair: whole results against a plain search, chunk sizes, stretches that never converge."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.llm import conversations as cv
from kestrel.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_queries import SF, rows as table

SCHEMA = "conv_id long, turn long, role string, text string"


def key(r):
    return [(x is not None, x) for x in r]


def judged(df, **options):
    return sorted((tuple(r) for r in cv.repair(df, missing=F.col("missing"), **options).collect()), key=key)


def wanted(rows):
    return sorted(brute.repair(*brute.damage(rows)), key=key)


def made(seed, convs, longest):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "sam", None]
    texts = ["yes.", "no", "why? ", "\n ", "", None, "é!", "中", "ok.\n"]
    out = []
    for c in range(convs):
        for t in range(r.randrange(longest)):
            text = r.choice(texts) if r.random() < .6 else f"said {r.randrange(99)}."
            out.append((c, r.choice([t, t, t, t * 2, None]), roles[t % 2] if r.random() < .6 else r.choice(roles), text))
    return out + [(None, 1, "user", "x."), (None, None, "assistant", "y.")]


@pytest.mark.parametrize("seed, size, passes", [(1, 1, 1), (2, 2, 0), (3, 3, 9), (4, 1000, 4)])
def test_against_plain_search(spark, seed, size, passes):
    rows = made(seed, 40, 14)
    df = cv.damage(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert judged(df, size=size, passes=passes) == wanted(rows)


@pytest.mark.parametrize("size, passes", [(5, 2), (4, 50)])
def test_roles_that_never_converge(spark, size, passes):
    rows = [(1, t, "tool", f"t{t}.") for t in range(150)] + [(2, t, "user", f"t{t}.") for t in range(40)]
    df = cv.damage(spark.createDataFrame(rows, SCHEMA))
    assert judged(df, size=size, passes=passes) == wanted(rows)


def test_one_conversation_over_all_partitions(spark):
    r = random.Random(5)
    rows = [(7, t, r.choice(["user", "assistant"]), f"turn {t}" + r.choice([".", "", "!"])) for t in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("missing", F.lit(False))
    whole = judged(df)
    assert whole == judged(df, size=97, passes=1) and len(whole) == 1
    row = whole[0]
    turns = cv.repaired(df, size=500).orderBy("place").collect()
    assert [t["edit"] for t in turns] == [e for e in row[7] if e != "D"]
    assert [t["role"][0] for t in turns] == ["u", "a"] * (len(turns) // 2)
    assert brute.sha("\n".join(f"{t['role']}:{t['text']}" for t in turns)) == row[8]


def test_odd_rows(spark):
    gone = next(c for c in range(999) if brute.damage([(c, 0, "user", "x")])[0] == [])
    rows = [(gone, 0, "user", "x")] + [(c, None, "user", "same.") for c in (1, 1, 1)] + [(5, 3, None, None)] \
        + [(6, 1, "assistant", "long " * 200_000)]
    df = cv.damage(spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "key", "rid", "missing", "hit")}))
    got = judged(df)
    assert got == wanted(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", brute.sha("")) in got
    assert judged(df.limit(0)) == []


def test_query(spark):
    got = sorted((tuple(r) for r in QUERIES["op12_conversation_repair"](spark, SF).collect()), key=key)
    assert got == wanted(table("conversations", "select conv_id, turn, role, text from conversations"))
