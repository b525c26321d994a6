"""Substring dedup: anchors, whole results against a plain count of all windows, odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import recompression as rc
from kestrel.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_queries import SF, documents


def judged(df, **options):
    return sorted((tuple(r) for r in rc.judge(df, **options).collect()), key=lambda r: (r[0] is not None, r))


def plain(rows, window):
    return sorted(brute.repeats(rows, window), key=lambda r: (r[0] is not None, r))


def planted(seed, size=60):
    """Texts over few words: copies, shared passages, loops, texts around the window's length."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Ü", "w\u00a0x", "\u4e2d\u6587"]
    passage = [" ".join(r.choices(words, k=n)) for n in (4, 6, 7, 12, 30)]
    out = []
    for i in range(size):
        parts = []
        for _ in range(r.randrange(5)):
            kind = r.randrange(4)
            parts.append(" \n\t".join(r.choices(words, k=r.randrange(9))) if kind < 2 else r.choice(passage) if kind < 3
                         else " ".join(r.choices(words, k=2) * r.randrange(8)))
        out.append((i, " ".join(parts)))
    return out + [(900, out[3][1]), (901, out[3][1]), (902, "w1 " * 40), (903, "w1 w2 w3 " * 15)]


@pytest.mark.parametrize("seed, window, rounds", [(1, 6, 0), (2, 6, 1), (3, 7, 2), (4, 9, 3), (5, 12, 5)])
def test_against_all_windows(spark, seed, window, rounds):
    rows = planted(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    # a bitmap of few bits only lets more rows through
    assert judged(df, window=window, rounds=rounds, bits=15 if seed % 2 else 18) == plain(rows, window)


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(7)
    for window, rounds in ((5, 1), (9, 3), (20, 4)):
        words = rc.mix(r.integers(0, 4, 3000).astype(np.uint64))
        first = np.append(np.arange(0, 3000, 150), 3000)
        sig, a, m, _, _ = rc.anchors(words, first, window, rounds)
        own = dict(zip(rc._each(a, m).tolist(), np.repeat(sig, m).tolist()))
        assert sorted(own) == [p for b in first[:-1] for p in range(b, b + 150 - window + 1)]
        by_text = {}
        for p, s in own.items():
            assert by_text.setdefault(words[p:p + window].tobytes(), s) == s


def test_names_shrink_and_contexts_grow():
    words = rc.mix(np.arange(500, dtype=np.uint64))
    levels = list(rc.levels(words, np.array([0, 500]), 4))
    sizes = [len(name) for name, *_ in levels]
    assert sizes[0] == 500 and all(b < a for a, b in zip(sizes, sizes[1:]))
    for _, begin, end in levels:
        assert (np.diff(begin) >= 0).all() and (np.diff(end) >= 0).all()
    runs = list(rc.levels(np.repeat(words[:3], [4, 1, 9]), np.array([0, 14]), 1))[1]
    assert len(runs[0]) <= 3


def test_odd_rows(spark):
    long = " ".join(f"a{k}" for k in range(40))
    rows = [(1, long, "x"), (1, long, "y"), (None, long, "z"), (None, None, None), (2, None, "x"), (3, "", ""),
            (4, " \n\t ", ""), (5, "a1 a2", ""), (6, "b " + long[:-2] + " c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    df = df.withColumns({c: F.lit(7) for c in ("id", "rid", "sig", "h", "n", "sha256", "__marked", "text_key")})
    assert judged(df) == plain([r[:2] for r in rows], 35)
    assert judged(df.limit(0)) == []


def test_a_very_long_text_and_many_copies(spark):
    r = random.Random(3)
    words = [f"x{k}" for k in range(5000)]
    long = " ".join(r.choices(words, k=300_000))
    inner = " ".join(long.split()[1000:1100])
    rows = [(0, long), (1, "start " + inner + " end")] + [(k, "copy " + inner) for k in range(2, 600)]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert [r[1:3] for r in got] == [(300_000, 100), (102, 100)] + [(101, 101)] * 598


def test_query(spark):
    got = sorted(tuple(r) for r in QUERIES["op13_substring_dedup"](spark, SF).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == sorted(brute.repeats(documents()))
