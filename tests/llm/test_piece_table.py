"""Fill-in-middle: tables, whole results against plain strings, exact round trip, odd rows."""

import random

from pyspark.sql import functions as F

from kestrel.llm import piece_table as pt
from kestrel.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_queries import SF, documents

COLS = ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def order(r):
    return [(x is not None, x) for x in r]


def test_cut_arrange_restore():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choices("ab<PSM> é\n", k=r.randrange(12))).encode()
        a, b = sorted((r.randrange(len(text) + 1), r.randrange(len(text) + 1)))
        assert pt.Table.of(text).cut(a, b).bytes() == text
        if any(s in text for s in (b"<P>", b"<S>", b"<M>")):
            continue
        for form in ("psm", "spm", "plain"):
            out = pt.transform(text, form, a, b)
            back = pt.restore(out.bytes(), form)
            assert back.bytes() == text and len(out.pieces) == (1 if form == "plain" else 6)
            assert out.digest() == brute.sha(out.bytes().decode("latin-1")) or not text.isascii()


def odd():
    rows = [(k, " ".join(random.Random(k).choices(["ab", "É", "x1", "<P", "\n", "中文", "S>", ""], k=k))) for k in range(60)]
    return rows + [(None, "null id here"), (1, None), (1, ""), (2, "a"), (2, "a"), (7, "has <S> in it"), (8, "<M>"),
                   (9, "word " * 300_000)]


def test_whole_results_and_round_trip(spark):
    rows = odd()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(3) for c in ("id", "n", "form", "output", "pieces")})
    out = pt.fill_in_middle(df).cache()
    got = sorted((tuple(r) for r in out.select(*COLS).collect()), key=order)
    assert got == sorted(brute.fill_in_middle(rows), key=order)
    back = sorted((tuple(r) for r in pt.restored(out).collect()), key=order)
    assert back == sorted([(i, x or "") for i, x in rows], key=order)
    assert pt.fill_in_middle(df.limit(0)).collect() == []


def test_query(spark):
    got = QUERIES["op11_fill_in_middle"](spark, SF)
    assert sorted(tuple(r) for r in got.select("doc_id", *COLS[1:]).collect()) == sorted(brute.fill_in_middle(documents()))
