"""Each registered query against its SQL, or its rows against a plain version."""

import os

import duckdb
import pytest

from kestrel.llm.oracle import ORACLE
from kestrel.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows(name, sql=None):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    return con.execute(sql).fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: [(x is None, x) for x in r]
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)


def documents():
    return rows("documents", "select doc_id, text from documents order by doc_id")


def test_simhash_query(spark):
    got = [tuple(r) for r in QUERIES["op5_simhash"](spark, SF).orderBy("doc_id").collect()]
    assert got == brute.near_duplicates(documents())


def test_sentencepiece_query(spark):
    import array

    import sentencepiece

    from kestrel.llm.transducer import MODEL_PATH
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    import hashlib
    want = []
    for i, text in documents():
        ids = sp.encode(text)
        want.append((i, len(ids), hashlib.sha256(array.array("i", ids).tobytes()).hexdigest(), True))
    assert [tuple(r) for r in QUERIES["op7_sentencepiece"](spark, SF).orderBy("doc_id").collect()] == want


def test_pii_query(spark):
    got = QUERIES["op9_pii"](spark, SF).orderBy("doc_id").collect()
    for (i, text), row in zip(documents(), got, strict=True):
        base = brute.base_spans(text)
        assert row["doc_id"] == i
        assert [row[f"n_{k}"] for k, _ in brute.BASE] == [sum(s[0] == k for s in base) for k, _ in brute.BASE]
        coded = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row["base_sha256"] == brute.sha(",".join(coded))
        assert set(coded) <= set(row["spans"].split(",")) | ({""} if not coded else set())


def test_url_query(spark):
    got = QUERIES["op6_url_filter"](spark, SF).orderBy("page_id").collect()
    pages = rows("pages", "select page_id, url from pages order by page_id")
    listed = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
    for (i, url), row in zip(pages, got, strict=True):
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end].translate(brute.LOWER), rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h + p), h + p, v) for h, p, v in listed
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (row["page_id"], row["host"], row["path"]) == (i, host, path)
        assert row["rule"] == (max(fits)[1] if fits else None)
        assert row["verdict"] == (max(fits)[2] if fits else row["verdict"])
        assert row["verdict"] in ("allow", "block")


def test_token_count_query(spark):
    got = [tuple(r)[:2] for r in QUERIES["op8_token_counts"](spark, SF).orderBy("doc_id").collect()]
    from kestrel.llm.lexicon import Lexicon
    from kestrel.llm.token_counts import MODEL_PATH
    lx = Lexicon.read(open(MODEL_PATH, "rb").read())
    cost = {p: -lx.scores[i] for p, i in lx.ids.items()}
    unknown = max(cost.values()) + 10

    def count(text):  # one plain forward pass over the whole text
        text = lx.spaced(text).replace(" ", "▁")
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            c = text[end - 1]
            own = [(best[end - 1][0] + unknown, best[end - 1][1] + len(c.encode()))]
            for b in range(max(0, end - lx.longest), end):
                if (w := cost.get(text[b:end])) is not None:
                    own.append((best[b][0] + w, best[b][1] + 1))
            best.append(min(own))
        return best[-1][1]

    assert got == [(i, count(t)) for i, t in documents()]
