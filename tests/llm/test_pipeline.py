"""The pipeline against plain versions of its stages, and its stages on odd tables."""

import array

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from kestrel.llm import pii
from kestrel.llm.transducer import MODEL_PATH
from tests.llm import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_least(docs):
    """One of each SimHash component: the smallest id."""
    group = brute.components([brute.simhash(d["text"]) for d in docs])
    least = {}
    for d, g in zip(docs, group):
        least[g] = min(least.get(g, d["doc_id"]), d["doc_id"])
    return [d for d, g in zip(docs, group) if d["doc_id"] == least[g]]


def test_run_against_plain_stages(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute.quality([(d["doc_id"], d["text"], d["source"]) for d in docs])
    docs = [d | {"text": w[9]} for d, w in zip(docs, judged) if w[8]]
    docs = keep_least(docs)
    dirty = brute.contamination([(d["doc_id"], d["text"]) for d in docs], items)
    docs = [d for d, w in zip(docs, dirty) if not w[4]]
    table = spark.createDataFrame([(d["text"],) for d in docs], "text string")
    model = pii.train(table)
    base = [pii.base_spans(d["text"]) for d in docs]
    assert [[(pii.KINDS[k], a, b) for k, a, b in s] for s in base] == [brute.base_spans(d["text"]) for d in docs]
    more = pii.added_spans(model, [d["text"] for d in docs], base)
    texts = [pii.mask(d["text"], a + b) for d, a, b in zip(docs, base, more)]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    want = [(d["doc_id"], d["lang"], d["source"], len(t), sp.encode(t)) for d, t in zip(docs, texts)]
    got = corpus_pipeline.run(spark, SF)
    rows = [(r["doc_id"], r["lang"], r["source"], r["n_chars"], r["ids"]) for r in got.orderBy("doc_id").collect()]
    assert rows == sorted(want)
    for r, (*_, ids) in zip(got.orderBy("doc_id").collect(), sorted(want)):
        assert r["round_trip"] and r["n_pieces"] == len(ids)
        assert r["ids_sha256"] == __import__("hashlib").sha256(array.array("i", ids).tobytes()).hexdigest()


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == \
        ["quality rules", "near duplicates", "decontamination", "personal data", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


ODD = [(1, None, None, None, None), (None, "", "en", "s", 0), (None, None, None, None, None),
       (2, "call +1 (456) 555-2186 " + " ".join(f"w{i}x" for i in range(80)), "en", None, 9),
       (2, "call +1 (456) 555-2186 " + " ".join(f"w{i}x" for i in range(80)), "en", None, 9),
       (None, " ".join(f"v{i}y" for i in range(60)), None, "s", None), (3, "z" * 300_000, "en", "s", 3)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_every_stage_takes_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == COLUMNS and out.schema == docs.schema
        n = out.count()
        assert n == {"quality rules": 3, "near duplicates": 4, "personal data": 7, "sentencepiece": 7,
                     "decontamination": 7}[name] if rows else n == 0, name


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD],
                                 "doc_id long, text string, lang string, source string, n_chars long, fp int, kept string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.filter(F.col("kept") != "x").count() == 0, name
