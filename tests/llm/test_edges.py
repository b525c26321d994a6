"""Nulls, empty and long texts, repeated rows, empty tables, clashing extra columns, hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.llm import components, decontaminate, quality, sharding, simhash
from tests.llm import brute

WORDS = ["alpha", "beta", "gamma", "delta", "Épée", "x9", "Zed", "the", "of", "and"]


def text_of(rng, n, words=WORDS, line=9):
    out = [rng.choice(words) for _ in range(n)]
    return "".join(w + ("\n" if i % line == line - 1 else " ") for i, w in enumerate(out))


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


DOC_DDL = ("doc_id long, text string, lang string, source string, n_chars long, rid long, fp string, "
           "line string, kept string")


def documents(spark, rows):
    """Rows (id, text, source) as a table with extra columns of names used inside."""
    return frame(spark, [(i, t, "en", s, None if t is None else len(t), 7, "fp", "line", "kept")
                         for i, t, s in rows], DOC_DDL)


def quality_rows():
    rng = random.Random(5)
    rows = []
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    for i in range(60):
        body = text_of(rng, 110, words)
        # a line that most documents of host a hold, in changing case and spacing; digits differ
        mark = f"Shared  LINE number {i} here" if i % 2 else "shared line  NUMBER 77 here"
        many = "\n".join(" ".join(f"{chr(97 + k)}{c}" for c in "pqrstuvwxyz") for k in range(8))
        host = "a" if i < 45 else None if i < 55 else "b"
        short = i % 7 == 3  # more footer than text
        rows.append((i, (text_of(rng, 20, words) if short else body) + f"\n{mark}\n{many}" * (host != "b"), host))
    rows += [(100, None, "a"), (101, "", "a"), (102, " \n\t\n", None), (103, None, None), (None, rows[1][1], "a"),
             rows[2], rows[2], (104, "be " * 70, "b"), (105, text_of(rng, 30000, words), "a"),
             (106, "#$ <b>| %&*" * 20, "b"), (107, "a\x0bb\x0cc\rd e " * 15, "b")]
    return rows


def test_quality_against_plain_version(spark):
    rows = quality_rows()
    got = sorted((tuple(r) for r in quality.judge(documents(spark, rows)).collect()), key=str)
    want = brute.quality([(i, t, s) for i, t, s in rows])
    assert got == sorted((w[:9] for w in want), key=str)
    assert any(not w[7] and not w[8] for w in want) and any(w[8] and w[6] < w[1] for w in want)


def test_quality_clean_edits_texts_and_keeps_columns(spark):
    rows = quality_rows()
    docs = documents(spark, rows)
    out = quality.clean(docs)
    assert out.schema == docs.schema
    want = sorted((str(i), w[9]) for (i, t, s), w in zip(rows, brute.quality(rows)) if w[8])
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == want
    assert all(r["n_chars"] == len(r["text"]) and r["kept"] == "kept" for r in out.collect())


@pytest.mark.parametrize("made", [
    lambda d, b: quality.judge(d), lambda d, b: quality.clean(d), lambda d, b: simhash.near_duplicates(d),
    lambda d, b: simhash.keep_one(d), lambda d, b: decontaminate.judge(d, b),
    lambda d, b: decontaminate.remove(d, b),
    lambda d, b: sharding.assign(d, F.col("doc_id"), F.octet_length("text"), ["doc_id"])])
def test_empty_tables(spark, made):
    docs, items = documents(spark, []), frame(spark, [], "item_id long, text string")
    assert made(docs, items).collect() == []


def benchmark_rows():
    rng = random.Random(9)
    items = [(i, text_of(rng, rng.choice([1, 2, 5, 8, 12, 13, 14, 20, 40]), WORDS + [f"k{j}" for j in range(40)], 50))
             for i in range(25)]
    items += [(50, None), (51, ""), (52, " .,; "), (None, text_of(rng, 30, ["n1", "n2", "n3", "n4"])),
              (3, items[3][1]), (60, "dup " * 30), (61, items[7][1].upper())]
    docs = []
    for i in range(80):
        parts = [text_of(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, max(1, len(words)))
            parts += [", ".join(words[a:a + rng.choice([5, 12, 13, 14, 30])]), text_of(rng, rng.randrange(0, 30))]
        docs.append((i, "; ".join(parts)))
    docs += [(200, None), (201, ""), (202, "dup " * 500), (203, "DUP,dup " * 6), docs[4], docs[4], (None, docs[5][1]),
             (204, text_of(rng, 40000, [f"z{j}" for j in range(300)]) + items[13][1])]
    return docs, items


@pytest.mark.parametrize("k, bits", [(8, 23), (5, 6)])
def test_decontamination_against_plain_version(spark, k, bits):
    docs, items = benchmark_rows()
    d = documents(spark, [(i, t, "s") for i, t in docs])
    b = frame(spark, [(i, t, 1, 2) for i, t in items], "item_id long, text string, fp int, rid int")
    got = decontaminate.judge(d, b, k=k, bits=bits)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()]
    want = brute.contamination(docs, items)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[4] for w in want) > 10 and sum(not w[4] for w in want) > 10
    left = decontaminate.remove(d, b, k=k, bits=bits)
    assert left.schema == d.schema
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(w[0]) for w in want if not w[4])


def test_winnowing_keeps_a_gram_of_every_shared_window():
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 3, 60), rng.integers(0, 3, 60)
        b[20:33] = a[5:18]
        kept = []
        for x in (a, b):
            words = x.astype(np.uint64) * np.uint64(977) + np.uint64(5)
            at = decontaminate.winnow(decontaminate.gram_hashes(words, 8), np.array([0, 60]), 8, 13)
            kept.append({i for i in at})
        assert {i - 5 for i in kept[0] if 5 <= i <= 10} & {i - 20 for i in kept[1] if 20 <= i <= 25}


def near_rows(rng):
    base = text_of(rng, 300, [f"w{i}" for i in range(200)], 12).split(" ")
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(i, text_of(rng, rng.randrange(1, 200), [f"v{i}" for i in range(300)])) for i in range(60)]
    rows += [(300, None), (301, ""), (302, " "), (303, "one"), (304, "ONE"), (305, "one two"), (None, "one"),
             (None, "only null id here"), rows[3], rows[3], (5, rows[50][1] + " other"),
             (306, text_of(rng, 20000, [f"u{i}" for i in range(900)]))]
    return rows


@pytest.mark.parametrize("options", [{}, {"parts": 4, "task_rows": 16}, {"parts": 2, "task_rows": 8}])
def test_simhash_against_plain_version(spark, options):
    rows = near_rows(random.Random(1))
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = [tuple(r) for r in simhash.near_duplicates(docs, **options).collect()]
    assert sorted(got, key=str) == sorted(brute.near_duplicates(rows), key=str)


def test_simhash_keeps_one_of_each_component(spark):
    rows = near_rows(random.Random(2))
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    group = brute.components([brute.simhash(t) for _, t in rows])
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    got = sorted(str(r["doc_id"]) for r in kept.collect())
    assert got == sorted("None" if none else str(i) for none, i in least.values())


def test_tile_links_equal_all_links():
    import numpy as np
    rng = np.random.default_rng(8)
    seeds = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds, *[seeds ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64))
                                             for _ in range(6)]]))
    u, v = simhash.links(fps, fps, 3, block=8)
    parent = {int(x): int(x) for x in fps}
    for a, b in zip(u, v):
        parent[int(a)] = int(b)
    want = brute.components([int(x) for x in fps])
    assert len(set(parent.values())) == len(set(want)) == 30
    for i in range(len(fps)):
        for j in range(i):
            assert (parent[int(fps[i])] == parent[int(fps[j])]) == (want[i] == want[j])


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    pairs = [(5000, 5001), (5001, 5001), (5001, 5000), (5001, 5000)]
    got = {r["node"]: r["rep"] for r in components.representatives(
        frame(spark, chain + hub + pairs, "u long, v long")).collect()}
    assert len(got) == 201 + 300 + 2
    assert len({got[i] for i in range(201)}) == 1 and len({got[1000 + i] for i in range(300)}) == 1
    assert len(set(got.values())) == 3 and all(got[r] == r for r in got.values())
    assert components.representatives(frame(spark, [], "u long, v long")).collect() == []


@pytest.mark.parametrize("step", [None, 3])
def test_shards_against_plain_version(spark, step):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 50, 400, 999])) for i in range(300)] + [(900, 5000), (None, 10), (901, None)]
    docs = frame(spark, [(i, b, "x") for i, b in rows], "doc_id long, b long, shard string")
    got = sharding.assign(docs, F.col("doc_id"), F.col("b"), ["doc_id", "b"], limit=1000, step=step).collect()
    want = brute.shards([(i, b or 0) for i, b in rows], 1000)
    assert sorted((str(r["doc_id"]), r["shard"]) for r in got) == sorted((str(i), s) for (i, _), s in zip(rows, want))
    assert all(r["shard_bytes"] <= 1000 or r["oversized"] and r["shard_rows"] == 1 for r in got)
    assert [r["doc_id"] for r in got if r["oversized"]] == [900]


def test_one_key_overflows_into_further_buckets(spark):
    rows = [(7, 100)] * 500 + [(i, 100) for i in range(300)]
    docs = frame(spark, rows, "key long, b long")
    got = sharding.assign(docs, F.col("key"), F.col("b"), ["key"], limit=1000).collect()
    assert len(got) == 800 and not any(r["oversized"] for r in got)
    sums = {}
    for r in got:
        sums[r["shard"]] = sums.get(r["shard"], 0) + 100
    assert all(s <= 1000 for s in sums.values())
    assert all(sums[r["shard"]] == r["shard_bytes"] for r in got)
    assert sum("/" in r["shard"] for r in got) in (500, 501)


def test_shards_are_written(spark, tmp):
    rows = [(i, "y" * 50) for i in range(100)]
    docs = frame(spark, rows, "doc_id long, text string")
    table = sharding.write_shards(docs, F.col("doc_id"), F.octet_length("text"), tmp + "/out", limit=600)
    back = spark.read.parquet(tmp + "/out")
    assert back.count() == 100 and table.agg(F.sum("shard_rows")).first()[0] == 100
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).agg(F.max("b")).first()[0] <= 600
