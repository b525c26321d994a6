"""Archives, URLs, pieces, token counts, personal data, chat: edge rows and plain versions."""

import gzip
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import chat, pii, token_counts, transducer, urls, warc
from kestrel.llm.lexicon import BPE, BYTE, UNIGRAM, UNKNOWN, Lexicon
from tests.llm import brute

MODEL = open(transducer.MODEL_PATH, "rb").read()
FST = transducer.Transducer(Lexicon.read(MODEL))

# ---------------------------------------------------------------- archives

BIG = "x" * 150
PAGES = [(5, "http://a.b/c d\n", BIG), (3, "http://a.b/é", BIG), (9, None, BIG), (None, "u", BIG), (4, "u", "short"),
         (2, "u", "short"), (7, "u", None), (8, "u", ""), (11, "u", "WARC/1.1\r\n\r\n1 2 3 4 5\n" * 9),
         (12, "u", "ü" * 99), (12, "u", "ü" * 99), (13, "u", "long " * 500_000), (14, "u", "y" * 99), (15, "u", "y" * 99)]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES],
                                  "page_id long, url string, html string, path string, offset int").repartition(3)
    got = sorted(([r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]]
                  for r in warc.convert_pages(pages).collect()), key=str)
    first = {}
    for i, _, html in PAGES:
        if len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, (True, 0)), (i is None, i or 0))
    want, seen = [], set()
    for i, _, html in PAGES:
        raw = (html or "").encode()
        again = len(raw) >= 100 and ((i is None, i or 0) != first[html] or html in seen)
        if len(raw) >= 100 and not again:
            seen.add(html)
        want.append([i, len(raw), brute.sha(html or ""), "revisit" if again else "response",
                     first[html][1] if again else None])
    assert got == sorted(want, key=str)


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.convert_pages(pages).collect() == []


def test_archive_versions_are_parsed_by_their_own_fields():
    def file(version):
        body = f"{version} 0 test\n{warc._ARC_FIELDS[version]}\n".encode()
        out = [warc.arc_record(version, "filedesc://old.arc", "19970101000000", "text/plain", body)]
        out.append(warc.arc_record(version, "http://h/a b", "19970102030405", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n\xff\n\n"))
        out.append(b"no header line")
        out.append(warc.arc_record(version, "dns:h", "199701020304", "text/dns", b"1.2.3.4"))
        return b"\n".join(out) + b"\n"

    for version in (1, 2):
        for content in (file(version), gzip.compress(file(version))):
            recs = list(warc.arc_records(content))
            assert [r["URL"] for r in recs] == ["filedesc://old.arc", "http://h/a%20b", "dns:h"]
            assert [r["version"] for r in recs] == [version] * 3 or version == 2
            assert recs[1]["content"].endswith(b"\xff\n\n") and recs[2]["short"] == 0
            made = list(warc.warc_records(b"\r\n\r\n".join(warc.warc_record(r, "p") for r in recs) + b"\r\n\r\n"))
            assert [h["WARC-Type"] for h, _ in made] == ["warcinfo", "response", "resource"]
            assert made[1][0]["WARC-Date"] == "1997-01-02T03:04:05Z" and made[1][1] == recs[1]["content"]
            assert made[1][0]["WARC-Payload-Digest"] == "sha256:" + __import__("hashlib").sha256(b"\xff\n\n").hexdigest()
            assert len({h["WARC-Record-ID"] for h, _ in made}) == 3
    cut = list(warc.arc_records(file(1)[:-5]))
    assert cut[-1]["short"] == 4 and b"WARC-Truncated: length" in warc.warc_record(cut[-1], "p")
    assert warc.warc_date("nonsense") == "1970-01-01T00:00:00Z" and warc.warc_date("19990231000000").startswith("1970")


# -------------------------------------------------------------------- URLs

def test_url_parts_and_rules(spark):
    rows = [(1, "HTTP://WWW.Example.COM/en/x?q#f"), (2, "http://a.example.com/en/1"), (3, "http://example.com"),
            (4, "http://x.net/fr/a"), (5, "http://notexample.com/en/"), (6, None), (7, "no scheme"), (8, ""),
            (9, "http://h?x/y"), (10, "http://É.org/ä//"), (10, "http://É.org/ä//"), (None, "x://net/es/"),
            (11, "http://o.org/" + "a/" * 3000), (12, "http://o.org/{n}/*/{x}")]
    pages = spark.createDataFrame([(i, u, "c", 3) for i, u in rows], "page_id long, url string, host string, n int")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (None, 0, 1), (10, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in urls.judge(pages, labels).collect()}
    assert len(got) == len(rows) - 1
    assert got[1, "www.example.com", "/en/x"] == ("www.example.com/en/", "allow")
    assert got[2, "a.example.com", "/en/1"] == ("example.com/en/", "block")
    assert got[3, "example.com", ""] == (None, "allow")
    assert got[4, "x.net", "/fr/a"] == ("net/fr/", "block")
    assert got[5, "notexample.com", "/en/"] == ("com/", "allow")
    assert got[6, "", ""] == got[7, "", ""] == got[8, "", ""] == (None, "allow")
    assert got[9, "h", ""] == (None, "allow") and got[10, "É.org", "/ä//"] == (None, "allow")
    assert got[None, "net", "/es/"] == ("net/es/", "block")
    assert urls.judge(pages.limit(0), labels).collect() == [] and urls.judge(pages, labels.limit(0)).count() == len(rows)


def plain_templates(rows, max_children, min_share, max_shape, max_z):
    """rows: (host, form tuple, bad or None) per page -> template per (host, form)."""
    keys = {(h, f): "" for h, f, _ in rows}
    for k in range(max((len(f) for _, f, _ in rows), default=0)):
        nodes = {}
        for h, f, bad in rows:
            if len(f) > k:
                shape = re.sub(r"[^\W\d_]+|%", lambda m: m[0], f[k + 1]) if len(f) > k + 1 else "/"
                shape = re.sub(r"(?:[^\W\d_]|%)+", "a", shape) if len(f) > k + 1 else "/"
                nodes.setdefault((h, keys[h, f]), {}).setdefault(f[k], []).append((shape, bad))
        stars = set()
        for node, children in nodes.items():
            pages = [x for own in children.values() for x in own]
            marked = [b for _, b in pages if b is not None]
            if len(children) < 2:
                continue
            for child, own in children.items():
                rare = len(children) > max_children and len(own) < min_share * len(pages)
                apart = 1 - sum(min(sum(s == x for s, _ in own) / len(own), sum(s == x for s, _ in pages) / len(pages))
                                for x in {s for s, _ in own})
                lab = [b for _, b in own if b is not None]
                alike = True
                if lab:
                    rate = sum(marked) / len(marked)
                    alike = abs(sum(lab) / len(lab) - rate) <= max_z * (rate * (1 - rate) / len(lab)) ** 0.5
                if rare or round(apart, 9) <= max_shape and alike:
                    stars.add((node, child))
        keys = {(h, f): t if len(f) <= k else t + "/" + ("*" if ((h, t), f[k]) in stars else f[k])
                for (h, f), t in keys.items()}
    return keys


def test_url_templates_against_plain_version(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        host = rng.choice(["a", "a", "b"])
        kind = rng.choice(["shop", "blog", "news", "spam"])
        leaf = {"shop": f"item-{i % 50}/view.html", "blog": f"{rng.choice('xyzw')}{rng.choice('pqrs')}k/{i}",
                "news": f"{2000 + i % 9}/{i % 12}/story", "spam": f"win{i}"}[kind]
        rows.append((i, f"http://{host}/{kind}/{leaf}" + rng.choice(["", "/", "?q"])))
        if rng.random() < 0.7:
            labels.append((i, 0 if rng.random() < (0.95 if kind == "spam" else 0.1) else 1, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    options = {"max_children": 6, "min_share": 0.05, "max_shape": 0.25, "max_z": 2.0}
    formed = urls.forms(pages, marks)
    got = {(r["host"], tuple(r["form"])): r["template"] for r in urls.templates(formed, **options).collect()}
    plain = [(r["host"], tuple(r["form"]), r["bad"]) for r in formed.collect()]
    assert got == plain_templates(plain, *options.values())
    judged = urls.judge(pages, marks, **options).collect()
    bad = {i for i, (_, u) in enumerate(rows) if "/spam/" in u}
    assert {r["page_id"] for r in judged if r["verdict"] == "block"} == bad


# ------------------------------------------------------------------ pieces

@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("  ab\n\t▁éthe ing𝄞_-.,12\r"), max_size=30) | st.text(max_size=20))
def test_pieces_equal_the_library(text):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=transducer.MODEL_PATH)
    text = text.encode("utf-8", "ignore").decode()
    if "\0" in text:  # the library's own reading ends there
        return
    assert FST.encode(text) == sp.encode(text)
    assert FST.decode(FST.encode(text)) == text.replace("▁", " ") == sp.decode(sp.encode(text))


def small_lexicon(kind):
    pieces = ["<unk>", "a", "b", "c", "ab", "bc", "abc", "ca", "aa", "▁", "▁a", "▁ab", "cab"]
    scores = [0.0, -3.0, -3.5, -4.0, -4.2, -4.9, -6.5, -5.0, -5.0, -2.0, -4.0, -5.5, -8.0]
    types = [UNKNOWN] + [1] * (len(pieces) - 1)
    fallback = [f"<0x{i:02X}>" for i in range(256)]
    return Lexicon(pieces + fallback, scores + [-50.0] * 256, types + [BYTE] * 256, kind, byte_fallback=True)


def segmentations(text):
    for cut in itertools.product([0, 1], repeat=max(len(text) - 1, 0)):
        out, last = [], 0
        for i, c in enumerate(cut, 1):
            if c:
                out.append(text[last:i])
                last = i
        yield [*out, text[last:]] if text else []


def best_unigram(text, lx):
    """(cost, tokens) of the best of all segmentations."""
    unknown = max(-lx.scores[i] for i in lx.ids.values()) + 10
    found = []
    for parts in segmentations(text):
        if all(p in lx.ids or len(p) == 1 for p in parts):
            cost = sum(-lx.scores[lx.ids[p]] if p in lx.ids else unknown for p in parts)
            found.append((round(cost, 6), sum(1 if p in lx.ids else len(p.encode()) for p in parts)))
    return min(found)


def test_unigram_paths_against_all_segmentations():
    lx = small_lexicon(UNIGRAM)
    fst, rng = transducer.Transducer(lx), random.Random(6)
    texts = ["".join(rng.choice("aabc éx") for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    for text in texts:
        ids = fst.encode(text)
        own = lx.spaced(text).replace(" ", "▁")
        unknown = sum(c not in lx.ids for c in own)
        cost = sum(-lx.scores[i] for i in ids if lx.types[i] == 1) + \
            unknown * (max(-lx.scores[i] for i in lx.ids.values()) + 10)
        assert round(cost, 6) == best_unigram(own, lx)[0]
        assert fst.decode(ids) == text
    words = sorted({lx.spaced(t).replace(" ", "▁") for t in texts})
    rng.shuffle(words)
    assert token_counts.trie_counts(words, lx) == [best_unigram(w, lx)[1] for w in words]


def test_bpe_paths_against_merging():
    lx = small_lexicon(BPE)
    fst, rng = transducer.Transducer(lx), random.Random(7)
    for _ in range(500):
        text = "".join(rng.choice("aabcb ") for _ in range(rng.randrange(0, 14)))
        own = lx.spaced(text).replace(" ", "▁")
        assert [lx.pieces[i] for i in fst.encode(text)] == fst.merged(own)


def test_token_counts_are_those_of_another_unigram_library():
    from tokenizers import models
    lx = Lexicon.read(MODEL)
    low = min(lx.scores[i] for i in lx.ids.values() if lx.scores[i] > -1e6)
    other = models.Unigram([(p, s) for p, s in zip(lx.pieces, lx.scores)], 0, True)
    words = ["▁the", "▁thonoren", "▁reea", "▁ertiondst", "▁Züäß", "▁123", "▁naïve▁", "thing"]
    for word, n in zip(words, token_counts.trie_counts(words, lx)):
        own = [t.value for t in other.tokenize(word)]
        assert all(p in lx.ids for p in own) and low < 0
        # of equal sums of scores either may be chosen
        parts = FST._unigram_path(word)
        assert sum(lx.scores[lx.ids[p]] for p in own) == sum(lx.scores[lx.ids[p]] for p in parts)
        assert n <= len(own)


def test_recent_paths_are_bounded():
    kept = transducer._Recent(3)
    for i in range(10):
        kept.keep(i, i)
    assert len(kept) <= 3 and len(kept.old) <= 3 and kept[9] == 9 and kept[0] is None


def test_encode_keeps_rows(spark):
    rows = [(1, "The thing\n  and ü"), (2, None), (3, ""), (1, "The thing\n  and ü"), (None, "𝄞" * 50_000), (4, "a▁b")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, ids int")
    got = transducer.encode(docs.drop("ids"), ["doc_id"]).collect()
    assert [(r["doc_id"], r["n_pieces"], r["ids"], r["round_trip"]) for r in got] == \
        [(i, len(FST.encode(t or "")), FST.encode(t or ""), True) for i, t in rows]
    counts = token_counts.count_tokens(docs).collect()
    assert [(r["doc_id"], r["n_tokens"] > 0) for r in counts] == [(i, bool(t)) for i, t in rows]
    assert transducer.encode(docs.limit(0), ["doc_id"]).collect() == []


# ----------------------------------------------------------- personal data

@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("a1@.+- (4)0\n%5é"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == brute.base_spans(text)


PEOPLE = ["reach a.b@mail.example.com or 10.0.0.1 and 300.1.1.1 now", "card 4111 1111 1111 1111 not 4111 1111 1111 1112",
          "call +1 (456) 555-2186 today, again (456) 555-2186 ok", None, "", "nothing here", "x" * 200_000 + "@",
          "1" * 100_000, "a@b.c " * 3000, "call +1 (456) 555-2186 today, again (456) 555-2186 ok"]


def test_messages_give_exact_marginals_on_trees():
    rng = np.random.default_rng(0)
    model = pii.Model({}, np.zeros((1, 5)), rng.normal(size=(5, 5)), np.zeros((5, 5)))
    model.skip = (s := rng.normal(size=(5, 5))) + s.T
    graph = pii.Graph()
    graph.spans, graph.features, graph.fixed = [(0, i, i + 1) for i in range(5)], [["bias"]] * 5, [-1, -1, 2, -1, -1]
    graph.edge, graph.chain, graph.skip = [(1, 0), (0, 1), (1, 1), (1, 0), (0, 1)], [(0, 1), (3, 4)], [(1, 2), (0, 3)]
    own = model.unaries(graph)
    total = np.zeros((5, 5))
    for y in itertools.product(range(5), repeat=5):
        if y[2] != 2:
            continue
        w = sum(own[i, y[i]] for i in range(5)) + sum(model.chain[y[a], y[b]] for a, b in graph.chain) + \
            sum(model.skip[y[a], y[b]] for a, b in graph.skip)
        for i in range(5):
            total[i, y[i]] += np.exp(w)
    want = total / total.sum(axis=1, keepdims=True)
    assert np.allclose(pii.beliefs(model, graph, rounds=200, settle=1e-12), want, atol=1e-6)


def test_field_is_learnt_and_carries_labels_to_like_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train(docs)
    texts = [r[0] for r in docs.filter("pmod(xxhash64(text), 2) = 1").select("text").collect()]
    graph = pii.Graph()
    for i, t in enumerate(texts):
        graph.add(i, t, pii.base_spans(t))
    gold = np.maximum(np.array(graph.fixed), 0)
    graph.fixed = [-1] * len(gold)
    assert (pii.beliefs(model, graph).argmax(axis=1) == gold).mean() > 0.98 and len(gold) > 300
    # on clean texts nothing is added; a dropped base match with its neighbour's digits is found
    clean = [t for t in texts if not pii.base_spans(t)]
    assert sum(map(len, pii.added_spans(model, clean, [[] for _ in clean]))) == 0
    text = "Des +1 (826) 555-4081 190.137.223.204 du"
    base = pii.base_spans(text)
    assert [pii.KINDS[k] for k, _, _ in base] == ["ip"]
    assert [text[a:b] for _, a, b in pii.added_spans(model, [text], [base])[0]] == ["+1 (826) 555-4081"]


def test_find_and_redact(spark):
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), "k") for i, t in enumerate(PEOPLE)],
                                 "doc_id long, text string, n_chars long, spans string")
    model = pii.train(docs)
    found = pii.find(docs, model).orderBy("doc_id").collect()
    for row, text in zip(found, PEOPLE, strict=True):
        assert [tuple(s) for s in row["base_spans"]] == brute.base_spans(text)
        assert set(map(tuple, row["base_spans"])) <= set(map(tuple, row["spans"]))
    out = pii.redact(docs, model)
    assert out.schema == docs.schema
    rows = out.orderBy("doc_id").collect()
    assert rows[0]["text"].startswith("reach [EMAIL] or [IP] and 300.1.1.1 now")
    assert "[CARD]" in rows[1]["text"] and "[PHONE]" in rows[2]["text"] and rows[3]["text"] is None
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    assert not any(brute.base_spans(r["text"]) for r in rows)
    assert pii.train(docs.limit(0)) is None and pii.find(docs.limit(0), None).collect() == []
    assert pii.find(docs, None).count() == len(PEOPLE)


# -------------------------------------------------------------------- chat

@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<|im_end>\\\nstart ok\r")), st.text(st.sampled_from("<|us\\\nn")))
def test_control_strings_are_escaped_reversibly(text, role):
    t = chat.CHAT
    formatted = "".join(part for part, _ in t.segments(role, text))
    assert formatted.count(t.begin) == 1 and formatted.count(t.end) == 1
    assert t.plain(t.quoted(text)) == text and t.plain_role(t.quoted_role(role)) == role
    reader = chat._Reader(t, 1)
    for c in formatted:
        reader.feed(c, False, True, True)
    assert reader.turns == 1 and reader.all.hexdigest() == brute.sha(f"{role}\n{text}\n")


def test_conversations(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo <|im_end|>\n"), (2, 0, "assistant", "x"),
            (2, 1, "assistant", None), (3, None, None, None), (None, 1, "user", "b"), (None, 0, "user", "a"),
            (None, 2, "assistant", "c" * 100_000), (4, 1, "user", "u"), (4, 1, "user", "u"), (5, 0, "odd", "é")]
    rows += [(6, i, "user" if i % 2 == 0 else "assistant", f"t{i}\\") for i in range(3000)]  # most rows are one conversation's
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "s", True) for r in rows],
                               "conv_id long, turn long, role string, text string, segment string, loss boolean")
    got = {r["conv_id"]: r for r in chat.read_back(chat.segments(df)).collect()}
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        said = "".join(t or "" for _, _, r, t in own if r == "assistant")
        row = got.pop(conv)
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == brute.sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(said), brute.sha(said))
        assert row["valid"] == (conv in (1, 6))
    assert not got
    assert chat.read_back(chat.segments(df.limit(0))).collect() == []
    parts = chat.segments(df.filter("conv_id = 1")).orderBy("segment").collect()
    assert [p["loss"] for p in parts] == [False] * 7 + [True, False]
    assert parts[3]["text"] == "<|im_start|>user\n"


@pytest.mark.parametrize("order, valid", [(["user", "assistant"], True), (["system", "user"], True),
                                          (["assistant"], False), (["user", "user"], False),
                                          (["user", "assistant", "tool", "assistant"], True),
                                          (["system", "assistant"], False), (["user", "system"], False)])
def test_machine(order, valid):
    state, allowed = chat.CHAT.start, []
    for role in order:
        state, ok = chat.CHAT.step(state, role)
        allowed.append(ok)
    assert all(allowed) == valid


def test_pages_of_one_payload(spark):
    """Two thirds of the records repeat one payload."""
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.when(F.col("id") % 3 > 0, "z" * 500).otherwise(F.col("id").cast("string")).alias("html"))
    got = warc.convert_pages(pages.repartition(4)).collect()
    assert sum(r["record_type"] == "revisit" and r["refers_to"] == 1 for r in got) == 199 and len(got) == 300


def test_archives_keep_long_ids_and_filedesc_pages(spark):
    low, high = -1 << 63, (1 << 63) - 1
    rows = [(high, "u", BIG), (10**18, "filedesc://a.arc", BIG), (low, "filedesc:x", "own " * 40),
            (-10**18, "filedesc://b", "1 0 x\na b c\n"), (7, "u", BIG), (8, None, "last")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["id"]: (r["url"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in warc.convert_pages(pages).collect()}
    want = {i: (u or "-", brute.sha(t), "revisit" if t == BIG and i != 7 else "response",
                7 if t == BIG and i != 7 else None) for i, u, t in rows}
    assert got == want
    again = spark.createDataFrame([(high, "u", BIG), (high - 1, "u", BIG)], "page_id long, url string, html string")
    assert {(r["id"], r["refers_to"]) for r in warc.convert_pages(again).collect()} == {(high, high - 1), (high - 1, None)}
    assert [warc._number(t) for t in (str(high), str(low), str(high + 1), str(low - 1), "0" * 5000 + "12", "-007", "x", "", None)] \
        == [high, low, None, None, 12, -7, None, None, None]


def test_rare_bad_branch_of_a_hot_node_is_blocked(spark):
    """An all-bad branch of 1.5 % of the pages below a node with more than 20 children."""
    names = [f"{a}{b}" for a in "abcdef" for b in "pqrst"]
    rows = [(i, f"http://hot/{names[i % 30]}/story.html") for i in range(3940)]
    rows += [(4000 + i, "http://hot/spam/story.html") for i in range(60)]
    rows += [(5000 + i, f"http://hot/rare{c}/story.html") for i, c in enumerate("xyz")]  # too few labels to tell
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame([(i, 0 if 4000 <= i < 4060 or i == 5000 else 1, 0) for i, _ in rows],
                                  "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["verdict"], r["template"]) for r in urls.judge(pages, marks).collect()}
    assert {i for i, (v, _) in got.items() if v == "block"} == set(range(4000, 4060))
    assert got[4000][1].startswith("/spam") and {got[i][1].split("/")[1] for i in (5000, 5001, 5002)} == {"*"}


def test_base_span_reaches_all_its_repeats():
    """Some hundred repeats after one base span, most of them far from it."""
    bias = np.zeros((2, 5))
    bias[1, 0] = 1.5
    model = pii.Model({"bias": 1}, bias, np.zeros((5, 5)), 3 * np.eye(5))
    text = "call +1 (826) 555-4081 " + "and 555-4081 " * 400
    found = pii.added_spans(model, [text], [pii.base_spans(text)])[0]
    assert [text[a:b] for _, a, b in found] == ["555-4081"] * 400 and {pii.KINDS[k] for k, _, _ in found} == {"phone"}


def line_graph(doc, n, graph=None):
    graph = graph or pii.Graph()
    at = len(graph.spans)
    graph.spans += [(doc, i, i + 1) for i in range(n)]
    graph.features += [["bias"]] * n
    graph.fixed += [4] + [-1] * (n - 1)
    graph.edge += [(0, 0)] * n
    graph.skip += [(at + i, at + i + 1) for i in range(n - 1)]
    return graph


def test_each_document_runs_until_it_settles():
    model = pii.Model({}, np.zeros((1, 5)), np.zeros((5, 5)), 5 * np.eye(5))
    own = pii.beliefs(model, line_graph(0, 150))
    want = np.linalg.matrix_power(np.exp(model.skip) / np.exp(model.skip).sum(axis=1), 100)[4]
    assert np.allclose(own[100], want, atol=5e-3)
    short = pii.beliefs(model, line_graph(0, 20))
    both = pii.beliefs(model, line_graph(1, 150, line_graph(0, 20)))
    assert np.array_equal(both[:20], short) and np.array_equal(both[20:], own)


def test_messages_that_swing_come_to_rest():
    rng = np.random.default_rng(1)
    model = pii.Model({}, np.zeros((1, 5)), np.zeros((5, 5)), -6 * np.eye(5))
    graph = line_graph(0, 12)
    graph.skip = [(a, b) for a in range(12) for b in range(a + 1, 12) if rng.random() < 0.8]
    assert np.isfinite(pii.beliefs(model, graph)).all()


def test_copies_do_not_change_the_model(spark, monkeypatch):
    texts = [f"{w} no{i}x and tel +1 (456) 555-{1000 + i} or {i}@{w}.org" for i in range(60) for w in ("a", "b")]
    texts.append("1a" * 500_000 + " 7")
    seen, fit = [], pii.fit
    monkeypatch.setattr(pii, "fit", lambda g, **o: seen.append((g.features, g.fixed, g.skip)) or fit(g, steps=1))
    for copies in (1, 5):
        docs = spark.createDataFrame([(t,) for t in texts * copies], "text string").repartition(5)
        pii.train(docs, sample_docs=1000, sample_tokens=300)
    assert seen[0] == seen[1] and 300 <= len(seen[0][1]) < 310


def test_archives_with_many_revisits_move_no_payloads(spark, tmp_path, monkeypatch):
    """A small, crowded bitmap takes other records for revisits; the result stays the same.  Records that
    it lets pass meet no exchange but broadcasts."""
    pages = spark.range(1200).selectExpr("id AS page_id", "concat('http://h/', id) AS url",
                                         "repeat(concat('<p>', if(id % 3 = 0, id, id % 50), '</p>'), 40) AS html")
    monkeypatch.setattr(warc, "BITS", 16)
    seen = []
    others = warc._others

    def crowded(table, again, bits):
        out = others(table, again, 16)
        seen.append(out[0]._jdf.queryExecution().executedPlan().toString())
        seen.append((again.count(), out[0].count(), out[1].count()))
        return out

    monkeypatch.setattr(warc, "_others", crowded)
    got = {r["id"]: r for r in warc.convert_pages(pages).collect()}
    assert len(got) == 1200
    want, first = {}, {}
    for r in pages.orderBy("page_id").collect():
        want[r.page_id] = first.get(r.html)
        first.setdefault(r.html, r.page_id)
    assert {k: r["refers_to"] for k, r in got.items()} == want
    assert all(r["record_type"] == ("response" if want[k] is None else "revisit") for k, r in got.items())
    plan, (n_again, n_passing, n_mistaken) = seen
    assert not [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert n_mistaken > 0 and n_again == sum(x is not None for x in want.values())
    files = spark.sparkContext.defaultParallelism
    assert 1200 <= n_again + n_passing + n_mistaken <= 1200 + files + 1


def test_paths_are_remembered_by_bytes():
    kept = transducer._Recent(1000, 4000)
    for k in range(100):
        kept.keep(str(k), bytes(50))
        assert kept.held <= 4000
    assert kept["99"] == bytes(50) and kept["0"] is None and len(kept) + len(kept.old) < 40
    assert kept.keep("long", bytes(3000)) == bytes(3000) and kept["long"] is None
