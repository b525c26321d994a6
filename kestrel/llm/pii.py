"""Personal data: base patterns, and a skip-chain conditional random field.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by
pattern.  The random field then labels tokens (runs between ASCII white space)
with the kinds or none:

* each token has potentials of its shape and its neighbours' shapes;
* tokens next to each other share a chain potential;
* tokens of one document that repeat or resemble each other (the same text but
  for case and outer punctuation, or the same last ``TAIL`` digits of at least as many)
  share a skip potential, each with the next one like it, and with the first of them
  that the base labels, if any.

A token without a digit or ``@`` cannot be part of any kind, so its label is fixed to
none; tokens of base spans are fixed to their kind.  Sum-product messages run
along chain and skip links until those of the document settle (the links form
loops; messages that swing are damped harder and harder), so an entity that the
base found at one place is found in its other forms too, however far away.  Tokens whose
belief in a kind reaches ``BELIEF`` become added spans, where they touch no base
span.

The weights are fitted by pseudo-likelihood on the base's labels of a bounded sample
of distinct texts (``SAMPLE_DOCS``, by a hash of the text); everything else covers all
documents.

Defined cases: a null text is empty; texts are looked at whole; equal rows give
equal results; without any sample token no span is added; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored, text_key

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000
SAMPLE_TOKENS = 20_000  # tokens that the weights are fitted on at most
_SAMPLE_TOKENS_PER_DOC = 500
_SAMPLE_TOKEN_CHARS = 256  # a longer sample token keeps its two ends
BELIEF = 0.9
TAIL = 7
ROUNDS = 50
L2 = 0.05

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: it would also match from the run's start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_HINT = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end (code points)


# ------------------------------------------------------------------- base

def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` on: the local part is the whole run
    before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans by kind, then start."""
    if not _HINT.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ------------------------------------------------------- tokens and features

def marked_tokens(text: str) -> list[tuple[int, int]]:
    """The tokens that may be part of a kind: those with a digit or ``@``."""
    return [m.span() for m in _MARKED.finditer(text)] if _HINT.search(text) else []


def _shape(token: str) -> str:
    """Classes of a token's characters; runs of digits keep their length (to 20)."""
    out = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", re.sub(r"[^\W0-9_]+", "a", token))
    return out if len(out) <= 24 else f"long{sum(c == '@' for c in token)}"


def _features(text: str, a: int, b: int) -> list[str]:
    token = text[a:b]
    digits = re.sub(r"[^0-9]", "", token)
    check = _luhn(digits) if 13 <= len(digits) <= 19 else None
    bare = token.strip(".,;:!?\"'()[]{}<>")
    before, after = text[max(0, a - 24):a].split(" "), text[b:b + 24].split(" ")
    left = _shape(before[-2]) if len(before) > 2 else "^"
    right = _shape(after[1]) if len(after) > 2 else "$"
    return ["bias", "shape=" + _shape(bare), f"digits={min(len(digits), 20)}", f"check={check}", f"at={'@' in token}",
            f"plus={token.startswith('+')}", f"paren={token.startswith('(')}", f"dots={min(token.count('.'), 4)}",
            f"dash={min(token.count('-'), 3)}", "left=" + left, "right=" + right]


def _likeness(token: str) -> tuple[str, str | None]:
    """Keys that tokens like each other share: by text, and by last digits."""
    digits = re.sub(r"[^0-9]", "", token)
    return (token.lower().strip(".,;:!?\"'()[]{}<>"),
            digits[-TAIL:] if len(digits) >= TAIL and "@" not in token else None)


class Graph:
    """Tokens of a run of documents with their features, fixed labels and links."""

    def __init__(self):
        self.spans: list[tuple[int, int, int]] = []  # document, start, end
        self.features: list[list[str]] = []
        self.fixed: list[int] = []  # label, -1 if free
        self.edge: list[tuple[int, int]] = []  # left neighbour is a plain token / the right one
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, base: list[Span]) -> None:
        last, like = None, {}  # like: the tokens by what they are alike in
        spans = sorted((s, e, k) for k, s, e in base)
        at = 0
        for a, b in marked_tokens(text):
            me = len(self.spans)
            while at < len(spans) and spans[at][1] <= a:
                at += 1
            label = next((k + 1 for s, e, k in spans[at:at + 8] if s < b and e > a), -1)
            self.spans.append((doc, a, b))
            self.features.append(_features(text, a, b))
            self.fixed.append(label)
            # a plain token lies between if another token starts before this one
            near = last is not None and not _TOKEN.search(text, last, a)
            if near:
                self.chain.append((me - 1, me))
                self.edge[-1] = (self.edge[-1][0], 0)
            self.edge.append((0 if near else 1, 1))
            for kind, key in enumerate(_likeness(text[a:b])):
                if key:
                    like.setdefault((kind, key), []).append(me)
            last = b
        links: set[tuple[int, int]] = set()
        for group in like.values():
            links.update(zip(group, group[1:]))
            # a free token with links to all would outweigh what its own shape says
            anchor = next((i for i in group if self.fixed[i] >= 0), None)
            if anchor is not None:
                links.update((min(i, anchor), max(i, anchor)) for i in group if i != anchor)
        self.skip += sorted(links)

    def arrays(self, index: dict[str, int], grow: bool = False):
        """Feature ids (n, f) with 0 for unknown ones."""
        out = np.zeros((len(self.features), len(self.features[0]) if self.features else 1), np.int64)
        for i, names in enumerate(self.features):
            for j, name in enumerate(names):
                if grow:
                    index.setdefault(name, len(index) + 1)
                out[i, j] = index.get(name, 0)
        return out


# ------------------------------------------------------------------- model

class Model:
    """Weights: per feature and label, chain and skip tables, and the tables of a
    plain neighbour on either side (its label is none)."""

    def __init__(self, index: dict[str, int], unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.index, self.unary, self.chain, self.skip = index, unary, chain, skip

    def unaries(self, graph: Graph) -> np.ndarray:
        edge = np.array(graph.edge, float).reshape(-1, 2)
        return self.unary[graph.arrays(self.index)].sum(axis=1) + edge[:, :1] * self.chain[0][None, :] \
            + edge[:, 1:] * self.chain[:, 0][None, :]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(graph: Graph, steps: int = 200, rate: float = 0.5) -> Model | None:
    """Pseudo-likelihood: each label given its neighbours' labels, by full gradient
    steps with AdaGrad; None without tokens.  Unlabelled tokens are of no kind."""
    if not graph.spans:
        return None
    index: dict[str, int] = {}
    x = graph.arrays(index, True)
    k, n = len(KINDS) + 1, len(x)
    y = np.maximum(np.array(graph.fixed), 0)
    one = np.eye(k)[y]
    edge = np.array(graph.edge, float).reshape(-1, 2)
    chain = np.array(graph.chain, np.int64).reshape(-1, 2)
    skip = np.array(graph.skip, np.int64).reshape(-1, 2)
    weights = [np.zeros((len(index) + 1, k)), np.zeros((k, k)), np.zeros((k, k))]
    squares = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(steps):
        unary, t, s = weights
        score = unary[x].sum(axis=1) + edge[:, :1] * t[0] + edge[:, 1:] * t[:, 0]
        np.add.at(score, chain[:, 0], t[:, y[chain[:, 1]]].T)
        np.add.at(score, chain[:, 1], t[y[chain[:, 0]]])
        np.add.at(score, skip[:, 0], s[y[skip[:, 1]]])
        np.add.at(score, skip[:, 1], s[y[skip[:, 0]]])
        off = (one - _softmax(score)) / n
        grads = [-L2 / n * w for w in weights]
        for j in range(k):
            grads[0][:, j] += np.bincount(x.ravel(), np.repeat(off[:, j], x.shape[1]), len(index) + 1)
        grads[1][0] += (edge[:, :1] * off).sum(axis=0)
        grads[1][:, 0] += (edge[:, 1:] * off).sum(axis=0)
        grads[1] += off[chain[:, 0]].T @ one[chain[:, 1]] + one[chain[:, 0]].T @ off[chain[:, 1]]
        both = one[skip[:, 1]].T @ off[skip[:, 0]] + one[skip[:, 0]].T @ off[skip[:, 1]]
        grads[2] += (both + both.T) / 2  # like tokens have no order
        for w, g, q in zip(weights, grads, squares):
            q += g * g
            w += rate * g / np.sqrt(q)
        weights[0][0] = 0  # unknown features have no say
    return Model(index, *weights)


def beliefs(model: Model, graph: Graph, rounds: int = ROUNDS, settle: float = 1e-4) -> np.ndarray:
    """Marginals (n, labels) by loopy sum-product messages along all links, for each
    document until its own messages settle.  One that comes no nearer to that in
    ``rounds`` rounds is damped twice as much from there on, until it rests."""
    k, n = len(KINDS) + 1, len(graph.spans)
    own = model.unaries(graph)
    fixed = np.array(graph.fixed, np.int64)
    held = fixed >= 0
    own[held] = -np.inf
    own[held, fixed[held]] = 0
    links = np.array(graph.chain + graph.skip, np.int64).reshape(-1, 2)
    kind = np.repeat([0, 1], [len(graph.chain), len(graph.skip)])
    pair = np.stack([model.chain, model.chain.T, model.skip, model.skip.T])
    for a, b, way in ((0, 1, 0), (1, 0, 1)):  # what a fixed token says never changes
        told = held[links[:, a]] & ~held[links[:, b]]
        np.add.at(own, links[told, b], pair[2 * kind[told] + way, fixed[links[told, a]]])
    free = ~held[links].any(axis=1)
    links, kind = links[free], kind[free]
    if not len(links):
        return _softmax(own)
    doc = np.array([s[0] for s in graph.spans], np.int64)
    order = np.argsort(doc[links[:, 0]], kind="stable")
    links, kind = links[order], kind[order]
    # messages in both directions, side by side: source, target, table[source label, target label]
    src, dst = links.ravel(), links[:, ::-1].ravel()
    table = pair[np.stack([2 * kind, 2 * kind + 1], 1).ravel()]
    message = np.zeros((len(src), k))
    sizes = np.unique(doc[src], return_counts=True)[1]  # messages of each document that has not settled
    step, low, before = np.full(len(sizes), 0.5), np.full(len(sizes), np.inf), np.full(len(sizes), np.inf)
    total, nodes, local, turn = own.copy(), np.arange(n), own, 0
    while len(sizes):
        heard = local.copy()
        np.add.at(heard, dst, message)
        given = (heard[src] - message[np.arange(len(src)) ^ 1])[:, :, None] + table
        top = given.max(axis=1, keepdims=True)
        fresh = (top + np.log(np.exp(given - top).sum(axis=1, keepdims=True)))[:, 0]
        fresh -= fresh.max(axis=1, keepdims=True)
        fresh -= message
        gap = np.maximum.reduceat(np.abs(fresh).max(axis=1), np.cumsum(sizes) - sizes)
        message += np.repeat(step, sizes)[:, None] * fresh
        low, turn = np.minimum(low, gap), turn + 1
        if turn % rounds == 0:
            step = np.where(low < 0.9 * before, step, step / 2)
            low, before = np.full(len(sizes), np.inf), np.minimum(low, before)
        rest = (0.5 * gap < settle) | (step < settle)
        if rest.any():
            gone = np.repeat(rest, sizes)
            np.add.at(total, nodes[dst[gone]], message[gone])
            src, dst, table, message = nodes[src[~gone]], nodes[dst[~gone]], table[~gone], message[~gone]
            sizes, step, low, before = sizes[~rest], step[~rest], low[~rest], before[~rest]
            nodes = np.unique(src)
            src, dst, local = np.searchsorted(nodes, src), np.searchsorted(nodes, dst), own[nodes]
    return _softmax(total)


def added_spans(model: Model | None, texts: list[str], base: list[list[Span]],
                belief: float = BELIEF) -> list[list[Span]]:
    """Per text, the spans that the random field adds to its base spans."""
    out: list[list[Span]] = [[] for _ in texts]
    if model is None:
        return out
    graph = Graph()
    for i, (text, spans) in enumerate(zip(texts, base)):
        graph.add(i, text, spans)
    if not graph.spans:
        return out
    share = beliefs(model, graph)
    label = share.argmax(axis=1)
    good = (label > 0) & (share.max(axis=1) >= belief) & (np.array(graph.fixed) < 0)
    joined = set(graph.chain)
    run: list[int] = []

    def close() -> None:
        doc, a, _ = graph.spans[run[0]]
        b, text, kind = graph.spans[run[-1]][2], texts[doc], int(label[run[0]]) - 1
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if a < b and not any(s < b and e > a for _, s, e in base[doc]):
            out[doc].append((kind, a, b))

    for i in np.flatnonzero(good):
        i = int(i)
        if run and not (i == run[-1] + 1 and (run[-1], i) in joined and label[i] == label[run[-1]]):
            close()
            run = []
        run.append(i)
    if run:
        close()
    return out


# ------------------------------------------------------------------- Spark

def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_tokens: int = SAMPLE_TOKENS, **options) -> Model | None:
    """Fits the model on about ``sample_docs`` distinct texts, chosen by their hash, in
    its order as many of them as hold ``sample_tokens`` tokens."""
    key = text_key(text_col)
    total = docs.select(key.alias("key")).distinct().count()
    if not total:
        return None
    every = max(1, -(-total // sample_docs))
    picked = docs.select(key.alias("key"), F.col(text_col).alias("text")) \
        .filter((F.pmod("key", F.lit(every)) == 0) & F.col("text").rlike("[0-9@]"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # marked tokens with what lies around them; the gaps of plain text shrink
        seen, half = set(), _SAMPLE_TOKEN_CHARS // 2
        for batch in batches:
            keys, sizes, out = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                if key in seen:
                    continue
                seen.add(key)
                last, pieces, text = 0, [], text.as_py()
                for a, b in marked_tokens(text)[:_SAMPLE_TOKENS_PER_DOC]:
                    if a - last > 64:
                        pieces.append(text[last:last + 30] + " a " + text[a - 30:a])
                    else:
                        pieces.append(text[last:a])
                    pieces.append(text[a:b] if b - a <= 2 * half else text[a:a + half] + text[b - half:b])
                    last = b
                pieces.append(text[last:last + 30])
                keys.append(key)
                out.append("".join(pieces))
                sizes.append(len(marked_tokens(out[-1])))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(out, pa.string())], names=["key", "n", "text"])

    sample = stored(picked.mapInArrow(cut, "key long, n long, text string").dropDuplicates(["key"]), "sample")
    # the sizes first: no more texts are collected than the tokens need
    held, last = 0, None
    for row in sample.select("key", "n").orderBy("key").limit(2 * sample_docs).collect():
        if held >= sample_tokens:
            break
        held, last = held + row["n"], row["key"]
    rows = [] if last is None else sample.filter(F.col("key") <= last).collect()
    graph = Graph()
    for i, row in enumerate(sorted(rows, key=lambda r: r["key"])):
        if len(graph.spans) >= sample_tokens:
            break
        graph.add(i, row["text"], base_spans(row["text"]))
    return fit(graph, **options)


def _label(texts: list[str], model: Model | None) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, added_spans(model, texts, base)


def coded(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _pieces(batch: pa.RecordBatch, name: str, limit: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of a batch's texts of about ``limit`` characters."""
    begin, held, texts = 0, 0, []
    for i, text in enumerate(batch.column(name)):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held > limit:
            yield begin, texts
            begin, held, texts = i + 1, 0, []
    if texts:
        yield begin, texts


def find(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone (base), base_spans, spans (base
    and added), both as arrays of (kind, start, end) in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        def listed(found):
            return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(s)] for s in found], kind)

        for batch in batches:
            for begin, texts in _pieces(batch, "text"):
                base, more = _label(texts, model)
                counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64())
                          for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(begin, len(texts)), *counts, listed(base),
                     listed([a + b for a, b in zip(base, more)])],
                    names=["id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = "array<struct<kind: string, start: long, end: long>>"
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, "
                           + ", ".join(f"n_{k} long" for k in KINDS) + f", base_spans {spans}, spans {spans}") \
        .withColumnRenamed("id", id_col)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span (overlapping ones as one) replaced by its kind's mark."""
    out, last = [], 0
    merged: list[list[int]] = []
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, model: Model | None, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with all spans masked in their texts, same columns; ``chars_col``, if
    the table has it, follows the text.  Null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            fresh = batch.column(at).to_pylist()
            changed = {}
            for begin, texts in _pieces(batch, text_col):
                base, more = _label(texts, model)
                for i, (text, a, b) in enumerate(zip(texts, base, more), begin):
                    if a or b:
                        changed[i] = mask(text, a + b)
            for i, text in changed.items():
                fresh[i] = text
            batch = batch.set_column(at, batch.schema.field(at), pa.array(fresh, batch.column(at).type))
            where = batch.schema.get_field_index(chars_col) if changed else -1
            if where >= 0:
                sizes = batch.column(where).to_pylist()
                for i, text in changed.items():
                    sizes[i] = len(text)
                batch = batch.set_column(where, batch.schema.field(where), pa.array(sizes, batch.column(where).type))
            yield batch
    return docs.mapInArrow(run, docs.schema)


def digest(spans: str):
    """Hex SHA-256 of the spans as kind:start:end, comma-joined."""
    return F.sha2(joined(spans), 256)


def joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
