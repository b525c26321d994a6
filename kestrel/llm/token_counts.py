"""Token counts by a dynamic programme over a trie of pre-tokens.

A text (normalised as its piece vocabulary says) falls into pre-tokens where no piece
can reach across.  A task puts the distinct pre-tokens of a run of texts into a trie
and walks it depth first: the unigram forward score of a prefix, i.e. the least
cost and the number of tokens of a best segmentation, is found once for all the
pre-tokens that share it, and is kept at those that end there.  Each occurrence then
adds the stored count of its pre-token.

Best: the highest sum of piece scores, of equal sums the fewest tokens.  A
character that no piece holds costs 10 more than the worst piece and counts as
its UTF-8 bytes with byte fallback, else as one token.

Defined cases: null counts as the empty text (no tokens); equal rows give equal
results; a very long text is a run of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import row_sums, runs, utf8
from kestrel.llm.lexicon import SPACE, Lexicon

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_UNKNOWN_PENALTY = 10.0


def trie_counts(words: list[str], lexicon: Lexicon) -> list[int]:
    """Tokens of each of the distinct ``words`` (spaces as the space mark).

    In sorted order neighbours are leaves next to each other in the trie, so the
    forward scores of the prefix that a word shares with the one before stand
    on the stack already.
    """
    ids, longest = lexicon.ids, lexicon.longest
    cost = {p: -lexicon.scores[i] for p, i in ids.items()}
    unknown = max(cost.values(), default=0.0) + _UNKNOWN_PENALTY
    get, fallback = cost.get, lexicon.bytes is not None
    out = [0] * len(words)
    score, tokens = [0.0], [0]  # of each prefix of the word before
    before = ""
    for place in sorted(range(len(words)), key=words.__getitem__):
        word = words[place]
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del score[shared + 1:], tokens[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            char = word[end - 1]
            least = score[end - 1] + unknown
            count = tokens[end - 1] + (len(char.encode()) if fallback else 1)
            for begin in range(max(0, end - longest), end):
                own = get(word[begin:end])
                if own is not None:
                    own += score[begin]
                    if own < least or own == least and tokens[begin] + 1 < count:
                        least, count = own, tokens[begin] + 1
            score.append(least)
            tokens.append(count)
        out[place] = tokens[-1]
        before = word
    return out


_lexicons: dict[str, Lexicon] = {}


def _pretokens(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Where pre-tokens start, in a run of normalised texts (spaces plain)."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[offsets] = True
    if lexicon.cuts_at_space:
        space = data == 0x20
        start[1:n] |= space[1:] & ~space[:-1]
    for c in lexicon.lone.encode():
        at = np.flatnonzero(data == c)
        start[at] = True
        start[at + 1] = True
    return np.flatnonzero(start[:n])


def _counter(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hashlib.sha256(model).hexdigest()
        lexicon = _lexicons.get(key) or _lexicons.setdefault(key, Lexicon.read(model))
        for batch in batches:
            offsets, _ = utf8(batch.column("text"))
            for lo, hi in runs(offsets, 8 << 20):
                texts = [lexicon.spaced(x.as_py() or "") for x in batch.column("text").slice(lo, hi - lo)]
                off, data = utf8(pa.array(texts, pa.large_string()))
                at = _pretokens(data, off, lexicon)
                ends = np.append(at, len(data))
                words = pa.LargeStringArray.from_buffers(
                    len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
                coded = words.dictionary_encode()
                distinct = [w.replace(" ", SPACE) for w in coded.dictionary.to_pylist()]
                stored = np.array(trie_counts(distinct, lexicon), np.int64)
                codes = coded.indices.to_numpy(zero_copy_only=False)
                first = np.searchsorted(at, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo),
                     pa.array(row_sums(stored[codes] if len(codes) else stored, first)),
                     pa.array(np.diff(first).astype(np.int64))], names=["id", "n_tokens", "n_pretokens"])
    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model_path: str = MODEL_PATH) -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_pretokens.  The model file goes with
    the tasks (a fixed size)."""
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_counter(model), f"id {kind}, n_tokens long, n_pretokens long") \
        .withColumnRenamed("id", id_col)
