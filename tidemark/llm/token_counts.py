"""Token counts of documents under a unigram model of pieces, by one pass over a trie.

Words are pre-tokens, with the mark of a word's begin. The distinct words of a batch that are not known yet form a trie; the best score of
each prefix is worked out once, however many words share it, from the scores of its own prefixes. Where a word ends, the
number of tokens of its best segmentation stands, and is kept.

A piece's score is the logarithm of its probability by Zipf's law from its rank in the vocabulary, in whole
numbers, so that sums are exact. A character that no piece covers costs as many tokens as it has bytes. Of segmentations
of equal score the one with fewer tokens counts.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import Pieces
from tidemark.llm.common import chunks, table, texts_only

MARK = "▁"
#: Longer words are segmented one by one.
LONGEST = 64
#: Words that a worker keeps; beyond, it starts anew, which costs time only.
CACHE_WORDS = 500_000
#: Units of a score, and places below them that count tokens.
UNIT, COUNT_BITS = 1 << 16, 10
BASE = np.uint64(0x5851F42D4C957F2D)


class Vocabulary:
    """Pieces and their scores, and a table of the pieces' hashes for lookups by columns."""

    def __init__(self, pieces: list[str]) -> None:
        """``pieces``: in the order of their ranks, the most frequent first."""
        self.longest = max(map(len, pieces))
        self.scores = {p: -round(UNIT * math.log(rank + 2)) for rank, p in enumerate(pieces)}
        #: Of each byte of a character that no piece covers: less than any piece.
        self.byte = -round(UNIT * (math.log(len(pieces) + 2) + 5))
        keys = np.array([hash_of(p) for p in self.scores], np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.array(list(self.scores.values()), np.int64)[order]
        if len(np.unique(self.keys)) < len(keys):
            raise ValueError("two pieces have one hash")

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Scores by hash; a large negative number for what is no piece."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -(1 << 40))

    def count(self, word: str) -> int:
        """Tokens of one word, by itself."""
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            width = len(word[end - 1].encode())
            score, tokens = best[end - 1]
            options = [(score + width * self.byte, tokens - width)]
            for start in range(max(0, end - self.longest), end):
                own = self.scores.get(word[start:end])
                if own is not None:
                    options.append((best[start][0] + own, best[start][1] - 1))
            best.append(max(options))
        return -best[-1][1]


def hash_of(piece: str) -> int:
    value = len(piece)
    for k, c in enumerate(piece):
        value += (ord(c) + 1) * pow(int(BASE), k + 1, 1 << 64)
    return value & (2**64 - 1)


def counts_by_trie(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each word; no word is empty or longer than ``LONGEST``."""
    order = sorted(range(len(words)), key=words.__getitem__)
    lengths = np.fromiter((len(words[i]) for i in order), np.int64, len(order))
    depth = int(lengths.max())
    points = np.zeros((len(order), depth), np.uint32)
    points[np.arange(depth) < lengths[:, None]] = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le"), np.uint32)
    # A row has a node of its own at each depth from where it first differs from the row before.
    same = np.zeros((len(order), depth), bool)
    same[1:] = np.logical_and.accumulate(points[1:] == points[:-1], 1)
    inside = points > 0
    own = inside & ~same
    node = own.cumsum(0) - 1  # at each depth, which node a row passes
    powers = np.multiply.accumulate(np.full(depth + 1, BASE, np.uint64))
    sums = np.zeros((len(order), depth + 1), np.uint64)
    sums[:, 1:] = ((points.astype(np.uint64) + np.uint64(1)) * powers[:depth]).cumsum(1, dtype=np.uint64)
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    back = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(depth, inverse, np.uint64))])
    values: list[np.ndarray] = []
    tokens = np.zeros(len(order), np.int64)
    for d in range(depth):
        rows = np.flatnonzero(own[:, d])
        if not len(rows):
            break
        width = 1 + (points[rows, d] > 0x7F).astype(np.int64) + (points[rows, d] > 0x7FF) + (points[rows, d] > 0xFFFF)
        before = values[d - 1][node[rows, d - 1]] if d else np.zeros(len(rows), np.int64)
        best = before + width * ((vocabulary.byte << COUNT_BITS) - 1)
        for size in range(1, min(d + 1, vocabulary.longest) + 1):
            start = d + 1 - size
            score = vocabulary.lookup((sums[rows, d + 1] - sums[rows, start]) * back[start] + np.uint64(size))
            hit = np.flatnonzero(score > -(1 << 40))
            from_ = values[start - 1][node[rows[hit], start - 1]] if start else np.zeros(len(hit), np.int64)
            best[hit] = np.maximum(best[hit], from_ + (score[hit] << COUNT_BITS) - 1)
        values.append(best)
        ends = np.flatnonzero(lengths == d + 1)
        tokens[ends] = -best[node[ends, d]] & ((1 << COUNT_BITS) - 1)
    out = np.empty(len(order), np.int64)
    out[order] = tokens
    return out


class Counter:
    """Counts tokens of texts; knows the words it has seen."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.vocabulary, self.known = Vocabulary([model.id_to_piece(i) for i in ids]), {}

    def words(self, found: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = [w for w in found if w not in self.known]
        texts = [MARK + w.decode() for w in new]
        short = [k for k, t in enumerate(texts) if len(t) <= LONGEST]
        if short:
            self.known.update(zip([new[k] for k in short], counts_by_trie([texts[k] for k in short], self.vocabulary).tolist(), strict=True))
        self.known.update({w: self.vocabulary.count(t) for w, t in zip(new, texts, strict=True) if len(t) > LONGEST})
        return np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))

    def count(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        found = Pieces.between_blanks(texts)
        tokens = np.zeros(0, np.int64)
        if len(found.starts):
            distinct, which = found.distinct()
            tokens = self.words(distinct)[which]
        ends = np.concatenate([[0], found.counts.cumsum()])
        return found.counts, np.diff(np.concatenate([[0], tokens.cumsum()])[ends])


@lru_cache(1)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens``. ``path``: a sentencepiece model, for its pieces and their ranks.

    Words lie between blanks (space, tab to carriage return). A null text counts as empty: 0 and 0. Each row gives a row, repeated ones too.
    """

    def run(batches):
        for batch in chunks(batches):
            words, tokens = counter(path).count(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(tokens)], ["doc_id", "n_words", "n_tokens"])

    return texts_only(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
