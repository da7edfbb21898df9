"""Encoders against the libraries whose ids they give, wavelet matrices and packing against plain versions."""

import hashlib
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, byte_codec, near_dedup, packing, token_counts, token_files
from tidemark.llm.queries import QUERIES

BYTES, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["'", "s", "re", "ll", "'t", " ", "\n", "  ", "a", "B", "1", "²", "é", "　", "!", "#", "\x85", "\x1c", "中", "😀", "é", "ΑΣ", "İ", "Å", "ﬁ", "_", "\t", "'ve", "'l"]
DOCS = "doc_id long, text string, n int, ids string, size int, spans int, rep int"
LONG = "word = 'tis " * 20_000


def fuzz(n=1500):
    pick = random.Random(2)
    return ["".join(pick.choices(ALPHABET, k=pick.randint(0, 40))) for _ in range(n)] + ["", "a" * 500, "=" * 300 + "ab" * 200, "<|endoftext|> and ' on"]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BYTES), special_tokens={})


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def cut(ids, counts):
    return [x.tolist() for x in np.split(ids, counts.cumsum())[:-1]]


def test_byte_ids_are_the_librarys(tik):
    texts = fuzz()
    coder = bpe.byte_bpe(BYTES)
    ids, counts = coder.encode(texts)
    assert cut(ids, counts) == [tik.encode_ordinary(t) for t in texts]
    assert coder.decoder.decode(ids)[0].decode() == "".join(texts)


def test_word_ids_are_the_librarys(words):
    texts = fuzz()
    assert cut(*bpe.word_bpe(WORDS).encode(texts)) == [words.encode(t, add_special_tokens=False).ids for t in texts]


def thue_morse(bits):
    """Two words of equal length on which every polynomial hash modulo a power of two agrees."""
    word = "a"
    for _ in range(bits):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_pieces_are_told_apart_by_their_bytes(tik, words):
    pair = list(thue_morse(11))
    assert cut(*bpe.byte_bpe(BYTES).encode(pair)) == [tik.encode_ordinary(t) for t in pair]
    assert cut(*bpe.word_bpe(WORDS).encode(pair)) == [words.encode(t, add_special_tokens=False).ids for t in pair]
    distinct, which = bpe.Pieces.between_blanks([f" {pair[0]} {pair[1]}\n{pair[0]} ".encode(), b"", b" \t", b"x"]).distinct()
    assert distinct == [pair[0].encode(), pair[1].encode(), b"x"] and which.tolist() == [0, 1, 0, 2]
    one, two = near_dedup.shingle_sets([t.encode() for t in pair], 5)
    assert one.tolist() != two.tolist()


def test_all_code_points_have_the_librarys_ids(words):
    settled = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for form in ("a%sb", "a%s1 %s\u0301", "\u0301%s\u0323"):
        texts = [form.replace("%s", chr(c)) for c in settled + [0x378, 0x1C89, 0x10D50]]
        expected = [e.ids for e in words.encode_batch_fast(texts, add_special_tokens=False)]
        got = cut(*bpe.word_bpe(WORDS).encode(texts))
        assert [(hex(ord(t[1])), a, b) for t, a, b in zip(texts, got, expected, strict=True) if a != b] == []


def test_queries_give_what_the_libraries_give(spark, frame, tik, words, tmp_path):
    frame([(r[0], r[1]) for r in rows()] + [(10 + k, t) for k, t in enumerate(fuzz(60))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    of = lambda data: hashlib.sha256(data).hexdigest()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    by_bytes = Counter((d, len(ids := tik.encode_ordinary(t)), of(",".join(map(str, ids)).encode()), of(t.encode())) for d, t in docs)
    assert Counter(map(tuple, QUERIES["op2_byte_bpe"](spark, str(tmp_path)).collect())) == by_bytes
    start, by_words, pieces = 0, [], []
    for d, t in docs:
        ids = words.encode(t, add_special_tokens=False).ids
        by_words.append((d, start, len(ids) + 1, crc(ids + [2])))
        start += len(ids) + 1
        ids.append(0)
        pieces += [(d, k, a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for k, a in enumerate(range(0, len(ids), 2048))]
    assert sorted(map(tuple, QUERIES["op8_token_files"](spark, str(tmp_path)).collect()), key=lambda r: r[1]) == by_words
    packed = QUERIES["op3_best_fit_packing"](spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:5] for r in packed) == Counter(pieces)
    assert check_packed(packed, 2048) == -(-sum(r.length for r in packed) // 2048)


def test_columns_and_heap_merge_alike():
    merger = bpe.byte_bpe(BYTES).cache.merger
    found = [t.encode() for t in fuzz() if t and len(t.encode()) <= 64]
    assert cut(*merger.merge(found)) == [merger.long(p) for p in found]


def test_a_full_cache_starts_anew(tik):
    cache = bpe.PieceCache(bpe.byte_bpe(BYTES).cache.merger, limit=3)
    for text in ("one two three four", "five six seven", "one two"):
        assert cache.encode(bpe.Pieces([text]))[0].tolist() == tik.encode_ordinary(text)


def rows():
    return [(1, "It's one, two.", 1, "x", 2, 3, 4), (1, "It's one, two.", 1, "x", 2, 3, 4), (None, "none", 0, None, 0, 0, 0), (3, None, 0, "", 0, 0, 0), (4, "", 0, "", 0, 0, 0), (2, LONG, 0, "", 0, 0, 0)]


def test_byte_codec_on_odd_rows(frame, tik):
    got = byte_codec.decode(byte_codec.encode(frame(rows(), DOCS), BYTES), BYTES).collect()
    wanted = [(d, tik.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in rows()]
    key = lambda r: (r[0] or 0, r[2])
    assert sorted([(r.doc_id, r.ids, bytes(r.decoded)) for r in got], key=key) == sorted(wanted, key=key)
    offsets = {r.doc_id: r.byte_at for r in byte_codec.encode(frame(rows(), DOCS), BYTES).collect()}
    at = 0
    for token, where in zip(tik.encode_ordinary(LONG), offsets[2], strict=True):
        assert where == at
        at += len(tik.decode_single_token_bytes(token))
    assert byte_codec.encode(frame([], DOCS), BYTES).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [5] * 700, list(range(3000)), [49407, 0, 7, 49407] * 400, [70_000, 2]])
def test_wavelet_matrix(ids):
    matrix = token_files.WaveletMatrix.build(np.array(ids, np.int64))
    assert matrix.all().tolist() == ids
    for at in range(0, len(ids), 97):
        assert matrix.access(at) == ids[at]
        assert matrix.rank(ids[at], at) == ids[:at].count(ids[at])
    for value in {*ids[:3], 1, 99_999_999}:
        places = [k for k, x in enumerate(ids) if x == value]
        assert matrix.count(value) == len(places)
        for k in range(0, len(places), 61):
            assert matrix.select(value, k) == places[k]
        with pytest.raises(IndexError):
            matrix.select(value, len(places))


@pytest.mark.parametrize("shard_ids", [3, 1 << 20])
def test_token_files_come_back(frame, words, shard_ids):
    got = token_files.read_shards(token_files.write_shards(frame(rows(), DOCS), WORDS, 2, shard_ids)).collect()
    start, wanted = 0, []
    for d, t, *_ in sorted(rows(), key=lambda r: r[0] or 0):
        ids = words.encode(t or "", add_special_tokens=False).ids + [2]
        wanted.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted([tuple(r) for r in got], key=lambda r: r[1]) == wanted
    assert token_files.read_shards(token_files.write_shards(frame([], DOCS), WORDS, 2)).count() == 0


def check_packed(packed, capacity):
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_odd_rows(frame, words):
    pieces = packing.token_pieces(frame(rows(), DOCS), WORDS, 0, 100).collect()
    wanted = []
    for d, t, *_ in rows():
        ids = words.encode(t or "", add_special_tokens=False).ids + [0]
        wanted += [(d, k, a, len(ids[a : a + 100]), zlib.crc32(np.array(ids[a : a + 100], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 100))]
    key = lambda r: (r[0] or 0, r[1])
    assert sorted([tuple(r) for r in pieces], key=key) == sorted(wanted, key=key)
    packed = packing.pack(packing.token_pieces(frame(rows(), DOCS), WORDS, 0, 100), 100).collect()
    assert sorted([tuple(r)[:5] for r in packed], key=key) == sorted(wanted, key=key)
    assert check_packed(packed, 100) == -(-sum(r.length for r in packed) // 100)
    assert packing.pack(packing.token_pieces(frame([], DOCS), WORDS, 0, 100), 100).count() == 0


def test_parts_with_gaps_exchange(frame):
    pick = random.Random(4)
    lengths = [pick.choice([34, 33, 50, 67, 20, 7]) for _ in range(600)]
    given = frame([(k, 0, 0, n, 0) for k, n in enumerate(lengths)], packing.PIECE)
    packed = packing.pack(given, 100, part_size=40, fan_in=4).collect()
    assert sorted(r.doc_id for r in packed) == list(range(600))
    values, counts = np.unique(lengths, return_counts=True)
    assert check_packed(packed, 100) <= packing.best_fit(np.array(lengths), 100)[0].max() + 1 + 4


@pytest.mark.parametrize("lengths, bound", [([60] * 5, 5), ([34] * 6, 3), ([50, 50, 50], 2), ([51, 51, 49], 2), ([100, 1], 2)])
def test_lower_bounds(lengths, bound):
    values, counts = np.unique(lengths, return_counts=True)
    assert packing.lower_bound(values, counts, 100) == bound
    assert packing.best_fit(np.array(lengths), 100)[0].max() + 1 >= bound


def test_token_counts_by_trie_are_those_word_by_word(frame):
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter = token_counts.counter(path)
    texts = [t for t in fuzz(400)] + ["x" * 100 + " the cat", "\U0001f680\U0001f680", LONG]
    frame_rows = [(k, t, 0, "", 0, 0, 0) for k, t in enumerate(texts)] + [(None, None, 0, "", 0, 0, 0)]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(frame(frame_rows, DOCS), path).collect()}
    known = {}
    for k, t in enumerate(texts):
        found = [w.decode() for w in t.encode().split()]
        for w in set(found) - known.keys():
            known[w] = counter.vocabulary.count("▁" + w)
        assert got[k] == (len(found), sum(known[w] for w in found))
    assert got[None] == (0, 0)


def test_best_segmentation_by_trying_all():
    vocabulary = token_counts.Vocabulary(["▁", "a", "b", "ab", "▁a", "ba", "aba"])

    def every(word):
        if not word:
            yield ()
        for end in range(1, len(word) + 1):
            if word[:end] in vocabulary.scores or end == 1:
                yield from ((word[:end], *rest) for rest in every(word[end:]))

    def value(parts):
        score = lambda p: vocabulary.scores.get(p, len(p.encode()) * vocabulary.byte)
        tokens = lambda p: 1 if p in vocabulary.scores else len(p.encode())
        return sum(map(score, parts)), -sum(map(tokens, parts))

    for word in ("▁ab", "▁abab", "▁aébé", "▁bababa", "▁"):
        assert vocabulary.count(word) == -max(map(value, every(word)))[1] == token_counts.counts_by_trie([word], vocabulary)[0]
