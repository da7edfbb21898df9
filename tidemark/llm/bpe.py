"""Byte-pair encoding without regular expressions or a tokenizer library: boundaries by scans, merges by columns.

Texts become code points and these class codes. A small automaton says where a piece begins; each class is a transition
function of its states, and composing functions is associative. Nearly all are constant, so that only the rest, around
apostrophes, is scanned, by doubling. A piece is a slice of the text's bytes; each distinct one is merged once and kept.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

#: Class codes of code points.
OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3
#: Code points with the Unicode property White_Space.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe in a contraction.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: States after a code point: in a run of letters, numbers or others, in white space, after a space that the next piece
#: takes, one or two letters before the end of a contraction, at its end.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, SPACE, ONE_LEFT, TWO_LEFT, DONE = range(8)
#: Pieces of more bytes are merged by a heap; shorter ones by columns of these widths.
WIDTHS = (4, 8, 16, 32, 64)
#: Distinct pieces that a worker keeps; beyond, it starts anew, which costs time only.
CACHE_PIECES = 200_000
NEVER = np.int32(2**31 - 1)


@lru_cache(1)
def class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    category = unicodedata.category
    first = np.array([ord(category(chr(c))[0]) for c in range(0x110000)], np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[WHITE_SPACE] = WHITE
    return table


def _functions() -> np.ndarray:
    """Rows: an apostrophe before a contraction's one or two letters, and a letter that may belong to it."""
    rows = np.empty((3, 8), np.uint8)
    rows[0], rows[1], rows[2] = ONE_LEFT, TWO_LEFT, IN_LETTERS
    rows[:2, [IN_OTHERS, SPACE]] = IN_OTHERS
    rows[2, TWO_LEFT], rows[2, ONE_LEFT] = ONE_LEFT, DONE
    return rows


FUNCTIONS = _functions()


def boundaries(points: np.ndarray, kind: np.ndarray, first: np.ndarray, word_ends: bool = False) -> np.ndarray:
    """Where pieces begin. ``points``: code points of texts end to end; ``first``: true at each text's first one.

    With ``word_ends`` no piece takes the space before it, and each number is a piece.
    """
    n = len(points)
    after = np.empty(n, np.uint8)  # class of the next code point in the same text, 255 at its end
    after[:-1] = kind[1:]
    after[-1] = 255
    after[:-1][first[1:]] = 255
    white = kind == WHITE
    last_white = white & (after != WHITE) & (after != 255)
    state = np.array([IN_OTHERS, IN_LETTERS, IN_NUMBERS, IN_WHITE], np.uint8)[kind]
    if not word_ends:
        state[last_white & (points == 32)] = SPACE

    apostrophe = np.flatnonzero(points == 39)
    length = np.zeros(len(apostrophe), np.int64)
    for ending in ENDINGS:
        fits = apostrophe + len(ending) < n
        at = np.where(fits, apostrophe, 0)
        for k, letter in enumerate(ending, 1):
            here = np.minimum(at + k, n - 1)
            fits &= (points[here] == ord(letter)) & ~first[here]
        length[fits] = len(ending)
    apostrophe, length = apostrophe[length > 0], length[length > 0]
    if len(apostrophe):
        which = np.full(n, -1, np.int8)
        for k in (1, 2):
            which[apostrophe[length >= k] + k] = 2
        which[apostrophe] = length - 1
        at = np.flatnonzero(which >= 0)
        begins = np.ones(len(at), bool)
        begins[1:] = (np.diff(at) > 1) | first[at[1:]]
        index = np.arange(len(at))
        start = np.maximum.accumulate(np.where(begins, index, 0))
        scan = FUNCTIONS[which[at]]
        step, deepest = 1, int((index - start).max())
        while step <= deepest:
            open_ = np.flatnonzero(index - start >= step)
            scan[open_] = np.take_along_axis(scan[open_], scan[open_ - step], 1)
            step *= 2
        begin = at[start]
        before = np.where(first[begin], IN_WHITE, state[begin - 1])
        state[at] = scan[index, before]

    prior = np.empty(n, np.uint8)
    prior[1:] = state[:-1]
    prior[0] = IN_WHITE
    goes_on = np.zeros((4, 8), bool)
    goes_on[LETTER, [IN_LETTERS, SPACE, ONE_LEFT, TWO_LEFT]] = True
    goes_on[NUMBER, SPACE if word_ends else [IN_NUMBERS, SPACE]] = True
    goes_on[OTHER, [IN_OTHERS, SPACE]] = True
    goes_on[WHITE, IN_WHITE] = True
    return ~goes_on[kind, prior] | last_white | first


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points end to end, the byte at which each begins (and the end), and where each text begins (and the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    widths = (points > 0x7F).view(np.int8) + np.int8(1)
    for limit in (0x7FF, 0xFFFF):
        widths += (points > limit).view(np.int8)
    at = np.zeros(len(points) + 1, np.int64)
    widths.cumsum(dtype=np.int64, out=at[1:])
    return points, at, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


class Pieces:
    """The pieces of some texts: slices of their bytes, and each text's number of pieces."""

    def __init__(self, texts: list[str], word_ends: bool = False) -> None:
        points, at, begins = code_points(texts)
        self.data, n = "".join(texts).encode(), len(points)
        if not n:
            self.starts, self.ends, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
            return
        first = np.zeros(n, bool)
        first[begins[:-1][np.diff(begins) > 0]] = True
        kind = class_table()[points]
        found = np.flatnonzero(boundaries(points, kind, first, word_ends))
        ends = np.append(found[1:], n)
        if word_ends:
            inked = kind[found] != WHITE
            found, ends = found[inked], ends[inked]
        self.counts = np.diff(np.searchsorted(found, begins))
        self.starts, self.ends = at[found], at[ends]

    @classmethod
    def between_blanks(cls, texts: list[bytes]) -> Pieces:
        """Words between spaces, tabs and line breaks."""
        self = cls.__new__(cls)
        self.data = b"\n".join(texts) + b"\n"
        data = np.frombuffer(self.data, np.uint8)
        ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.flatnonzero(np.diff(ink, prepend=False, append=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.counts = np.diff(np.searchsorted(self.starts, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])))
        return self

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """Distinct pieces, and which of them each piece is; told apart by their bytes."""
        n = len(self.starts)
        if not n:
            return [], np.zeros(0, np.int32)
        cuts = np.empty(2 * n, np.int64)  # pieces and, between them, what lies in none
        cuts[::2], cuts[1::2] = self.starts, self.ends
        column = pa.Array.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(cuts), pa.py_buffer(self.data)])
        column = column.take(pa.array(np.arange(0, 2 * n, 2)))
        encoded = column.dictionary_encode()
        _, offsets, values = encoded.dictionary.buffers()
        cuts, found = np.frombuffer(offsets, np.int64)[: len(encoded.dictionary) + 1].tolist(), values.to_pybytes()
        return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], encoded.indices.to_numpy()


class PairTable:
    """(left id, right id) to (rank, merged id), looked up by columns: levels of slots, each for what clashed before."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        keys, values = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64), rank.astype(np.int32)
        self.merged = np.zeros(int(rank.max()) + 1, np.int32)
        self.merged[rank] = merged
        self.keys, self.values, self.levels = keys, values, []
        while len(keys):
            bits = max(8, int(len(keys) * 4).bit_length())
            slot = self._slot(keys, bits)
            _, chosen = np.unique(slot, return_index=True)
            slots, ranks = np.full(1 << bits, 2**40, np.uint64), np.full(1 << bits, NEVER, np.int32)
            slots[slot[chosen]], ranks[slot[chosen]] = keys[chosen], values[chosen]
            self.levels.append((bits, slots, ranks))
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values = keys[rest], values[rest]

    @cached_property
    def best(self) -> dict[int, int]:
        """The same by single pairs, for long pieces."""
        return dict(zip(self.keys.tolist(), self.values.tolist(), strict=True))

    def _slot(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys * (self.MULTIPLIER + np.uint64(2 * bits)) >> np.uint64(64 - bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        out = np.full(keys.shape, NEVER, np.int32)
        for bits, slots, ranks in self.levels:
            slot = self._slot(keys, bits)
            np.copyto(out, ranks[slot], where=slots[slot] == keys)
        return out


class Merger:
    """Merges pieces of bytes: always the pair of least rank, the leftmost of equals."""

    def __init__(self, pairs: PairTable, first_ids: np.ndarray, last_ids: np.ndarray) -> None:
        """``first_ids``: of each byte; ``last_ids``: of each byte that ends a piece."""
        self.pairs, self.first_ids, self.last_ids = pairs, first_ids.astype(np.int32), last_ids.astype(np.int32)

    def long(self, piece: bytes) -> list[int]:
        ids = self.first_ids[np.frombuffer(piece, np.uint8)].tolist()
        ids[-1] = int(self.last_ids[piece[-1]])
        best, merged, n = self.pairs.best, self.pairs.merged, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := best.get(ids[i] << 16 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = int(merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for at in (before[i], i):
                if at >= 0 and after[at] < n and (r := best.get(ids[at] << 16 | ids[after[at]])) is not None:
                    heapq.heappush(heap, (r, at, ids[at], ids[after[at]]))
        return [x for x in ids if x >= 0]

    def _columns(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids in rows of ``width``, and their numbers."""
        n, columns = len(starts), np.arange(width)
        inside = columns < lengths[:, None]
        taken = data[np.where(inside, starts[:, None] + columns, 0)]
        ids = np.where(inside, self.first_ids[taken], 0xFFFF).astype(np.int32)
        ids[np.arange(n), lengths - 1] = self.last_ids[data[starts + lengths - 1]]
        ranks = np.full((n, width), NEVER, np.int32)
        ranks[:, :-1] = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        out, counts, rows = ids.copy(), lengths.copy(), np.arange(n)
        counts_now = lengths.copy()
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            rank = ranks[here, at]
            over = rank == NEVER
            if over.any():
                out[rows[over]], counts[rows[over]] = ids[over], counts_now[over]
                keep = ~over
                rows, ids, ranks, at, rank, counts_now = rows[keep], ids[keep], ranks[keep], at[keep], rank[keep], counts_now[keep]
                here = here[: len(rows)]
                if not len(rows):
                    break
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[:, -1], ranks[:, -1] = 0xFFFF, NEVER
            ids[here, at] = self.pairs.merged[rank]
            counts_now = counts_now - 1
            right = np.minimum(at + 1, width - 1)
            ranks[here, at] = np.where(at + 1 < width, self.pairs.ranks(ids[here, at], ids[here, right]), NEVER)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.ranks(ids[left, at[left] - 1], ids[left, at[left]])
        return out, counts

    def merge(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and each one's number of ids. No piece is empty."""
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = lengths.cumsum() - lengths
        data = np.frombuffer(b"".join(found), np.uint8)
        counts, parts, lower = np.zeros(len(found), np.int64), [], 0
        for width in WIDTHS:
            rows = np.flatnonzero((lengths > lower) & (lengths <= width))
            lower = width
            for at in range(0, len(rows), 1 << 16):
                some = rows[at : at + (1 << 16)]
                ids, counts[some] = self._columns(data, starts[some], lengths[some], width)
                parts.append((some, ids[np.arange(width) < counts[some][:, None]]))
        rows = np.flatnonzero(lengths > lower)
        merged = [self.long(found[r]) for r in rows]
        counts[rows] = [len(m) for m in merged]
        parts.append((rows, np.array([x for m in merged for x in m], np.int32)))
        offsets = counts.cumsum() - counts
        out = np.empty(int(counts.sum()), np.int32)
        for some, ids in parts:
            out[spread(offsets[some], counts[some])] = ids
        return out, counts


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of each slice, end to end."""
    total = int(counts.sum())
    return np.repeat(starts - (counts.cumsum() - counts), counts) + np.arange(total)


class PieceCache:
    """Ids of the pieces seen so far, in one array that grows."""

    def __init__(self, merger: Merger, limit: int = CACHE_PIECES) -> None:
        self.merger, self.limit = merger, limit
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.starts, self.counts, self.ids = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)
        self.used = 0

    @staticmethod
    def _grown(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def encode(self, found: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and each text's number of ids."""
        if not len(found.starts):
            return np.zeros(0, np.int32), found.counts
        if len(self.slots) > self.limit:
            self._clear()
        distinct, which = found.distinct()
        slots = list(map(self.slots.get, distinct))
        new = [p for p, s in zip(distinct, slots, strict=True) if s is None]
        if new:
            ids, counts = self.merger.merge(new)
            n = len(self.slots)
            self.slots.update(zip(new, range(n, n + len(new)), strict=True))
            self.starts, self.counts = self._grown(self.starts, n + len(new)), self._grown(self.counts, n + len(new))
            self.ids = self._grown(self.ids, self.used + len(ids))
            self.starts[n : n + len(new)] = self.used + counts.cumsum() - counts
            self.counts[n : n + len(new)] = counts
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            slots = list(map(self.slots.__getitem__, distinct))
        at = np.array(slots, np.int64)[which]
        counts = self.counts[at]
        ends = np.concatenate([[0], counts.cumsum()])[np.concatenate([[0], found.counts.cumsum()])]
        return self.ids[spread(self.starts[at], counts)], np.diff(ends)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBPE:
    """Encodes as the vocabulary of a rank file says."""

    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        pairs = np.array([(a, b, r) for token, r in ranks.items() for k in range(1, len(token)) if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None])
        bytes_ = np.array([ranks[bytes([b])] for b in range(256)])
        self.cache = PieceCache(Merger(PairTable(*pairs.T, pairs[:, 2]), bytes_, bytes_))
        self.decoder = ByteDecoder(ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and each text's number of ids."""
        return self.cache.encode(Pieces(texts))


class ByteDecoder:
    """The bytes that ids stand for."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            tokens[r] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = self.lengths.cumsum() - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of the ids end to end, and the number of bytes of each id."""
        lengths = self.lengths[ids]
        return self.data[spread(self.starts[ids], lengths)].tobytes(), lengths


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(1)
def unsettled() -> np.ndarray:
    """Code points on which versions of Unicode may differ: unassigned ones, and combining marks but for the oldest block."""
    points = map(chr, range(0x110000))
    table = np.fromiter((unicodedata.category(c) == "Cn" or unicodedata.combining(c) > 0 for c in points), bool, 0x110000)
    table[0x300:0x370] = False
    return table


class WordBPE:
    """Encodes as the tokenizers library does by a vocabulary with word ends: NFC, white space to a space, lower case."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        vocab, end = read["model"]["vocab"], read["model"]["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        letters = byte_letters()
        pairs = PairTable(*(np.array(x) for x in zip(*((vocab[a], vocab[b], r, vocab[a + b]) for r, (a, b) in enumerate(merges)), strict=True)))
        merger = Merger(pairs, np.array([vocab[x] for x in letters]), np.array([vocab[x + end] for x in letters]))
        self.path, self.cache = path, PieceCache(merger)
        self.special = [t["content"] for t in read["added_tokens"]]
        self.library = None

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no other form of sigma at the end of a word
        return text.lower()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and each text's number of ids."""
        special = {k: self._by_library(t) for k, t in enumerate(texts) if any(s in t for s in self.special) or self._unsettled(t)}
        ids, counts = self.cache.encode(Pieces(["" if k in special else self.normal(t) for k, t in enumerate(texts)], word_ends=True))
        if special:
            ends = np.concatenate([[0], counts.cumsum()])
            parts = [special[k] if k in special else ids[ends[k] : ends[k + 1]] for k in range(len(texts))]
            return np.concatenate(parts).astype(np.int32), np.array([len(p) for p in parts])
        return ids, counts

    @staticmethod
    def _unsettled(text: str) -> bool:
        return not text.isascii() and bool(unsettled()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any())

    def _by_library(self, text: str) -> np.ndarray:
        """A text that spells a special token, or holds an unsettled code point, is rare and left to the library."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)


@lru_cache(2)
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(2)
def byte_decoder(path: str) -> ByteDecoder:
    return ByteDecoder(read_ranks(path))


@lru_cache(2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)
