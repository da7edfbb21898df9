"""Web archives, vector codes and the Merkle manifest against plain versions, with nulls, repeats, ties and clashing names."""

import hashlib
import io
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from tidemark.llm import code_books, merkle, warc
from tidemark.session import shared_dir

DATE = "2024-01-02T03:04:05Z"
CLASH = ("a", 1, "b", 2)


def pages(frame, rows):
    return frame([(*r, *CLASH) for r in rows], "page_id long, url string, html string, refers_to string, digest int, path string, records int")


def plain_pages(rows):
    least = {}
    for page_id, _, html in rows:
        if page_id is not None:
            least[html or ""] = min(page_id, least.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data, first = (html or "").encode(), least.get(html or "")
        again = len(data) >= 100 and first is not None and first != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


ROWS = [(5, "http://a/ b\r\nX: y", "é" * 50), (2, None, "é" * 50), (9, "http://c", "é" * 50), (9, "http://c", "é" * 50), (2, None, "é" * 50), (None, "", "é" * 50), (None, "u", "z" * 200), (None, "u", "z" * 200)]
ROWS += [(1, "x", "s" * 99), (0, "x", "s" * 99), (3, "x", None), (4, "x", ""), (7, "long", "<p>HTTP/1.1\r\n\r\nWARC/1.1</p>" * 90_000), (-3, "x", "m" * 100), (6, "x", "m" * 100)]


@pytest.mark.parametrize("archive_bytes", [1, 64 << 20])
def test_archives_come_back(spark, frame, tmp_path, archive_bytes):
    folder = f"{shared_dir(spark)}/archives-{archive_bytes}"
    archives = warc.write_archives(pages(frame, ROWS), folder, archive_bytes=archive_bytes, date=DATE)
    got = warc.read_archives(archives)
    warc.check_revisits(got)
    rows = got.collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == plain_pages(ROWS)
    assert {bytes(r.payload) for r in rows if r.payload is not None} == {(h or "").encode() for _, _, h in ROWS}
    assert {r.target_uri for r in rows if r.page_id in (5, 2)} == {"http://a/%20b%0D%0AX:%20y", "about:blank"} and {r.date for r in rows} == {DATE}
    assert archives.agg({"records": "sum"}).first()[0] == len(ROWS) and (archives.count() == len(ROWS)) == (archive_bytes == 1)


def test_archives_of_nothing(spark, frame):
    archives = warc.write_archives(pages(frame, []), f"{shared_dir(spark)}/none")
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_a_revisit_of_nothing_raises(spark, frame):
    records = frame([(1, "response", "x", 5), (2, "revisit", "x", 5), (3, "revisit", "y", 5)], "page_id long, record_type string, payload_digest string, payload_bytes long")
    warc.check_revisits(records.filter("page_id < 3").selectExpr("*", "1L AS refers_to"))
    with pytest.raises(warc.BadArchive, match="page 1"):
        warc.check_revisits(records.selectExpr("*", "1L AS refers_to"))


def archive(records, packed=False):
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, records, DATE, packed)
    for r in records:
        writer.add(r)
    assert writer.bytes == len(out.getvalue())
    return out.getvalue()


RECORDS = [warc.page_record(k, f"u{k}", b"payload %d" % k * 30, None, DATE) for k in range(5)] + [warc.page_record(9, "u", b"payload 0" * 30, 0, DATE)]


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_comes_from_the_leading_frame(packed):
    data = archive(RECORDS, packed)
    mark, size = struct.unpack_from("<II", data)
    held = data[8 : 8 + size]
    assert mark == warc.DICTIONARY_FRAME and struct.unpack_from("<I", held)[0] == (warc.FRAME if packed else warc.DICTIONARY)
    found = list(warc.Frames(io.BytesIO(data)))
    assert [d for _, d in found][1:] == RECORDS
    # Each frame by itself, from its place.
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(held) if packed else held)
    for place, record in found:
        assert zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[place:]) == record
    assert [p.page_id for p in warc.read_pages(io.BytesIO(data)) if p] == [0, 1, 2, 3, 4, 9]
    # Other skippable frames are passed over; no dictionary is needed if no frame asks for one.
    more = data + struct.pack("<II", 0x184D2A51, 3) + b"abc"
    assert len(list(warc.Frames(io.BytesIO(more)))) == len(RECORDS) + 1
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in RECORDS)
    assert [d for _, d in warc.Frames(io.BytesIO(plain))] == RECORDS
    assert list(warc.Frames(io.BytesIO(b""))) == []


def frames(*records):
    return b"".join(zstandard.ZstdCompressor(write_checksum=True).compress(r) for r in records)


def spoiled():
    data, one, again = archive(RECORDS), RECORDS[0], RECORDS[5]
    first = 8 + struct.unpack_from("<II", data)[1]
    yield "no dictionary", struct.pack("<II", warc.DICTIONARY_FRAME, 4) + b"none"
    yield "can't be decompressed", struct.pack("<II", warc.DICTIONARY_FRAME, 8) + struct.pack("<I", warc.FRAME) + b"\xff" * 4
    yield "asks for dictionary", data[first:]
    yield "ends within", data[:-3]
    yield "ends within", data[:100]
    yield "no frame", data + b"abc"
    yield "no frame", data + b"abcdefghijklmnopqrstuvwxyz"
    yield "no frame", data[:-1] + bytes([data[-1] ^ 1])
    yield "no record's head", frames(one.replace(b"WARC/1.1", b"WARC/9.9", 1))
    yield "the length is 1,", frames(one.replace(b"Content-Length: ", b"Content-Length: 1\r\nX: ", 1) if one.index(b"Content-Length: ") < one.index(b"\r\n\r\n") else one)
    yield "the length is", frames(one + one)
    yield "the length is", frames(one[:-1])
    yield "the length is", frames(one[:-4] + b"abcd")
    yield "no warc-record-id", frames(one.replace(b"WARC-Record-ID", b"X-Record-ID", 1))
    yield "no warc-date", frames(one.replace(b"WARC-Date: " + DATE.encode(), b"WARC-Date:", 1))
    yield "the date is none", frames(one.replace(DATE.encode(), b"yesterday", 1))
    yield "twice", frames(one.replace(b"WARC-Date", b"WARC-Type: response\r\nWARC-Date", 1))
    yield "no header", frames(one.replace(b"WARC-Date", b"WARC Date", 1))
    yield "not UTF-8", frames(one.replace(b"WARC-Target-URI: u0", b"WARC-Target-URI: \xff", 1))
    yield "the block's digest", frames(one.replace(b"payload 0", b"payload X", 1))
    yield "no page's name", frames(one.replace(b"<urn:page:0>", b"<urn:page:x>", 1))
    yield "no target", frames(one.replace(b"WARC-Target-URI", b"WARC-Other-URI", 1))
    yield "is no SHA-256", frames(one.replace(b"Payload-Digest: sha256", b"Payload-Digest: md5", 1))
    yield "a revisit with", frames(again.replace(b"identical-payload", b"not-modified", 1))
    yield "a revisit of no page", frames(again.replace(b"<urn:page:0>", b"<urn:page:null>", 1))
    bare = one.replace(b"WARC-Block-Digest", b"X-Digest", 1)
    yield "the payload's length", frames(bare.replace(b"payload 0", b"payload X", 1))


@pytest.mark.parametrize("message,data", list(spoiled()))
def test_what_is_wrong_raises(message, data):
    with pytest.raises(warc.BadArchive, match=message):
        list(warc.read_pages(io.BytesIO(data)))


def test_folded_headers_are_read():
    record = warc.parse_record(RECORDS[0].replace(b"WARC-Target-URI: u0", b"WARC-Target-URI: u0\r\n\t and more", 1).replace(b"WARC/1.1", b"WARC/1.0", 1))
    assert record.headers["warc-target-uri"] == "u0 and more"


def plain_codes(rows, rounds=6, parts=8, size=None):
    kept = [(i, lab, np.floor(np.array(v, np.float64) * 4096).astype(np.int64)) for i, lab, v in rows if v is not None and None not in v and np.isfinite(np.array(v, np.float64)).all()]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].astype("<i4").tobytes()))
    if not kept:
        return Counter(), ""
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // parts)
    points = np.array([np.pad(v, (0, parts * width - len(v))) for _, _, v in kept]).reshape(len(kept), parts, width)
    books = points[:16].swapaxes(0, 1).copy()

    def assign():
        away = ((points[:, :, None, :] - books[None]) ** 2).sum(3)
        return away.argmin(2), away.min(2)

    for _ in range(rounds):
        which, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = points[which[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    which, away = assign()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return Counter((i, lab, bytes(w.astype(np.uint8).tolist()), int(a.sum())) for (i, lab, _), w, a in zip(kept, which, away, strict=True)), digest


def vectors(frame, rows):
    return frame([(i, v, lab, "x", b"y", 1) for i, lab, v in rows], "vec_id long, embedding array<float>, label int, code string, ints binary, error int")


@pytest.mark.parametrize("case", ["clusters", "few", "grid", "uneven"])
def test_codes(frame, case):
    pick = np.random.default_rng(len(case))
    if case == "clusters":
        centres = pick.normal(0, 1, (30, 64))
        rows = [(k, k % 3 or None, (centres[k % 30] + pick.normal(0, 0.05, 64)).astype(np.float32).tolist()) for k in range(900)]
        rows += [(1000 + k, 7, rows[5][2]) for k in range(300)] + [(5, 1, rows[9][2]), (None, 2, rows[3][2]), (None, None, None), (2000, 1, [float("nan")] * 64), (2001, 1, [None, *rows[0][2][1:]]), (2002, 1, [float("inf")] * 64), (2003, 1, [0.5]), (2004, 1, [])]
    elif case == "few":
        rows = [(k, None, [0.25 * k] * 16) for k in range(5)] + [(9, 1, [0.125] * 16)]
    elif case == "grid":  # equal distances everywhere: ties to the lower index
        rows = [(k, 1, [float(x) for x in pick.integers(0, 3, 16)]) for k in range(600)]
    else:
        rows = [(k, 1, pick.normal(0, 9, 13).astype(np.float32).tolist()) for k in range(200)]
    log = []
    codes, books = code_books.compress(vectors(frame, rows).repartition(3), log=log)
    expected, digest = plain_codes(rows)
    got = codes.collect()
    assert Counter((r.vec_id, r.label, bytes(r.code), r.error) for r in got) == expected and books.sha256() == digest
    assert len(books.decode(got[0].code)) == -(-len(next(r[2] for r in rows)) // 8) * 8
    if case == "clusters":
        n = len(expected)
        worked = [sum(d[-1] for d in depths) for _, depths in log]
        assert worked[0] >= 8 * 16 * n and worked[-1] < worked[0] / 3, "bounds spare most distances"
        assert all(max(z) <= 4 for z, _ in log)


def test_codes_of_nothing(frame):
    codes, books = code_books.compress(vectors(frame, [(1, 1, None)]))
    assert codes.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()


def test_a_cut_list_counts_for_the_outer_bound():
    entries = np.arange(6, dtype=np.int64)[:, None] * 10
    known = code_books.Bounds.unknown(1, 4)
    known.settle(np.array([[1]]), entries)
    cut = known.cut(2)
    assert cut.near.tolist() == [[0, 1]] and cut.outer[0] <= 19 < known.outer[0] and cut.low[0, 0] <= 9


def plain_manifest(rows):
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    put = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, t: h(*map(put, (r[0], r[1], r[2], r[3], t)))
    lower = lambda t: t and t.translate({c: c + 32 for c in range(65, 91)})
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)

    def climb(digests):
        """The top, and for each node its siblings by level."""
        paths, at, now = [[] for _ in digests], list(range(len(digests))), digests
        while len(now) > 1:
            for k, a in enumerate(at):
                run = a // 8 * 8
                paths[k].append((now[run:a], now[a + 1 : run + 8]))
                at[k] = a // 8
            now = [h(*now[i : i + 8]) for i in range(0, len(now), 8)]
        return now[0], paths

    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    inner = []
    for x in langs:
        mine = sorted(by_lang[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        inner.append((mine, *climb([leaf(r, r[4]) for r in mine])))
    root, over = climb([top for _, top, _ in inner])
    out = []
    for (mine, top, paths), above in zip(inner, over, strict=True):
        for r, path in zip(mine, paths, strict=True):
            path = path + above
            now = leaf(r, r[4])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = leaf(r, lower(r[4]))
            for before, after in path:
                now = h(*before, now, *after)
            out.append((r[0], leaf(r, r[4]), top, root, h(*[x for b, a in path for x in (*b, *a)]), now, now == root))
    return Counter(out)


def manifest_rows(case):
    pick = random.Random(case)
    if case == "one":
        return [(3, "s", "en", 1, "A")]
    if case == "alone":
        return [(k, None, None, None, "Ab") for k in range(5)]
    if case == "langs":
        return [(k, "s", f"l{k % 75}é" if k % 9 else None, k, f"Text {k}") for k in range(400)]
    rows = [(k, pick.choice(["a", None, "é"]), "en" if k % 3 else "fr", pick.choice([None, 5]), pick.choice(["Text É %d" % k, None, "", "lower"])) for k in range(700)]
    return rows + [(4, "s", "en", 2, "Same")] * 30 + [(None, "s", None, None, "Null")] * 9 + [(900, "s", "de", 1, "X" * 200_000), (901, "s", "", 1, "e")]


@pytest.mark.parametrize("case", ["one", "alone", "langs", "mixed"])
@pytest.mark.parametrize("share", [2, 1024])
def test_manifest(spark, frame, monkeypatch, case, share):
    monkeypatch.setattr(merkle, "SHARE", share)
    monkeypatch.setattr("tidemark.llm.merkle.table", lambda *_: docs)
    rows = manifest_rows(case)
    docs = frame([(*r, 1, b"x", "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf int, root binary, tree string").repartition(3)
    limit = spark.conf.get(merkle.ROW_LIMIT)
    got = merkle.op13_merkle(spark, "").collect()
    assert Counter(map(tuple, got)) == plain_manifest(rows) and spark.conf.get(merkle.ROW_LIMIT) == limit


def test_manifest_of_nothing(spark, frame, monkeypatch):
    monkeypatch.setattr("tidemark.llm.merkle.table", lambda *_: frame([], "doc_id long, source string, lang string, n_chars long, text string"))
    assert merkle.op13_merkle(spark, "").count() == 0
