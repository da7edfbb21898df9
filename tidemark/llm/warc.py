"""Web pages in Zstandard archives: a frame for each record, and a dictionary in a leading skippable frame.

An archive begins with a skippable frame that holds the dictionary, plain or itself compressed; then each record is one frame that
names the dictionary, so that any record can be read by its place. The reader streams an archive, decodes frame by frame and
checks each record's version, mandatory headers, lengths, end marks and digests; the first thing that is wrong raises, with the
archive and the place. A page whose payload an earlier one has is a revisit: it holds the HTTP headers only, and names the page it
revisits. Readers check that this page's record is there, with that digest and length.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import chunks, release, saved, share_code, table
from tidemark.session import shared_dir

# Fixed values of the formats: marks of skippable frames (the first is that of a dictionary), of a frame, of a dictionary.
DICTIONARY_FRAME, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: An archive ends with the record that reaches so many bytes, compressed.
ARCHIVE_BYTES = 64 << 20
#: Bytes of an archive's first records that its dictionary is made from, and of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 16 << 10
#: Bytes read from an archive at a time.
READ_BYTES = 1 << 18
#: Digests of repeated payloads, or pages that revisit, that are broadcast at most (about 100 bytes each).
BROADCAST_ROWS = 500_000


class BadArchive(ValueError):
    """An archive, or a record in it, that is not as the format says."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def urn_page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(null|-?[0-9]+)>", urn)
    if not found:
        raise BadArchive(f"no page's name: {urn}")
    return None if found[1] == "null" else int(found[1])


def target(url: str | None) -> str:
    """The URL as a header holds it: white space and control characters are escaped; null or empty is ``about:blank``."""
    return re.sub(r"[\x00-\x20\x7f-\xa0\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or with ``refers_to`` a revisit, whose HTTP headers tell the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target(url)),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers_to is not None:
        headers += [("WARC-Refers-To", page_urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    return record_bytes(headers, block)


def make_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """From whole records; a few are repeated, as the trainer asks for more than a handful."""
    return zstandard.train_dictionary(DICTIONARY_BYTES, records * -(-64 // len(records)), k=200, d=8)


class ArchiveWriter:
    """Writes the dictionary's frame and a ``warcinfo`` record, then a frame for each record."""

    def __init__(self, stream: BinaryIO, sample: list[bytes], date: str, packed_dictionary: bool = False) -> None:
        dictionary = make_dictionary(sample)
        held = dictionary.as_bytes()
        if packed_dictionary:
            held = zstandard.ZstdCompressor().compress(held)
        self.stream, self.coder = stream, zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        self.bytes = stream.write(struct.pack("<II", DICTIONARY_FRAME, len(held)) + held)
        about = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
        self.add(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], about))

    def add(self, record: bytes) -> None:
        self.bytes += self.stream.write(self.coder.compress(record))


class Frames:
    """The data of an archive's frames, in order, each with the place at which it begins."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.held, self.place = stream, b"", 0

    def _fill(self, size: int) -> bool:
        while len(self.held) < size:
            more = self.stream.read(max(READ_BYTES, size - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def _take(self, size: int) -> bytes:
        if not self._fill(size):
            raise BadArchive(f"the archive ends within the frame at {self.place}")
        out, self.held = self.held[:size], self.held[size:]
        self.place += size
        return out

    def _skippable(self) -> tuple[int, bytes] | None:
        """Mark and content of a skippable frame, if one is next."""
        if not self._fill(8):
            if self.held:
                raise BadArchive(f"{len(self.held)} bytes at {self.place} are no frame")
            return None
        mark, size = struct.unpack_from("<II", self.held)
        if mark not in SKIPPABLE:
            return None
        self._take(8)
        return mark, self._take(size)

    def _dictionary(self) -> zstandard.ZstdCompressionDict | None:
        """What the leading frame holds; an archive that begins with a record has none."""
        first = self._skippable()
        if first is None or first[0] != DICTIONARY_FRAME:
            return None
        data = first[1]
        mark = struct.unpack_from("<I", data)[0] if len(data) >= 4 else None
        if mark == FRAME:
            frame = zstandard.ZstdDecompressor().decompressobj()
            try:
                data = frame.decompress(data)
            except zstandard.ZstdError as error:
                raise BadArchive(f"the dictionary can't be decompressed: {error}") from error
            if not frame.eof or frame.unused_data:
                raise BadArchive("the dictionary can't be decompressed: its frame is not all there is")
            mark = struct.unpack_from("<I", data)[0] if len(data) >= 4 else None
        if mark != DICTIONARY:
            raise BadArchive("the leading frame holds no dictionary")
        return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        dictionary = self._dictionary()
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
        known = dictionary.dict_id() if dictionary else 0
        while True:
            while self._skippable():
                pass
            if not self.held:
                return
            start = self.place
            # A frame's header has 18 bytes at most; at the end of an archive there may be fewer.
            self._fill(18)
            try:
                wanted = zstandard.get_frame_parameters(self.held).dict_id
                if wanted not in (0, known):
                    raise BadArchive(f"the frame at {start} asks for dictionary {wanted}, the archive has {known}")
                frame, parts = decoder.decompressobj(), []
                while not frame.eof:
                    if not self._fill(1):
                        raise BadArchive(f"the archive ends within the frame at {start}")
                    parts.append(frame.decompress(self.held))
                    self.place += len(self.held) - len(frame.unused_data)
                    self.held = frame.unused_data
            except zstandard.ZstdError as error:
                raise BadArchive(f"no frame at {start}: {error}") from error
            yield start, b"".join(parts)


def parse_record(data: bytes) -> Record:
    """One record and nothing else; header names in lower case."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version not in VERSIONS:
        raise BadArchive("no record's head")
    headers: dict[str, str] = {}
    last = None
    for line in lines:
        try:
            text = line.decode()
        except UnicodeDecodeError as error:
            raise BadArchive("a header is not UTF-8") from error
        if text[:1] in (" ", "\t") and last:
            headers[last] += " " + text.strip(" \t")
            continue
        name, colon, value = text.partition(":")
        last = name.lower()
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9a-z-]+", last):
            raise BadArchive(f"no header: {text[:80]!r}")
        if last in headers and last != "warc-concurrent-to":
            raise BadArchive(f"a header is there twice: {name}")
        headers[last] = value.strip(" \t")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not headers.get(name):
            raise BadArchive(f"no {name}")
    if not re.fullmatch(r"[0-9]+", headers["content-length"]):
        raise BadArchive("the length is no number")
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z", headers["warc-date"]):
        raise BadArchive("the date is none")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"the length is {size}, but the frame holds {len(rest) - 4} bytes before an end mark")
    return Record(headers, rest[:size])


def _digest(headers: dict[str, str], name: str) -> str:
    kind, _, value = headers.get(name, "").partition(":")
    if kind.lower() != "sha256" or not re.fullmatch(r"[0-9a-fA-F]{64}", value):
        raise BadArchive(f"{name} is no SHA-256")
    return value.lower()


class Page(NamedTuple):
    page_id: int | None
    record_type: str
    target_uri: str
    date: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    payload: bytes | None


def page_of(record: Record) -> Page | None:
    """The page that a response or revisit is about, checked; None for other records."""
    headers, block = record
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    if not headers.get("warc-target-uri"):
        raise BadArchive("no target")
    if "warc-block-digest" in headers and _digest(headers, "warc-block-digest") != hashlib.sha256(block).hexdigest():
        raise BadArchive("the block's digest is another")
    head, found, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*$", head.replace(b"\r", b""))
    if not found or not head.startswith(b"HTTP/") or not length:
        raise BadArchive("no HTTP headers with a length")
    size, digest = int(length[1]), _digest(headers, "warc-payload-digest")
    refers_to = None
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive("the payload's length or digest is another")
    else:
        if payload or headers.get("warc-profile") != REVISIT_PROFILE:
            raise BadArchive("a revisit with a payload, or of another kind")
        refers_to = urn_page(headers.get("warc-refers-to", ""))
        if refers_to is None:
            raise BadArchive("a revisit of no page")
    return Page(urn_page(headers["warc-record-id"]), kind, headers["warc-target-uri"], headers["warc-date"], size, digest, refers_to, payload if kind == "response" else None)


def read_pages(stream: BinaryIO) -> Iterator[Page | None]:
    """Each record's page, None for records that are about none."""
    for place, data in Frames(stream):
        try:
            yield page_of(parse_record(data))
        except BadArchive as error:
            raise BadArchive(f"record at {place}: {error}") from error


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to`` of pages whose payload a page of a smaller id has. Only digests are shuffled."""
    digests = saved(pages.select("page_id", F.unhex(F.sha2("html", 256)).alias("digest"), F.octet_length("html").alias("size")).filter(F.col("size") >= least_bytes))
    groups = saved(digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n"))
    small = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    return digests.join(small, "digest").filter("NOT page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Write a record for each of ``pages`` (``page_id``, ``url``, ``html``; others are left out) into archives in ``folder``.

    Returns the table of archives: ``path``, ``records``, ``bytes``. Only archives that it names count: one that a lost task
    left is named by none. A null html is an empty payload, a null url ``about:blank``. Of equal payloads of ``least_bytes`` or more, the
    least page id's is the response; pages without an id come last, and are responses if no page of theirs has one.
    Rows that repeat an id and a payload are one record twice. ``folder`` is any that pyarrow can write.
    """
    share_code(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    again = saved(revisits(pages, least_bytes))
    few = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    same = pages["page_id"].eqNullSafe(few["page_id"]) & (F.unhex(F.sha2(pages["html"], 256)) == few["digest"])
    dealt = pages.join(few, same, "left").select(pages["page_id"], "url", "html", "refers_to")
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        writer = stream = None
        seq = records = 0
        path = ""

        def close():
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64()), "bytes": pa.array([writer.bytes], pa.int64())})

        for batch in chunks(batches, "html"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url")), batch.column("html").cast(pa.binary()).to_pylist(), batch.column("refers_to").to_pylist(), strict=True)
            made = [page_record(page_id, url, html, refers_to, date) for page_id, url, html, refers_to in rows]
            for k, record in enumerate(made):
                if writer is None:
                    sample, size = [], 0
                    for other in made[k:]:
                        size += len(other)
                        if sample and size > SAMPLE_BYTES:
                            break
                        sample.append(other)
                    path = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{seq:05d}.warc.zst"
                    stream = store.open_output_stream(f"{base}/{path}", compression=None)
                    writer, records = ArchiveWriter(stream, sample, date), 0
                writer.add(record)
                records += 1
                if writer.bytes >= archive_bytes:
                    yield close()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield close()

    files = dealt.mapInArrow(run, "path string, records long, bytes long")
    return saved(files.select(F.concat(F.lit(folder.rstrip("/") + "/"), "path").alias("path"), "records", "bytes"))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each response and revisit in the archives that ``archives`` names (``path``; ``records``, if known, is checked).

    ``page_id``, ``record_type``, ``target_uri``, ``date``, ``payload_bytes`` and ``payload_digest`` (of the full payload, of revisits too),
    ``refers_to``, and with ``payloads`` ``payload`` (null for revisits). Whatever is not as the format says raises ``BadArchive``.
    """
    share_code(archives.sparkSession)
    columns = {"page_id": pa.int64(), "record_type": pa.string(), "target_uri": pa.string(), "date": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    if payloads:
        columns["payload"] = pa.binary()

    def run(batches):
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                store, at = _store(path)
                rows, size, records = [], 0, 0

                def out(rows):
                    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(columns.values())], list(columns))

                with store.open_input_stream(at, compression=None) as stream:
                    try:
                        for page in read_pages(stream):
                            if page is None:
                                continue
                            records += 1
                            rows.append(page)
                            size += 200 + len(page.payload or b"") * payloads
                            if size >= 1 << 20:
                                yield out(rows)
                                rows, size = [], 0
                    except BadArchive as error:
                        raise BadArchive(f"{path}: {error}") from error
                if expected is not None and records != expected:
                    raise BadArchive(f"{path}: {records} pages, not {expected}")
                if rows:
                    yield out(rows)
        release()

    schema = "page_id long, record_type string, target_uri string, date string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payloads
    known = F.col("records") if "records" in archives.columns else F.lit(None)
    return archives.select("path", known.cast("long").alias("records")).mapInArrow(run, schema)


def check_revisits(records: DataFrame) -> None:
    """Raise if a revisit's page has no response of that digest and length. What a hot page's revisits claim is one row."""
    what = "payload_digest", "payload_bytes"
    claims = records.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), *what).distinct()
    responses = records.filter("record_type = 'response'").select("page_id", *what)
    wrong = claims.join(responses, ["page_id", *what], "left_anti").first()
    if wrong:
        raise BadArchive(f"revisits of page {wrong.page_id}, which has no such response")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    records = saved(read_archives(archives, payloads=False))
    check_revisits(records)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p
), r AS (
  SELECT *, payload_bytes >= {LEAST_BYTES} AND least IS NOT NULL AND page_id IS DISTINCT FROM least AS again FROM g
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN least END AS refers_to
FROM r
"""
