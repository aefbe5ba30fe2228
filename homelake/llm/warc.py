"""Zstandard WARC archives: writer and reader (operator 3).

An archive is one file: a skippable frame that holds the dictionary, then one zstandard frame for
each record. Spark's text writer puts the frames into files of any file system; its line
separator is an empty skippable frame, which every reader passes over. Reading takes files as
binary rows, loads the dictionary from the leading frame, and decodes one frame at a time.

Equal payloads (by digest) of at least ``least`` bytes are written once: the record with the
smallest page_id is a response, the others are revisits that refer to it.

Defined results: null html is an empty payload; a null page_id comes after all others; rows that
repeat the smallest id of a payload are all responses; without any id, all of them are; a
payload of any length is one record; an empty table gives no rows; other columns are not read. A
file that is cut short, a wrong length or a wrong digest raises an error that names the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, new_path, stored

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
ZSTD_FRAME = 0xFD2FB528
ZSTD_DICTIONARY = 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame, of ASCII characters alone.
SEPARATOR = "P*M\x18\0\0\0\0"
#: Bytes of the dictionary of an archive, and of the first records that it is made from.
DICTIONARY_BYTES, SAMPLE_BYTES = 32768, 1 << 20


class BadArchive(ValueError):
    pass


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _urn(page_id) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def record(page_id, uri: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit keeps the length of the payload that it leaves out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_urn(page_id)}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", "", uri))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_urn(refers_to)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def make_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of samples that are too few for that, their last bytes."""
    import zstandard as z

    try:
        return z.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b"".join(samples)[-size:]
    except z.ZstdError:
        return b"".join(samples)[-size:]


def skippable(content: bytes, magic: int = DICTIONARY_FRAME) -> bytes:
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def _dictionary(content: bytes):
    import zstandard as z

    if int.from_bytes(content[:4], "little") == ZSTD_FRAME:  # the dictionary may itself be compressed
        content = z.ZstdDecompressor().decompress(content, max_output_size=1 << 27)
    kind = z.DICT_TYPE_FULLDICT if int.from_bytes(content[:4], "little") == ZSTD_DICTIONARY else z.DICT_TYPE_RAWCONTENT
    return z.ZstdCompressionDict(content, dict_type=kind)


def frames(records: Iterator[bytes], level: int = 3) -> Iterator[bytes]:
    """The frames of one archive: the dictionary made from its first records, then the records."""
    import zstandard as z

    first: list[bytes] = []
    held, encoder = 0, None
    for one in records:
        if encoder is None:
            first.append(one)
            held += len(one)
            if held < SAMPLE_BYTES:
                continue
            words = make_dictionary(first)
            encoder = z.ZstdCompressor(level=level, dict_data=_dictionary(words), write_checksum=True)
            yield skippable(words)
            yield from map(encoder.compress, first)
            continue
        yield encoder.compress(one)
    if encoder is None and first:
        words = make_dictionary(first)
        encoder = z.ZstdCompressor(level=level, dict_data=_dictionary(words), write_checksum=True)
        yield skippable(words)
        yield from map(encoder.compress, first)


def unpack(content: bytes, name: str = "") -> Iterator[bytes]:
    """The records of an archive, each the whole content of one frame."""
    import zstandard as z

    at, decoder = 0, z.ZstdDecompressor()
    view = memoryview(content)
    while at < len(content):
        magic = int.from_bytes(view[at : at + 4], "little")
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            end = at + 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            if len(content) < at + 8 or end > len(content):
                raise BadArchive(f"{name}: skippable frame cut short at {at}")
            if magic == DICTIONARY_FRAME:
                if at:
                    raise BadArchive(f"{name}: dictionary after the beginning, at {at}")
                decoder = z.ZstdDecompressor(dict_data=_dictionary(bytes(view[at + 8 : end])))
            at = end
        elif magic == ZSTD_FRAME:
            one = decoder.decompressobj()
            parts, start = [], at
            try:
                while not one.eof and at < len(content):
                    parts.append(one.decompress(view[at : at + (1 << 20)]))
                    at += 1 << 20
            except z.ZstdError as error:
                raise BadArchive(f"{name}: frame at {start}: {error}") from error
            if not one.eof:
                raise BadArchive(f"{name}: frame cut short at {start}")
            at = min(at, len(content)) - len(one.unused_data)
            yield b"".join(parts)
        else:
            raise BadArchive(f"{name}: no frame at {at}")


def _headers(lines: list[bytes], name: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        key, colon, value = line.partition(b":")
        if not colon:
            raise BadArchive(f"{name}: header without a colon: {line[:80]!r}")
        out[key.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def parse(content: bytes, name: str = "") -> dict:
    """Checks a record and gives page_id, payload_bytes, payload_digest, record_type, refers_to, uri, payload."""
    head, blank, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not blank or not version.startswith(b"WARC/1."):
        raise BadArchive(f"{name}: no WARC header: {content[:60]!r}")
    headers = _headers(lines, name)
    try:
        kind, size = headers["warc-type"], int(headers["content-length"])
        own, digest = headers["warc-record-id"], headers["warc-payload-digest"].removeprefix("sha1:")
    except (KeyError, ValueError) as error:
        raise BadArchive(f"{name}: header missing or wrong: {error}") from error
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"{name}: {own}: block of {len(rest) - 4} bytes, header says {size}")
    http, blank, payload = rest[:size].partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise BadArchive(f"{name}: {own}: no HTTP header")
    length = _headers(lines, name).get("content-length", "")
    if not length.isdigit():
        raise BadArchive(f"{name}: {own}: no payload length")
    if kind == "response" and (int(length) != len(payload) or base32_sha1(payload) != digest):
        raise BadArchive(f"{name}: {own}: payload does not match its length or digest")
    if kind == "revisit" and (payload or headers.get("warc-profile") != PROFILE or "warc-refers-to" not in headers):
        raise BadArchive(f"{name}: {own}: revisit with a payload or without what it refers to")
    return {
        "page_id": _page(own),
        "payload_bytes": int(length),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(headers["warc-refers-to"]) if kind == "revisit" else None,
        "uri": headers.get("warc-target-uri"),
        "payload": None if kind == "revisit" else payload,
    }


def _page(urn: str) -> int | None:
    text = urn.strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> None:
    """Archives of all rows in ``folder``, one for each task: about the size of an input split."""
    payload = F.encode(F.coalesce(column(html), F.lit("")), "UTF-8")
    rows = pages.select(
        column(page_id).cast("long").alias("page_id"),
        column(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    long_enough = rows.where(F.octet_length("payload") >= least).groupBy("digest")
    first = long_enough.agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    first = stored(first.select(F.col("digest").alias("first_digest"), "first_id"), "first")
    marked = rows.join(first, F.col("digest") == F.col("first_digest"), "left")
    # A null id differs from any first id; where no id is known at all, there is nothing to refer to.
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    ready = marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for own, uri, content, digest, refers_to in zip(*batch.columns, strict=True):
                    content = content.as_py()
                    name = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                    yield record(own.as_py(), uri.as_py(), content, name, refers_to.as_py())

        held, size = [], 0
        for frame in frames(records()):
            held.append(frame)
            size += len(frame)
            if size > 1 << 22:
                yield pa.RecordBatch.from_pydict({"frame": pa.array(held, pa.binary())})
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"frame": pa.array(held, pa.binary())})

    out = ready.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    out.write.option("lineSep", SEPARATOR).text(folder)


def read(spark: SparkSession, folder: str, keep_payload: bool = False) -> DataFrame:
    """The checked records of all archives in ``folder``."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("uri", pa.string()),
            *([("payload", pa.binary())] if keep_payload else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                held, name = [], path.as_py()
                for one in unpack(content.as_py(), name):
                    held.append(parse(one, name))
                    if len(held) == 2000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"
    return files.mapInArrow(run, ddl + (", payload binary" if keep_payload else ""))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Rows written as archives in the shared folder and read back."""
    folder = new_path(pages.sparkSession, "warc")
    write(pages, folder, page_id, url, html, least)
    return read(pages.sparkSession, folder)
