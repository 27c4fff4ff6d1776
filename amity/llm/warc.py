"""Zstandard-compressed web archives: one frame per record, dictionary in front.

An archive is a `.warc.zst` file: a skippable frame that holds a dictionary,
then a frame for each record. Each partition becomes one archive with its own
dictionary, trained in the task on its first records. Spark's text writer puts
the frames on disk, so that its commit protocol covers lost executors and any
store that Spark writes to will do. The writer wants a line end between rows:
an empty skippable frame serves, which every reader of the format ignores.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

# Payloads below this size are always stored.
MIN_REVISIT_BYTES = 100

# A dictionary is trained on this many records of its archive at most.
DICTIONARY_RECORDS = 200
DICTIONARY_BYTES = 16 << 10

PAGE_URN = "urn:page:"
RECORD = "page_id long, type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary, error string"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, html) with payload, digest and refers_to.

    Of pages with equal payloads of at least `min_bytes` the one with the
    smallest page_id is stored and the others refer to it. Rows that repeat
    that page_id are stored as well. A null html is an empty payload; a page
    with a null page_id is always stored and never referred to.
    """
    page = pages.select(
        "page_id",
        "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
    )
    large = F.octet_length("payload") >= min_bytes
    first = (
        page.where(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    # The key is made anew on both sides, so that both are shuffled for the
    # join and adaptive execution can split a payload that very many pages have.
    first = first.select(_spread("digest").alias("key"), "first")
    key = F.when(large, _spread("digest"))
    return page.join(first, key == F.col("key"), "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str, date: str) -> None:
    """Writes an archive per partition of `records`, the result of with_revisits."""

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressor = None
        for batch in batches:
            made = [_record(*row, date) for row in batch.itertuples(index=False)]
            out = []
            if compressor is None and made:
                trained = _dictionary(made[:DICTIONARY_RECORDS])
                if trained is not None:
                    packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
                    out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
                compressor = zstandard.ZstdCompressor(
                    dict_data=trained, write_checksum=True
                )
            out += [compressor.compress(record) for record in made]
            yield pd.DataFrame({"frame": out})

    rows = records.select("page_id", "url", "payload", "digest", "refers_to")
    rows.mapInPandas(frames, "frame binary").select(
        F.col("frame").cast("string").alias("value")
    ).write.option("lineSep", EMPTY_FRAME).text(path)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """A row per record of the archives under `path`, read by Spark.

    `error` says what is wrong with a record: its frame, its headers, its
    lengths or its digest; it is null for a sound one. After a broken frame the
    rest of the archive can't be found and is reported by one row.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for row in _records(content):
                    held += len(row[6] or b"")
                    rows.append(row if keep_payload else row[:6] + (None,) + row[7:])
                    if held > 8 << 20:
                        yield pd.DataFrame(rows, columns=names).astype(_ROWS)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names).astype(_ROWS)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(records, RECORD)


_ROWS = {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"}


def _spread(name: str) -> Column:
    return F.concat(F.lit("sha256:"), F.col(name))


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records)
    except zstandard.ZstdError:  # too few or too small
        return None


def _record(page_id, url, payload, digest, refers_to, date: str) -> bytes:
    page = "" if pd.isna(page_id) else int(page_id)
    revisit = not pd.isna(refers_to)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = f"{PAGE_URN}{page}" if url is None else "".join(
        c if c > " " else f"%{ord(c):02X}" for c in url
    )
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{PAGE_URN}{page}>",
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = f"<{PAGE_URN}{int(refers_to)}>"
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends, found from its block headers."""
    parameters = zstandard.get_frame_parameters(data[at : at + 18])
    at += zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 if parameters.has_checksum else 0
    if at > len(data):
        raise ValueError("frame is cut off")
    return at


def _records(content: bytes) -> Iterator[tuple]:
    data, at, first = memoryview(content), 0, True
    decompressor = zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            if at + 8 > len(data):
                raise ValueError("archive is cut off")
            magic, size = struct.unpack_from("<II", data, at)
            if magic in SKIPPABLE_MAGIC:
                if at + 8 + size > len(data):
                    raise ValueError("skippable frame is cut off")
                if first and magic == DICTIONARY_MAGIC:
                    found = bytes(data[at + 8 : at + 8 + size])
                    if found[:4] == struct.pack("<I", FRAME_MAGIC):
                        found = zstandard.ZstdDecompressor().decompress(found)
                    decompressor = zstandard.ZstdDecompressor(
                        dict_data=zstandard.ZstdCompressionDict(found)
                    )
                at, first = at + 8 + size, False
                continue
            end = _frame_end(data, at)
            record = decompressor.decompress(data[at:end])
        except (ValueError, zstandard.ZstdError) as problem:
            yield (None, None, None, None, None, None, None, f"frame: {problem}")
            return
        at, first = end, False
        yield _parsed(record)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return _broken(headers, "header line without a colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if lines[0] != VERSION:
        return _broken(headers, "not a WARC/1.1 record")
    if missing := [name for name in REQUIRED if name not in headers]:
        return _broken(headers, f"no {missing[0]}")
    if not headers["content-length"].isdigit():
        return _broken(headers, "content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        return _broken(headers, "content-length differs from the block")
    block = rest[:length]
    if headers.get("warc-block-digest", _sha(block)) != _sha(block):
        return _broken(headers, "block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x[15:].strip() for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:"]
    if len(sizes) != 1 or not sizes[0].isdigit():
        return _broken(headers, "payload length is missing")
    size, digest = int(sizes[0]), headers.get("warc-payload-digest", "")
    kind = headers["warc-type"]
    if kind == "response" and (size != len(payload) or digest != _sha(payload)):
        return _broken(headers, "payload differs from its length or digest")
    if kind == "revisit" and "warc-refers-to" not in headers:
        return _broken(headers, "revisit without warc-refers-to")
    return (
        _page(headers["warc-record-id"]),
        kind,
        _page(headers.get("warc-refers-to", "")),
        size,
        digest.removeprefix("sha256:"),
        headers.get("warc-target-uri"),
        payload if kind == "response" else None,
        None,
    )


def _broken(headers: dict[str, str], why: str) -> tuple:
    page = _page(headers.get("warc-record-id", ""))
    return (page, headers.get("warc-type"), None, None, None, None, None, why)


def _sha(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(PAGE_URN)
    return int(number) if number.lstrip("-").isdigit() else None
