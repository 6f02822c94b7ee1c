"""WARC archives in seekable Zstandard bundles: written by tasks, indexed by record, read back whole or by record."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written
from tidemart.session import shared_folder

# Fixed values of the formats: skippable frame, end of a seek table, and what a WARC record starts with.
SKIPPABLE, SEEKABLE, VERSION = 0x184D2A5E, 0x8F92EAB1, b"WARC/1.1\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame int, at long, length long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, frame int, at long"
)


def open_folder(uri: str):
    """File system and path of a folder, local or remote."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://")) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(text: str) -> int | None:
    number = text[len("<urn:x-page:") : -1]
    return int(number) if number else None


def to_record(page_id: int | None, url: bytes | None, payload: bytes, digest: str, of: int | None, revisit: bool, date: str) -> bytes:
    """One record: the response with its payload, or the revisit with the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(page_id)), ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        head += [("WARC-Refers-To", urn(of)), ("WARC-Profile", IDENTICAL)]
    if url is not None:  # a header is one line
        head.append(("WARC-Target-URI", url.decode().replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at a place, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    head = dict(line.split(": ", 1) for line in data[at + len(VERSION) : end].decode().split("\r\n"))
    start, size = end + 4, int(head["Content-Length"])
    block = data[start : start + size]
    cut = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[: cut - 4].decode().split("\r\n")[1:])
    revisit = head["WARC-Type"] == "revisit"
    payload = None if revisit else block[cut:]
    uri = head.get("WARC-Target-URI")
    return {
        "page_id": page_of(head["WARC-Record-ID"]),
        "url": None if uri is None else uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": head["WARC-Type"],
        "payload_bytes": int(http["Content-Length"]) if revisit else len(payload),
        "payload_digest": head["WARC-Payload-Digest"][5:] if revisit else base32_sha1(payload),
        "refers_to": page_of(head["WARC-Refers-To"]) if revisit else None,
        "payload": payload, "at": at,
    }, start + size + 4


@dataclass
class Bundle:
    """A bundle being written: frames that stand alone, then the table of their sizes."""

    sink: object
    sizes: list[tuple[int, int]] = field(default_factory=list)
    written: int = 0

    def frame(self, data: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=3).compress(data)
        self.sink.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.written += len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.sink.close()


def seek_table(file) -> list[tuple[int, int]]:
    """(offset, packed size) of the frames of a bundle, from its end."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    packed = [p for p, _ in struct.iter_unpack("<II", file.read(8 * count))]
    out, at = [], 0
    for p in packed:
        out.append((at, p))
        at += p
    return out


def read_frame(file, place: tuple[int, int]) -> bytes:
    file.seek(place[0])
    return zstandard.ZstdDecompressor().decompress(file.read(place[1]))


def decide(pages: DataFrame, least: int = 0, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """The pages that repeat a payload: (``page_id``, ``sha``, ``owner``), one row each.

    Payloads of at least ``least`` bytes are equal if their SHA-1 is; the smallest page_id of them is the owner (a null
    id only among nulls). Nothing but ids and digests is shuffled, summed up per task first.
    """
    slim = pages.select(F.col(page_id).alias("page_id"), payload(html).alias("payload")).select(
        "page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")).filter(F.col("n") >= least)
    owners = slim.groupBy("sha").agg(F.min("page_id").alias("owner"), F.count("*").alias("times")).filter("times > 1").drop("times")
    return slim.drop("n").join(owners, "sha").filter(~F.col("page_id").eqNullSafe(F.col("owner"))).distinct()


def payload(html: str):
    return F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")


def write(
    pages: DataFrame, folder: str | None = None, least: int = 0, frame_bytes: int = 1 << 20, bundle_bytes: int = 64 << 20,
    date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write a record per row into bundles under ``folder`` (a new shared one by default); return the index.

    A row whose payload is that of a smaller page_id becomes a revisit of it, the others are responses. A null html is
    an empty payload; a null url is left out; rows with equal page_id and payload are records of their own of one kind.
    An empty table gives no bundle. A task fills frames of at least ``frame_bytes`` (one record may be larger) and
    bundles of about ``bundle_bytes`` packed. Every attempt of a task has its own file names; the index, which Spark
    commits, names only those of attempts that succeeded. Index: ``page_id``, ``bundle``, ``frame``, ``at`` (offset in
    the unpacked frame), ``length``.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "bundles")
    repeats = decide(pages, least, page_id, html)
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), payload(html).alias("payload"))
    rows = rows.withColumn("hash", F.sha1("payload"))
    rows = rows.join(repeats, rows["id"].eqNullSafe(repeats["page_id"]) & (rows["hash"] == repeats["sha"]), "left")
    rows = rows.select("id", "url", "payload", "owner", F.col("sha").isNotNull().alias("revisit"))

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        bundle, number, names = None, 0, []
        buffer, size, pending = [], 0, []

        def flush() -> Iterator[dict[str, list]]:
            nonlocal bundle, number, buffer, size, pending
            if not buffer:
                return
            if bundle is None:
                names.append(f"{task.partitionId():06d}-{task.taskAttemptId()}-{number}.warc.zst")
                bundle, number = Bundle(files.open_output_stream(f"{root}/{names[-1]}", compression=None)), number + 1
            bundle.frame(b"".join(buffer))
            yield {
                "page_id": [p for p, _, _ in pending], "bundle": [names[-1]] * len(pending), "frame": [len(bundle.sizes) - 1] * len(pending),
                "at": [a for _, a, _ in pending], "length": [n for _, _, n in pending],
            }
            buffer, size, pending = [], 0, []
            if bundle.written >= bundle_bytes:
                bundle.close()
                bundle = None

        for batch in batches:
            for page, link, body, owner, revisit in zip(*(batch[c] for c in ("id", "url", "payload", "owner", "revisit"))):
                record = to_record(page, link, body, base32_sha1(body), owner, revisit, date)
                pending.append((page, size, len(record)))
                buffer.append(record)
                size += len(record)
                if size >= frame_bytes:
                    yield from flush()
        yield from flush()
        if bundle is not None:
            bundle.close()

    index = map_batches(rows, INDEX, run).withColumn("bundle", F.concat(F.lit(folder.rstrip("/") + "/"), "bundle"))
    return written(index, "bundle-index")


def read(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the bundles that an index names, a frame in memory at a time.

    Payload length and digest of a response are those of the payload read; a revisit has the recorded ones.
    """
    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for name in batch["bundle"]:
                files, path = open_folder(name.decode())
                with files.open_input_file(path) as file:
                    for frame, place in enumerate(seek_table(file)):
                        data, at, out = read_frame(file, place), 0, []
                        while at < len(data):
                            record, at = parse_record(data, at)
                            out.append(record | {"frame": frame} | ({} if with_payload else {"payload": None}))
                        yield {k: [r[k] for r in out] for k in (c.split()[0] for c in RECORD.split(", "))}

    return map_batches(index.select("bundle").distinct(), RECORD, run)


def fetch(wanted: DataFrame) -> DataFrame:
    """The records of some index rows: each one's frame is read alone, and the record at its offset in it."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            tables: dict[bytes, list] = {}
            for name, frame, at in sorted(zip(batch["bundle"], batch["frame"], batch["at"])):
                files, path = open_folder(name.decode())
                with files.open_input_file(path) as file:
                    table = tables.get(name) or tables.setdefault(name, seek_table(file))
                    record, _ = parse_record(read_frame(file, table[frame]), at)
                yield {k: [v] for k, v in (record | {"frame": frame}).items()}

    return map_batches(wanted.select("bundle", "frame", "at"), RECORD, run)
