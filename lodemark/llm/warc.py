"""WARC records in ZIP-packaged archives, and a reader that finds and range-reads them without extraction.

An archive is a ZIP file with two stored members: `archive/data.warc.gz`, one gzip member per WARC record, and
`indexes/index.cdxj`, one line per record with its place in the first. Files are reached through pyarrow's file systems, so the
folder may be a shared disk, HDFS or an object store.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.sources.scans import Scratch

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = "<urn:lodemark:page:{}>"
# Fixed values of the ZIP format: signatures and the markers that send a reader to the ZIP64 fields.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MARK16, MARK32 = 0xFFFF, 0xFFFFFFFF
TASK_BYTES = 32 << 20


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed_size: int
    header_offset: int


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


# ---- records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, level: int) -> bytes:
    """One WARC/1.1 record as a gzip member. With `first`, a revisit of that page's record: headers, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {RECORD_ID.format(page_id)}",
              f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if first is not None:
        fields += [f"WARC-Refers-To: {RECORD_ID.format(first)}", f"WARC-Profile: {PROFILE}"]
    data = "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _page(value: str | None) -> int | None:
    text = "" if value is None else value.removeprefix(RECORD_ID.partition("{}")[0]).removesuffix(">")
    return None if text in ("", "None") else int(text)


def parsed(data: bytes) -> tuple[int | None, str | None, bytes | None, int, str, str, int | None]:
    """Page id, URL, payload (null for a revisit), payload size and digest, type, page referred to. A wrong digest is an error."""
    text = zlib.decompress(data, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), payload if kind == "response" else None, length, digest,
            kind, _page(fields.get("WARC-Refers-To")))


# ---- ZIP directories


def _wide(extra: bytes, size: int, packed_size: int, offset: int) -> tuple[int, int, int]:
    """Sizes and offset with the values of the ZIP64 extra field in place of the markers."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return tuple(next(values) if v == MARK32 else v for v in (size, packed_size, offset))
        at += 4 + n
    return size, packed_size, offset


def directory(file) -> list[Member]:
    """Members listed in the central directory of an open ZIP file, by its ZIP64 records where it has them."""
    total = file.size()
    tail_at = max(0, total - 66_000)
    file.seek(tail_at)
    tail = file.read(total - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("not a ZIP file")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if MARK16 == count or MARK32 in (size, start):
        if locator < 0 or tail[locator:locator + 4] != LOCATOR64:
            raise ValueError("ZIP64 locator is missing")
        file.seek(struct.unpack_from("<Q", tail, locator + 8)[0])
        wide = file.read(56)
        if wide[:4] != END64:
            raise ValueError("ZIP64 end record is missing")
        count, size, start = struct.unpack_from("<QQQ", wide, 32)
    file.seek(start)
    entries, at, out = file.read(size), 0, []
    for _ in range(count):
        if entries[at:at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", entries, at + 10)
        packed_size, full = struct.unpack_from("<II", entries, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", entries, at + 28)
        offset, = struct.unpack_from("<I", entries, at + 42)
        name = entries[at + 46:at + 46 + n_name].decode("utf-8")
        full, packed_size, offset = _wide(entries[at + 46 + n_name:at + 46 + n_name + n_extra], full, packed_size, offset)
        out.append(Member(name, method, full, packed_size, offset))
        at += 46 + n_name + n_extra + n_comment
    return out


def stored_at(file, member: Member) -> int:
    """Where the bytes of a stored member begin in the archive."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; archive members must be stored")
    file.seek(member.header_offset)
    head = file.read(30)
    if head[:4] != LOCAL:
        raise ValueError("damaged local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header_offset + 30 + n_name + n_extra


# ---- Spark jobs


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = 32 << 20, revisit_bytes: int = 100, level: int = 3) -> DataFrame:
    """Writes a record per row into ZIP archives under `folder` and returns their paths and record counts.

    Of rows with equal payloads of at least revisit_bytes, those with the smallest id are responses and the others revisits
    of it; smaller payloads are all responses. Smallest ids are found with map-side sums; only digests that occur more than
    once are joined to the rows, and a digest of any number of rows spreads over the join's tasks and over all archives.
    Rows are dealt to archives of about archive_bytes of payload by a hash of id and URL. An archive is written under a
    name of the attempt's own and then moved to its final one, so a repeated or speculative task leaves one whole file.

    A null html is an empty payload, a null URL is left out, and a row with a null id gets a record with a null id: it is a
    revisit where its payload belongs to a known id. Repeated rows give repeated records. An empty table writes no archive.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    sizes = rows.groupBy(F.when(F.length("payload") >= revisit_bytes, F.col("digest")).alias("digest"))
    sizes = scratch.write(sizes.agg(F.min("id").alias("first"), F.count("*").alias("n"), F.sum(F.length("payload")).alias("bytes")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    repeats = scratch.write(sizes.where(F.col("digest").isNotNull() & (F.col("n") > 1)).select("digest", "first"))
    rows = rows.join(repeats, "digest", "left")
    rows = rows.withColumn("first", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    archives = max(1, -(-total // archive_bytes))
    rows = rows.withColumn("archive", F.pmod(F.xxhash64("id", "url"), F.lit(archives)))
    # one archive a task: by a hash of the number, several of them could fall to one
    rows = rows.repartitionById(archives, F.col("archive").cast("int")).sortWithinPartitions("archive", "id", "url")

    def save(number: int, members: list[bytes], lines: list[dict]) -> tuple[str, int]:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
            archive.writestr(DATA, b"".join(members))
            archive.writestr(INDEX, "".join(json.dumps(x) + "\n" for x in lines))
        system, path = opened(folder)
        system.create_dir(path)
        own = f"{path}/.{number:08d}-{TaskContext.get().taskAttemptId()}-{os.getpid()}"
        with system.open_output_stream(own) as out:
            out.write(buffer.getbuffer())
        system.move(own, f"{path}/{number:08d}.wacz")
        return f"{folder}/{number:08d}.wacz", len(members)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, members, lines, at, done = None, [], [], 0, []
        for batch in batches:
            for page_id, url, payload, digest, first, archive in zip(*[batch[c] for c in ("id", "url", "payload", "digest", "first", "archive")]):
                if archive != number:
                    if members:
                        done.append(save(number, members, lines))
                    number, members, lines, at = archive, [], [], 0
                page_id, first = (None if pd.isna(v) else int(v) for v in (page_id, first))
                members.append(record(page_id, url, payload, digest, first, level))
                lines.append({"url": url, "digest": f"sha256:{digest}", "offset": at, "length": len(members[-1]), "filename": DATA})
                at += len(members[-1])
        if members:
            done.append(save(number, members, lines))
        yield pd.DataFrame(done, columns=["path", "records"])

    sent = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", F.col("first").cast("string").alias("first"), "archive")
    written = scratch.write(sent.mapInPandas(write, "path string, records long"))
    scratch.drop(sizes, repeats)
    return written


def read_index(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Place of every record of the archives: path, offset in the archive, length, url, digest.

    Only the directories and the index members are read. An archive without an index member is an error.
    """
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    members = {m.name: m for m in directory(file)}
                    begins = {n: stored_at(file, m) for n, m in members.items() if n.startswith("archive/")}
                    file.seek(stored_at(file, members[INDEX]))
                    lines = [json.loads(x) for x in file.read(members[INDEX].size).splitlines()]
                yield pd.DataFrame({
                    "path": path, "offset": [begins[x["filename"]] + x["offset"] for x in lines], "length": [x["length"] for x in lines],
                    "url": [x["url"] for x in lines], "digest": [x["digest"] for x in lines]})

    paths = paths.select(F.col(f"`{path_col}`").alias("path"))
    return paths.repartition(max(1, paths.count()), "path").mapInPandas(locate, "path string, offset long, length long, url string, digest string")


def read_records(index: DataFrame, range_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """The records at the places of the index: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Places are dealt out by archive and range of range_bytes, to as many tasks as the archives need at TASK_BYTES each; records
    that follow each other in one range are fetched by one read. Every response's payload is checked against its size and digest. Without payloads, that column is null.
    """
    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, mine in batch.groupby("path", sort=False):
                mine = mine.sort_values("offset")
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    run: list[tuple[int, int]] = []
                    for place in [*zip(mine["offset"], mine["length"]), None]:
                        if run and (place is None or place[0] != sum(run[-1]) or sum(place) - run[0][0] > range_bytes):
                            file.seek(run[0][0])
                            data = file.read(sum(run[-1]) - run[0][0])
                            out += [parsed(data[a - run[0][0]:a - run[0][0] + n]) for a, n in run]
                            run = []
                        run.append(place)
            rows = [(None if r[0] is None else str(r[0]), r[1], r[2] if payloads else None, *r[3:6], None if r[6] is None else str(r[6])) for r in out]
            yield pd.DataFrame(rows, columns=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    index = Scratch(index.sparkSession).write(index.select("path", "offset", "length"))
    tasks = (index.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES + 1
    dealt = index.withColumn("block", F.floor(F.col("offset") / range_bytes)).repartition(tasks, "path", "block").select("path", "offset", "length")
    found = dealt.mapInPandas(fetch, "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})
