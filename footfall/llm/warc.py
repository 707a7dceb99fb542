"""WARC records in ZIP packages: written by tasks, then read back by byte ranges.

A package holds a member ``archive/data.warc.gz`` of separately compressed records and an index of their
offsets, both stored without further compression. The reader takes the central directory (ZIP64 too) from the
end of the file, finds the stored members, reads the index, and fetches each record by its byte range; no
member is ever extracted, and the records of a package can be read by many tasks.
"""

from __future__ import annotations

import gzip
import json
import math
import struct
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import objects
from footfall.session import cut_lineage

#: Production parameters: payloads shorter than this are never revisits; bytes that one task reads of a package.
LEAST_REVISIT = 100
RANGE_BYTES = 8 << 20

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"

# Signatures and sizes of the ZIP format.
END, END_SIZE = b"PK\x05\x06", 22
END64, LOCATOR64, LOCATOR64_SIZE = b"PK\x06\x06", b"PK\x06\x07", 20
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
LONGEST_COMMENT = 65_535
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    size: int
    header_at: int


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a path as Spark writes it."""
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def open_file(path: str):
    """A file for random reads on any file system that pyarrow knows, and its size."""
    system, inner = locate(path)
    found = system.open_input_file(inner)
    return found, found.size()


def read_range(file, at: int, size: int) -> bytes:
    file.seek(at)
    found = file.read(size)
    if len(found) != size:
        raise ValueError(f"{size} bytes wanted at {at}, {len(found)} found")
    return found


def directory(file, size: int) -> list[Member]:
    """Members of a package, from its central directory; bytes before the first member are allowed."""
    tail_at = max(0, size - END_SIZE - LONGEST_COMMENT)
    tail = read_range(file, tail_at, size - tail_at)
    place = tail.rfind(END)
    while place >= 0:
        if place + END_SIZE <= len(tail):
            comment = struct.unpack_from("<H", tail, place + 20)[0]
            if place + END_SIZE + comment == len(tail):
                break
        place = tail.rfind(END, 0, place)
    if place < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack_from("<HII", tail, place + 10)
    end_at = tail_at + place
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read_range(file, end_at - LOCATOR64_SIZE, LOCATOR64_SIZE)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        # The record ends where its locator begins, whatever stands before the first member.
        declared = struct.unpack_from("<Q", locator, 8)[0]
        end_at, record = _end64(file, end_at - LOCATOR64_SIZE, declared)
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    shift = end_at - length - start
    listed, members, at = read_range(file, end_at - length, length), [], 0
    for _ in range(entries):
        if listed[at : at + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", listed, at + 8)
        packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", listed, at + 20)
        header_at = struct.unpack_from("<I", listed, at + 42)[0]
        name = listed[at + ENTRY_SIZE : at + ENTRY_SIZE + names]
        extra = listed[at + ENTRY_SIZE + names : at + ENTRY_SIZE + names + extras]
        packed, header_at = _wide(extra, plain, packed, header_at)
        text = name.decode("utf-8" if flags & 0x800 else "cp437")
        members.append(Member(text, method, flags, packed, header_at + shift))
        at += ENTRY_SIZE + names + extras + comment
    return members


def _end64(file, locator_at: int, declared: int) -> tuple[int, bytes]:
    for at in (declared, locator_at - 56):
        if 0 <= at <= locator_at - 56:
            record = read_range(file, at, 56)
            if record[:4] == END64 and at + 12 + struct.unpack_from("<Q", record, 4)[0] == locator_at:
                return at, record
    raise ValueError("no ZIP64 end of central directory")


def _wide(extra: bytes, plain: int, packed: int, header_at: int) -> tuple[int, int]:
    """Packed size and header offset, from the ZIP64 field where the entry has no room for them."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if plain == 0xFFFFFFFF:
                next(values)
            if packed == 0xFFFFFFFF:
                packed = next(values)
            if header_at == 0xFFFFFFFF:
                header_at = next(values)
            break
        at += 4 + length
    return packed, header_at


def stored_at(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0 or member.flags & 1:
        raise ValueError(f"{member.name} is compressed or encrypted")
    header = read_range(file, member.header_at, LOCAL_SIZE)
    if header[:4] != LOCAL:
        raise ValueError(f"no member at {member.header_at}")
    names, extras = struct.unpack_from("<HH", header, 26)
    return member.header_at + LOCAL_SIZE + names + extras


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = name.rpartition(":")[2].rstrip(">") if name else "none"
    return None if number == "none" else int(number)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 response, or a revisit that has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", REVISIT if revisit else None),
        ("WARC-Refers-To", _name(refers_to) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and what follows them."""

    def headers(block: bytes) -> tuple[dict[str, str], int]:
        end = block.index(b"\r\n\r\n")
        lines = block[:end].decode("utf-8").split("\r\n")[1:]
        return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4

    if not raw.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    outer, at = headers(raw)
    block = raw[at : at + int(outer["content-length"])]
    inner, at = headers(block)
    return outer, inner, block[at:]


def _write(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        system, inner = locate(folder)
        final = f"pages-{task.partitionId():06d}.zip"
        part = f"{inner}/.{final}.{task.taskAttemptId()}"
        index, at, stream = [], 0, None
        for batch in batches:
            if stream is None and len(batch):
                system.create_dir(inner, recursive=True)
                stream = system.open_output_stream(part)
                package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                member = package.open(ARCHIVE, "w", force_zip64=True)
            for page_id, url, payload, digest, refers_to, kind in zip(
                batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["refers_to"], batch["record_type"]
            ):
                own = None if pd.isna(page_id) else int(page_id)
                other = None if pd.isna(refers_to) else int(refers_to)
                packed = gzip.compress(record_bytes(own, url, payload, digest, other, kind == "revisit"), 6, mtime=0)
                member.write(packed)
                index.append((at, len(packed)))
                at += len(packed)
        if stream is not None:
            member.close()
            package.writestr(INDEX, "".join(json.dumps({"offset": o, "length": n}) + "\n" for o, n in index))
            package.close()
            stream.close()
            system.move(part, f"{inner}/{final}")
            yield pd.DataFrame({"path": objects([f"{folder}/{final}"]), "records": [len(index)], "bytes": [at]})

    return run


def write_archives(pages: DataFrame, folder: str, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write every page as a record into packages below ``folder``: ``path, records, bytes``, one row per package.

    Of equal payloads of at least ``least_revisit`` bytes the page with the smallest id is the response (all
    rows with that id, if it is repeated, and all rows if none has an id). A task writes its package under a
    name of its own and renames it when it is whole, so a task that runs again leaves one package; the list
    is stored, so that reading never runs the writing again.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    records = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    long_ones = records.filter(F.octet_length("payload") >= least_revisit)
    firsts = cut_lineage(
        long_ones.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = records.join(firsts, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(again, F.col("first")).alias("refers_to"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
    )
    return cut_lineage(typed.mapInPandas(_write(folder), "path string, records long, bytes long"))


def _list_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            file, size = open_file(path)
            with file:
                members = {m.name: m for m in directory(file, size)}
                start = stored_at(file, members[ARCHIVE])
                listed = read_range(file, stored_at(file, members[INDEX]), members[INDEX].size)
            lines = [json.loads(line) for line in listed.splitlines()]
            yield pd.DataFrame(
                {
                    "path": objects([path] * len(lines)),
                    "at": [start + x["offset"] for x in lines],
                    "length": [x["length"] for x in lines],
                }
            )


def _read_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, own in batch.sort_values(["path", "at"]).groupby("path", sort=False):
            file, _ = open_file(path)
            rows, held = [], 0
            with file:
                for at, length in zip(own["at"], own["length"]):
                    outer, inner, payload = parse_record(gzip.decompress(read_range(file, int(at), int(length))))
                    revisit = outer["warc-type"] == "revisit"
                    rows.append(
                        (
                            _page(outer["warc-record-id"]),
                            outer.get("warc-target-uri"),
                            outer["warc-type"],
                            _page(outer.get("warc-refers-to")),
                            int(inner["content-length"]),
                            outer["warc-payload-digest"].partition(":")[2],
                            None if revisit else payload,
                        )
                    )
                    held += len(payload)
                    if held > RANGE_BYTES:
                        yield _frame(rows)
                        rows, held = [], 0
            yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(
        rows, columns=["page_id", "url", "record_type", "refers_to", "declared_bytes", "declared_digest", "payload"]
    )
    texts = dict.fromkeys(["url", "record_type", "declared_digest", "payload"], object)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", **texts})


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the packages named in ``path`` (``bytes`` long), fetched by byte range.

    ``page_id, url, record_type, refers_to, declared_bytes, declared_digest, payload``; a revisit has no
    payload of its own. Ranges are dealt out by package and position, so one large package is read by many
    tasks. A package that is cut short or broken raises. Target addresses come back percent-encoded.
    """
    listed = archives.select("path").mapInPandas(_list_records, "path string, at long, length long")
    ranges = math.ceil((archives.agg(F.sum("bytes")).first()[0] or 0) / RANGE_BYTES)
    dealt = listed.repartition(max(1, 2 * ranges), "path", F.floor(F.col("at") / RANGE_BYTES))
    return dealt.mapInPandas(
        _read_records,
        "page_id long, url string, record_type string, refers_to long, declared_bytes long, declared_digest string, "
        "payload binary",
    )


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages, read them back, and tell each page's payload and record.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Null html is an empty payload, null
    ids stay null, repeated rows give a record each, an empty table an empty result.
    """
    read = read_archives(write_archives(pages, folder))
    return read.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("declared_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
