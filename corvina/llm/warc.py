"""Dictionary-compressed WARC archives.

An archive begins with a skippable Zstandard frame that holds a dictionary,
built from records taken evenly from all of the archive; every record follows
as a frame of its own, compressed with that dictionary. Pages with the payload
of another page are archived as revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, met, met_where_hot, quoted, remove_folder, scratch, shared_folder  # noqa: F401

#: The magic number of the skippable frame that holds a dictionary.
DICT_MAGIC = 0x184D2A5D
#: Payloads that are shorter are never revisits.
LEAST_REVISIT = 100
#: A dictionary's size, the records it is built from, and how many bytes from the beginning of each of them.
DICT_BYTES, SAMPLE_RECORDS, RECORD_BYTES = 1 << 16, 256, 1 << 14
#: An archive is closed once its records are this long; so much is held by a task.
ARCHIVE_BYTES = 1 << 26
#: Equal payloads beyond so many are dealt out.
HOT = 1000
#: What can't stand in a header line as it is.
UNSAFE = re.compile(r"[\x00-\x20\x7f-\xa0\u2028\u2029]")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None, again: str = "") -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head only.

    again tells records of one page apart. A null URL has no field. One with
    blanks or control characters is percent-encoded, and stands beside that in
    base64, so that it is read back as it was.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id, again)), ("WARC-Date", DATE)]
    if url is not None:
        plain = not UNSAFE.search(url)
        fields.append(("WARC-Target-URI", url if plain else UNSAFE.sub(lambda m: quote(m[0]), url)))
        if not plain:
            fields.append(("X-Target-URI-Base64", base64.b64encode(url.encode()).decode()))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _urn(page_id: str | None, again: str = "") -> str:
    """Ids are quoted, so that they may hold anything; no id is no path at all."""
    return f"<urn:page{'' if page_id is None else ':' + quote(str(page_id), safe='')}{'#' + again if again else ''}>"


def _page(urn: str) -> str | None:
    inner = urn.removeprefix("<urn:page").removesuffix(">").partition("#")[0]
    return unquote(inner[1:]) if inner else None


def _url(fields: dict) -> str | None:
    raw = fields.get("X-Target-URI-Base64")
    return base64.b64decode(raw).decode() if raw is not None else fields.get("WARC-Target-URI")


def parse(raw: bytes) -> dict:
    """Fields, HTTP head and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"fields": fields, "http": http.decode(), "payload": payload}


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of bounded size from up to SAMPLE_RECORDS records, evenly spaced, of which the first RECORD_BYTES count.

    Where there is too little to train one, it holds the samples as they are; without records there is none.
    """
    step = max(1, -(-len(records) // SAMPLE_RECORDS))
    samples = [r[:RECORD_BYTES] for r in records[::step]]
    if not samples:
        return None
    if len(samples) >= 8:
        try:
            return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples, k=512, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[:RECORD_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def leading_frame(d: zstandard.ZstdCompressionDict | None) -> bytes:
    if d is None:
        return b""
    body = zstandard.ZstdCompressor(level=3).compress(d.as_bytes())
    return struct.pack("<II", DICT_MAGIC, len(body)) + body


def write_archive(records: Iterable[bytes], out) -> int:
    """Writes the records of one archive, which are held meanwhile, to a binary file; returns the bytes written."""
    held = list(records)
    d = dictionary(held)
    packer = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=True) if d else zstandard.ZstdCompressor(level=3, write_content_size=True)
    return out.write(leading_frame(d)) + sum(out.write(packer.compress(r)) for r in held)


def read_archive(source) -> object:
    """The records of an archive, one after another, from a binary file."""
    head = source.read(8)
    d = None
    rest = head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICT_MAGIC:
        body = source.read(struct.unpack("<I", head[4:])[0])
        d = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(body) if body[:4] == b"\x28\xb5\x2f\xfd" else body)
        rest = b""
    opener = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    while True:
        rest = rest or source.read(1 << 20)
        if not rest:
            return
        frame, parts = opener.decompressobj(), []
        while not frame.eof:
            if not rest:
                rest = source.read(1 << 20)
                if not rest:
                    raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to, repeated) of what is to be archived.

    Of pages with equal payloads of at least 100 bytes the smallest id is the
    response, and rows that repeat that id are responses too; others refer to
    it. A null html is an empty payload. A page without an id refers to the
    smallest id there is; payloads seen only without ids are all responses.
    repeated tells rows that share their id, or have none, from others. Ids keep their type.
    """
    payload = F.encode(F.coalesce(quoted(html), F.lit("")), "UTF-8")
    keyed = pages.select(
        quoted(page_id).alias("page_id"), quoted(url).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.sha2(payload, 256).alias("payload_digest")
    )
    # Decided on ids and digests alone. Payloads that occur once, or are too short, need no partner.
    small = keyed.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy(F.col("payload_digest").alias("d"))
    again = scratch(small.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    twice = scratch(keyed.groupBy("page_id").agg(F.count("*").alias("m")).where("m > 1").select("page_id", F.lit(True).alias("repeated")))
    wide = keyed.withColumn("d", F.when(F.col("payload_bytes") >= LEAST_REVISIT, F.col("payload_digest")))
    if again.count() <= BROADCAST_ROWS:  # the payloads stay where they are
        joined = wide.join(F.broadcast(again), "d", "left")
    else:
        joined = met_where_hot(wide.where("d IS NOT NULL"), again, ["d"], "page_id", F.col("n") > HOT, "left").unionByName(wide.where("d IS NULL"),
            allowMissingColumns=True)
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    told = met(joined.withColumn("refers_to", refers).drop("d", "first", "n"), twice, ["page_id"], "payload_digest", "left")
    return told.withColumn("repeated", F.coalesce("repeated", F.col("page_id").isNull()))


def _writer(folder: str):
    """Writes archives under names that no other attempt of a task has, and lists them."""

    def run(batches):
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        attempt, names, counts = uuid.uuid4().hex, [], []
        held: list[bytes] = []

        def close() -> None:
            name = f"{attempt}-{len(names):04d}.warc.zst"
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                write_archive(held, out)
            names.append(name)
            counts.append(len(held))
            held.clear()

        size = position = 0
        columns = ("page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to", "repeated")
        for b in batches:
            for i in range(b.num_rows):
                *r, repeated = (b.column(c)[i].as_py() for c in columns)
                position += 1
                one = record(*r, again=f"{attempt}-{position}" if repeated else "")
                held.append(one)
                size += len(one)
                if size >= ARCHIVE_BYTES:
                    close()
                    size = 0
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["file", "records"])

    return run


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives all pages under folder, a URI that executors can write to, and returns (file, records).

    Rows are archived where they lie, in files that only the task's own attempt
    writes; those of attempts that were given up are listed nowhere. Null, empty
    and very long payloads, repeated rows and ids are as plan() says; other
    columns are not archived; an empty table gives no files.
    """
    rows = plan(pages, page_id, url, html)
    return scratch(rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInArrow(_writer(folder), "file string, records bigint"))


def _reader(folder: str):
    def run(batches):
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for raw in read_archive(source):
                        r = parse(raw)
                        f = r["fields"]
                        sized = int(r["http"].rpartition("Content-Length: ")[2])
                        digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                        if f["WARC-Type"] == "response" and (len(r["payload"]) != sized or hashlib.sha256(r["payload"]).hexdigest() != digest):
                            raise ValueError(f"{name}: the payload of {f['WARC-Record-ID']} is damaged")
                        refers = _page(f["WARC-Refers-To"]) if "WARC-Refers-To" in f else None
                        payload = r["payload"] if f["WARC-Type"] == "response" else None
                        rows.append((_page(f["WARC-Record-ID"]), _url(f), sized, digest, f["WARC-Type"], refers, payload))
                        held += len(raw)
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)], list(names))
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)], list(names))

    return run


def read_warc(written: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of the records of the files listed.

    The payload of a response is held against its length and digest; a revisit
    has none. Ids are read as id_type. No files give no rows.
    """
    spread = written.select("file").repartition(max(1, written.rdd.getNumPartitions()), "file")
    schema = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    rows = spread.mapInArrow(_reader(folder), schema)
    return rows.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
