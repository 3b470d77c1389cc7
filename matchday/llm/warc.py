"""WARC archives: writing, normalising whole-file gzip streams to a member per record, reading by offset."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchday.llm.common import named
from matchday.workspace import materialise, new_folder

#: Bytes that a reader takes from a stream at a time.
BLOCK = 1 << 18
#: Payloads below this size are never revisits.
LEAST_REVISIT = 100
#: Uncompressed bytes of an archive file, about.
ARCHIVE_BYTES = 16 << 20
LEVEL = 6

HEAD = b"WARC/1.1\r\n"


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of every row of ``pages``.

    Of rows with equal payloads of at least LEAST_REVISIT bytes the smallest id is the response and the
    others revisit it. Only digests that repeat are joined back, not the pages.
    """
    rows = pages.select(
        named(id_col).cast("long").alias("page_id"),
        F.coalesce(named(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(named(html_col).cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(materialise(large.where("n > 1").drop("n"), "warc-repeated"), "payload_digest", "left")
    # a null id refers to the smallest, and is a response only where all ids of a payload are null
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first"))).drop("first")


def write_monolithic(records: DataFrame, folder: str) -> None:
    """Writes the records of :func:`with_record_types` as archives, each one gzip stream of a whole file.

    A record is a line of Spark's text writer whose separator is the second empty line at its end, so
    the bytes are those of a WARC file. A revisit has no block; its header keeps size and digest of the
    payload it stands for.
    """

    def field(name: str, value) -> list:
        return [F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")]

    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    # a url cannot end a header line
    url = F.translate("url", "\r\n", "")
    head = F.concat(
        F.lit(HEAD.decode()),
        *field("WARC-Type", F.col("record_type")),
        *field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        *field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        *field("WARC-Target-URI", url),
        *field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        *field("WARC-Payload-Length", F.col("payload_bytes")),
        F.when(revisit, F.concat(*field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        F.when(revisit, F.concat(*field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))))).otherwise(""),
        *field("Content-Type", F.lit("text/html; charset=utf-8")),
        *field("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    # files of about ARCHIVE_BYTES, so that a task that normalises one can hold it
    size = records.select(F.sum("payload_bytes").alias("b"), F.count("*").alias("n")).first()
    per_file = max(1, int((size["n"] or 1) * ARCHIVE_BYTES / max(1, size["b"] or 1)))
    lines = records.select(F.concat(head, block, F.lit("\r\n")).alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(folder)


class Inflated:
    """Reads a gzip stream of one or more members once, front to back."""

    def __init__(self, data: bytes):
        self.data, self.at, self.left = memoryview(data), 0, b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self.inflate.eof:
                rest = self.inflate.unused_data
                self.at -= len(rest)
                if self.at >= len(self.data):
                    return False
                self.inflate = zlib.decompressobj(31)
            if self.at >= len(self.data):
                return False
            block = self.data[self.at : self.at + BLOCK]
            self.at += len(block)
            found = self.inflate.decompress(block)
            if found:
                self.left += found
                return True

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``, or nothing at the end of the stream."""
        start = 0
        while (found := self.left.find(mark, start)) < 0:
            start = max(0, len(self.left) - len(mark) + 1)
            if not self._more():
                if self.left:
                    raise ValueError("the stream ends within a record")
                return b""
        out, self.left = self.left[: found + len(mark)], self.left[found + len(mark) :]
        return out

    def take(self, size: int) -> bytes:
        parts, missing = [], size
        while True:
            parts.append(self.left[:missing])
            self.left = self.left[missing:]
            missing -= len(parts[-1])
            if not missing:
                return b"".join(parts)
            if not self._more():
                raise ValueError("the stream ends within a record")


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def records_of(data: bytes) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """(header bytes, headers, block) of each record of a gzip stream."""
    stream = Inflated(data)
    while head := stream.until(b"\r\n\r\n"):
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = headers_of(head)
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end with two empty lines")
        yield head, headers, block


def _page(urn: str) -> int | None:
    found = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "null" else int(found)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{uri}")


def _normalise(folder: str):
    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py().rsplit("/", 1)[-1].split(".")[0]
                data = batch.column("content")[i].as_buffer()
                store, base = _open(folder)
                # each attempt writes a file of its own and names it at the end, so a repeated task changes nothing
                final, own = f"{base}/{name}.warc.gz", f"{base}/.{name}-{uuid.uuid4().hex}"
                at, index = 0, []
                with store.open_output_stream(own) as out:
                    for head, headers, block in records_of(data):
                        deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = deflate.compress(head) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()
                        out.write(member)
                        index.append({"offset": at, "length": len(member), "type": headers["warc-type"], "record_id": headers["warc-record-id"], "digest": headers.get("warc-payload-digest", "")})
                        at += len(member)
                store.move(own, final)
                with store.open_output_stream(f"{own}.idx") as out:
                    out.write("".join(json.dumps(x) + "\n" for x in index).encode())
                store.move(f"{own}.idx", f"{base}/{name}.idx")
                yield pa.RecordBatch.from_pydict({"file": pa.array([final]), "records": pa.array([len(index)], pa.int64()), "bytes": pa.array([at], pa.int64())})

    return normalise


def normalise(spark: SparkSession, monolithic: str, folder: str) -> DataFrame:
    """Rewrites every archive of ``monolithic`` to ``folder``; returns file, records and bytes of each.

    A whole-file stream can only be read from its start: it is inflated once, record by record, and
    each record becomes a gzip member of its own, so that it can be read alone. ``NAME.idx`` beside
    ``NAME.warc.gz`` has a JSON line for each record: offset, length, type, record_id, digest. Both
    folders must be ones that all executors reach. An archive is held by one task, compressed.
    """
    store, base = _open(folder)
    store.create_dir(base, recursive=True)
    files = spark.read.format("binaryFile").load(f"{monolithic}/*.gz").select("path", "content")
    return materialise(files.mapInArrow(_normalise(folder), "file string, records long, bytes long"), "warc-files")


def _read(folder: str):
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                store, _ = _open(folder)
                with store.open_input_stream(path.removesuffix(".warc.gz") + ".idx") as lines:
                    index = [json.loads(x) for x in lines.read().splitlines()]
                with store.open_input_file(path) as archive:
                    for start in range(0, max(1, len(index)), 200):
                        rows = []
                        for entry in index[start : start + 200]:
                            member = archive.read_at(entry["length"], entry["offset"])
                            ((_, headers, block),) = records_of(member)
                            digest = headers["warc-payload-digest"].removeprefix("sha256:")
                            if headers["warc-type"] == "response":
                                if hashlib.sha256(block).hexdigest() != digest:
                                    raise ValueError(f"{path}: the payload at {entry['offset']} is not what was written")
                                size = len(block)
                            else:
                                size = int(headers["warc-payload-length"])
                            refers = _page(headers["warc-refers-to"]) if "warc-refers-to" in headers else None
                            rows.append((_page(headers["warc-record-id"]), headers["warc-target-uri"], headers["warc-type"], refers, size, digest, block))
                        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types, strict=True)], schema=kinds)

    return read


def read(archives: DataFrame, folder: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload of every record of ``archives`` (file).

    Every record is read by its offset and checked against its digest. The payload of a revisit is empty.
    """
    kind = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return archives.select("file").repartition(max(1, archives.count()), "file").mapInArrow(_read(folder), kind)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives ``pages``, normalises the archives and reads them back: a row per page, as in :func:`read`.

    A null html is an empty payload, a null url an empty one; line ends within a url are left out.
    Rows that repeat each get a record, and those with the id of a response are responses too. A null
    id is written as ``null``; it revisits the smallest id of its payload, if there is one. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    whole, normal = new_folder(spark, "warc-whole"), new_folder(spark, "warc")
    write_monolithic(with_record_types(pages, id_col, url_col, html_col), whole)
    return read(normalise(spark, whole, normal), normal)
