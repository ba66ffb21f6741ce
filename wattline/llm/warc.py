"""WARC archives: monolithic gzip files, their normaliser, and reads by a sidecar index.

``write_monolithic`` turns rows into records and writes one gzip stream per task and file. ``normalise`` inflates each
such file once, as a stream, writes every record as a gzip member of its own and returns the offsets, which are stored
as a sidecar table. ``read_records`` reads single records by that table, in ranges that no task has to read whole
files for. Files are written under a name of their own and renamed, so repeated or lost tasks leave whole files only.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import scratch_path, settled

#: Payloads from this size on are stored once; their copies refer to it.
REVISIT_FROM = 1000
#: Bytes inflated or read at once.
STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "id bigint, uri string, kind string, refers bigint, payload_bytes bigint, digest string, file string, start bigint, bytes bigint"


def local(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all workers share, and the path on it."""
    return fs.FileSystem.from_uri(url) if "://" in url or url.startswith("file:") else (fs.LocalFileSystem(), url)


def record(kind: str, key: int | None, uri: str, payload: bytes, digest: str, size: int, refers: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but the digest and length of the one it refers to."""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", " ".join(uri.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
        ("Content-Type", "text/html"),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers}>")]
    fields.append(("Content-Length", str(len(payload))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:] if line)}


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


class Output:
    """A file that appears under its name only when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, path = local(folder)
        self.fs.create_dir(path, recursive=True)
        self.name, self.path, self.draft = name, f"{path}/{name}", f"{path}/_{uuid.uuid4().hex}"
        self.stream, self.at = self.fs.open_output_stream(self.draft, compression=None), 0

    def write(self, data: bytes) -> int:
        """Append; returns where the data begins."""
        before, self.at = self.at, self.at + len(data)
        self.stream.write(data)
        return before

    def done(self) -> None:
        self.stream.close()
        self.fs.move(self.draft, self.path)


def planned(pages: DataFrame, key: str, uri: str, body: str, least: int = REVISIT_FROM) -> DataFrame:
    """``(id, uri, body, digest, size, refers)``: of equal payloads of ``least`` bytes the one with the largest id is
    stored, the others refer to it. The largest id per digest is aggregated before the shuffle."""
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{uri}`"), F.lit("")).alias("uri"),
        F.coalesce(F.col(f"`{body}`"), F.lit("")).alias("body"),
    )
    raw = F.col("body").cast("binary")
    rows = rows.select("*", F.sha1(raw).alias("digest"), F.octet_length("body").cast("long").alias("size"))
    main = rows.filter(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max("id").alias("main"), F.count(F.lit(1)).alias("copies")
    ).filter("copies > 1 AND main IS NOT NULL").drop("copies")
    refers = F.when(~F.col("id").eqNullSafe(F.col("main")), F.col("main")).alias("refers")
    return rows.join(main, ["digest", "size"], "left").select("id", "uri", "body", "digest", "size", refers)


def write_monolithic(plan: DataFrame, folder: str) -> DataFrame:
    """Write one gzip stream per task; returns ``(file, records)``, stored."""

    def written(batches):
        from pyspark import TaskContext

        name, out, press, n = f"part-{TaskContext.get().partitionId():06d}.warc.gz", None, zlib.compressobj(6, zlib.DEFLATED, 31), 0
        for batch in batches:
            for row in batch.to_pylist():
                out = out or Output(folder, name)
                revisit = row["refers"] is not None
                payload = b"" if revisit else row["body"].encode("utf-8", "surrogatepass")
                kind = "revisit" if revisit else "response"
                out.write(press.compress(record(kind, row["id"], row["uri"], payload, row["digest"], row["size"], row["refers"])))
                n += 1
        if out is not None:
            out.write(press.flush())
            out.done()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})

    return settled(plan.mapInArrow(written, "file string, records bigint"), "archives")


def cut(held: bytearray):
    """Take the whole records off the front of ``held``."""
    while (end := held.find(b"\r\n\r\n")) >= 0:
        need = end + 4 + int(fields_of(bytes(held[:end]))["content-length"]) + 4
        if len(held) < need:
            return
        yield bytes(held[:need])
        del held[:need]


def records(stream, step: int = STEP):
    """Every record of a gzip stream (of one or many members), inflated once; about a record and a step in memory."""
    inflate, held = zlib.decompressobj(31), bytearray()
    while data := stream.read(step):
        while data:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            held += inflate.decompress(data, step)
            data = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            yield from cut(held)
    held += b"" if inflate.eof else inflate.flush()
    yield from cut(held)
    if held or not inflate.eof:
        raise ValueError("the gzip stream ends within a record")


def normalise(archives: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite each monolithic file with one member per record; returns the sidecar index, stored: file, start, bytes,
    id and kind of every record."""

    def rewritten(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = local(source)
                out = Output(folder, name)
                rows = []
                with files.open_input_file(f"{path}/{name}") as stream:
                    for whole in records(stream):
                        head = fields_of(whole[: whole.index(b"\r\n\r\n")])
                        press = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = press.compress(whole) + press.flush()
                        rows.append((name, out.write(member), len(member), page_of(head["warc-record-id"]), head["warc-type"]))
                        if len(rows) == 4096:
                            yield _index(rows)
                            rows = []
                out.done()
                if rows:
                    yield _index(rows)

    wide = archives.select("file").repartition(max(1, archives.count()), "file")
    return settled(wide.mapInArrow(rewritten, "file string, start bigint, bytes bigint, id bigint, kind string"), "index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["file", "start", "bytes", "id", "kind"])


def read_records(index: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Read the members that ``index`` names and check them: length and digest of a response are those of its bytes.

    Returns ``RECORD`` columns and, on request, the ``payload`` bytes (null for revisits).
    """

    def read(batches):
        files, path = local(folder)
        handle, name = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                out = []
                for row in whole.slice(at, 256).to_pylist():
                    if row["file"] != name:
                        if handle:
                            handle.close()
                        name, handle = row["file"], files.open_input_file(f"{path}/{row['file']}")
                    data = zlib.decompress(handle.read_at(row["bytes"], row["start"]), 31)
                    end = data.index(b"\r\n\r\n")
                    head, body = fields_of(data[:end]), data[end + 4 : -4]
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                    if head["warc-type"] == "response":
                        if (hashlib.sha1(body).hexdigest(), len(body)) != (digest, size):
                            raise ValueError(f"record of page {head['warc-record-id']} is damaged")
                    out.append(
                        (page_of(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"], page_of(head.get("warc-refers-to")),
                         size, digest, name, row["start"], row["bytes"], body if payload and head["warc-type"] == "response" else None)
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        if handle:
            handle.close()

    spec = RECORD + ", payload binary"
    names = [part.split()[0] for part in spec.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[part.split()[1]] for part in spec.split(", ")]
    out = index.select("file", "start", "bytes").sortWithinPartitions("file", "start").mapInArrow(read, spec)
    return out if payload else out.drop("payload")


def archived(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html", least: int = REVISIT_FROM) -> DataFrame:
    """Write, normalise and read back; ``RECORD`` columns, one row per row of ``pages``.

    A null body is empty. Ids must be whole numbers; a null id is kept as such. Of rows with equal payloads of ``least``
    bytes those with the largest id are responses (repeated rows of that id all are), the others revisit it; if no
    copy has an id, all are responses. An empty table writes nothing and gives no rows.
    """
    spark = pages.sparkSession
    raw, members = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    archives = write_monolithic(planned(pages, key, uri, body, least), raw)
    index = normalise(archives, raw, members)
    return read_records(index, members)


def oracle(least: int = REVISIT_FROM) -> str:
    """The rows ``archived`` must give, in SQL."""
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS main FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= {least} AND page_id < main THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= {least} AND page_id < main THEN main END AS refers_to
        FROM m"""
