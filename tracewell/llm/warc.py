"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page id; each task writes its range to files that roll over at a
compressed size, under temporary names, and commits them by renaming and listing them in its part
of the manifest. Headers and digests are made anew from url and payload, dates are a parameter,
record ids are derived from page ids: the same pages give the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import join_groups, materialize, tidy
from .stores import Staged, clear_strays, open_store, write_file

#: Fixed value: names a revisit by equal payload, as the WARC 1.1 standard has it.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def record_id(page_id, payload_digest: str, nth: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}:{nth}')}>"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id, nth: int, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record; a revisit (refers_to not None) has the payload's headers but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest(payload), nth)),
        ("WARC-Date", date),
        ("WARC-Target-URI", "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", json.dumps(page_id)),
    ]
    if revisit:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest(payload))), ("X-Refers-To-Page-Id", json.dumps(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}".encode() + CRLF for k, v in head) + CRLF + block + CRLF + CRLF


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without a time, so that the same record gives the same bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def split_records(chunks):
    """(headers, block) of each record of an archive that comes as compressed chunks, one member at a time."""
    z, out, rest = zlib.decompressobj(31), [], b""
    for chunk in chunks:
        rest = chunk
        while rest:
            out.append(z.decompress(rest))
            rest = z.unused_data
            if z.eof:
                yield parse_record(b"".join(out))
                z, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("the archive ends within a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def find_revisits(hashed: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(id, h, refers_to, n) from (id, bytes, h): how many rows of an id and digest are revisits, and of which id's response.

    Of equal payloads that with the largest id is the response; of repeated rows with that id, one.
    """
    own = hashed.where(F.col("bytes") >= min_revisit_bytes).groupBy("h", "bytes", "id").agg(F.count("*").alias("rows"))
    own, _ = materialize(own, "payload-groups")
    first = own.groupBy("h").agg(F.max("id").alias("first"), F.sum("rows").alias("all"), F.count("*").alias("ids")).where("all > 1").drop("all")
    first, _ = materialize(first, "payload-responses")
    n = F.col("rows") - F.col("id").eqNullSafe(F.col("first")).cast("int")
    # a hot payload's response goes to where its rows are
    return join_groups(own, first, "h", "ids", own.count()).select("id", "h", F.col("first").alias("refers_to"), n.alias("n")).where("n > 0")


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    roll_bytes: int = 1 << 30,
    date: str = "2020-01-01T00:00:00Z",
    shards: int | None = None,
) -> list[dict]:
    """Write a record for each row to files under path; returns the manifest: name, records, bytes, first and last id of each file.

    Payloads are the column's UTF-8; null is empty. Which rows are revisits is found over (id,
    digest) rows without payloads; then payloads shuffle once, range-sorted by id together with
    those decisions. A file ends once it holds ``roll_bytes`` compressed bytes. A null url becomes
    about:blank; null ids come first and are ids like any other, except that a group without any
    other id has responses only; repeated rows are records of their own. No rows: no files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    hashed = rows.select("id", F.octet_length("payload").cast("long").alias("bytes"), F.unhex(F.sha1(F.col("payload").cast("binary"))).alias("h"))
    revisits = find_revisits(hashed, min_revisit_bytes).where(F.col("refers_to").isNotNull())
    none = F.lit(None)
    both = revisits.select("id", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("string").alias("payload"), "h", "refers_to", "n").unionAll(
        rows.select("id", F.lit(1).alias("kind"), "url", "payload", none.cast("binary").alias("h"), none.cast(rows.schema["id"].dataType).alias("refers_to"), none.cast("long").alias("n"))
    )
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def write(batches):
        from pyspark import TaskContext

        store, at = open_store(path)
        task, number, staged, files = TaskContext.get().partitionId(), 0, None, []
        current, plan, seen = object(), {}, {}

        def close():
            nonlocal staged, number
            if staged is not None:
                staged.__exit__(None)
                staged, number = None, number + 1

        try:
            for batch in batches:
                for page_id, kind, url, payload, h, refers_to, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if page_id != current:
                        current, plan, seen = page_id, {}, {}
                    if kind == 0:
                        plan[bytes(h)] = (refers_to, n)
                        continue
                    data = payload.encode()
                    own = hashlib.sha1(data).digest()
                    nth = seen[own] = seen.get(own, -1) + 1
                    to, _ = plan.get(own, (None, 0))
                    revisit = own in plan and (to != page_id or nth > 0)
                    packed = member(make_record(page_id, nth, url, data, to if revisit else None, date))
                    if staged is None:
                        staged = Staged(store, f"{at}/part-{task:05d}-{number:05d}.warc.gz")
                        files.append({"name": staged.path.rsplit("/", 1)[1], "records": 0, "bytes": 0, "first": json.dumps(page_id), "last": None})
                    staged.__enter__().write(packed)
                    files[-1]["records"] += 1
                    files[-1]["bytes"] += len(packed)
                    files[-1]["last"] = json.dumps(page_id)
                    if files[-1]["bytes"] >= roll_bytes:
                        close()
        except BaseException as why:
            if staged is not None:
                staged.__exit__(type(why))
            raise
        close()
        if files:
            yield pa.RecordBatch.from_pylist(files, pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("first", pa.string()), ("last", pa.string())]))

    store, at = open_store(path)
    store.create_dir(at)
    ranged = both.repartitionByRange(shards, "id").sortWithinPartitions("id", "kind", "url", "payload")
    files = [r.asDict() for r in ranged.mapInArrow(tidy(write), "name string, records long, bytes long, first string, last string").collect()]
    files.sort(key=lambda f: f["name"])
    clear_strays(store, at)
    write_file(store, f"{at}/MANIFEST.json", json.dumps(files).encode())
    return files


def read_warc(spark: SparkSession, path: str, id_type: str = "long", payload: bool = False) -> DataFrame:
    """A row for each record of the files that the manifest lists: page_id, payload_bytes, payload_digest, record_type, refers_to[, url, payload].

    Digests of blocks and of responses' payloads are checked against what the files hold; a wrong
    one fails the read. The payload of a revisit is null.
    """
    store, at = open_store(path)
    with store.open_input_stream(f"{at}/MANIFEST.json") as f:
        names = [x["name"] for x in json.loads(f.read())]

    def read(batches):
        store, at = open_store(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{at}/{name}", compression=None) as f:
                    out = []
                    for headers, block in split_records(iter(lambda: f.read(1 << 20), b"")):
                        out.append(_row(headers, block, payload))
                        if len(out) == 500:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)

    ddl = f"page_id {id_type}, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}" + (", url string, payload string" if payload else "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    listed = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, min(len(names), 10_000)))
    return listed.mapInArrow(tidy(read), ddl)


def _row(headers: dict[str, str], block: bytes, payload: bool) -> dict:
    kind = headers["WARC-Type"]
    if headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"{headers['WARC-Record-ID']}: the block's digest is wrong")
    http, _, body = block.partition(CRLF + CRLF)
    told = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and told != digest(body):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload's digest is wrong")
    length = next(int(x.split(b":")[1]) for x in http.split(CRLF) if x.startswith(b"Content-Length:"))
    out = {
        "page_id": json.loads(headers["X-Page-Id"]),
        "payload_bytes": length,
        "payload_digest": told,
        "record_type": kind,
        "refers_to": json.loads(headers["X-Refers-To-Page-Id"]) if kind == "revisit" else None,
    }
    return out | ({"url": headers["WARC-Target-URI"], "payload": body.decode() if kind == "response" else None} if payload else {})
