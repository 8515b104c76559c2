"""WARC archives: writing records, segmented where they are long, and reading them back whole.

An archive is a folder of gzip files that Spark's text writer and reader handle as lines ended by an empty line, the
mark that ends every WARC record. Gzip files are not split, so a task reads each from its start; it joins the lines
again by Content-Length and holds one record at a time. Continuation records may lie in any file: segments meet
in a shuffle by origin identifier.
"""

from __future__ import annotations

from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.joins import attach

from .common import stored

_END = b"\r\n\r\n"
#: Longer blocks are cut into continuation records.
SEGMENT_BYTES = 16 << 10
#: HTTP chunks of a response body.
CHUNK_BYTES = 4 << 10
#: Records with equal payloads from this size on are revisits of one of them.
REVISIT_BYTES = 1000
RECORDS_A_FILE = 50_000
_FIELDS = {
    "type": "WARC-Type", "record_id": "WARC-Record-ID", "row": "X-Row-ID", "uri": "WARC-Target-URI", "digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To", "origin": "WARC-Segment-Origin-ID", "segment": "WARC-Segment-Number",
    "total": "WARC-Segment-Total-Length"}
RECORD = "type string, record_id string, row string, uri string, digest string, refers_to string, origin string, segment int, total long, block binary"


def record_name(key, digest: str, place: str = "") -> str:
    """The identifier of a record: its row's key and payload digest, and its place among the records where those may repeat."""
    own = "" if key is None else quote(str(key), safe="")
    return f"<urn:x-row:{own}:{digest}:{place}>" if place else f"<urn:x-row:{own}:{digest}>"


def row_named(name: Column | str) -> Column:
    """The key in a record identifier, as text."""
    name = F.col(name) if isinstance(name, str) else name
    return F.url_decode(F.regexp_extract(name, "^<urn:x-row:([^:]*):", 1))


def plan_records(pages: DataFrame, id: str = "page_id", uri: str = "url", body: str = "html",
                 least: int = REVISIT_BYTES) -> DataFrame:
    """Rows (id, uri, payload, digest, refers_to, single): each payload in UTF-8, its SHA-1, and the id of the equal payload it revisits.

    Of the rows with equal payloads of at least ``least`` bytes that with the largest id is the response; the others
    refer to it and their ``payload`` is null. Smaller payloads are all responses. A null body is an empty payload.
    Payloads count as equal if length, SHA-1 and SHA-256 are; a row that repeats the largest id is a response as well. A
    null id is no response of others: such rows get no reference. ``single``: others refer to this row, and no other row
    has its id and payload. Digests are counted and stored first; they meet the payloads by broadcast where they measure
    small, else with hot payloads spread.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(F.col(id).alias("id"), F.col(uri).alias("uri"), payload.alias("payload"))
    keys = (F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("strong"))
    copies = rows.where(F.octet_length("payload") >= least).select("id", *keys).groupBy("digest", "n", "strong", "id").agg(F.count("*").alias("k"))
    last = copies.groupBy("digest", "n", "strong").agg(F.max(F.struct("id", "k")).alias("last"), F.sum("k").alias("copies")).where("copies > 1")
    last = stored(last.select("digest", "n", "strong", F.col("last.id").alias("last"), F.col("last.k").alias("again")), "equal-payloads")
    found = attach(rows.select("id", "uri", "payload", *keys), last, ["digest", "n", "strong"], "left")
    refers = F.expr("if(id < last, last, null)")
    single = F.coalesce((F.col("id") == F.col("last")) & (F.col("again") == 1), F.lit(False))
    return found.select("id", "uri", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest", refers.alias("refers_to"), single.alias("single"))


def write_archive(records: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                  records_a_file: int = RECORDS_A_FILE) -> None:
    """Write rows as ``plan_records`` returns them as WARC records under ``folder``.

    A response's block is an HTTP message with a chunked body; one over ``segment_bytes`` becomes a first record and
    continuation records. A revisit's block is the HTTP head alone. Every record has a name of its own, whatever ids
    repeat, and carries its row's id in a field, which a null id lacks.
    """

    def run(batches):
        part, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                place = "" if row["single"] else f"{part}-{written}"
                written += 1
                out += _records(row, place, segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = records.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", _END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_a_file).text(folder)


def _records(row: dict, place: str, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    name, payload = record_name(row["id"], row["digest"], place), row["payload"]
    own = [] if row["id"] is None else [("X-Row-ID", _line(str(row["id"])))]
    common = [*own, ("WARC-Target-URI", _line(row["uri"])), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    if payload is None:
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        return [_record("revisit", name, [*common, ("WARC-Refers-To", record_name(row["refers_to"], row["digest"]))], head)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + _chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record("response", name, common, block)]
    out = [_record("response", name, [*common, ("WARC-Segment-Number", "1")], block[:segment_bytes])]
    cuts = range(segment_bytes, len(block), segment_bytes)
    for k, at in enumerate(cuts, 2):
        fields = [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(k))]
        if k == len(cuts) + 1:
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record("continuation", f"{name[:-1]}:{k}>", fields, block[at:at + segment_bytes]))
    return out


def _line(value: str | None) -> str:
    return " ".join((value or "").split())


def _record(kind: str, name: str, fields: list, block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", "1970-01-01T00:00:00Z"), *fields,
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in head).encode() + _END + block


def _chunked(payload: bytes, size: int) -> bytes:
    cuts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in cuts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is wrong."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            break
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at:at + size])
        at += size + 2
    if body[at:] != b"\r\n" and not body[at:].endswith(_END):  # trailer fields may stand between
        raise ValueError("a chunked body does not end in an empty line")
    return b"".join(out)


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, its chunks joined."""
    head, _, body = block.partition(_END)
    chunked = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return unchunked(body) if chunked else body


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive as they stand, a row each (see ``RECORD``)."""
    lines = spark.read.option("lineSep", _END.decode()).text(folder).select(F.col("value").cast("binary").alias("value"))

    def run(batches):
        head, parts, size, missing = None, [], 0, 1
        for batch in batches:
            out = []
            for line in batch.column("value").to_pylist():
                parts += [line, _END]  # the stream as it was, wherever the reader found its ends of lines
                size += len(line) + len(_END)
                while size >= missing:
                    data = b"".join(parts)
                    if head is None:  # between records: empty lines, then a head in one piece
                        data = data.lstrip(b"\r\n")
                        if data:
                            first, _, data = data.partition(_END)
                            head = _head(first)
                            missing = max(int(head["content-length"]), 1)
                    else:
                        length = int(head["content-length"])
                        out.append({k: head.get(v.lower()) for k, v in _FIELDS.items()} | {"block": data[:length]})
                        head, data, missing = None, data[length:], 1
                    parts, size = [data], len(data)
            if out:
                yield _batch(out)
        if head is not None:
            raise ValueError("an archive ends within a record")

    return lines.mapInArrow(run, RECORD)


def _head(line: bytes) -> dict[str, str]:
    version, *fields = line.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {version[:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (f.partition(":") for f in fields)}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    number = {"segment": pa.int32(), "total": pa.int64(), "block": pa.binary()}
    columns = [pa.array([r[k] if k == "block" or r[k] is None or k not in number else int(r[k]) for r in rows], number.get(k, pa.string()))
               for k in (*_FIELDS, "block")]
    return pa.RecordBatch.from_arrays(columns, names=[*_FIELDS, "block"])


def reassembled(segments: DataFrame) -> DataFrame:
    """Whole records: continuation records joined to their first one by segment number.

    Only segmented records are shuffled. A missing or doubled segment, or a total that differs from the declared one,
    is an error that names the record.
    """
    single = segments.where("segment is null").select("type", "record_id", "row", "uri", "digest", "refers_to", "block")
    parts = segments.where("segment is not null").withColumn("of", F.coalesce("origin", "record_id"))
    first = F.expr("segment = 1")
    grouped = parts.groupBy("of").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("type", "row", "uri", "digest", "refers_to")],
        F.max("total").alias("total"), F.count("*").alias("n"), F.max("segment").alias("last"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    block = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["block"]))
    joined = grouped.withColumn("block", block)
    good = F.expr("type is not null and n = last and total = octet_length(block)")
    joined = joined.withColumn("block", F.when(good, F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("segments of a record are missing: "), "of")).cast("binary")))
    return single.unionByName(joined.select("type", F.col("of").alias("record_id"), "row", "uri", "digest", "refers_to", "block"))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (type, record_id, row, uri, digest, refers_to, payload): whole records, HTTP framing taken off.

    A response's payload must agree with its digest. A revisit has no payload of its own: its ``payload`` is null.
    """
    whole = reassembled(read_segments(spark, folder))

    def run(batches):
        for batch in batches:
            kinds = batch.column("type").to_pylist()
            payloads = [payload_of(b) if k == "response" else None for k, b in zip(kinds, batch.column("block").to_pylist(), strict=True)]
            names = ["type", "record_id", "row", "uri", "digest", "refers_to"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(payloads, pa.binary())], names=[*names, "payload"])

    read = whole.mapInArrow(run, "type string, record_id string, row string, uri string, digest string, refers_to string, payload binary")
    wrong = F.expr("type = 'response' and digest != concat('sha1:', sha1(payload))")
    return read.withColumn("payload", F.when(wrong, F.raise_error(F.concat(F.lit("wrong digest: "), "record_id")).cast("binary")).otherwise(F.col("payload")))
