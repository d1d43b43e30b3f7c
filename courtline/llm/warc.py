"""WARC archives: captures written as transactions, and transactions assembled from records.

A capture is a request, a response (or a revisit, where an equal payload has a
response already) and a metadata record, tied by WARC-Concurrent-To.  Archives
are written by Spark's text sink with the record terminator as its line
separator, so task retries, commits and any file system are Spark's.  They are
read by record lengths alone.  Assembly needs no order and no archive in
common: records whose concurrent-to identifiers connect them are one capture.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm.common import discard, stored
from courtline.llm.components import components

ARCHIVE_BYTES = 16 << 20
MOST_BROADCAST_REVISITS = 500_000
# Payloads with more copies than this share of all rows are at most as many as its inverse: they are broadcast.
HOT_SHARE = 1 / 1024
# Fixed values of the WARC format.
_HEAD = "WARC/1.1\r\n"
_END = "\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# The part of a capture that a record type is; other types (warcinfo, conversion, continuation) are no part.
PARTS = {"request": "request", "response": "response", "revisit": "response", "resource": "response", "metadata": "metadata"}

RECORD = ("row long, record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
          "date string, content_type string, payload_digest string, http_header string, payload binary, payload_bytes long")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a binary's SHA-1: four digits for each five of its hexadecimal ones."""
    h = F.sha1(data)
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _with_first(rows: DataFrame) -> DataFrame:
    """(row, first_row, first_key) of the rows whose payload an earlier row has; the earliest has the smallest key, nulls last."""
    earliest = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row"))
    firsts = rows.groupBy("same").agg(earliest.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select("same", F.col("first.row").alias("first_row"), F.col("first.key").alias("first_key"), "n")
    firsts = stored(firsts, "warc-firsts")
    least = max(1.0, rows.count() * HOT_SHARE)
    hot, others = firsts.filter(F.col("n") > least), firsts.filter(F.col("n") <= least)
    thin = rows.select("row", "same")
    met = thin.join(F.broadcast(hot), "same").unionByName(
        thin.join(F.broadcast(hot.select("same")), "same", "left_anti").join(others, "same"))
    return met.filter("row != first_row").select("row", "first_row", "first_key")


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, record_id: Column, block: Column, *lines: Column) -> Column:
    head = F.concat(F.lit(_HEAD + "WARC-Type: "), kind, F.lit("\r\n"), _line("WARC-Record-ID", record_id), *lines,
                    _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return F.concat(head.cast("binary"), block)


def write_warc(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", html: str = "html",
               least_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, gzip: bool = True, date: datetime | None = None) -> None:
    """Archives, gzip by file, of about ``archive_bytes`` before it, with a request, a response or revisit, and a metadata record per row of ``pages``.

    The payload is the UTF-8 of ``html``, null as empty.  Of rows with equal
    payloads of ``least_revisit_bytes`` or more, the one with the smallest key
    (nulls last; of equal keys any one) is the response that the others revisit;
    smaller payloads are responses each.  Every row, repeated ones included, is
    a capture of its own; a null key or address has no line in its records.
    The metadata record names the keys of the page and of the page it revisits.
    Other columns are not read; an empty table writes no record.  Payloads are
    compared by SHA-256.  The revisits' rows, 24 bytes and a key each, are
    counted and broadcast up to ``MOST_BROADCAST_REVISITS``, so that no payload
    is shuffled; beyond, payloads are shuffled once to meet them.
    """
    run, moment = uuid.uuid4().hex, (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    src = stored(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.regexp_replace(F.regexp_replace(F.col(url).cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("payload"), F.octet_length(body).alias("n"), base32_sha1(body).alias("digest"),
        F.unhex(F.sha2(body, 256)).alias("same")), "warc-pages", compression="zstd")
    pages_, total = src.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    again = stored(_with_first(src.filter(F.col("n") >= least_revisit_bytes).select("row", "key", "same")), "warc-again")
    if again.count() <= MOST_BROADCAST_REVISITS:
        full = src.join(F.broadcast(again), "row", "left")
    else:
        full = src.repartition(max(1, -(-total // archive_bytes)), "row").join(again, "row", "left")
    # Three records a page, and a header's worth beside each payload.
    per_archive = max(3, 3 * archive_bytes * pages_ // (total + 1000 * pages_ + 1))

    def urn(row: Column, kind: str) -> Column:
        h = F.md5(F.concat(F.lit(run + kind), row.cast("string")))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))

    def text(c: str) -> Column:
        return F.url_encode(F.col(c).cast("string"))

    row, revisit = F.col("row"), F.col("first_row").isNotNull()
    common = [_line("WARC-Date", F.lit(moment)), _line("WARC-Target-URI", F.col("url"))]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit(_END)).cast("binary")
    asked = F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(" HTTP/1.1" + _END)).cast("binary")
    fields = F.concat(_line("page-id", text("key")), _line("revisits-page-id", text("first_key"))).cast("binary")
    records = F.array(
        _record(F.lit("request"), urn(row, "request"), asked, *common, _line("WARC-Concurrent-To", urn(row, "response")),
                _line("Content-Type", F.lit("application/http; msgtype=request"))),
        _record(F.when(revisit, "revisit").otherwise("response"), urn(row, "response"),
                F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))), *common,
                _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                _line("WARC-Profile", F.when(revisit, _REVISIT)), _line("WARC-Refers-To", urn(F.col("first_row"), "response")),
                _line("Content-Type", F.lit("application/http; msgtype=response"))),
        _record(F.lit("metadata"), urn(row, "metadata"), fields, *common, _line("WARC-Concurrent-To", urn(row, "response")),
                _line("Content-Type", F.lit("application/warc-fields"))),
    )
    # A string column may hold any bytes; the text sink writes them as they are.
    full.select(F.explode(records).alias("r")).select(F.col("r").cast("string").alias("value")) \
        .write.option("lineSep", _END).option("maxRecordsPerFile", per_archive).text(path, compression="gzip" if gzip else "none")
    discard(src)


def _plain(data: bytes) -> bytes:
    """An archive without gzip, whose members may be one per record."""
    out, at = [], 0
    view = memoryview(data)
    while at < len(data) and view[at:at + 2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out.append(d.decompress(view[at:]) + d.flush())
        if not d.eof:
            raise ValueError("gzip member without end")
        at = len(data) - len(d.unused_data)
    return b"".join(out) if at else data


def records_of(data: bytes) -> Iterator[dict]:
    """The records of one archive, cut by their lengths; ValueError with the offset where it is no archive."""
    data, at = _plain(data), 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        named: dict[str, list[str]] = {}
        name = ""
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and name:
                named[name][-1] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            name = name.strip().lower()
            named.setdefault(name, []).append(value.strip())
        length = named.get("content-length", [""])[0]
        start = end + 4
        if not length.isdecimal() or start + int(length) > len(data):
            raise ValueError(f"WARC record at byte {at} without its whole block")
        stop = start + int(length)
        block, header = data[start:stop], None
        kind, content = named.get("warc-type", [""])[0].lower(), named.get("content-type", [None])[0]
        if content and content.lower().startswith("application/http"):
            cut = block.find(b"\r\n\r\n")
            cut = len(block) if cut < 0 else cut + 4
            header, block = block[:cut].decode("utf-8", "replace"), block[cut:]
        digest = named.get("warc-payload-digest", [None])[0]
        yield {"record_id": named.get("warc-record-id", [None])[0], "type": kind,
               "concurrent_to": named.get("warc-concurrent-to", []), "refers_to": named.get("warc-refers-to", [None])[0],
               "target_uri": named.get("warc-target-uri", [None])[0], "date": named.get("warc-date", [None])[0],
               "content_type": content, "payload_digest": digest.partition(":")[2] if digest else None,
               "http_header": header, "payload": None if kind == "revisit" else block}
        at = stop
        while data.startswith(b"\r\n", at):
            at += 2


_ARROW = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
                    ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("content_type", pa.string()),
                    ("payload_digest", pa.string()), ("http_header", pa.string()), ("payload", pa.binary()),
                    ("payload_bytes", pa.int64())])
_BATCH_BYTES = 8 << 20


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, gzip or not, by ``RECORD``, stored once.

    ``payload`` is the block, for ``application/http`` without the HTTP header;
    a revisit has none, its ``payload_bytes`` and ``payload_digest`` are those its
    headers state.  Other digests are computed from the payload.  A record
    without an id is named after its row.  A file that is no archive ends the
    job.  Each file is read whole by one task: archives have to fit in a
    task's memory, as those of :func:`write_warc` do.
    """
    def parse(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            rows: list[dict] = []
            size = 0
            for i in range(f.num_rows):
                for r in records_of(f.column(0)[i].as_py()):
                    if r["payload"] is not None:
                        r["payload_bytes"] = len(r["payload"])
                        r["payload_digest"] = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                    rows.append(r)
                    size += r.get("payload_bytes", 0) + 500
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    columns = RECORD.replace("row long, ", "")
    parsed = files.mapInArrow(parse, columns).withColumn("row", F.monotonically_increasing_id())
    stated = F.regexp_extract("http_header", r"(?i)\r\nContent-Length:[ \t]*([0-9]+)", 1)
    return stored(parsed.withColumn("stated", stated).selectExpr(
        "row", "coalesce(record_id, concat('row:', row)) AS record_id",
        *[c for c in parsed.columns if c not in ("row", "record_id", "payload_bytes")],
        "coalesce(payload_bytes, try_cast(nullif(stated, '') AS long)) AS payload_bytes"), "warc-records", compression="zstd")


def _capture_of(nodes: DataFrame) -> DataFrame:
    """(record_id, capture) of all records that name another or are named by one, as far as they are here or not.

    A record that names one other and is named by none is in that one's
    capture.  These leaves, as a rule all there is, are set aside; the
    components of the links between the others are found in rounds.
    """
    links = stored(nodes.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b")).filter("a != b").distinct(),
                   "warc-links")
    named = links.select(F.col("b").alias("a"), F.lit(1).alias("named")).distinct()
    ends = links.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b")).join(named, "a", "left")
    leaf = F.col("named").isNull() & (F.col("n") == 1)
    leaves = ends.filter(leaf).select(F.col("a").alias("leaf"), "b")
    inner = stored(ends.filter(~leaf).select("a").join(links, "a"), "warc-inner-links")
    roots = stored(components(inner), "warc-roots")
    by_leaf = leaves.join(roots.withColumnRenamed("node", "b"), "b", "left") \
        .select(F.col("leaf").alias("record_id"), F.coalesce("root", "b").alias("capture"))
    return by_leaf.unionByName(roots.select(F.col("node").alias("record_id"), F.col("root").alias("capture")))


def _captures(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, capture, record_id, part) of every part of a capture, and per capture the chosen row of each part."""
    part = F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair])[F.col("type")]
    nodes = records.select("row", "record_id", "concurrent_to", part.alias("part")).filter("part IS NOT NULL")
    # Records with one id are one record: the first row counts.
    single = nodes.groupBy("record_id", "part").agg(F.min("row").alias("row"))
    parts = stored(single.join(_capture_of(nodes), "record_id", "left").select(
        "row", F.coalesce("capture", "record_id").alias("capture"), "record_id", "part"), "warc-parts")
    least = [F.min(F.when(F.col("part") == p, F.struct("record_id", "row")))["row"].alias(f"{p}_row") for p in ("request", "response", "metadata")]
    sizes = [F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("request", "response", "metadata")]
    return parts, parts.groupBy("capture").agg(*least, *sizes)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture of the rows of :func:`read_warc`: ``capture, request, response, metadata, n_request, n_response, n_metadata``.

    Records belong to one capture where concurrent-to identifiers, of either
    side and over any number of steps, connect them; a record without such ties
    is a capture of its own.  Each part is a struct of the record with the
    smallest id, null where the capture has none, and ``n_*`` count the records
    of that part; :func:`further_records` gives the rest, so that no capture is
    gathered in one task whatever refers to it.  Identifiers of records that
    are not there connect too.  Records with one id count once.  Types that
    are no part of a capture are left out.  No records give no rows.
    """
    _, chosen = _captures(records)
    out = chosen
    for p, types in (("request", ["request"]), ("response", ["response", "revisit", "resource"]), ("metadata", ["metadata"])):
        some = records.filter(F.col("type").isin(types)).select(
            F.col("row").alias(f"{p}_row"), F.struct(*[c for c in records.columns if c != "row"]).alias(p))
        out = out.join(some, f"{p}_row", "left")
    return out.select("capture", "request", "response", "metadata", "n_request", "n_response", "n_metadata")


def further_records(records: DataFrame) -> DataFrame:
    """(capture, and the columns of a record) of the parts that :func:`captures` only counts."""
    parts, chosen = _captures(records)
    first = chosen.select(F.explode(F.array("request_row", "response_row", "metadata_row")).alias("row")).dropna()
    return parts.join(first, "row", "left_anti").select("row", "capture").join(records, "row").drop("row")


def page_captures(nested: DataFrame, *, key: str = "page_id", key_type: str = "long") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of captures that :func:`write_warc` wrote."""
    fields = F.concat(F.lit("\r\n"), F.col("metadata.payload").cast("string"))

    def field(name: str) -> Column:
        got = F.regexp_extract(fields, f"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(fields.contains(f"\r\n{name}: "), F.url_decode(got)).cast(key_type)

    return nested.select(
        field("page-id").alias(key), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        field("revisits-page-id").alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id, sha1(body) AS h FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
           1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)),
           lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
