"""WARC archives: captures written as transactions, read back and assembled.

A capture is up to three records: a response (or a revisit where an equal payload is archived
already), its request and its metadata; the latter two name the first in WARC-Concurrent-To. Spark's
text sink writes the records: one row is one record, and its line separator is the two CRLFs that end a
record. The reader follows Content-Length through files (plain or gzip, one member a record
or not), so payloads may hold anything; it inflates a record at a time. Assembly joins the records of a capture on the response's id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.held import lean
from loomtext.llm.staging import delete, join_counted, new_path, scope, stage

CRLF = "\r\n"
#: How a gzip member begins.
GZIP = b"\x1f\x8b\x08"
#: Payloads below this many bytes are always archived whole.
REVISIT_BYTES = 100
#: Bytes of an archive file, before compression, that the writer aims at; the reader holds one file at a time.
FILE_BYTES = 32_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "2024-01-01T00:00:00Z"


def captures(pages: DataFrame, date: str = EPOCH) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): payload, its digest and size, record_type and refers_to.

    Of rows with equal payloads of at least REVISIT_BYTES the smallest page_id (of rows that repeat it,
    one) is the response and others revisit it. Payloads are staged once, here. A null html is an empty payload; a null url an empty target.
    Long payloads stay whole, rows that repeat are captures of their own, an empty table gives no capture, and
    columns other than these three, whatever their names, are not read.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = stage(rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("capture_date", F.lit(date)), "captures")
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row"))
    groups = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(first.alias("first"), F.count("*").alias("n"))
    groups = stage(groups.filter("n > 1"), "equal-payloads")
    light = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).select("row", "payload_digest")
    revisits = join_counted(light, groups, "payload_digest", "n").filter("row <> first.row").select("row", F.col("first.page_id").alias("refers_to"), F.col("first.row").alias("first_row"))
    return rows.join(revisits, "row", "left").withColumn("record_type", F.when(F.col("first_row").isNull(), "response").otherwise("revisit"))


def _record_id(kind: str, row: str) -> str:
    """A UUID-shaped id that is a digest of the record's kind, the page and its row."""
    return (
        f"regexp_replace(substr(sha2(concat_ws('|', '{kind}', cast({row} as string)), 256), 1, 32), "
        "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', 'urn:uuid:$1-$2-$3-$4-$5')"
    )


def records(caps: DataFrame) -> DataFrame:
    """(value): three records per capture as text, without the final CRLFs."""
    line = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x], F.lit(CRLF))
    main, url = F.expr(_record_id("main", "row")), F.col("url")
    clean = F.regexp_replace(url, r"[\r\n]", " ")
    head = lambda kind, rid: [F.lit("WARC/1.1" + CRLF), line("WARC-Type: ", kind), line("WARC-Record-ID: <", rid, ">"), line("WARC-Date: ", F.col("capture_date")), line("WARC-Target-URI: ", clean)]
    http = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF)
    new = F.col("record_type") == "response"
    body = F.when(new, F.concat(http, F.col("payload"))).otherwise(http)
    response = F.concat(
        *head(F.col("record_type"), main),
        line("WARC-Payload-Digest: sha256:", F.col("payload_digest")),
        F.when(new, F.lit("")).otherwise(F.concat(line("WARC-Refers-To: <", F.expr(_record_id("main", "coalesce(first_row, row)")), ">"), line("WARC-Profile: " + PROFILE))),
        line("Content-Type: application/http; msgtype=response"),
        line("Content-Length: ", F.octet_length(body).cast("string")), F.lit(CRLF), body,
    )
    path = F.when(F.regexp_extract(clean, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1) == "", "/").otherwise(F.regexp_extract(clean, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1))
    ask = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1" + CRLF + "Host: "), F.regexp_extract(clean, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), F.lit(CRLF + CRLF))
    request = F.concat(
        *head(F.lit("request"), F.expr(_record_id("request", "row"))), line("WARC-Concurrent-To: <", main, ">"),
        line("Content-Type: application/http; msgtype=request"), line("Content-Length: ", F.octet_length(ask).cast("string")), F.lit(CRLF), ask,
    )
    null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    facts = F.concat(line("page-id: ", null("page_id")), line("payload-bytes: ", null("payload_bytes")))
    metadata = F.concat(
        *head(F.lit("metadata"), F.expr(_record_id("metadata", "row"))), line("WARC-Concurrent-To: <", main, ">"),
        line("Content-Type: application/warc-fields"), line("Content-Length: ", F.octet_length(facts).cast("string")), F.lit(CRLF), facts,
    )
    return caps.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(caps: DataFrame, path: str) -> None:
    """Writes the captures' records under ``path``, gzipped, as many to a file as make about FILE_BYTES on average."""
    total = caps.agg(F.count("*").alias("n"), F.sum("payload_bytes").alias("bytes")).first()
    per_capture = ((total.bytes or 0) / total.n if total.n else 0) + 2000
    out = records(caps).write.option("lineSep", CRLF * 2).option("compression", "gzip")
    out.option("maxRecordsPerFile", 3 * max(1, int(FILE_BYTES / per_capture))).text(path)


def inflated(raw: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, piece by piece, in time linear in its size.

    What isn't a member (padding, junk) is skipped up to the next member's signature; a damaged member gives what can be read of it.
    """
    view, at = memoryview(raw), raw.find(GZIP)
    while at >= 0:
        d, begin = zlib.decompressobj(31), at
        try:
            while not d.eof and at < len(raw):
                fed = view[at : at + step]
                at += len(fed)
                out = d.decompress(fed)
                if out:
                    yield out
            at -= len(d.unused_data)  # at most one step, whatever follows
        except zlib.error:
            at = begin + 1
        at = raw.find(GZIP, at)


def parse(raw: bytes, step: int = 1 << 20) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers by lower-case name, content block) of each record; what is not a record is skipped to the next version line. One record
    is held at a time, besides the file as it is."""
    pieces = inflated(raw) if raw[:3] == GZIP else (raw[k : k + step] for k in range(0, len(raw), step))
    held, more = bytearray(), True

    def fill() -> bool:
        nonlocal more
        piece = next(pieces, None)
        more = piece is not None
        held.extend(piece or b"")
        return more

    def find(what: bytes, since: int) -> int:
        """Where ``what`` begins, reading on as far as it takes; each byte is looked at once."""
        while (at := held.find(what, since)) < 0:
            since = max(since, len(held) - len(what) + 1)
            if not fill():
                return -1
        return at

    while True:
        at = find(b"WARC/", 0)
        if at < 0:
            return
        del held[:at]
        end = find(b"\r\n\r\n", 0)
        if end < 0:
            return
        lines = re.sub(rb"\r\n[ \t]+", b" ", bytes(held[:end])).split(b"\r\n")[1:]
        headers: dict[str, list[str]] = {}
        for line in lines:
            name, _, value = line.partition(b":")
            headers.setdefault(name.strip().decode("utf-8", "replace").lower(), []).append(value.strip().decode("utf-8", "replace"))
        size = headers.get("content-length", [""])[0]
        if not (size.isascii() and size.isdigit()):
            del held[:5]
            continue
        stop = end + 4 + int(size)
        while len(held) < stop and fill():
            pass
        yield headers, bytes(held[end + 4 : stop])
        del held[:stop]


RECORD = "record_id string, type string, date string, uri string, concurrent_to array<string>, refers_to string, digest string, content_type string, http_head string, payload binary, truncated boolean"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``. For HTTP records payload is what follows the
    HTTP head. A record cut short by the file's end is marked truncated, one that damage cuts holds what could be read before it; padding
    and junk between members or records are skipped. Non-archives and empty files give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()), ("uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("digest", pa.string()), ("content_type", pa.string()), ("http_head", pa.string()), ("payload", pa.binary()), ("truncated", pa.bool_())])
        for b in batches:
            for raw in b.column(0):
                rows, held = [], 0
                for h, block in parse(memoryview(raw.as_buffer()).tobytes()):
                    get = lambda k: h.get(k, [None])[0]  # noqa: B023, E731
                    bare = lambda x: x and x.strip("<> ")
                    kind, head, payload = get("content-type") or "", None, block
                    if kind.startswith("application/http"):
                        a, sep, rest = block.partition(b"\r\n\r\n")
                        if sep:
                            head, payload = a.decode("utf-8", "replace"), rest
                    rows.append((bare(get("warc-record-id")), get("warc-type"), get("warc-date"), get("warc-target-uri"), [bare(x) for x in h.get("warc-concurrent-to", [])], bare(get("warc-refers-to")), get("warc-payload-digest"), get("content-type"), head, payload, len(block) < int(get("content-length"))))
                    held += len(block)
                    if held > 8_000_000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(lean(run), RECORD)


def transactions(recs: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: record_id, type, date, uri, refers_to, digest, response, request, metadata.

    A capture is a response, revisit or resource record. A request or metadata record belongs to the
    captures it names in its concurrent-to ids; of several of a kind the one with the smallest id is
    taken. Records that name no capture are left out; records that repeat an id are one. The archives
    are parsed once and shuffled once, by the capture's id. The response tells its payload's size and
    SHA-256; with ``payloads`` False it leaves the payload itself out, and the shuffle carries none.
    """
    main = F.col("type").isin("response", "revisit", "resource")
    key = F.when(main, F.array("record_id")).when(F.col("type").isin("request", "metadata"), F.array_distinct("concurrent_to"))
    keyed = recs.withColumn("key", F.explode(key))
    told = [F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256")]
    body = F.col("payload") if payloads else F.lit(None).cast("binary").alias("payload")
    whole = F.struct("type", "date", "uri", "refers_to", "digest", F.struct("http_head", "content_type", body, *told, "truncated").alias("response"))
    aside = F.struct("record_id", "http_head", "payload")
    one = lambda value, kind: F.min_by(value, F.when(kind, F.col("record_id")))
    keyed = keyed.select("key", "record_id", "type", F.when(main, whole).alias("whole"), F.when(~main, aside).alias("aside"))
    out = keyed.groupBy("key").agg(
        one("whole", F.col("whole").isNotNull()).alias("m"), one("aside", F.col("type") == "request").alias("request"), one("aside", F.col("type") == "metadata").alias("metadata"), F.max(F.col("whole").isNotNull()).alias("found")
    )
    return out.filter("found").select(F.col("key").alias("record_id"), "m.*", "request", "metadata")


def field(block: str, name: str):
    """A field of a warc-fields block as a string column, null if absent or empty."""
    found = F.regexp_extract(F.decode(F.col(block), "UTF-8"), rf"(?m)^{re.escape(name)}: ?(.*?)\r?$", 1)
    return F.when(found != "", found)


def archived(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``, as read back from archives.

    refers_to is the page of the record that a revisit's WARC-Refers-To names, null if the archives hold none. Nulls, long
    payloads, repeats, empty tables and clashing names: as in ``captures``.
    """
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    with scope() as made:
        write_archives(captures(pages), path)
    delete(spark, made.paths)  # the archives hold all that is read from here on
    caps = transactions(read_archives(spark, path), payloads=False)
    kind = pages.schema["page_id"].dataType.simpleString()
    new = F.col("type") == "response"
    light = caps.select(
        "record_id",
        F.col("refers_to").alias("ref"),
        field("metadata.payload", "page-id").cast(kind).alias("page_id"),
        F.when(new, F.col("response.payload_bytes")).otherwise(field("metadata.payload", "payload-bytes").cast("long")).alias("payload_bytes"),
        F.when(new, F.col("response.payload_sha256")).otherwise(F.regexp_replace("digest", "^sha256:", "")).alias("payload_digest"),
        F.col("type").alias("record_type"),
    )
    return with_referred_pages(stage(light, "captured"))


def with_referred_pages(light: DataFrame) -> DataFrame:
    """``light`` (record_id, ref, page_id, …, record_type; staged) with refers_to, the page of the response whose record id
    ``ref`` is, in place of record_id and ref."""
    columns = [c for c in light.columns if c not in ("record_id", "ref")]
    revisits = light.filter("record_type = 'revisit'")
    asked = revisits.groupBy("ref").agg(F.count("*").alias("n"))
    targets = light.filter("record_type <> 'revisit'").select(F.col("record_id").alias("ref"), F.col("page_id").alias("refers_to"))
    told = stage(targets.join(asked, "ref"), "referred")
    none = F.lit(None).cast(light.schema["page_id"].dataType).alias("refers_to")
    found = join_counted(revisits, told, "ref", "n").select(*columns, "refers_to")
    lost = revisits.join(told.select("ref"), "ref", "left_anti").select(*columns, none)
    return light.filter("record_type <> 'revisit'").select(*columns, none).unionByName(found).unionByName(lost)
