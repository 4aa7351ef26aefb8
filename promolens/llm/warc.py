"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged archives.

Writing. Payloads are digested by Spark; of equal payloads of at least REVISIT_BYTES the record with the largest page id is
the response and the others are revisits that refer to it. Digests are counted before they meet (map-side), and only
digests that repeat are joined back: broadcast if they are few, which is counted first, else salted, so that a payload
that makes up a third of all rows is dealt over tasks.
Records are written through Spark's text sink with the record separator CRLF CRLF as the line's end, so the
archives are plain WARC files wherever Spark can write.

The last header line, X-Header-Digest, is the SHA-1 of all header bytes before it; the block has a digest too.

Reading. ``salvage`` walks an archive, plain or of gzip members. A record counts only if its header parses and has the digest that it states, its
type is known, its length fits, the separator follows and its payload (of a response) and block have the digests that the header states. Where any record of an
archive or of a gzip member states a header digest, those without are suspect and count as damaged; so do responses without a payload digest where
others have one. Archives whose records state neither are read by the other checks alone, and a damaged name or id in them goes unnoticed. After a failed check it searches for the next
gzip member that inflates or the next version line, goes on there, and reports the bytes between as a quarantined gap.

Defined results: a null html is the empty payload; a null url leaves out WARC-Target-URI, and control or non-ASCII characters
in urls are percent-encoded; a null page id is written as ``null``, never is the largest, and never referred to; of rows that
share the largest page id each is a response; an empty table makes no archive. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import let, shared_path, table, written

#: Payloads from this size on are stored once; a repeated digest is dealt over this many join keys.
REVISIT_BYTES, SALTS = 1000, 32
#: Bytes of the payloads of a file of many records, at most; bounds of the payloads' size classes.
FILE_BYTES, CLASSES = 1 << 28, (1 << 15, 1 << 19, 1 << 23)
#: Up to this many repeated digests (some 10 MB) are broadcast, and no payload is shuffled.
BROADCAST_DIGESTS = 100_000

#: Bytes that are inflated at a time where a member fails.
STEP = 4096

VERSION, END = b"WARC/1.", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
HEADER_DIGEST = "X-Header-Digest"
TYPES = frozenset(["warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation"])


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, bytes, type, refers_to) for each page."""
    p = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    big = p.where(F.col("bytes") >= revisit_bytes)
    most = big.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    most = written(most.select("digest", "refers_to"), "digests")
    if most.count() <= BROADCAST_DIGESTS:
        p = p.join(F.broadcast(most), "digest", "left")
    else:
        most = most.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        p = p.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(most, ["digest", "salt"], "left").drop("salt")
    p = p.withColumn("type", F.when(F.col("refers_to").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to")), "response").otherwise("revisit"))
    return p.withColumn("refers_to", F.when((F.col("type") == "revisit") & (F.col("bytes") >= revisit_bytes), F.col("refers_to")))


def _uri(url):
    """Percent-encode what may not stand in a header line (bytes outside 0x21 to 0x7E), and nothing else."""
    one = lambda c: F.when(c.rlike(r"\A[\x21-\x7E]\z"), c).when(c == " ", "%20").otherwise(F.url_encode(c))
    return F.array_join(F.transform(F.split(url, ""), one), "")


def rendered(rows: DataFrame, date: str = "2000-01-01T00:00:00Z"):
    """The record's text without its end."""
    plain = F.col("url").rlike(r"\A[\x21-\x7E]*\z")
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.when(plain, F.col("url")).otherwise(_uri(F.col("url"))), F.lit("\r\n")), F.lit(""))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    revisit = F.col("type") == "revisit"
    refers = F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), name("refers_to"), F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n"))).otherwise("")
    body = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("type"), F.lit("\r\nWARC-Record-ID: <urn:page:"), name("page_id"), F.lit(f">\r\nWARC-Date: {date}\r\n"), uri, refers,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Block-Digest: sha1:"), F.when(revisit, hashlib.sha1(HTTP.encode()).hexdigest()).otherwise(F.sha1(body.cast("binary"))), F.lit("\r\nX-Payload-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n"),
    )
    return let(head, lambda h: F.concat(h, F.lit(f"{HEADER_DIGEST}: sha1:"), F.sha1(h.cast("binary")), F.lit("\r\n\r\n"), body))


def write(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the pages as plain WARC files into a folder.

    A file holds at most FILE_BYTES, headers apart, or one record: payloads are written by size classes, the larger the fewer in a file."""
    out = records(pages, revisit_bytes)
    largest = pages.agg(F.max(F.octet_length(F.col("html").cast("string")))).first()[0] or 0
    least = 0
    for most in [*[n for n in CLASSES if n <= largest], None]:
        part = out.where(F.col("bytes") >= least) if most is None else out.where((F.col("bytes") >= least) & (F.col("bytes") < most))
        top = largest + 1 if most is None else most
        part.select(rendered(part).alias("value")).write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", max(1, FILE_BYTES // top)).text(path)
        least = most


def member(record: bytes) -> bytes:
    """A record (with its end) as a gzip member of its own."""
    z = zlib.compressobj(wbits=31)
    return z.compress(record) + z.flush()


def _same(digest: bytes, stated: str) -> bool:
    """Digests are stated in hexadecimal or base32, in either case."""
    return stated.lower() == digest.hex() or stated.upper().rstrip("=") == base64.b32encode(digest).decode()


def _inflated(data: memoryview) -> tuple[bytes, int, str]:
    """What a gzip member holds, as far as it inflates, its length in the archive (0 if it has no end) and what is wrong with it."""
    z = zlib.decompressobj(wbits=31)
    try:
        raw = z.decompress(data)
        return (raw, len(data) - len(z.unused_data), "") if z.eof else (raw, 0, "member without end")
    except zlib.error as e:
        problem = f"member does not inflate: {e}"
    z, out = zlib.decompressobj(wbits=31), []
    for at in range(0, len(data), STEP):
        before = z.copy()
        try:
            out.append(z.decompress(data[at : at + STEP]))
        except zlib.error:
            for k in range(at, at + STEP):  # byte by byte up to the failure
                try:
                    out.append(before.decompress(data[k : k + 1]))
                except zlib.error:
                    break
            break
    return b"".join(out), 0, problem


def stated(data: bytes) -> tuple[bool, bool]:
    """Whether an archive's records state header digests, and payload digests; a damaged line or two doesn't change it unless there is no other record."""
    return f"\r\n{HEADER_DIGEST}: sha1:".encode() in data, b"\r\nWARC-Payload-Digest: sha1:" in data


@functools.lru_cache(1)
def stated_by_members(data: bytes) -> tuple[bool, bool]:
    """stated() of the archive's first whole gzip member: what a damaged one may have lost."""
    at = data.find(GZIP)
    while at >= 0:
        raw, size, _ = _inflated(memoryview(data)[at:])
        if size:
            return stated(raw)
        at = data.find(GZIP, at + 1)
    return False, False


def parse(data: bytes, at: int, strict: tuple[bool, bool] | None = None) -> tuple[dict, int, int, int] | str:
    """(headers, block start, block end, record end) of the record at a position, or what is wrong with it. strict: what stated() says of the archive."""
    if data[at : at + len(VERSION)] != VERSION:
        return "no version line"
    if (head := data.find(END, at)) < 0:
        return "header without end"
    lines = data[at:head].split(b"\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        key = name.strip().lower().decode("latin-1")
        # a header that is cut short and followed by another record's names them twice, or holds half a line's end
        if not colon or b"\r" in line or b"\n" in line or (key in headers and key != "warc-concurrent-to"):
            return "malformed header"
        headers[key] = value.strip().decode("latin-1")
    headers_stated, payloads_stated = strict or stated(data)
    own = headers.get(HEADER_DIGEST.lower())
    if own is None and headers_stated:
        return "no header digest"
    if own is not None and (not lines[-1].startswith(f"{HEADER_DIGEST}: sha1:".encode()) or not _same(hashlib.sha1(data[at : head - len(lines[-1])]).digest(), own[5:])):
        return "header digest differs"
    kind = headers.get("warc-type", "")
    if kind not in TYPES:
        return "unknown type"
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    start = head + 4
    end = start + int(length)
    if data[end : end + 4] != END:
        return "no separator after the block"
    payload, block = headers.get("warc-payload-digest", ""), headers.get("warc-block-digest", "")
    if kind == "response" and payloads_stated and not payload:
        return "no payload digest"
    if payload.startswith("sha1:") and kind == "response":
        split = data.find(END, start, end)
        if split < 0 or not _same(hashlib.sha1(memoryview(data)[split + 4 : end]).digest(), payload[5:]):
            return "payload digest differs"
    if block.startswith("sha1:") and not _same(hashlib.sha1(memoryview(data)[start:end]).digest(), block[5:]):
        return "block digest differs"
    return headers, start, end, end + 4


def _plain(data: bytes, base: int, strict: tuple[bool, bool]) -> Iterator[tuple]:
    at, gap, why = 0, -1, ""
    while at < len(data):
        got = parse(data, at, strict)
        if isinstance(got, str):
            if gap < 0:
                gap, why = at, got
            nxt = data.find(VERSION, at + 1)
            at = len(data) if nxt < 0 else nxt
            continue
        if gap >= 0:
            yield "gap", base + gap, at - gap, why
            gap = -1
        headers, start, end, after = got
        yield "record", base + at, after - at, headers, data[start:end]
        at = after
    if gap >= 0:
        yield "gap", base + gap, at - gap, why


def _next(data: bytes, at: int) -> int:
    """Where the nearer of the next gzip member and the next version line might begin."""
    found = [k for k in (data.find(GZIP, at), data.find(VERSION, at)) if k >= 0]
    return min(found, default=len(data))


def _digested(headers: dict) -> bool:
    """Whether digests that parse() found right cover the payload of a response or the block of another record."""
    covering = "warc-payload-digest" if headers.get("warc-type") == "response" else "warc-block-digest"
    return headers.get(covering, "").startswith("sha1:")


def _member(data: bytes, at: int) -> tuple[list[tuple], int]:
    """The records and gaps of the gzip member at a position, none if it holds no good record, and where it ends."""
    raw, size, problem = _inflated(memoryview(data)[at:])
    found = list(_plain(raw, 0, stated(raw) if size else tuple(map(max, stated(raw), stated_by_members(data)))))
    if problem.startswith("member does not inflate"):  # its bytes may be wrong before it fails, so only digests make a record good
        found = [x if x[0] == "gap" or _digested(x[3]) else ("gap", *x[1:3], problem) for x in found]
    if not size and found and found[-1][0] == "record":
        found.append(("gap", 0, 0, problem))
    if not any(x[0] == "record" for x in found):
        return [("gap", 0, 0, problem or next((x[3] for x in found), "empty member"))], at
    return found, at + size if size else _next(data, at + 1)


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', offset, length, headers, block) and ('gap', offset, length, reason), in order; every byte is in one of them.

    Plain records and gzip members may follow each other in any order. Offsets are those of the archive; a gzip member's records, and the gaps
    between them, bear the member's offset and length. A member that has no end gives the records before that, one that fails those with a good
    digest, and a gap; it reaches to the next member or version line."""
    at, gap, why, strict = 0, -1, "", stated(data)
    while at < len(data):
        if data[at : at + 3] == GZIP:
            found, end = _member(data, at)
            problem = found[0][3] if end == at else ""
            found = [("record", at, end - at, *x[3:]) if x[0] == "record" else ("gap", at, end - at, x[3]) for x in found]
        else:
            got = parse(data, at, strict)
            problem = got if isinstance(got, str) else ""
            if not problem:
                headers, start, stop, end = got
                found = [("record", at, end - at, headers, data[start:stop])]
        if problem:
            if gap < 0:
                gap, why = at, problem
            at = _next(data, at + 1)
            continue
        if gap >= 0:
            yield "gap", gap, at - gap, why
            gap = -1
        yield from found
        at = end
    if gap >= 0:
        yield "gap", gap, at - gap, why


SCHEMA = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, archive string, offset long, length long, problem string"


def _page(value: str | None) -> str | None:
    return value[len("<urn:page:") : -1] if value and value.startswith("<urn:page:") else None


def _number(value: str | None) -> int | None:
    """A header's whole number; null if it is none or beyond 64 bits."""
    return int(value) if value and value.isascii() and value.isdigit() and len(value) < 19 else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder's archives, and their quarantined gaps (record_type ``gap``, problem set)."""
    return rows(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content"))


def rows(archives: DataFrame) -> DataFrame:
    """read(), of archives (path, content)."""

    def work(batches):
        for b in batches:
            for k in range(b.num_rows):
                name, data = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                rows = []
                for x in salvage(data):
                    if x[0] == "gap":
                        rows.append((None, None, None, "gap", None, name, x[1], x[2], x[3]))
                        continue
                    _, at, length, h, block = x
                    payload = block[block.find(END) + 4 :]
                    kind = h.get("warc-type", "")
                    whole = kind == "response"
                    rows.append((_page(h.get("warc-record-id")), len(payload) if whole else _number(h.get("x-payload-length")), hashlib.sha1(payload).hexdigest() if whole else h.get("warc-payload-digest", "")[5:], kind, _page(h.get("warc-refers-to")), name, at, length, None))
                columns = list(zip(*rows, strict=True)) or [()] * 9
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], SCHEMA.replace(" long", "").replace(" string", "").split(", "))

    return archives.mapInArrow(work, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    got = read(spark, path).where("record_type <> 'gap'")
    page = lambda c: F.expr(f"try_cast({c} AS BIGINT)").alias(c)
    return got.select(page("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN top IS NOT NULL AND top IS DISTINCT FROM page_id THEN top END AS refers_to
FROM d LEFT JOIN m USING (payload_digest)
"""

def damaged(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content): a folder's archives, every record a gzip member in some, and damaged by their length: a byte flipped, a part cut out, strange bytes put in."""

    def work(batches):
        for b in batches:
            for k in range(b.num_rows):
                name, data = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                kind = zlib.crc32(data) % 3
                if kind == 1:
                    data = b"".join(member(data[x[1] : x[1] + x[2]]) for x in salvage(data))
                third = len(data) // 3
                data = data[:third] + bytes([data[third] ^ 1]) + data[third + 1 : 2 * third] + b"?" * 100 + data[2 * third + 50 :] if third else data
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], ["path", "content"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(work, "path string, content binary")


def salvage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is salvaged of archives that were damaged on purpose: records that come back, whether each is a page's own payload, and the gaps."""
    pages = table(spark, sf_dir, "pages")
    path = shared_path(spark, "warc")
    write(pages.repartition(8, "page_id"), path)
    got = written(rows(damaged(spark, path)), "salvaged")
    own = pages.select("page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("own"))
    back = got.where("record_type <> 'gap'").withColumn("page_id", F.expr("try_cast(page_id AS BIGINT)")).join(own, "page_id", "left")
    right = F.col("own").eqNullSafe(F.col("payload_digest"))
    gaps = got.where("record_type = 'gap'").groupBy(F.lit("gap").alias("record_type"), "problem").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("right"))
    return back.groupBy("record_type", F.lit(None).cast("string").alias("problem")).agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("right")).unionByName(gaps)


QUERIES, ORACLES = {"op4_warc": query, "warc_salvage": salvage_query}, {"op4_warc": ORACLE}
