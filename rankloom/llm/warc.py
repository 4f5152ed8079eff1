"""WARC archives: writing, normalising to one gzip member per record, reading by offset.

Pages become WARC records as text columns, and Spark's text writer with gzip makes
archives of them that are one gzip stream each. The normaliser inflates each stream
once, a piece at a time, cuts it into records, writes every record as a gzip
member of its own and puts a sidecar beside the archive: offset, length and record id of
every member. Reading fetches members by these offsets. Archives are written under
another name and moved when they are complete, so a task that runs again leaves no
half archive.

Of pages with equal payloads the one with the largest id is a response and the others
are revisits that refer to it; a payload below ``least_bytes`` is always a response. A
revisit holds the HTTP head with the length of the payload, not the payload. Null html
is the empty payload, a null url is left out, a null id is the least. Of rows that
repeat an id and payload one is the response. An empty table gives no records. Further
columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.llm.common import query, table
from rankloom.session import cut_lineage, scratch_path

PIECE = 1 << 20
SALTS = 16
#: The base32 alphabet, the revisit profile.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:rankloom:page:{}>"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(value: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's bytes."""
    hexed = F.sha1(value.cast("binary"))
    letters = []
    for group in range(4):
        bits = F.conv(F.substring(hexed, 10 * group + 1, 10), 16, 10).cast("bigint")
        letters += [F.substr(F.lit(BASE32), (F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for s in range(35, -1, -5)]
    return F.concat(*letters)


def with_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) with digest, record_type and refers_to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"))
    known = pages.filter(F.octet_length("html") >= least_bytes).select("page_id", base32_sha1(F.col("html")).alias("digest"))
    copies = cut_lineage(known.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n")))
    shared = copies.groupBy("digest").agg(F.sum("n").alias("rows"), F.max("page_id").alias("top")).filter("rows > 1").drop("rows")
    shared = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = pages.withColumn("digest", base32_sha1(F.col("html"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(cut_lineage(shared), ["digest", "salt"], "left")
    first = F.lit(True)
    if not copies.filter("n > 1").isEmpty():
        joined = joined.withColumn("_nth", F.row_number().over(Window.partitionBy("digest", "salt", "page_id").orderBy("url")))
        first = F.col("_nth") == 1
    # Without a shared payload ``top`` is null, and so is it where all ids are.
    alone = F.octet_length("html") < least_bytes
    response = alone | (F.col("page_id").eqNullSafe(F.coalesce("top", "page_id")) & first)
    return joined.select("page_id", "url", "html", "digest", F.when(response, "response").otherwise("revisit").alias("record_type"), F.when(~response, F.coalesce("top", "page_id")).alias("refers_to"))


def records(typed: DataFrame) -> DataFrame:
    """One text column: the WARC record of each page."""
    n, crlf = F.octet_length("html"), "\r\n"
    id_of = lambda c: F.concat(F.lit(RECORD_ID.split("{}")[0]), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(RECORD_ID.split("{}")[1]))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), n.cast("string"), F.lit(crlf * 2))
    block = F.when(F.col("record_type") == "response", F.concat(head, "html")).otherwise(head)
    url = F.regexp_replace("url", "[\r\n]+", " ")
    lines = [
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), id_of("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit(f"WARC-Profile: {PROFILE}{crlf}WARC-Refers-To: "), id_of("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    made = typed.withColumn("block", block)
    return made.select(F.concat(F.lit(f"WARC/1.1{crlf}"), F.concat_ws(crlf, *lines), F.lit(crlf * 2), "block", F.lit(crlf * 2)).alias("record"))


def write_archives(typed: DataFrame, path: str) -> None:
    """Archives of one gzip stream each. The writer itself ends a record's last line."""
    made = records(typed)
    made.select(F.expr("substring(record, 1, length(record) - 1)").alias("record")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def inflated(stream) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members."""
    engine, rest = zlib.decompressobj(31), b""
    while True:
        piece = rest or stream.read(PIECE)
        if not piece:
            return
        yield engine.decompress(piece)
        rest = b""
        if engine.eof:
            rest = engine.unused_data
            engine = zlib.decompressobj(31)


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records; no more than one and a piece is held at a time."""
    held = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        for p in pieces:
            held.extend(p)
            return True
        return False

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if bytes(held).strip():
                    raise ValueError("an archive ends inside a record head")
                return
        length = int(headers_of(bytes(held[:end]))["content-length"])
        size = end + 4 + length + 4
        while len(held) < size:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield bytes(held[:size])
        del held[:size]


def headers_of(head: bytes) -> dict[str, str]:
    fields = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}


#: Endings that a normalised archive's name is freed from; other dots belong to the name.
ENDINGS = r"(\.warc|\.txt)?\.gz$"


def _normalise(out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _open(uri)
                to, folder = _open(out)
                name = re.sub(ENDINGS, "", posixpath.basename(path)) + ".warc.gz"
                draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
                offset, ids, offsets, lengths = 0, [], [], []
                with fs.open_input_stream(path, compression=None) as stream, to.open_output_stream(draft, compression=None) as sink:
                    for record in split_records(inflated(stream)):
                        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = engine.compress(record) + engine.flush()
                        sink.write(member)
                        ids.append(headers_of(record[: record.find(b"\r\n\r\n")]).get("warc-record-id", ""))
                        offsets.append(offset)
                        lengths.append(len(member))
                        offset += len(member)
                with to.open_output_stream(f"{draft}.idx", compression=None) as sink:
                    sink.write("".join(f"{a}\t{b}\t{i}\n" for a, b, i in zip(offsets, lengths, ids)).encode())
                to.move(f"{draft}.idx", f"{folder}/{name}.idx")
                to.move(draft, f"{folder}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.string())], ["archive", "offset", "length", "record_id"])

    return run


def files_in(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths of a folder's files; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")


def normalise(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Rewrite the archives of ``path`` into ``out``; returns the offset index as a written table.

    Two archives that would get one name are refused before any is written.
    """
    files = files_in(spark, path, "*.gz")
    names = files.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), ENDINGS, "").alias("name"))
    clash = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if clash is not None:
        raise ValueError(f"{clash['n']} archives would be named {clash['name']}.warc.gz")
    to, folder = _open(out)
    to.create_dir(folder, recursive=True)
    return cut_lineage(files.mapInArrow(_normalise(out), "archive string, offset bigint, length bigint, record_id string"))


def _read(id_cast: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _open(uri)
                with fs.open_input_stream(f"{path}.idx", compression=None) as stream:
                    index = [line.split("\t") for line in stream.read().decode().splitlines()]
                with fs.open_input_file(path) as archive:
                    for at in range(0, len(index), 500):
                        rows = [_parsed(archive.read_at(int(n), int(o)), with_payload) for o, n, _ in index[at : at + 500]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ_TYPES)], _READ_NAMES)

    return run


_READ_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
_READ_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]


def _parsed(member: bytes, with_payload: bool) -> tuple:
    record = zlib.decompress(member, 31)
    end = record.find(b"\r\n\r\n")
    head = headers_of(record[:end])
    block = record[end + 4 : end + 4 + int(head["content-length"])]
    http = block.find(b"\r\n\r\n")
    n = int(headers_of(block[:http])["content-length"])
    payload, digest = block[http + 4 :], head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {head['warc-record-id']} does not fit its digest")
    prefix, suffix = RECORD_ID.split("{}")
    number = lambda v: None if v is None or (v := v.removeprefix(prefix).removesuffix(suffix)) == "null" else v
    return number(head["warc-record-id"]), head.get("warc-target-uri"), n, digest, head["warc-type"], number(head.get("warc-refers-to")), payload if with_payload else None


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """Records of normalised archives, member by member; digests of responses are verified."""
    rows = files_in(spark, path, "*.warc.gz").mapInArrow(_read(id_type, with_payload), "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary")
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, least_bytes: int = 0, with_payload: bool = True) -> DataFrame:
    """Write, normalise and read the pages again; raw archives are removed once rewritten."""
    spark = pages.sparkSession
    raw, out = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    write_archives(with_types(pages, least_bytes), raw)
    index = normalise(spark, raw, out)
    folder = spark._jvm.org.apache.hadoop.fs.Path(raw)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    kind = pages.schema["page_id"].dataType.simpleString()
    if index.isEmpty():
        return spark.createDataFrame([], f"page_id {kind}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, payload binary")
    return read_archives(spark, out, kind, with_payload)


@query(
    "op4_warc",
    """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS x, max(page_id) OVER (PARTITION BY b) AS top FROM p),
bits AS (SELECT page_id, n, top, list_transform(range(0, 40), lambda i: lpad(bin(strpos('0123456789abcdef', x[i + 1]) - 1), 4, '0')) AS bs FROM h),
d AS (SELECT page_id, n, top, array_to_string(bs, '') AS s FROM bits)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(s[5 * i + 1] = '1')::INT * 16 + (s[5 * i + 2] = '1')::INT * 8 + (s[5 * i + 3] = '1')::INT * 4 + (s[5 * i + 4] = '1')::INT * 2 + (s[5 * i + 5] = '1')::INT + 1]), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
