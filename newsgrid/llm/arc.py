"""Legacy ARC archives converted to WARC records, and both kinds written and read as Spark files.

An ARC file starts with a ``filedesc`` record whose second line names the version; each record is one
header line (version 1: URL IP-address Archive-date Content-type Archive-length; version 2: ten
fields ending with Result-code Checksum Location Offset Filename Archive-length) and as many bytes
as declared. The converter makes record ids, dates, types and SHA-1 digests; equal payloads of at
least ``min_revisit`` bytes become revisits of one response.

Null html is an empty payload, null urls become ``urn:none``, header fields lose spaces and control
characters by percent-encoding. A file that breaks off, or a header line that does not parse, ends
that file's records with one row whose ``error`` says where; the rows before it stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = {
    "1": ["url", "ip", "date", "type", "length"],
    "2": ["url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"],
}
V1_NAMES = "URL IP-address Archive-date Content-type Archive-length"
V2_NAMES = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
RECORD = "url string, ip string, date string, type string, payload binary, version string, error string"


def inflated(data: bytes) -> bytes:
    """Plain bytes of a file with any number of gzip members."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out) + data


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of one ARC file, the ``filedesc`` record left out."""
    at, version = 0, "1"
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").strip()
        parts = line.split(" ")
        names = FIELDS["1"] if line.startswith("filedesc:") and len(parts) == 5 else FIELDS[version]
        if end < 0 or len(parts) != len(names) or not parts[-1].isdigit():
            yield {"error": f"no header line at byte {at}"}
            return
        record = dict(zip(names, parts, strict=True))
        body = data[end + 1 : (at := end + 1 + int(record["length"]))]
        if line.startswith("filedesc:"):
            version = "2" if body[:1] == b"2" else "1"
            continue
        if len(body) < int(record["length"]):
            yield {"error": f"record of {record['length']} bytes breaks off at {len(data)}"}
            return
        yield {"url": record["url"], "ip": record["ip"], "date": record["date"], "type": record["type"], "payload": body, "version": version}


WARC_RECORD = "record_id string, url string, date string, record_type string, payload_digest string, refers_to_id string, payload_bytes long, stored_bytes long, payload binary, error string"


def warc_records(data: bytes) -> Iterator[dict]:
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at : end if end >= 0 else at].decode("utf-8", "replace").split("\r\n")
        told = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        if end < 0 or not head[0].startswith("WARC/") or not told.get("content-length", "").isdigit():
            yield {"error": f"no record at byte {at}"}
            return
        size = int(told["content-length"])
        body = data[end + 4 : end + 4 + size]
        if len(body) < size:
            yield {"error": f"record of {size} bytes breaks off"}
            return
        at = end + 4 + size + 4
        yield {
            "record_id": told.get("warc-record-id"), "url": told.get("warc-target-uri"), "date": told.get("warc-date"), "record_type": told.get("warc-type"),
            "payload_digest": told.get("warc-payload-digest", "").removeprefix("sha1:"), "refers_to_id": told.get("warc-refers-to"),
            "payload_bytes": int(told.get("x-payload-length", size)), "stored_bytes": size, "payload": body,
        }


def read_archives(spark, path: str, records, schema: str) -> DataFrame:
    """Every record of the archives under ``path``; a task holds one file, whose size the writers bound."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                found, size = [], 0
                for record in records(inflated(content)):
                    found.append(record)
                    size += len(record.get("payload") or b"")
                    if size > 4_000_000:
                        yield pd.DataFrame(found).reindex(columns=names).astype(object).where(lambda x: x.notna(), None)
                        found, size = [], 0
                if found:
                    yield pd.DataFrame(found).reindex(columns=names).astype(object).where(lambda x: x.notna(), None)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, schema)


def encoded(column: Column) -> Column:
    """A header field: spaces and control characters percent-encoded, null as ``urn:none``."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(column, " ", "%20"), r"[\x00-\x1F\x7F]", "%0A"), F.lit("")), F.lit("urn:none"))


def write_text_archive(df: DataFrame, path: str, records_per_file: int) -> None:
    """Files whose lines are the column ``record``, each ended by one line feed."""
    df.select("record").write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def write_arc(pages: DataFrame, path: str, version: str, records_per_file: int = 2_000) -> None:
    """``pages`` (url, ip, date, html) as ARC files; each record stands with its own file description."""
    names = V1_NAMES if version == "1" else V2_NAMES
    block = f"{version} 0 legacy\n{names}\n"
    desc = f"filedesc://legacy.arc 0.0.0.0 20000101000000 text/plain {len(block)}\n{block}\n"
    html = F.coalesce("html", F.lit(""))
    size = F.octet_length(html).cast("string")
    fields = [encoded(F.col("url")), F.col("ip"), F.col("date"), F.lit("text/html")]
    fields += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("legacy.arc")] if version == "2" else []
    write_text_archive(pages.select(F.concat(F.lit(desc), F.concat_ws(" ", *fields, size), F.lit("\n"), html).alias("record")), path, records_per_file)


def read_arc(spark, path: str) -> DataFrame:
    return read_archives(spark, path, arc_records, RECORD)


def digested(records: DataFrame) -> DataFrame:
    """Adds the payload's SHA-1 and the WARC form of the 14-digit date (epoch where it does not parse)."""
    when = F.try_to_timestamp(F.col("date"), F.lit("yyyyMMddHHmmss"))
    return records.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "warc_date", F.coalesce(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z"))
    )


def record_id(key: Column) -> Column:
    """A name-based id, the same on every run."""
    h = F.md5(key.cast("string"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def to_warc(records: DataFrame, key: str, min_revisit: int = 1_000) -> DataFrame:
    """``records`` with type, id and reference; of equal payloads the largest ``key`` is the response."""
    told = digested(records)
    heads = told.where(F.col("payload_bytes") >= min_revisit).groupBy(F.col("payload_digest").alias("_d"), F.col("payload_bytes").alias("_n")).agg(F.max(key).alias("head"))
    joined = told.join(heads, (F.col("payload_digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_n")), "left").drop("_d", "_n")
    again = F.col("head").isNotNull() & ~F.col(key).eqNullSafe(F.col("head"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("record_id", record_id(F.col(key))).withColumn(
        "refers_to_id", F.when(again, record_id(F.col("head")))
    )


def write_warc(records: DataFrame, path: str, records_per_file: int = 2_000) -> None:
    """WARC files; a revisit's block is empty and its header keeps digest and length of the payload."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.decode("payload", "UTF-8"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "warc_date"), F.concat(F.lit("WARC-Target-URI: "), "url"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), "refers_to_id")), F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    write_text_archive(records.select(F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r")).alias("record")), path, records_per_file)


def read_warc(spark, path: str) -> DataFrame:
    """Records with their full payload's digest, recomputed for responses."""
    rows = read_archives(spark, path, warc_records, WARC_RECORD)
    return rows.withColumn("payload_digest", F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest")))
