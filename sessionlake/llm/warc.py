"""Zstandard WARC archives: a dictionary in the leading skippable frame, one frame for each record.

Writing: each task packs its rows into archives of bounded size. An archive is written as one file by Spark's text
sink, whose line separator is an empty skippable frame, so the file is a valid sequence of Zstandard frames.
Reading: Spark's binaryFile source hands each archive to a task, which loads the dictionary, decodes frame by frame
and validates each record's version, headers, lengths and digest.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm.common import broadcast_if_small, shared_folder, stored

#: Fixed values of the formats: the dictionary's frame magic, an empty skippable frame (all ASCII), the frame magic.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"

RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, problem string"


def trained_dictionary(pages: DataFrame, payload_col: str, sample_rows: int = 400, dictionary_bytes: int = 16_384) -> bytes:
    """A dictionary from at most `sample_rows` payloads' first 4 KiB; empty where there is too little to train on."""
    heads = [bytes(r[0]) for r in pages.select(F.substring(F.col(payload_col), 1, 4096)).where(F.octet_length(F.col(payload_col)) > 0).limit(sample_rows).collect()]
    try:
        return zstandard.train_dictionary(dictionary_bytes, heads).as_bytes() if len(heads) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def _record(page_id, url, kind: str, refers, digest: str, payload: bytes) -> bytes:
    block = b"" if kind == "revisit" else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {url}" if isinstance(url, str) else None,
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Refers-To: <urn:page:{refers}>" if kind == "revisit" else None,
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None,
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(block)}",
    ]
    return "\r\n".join(x.replace("\r", "%0D").replace("\n", "%0A") for x in head if x is not None).encode() + b"\r\n\r\n" + http + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, level: int = 3, archive_bytes: int = 16 << 20) -> None:
    """Writes (page_id, url, record_type, refers_to, payload_digest, payload) as archives of about `archive_bytes`."""
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True)
        parts, size = [lead], len(lead)
        for t in batches:
            for page_id, url, kind, refers, digest, payload in zip(t["page_id"], t["url"], t["record_type"], t["refers_to"], t["payload_digest"], t["payload"], strict=True):
                parts.append(coder.compress(_record(page_id, url, kind, refers, digest, bytes(payload))))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pd.DataFrame({"archive": [b"".join(parts)]})
                    parts, size = [lead], len(lead)
        if len(parts) > 1:
            yield pd.DataFrame({"archive": [b"".join(parts)]})

    # ids as text: a null id would turn a pandas column of longs into floats
    rows = pages.select(F.col("page_id").cast("string"), "url", "record_type", F.col("refers_to").cast("string"), "payload_digest", "payload")
    archives = rows.mapInPandas(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)


def frames(archive: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(dictionary, decoded frame) of each frame but skippable ones; raises ValueError on what isn't an archive."""
    at, dictionary, shared = 0, b"", None
    while at < len(archive):
        magic = archive[at : at + 4]
        if len(magic) == 4 and magic[1:] == b"\x2a\x4d\x18" and 0x50 <= magic[0] <= 0x5F:
            (size,) = struct.unpack_from("<I", archive, at + 4)
            if at == 0 and magic[0] == 0x5D:
                dictionary = archive[8 : 8 + size]
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary) if dictionary[:4] == FRAME_MAGIC else dictionary
                shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            at += 8 + size
            if at > len(archive):
                raise ValueError("a skippable frame passes the end")
        elif magic == FRAME_MAGIC:
            decoder = (zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()).decompressobj()
            data = decoder.decompress(archive[at:at + (1 << 16)])
            fed = min(len(archive), at + (1 << 16))
            while not decoder.eof:
                if fed >= len(archive):
                    raise ValueError("a frame is cut off")
                more = archive[fed : fed + (1 << 20)]
                fed += len(more)
                data += decoder.decompress(more)
            at = fed - len(decoder.unused_data)
            yield dictionary, data
        else:
            raise ValueError(f"no frame at byte {at}")


def parsed(record: bytes) -> dict:
    """One WARC record as a row of RECORDS; `problem` names the first check that fails, else null."""
    row = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"))
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines[1:]) if sep}
    number = lambda text: int(text[10:-1]) if text.startswith("<urn:page:") and text[10:-1].lstrip("-").isdigit() else None
    row |= {"page_id": number(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"), "refers_to": number(fields.get("warc-refers-to", "")), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:")}
    length = fields.get("content-length", "")
    if not found or not lines[0].startswith("WARC/1."):
        return row | {"problem": "no WARC header"}
    if {"warc-type", "warc-record-id", "warc-payload-digest"} - fields.keys() or not length.isdigit():
        return row | {"problem": "a header is missing"}
    if len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return row | {"problem": "the block's length is not its Content-Length"}
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/1."):
        return row | {"problem": "no HTTP header"}
    if f"content-length: {len(payload)}" not in http.decode("latin-1").lower().split("\r\n"):
        return row | {"problem": "the payload's length is not its Content-Length"}
    if row["record_type"] == "revisit":
        return row | ({"problem": "a revisit with a payload"} if payload else {})
    row |= {"payload_bytes": len(payload), "payload": payload}
    return row | ({"problem": "the payload's digest differs"} if hashlib.sha256(payload).hexdigest() != row["payload_digest"] else {})


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row of RECORDS for each record of the archives in a folder.

    `problem` tells what is wrong with a record, and is null for valid ones; an archive that breaks off gives a row
    with nothing but `problem`. A revisit has neither payload nor payload_bytes. `payloads` false leaves payloads out.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            for archive in t["content"]:
                rows: list[dict] = []
                try:
                    for _, data in frames(bytes(archive)):
                        rows.append(parsed(data))
                        if not payloads:
                            rows[-1]["payload"] = None
                        if len(rows) >= 500:
                            yield _table(rows)
                            rows = []
                except (ValueError, zstandard.ZstdError) as error:
                    rows.append(dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")) | {"problem": f"archive: {error}"})
                if rows:
                    yield _table(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInPandas(decode, RECORDS)


def _table(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.array([r[name] for r in rows], dtype="Int64") if name in ("page_id", "refers_to", "payload_bytes") else [r[name] for r in rows] for name in rows[0]})


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 100) -> tuple[str, DataFrame]:
    """Writes a record for each row, and reads them back: (folder, records with payload_bytes of revisits resolved).

    Of rows with equal payloads of at least `least_bytes` bytes, those with the smallest id are responses, the others
    revisits of it. Null payloads are empty. Rows with a null id are responses unless an equal payload has an id.
    Repeated rows are repeated records: those that share the smallest id are all responses. An empty table gives an
    archive folder without records. Other columns are not read.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    digests = rows.where(F.octet_length("payload") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    repeated = stored(digests.select(F.col("payload_digest").alias("__digest"), "first_id"))
    met = rows.join(broadcast_if_small(repeated), F.col("payload_digest") == F.col("__digest"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kinds = met.select("page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"), "payload_digest", "payload")
    folder = shared_folder(spark)
    write_archives(kinds, folder, trained_dictionary(rows, "payload"))
    records = read_archives(spark, folder, payloads=False)
    records = stored(records.drop("payload"))
    sizes = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")).agg(F.min("payload_bytes").alias("__bytes"))
    referred = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("__id")).distinct()
    sizes = stored(sizes.join(referred, "__id", "left_semi"))
    whole = records.join(broadcast_if_small(sizes), (F.col("refers_to") == F.col("__id")) & (F.col("payload_digest") == F.col("__digest")), "left")
    return folder, whole.select("page_id", "url", "record_type", "refers_to", F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"), "payload_digest", "problem")
