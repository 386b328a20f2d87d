"""WARC archives without repeated payloads: write, read back, resolve revisits.

Spark's text sink writes the records: a record is a header, a blank line and a block, and
the sink's line separator is the two line ends that close it. Archives live in any store
that Spark reaches; they are read as binary files of bounded size and parsed by length.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.llm.bloom import blocks_for, build_filter, possible_hits
from gitloom.session import cut_measured

#: Payloads below this many bytes are never replaced by a revisit record.
MIN_REVISIT_BYTES = 1000
#: Bytes of records in one archive file, on average.
FILE_BYTES = 32 << 20

# --- fixed values: the format's ---
VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# --- end of fixed values ---


def _uuid(*parts: Column) -> Column:
    """A record id that follows from the row, so that a repeated task writes the same."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def with_headers(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, n_bytes``; a null html is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    )


def responders(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``digest, n_bytes, response_id`` of payloads of at least ``min_bytes`` that repeat.

    Of equal payloads the row with the largest page_id is the response; null ids come last.
    Copies are counted before the shuffle.
    """
    return (
        headers.where(F.col("n_bytes") >= min_bytes)
        .groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )


def revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The headers whose payload another page holds, with its id as ``response_id``.

    Rows that repeat the response's id and payload are responses as well (and share its
    record id), and so are all rows of a payload that only null ids have.
    """
    joined = headers.join(responders(headers, min_bytes), ["digest", "n_bytes"])
    return joined.where(~F.col("page_id").eqNullSafe(F.col("response_id")))


def _key() -> Column:
    """Names rows of equal payload and id; what is decided for one of them holds for all."""
    return F.concat_ws("|", "digest", "n_bytes", "page_id")


def responses(pages: DataFrame, headers: DataFrame, found: DataFrame, n_found: int) -> DataFrame:
    """The pages (:func:`with_headers`) that are not among the revisits ``found``.

    Payloads stay where they are read. A filter of the revisits' keys clears most
    responses; those that it does not clear are known exactly from the headers, and a second
    filter, of their keys, tells revisits from them. Only pages that both filters let
    through, in the order of the first one's false positives, are shuffled for the exact
    join.
    """
    names = pages.columns
    listed = found.select(_key().alias("__key")).distinct()
    n_blocks = blocks_for(n_found)
    first = build_filter(listed, "__key", n_blocks)
    doubtful = possible_hits(headers.select(_key().alias("__key")), "__key", first, n_blocks)
    doubtful = doubtful.where("__possible").join(listed, "__key", "left_anti").select("__key").distinct()
    kept, seen = cut_measured(doubtful, "kept", n=F.count(F.lit(1)))
    k_blocks = blocks_for(seen["n"])
    second = build_filter(kept, "__key", k_blocks)
    asked = possible_hits(pages.withColumn("__key", _key()), "__key", first, n_blocks)
    asked = possible_hits(asked, "__key", second, k_blocks, "__kept")
    clear = asked.where("not __possible").select(*names)
    exact = asked.where("__possible and __kept").join(kept, "__key", "left_semi")
    return clear.unionByName(exact.select(*names))


def deduplicated(
    pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES
) -> tuple[DataFrame, DataFrame, int, int]:
    """Responses, revisits, and the number of all pages and of their payload bytes.

    Responses have a payload, revisits a ``response_id``. Pages are read twice: for the
    headers, a stored table which alone is shuffled to find revisits, and for the responses.
    """
    headed = with_headers(pages)
    sums = {"n": F.count(F.lit(1)), "n_bytes": F.sum("n_bytes")}
    headers, total = cut_measured(headed.drop("payload"), "headers", **sums)
    found, seen = cut_measured(revisits(headers, min_bytes), "revisits", n=F.count(F.lit(1)))
    kept = responses(headed, headers, found, seen["n"]) if seen["n"] else headed
    return kept, found, total["n"], total["n_bytes"] or 0


def records(rows: DataFrame, date: Column) -> DataFrame:
    """One text column ``value``: the record, with a fresh header, of each response
    (a row with ``payload``) or revisit (one with ``response_id``)."""
    kind = "revisit" if "response_id" in rows.columns else "response"
    block, target, profile = F.concat(F.lit(HTTP_HEAD), F.col("payload")), F.lit(None), F.lit(None)
    if kind == "revisit":
        block, profile = F.lit(HTTP_HEAD), F.lit(PROFILE)
        target = _uuid(F.lit("response"), F.col("response_id"), F.col("digest"))
    own = _uuid(F.lit(kind), F.col("page_id"), F.col("digest"))

    def line(name: str, value: Column) -> Column:  # absent where the value is null
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    header = F.concat_ws(
        END,
        F.lit(VERSION),
        line("WARC-Type", F.lit(kind)),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", target),
        line("WARC-Profile", profile),
        line("X-Page-ID", F.col("page_id")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
    )
    return rows.select(F.concat(header, F.lit(END + END), block).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    date: Column | None = None,
) -> None:
    """Write deduplicated archives (gzip) of ``page_id, url, html`` under ``path``.

    ``date`` is the records' date, by default now. Empty input writes an empty archive.
    """
    date = F.current_timestamp() if date is None else date
    kept, found, n, n_bytes = deduplicated(pages, min_bytes)
    mean = n_bytes / max(n, 1)
    rows = records(kept, date).unionByName(records(found, date))
    (
        rows.write.option("lineSep", END + END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, int(file_bytes / (mean + 600))))
        .text(path)
    )


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record; a broken record is an error."""
    while line := stream.readline():
        if line != f"{VERSION}{END}".encode():
            raise ValueError(f"no record at {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (END.encode(), b""):
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        block = stream.read(int(fields["Content-Length"]))
        if len(block) != int(fields["Content-Length"]) or stream.read(4) != (END + END).encode():
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, block


RECORD = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, "
    "refers_to_record string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record; without ``payloads`` that column is null.

    A response whose payload has another digest than its header says is an error. Revisit
    records have null ``payload_bytes`` until they are resolved.
    """
    types = [("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64())]
    types += [("url", pa.string()), ("payload_digest", pa.string())]
    types += [("refers_to_record", pa.string()), ("payload_bytes", pa.int64())]
    schema = pa.schema([*types, ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for fields, block in parse(gzip.open(io.BytesIO(content.as_py()))):
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = fields["WARC-Type"] == "response"
                    if response and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{fields['WARC-Record-ID']}: wrong payload digest")
                    page = fields.get("X-Page-ID")
                    rows.append(
                        {
                            "record_id": fields["WARC-Record-ID"],
                            "record_type": fields["WARC-Type"],
                            "page_id": None if page is None else int(page),
                            "url": fields.get("WARC-Target-URI"),
                            "payload_digest": digest,
                            "refers_to_record": fields.get("WARC-Refers-To"),
                            "payload_bytes": len(payload) if response else None,
                            "payload": payload if response and payloads else None,
                        }
                    )
                    held += len(payload)
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, RECORD)


def resolve_revisits(found: DataFrame) -> DataFrame:
    """Add ``refers_to`` (the response's page_id) and fill in the size (and payload) of revisits.

    A join on record ids; Spark splits a response that very many records revisit. Responses
    that repeat a record id count once; a revisit without its response keeps nulls.
    """
    responses = (
        found.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(
            F.first("page_id").alias("refers_to"),
            F.first("payload_bytes").alias("__bytes"),
            F.first("payload").alias("__payload"),
        )
    )
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes", "payload")
    revisits = revisits.join(responses, "refers_to_record", "left")
    revisits = revisits.withColumnsRenamed({"__bytes": "payload_bytes", "__payload": "payload"})
    plain = found.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(revisits)
