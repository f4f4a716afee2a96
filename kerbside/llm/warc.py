"""WARC derivatives: metadata and plain-text conversion records of response records.

A response gives two records that refer to it: ``metadata`` with its source headers, status and
digests as warc-fields, and ``conversion`` with the text of its html. Identifiers are derived
from the response's identifier and the kind of record, so that a rerun makes the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches
from kerbside.llm.html import blocks

CRLF = "\r\n"


def _uuid(*parts: Column) -> Column:
    """A record identifier from the digest of some columns, in the form of a version 5 UUID."""
    d = F.sha1(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.substring(d, 1, 8), F.lit("-"), F.substring(d, 9, 4), F.lit("-5"),
                    F.substring(d, 14, 3), F.lit("-a"), F.substring(d, 18, 3), F.lit("-"), F.substring(d, 21, 12),
                    F.lit(">"))


def _digest(data: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(data, 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", id_column: str = "page_id") -> DataFrame:
    """Pages as response records: (id, record_id, target_uri, date, block); the block is the
    HTTP message. Null html is an empty body."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF * 2))
    return pages.select(
        F.col(id_column), _uuid(F.lit("response"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
                                F.coalesce("url", F.lit(""))).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.concat(head, body).alias("block"))


def _text(series):
    import pandas as pd

    return pd.Series(["\n".join(text for text, *_ in blocks(page)) for page in series], dtype=object)


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per response: the columns of ``records`` but for record_id and block, and
    warc_type, record_id, refers_to, source_digest, payload_digest, block_digest,
    content_type, content_length, block.

    Expects record_id, target_uri, date and block, an HTTP message; what has no empty line is
    all body. Null blocks count as empty. Headers keep their order and case. Records that
    repeat an identifier give records that do, as do two captures of one page without a date in
    their identifier. Columns of ``records`` named like one that is added give way to it. An empty
    table gives an empty one.
    """
    added = ("warc_type", "record_id", "refers_to", "source_digest", "payload_digest", "block_digest",
             "content_type", "content_length", "block")
    kept = [c for c in records.columns if c not in added]
    # the columns of the records travel in one, so that no name meets those of the steps
    given = records.select(
        F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"),
        F.col("record_id"), F.coalesce(F.col("block").cast("string"), F.lit("")).alias("whole"))
    at = F.instr("whole", CRLF * 2)
    parsed = given.withColumn("at", at).withColumns({
        "head": F.when(F.col("at") > 0, F.expr("left(whole, at - 1)")).otherwise(""),
        "body": F.when(F.col("at") > 0, F.expr("substring(whole, at + 4)")).otherwise(F.col("whole"))})
    to_text = F.pandas_udf(_text, "string", F.PandasUDFType.SCALAR)
    parsed = small_batches(parsed).withColumn("text", to_text("body"))
    digested = parsed.withColumns({"source_digest": _digest(F.col("whole")), "payload_digest": _digest(F.col("body"))})
    head = F.split(F.col("head"), CRLF, -1)
    fields = F.concat_ws(
        CRLF, F.concat(F.lit("http-status-line: "), F.element_at(head, 1)),
        F.array_join(F.transform(F.slice(head, 2, F.greatest(F.size(head) - 1, F.lit(0))),
                                 lambda h: F.concat(F.lit("http-header: "), h)), CRLF),
        F.concat(F.lit("payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("payload-length: "), F.octet_length("body").cast("string")), F.lit(""))
    made = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                 fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("text").alias("block")))
    rows = digested.select("row", F.col("record_id").alias("refers_to"), "source_digest", "payload_digest",
                           F.explode(made).alias("m"))
    return rows.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.col("m.warc_type").alias("warc_type"),
        _uuid(F.col("m.warc_type"), F.coalesce("refers_to", F.lit(""))).alias("record_id"), "refers_to",
        "source_digest", "payload_digest", _digest(F.col("m.block")).alias("block_digest"),
        F.col("m.content_type").alias("content_type"),
        F.octet_length("m.block").cast("long").alias("content_length"), F.col("m.block").alias("block"))


def serialised(records: DataFrame) -> DataFrame:
    """A column ``value`` with each derived record as it stands in a WARC file, but for the two
    line ends after it."""
    fields = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
              ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
              ("Content-Type", "content_type"), ("Content-Length", "content_length"))
    lines = [F.concat(F.lit(f"{name}: "), F.col(column).cast("string")) for name, column in fields]
    return records.select(F.concat(
        F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF * 2), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Derived records as gzip-compressed WARC files, one per partition."""
    serialised(records).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
