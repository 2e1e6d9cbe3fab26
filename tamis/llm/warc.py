"""WARC archives: one record per page, equal payloads stored once, read back by verified chains.

Writing: of pages with equal payloads of at least ``LEAST_BYTES`` bytes the one with the smallest
id is a ``response``, the others are ``revisit`` records that refer to it and hold no payload.

Reading: records have no index, and a payload may hold the magic, even whole records. The scan is
split at every magic, so each place where a record could start is a row: a candidate. Its header
names the length of its content and so the place of its successor. A record is what is reachable
from the start of its file. Each task first follows the chains of its own split (pointer jumping
in arrays), which leaves for each candidate the place where its chain leaves the split; the few
places at which splits are entered are then resolved by pointer jumping over a table. Rounds grow
with the logarithm of the splits of a file, not with its records. Payloads are not shuffled: only
records whose payload holds the magic are put together from several rows.

Nothing opens a file by itself: Spark's text source reads the archives, plain or compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import FILE, NARROW_BYTES, ROW, named_columns, stored, text_of
from tamis.sources.staging import fits_broadcast, materialize, new_path

# Marks of the WARC 1.1 format.
MAGIC = "WARC/1."  # the minor version follows
LINE = "\r\n"
BLANK = "\r\n\r\n"  # ends a header; also follows every record
HTTP = "application/http;msgtype=response"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100  # smaller payloads are always stored
DATE = "2000-01-01T00:00:00Z"  # of pages without a date of their own
SPLIT_BYTES = 64 * 1024 * 1024  # of an archive that one task reads


def _urn(*parts: Column) -> Column:
    """A record id made of what tells a row apart."""
    return F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws("|", *parts), 256), F.lit(">"))


def _one_line(value: Column) -> Column:
    """The value without what would end a header line or a URI."""
    for found, put in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        value = F.replace(value, F.lit(found), F.lit(put))
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]", "")


def _header(**fields: Column) -> Column:
    """Header lines; a null value leaves its line out."""
    lines = [F.concat(F.lit(f"{name.replace('_', '-')}: "), value) for name, value in fields.items()]
    return F.concat(F.lit(f"{MAGIC}1{LINE}"), F.concat_ws(LINE, *lines), F.lit(BLANK))


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = DATE,
    least_bytes: int = LEAST_BYTES,
    compression: str | None = None,
) -> None:
    """Write a record per row of ``pages`` to ``path``, one archive per task.

    A null ``html`` is an empty payload, a null ``url`` or id leaves its header line out. Of rows
    with the same payload and id, the first in storage is the response; a null id comes after all
    others. Other columns are not looked at.
    """
    named = named_columns(pages, page_id=page_id, url=url, html=html)
    rows = stored(named)
    payload = text_of("html").cast("binary")
    key = [F.col("page_id").isNull(), "page_id", FILE, ROW]
    narrow = materialize(
        rows.select(FILE, ROW, "page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")),
        "payloads",
    )
    # One row per payload that several pages have.
    copied = (
        narrow.where(F.col("n") >= least_bytes)
        .groupBy("digest", "n")
        .agg(F.count("*").alias("rows"), F.min(F.struct(*key)).alias("first"))
        .where("rows > 1")
    )
    page, file, row = (F.col(f"first.{c}") for c in ("page_id", FILE, ROW))
    target = _urn(page.cast("string"), file, row.cast("string")).alias("refers_to")
    copied = materialize(copied.select("digest", "n", file.alias("file"), row.alias("row"), target), "copied")
    # A payload may belong to a third of the pages: where its table is not broadcast, adaptive
    # execution splits its partition.
    small = fits_broadcast(copied, NARROW_BYTES)
    revisits = narrow.join(F.broadcast(copied) if small else copied, ["digest", "n"])
    revisits = revisits.where((F.col(FILE) != F.col("file")) | (F.col(ROW) != F.col("row")))
    revisits = materialize(revisits.select(FILE, ROW, "refers_to"), "revisits")
    small = fits_broadcast(revisits, NARROW_BYTES)
    full = rows.join(F.broadcast(revisits) if small else revisits, [FILE, ROW], "left")
    again = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(again, F.lit("")).otherwise(text_of("html")))
    record = F.concat(
        _header(
            WARC_Type=F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
            WARC_Record_ID=_urn(F.col("page_id").cast("string"), F.col(FILE), F.col(ROW).cast("string")),
            WARC_Date=F.lit(date),
            WARC_Target_URI=_one_line(F.col("url")),
            WARC_Payload_Digest=F.concat(F.lit("sha256:"), F.sha2(payload, 256)),
            WARC_Refers_To=F.col("refers_to"),
            WARC_Profile=F.when(again, F.lit(REVISIT)),
            X_Page_ID=F.url_encode(F.col("page_id").cast("string")),
            Content_Type=F.lit(HTTP),
            Content_Length=F.octet_length(block).cast("string"),
        ),
        block,
    )
    writer = full.select(record.alias("value")).write.option("lineSep", BLANK)
    (writer.option("compression", compression) if compression else writer).text(path)


def _field(name: str) -> Column:
    """A header field, null if it is missing."""
    found = F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def scan(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``place``, ``file``, ``block``, ``value``: what lies between two magics, in a row each.

    ``place`` grows along a split. The scan is made twice and must cut the files alike both times,
    also when executors came or went in between; so a session of its own fixes the splits, which
    otherwise follow the number of cores.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return own.read.option("lineSep", MAGIC).text(path).select(
        F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def candidates(lines: DataFrame) -> DataFrame:
    """``file``, ``block``, ``place``, ``at``, ``goes_to``, ``whole``, ``last`` of every row of ``scan``.

    ``at`` is the offset in the file behind the magic, ``goes_to`` that of the successor which the
    header announces (null without a valid header), ``whole`` says that the record ends with the
    row, ``last`` is what a file's last record goes to. Written.
    """
    header = F.substring_index("value", BLANK, 1)
    n = F.octet_length("value").cast("long")
    length = F.try_to_number(F.substring(_field("Content-Length"), 1, 18), F.lit("9" * 18)).cast("long")
    size = F.col("head") + F.col("length") + len(BLANK)
    narrow = materialize(
        lines.select("place", "file", "block", n.alias("n"), header.alias("header"))
        .withColumns({"head": F.octet_length("header").cast("long") + len(BLANK), "length": length})
        .select("place", "file", "block", "n", F.when(F.col("head") <= F.col("n"), size).alias("size")),
        "lines",
    )
    step = F.col("n") + len(MAGIC)
    splits = narrow.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    of_file = W.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("bytes").over(of_file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("bytes").over(of_file.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    splits = splits.select("file", "block", before.alias("base"), every.alias("last"))
    inside = W.partitionBy("file", "block").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum(step).over(inside), F.lit(0))
    found = narrow.join(splits, ["file", "block"]).withColumn("at", at)
    return materialize(
        found.select(
            "file",
            "block",
            "place",
            "at",
            # what stands before the first magic of a file is no record
            F.when(F.col("at") > 0, F.col("at") + F.col("size") + len(MAGIC)).alias("goes_to"),
            (F.col("size") == F.col("n")).alias("whole"),
            "last",
        ),
        "candidates",
    )


def _inside(at: np.ndarray, goes_to: np.ndarray) -> np.ndarray:
    """Index of each one's successor among the sorted ``at``; its own where there is none."""
    own = np.arange(len(at))
    index = np.minimum(np.searchsorted(at, goes_to), len(at) - 1)
    return np.where(at[index] == goes_to, index, own)


def _sorted(split: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    split = split.sort_by("at")
    return split, split.column("at").to_numpy(), split.column("goes_to").fill_null(-1).to_numpy()


def leaves_at(split: pa.Table) -> pa.Table:
    """For every candidate of a split, where its chain goes to from the last one inside."""
    split, at, goes_to = _sorted(split)
    jump = _inside(at, goes_to)
    while not np.array_equal(further := jump[jump], jump):
        jump = further
    return pa.table({"file": split.column("file"), "at": at, "goes_to": pa.array(goes_to[jump])})


def reached_in(split: pa.Table) -> pa.Table:
    """Whether each candidate of a split is on the chain of one where the split is entered."""
    split, at, goes_to = _sorted(split)
    reached, jump = split.column("entered").to_numpy().astype(bool), _inside(at, goes_to)
    while True:
        reached[jump[reached]] = True
        if np.array_equal(further := jump[jump], jump):
            break
        jump = further
    return split.drop_columns(["entered"]).append_column("record", pa.array(reached))


def entered(found: DataFrame) -> DataFrame:
    """``file``, ``at`` of the records at which a split is entered, by pointer jumping over the
    places where chains leave the splits.

    Raises if the chain from a file's start does not end at the file's end.
    """
    split = found.select("file", "block", "at", "goes_to").groupBy("file", "block")
    exits = materialize(split.applyInArrow(leaves_at, "file string, at long, goes_to long"), "exits")
    starts = found.select("file", F.lit(len(MAGIC)).cast("long").alias("at"), "last").distinct()
    starts = materialize(starts, "starts")
    # Of a split's candidates, those that something goes to; others can't be entered.
    places = exits.select("file", F.col("goes_to").alias("at")).unionByName(starts.select("file", "at")).distinct()
    jump = materialize(exits.join(places, ["file", "at"]), "jumps")
    reached = starts.select("file", "at")
    while True:
        next_jump = jump.select("file", F.col("at").alias("goes_to"), F.col("goes_to").alias("beyond"))
        further = jump.join(next_jump, ["file", "goes_to"]).select("file", "at", F.col("beyond").alias("goes_to"))
        new = reached.join(jump, ["file", "at"]).select("file", F.col("goes_to").alias("at"))
        reached = materialize(reached.unionByName(new).distinct(), "reached")
        jump = materialize(further, "jumps")
        if jump.isEmpty():
            break
    broken = starts.join(reached, (starts.file == reached.file) & (starts["last"] == reached["at"]), "left_anti")
    n = broken.count()
    if n:
        raise ValueError(f"{n} archives hold no whole chain of records, such as {broken.first()['file']}")
    return reached


def records(lines: DataFrame) -> DataFrame:
    """``header`` and ``content`` (binary) of every record of the rows of ``scan``."""
    found = candidates(lines)
    reached = entered(found).withColumn("entered", F.lit(True))
    marked = found.join(reached, ["file", "at"], "left").withColumn("entered", F.coalesce("entered", F.lit(False)))
    schema = "file string, block long, place long, at long, goes_to long, whole boolean, last long, record boolean"
    marked = marked.select("file", "block", "place", "at", "goes_to", "whole", "last", "entered")
    chain = materialize(marked.groupBy("file", "block").applyInArrow(reached_in, schema), "chain")
    # Rows that are no whole record: parts of one, the first of them the record's own, and what
    # stands before the first magic (nothing, or the chain would be broken).
    head = F.when(F.col("record"), F.col("place"))
    up_to = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    parts = chain.where(~(F.col("record") & F.col("whole"))).select(
        "place", "at", F.last(head, True).over(up_to).alias("head"), F.lit(True).alias("part")
    )
    parts = materialize(parts, "parts")
    small = fits_broadcast(parts, NARROW_BYTES)
    rows = lines.select("place", "value").join(F.broadcast(parts) if small else parts, "place", "left")
    # One group is one record whose payload holds the magic.
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
    joined = rows.where("head IS NOT NULL").groupBy("head").agg(F.array_join(pieces, MAGIC).alias("value"))
    values = rows.where("part IS NULL").select("value").unionByName(joined.select("value"))
    header = F.substring_index("value", BLANK, 1)
    with_header = values.select("value", header.alias("header"))
    start = F.octet_length("header") + len(BLANK) + 1
    content = F.substring(F.col("value").cast("binary"), start, _field("Content-Length").cast("int"))
    return with_header.select("header", content.alias("content"))


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of all archives in ``path``: ``record_type``, ``record_id``, ``target_uri``,
    ``date``, ``refers_to``, ``digest``, ``page_id`` (string), ``content_type``, ``header``, ``payload``.

    The payload (binary) of an HTTP message is its body, of other records their content. Fields
    that a record lacks are null. An archive whose chain of records is broken is an error; an
    empty file has no records.
    """
    of = records(scan(spark, path, split_bytes)).withColumn("content_type", _field("Content-Type"))
    http = F.octet_length(F.substring_index(F.col("content").cast("string"), BLANK, 1)) + len(BLANK)
    is_http = F.lower("content_type").startswith("application/http")
    body = F.when(is_http, F.substring(F.col("content"), http + 1, F.octet_length("content"))).otherwise(F.col("content"))
    return of.select(
        F.lower(_field("WARC-Type")).alias("record_type"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("target_uri"),
        _field("WARC-Date").alias("date"),
        _field("WARC-Refers-To").alias("refers_to"),
        _field("WARC-Payload-Digest").alias("digest"),
        F.url_decode(_field("X-Page-ID")).alias("page_id"),
        "content_type",
        "header",
        body.alias("payload"),
    )


def described(records_read: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (a page
    id) of every record of ``read_warc``; of a revisit, those of the payload it refers to.

    A payload that does not have the digest of its header is an error, and so is a revisit whose
    response is missing or has another payload.
    """
    named = F.when(F.lower("digest").startswith("sha256:"), F.substring_index("digest", ":", -1))
    own = F.sha2("payload", 256)
    error = F.raise_error(F.concat(F.lit("payload and digest differ: "), "record_id")).cast("string")
    narrow = records_read.select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", named)
        .when(named.isNull() | (named == own), own)
        .otherwise(error)
        .alias("payload_digest"),
    )
    narrow = materialize(narrow, "records")
    stays = narrow.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to")
    )
    again = narrow.where("record_type = 'revisit'").select("page_id", "refers_to", "payload_digest", "record_type")
    # One row per response that is referred to, however many do.
    wanted = again.select(F.col("refers_to").alias("record_id")).distinct()
    of = narrow.where("record_type <> 'revisit'").join(wanted, "record_id", "left_semi").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("response"),
        "payload_bytes",
        F.col("payload_digest").alias("other"),
    )
    of = materialize(of, "responses")
    found = again.join(F.broadcast(of) if fits_broadcast(of, NARROW_BYTES) else of, "refers_to", "left")
    known = F.coalesce(F.col("payload_digest") == F.col("other"), F.lit(False))
    size = F.when(known, F.col("payload_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("no such response: "), "refers_to")).cast("long")
    )
    response = F.col("response").alias("refers_to")
    return stays.unionByName(
        found.select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", response)
    )


def op12_warc(pages: DataFrame) -> DataFrame:
    """Write the pages as archives below the shared folder, read them back, and describe every
    record; one row per page.

    Nulls, empty pages, repeated rows and columns of any other name: see ``write_warc``. A page
    of any length is one record. No pages give no rows.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    path = new_path(spark, "warc")
    write_warc(pages, path)
    found = described(read_warc(spark, path))
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
