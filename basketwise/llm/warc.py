"""WARC archives of pages: writing with payload deduplication, reading by boundary-chain verification.

Writing: a record is a header block, an empty line and the payload, ended by two line breaks; these are the rows and the
row separator of Spark's text writer. Of records with equal payloads that are long enough, the one with the smallest id is
a response and holds the payload; the others are revisits that refer to it. Payloads stay where they were read:
only the ids of revisits are joined in, broadcast as far as Spark's size check on that written table allows.

Reading: archives are cut at every occurrence of the version line, wherever splits fall. Each piece has an offset and, by the
length its header declares, an offset where its record must end. A version line inside a payload also starts a piece.
Records are the pieces that can be reached from the start of the file; pointer jumping finds them in as many rounds as the
logarithm of the pieces of the largest file. Other pieces are part of the payload of the record before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwise.session import materialise, scratch_path

VERSION = "WARC/1.1\r\n"
_END = "\r\n\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null. Line breaks in a value would end the line and are taken out."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "), F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, least: int = 100) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as WARC files under ``path``.

    Args:
        least: payloads shorter than this many bytes are never revisits.

    A null html is an empty payload. Rows that repeat the smallest id of a payload are all responses; a row without id is
    a revisit if another row has the payload and an id. Further columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    digest = F.sha2("payload", 256)
    small = rows.where(F.octet_length("payload") >= least).select("page_id", digest.alias("digest"))
    first = small.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = small.join(first, "digest").where("not (page_id <=> refers_to)").distinct()
    revisits = materialise(later, "warc-revisits")
    known = revisits.select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "refers_to")
    joined = rows.withColumn("digest", digest).join(
        known, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest")), "left"
    )
    again = F.col("refers_to").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    record = F.concat(
        F.lit(VERSION),
        F.when(again, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">\r\n")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    joined.select(record.alias("value")).write.option("lineSep", _END).text(path)


def _field(name: str) -> Column:
    """Value of a header line, null if there is none."""
    value = F.regexp_extract("head", f"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between version lines, with file and offset of the line before it (null text before the first)."""
    raw = spark.read.option("lineSep", VERSION).text(path)
    raw = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        F.octet_length("value").cast("long").alias("length"),
    )
    return raw


def _placed(pieces: DataFrame) -> DataFrame:
    """Adds each piece's offset: the lengths before it in its file, and the version lines between."""
    order = "(PARTITION BY file ORDER BY block, at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = F.expr(f"sum(length + {len(VERSION)}) OVER {order} - length - 2 * {len(VERSION)}")
    return pieces.withColumn("offset", before).where("offset >= 0")


def reachable(links: DataFrame, most: int) -> DataFrame:
    """(file, offset) of the records that a chain from offset 0 of each file meets.

    Args:
        links: (file, offset, successor) of all candidates.
        most: candidates of the file that has most.
    """
    jumps = links.select("file", "offset", "successor")
    found = jumps.where("offset = 0").select("file", "offset")
    rounds = max(1, most).bit_length()
    for i in range(rounds):  # found: the first 2^i records; jumps: over 2^i records
        ahead = found.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        found = materialise(found.unionByName(ahead), "warc-found")
        if i + 1 < rounds:
            far = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("after"))
            jumps = jumps.join(far, ["file", "successor"]).select("file", "offset", F.col("after").alias("successor"))
            jumps = materialise(jumps, "warc-jumps")
    return found.join(links, ["file", "offset"], "left_semi")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under ``path``: file, offset, page_id, url, record_type, refers_to, and the payload's bytes
    (payload_bytes) and SHA-256 (payload_digest), both of the full payload, which a revisit takes from its response.

    Version lines inside payloads do no harm; files without a version line give nothing. A payload that was cut short
    at the end of a file ends the chain, so that the record is left out.
    """
    pieces = _pieces(spark, path)
    head_end = F.locate(_END, F.col("value"))
    head_bytes = F.octet_length(F.substring_index("value", _END, 1)) + len(_END)
    declared = F.regexp_extract(F.substring_index("value", _END, 1), "(?:^|\r\n)Content-Length: ([0-9]{1,15})(?:\r\n|$)", 1)
    raw = F.col("value").cast("binary")
    parsed = pieces.select(
        "file", "block", "at", "length",
        F.when(head_end > 0, F.substring_index("value", _END, 1)).alias("head"),
        F.when((head_end > 0) & (declared != ""), head_bytes.cast("long")).alias("skip"),
        F.when(declared != "", declared.cast("long")).alias("declared"),
        F.when(
            (head_end > 0) & (declared != ""), F.sha2(F.substring(raw, head_bytes + 1, declared.cast("int")), 256)
        ).alias("digest"),
    )
    placed = materialise(_placed(parsed), "warc-pieces")
    successor = F.col("offset") + len(VERSION) + F.col("skip") + F.col("declared") + len(_END)
    links = placed.where("skip is not null").select("file", "offset", successor.alias("successor"))
    most = placed.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    records = reachable(links, most).join(placed, ["file", "offset"])
    ends = F.col("length") >= F.col("skip") + F.col("declared")
    whole = records.where(ends).select("file", "offset", "head", "declared", "digest")
    # a record whose payload holds version lines: its bytes are in several pieces, which are read once more
    cut = records.where(~ends).select("file", F.col("offset").alias("owner"), "head", "skip", "declared")
    cut = materialise(cut, "warc-cut")
    last = F.col("owner") + len(VERSION) + F.col("skip") + F.col("declared")
    files = cut.select("file").distinct()
    again = _placed(_pieces(spark, path).join(files, "file", "left_semi")).select("file", "offset", "value")
    parts = again.join(cut, "file").where((F.col("offset") >= F.col("owner")) & (F.col("offset") < last))
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), VERSION
    ).cast("binary")
    rebuilt = (
        parts.groupBy("file", "owner", "head", "skip", "declared")
        .agg(joined.alias("bytes"))
        .where(F.octet_length("bytes") >= F.col("skip") + F.col("declared"))
        .select(
            "file", F.col("owner").alias("offset"), "head", "declared",
            F.sha2(F.substring(F.col("bytes"), (F.col("skip") + 1).cast("int"), F.col("declared").cast("int")), 256).alias("digest"),
        )
    )
    page = F.regexp_extract("head", "(?:^|\r\n)WARC-Record-ID: <urn:page:(-?[0-9]*)>", 1)
    refers = F.regexp_extract("head", "(?:^|\r\n)WARC-Refers-To: <urn:page:(-?[0-9]*)>", 1)
    read = whole.unionByName(rebuilt).select(
        "file", "offset", "declared", "digest",
        F.when(page != "", page.cast("long")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("stated"),
    )
    read = materialise(read, "warc-read")
    held = read.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("digest").alias("stated"), F.col("declared").alias("full")
    )
    revisits = read.where("record_type = 'revisit'").join(held.distinct(), ["refers_to", "stated"], "left")
    columns = ["file", "offset", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        read.where("record_type = 'response'")
        .withColumnsRenamed({"declared": "payload_bytes", "digest": "payload_digest"})
        .select(columns)
        .unionByName(revisits.withColumnsRenamed({"full": "payload_bytes", "stated": "payload_digest"}).select(columns))
    )


def archive_and_read(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    return read_archives(pages.sparkSession, path)
