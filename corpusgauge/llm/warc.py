"""Content-addressed web archive: payload bytes once per digest, exact record heads apart.

An archive has three tables. ``payloads`` (digest, payload) holds every distinct payload once,
under its SHA-256. ``responses`` and ``revisits`` hold the exact bytes that precede the payload in
each record (WARC head and HTTP head) with the digest they point to. Payloads and responses are
bucketed by digest, so records are rebuilt by a join that does not move payload bytes. A digest is
verified when it is read: it is computed again from the stored bytes.

Defined results: a null payload is empty; a null URL is an empty target; of equal payloads the
rows with the largest id are responses (null counts as smaller than any id, and rows that repeat
the id are all responses); an empty table gives an archive without records. Only the three named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.operators.keyed import lookup_join

# Fixed values of the record format.
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Digests broadcast at once; 100,000 of them take about 25 MB.
BROADCAST_DIGESTS = 100_000


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: ten hex digits are eight base32 digits."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*parts), BASE32_HEX_DIGITS, BASE32_DIGITS)


def record_id(key: Column) -> Column:
    """A stable record id drawn from the page's key."""
    digest = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit(""))))
    shape = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, shape, "$1-$2-$3-$4-$5"), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    return F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields])


def record_heads(rows: DataFrame, date: str) -> DataFrame:
    """Add ``head``: everything of a record before its payload.

    Expects id, url, n_bytes, sha1, keep_id, response (boolean).
    """
    kind = F.when(F.col("response"), "response").otherwise("revisit")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF),
        _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("n_bytes").cast("string"))),
        F.lit(CRLF),
    )
    length = F.length("http") + F.when(F.col("response"), F.col("n_bytes")).otherwise(0)
    refers = F.when(
        ~F.col("response"),
        _lines(("WARC-Refers-To", record_id(F.col("keep_id"))), ("WARC-Profile", F.lit(REVISIT_PROFILE))),
    ).otherwise("")
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _lines(
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(F.col("id"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", F.coalesce("url", F.lit(""))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ),
        refers,
        _lines(
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", length.cast("string")),
        ),
        F.lit(CRLF),
        F.col("http"),
    )
    return rows.withColumn("http", http).withColumn("head", head).drop("http")


@dataclass
class Archive:
    """Catalog names of an archive's tables."""

    spark: SparkSession
    payloads: str
    responses: str
    revisits: str

    def tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return tuple(self.spark.table(name) for name in (self.payloads, self.responses, self.revisits))

    def forget(self) -> None:
        """Drop the catalog entries; the files stay."""
        for name in (self.payloads, self.responses, self.revisits):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_archive(
    pages: DataFrame,
    steps: Steps,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> Archive:
    """Write every page as a response, or as a revisit of an equal payload's response.

    Payloads shorter than ``least_bytes`` are never revisits.
    """
    spark = pages.sparkSession
    # The bucket of a digest is the shuffle partition of its group: one file per bucket.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark = uuid.uuid4().hex
    archive = Archive(spark, *[f"warc_{mark}_{part}" for part in ("payloads", "responses", "revisits")])
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    full = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))

    def bucketed(rows: DataFrame, name: str) -> None:
        (
            rows.write.format("parquet")
            .option("compression", "zstd")
            .option("path", steps.path(name))
            .bucketBy(buckets, "digest")
            .sortBy("digest")
            .saveAsTable(name)
        )

    # Copies meet before the shuffle, so a payload that fills a third of the pages moves once per task.
    bucketed(full.groupBy("digest").agg(F.first("payload").alias("payload")), archive.payloads)
    rows = steps.keep(
        full.select(
            "id", "url", "digest", F.octet_length("payload").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1")
        )
    )
    keep = steps.keep(
        rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    )
    marked = lookup_join(rows, keep, "digest", "copies", BROADCAST_DIGESTS).withColumn(
        "response", F.col("id").eqNullSafe(F.col("keep_id")) | (F.col("n_bytes") < least_bytes)
    )
    heads = steps.keep(record_heads(marked, date).select("id", "digest", "head", "response", "keep_id"))
    responses = heads.filter("response").select("id", "digest", "head")
    bucketed(responses.repartition(buckets, "digest"), archive.responses)
    heads.filter("not response").select("id", "digest", "head", "keep_id").write.format("parquet").option(
        "path", steps.path(archive.revisits)
    ).saveAsTable(archive.revisits)
    steps.drop(rows, keep, heads)
    return archive


def response_records(archive: Archive) -> DataFrame:
    """(id, digest, payload, record): whole response records rebuilt beside their payloads."""
    payloads, responses, _ = archive.tables()
    record = F.concat(F.encode("head", "UTF-8"), F.col("payload"), F.lit(RECORD_END.encode()))
    return responses.hint("merge").join(payloads, "digest").select("id", "digest", "payload", record.alias("record"))


def revisit_records(archive: Archive) -> DataFrame:
    """(id, digest, keep_id, record): a revisit has a head and no payload of its own."""
    _, _, revisits = archive.tables()
    record = F.concat(F.encode("head", "UTF-8"), F.lit(RECORD_END.encode()))
    return revisits.select("id", "digest", "keep_id", record.alias("record"))


def read_archive(archive: Archive, steps: Steps) -> DataFrame:
    """Per record: id, payload_bytes, payload_digest, record_type, refers_to, record_bytes.

    The type comes from the record's own first lines; bytes and SHA-1 come from the stored
    payload, and a payload whose SHA-256 is not its key stops the job.
    """
    sound = F.assert_true(F.unhex(F.sha2("payload", 256)) == F.col("digest"), "a stored payload was altered")
    kind = F.regexp_extract(F.decode(F.substring("record", 1, 40), "ISO-8859-1"), r"WARC-Type: (\w+)", 1)
    found = steps.keep(
        response_records(archive)
        .withColumn("_sound", sound)
        .filter(F.col("_sound").isNull())
        .select(
            "id",
            "digest",
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            base32_sha1(F.col("payload")).alias("payload_digest"),
            kind.alias("record_type"),
            F.octet_length("record").cast("bigint").alias("record_bytes"),
        )
    )
    again = revisit_records(archive).select(
        "id", "digest", "keep_id", kind.alias("record_type"), F.octet_length("record").cast("bigint").alias("record_bytes")
    )
    counts = again.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    facts = found.groupBy("digest").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    known = steps.keep(counts.join(facts, "digest"))
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_bytes"]
    first = found.withColumn("refers_to", F.lit(None).cast(dict(again.dtypes)["keep_id"]))
    return first.select(columns).unionByName(
        lookup_join(again, known, "digest", "copies", BROADCAST_DIGESTS).withColumnRenamed("keep_id", "refers_to").select(columns)
    )
