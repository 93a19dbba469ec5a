"""WARC archives and a globally ordered capture index.

Writing: every capture is one WARC/1.0 record; of captures with equal
payloads one is the response and the others are revisit records without the
payload. Archives are compressed text files of Spark's writer, since records
end with a fixed separator (offsets count uncompressed bytes); a task sorts its captures by URL key and time, so
each archive holds a locally sorted run. Reading frames records by
Content-Length alone, whatever a payload holds. Indexing is an external merge:
the runs are cut at sampled keys by range, and each range's k slices of runs
are merged by a loser tree, which gives every capture its place in its URL's
history and in the whole index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.llm.store import shared_path

ARCHIVE_BYTES = 32 << 20  # aim for an archive
LINE = "\r\n"


class LoserTree:
    """Merges k sorted iterators; an inner node keeps the loser of its match,
    so a new item of the winner's run is compared along one path only."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i, True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or x == y and a < b

    def _play(self, i: int, first: bool = False) -> None:
        node = (i + self.k) // 2
        while node:
            if first and self.losers[node] < 0:
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while True:
            i = self.losers[0]
            if self.heads[i] is None:
                return
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self._play(i)


def url_key(url):
    """Sort key: host labels from the last on, then the rest in lower case
    (``http://www.a.org/x`` -> ``org,a)/x``; a leading ``www.`` goes)."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^www\d*\.", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def clean_url(url):
    """A URL as a record's header holds it, without line ends (null: empty).
    Runs are sorted by the key of this form."""
    return F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\r\n]", "")


def warc_date():
    """A capture's time as its record holds it, in whole seconds."""
    return F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _base32(hex_digest):
    """Base 32 of 20 bytes given as 40 hex digits: 5 bits each, 4 groups of 10
    digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [F.conv(F.substring(hex_digest, 1 + 10 * g, 10), 16, 10).cast("long") for g in range(4)]
    index = lambda g, k: F.shiftright(groups[g], 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int") + 1
    return F.concat(*(F.substring(F.lit(letters), index(g, k), F.lit(1)) for g in range(4) for k in range(8)))


def classify(pages: DataFrame, id_col: str, url_col: str, payload_col: str, date_col: str, least_bytes: int) -> DataFrame:
    """Captures with payload, digest and refers_to (null: a response).

    Which capture of a payload is the response is found on ids and digests
    alone; payloads move once, to their archive's task."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), clean_url(F.col(url_col)).alias("url"), F.col(date_col).alias("date"), payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1(F.encode("payload", "UTF-8")))
    narrow = rows.filter(F.col("bytes") >= least_bytes).select(F.col("id").alias("_id"), "sha", "bytes").distinct()
    last = narrow.groupBy("sha", "bytes").agg(F.max("_id").alias("_last"))
    older = narrow.join(last, ["sha", "bytes"]).filter(~F.col("_id").eqNullSafe(F.col("_last")))
    older = older.select("_id", F.col("sha").alias("_sha"), "_last")
    joined = rows.join(older, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left")
    return joined.select("id", "url", "date", "bytes", _base32(F.col("sha")).alias("digest"), F.col("_last").alias("refers_to"),
                         F.when(F.col("_last").isNull(), F.col("payload")).alias("payload"))


def _record(kind: str):
    """One record's text, without the two line ends that follow it."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(LINE * 2))
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    lines = [("WARC-Type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
             ("WARC-Record-ID", F.concat(F.lit(f"<urn:{kind}:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
             ("WARC-Date", warc_date()), ("WARC-Target-URI", F.col("url")),
             ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
             ("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"<urn:{kind}:"), F.col("refers_to").cast("string"), F.lit(">")))),
             ("WARC-Profile", F.when(F.col("refers_to").isNotNull(), "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
             ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", F.octet_length(block).cast("string"))]
    head = F.concat(F.lit(f"WARC/1.0{LINE}"), *(F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(LINE)), F.lit("")) for k, v in lines), F.lit(LINE))
    return F.concat(head, block)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date_col: str = "date",
          least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, kind: str = "page") -> None:
    """Write gzip archives of at most as many records as make about
    ``archive_bytes`` of text to ``path``. Of captures with
    equal payloads of at least ``least_bytes`` the one with the largest id is
    the response; smaller payloads are all responses. Null payloads are empty,
    null URLs too; line ends go from URLs. No rows make an empty folder."""
    size = F.octet_length(F.col(payload_col).cast("string"))
    n, total = pages.agg(F.count(F.lit(1)), F.sum(size)).first()
    records_each = max(1, int(archive_bytes // (600 + (total or 0) / max(n, 1))))
    rows = classify(pages, id_col, url_col, payload_col, date_col, least_bytes)
    runs = rows.sortWithinPartitions(url_key(F.col("url")), warc_date(), "id")
    lines = runs.select(_record(kind)).write.option("lineSep", LINE * 2).option("maxRecordsPerFile", records_each)
    lines.option("compression", "gzip").text(path)


def records(content: bytes):
    """(offset, headers, block) of each record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split(LINE)
        if lines[0] != "WARC/1.0":
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield at, head, content[start:stop]
        at = stop + 4


def read(spark, path: str, id_type: str = "long") -> DataFrame:
    """Captures of the archives in ``path``: archive, offset, id, url, date,
    payload_bytes, payload_digest, record_type, refers_to. A response's length
    and digest come from its payload, a revisit's from its headers."""

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                content, rows = gzip.decompress(content), []
                for offset, head, block in records(content):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = head["WARC-Type"] == "revisit"
                    size = int(http.rpartition(b"Content-Length: ")[2]) if revisit else len(payload)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    number = lambda k: head.get(k, "").strip("<>").rpartition(":")[2] or None
                    rows.append((name, offset, number("WARC-Record-ID"), head["WARC-Target-URI"], head.get("WARC-Date", ""), size, digest, head["WARC-Type"], number("WARC-Refers-To")))
                yield pd.DataFrame(rows, columns=names)

    names = ["archive", "offset", "id", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    # an archive is one row, so a batch holds one at a time
    out = files.mapInPandas(run, "archive string, offset long, id string, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return out.withColumn("id", F.col("id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def merge(captures: DataFrame, carry: tuple = ("id", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset")) -> DataFrame:
    """The captures in the index's order, one output partition per range of
    keys: the carried columns, url_key, range and place (in the range).

    A run is one archive's captures in the archive's order; one that is not
    sorted is an error. No captures give no rows. The order is by
    URL key, date, id, archive and offset, so ranges also part the captures of
    a single URL."""
    keyed = captures.select(*carry, url_key(F.col("url")).alias("url_key"))
    order = ["url_key", "date", "id", "archive", "offset"]
    parts = max(1, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id())
    slices = ranged.sortWithinPartitions("archive", "offset")
    fields = ", ".join(f"`{c}` {t}" for c, t in slices.dtypes)
    columns = slices.columns

    def run(batches):
        pdf = pd.concat(list(batches) or [pd.DataFrame(columns=columns)], ignore_index=True)
        if not len(pdf):
            return
        low = pdf["id"].isna()
        keys = list(zip(pdf["url_key"], pdf["date"], (~low).tolist(), pdf["id"].where(~low, 0), pdf["archive"], pdf["offset"], range(len(pdf))))
        runs = [[keys[i] for i in at] for _, at in pdf.groupby("archive", sort=False).indices.items()]
        for own in runs:
            if any(a[:4] > b[:4] for a, b in zip(own, own[1:])):
                raise ValueError(f"the archive of {own[0][4]} is no sorted run")
        at = [k[-1] for k in LoserTree(runs)]
        out = pdf.iloc[at]
        for k in range(0, len(out), 10_000):
            yield out.iloc[k: k + 10_000].assign(place=range(k, min(k + 10_000, len(out))))

    return slices.mapInPandas(run, f"{fields}, place long")


def capture_index(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date_col: str = "date", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives below ``spark.checkpoint.dir``, read them
    back and merge their runs. No pages give an empty index."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path, id_col, url_col, payload_col, date_col, least_bytes)
    return merge(read(spark, path, dict(pages.dtypes)[id_col]))
