"""URL filters: a blocked Bloom filter before an exact hash join.

A listed rule is a host and the beginning of a path; its canonical form is
both joined, the host in lower case. A URL's possible rules are its host and
all parent domains, each with the beginnings of its path that have the length
of some rule's. The filter has one 64-bit block for each slot of a fixed
number; a rule sets four bits of one block. Candidates whose bits are all set
pass to an exact join with the list, which removes the false ones. The
filter's size is a parameter and does not grow with the data; a list too long
for it lets more candidates through, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKS = 1 << 16


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    h = F.xxhash64(key, F.lit("bits"))
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return one(0).bitwiseOR(one(1)).bitwiseOR(one(2)).bitwiseOR(one(3))


def _parents(h: Column) -> Column:
    """A host and its parent domains."""
    labels = F.split(h, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", blocks: int = BLOCKS) -> DataFrame:
    """``id_col``, host, path, rule, verdict for every row of ``pages``.

    ``rules``: columns rule (host and path, as ``example.net/en/``) and
    verdict. A rule fits its host and all subdomains if the path starts with
    the rule's; the longest rule wins, of equally long ones the longer host,
    then the verdict that sorts last. Without a rule the verdict is
    ``default``. Equal URLs are judged once.
    """
    listed = rules.select(F.col("rule"), F.col("verdict"), F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("_host"))
    listed = listed.withColumn("_path", F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)"))
    listed = listed.select("rule", "verdict", F.concat("_host", "_path").alias("_key"), F.length("_host").alias("_hosts"), F.length("_path").alias("_paths")).dropna()
    lengths = sorted(r["_paths"] for r in listed.select("_paths").distinct().collect())
    filter_ = listed.groupBy(_block(F.col("_key"), blocks).alias("_block")).agg(F.bit_or(_bits(F.col("_key"))).alias("_set"))

    urls = pages.select(id_col, host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    heads = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in lengths or [0])), lambda x: x.isNotNull())
    keys = F.flatten(F.transform(_parents(F.col("host")), lambda h: F.transform(heads, lambda p: F.concat(h, p))))
    once = urls.select("host", "path").distinct()
    candidates = once.select("host", "path", F.explode(keys).alias("_key"))
    candidates = candidates.withColumn("_block", _block(F.col("_key"), blocks)).withColumn("_bits", _bits(F.col("_key")))
    passed = candidates.join(F.broadcast(filter_), "_block").filter(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    hits = passed.select("host", "path", "_key").join(listed, "_key")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("_key").alias("n"), F.col("_hosts"), F.col("verdict"), F.col("rule"))).alias("_best"))
    judged = best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict"))
    out = urls.join(judged, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return out.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
