"""The registered queries of this package, each over its whole table.

An operator keeps its general interface; a query here chooses the production
parameters and shapes the columns that its contract names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobledger.llm import collocations, decontaminate, histogram, langid, neighbours, ngrams, packing, ring, simhash, toxicity, urls, warc, whitening
from jobledger.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"

# fixed values: the listed rules and their verdicts
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def fold(id_col: str, n: int) -> Column:
    """True for the ids that are held out of training: crc32 of the id's text
    divisible by n (null ids: never)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % n == 0, F.lit(False))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op1_kneser_ney")
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold("doc_id", 10).alias("held_out"))
    model = ngrams.train(docs.filter(~F.col("held_out")), order=3)
    return ngrams.score(docs, model, keep=("held_out",))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold("doc_id", 5).alias("held_out"))
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, most=3, blocks=2)


@query("op4_best_fit")
def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


@query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold("doc_id", 5).alias("held_out"))
    labels = table(spark, sf_dir, "labels").filter(~fold("doc_id", 5))
    return toxicity.score(docs, toxicity.train(docs, labels), keep=("doc_id", "held_out"))


@query("op6_ring")
def op6_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ring.assign(table(spark, sf_dir, "documents"), shards=16, virtual=128, slack=0.0)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)


@query("op9_url_filter", f"""
    WITH rules(rule, verdict) AS (VALUES {_RULE_ROWS}),
    parts AS (
        SELECT rule, verdict, split_part(rule, '/', 1) AS rh, substr(rule, length(split_part(rule, '/', 1)) + 1) AS rp FROM rules),
    rest AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    urls AS (
        SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
               regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    fits AS (
        SELECT u.page_id, p.rule, p.verdict, row_number() OVER (PARTITION BY u.page_id ORDER BY length(p.rule) DESC, length(p.rh) DESC) AS k
        FROM urls u JOIN parts p ON (u.host = p.rh OR ends_with(u.host, '.' || p.rh)) AND starts_with(u.path, p.rp))
    SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
    FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND f.k = 1""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS t(rule, verdict)")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op10_warc")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no capture time: one second for each page_id
    pages = table(spark, sf_dir, "pages").withColumn("date", F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))))
    index = warc.capture_index(pages, least_bytes=0)
    return index.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "date", "archive", "offset", "range", "place")


@query("op5_cross_polytope")
def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op11_least_squares")
def op11_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=1)


@query("op12_collocations", f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
    runs AS (SELECT lang, w, i, unnest([1, 2, 3]) AS size FROM places),
    counts AS (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
        FROM runs WHERE i + size - 1 <= len(w) GROUP BY ALL),
    words AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
    wide AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10),
    cut AS (
        SELECT lang, phrase, a, size, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM wide)),
    scored AS (
        SELECT c.*, x.f AS l, y.f AS r, (c.a::HUGEINT * c.a * 1000000) // (x.f::HUGEINT * y.f) AS score
        FROM cut c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
    longer AS (
        SELECT lang, phrase, max(a) AS most FROM (
            SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM wide WHERE size = 3
            UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM wide WHERE size = 3) GROUP BY ALL),
    kept AS (
        SELECT b.lang, b.phrase, b.a, b.l, b.r, w.n::BIGINT AS n, b.score::BIGINT AS score
        FROM best b JOIN words w ON w.lang = b.lang LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
        WHERE b.nth = 1 AND NOT coalesce(100 * g.most >= 50 * b.a, false))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"), most=3, least=10, scale=1_000_000, share_of=50)
    return collocations.top(found, 2000).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=16, steps=64, shift=1_000_000, weights="one")
