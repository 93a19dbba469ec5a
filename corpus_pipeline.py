"""A corpus pipeline of five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet below ``spark.checkpoint.dir`` and gives the
reread rows to the next, so that a lost executor costs one stage's tasks at
most. All stages but the last keep whole rows of ``documents`` with its
columns; the last returns one row for each packed piece.

Nulls: a null text is scored like an empty one by the first stage and goes in
the second, where it has no letter. Repeated rows count as copies in the
third stage, which keeps one. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobledger.llm import decontaminate, langid, packing, simhash, toxicity
from jobledger.llm.catalog import fold, tokenizer_path
from jobledger.llm.store import shared_path
from jobledger.sources.tables import table

# a text that its best language's model makes so many bits longer than its
# bytes are fits no learned language
EXCESS_BITS = 64


def whole(docs: DataFrame, *others) -> DataFrame:
    """Rows as one column ``doc`` beside ``others``, so that no column of a
    document clashes with what an operator adds."""
    return docs.select(F.struct(*docs.columns).alias("doc"), *others)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from the
    labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~fold("doc_id", 5))
    model = toxicity.train(docs, labels)
    return toxicity.score(whole(docs, "text"), model, keep=("doc",)).filter("predicted = 0").select("doc.*")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: with a letter, and not such that even
    the best language's model codes them in more bits than their bytes have.
    One that fits several languages alike stays."""
    model = langid.train(docs.filter(~fold("doc_id", 5)))
    found = langid.identify(whole(docs, "text"), model, keep=("doc",))
    excess = (F.col("bits_per_byte") - 8) * F.octet_length("doc.text")
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (excess <= EXCESS_BITS)).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group; of
    repeated rows, one. Documents without an id come after all others and are
    told apart by their text."""
    no_id = F.col("doc_id").isNull()
    key = [no_id.alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("h")]
    names = ["none", "id", "h"]
    groups = simhash.near_duplicates(docs.select("text", F.struct(*key).alias("row")), id_col="row", size=3, most=3, blocks=2)
    kept = groups.filter("row = component_id").select("row.*").distinct()
    return whole(docs, *key).dropDuplicates(names).join(kept, names, "left_semi").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

# the classifier, the byte model, the tokenizer and the trees have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
