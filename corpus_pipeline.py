"""The training-data pipeline over ``documents``: STAGES, each calling one operator of
``snapfacet.llm``, and ``run``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``; all but the last return the columns of ``documents``. Each stage
works on all that the one before has kept. Null or empty texts are clean, unlinked but for other
empty texts (equal fingerprints), without repeats or benchmark passages, and are packed as their
end id. Rows with equal ids are judged each by itself, and of equal rows the copies go with the
near-duplicates. Empty tables give empty results; further columns are handed on.

No DuckDB SQL can express the stages (a trained score, components, automata, tokens), so ORACLE_SQL
is None and ``tests/llm/test_pipeline.py`` holds ``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapfacet.llm import toxicity
from snapfacet.llm.benchmark_decontamination import decontaminate
from snapfacet.llm.packing import pack
from snapfacet.llm.simhash import near_duplicates
from snapfacet.llm.suffix_dedup import suffix_dedup
from snapfacet.session import apply_conf, ensure_checkpoint_dir, table

ORACLE_SQL = None


def _as(docs: DataFrame, found: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` in their order, with a new text."""
    columns = [(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    return found.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents predicted toxic go. Learnt from the labelled rows, held-out ones
    left out."""
    apply_conf(spark)
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return _as(docs, scored.where(F.col("score") < toxicity.THRESHOLD), F.col("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each component of SimHash links one document stays, that with the smallest
    id (a null id only where the component has no other)."""
    apply_conf(spark)
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))
    keyed = docs.withColumn("_key", key)
    found = near_duplicates(keyed.select("doc_id", "_key", "text"), shingle_words=4, max_bits=4)
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("row._key"))
    first = found.groupBy("component").agg(F.min_by("row._key", order).alias("_key"))
    kept = keyed.join(first, "_key", "left_semi")
    # equal rows have equal keys: one of them stays
    once = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return kept.withColumn("_n", once).where("_n = 1").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: passages of 50 words or more that a document with a smaller id has too are
    taken out; ``n_chars`` follows where a text has changed."""
    apply_conf(spark)
    found = suffix_dedup(docs, min_words=50)
    if "n_chars" not in docs.columns:
        return _as(docs, found, F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    columns = {"text": F.col("text"), "n_chars": chars}
    return found.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents with at least a twentieth of their words in benchmark windows go."""
    apply_conf(spark)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), min_share=0.05)
    return _as(docs, found, F.col("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: sequences of 2048 tokens, one row per piece."""
    apply_conf(spark)
    out = pack(docs)
    rest = [F.col("row")[c].alias(c) for c in docs.columns if c == "doc_id"]
    return out.select(*rest, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared checkpoint folder
    and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{spark.sql('SELECT uuid()').first()[0]}"
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
