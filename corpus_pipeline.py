"""The corpus pipeline: documents to packed training sequences, stage by stage."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import decontam, langid, ngram_join, packing, toxicity
from locusframe.llm.common import bounded_broadcast, stored, table
from locusframe.plans.registry import Query
from locusframe.session import prepare


BATCH_BYTES = "4m"


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows as one column beside what the stages read, so that no column of theirs meets one of the input."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The input's own columns again."""
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letter at all, or too few character n-grams that any learned language has.

    Learned from the documents' own ``lang``; the least share of known n-grams is half of what 99 of 100 labelled texts reach. A null
    text has no language. Without any known language all documents with letters stay. Columns of any name stay as they are.
    """
    model = langid.train_language_model(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(_packed(docs), model)
    return _unpacked(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("known") >= model.least_known)), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the operator itself predicts toxic, by a lexicon learned from ``labels``.

    Null and empty texts stay. Columns of any name stay as they are.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    lexicon = toxicity.train_lexicon(docs.select("doc_id", "text"), labels)
    if not lexicon.weights:
        return docs
    return _unpacked(toxicity.score_texts(_packed(docs), lexicon).where("predicted = 0"), docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """The packed rows with a number of their own, written so that it stays."""
    return stored(_packed(docs).drop("doc_id", "text").withColumn("number", F.monotonically_increasing_id()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group linked by a Jaccard similarity of 0.8 of five-word runs.

    Rows that repeat an id are judged by their texts. Rows without an id or without words stay. Columns of any name stay as they are.
    """
    rows = _numbered(docs)
    texts = rows.select("number", "row.doc_id", "row.text")
    groups = stored(ngram_join.jaccard_components(texts.where("doc_id is not null"), n=5, num=80, den=100, id_col="number").select("number", "component_id"))
    order = F.struct("doc_id", "number")
    shared = groups.where("number <> component_id").select("component_id").distinct()
    members = groups.join(shared, "component_id").join(texts.select("number", "doc_id"), "number")
    kept = members.groupBy("component_id").agg(F.min(order).getField("number").alias("kept"))
    dropped = stored(members.select("number", "component_id").join(kept, "component_id").where("number <> kept").select("number"))
    return _unpacked(rows.join(bounded_broadcast(dropped), "number", "left_anti"), docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold at least half of the words of a benchmark item in tiles, each row by its own text.

    Columns of any name stay as they are.
    """
    rows = _numbered(docs)
    texts = rows.select("number", "row.text")
    found = decontam.contaminated(texts, table(spark, sf_dir, "benchmark"), id_col="number").select(F.col("doc_id").alias("number"))
    return _unpacked(rows.join(bounded_broadcast(stored(found.distinct())), "number", "left_anti"), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 4096 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"))


def _prepared(stage):
    """The stage on a session that has the library's settings and code, and sends texts to Python in batches bounded by bytes.

    Spark bounds a batch by rows first; 10,000 whole texts are held several times over, in the executor and in each Python worker.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _prepared(stage)) for name, stage in (
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_text),
    ("packing", pack_sequences),
)]

# The first two stages rest on trained models and the last on a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": Query(run, ORACLE_SQL)}
