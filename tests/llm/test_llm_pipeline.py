"""Registered queries and the pipeline on the given tables."""

import os
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from locusframe.llm import toxicity  # noqa: E402
from locusframe.llm.queries import QUERIES  # noqa: E402
from oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.oracle])
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), QUERIES[name].oracle) == ""


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        assert ids(out) <= ids(kept), name
        kept = spark.createDataFrame(out.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).toPandas()
    assert set(packed.doc_id) == ids(kept)
    run = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(zip(run.doc_id, run.piece, run.length, run.ids_crc32)) == sorted(zip(packed.doc_id, packed.piece, packed.length, packed.ids_crc32))


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    base = "the thing of the other that was with this and here they are going to be found in words again " * 2
    rows = [(1, base, "en", "s", 1), (1, base, "en", "s", 1), (2, base, "en", "s", 1), (None, base + "null id", "en", None, None), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "12 !", "en", "s", 4)]
    docs = spark.createDataFrame(rows, schema)
    named = dict(corpus_pipeline.STAGES)
    assert sorted(str(r.doc_id) for r in named["language"](spark, docs, SF).collect()) == ["1", "1", "2", "None"]
    kept = sorted(str(r.doc_id) for r in named["near_duplicates"](spark, docs, SF).collect())
    assert kept == ["1", "3", "4", "5", "None"]
    assert len(named["toxicity"](spark, docs, SF).collect()) == len(rows)
    assert len(named["decontamination"](spark, docs, SF).collect()) == len(rows)
    for stage in named.values():
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_toxicity_stage_drops_all_that_the_operator_predicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    lexicon = toxicity.train_lexicon(docs.select("doc_id", "text"), labels)
    insult = max((w, t) for (t, whole), w in lexicon.weights.items() if whole)[1]
    texts = [" ".join([insult] * k + ["plain"] * n) for k in (1, 2, 3) for n in range(1, 4000, 9)]
    between = next(t for t in texts if 0.3 <= lexicon.score(t) < 0.5)
    rows = spark.createDataFrame([(10**9, between, "en", "s", len(between))], docs.schema)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs.unionByName(rows), SF).select("doc_id").collect()}
    scored = toxicity.score_texts(docs, lexicon)
    assert kept == {r.doc_id for r in scored.where("predicted = 0").select("doc_id").collect()}


def test_null_and_repeated_ids_are_judged_by_their_texts(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.text and len(r.text.split()) > 12)
    other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "xy")
    rows = [(None, item), (1, item), (1, other), (2, third), (2, other), (None, third), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], schema)
    named = dict(corpus_pipeline.STAGES)
    got = lambda stage: sorted(((r.doc_id, r.text) for r in named[stage](spark, docs, SF).collect()), key=str)
    assert got("decontamination") == sorted(rows[2:], key=str)
    assert got("near_duplicates") == sorted([(1, item), (1, other), (2, third), (None, item), (None, third), (None, None)], key=str)


def test_stages_leave_columns_of_any_name_alone(spark):
    clashes = {c: F.lit(f"own {c}") for c in ("score", "predicted", "lang_pred", "known", "_row", "row", "number", "component_id", "_found", "kept", "_p")}
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(clashes)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in clashes), name


def test_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = spark.createDataFrame([(10**9 + i, " ".join(chr(0x10A0 + (i * 7 + k * k) % 38) * 3 for k in range(80)), None, "s", 0) for i in range(5)], docs.schema)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(strange), SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}


def test_texts_reach_python_in_batches_bounded_by_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20_000).alias("text"), F.lit("aa").alias("lang"))
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []
    sizes = docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) >= 60_000_000 and max(r.n for r in sizes) <= 8_000_000
