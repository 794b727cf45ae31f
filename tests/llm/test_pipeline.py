"""The pipeline's stages on documents with known faults, and every registered query on a small table."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowtable.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages_are_in_order_and_registered():
    from __spark_entry__ import queries

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "packing"]
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns(
        {"lang_pred": F.lit("x"), "kept": F.lit(1), "row": F.lit(2), "n": F.lit(3), "a.b": F.lit(4)})
    clean = "the quick brown fox and the lazy dog were seen on the road to the old town by many of the people who live there"
    rows = [(10_001, None, "en"), (10_002, "1234 5678 !!! ???", None), (10_003, "few words", "en"), (10_004, clean, "en"),
            (10_005, clean.upper(), "en"), (10_006, clean + " today", None), (None, clean, "en"), (10_004, clean, "en")]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.unionByName(extra, allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_each_stage_takes_effect_and_keeps_columns(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, planted), name)
        seen[name] = sorted(r[0] for r in docs.select("doc_id").where("doc_id > 10000").collect())
        if name != "packing":
            assert docs.columns == columns
    assert seen["language_id"] == [10_003, 10_004, 10_004, 10_005, 10_006]
    assert seen["quality_rules"] == [10_004, 10_004, 10_005, 10_006]
    assert seen["near_duplicates"] == [10_004]
    assert seen["packing"].count(10_004) >= 1


def test_one_row_of_each_text_stays_whatever_its_id(spark):
    a, b, c = "a passage that three rows have in common", "before all others but only once", "copies without any id at all here"
    rows = [(7, a), (3, a), (7, b), (None, a.upper()), (None, c), (None, c), (5, c + " and more words"), (None, "said only here and by nobody"),
            (9, ""), (9, None), (None, ""), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.remove_near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got if (r["text"] or "").strip()) == [
        (0, c), (0, "said only here and by nobody"), (3, a), (5, c + " and more words"), (7, b)]
    assert sorted(r["doc_id"] or 0 for r in got if not (r["text"] or "").strip()) == [0, 0, 9]


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    kept = corpus_pipeline.apply_quality_rules(spark, corpus_pipeline.identify_language(spark, docs, SMALL), SMALL)
    base_failed = QUERIES["op9_decision_list"](spark, SMALL).where("base_failed").select("doc_id")
    lost = good.join(kept, "doc_id", "left_anti").join(base_failed, "doc_id", "left_anti").count()
    assert lost <= 0.02 * good.count()


def test_pipeline_on_no_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


#: Runs a stage's map over texts of 16 MB as a task of a worker of its own, and what follows it there without rows; prints
#: the MB that Arrow still keeps for later.
WORKER = """
import random, re, sys
import pyarrow as pa
import public_tokenizers
from flowtable.llm import langid, packing

def resident():
    return int(re.search(r"Pss_Anon: *([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

runs = {"tokenize": packing._tokenize(public_tokenizers.path("word_bpe_49k.json"), 4096), "describe": langid._describe}
behind = {"tokenize": packing._pack(None, 1.0, 4096)}  # a later stage in the same worker
draw = random.Random(0)
words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(2000)]
texts = [" ".join(draw.choices(words, k=230)) for _ in range(10_000)]
table = pa.table({"doc_id": list(range(10_000)), "text": texts, "lang": ["en"] * 10_000})
sink = pa.BufferOutputStream()
with pa.ipc.new_stream(sink, table.schema) as out:
    out.write_table(table)
data = sink.getvalue().to_pybytes()
del sink, out, table, texts
pa.default_memory_pool().release_unused()
for batch in runs[sys.argv[1]](pa.ipc.open_stream(data)):
    pass
del batch
for batch in behind.get(sys.argv[1], iter)(iter([])):
    pass
before = resident()
pa.default_memory_pool().release_unused()
print(before - resident())
"""


@pytest.mark.parametrize("stage", ["tokenize", "describe"])
def test_workers_keep_no_unused_memory_after_a_task(stage):
    top = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    env = {**os.environ, "PYTHONPATH": top + os.pathsep + os.environ.get("PYTHONPATH", "")}
    out = subprocess.run([sys.executable, "-c", WORKER, stage], env=env, capture_output=True, text=True, check=True, timeout=300)
    assert float(out.stdout) < 16
