import random

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.corpus import frame, texts
from tidemark.llm.queries import QUERIES


def test_stages_and_registration():
    assert sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0])) == [q for q in QUERIES] and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_whole_pipeline(spark, tmp_path):
    rnd = random.Random(3)
    good = [" ".join(f"good{rnd.randrange(400)}" for _ in range(60)) for _ in range(120)]
    junk = [" ".join(f"$$${rnd.randrange(40)}" for _ in range(60)) for _ in range(40)]
    leak = " ".join(f"good{399 - k}" for k in range(20))
    passage = " ".join(f"good{k}" for k in range(60))
    rows = [*good, *junk, good[0], good[1] + " more", good[2] + " " + leak, good[3][: len(good[3]) // 3] + " " + passage, good[4][: len(good[4]) // 3] + " " + passage, None, ""]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i < 120), 0) for i in range(160)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/stage-{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage-{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    first, second, third, fourth, last = seen.values()
    assert set(range(120)) <= set(first) and not set(range(120, 160)) & set(first)
    assert {160, 161} <= set(first) and not {160, 161} & set(second)
    assert passage in first[163].text and all("good30 good31" not in third[k].text for k in (163, 164))
    assert 162 in third and 162 not in fourth
    assert set(last) == set(fourth) and last[166].n_tokens == 0 if 166 in fourth else True
    assert {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == last


def test_queries_run_on_small_tables(spark):
    for name, query in QUERIES.items():
        got = query(spark, "/root/testdata/sf0.001")
        assert got.count() > 0, name
    assert texts(1)


def test_whole_pipeline_on_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
