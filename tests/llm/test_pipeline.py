"""Registered corpus queries against SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, difference
from daybook.llm.queries import ORACLE, QUERIES
from tests.llm.test_duplicates import closure, distance, grams, plain_fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_stages_by_brute_force(spark):
    """Each stage over what the one before has kept, worked out by hand or by all pairs."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    benchmark = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    steps = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(steps[-1], docs.schema)
        out = stage(spark, frame, SMALL)
        assert out.columns == columns, name
        steps.append(out.collect())
    good, lined, single, clean = steps[1:]

    assert set(good) <= set(steps[0])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    right = sum((r["doc_id"] in kept) == bool(labels[r["doc_id"]]) for r in steps[0] if r["doc_id"] in labels)
    assert right >= 0.9 * sum(r["doc_id"] in labels for r in steps[0])

    places = sorted((r["doc_id"], i, line) for r in good for i, line in enumerate(r["text"].split("\n")) if line.strip())
    texts = sorted({p[2] for p in places})
    near = lambda i, j: min(len(texts[i]), len(texts[j])) >= 20 and abs(len(texts[i]) - len(texts[j])) <= 1 and (
        texts[i][: len(texts[i]) // 2 - 1] == texts[j][: len(texts[i]) // 2 - 1]
        or texts[i][-(len(texts[i]) // 2 - 1) :] == texts[j][-(len(texts[i]) // 2 - 1) :]
    ) and distance(texts[i], texts[j]) <= 1
    classes = dict(zip(texts, closure(len(texts), near), strict=True))
    seen, gone = set(), set()
    for doc, i, line in places:
        (gone if classes[line] in seen else set()).add((doc, i))
        seen.add(classes[line])
    want = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if (r["doc_id"], i) not in gone) for r in good}
    assert {r["doc_id"]: r["text"] for r in lined} == want

    marks = {r["doc_id"]: plain_fingerprint(r["text"], corpus_pipeline.SHINGLE) for r in lined}
    ids = sorted(marks)
    roots = closure(len(ids), lambda i, j: (marks[ids[i]] ^ marks[ids[j]]).bit_count() <= 3)
    assert {r["doc_id"] for r in single} == {ids[r] for r in roots}

    items = [grams(t) for t in benchmark]
    leaks = {r["doc_id"] for r in single if any(i and len(i & grams(r["text"])) >= 0.8 * len(i) for i in items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - leaks


def test_run_keeps_the_columns_and_adds_copy(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*spark.read.parquet(f"{SMALL}/documents.parquet").columns, "copy"]
    copies = out.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m")).collect()
    assert copies and all(r["n"] == r["m"] <= 3 for r in copies)
