"""The pipeline against its stages written out in plain Python."""

import re
from collections import Counter

import brute
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from hirelens.llm import mixing, quality_rules, queries


def test_registered():
    found = __spark_entry__.queries()
    assert [n for n in found if re.match(r"op\d+_", n)] == list(queries.queries())
    assert "pipeline" in found
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "decontamination", "mixing", "token_output"]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    weights = quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r.doc_id for r in quality_rules.assess(docs, weights).where("kept").collect()}
    assert all(not brute.base_rules(rows[i].text)[5] for i in kept)
    groups = brute.jaccard([(i, rows[i].text) for i in kept])
    kept = {i for i in kept if groups[i][1] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = brute.contamination([(i, rows[i].text) for i in kept], items)
    kept = sorted(i for i in kept if not dirty[i][4])
    mixed = mixing.curriculum(spark.createDataFrame([rows[i] for i in kept], docs.schema), whole=True)
    copies = {r.doc_id: r.n for r in mixed.select("doc_id", F.size("copies").alias("n")).collect()}
    assert all(r.taken == r.size * copies[r.doc_id] for r in mixed.collect())
    want, start = [], 0
    encoded = {i: brute.token_rows([(i, rows[i].text)], queries.tokenizer_path())[i][1:] for i in kept}
    order = [r.doc_id for r in mixing.training_order(mixed).collect()]  # of the curriculum
    assert Counter(order) == {i: n for i, n in copies.items() if n} and order != sorted(order)
    for i in order:
        want.append((i, start, *encoded[i]))
        start += encoded[i][0]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(want)


def test_tokens_in_the_order_of_the_files(spark, tmp_path):
    """Over many files, some of which go to one task or are split."""
    path = f"file://{tmp_path}/docs"
    order = [(k * 7919) % 1009 for k in range(1009)]
    df = spark.createDataFrame([(i, f"text number {i} " * (1 + i % 5), k) for k, i in enumerate(order)], "doc_id bigint, text string, k int")
    df.repartitionByRange(13, "k").sortWithinPartitions("k").drop("k").write.parquet(path)
    got = corpus_pipeline.tokens(spark, spark.read.parquet(path), "").orderBy("start").collect()
    assert [r.doc_id for r in got] == order
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_tokens_in_the_order_of_files_in_parts(spark, tmp_path):
    """Row groups of two files, dealt over tasks by their size and not by their place."""
    path = f"file://{tmp_path}/docs"
    df = spark.range(6000).selectExpr("(id * 7919) % 6007 as doc_id", "repeat(concat('word', id, ' '), cast(id % 37 as int)) as text", "id as k")
    df.repartitionByRange(2, "k").sortWithinPartitions("k").drop("k").write.option("parquet.block.size", 4096).option("parquet.page.size", 512).option("parquet.page.row.count.limit", 100).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "2k")
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() > 4
        got = corpus_pipeline.tokens(spark, docs, "").orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert [r.doc_id for r in got] == [k * 7919 % 6007 for k in range(6000)]
    assert [r.start for r in got[1:]] == [r.start + r.n_tokens for r in got[:-1]]


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.where("false"), sf_dir).count() == 0, name


def test_stages_carry_any_column(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.col("doc_id") for c in ("size", "kept", "n_words", "position", "words", "copies", "gone_id", "hit_starts", "quality")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.where("size <> doc_id or kept <> doc_id or copies <> doc_id or n_words <> doc_id or hit_starts <> doc_id").isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_stages_take_nulls_and_repeats(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    text = " ".join(f"w{k}x" for k in range(120)) + "."
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + " end", None, None, None), (None, text, "en", "b", 1), (3, None, None, None, None), (4, "", None, "", None), (5, "z " * 40_000, "en", "a", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() >= 0, name
    left = corpus_pipeline.STAGES[1][1](spark, docs, sf_dir)
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "3", "4", "5", "None"]
