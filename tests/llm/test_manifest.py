"""The Merkle manifest against a plain one, and proofs that show a change."""

import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from hirelens.llm import merkle_manifest, queries

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def run(spark, rows, tmp_path):
    """The query over these rows, with further columns of names that are used inside."""
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("tree", "place", "many", "hash", "claimed", "salt", "path", "sides", "members")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def test_documents(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    rows = con.sql("select doc_id, source, lang, n_chars, text from documents").fetchall()
    got = sorted(tuple(r) for r in queries.op11_merkle_manifest(spark, sf_dir).collect())
    assert got == sorted(brute.merkle(rows)) == sorted(con.sql(queries.OP11_ORACLE).fetchall())
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("span", [1, 2, 4])
def test_trees_of_all_heights(spark, tmp_path, span, monkeypatch):
    """Langs of 1, 8, 9, 65 and 600 leaves: the top of the last is four levels up."""
    monkeypatch.setattr(merkle_manifest, "SPAN", span)
    rng = random.Random(span)
    langs = [x for lang, n in ((None, 1), ("a", 8), ("é", 9), ("Z", 65), ("", 600)) for x in [lang] * n] + [f"l{k}" for k in range(70)]
    rng.shuffle(langs)
    rows = [(k * 7 - 900, None if k % 5 == 0 else f"s{k}", lang, k, f"Text {k} É") for k, lang in enumerate(langs)]
    assert run(spark, rows, tmp_path) == sorted(brute.merkle(rows), key=str)


def test_edges(spark, tmp_path):
    """Nulls in any field, empty texts, one doc_id twice, equal rows, and a text of 2 MB."""
    rows = [(None, None, None, None, None), (1, "", "", 0, ""), (1, "a", "", 0, "B"), (3, "a", "", 0, "ABC"), (3, "a", "", 0, "ABC"), (4, "a", "x", 2, "Ab" * 1_000_000), (-5, "a", "x", None, None)]
    got = run(spark, rows, tmp_path)
    assert got == sorted(brute.merkle(rows), key=str) and len(got) == len(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_a_changed_row_is_told(spark):
    """Only rows that somebody has otherwise fold to another root; the manifest itself does not change."""
    docs = spark.createDataFrame([(k, "s", "en", k, f"t{k}") for k in range(100)], SCHEMA)
    fields = [F.col(c) for c in merkle_manifest.FIELDS]
    claims = [*fields[:4], F.when(F.col("doc_id") == 42, "forged").otherwise(F.col("text"))]
    rows = merkle_manifest.verify(merkle_manifest.manifest(docs, fields, claims)).collect()
    assert [r.doc_id for r in rows if not r.verified] == [42] and len({r.root for r in rows}) == 1
    assert all(r.verified for r in merkle_manifest.verify(merkle_manifest.manifest(docs)).collect())
