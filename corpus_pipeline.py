"""From raw documents to token files: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps with the
columns of documents; the last returns what its files hold.

* quality rules: documents that the rules or the line labels reject go.
* near duplicates: one document of each group of linked ones stays, that of the smallest doc_id.
* decontamination: documents that contain a window of the benchmark go.
* mixing: documents are taken, left or repeated so that sources meet their target weights, each copy
  at its place in the curriculum.
* tokens: what is left is encoded and written as files of token ids, in the order in which mixing
  wrote the copies; documents that are not read from files stand in order of doc_id.

Edge cases, in every stage: an empty table gives an empty result. Nulls: a null or empty text fails the
rules, is no near duplicate, hits no benchmark, is never taken by the mix (its size is 0) and encodes to the
end id; a null doc_id is kept, as no duplicate of anything; a null source is a source of its own. Very long
texts are read whole. Ties: of linked rows with one smallest doc_id all stay; repeated rows are judged alike.
Further columns are carried through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from hirelens.llm import decontam, jaccard_join, mixing, quality_rules, token_store
from hirelens.llm.base import Scratch, discarded, table
from hirelens.llm.queries import tokenizer_path


CORE = ("doc_id", "text", "source")


def keeping_columns(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage on documents whose further columns have names of their own while it runs, whatever they are called."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe = {c: f"carried_{k}" for k, c in enumerate(docs.columns) if c not in CORE}
        out = stage(spark, docs.withColumnsRenamed(safe), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in safe.items()}).select(*docs.columns)

    return run


@keeping_columns
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.assess(docs, weights).where("kept").select(*docs.columns)


@keeping_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.representatives(docs)


@keeping_columns
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@keeping_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(mixing.curriculum(docs, whole=True)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.store(docs, tokenizer_path(), as_stored=token_store.is_stored(docs))


STAGES = [("quality_rules", rules), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontaminate), ("mixing", mix), ("token_output", tokens)]

#: Viterbi decoding and byte-pair encoding are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        with discarded():  # what the stage's operator wrote on its way
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop_all_but(name)
    return STAGES[-1][1](spark, docs, sf_dir)
