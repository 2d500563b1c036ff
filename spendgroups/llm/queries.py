"""One query per operator, on its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.llm.bpe import bpe_digest
from spendgroups.llm.jaccard import jaccard_components
from spendgroups.llm.lattice import near_duplicates
from spendgroups.llm.mixing import mix_sources
from spendgroups.llm.neighbours import nearest_neighbours
from spendgroups.llm.periodic import runs_digest
from spendgroups.llm.phrases import phrase_collocations
from spendgroups.llm.pii import pii_digest
from spendgroups.llm.ppm import language_ids
from spendgroups.llm.secret_scan import secrets_digest
from spendgroups.llm.tables import importable, table
from spendgroups.llm.tokencount import token_counts
from spendgroups.llm.topk import top_products
from spendgroups.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_pii(spark, folder):
    return pii_digest(table(spark, folder, "documents"))


@query
def op2_secrets(spark, folder):
    return secrets_digest(table(spark, folder, "documents"))


@query
def op3_neighbours(spark, folder):
    asks = F.col("vec_id") % 20 == 0
    return nearest_neighbours(table(spark, folder, "embeddings"), asks)


@query
def op4_language(spark, folder):
    return language_ids(table(spark, folder, "documents"))


@query
def op5_near_vectors(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"))


@query
def op6_bpe(spark, folder):
    return bpe_digest(table(spark, folder, "documents"))


@query
def op7_mixing(spark, folder):
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_toxicity(spark, folder):
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_jaccard(spark, folder):
    return jaccard_components(table(spark, folder, "documents"))


@query
def op10_token_counts(spark, folder):
    return token_counts(table(spark, folder, "documents"))


@query
def op11_periodic_runs(spark, folder):
    return runs_digest(table(spark, folder, "documents"))


@query
def op12_phrases(spark, folder):
    return phrase_collocations(table(spark, folder, "documents"))


@query
def op13_top_products(spark, folder):
    return top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
