"""The registered queries of the operators; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchpath.llm import divergence, merkle, mixing, packing, phrase_index, pii, quality_rules, simhash, suffix_dedup, suffix_tree, token_counts, vector_graph, warc
from touchpath.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
PII_KEY = "an example key, not a secret"
MIX_SEED = 42


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op5_pii_surrogates(spark, sf_dir):
    return pii.surrogate_report(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op6_source_mix(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"), MIX_SEED)


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op8_suffix_tree(spark, sf_dir):
    return suffix_tree.scored(table(spark, sf_dir, "documents"))


@query
def op1_warc_dictionary(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


ORACLE_SQL["op1_warc_dictionary"] = warc.ORACLE


@query
def op7_vector_graph(spark, sf_dir):
    return vector_graph.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_merkle_manifest"] = merkle.ORACLE


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.divergences(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_source_divergence"] = divergence.ORACLE


@query
def op11_phrase_index(spark, sf_dir):
    return phrase_index.decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_phrase_index"] = phrase_index.ORACLE
