"""The registered queries of this package and their SQL, and the pipeline over documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from aerostrata.llm import (
    chat, collocations, histogram_packing, html_tree, line_winnow, near_simhash, near_vectors, packing, piece_dropout, quality_lines, sharding,
    token_align, url_reputation,
)

Query = Callable[[SparkSession, str], DataFrame]


def _utc(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Query]:
    queries = [
        near_vectors.op1_cross_polytope_near_dedup, line_winnow.op2_line_winnowing, quality_lines.op3_quality_lines,
        url_reputation.op4_url_reputation, piece_dropout.op5_merge_dropout, packing.op6_swap_packing,
        near_simhash.op7_simhash_near_dedup, chat.op8_chat_events, html_tree.op9_html_tree_model,
        sharding.op10_stratified_shards, token_align.op11_pointer_alignment, collocations.op12_fm_collocations,
        histogram_packing.op13_shortest_pack_first, pipeline,
    ]
    return {q.__name__: _utc(q) for q in queries}


def llm_oracles() -> dict[str, str]:
    return {
        "op1_cross_polytope_near_dedup": near_vectors.oracle(),
        "op3_quality_lines": quality_lines.oracle(),
        "op4_url_reputation": url_reputation.oracle(),
        "op8_chat_events": chat.oracle(),
        "op12_fm_collocations": collocations.oracle(),
    }
