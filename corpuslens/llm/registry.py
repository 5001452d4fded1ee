"""The queries of this subpackage and their SQL counterparts."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm import bpe, chat_format, context_tree, credentials, language_id, line_quality, neighbours, ngram_join, packing, phrase_mining, stream_dedup, url_filter, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": chat_format.query,
        "op2_context_tree": context_tree.query,
        "op3_ngram_join": ngram_join.query,
        "op4_line_quality": line_quality.query,
        "op5_stream_dedup": stream_dedup.query,
        "op6_url_filter": url_filter.query,
        "op7_language_id": language_id.query,
        "op8_bpe": bpe.query,
        "op9_credentials": credentials.query,
        "op10_packing": packing.query,
        "op11_phrases": phrase_mining.query,
        "op12_neighbours": neighbours.query,
        "op13_whitening": whitening.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat_format.ORACLE_SQL,
        "op5_stream_dedup": stream_dedup.ORACLE_SQL,
        "op6_url_filter": url_filter.ORACLE_SQL,
        "op11_phrases": phrase_mining.ORACLE_SQL,
    }
