"""The queries of this package: `(spark, sf_dir) -> DataFrame`, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyshelf.llm.common import ship_code
from tallyshelf.llm.decontaminate import q_decontaminate
from tallyshelf.llm.language import q_language
from tallyshelf.llm.licences import licences_sql, q_licences
from tallyshelf.llm.main_text import q_main_text
from tallyshelf.llm.order_minhash import q_near_duplicates
from tallyshelf.llm.packing import q_packing
from tallyshelf.llm.phrases import phrases_sql, q_phrases
from tallyshelf.llm.pieces import q_pieces
from tallyshelf.llm.pitman_yor import q_score
from tallyshelf.llm.prefix_trie import q_prefix_trie, trie_sql
from tallyshelf.llm.quality import q_quality
from tallyshelf.llm.repeats import q_repeats
from tallyshelf.llm.token_counts import q_token_counts


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return run(spark, sf_dir)

    return with_code


QUERIES = {name: _query(run) for name, run in {
    "op1_score": q_score,
    "op2_token_counts": q_token_counts,
    "op3_near_duplicates": q_near_duplicates,
    "op4_pieces": q_pieces,
    "op5_main_text": q_main_text,
    "op6_quality": q_quality,
    "op7_language": q_language,
    "op8_licences": q_licences,
    "op9_decontaminate": q_decontaminate,
    "op10_repeats": q_repeats,
    "op11_packing": q_packing,
    "op12_phrases": q_phrases,
    "op13_prefix_trie": q_prefix_trie,
}.items()}
ORACLES = {
    "op8_licences": licences_sql(),
    "op12_phrases": phrases_sql(),
    "op13_prefix_trie": trie_sql(),
}
