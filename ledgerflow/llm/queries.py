"""The subpackage's registered queries and, where SQL expresses one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm.op10_suffix_dedup import op10_suffix_dedup
from ledgerflow.llm.op11_token_files import op11_token_files
from ledgerflow.llm.op12_merkle import ORACLE_SQL as MERKLE_SQL, op12_merkle
from ledgerflow.llm.op13_spelling import op13_spelling
from ledgerflow.llm.op1_secrets import op1_secrets
from ledgerflow.llm.op2_topk import ORACLE_SQL as TOPK_SQL, op2_topk
from ledgerflow.llm.op3_hilbert import op3_hilbert
from ledgerflow.llm.op4_ngram_jaccard import op4_ngram_jaccard
from ledgerflow.llm.op5_language import op5_language
from ledgerflow.llm.op6_url_ratio import op6_url_ratio
from ledgerflow.llm.op7_decontaminate import op7_decontaminate
from ledgerflow.llm.op8_ngram_trie import op8_ngram_trie
from ledgerflow.llm.op9_sentencepiece import op9_sentencepiece

Run = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Run]:
    found = [op1_secrets, op2_topk, op3_hilbert, op4_ngram_jaccard, op5_language, op6_url_ratio, op7_decontaminate, op8_ngram_trie, op9_sentencepiece, op10_suffix_dedup, op11_token_files, op12_merkle, op13_spelling]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": TOPK_SQL, "op12_merkle": MERKLE_SQL}
