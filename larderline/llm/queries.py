"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larderline.llm import op1_sharding as op1
from larderline.llm import op4_line_dedup as op4
from larderline.llm import op7_minhash as op7
from larderline.llm import op9_exact_top_k as op9
from larderline.llm import op12_filter_audit as op12
from larderline.llm.op2_toxicity import op2_toxicity
from larderline.llm.op3_packing import op3_packing
from larderline.llm.op5_pii import op5_pii
from larderline.llm.op6_token_counts import op6_token_counts
from larderline.llm.op8_ann import op8_ann
from larderline.llm.op10_bpe import op10_bpe
from larderline.llm.op11_whitening import op11_whitening
from larderline.llm.op13_sentencepiece import op13_sentencepiece

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1.op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_line_dedup": op4.op4_line_dedup,
    "op5_pii": op5_pii,
    "op6_token_counts": op6_token_counts,
    "op7_minhash": op7.op7_minhash,
    "op8_ann": op8_ann,
    "op9_exact_top_k": op9.op9_exact_top_k,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12.op12_filter_audit,
    "op13_sentencepiece": op13_sentencepiece,
}

#: The other operators cannot be said in SQL (tokenizers, fitted models, an index); tests/llm holds them to brute force.
ORACLES: dict[str, str] = {
    "op1_sharding": op1.ORACLE,
    "op4_line_dedup": op4.ORACLE,
    "op7_minhash": op7.ORACLE,
    "op9_exact_top_k": op9.ORACLE,
    "op12_filter_audit": op12.ORACLE,
}
