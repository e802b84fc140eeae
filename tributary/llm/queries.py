"""The queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tributary.llm.ann import op3_ann
from tributary.llm.bpe import op5_bpe
from tributary.llm.chat import OP7_SQL, op7_chat
from tributary.llm.knn import OP9_SQL, op9_topk
from tributary.llm.langid import op6_langid
from tributary.llm.licenses import op10_licenses
from tributary.llm.mixing import op4_mixing
from tributary.llm.quality import op8_quality
from tributary.llm.simhash import op2_simhash
from tributary.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_ann": op3_ann,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_langid": op6_langid,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_licenses": op10_licenses,
}

ORACLE: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op7_chat": OP7_SQL,
    "op9_topk": OP9_SQL,
}
