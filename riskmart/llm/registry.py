"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from riskmart.llm.langid import op4_langid
from riskmart.llm.licenses import op6_licenses
from riskmart.llm.manifest import OP11_SQL, op11_merkle
from riskmart.llm.mixing import OP7_SQL, op7_mixing
from riskmart.llm.packing import op2_packing
from riskmart.llm.simhash import op1_simhash
from riskmart.llm.styletree import op3_html
from riskmart.llm.substrings import OP8_SQL, op8_substrings
from riskmart.llm.syncmers import op5_syncmers
from riskmart.llm.topk import OP10_SQL, op10_topk
from riskmart.llm.toxicity import op9_toxicity
from riskmart.llm.urlrules import op13_urls
from riskmart.llm.whitening import op12_whitening

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_html": op3_html,
    "op4_langid": op4_langid,
    "op5_syncmers": op5_syncmers,
    "op6_licenses": op6_licenses,
    "op7_mixing": op7_mixing,
    "op8_substrings": op8_substrings,
    "op9_toxicity": op9_toxicity,
    "op10_topk": op10_topk,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_urls": op13_urls,
}

ORACLE = {
    "op7_mixing": OP7_SQL,
    "op8_substrings": OP8_SQL,
    "op10_topk": OP10_SQL,
    "op11_merkle": OP11_SQL,
}
