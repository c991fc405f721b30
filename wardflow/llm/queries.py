"""Registered queries of the corpus operators."""

from __future__ import annotations

from wardflow.llm.ann import op9_ann
from wardflow.llm.bpe import op3_bpe
from wardflow.llm.html_text import op4_html_text
from wardflow.llm.jaccard import op10_jaccard_join
from wardflow.llm.katz import op12_katz
from wardflow.llm.language_id import op1_language_id
from wardflow.llm.lexical import OP11_SQL, op11_search
from wardflow.llm.license_scan import op7_license_scan
from wardflow.llm.packing import op5_packing
from wardflow.llm.quality import op8_quality
from wardflow.llm.spelling import op13_spelling
from wardflow.llm.url_filter import OP6_SQL, op6_url_filter
from wardflow.llm.warc_zip import op2_warc

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_bpe": op3_bpe,
    "op4_html_text": op4_html_text,
    "op5_packing": op5_packing,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_ann": op9_ann,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_search": op11_search,
    "op12_katz": op12_katz,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": OP6_SQL,
    "op11_search": OP11_SQL,
}
