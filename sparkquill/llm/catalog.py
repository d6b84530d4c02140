"""The queries of this subpackage by name, with SQL where SQL can express them."""

from __future__ import annotations

from sparkquill.llm import bpe, decontaminate, fill_middle, filter_audit, html_text, near_dup, pii, quality, secrets, substring_dup, token_counts, urls, warc
from sparkquill.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_warc": warc.query,
    "op2_pii": pii.query,
    "op3_url_filters": urls.query,
    "op4_near_dup": near_dup.query,
    "op5_html_text": html_text.query,
    "op6_quality_rules": quality.query,
    "op7_substring_dedup": substring_dup.query,
    "op8_byte_bpe": bpe.query,
    "op9_decontamination": decontaminate.query,
    "op10_secret_scans": secrets.query,
    "op11_fill_in_middle": fill_middle.query,
    "op12_token_counts": token_counts.query,
    "op13_filter_audit": filter_audit.query,
}
