"""Schemas of the records that are read and written."""

from __future__ import annotations

COMPANY = "name string, corp_code string, stock string, sector string"
CORP_MAP = "corp_code string, corp_name string, stock_code string, modify_date string"
DISCLOSURE = "rcept_no string, corp_code string, corp_name string, report_nm string, rcept_dt string"
MANIFEST = "company string, stock string, corp_code string, year int, report_code string, rcept_no string, report_nm string, file string, status string, reason string"
CHUNK = "chunk_id string, text string, company string, year int, section string, report_code string, has_table boolean, token_count int, block_kinds array<string>"
ITEM = (
    "id string, question string, gold_answer string, gold_answer_unit string, evidence_chunks array<string>, evidence_quotes array<string>, reasoning_steps array<string>, "
    "reasoning_hops int, task_type string, source_company string, source_report string, source_section string, source_pages string, generation_notes string"
)
CALIBRATION = "item_id string, task_type string, classification string, attempts array<struct<raw:string,predicted:string,correct:boolean,input_tokens:int,output_tokens:int>>, retrieved_chunk_ids array<string>"
