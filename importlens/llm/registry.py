"""Queries of this subpackage and their SQL, by registered name."""

from __future__ import annotations

from importlens.llm import chat_format, conversation_repair, decontaminate, html_extract, language_id, license_scan, line_dedup, merkle_manifest, quality, sentencepiece_codec, simhash_dedup, topk_search, warc_bundles

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_topk_search": topk_search.op2_topk_search,
    "op3_quality": quality.op3_quality,
    "op4_warc": warc_bundles.op4_warc,
    "op5_sentencepiece": sentencepiece_codec.op5_sentencepiece,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op10_language_id": language_id.op10_language_id,
    "op7_html_extract": html_extract.op7_html_extract,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_simhash_dedup": simhash_dedup.op9_simhash_dedup,
    "op11_chat_format": chat_format.op11_chat_format,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_merkle_manifest": merkle_manifest.op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_scan.ORACLE,
    "op2_topk_search": topk_search.ORACLE,
    "op4_warc": warc_bundles.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
