"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from . import ann, bpe, conversations, filter_audit, line_dedup, minhash, packing, repetition, simhash, token_store, toxicity, url_filter, warc

QUERIES = {
    "op1_repetition": repetition.op1_repetition,
    "op2_simhash": simhash.op2_simhash,
    "op3_ann": ann.op3_ann,
    "op4_packing": packing.op4_packing,
    "op5_warc": warc.op5_warc,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_bpe": bpe.op7_bpe,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_token_store": token_store.op10_token_store,
    "op11_conversations": conversations.op11_conversations,
    "op12_minhash": minhash.op12_minhash,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE_SQL = {
    "op9_url_filter": url_filter.OP9_SQL,
    "op11_conversations": conversations.OP11_SQL,
    "op12_minhash": minhash.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
