"""Names of the training-data queries and their SQL."""

from __future__ import annotations

from notegraph.llm import (
    chat,
    convtrie,
    fingerprint,
    html_extract,
    langid,
    mih,
    mixing,
    neardup,
    packing,
    runs,
    sharding,
    simhash,
    warczip,
)


def queries():
    import corpus_pipeline

    return {
        "op1_language_id": langid.op1_language_id,
        "op2_mixing": mixing.op2_mixing,
        "op3_html_extraction": html_extract.op3_html_extraction,
        "op4_packing": packing.op4_packing,
        "op5_near_dedup": neardup.op5_near_dedup,
        "op6_exact_topk": mih.op6_exact_topk,
        "op7_sharding": sharding.op7_sharding,
        "op8_fingerprints": fingerprint.op8_fingerprints,
        "op9_chat_formatting": chat.op9_chat_formatting,
        "op10_warc": warczip.op10_warc,
        "op11_prefix_trie": convtrie.op11_prefix_trie,
        "op12_periodic_runs": runs.op12_periodic_runs,
        "op13_simhash": simhash.op13_simhash,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    return {
        "op2_mixing": mixing.OP2_SQL,
        "op6_exact_topk": mih.OP6_SQL,
        "op11_prefix_trie": convtrie.OP11_SQL,
    }
