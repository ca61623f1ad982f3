"""The queries of the corpus operators and their DuckDB counterparts."""

from weftline.llm import chat, decontam, hnsw, mixing, neardup, quality, secrets, sufdedup, toxicity, warc

QUERIES = {
    "op1_source_mixing": mixing.op1_source_mixing,
    "op2_near_dedup": neardup.op2_near_dedup,
    "op3_quality": quality.op3_quality,
    "op4_embedding_dedup": hnsw.op4_embedding_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_warc_pages": warc.op6_warc_pages,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_chat_format": chat.op8_chat_format,
    "op9_suffix_dedup": sufdedup.op9_suffix_dedup,
    "op10_secret_scan": secrets.op10_secret_scan,
}
ORACLES = {
    "op1_source_mixing": mixing.OP1_SQL,
    "op4_embedding_dedup": hnsw.OP4_SQL,
    "op6_warc_pages": warc.OP6_SQL,
    "op8_chat_format": chat.OP8_SQL,
    "op10_secret_scan": secrets.OP10_SQL,
}
