"""Operators for preparing training corpora, and their queries."""

from . import ann, jaccard, media, mixing, packing, quality, secrets, substrings, tokens, urls

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_packing": packing.query,
    "op3_matroska": media.query,
    "op4_token_counts": tokens.query,
    "op5_multi_index_search": ann.query,
    "op6_quality_classifier": quality.query,
    "op7_substring_dedup": substrings.query,
    "op8_mixing": mixing.query,
    "op9_ngram_jaccard": jaccard.query,
    "op10_url_filter": urls.query,
    "matroska_packets": media.packet_query,
    "matroska_cues": media.cue_query,
}
ORACLES = {"op8_mixing": mixing.SQL, "op10_url_filter": urls.SQL, "matroska_packets": media.PACKET_SQL, "matroska_cues": media.CUE_SQL}
