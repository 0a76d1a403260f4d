"""The registered queries of this subpackage: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

from projectpulse.llm import bpe, chat_format, exact_dedup, html_text, jaccard_join, langid, lm, packing, prefix_trie, secret_scan, spelling, spotsigs, suffix_dedup

REGISTRY = {
    "op1_pack": (packing.op1_pack, None),
    "op2_langid": (langid.op2_langid, None),
    "op3_bpe": (bpe.op3_bpe, None),
    "op4_spotsigs": (spotsigs.op4_spotsigs, None),
    "op5_suffix_dedup": (suffix_dedup.op5_suffix_dedup, None),
    "op6_exact_dedup": (exact_dedup.op6_exact_dedup, exact_dedup.OP6_SQL),
    "op7_chat_format": (chat_format.op7_chat_format, chat_format.OP7_SQL),
    "op8_jaccard_join": (jaccard_join.op8_jaccard_join, jaccard_join.OP8_SQL),
    "op9_lm_score": (lm.op9_lm_score, None),
    "op10_html_text": (html_text.op10_html_text, None),
    "op11_secret_scan": (secret_scan.op11_secret_scan, secret_scan.OP11_SQL),
    "op12_prefix_trie": (prefix_trie.op12_prefix_trie, prefix_trie.OP12_SQL),
    "op13_spelling_variants": (spelling.op13_spelling_variants, spelling.OP13_SQL),
}
