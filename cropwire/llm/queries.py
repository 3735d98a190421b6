"""Registered queries of the training-data operators, and their DuckDB SQL."""

from cropwire.llm.ann import op9_nearest_neighbours
from cropwire.llm.licenses import op11_license_scan
from cropwire.llm.language import op7_language_id
from cropwire.llm.mixing import op10_mix_sources
from cropwire.llm.negatives import OP12_SQL, op12_hard_negatives
from cropwire.llm.packing import op5_best_fit_packing
from cropwire.llm.toxicity import op8_toxicity
from cropwire.llm.partenum import op4_ngram_jaccard_join
from cropwire.llm.preference import OP3_SQL, op3_preference_formatting
from cropwire.llm.quality import op6_quality
from cropwire.llm.scoring import op1_lm_scoring
from cropwire.llm.topk import OP2_SQL, op2_exact_top_k
from cropwire.llm.trie import OP13_SQL, op13_prefix_trie

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_preference_formatting": op3_preference_formatting,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality": op6_quality,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_mix_sources": op10_mix_sources,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

#: SQL for the operators that SQL can express; the others have brute-force tests.
ORACLES = {
    "op2_exact_top_k": OP2_SQL,
    "op3_preference_formatting": OP3_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
