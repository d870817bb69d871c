"""The opN_ queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op1_adaptive_dimension_scan
from .bpe import op10_bpe_encode_decode
from .codes import op11_vector_code_compression
from .fingerprint import op4_one_permutation_minhash
from .jaccard import op2_ngram_jaccard_join
from .licenses import op3_license_scan
from .lines import op8_line_chunk_dedup
from .packing import op6_best_fit_packing
from .simhash import op13_simhash_bk_trees
from .substrings import op9_super_kmer_dedup
from .suffixes import op7_suffix_array_dedup
from .toxicity import op5_toxicity_compression
from .trie import op12_conversation_prefix_trie

QUERIES = {
    "op1_adaptive_dimension_scan": op1_adaptive_dimension_scan,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_license_scan": op3_license_scan,
    "op4_one_permutation_minhash": op4_one_permutation_minhash,
    "op5_toxicity_compression": op5_toxicity_compression,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_line_chunk_dedup": op8_line_chunk_dedup,
    "op9_super_kmer_dedup": op9_super_kmer_dedup,
    "op10_bpe_encode_decode": op10_bpe_encode_decode,
    "op11_vector_code_compression": op11_vector_code_compression,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_simhash_bk_trees": op13_simhash_bk_trees,
}

ORACLES: dict[str, str] = {}
