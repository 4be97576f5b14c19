"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage; the registered queries
and their DuckDB SQL are in ``QUERIES`` and ``ORACLE_SQL``.
"""

from tidewater.llm.ann import op9_inverted_multi_index
from tidewater.llm.exact_dedup import OP2_SQL, op2_bloom_exact_dedup
from tidewater.llm.filter_audit import OP12_SQL, op12_filter_interaction_audit
from tidewater.llm.language_id import op13_language_id
from tidewater.llm.line_dedup import op6_simhash_lines
from tidewater.llm.ngram_join import op3_ngram_join
from tidewater.llm.packing import op7_vector_packing
from tidewater.llm.pii import op1_weak_supervision_pii
from tidewater.llm.quality_gam import op8_quality_gam
from tidewater.llm.sentencepiece_unigram import op5_sentencepiece_unigram
from tidewater.llm.source_divergence import OP11_SQL, op11_source_divergence
from tidewater.llm.style_tree import op10_site_style_tree
from tidewater.llm.warc import op4_warc_boundary_chain

QUERIES = {f.__name__: f for f in (op1_weak_supervision_pii, op2_bloom_exact_dedup, op3_ngram_join, op4_warc_boundary_chain, op5_sentencepiece_unigram,
                                   op6_simhash_lines, op7_vector_packing,
                                   op8_quality_gam, op9_inverted_multi_index, op10_site_style_tree, op11_source_divergence,
                                   op12_filter_interaction_audit, op13_language_id)}
ORACLE_SQL = {"op2_bloom_exact_dedup": OP2_SQL, "op11_source_divergence": OP11_SQL, "op12_filter_interaction_audit": OP12_SQL}
