"""The registered queries of this package, one for each operator."""

from crowdtape.llm.anomaly import op9_quality_rules
from crowdtape.llm.chat import op5_chat_format
from crowdtape.llm.decontaminate import op3_decontamination
from crowdtape.llm.langid import op10_language_id
from crowdtape.llm.line_dedup import op2_line_dedup
from crowdtape.llm.packing import op8_best_fit_packing
from crowdtape.llm.quality_model import op12_quality_classifier
from crowdtape.llm.runs import op11_periodic_runs
from crowdtape.llm.separators import op1_token_counts
from crowdtape.llm.simhash_trie import op6_simhash
from crowdtape.llm.url_cascade import op4_url_filter
from crowdtape.llm.warc import op7_warc
from crowdtape.llm.whitening import op13_embedding_whitening

QUERIES = (
    op1_token_counts,
    op2_line_dedup,
    op3_decontamination,
    op4_url_filter,
    op5_chat_format,
    op6_simhash,
    op7_warc,
    op8_best_fit_packing,
    op9_quality_rules,
    op10_language_id,
    op11_periodic_runs,
    op12_quality_classifier,
    op13_embedding_whitening,
)
