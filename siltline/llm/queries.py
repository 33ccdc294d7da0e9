"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from siltline.llm.centroids import OP11_SQL, op11_centroid_clustering
from siltline.llm.contamination import OP10_SQL, op10_benchmark_decontamination
from siltline.llm.conversations import op12_conversation_repair
from siltline.llm.embeddings import OP6_SQL, op6_embedding_near_dedup
from siltline.llm.language import op1_language_id
from siltline.llm.licenses import OP3_SQL, op3_license_scan
from siltline.llm.packing import op7_best_fit_packing
from siltline.llm.quality import op4_quality_classifier
from siltline.llm.scoring import op9_lm_scoring
from siltline.llm.sharding import op2_sharding
from siltline.llm.simhash import op8_simhash_near_dedup
from siltline.llm.substrings import op5_substring_dedup
from siltline.llm.toxicity import op13_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_sharding,
        op3_license_scan,
        op4_quality_classifier,
        op5_substring_dedup,
        op6_embedding_near_dedup,
        op7_best_fit_packing,
        op8_simhash_near_dedup,
        op9_lm_scoring,
        op10_benchmark_decontamination,
        op11_centroid_clustering,
        op12_conversation_repair,
        op13_toxicity,
    )
}

ORACLE_SQL = {
    "op3_license_scan": OP3_SQL,
    "op6_embedding_near_dedup": OP6_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_centroid_clustering": OP11_SQL,
}
