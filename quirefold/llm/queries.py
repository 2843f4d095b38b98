"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontaminate import OP8_SQL, op8_prefix_filtered_windows
from .fingerprints import op6_threshold_sketch
from .htmlextract import op10_crf_extraction
from .packing import op5_tiered_packing
from .prefixtrie import OP11_SQL, op11_truncation_peeling
from .quality import op13_naive_bayes_svm
from .runs import op12_dyadic_runs
from .setjoin import op2_set_relation_join
from .sharding import op9_hilbert_sharding
from .tokenfiles import op3_elias_fano_ids
from .toxicity import op4_maximal_segments
from .urlfilter import OP1_SQL, op1_redirect_equivalence
from .warc import op7_content_addressed_archive

QUERIES = {
    f.__name__: f
    for f in (
        op1_redirect_equivalence,
        op2_set_relation_join,
        op3_elias_fano_ids,
        op4_maximal_segments,
        op5_tiered_packing,
        op6_threshold_sketch,
        op7_content_addressed_archive,
        op8_prefix_filtered_windows,
        op9_hilbert_sharding,
        op10_crf_extraction,
        op11_truncation_peeling,
        op12_dyadic_runs,
        op13_naive_bayes_svm,
    )
}

SQL = {
    "op1_redirect_equivalence": OP1_SQL,
    "op8_prefix_filtered_windows": OP8_SQL,
    "op11_truncation_peeling": OP11_SQL,
}
