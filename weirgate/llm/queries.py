"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirgate.llm.binary_output import op3_binary_output
from weirgate.llm.filter_audit import OP13_SQL, op13_filter_audit
from weirgate.llm.mixing import op2_source_mixing
from weirgate.llm.near_dedup import op5_near_dedup
from weirgate.llm.packing import op8_best_fit_packing
from weirgate.llm.pii import op9_pii
from weirgate.llm.quality import op4_quality_rules
from weirgate.llm.spelling import op11_spelling_variants
from weirgate.llm.substring_dedup import op1_substring_dedup
from weirgate.llm.suffix_dedup import op10_suffix_dedup
from weirgate.llm.token_counts import op6_token_counts
from weirgate.llm.topk import op7_exact_topk
from weirgate.llm.vector_dedup import OP12_SQL, op12_vector_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (op1_substring_dedup, op2_source_mixing, op3_binary_output, op4_quality_rules, op5_near_dedup,
                     op6_token_counts, op7_exact_topk, op8_best_fit_packing, op9_pii, op10_suffix_dedup, op11_spelling_variants,
                     op12_vector_dedup, op13_filter_audit)
}

SQL: dict[str, str] = {"op12_vector_dedup": OP12_SQL, "op13_filter_audit": OP13_SQL}
