"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paylater.llm.bpe import op5_bpe
from paylater.llm.filter_audit import OP13_SQL, op13_filter_audit
from paylater.llm.fingerprints import op3_fingerprints
from paylater.llm.line_dedup import OP7_SQL, op7_line_dedup
from paylater.llm.ngram_join import op10_ngram_jaccard_join
from paylater.llm.packing import op9_packing
from paylater.llm.periodic_runs import op12_periodic_runs
from paylater.llm.secret_scan import op6_secret_scan
from paylater.llm.sharding import op11_sharding
from paylater.llm.suffix_dedup import op1_suffix_dedup
from paylater.llm.topk_search import op2_topk_search
from paylater.llm.toxicity import op4_toxicity
from paylater.llm.url_filter import op8_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup,
        op2_topk_search,
        op3_fingerprints,
        op4_toxicity,
        op5_bpe,
        op6_secret_scan,
        op7_line_dedup,
        op8_url_filter,
        op9_packing,
        op10_ngram_jaccard_join,
        op11_sharding,
        op12_periodic_runs,
        op13_filter_audit,
    )
}

# Statements for the queries that SQL expresses on whole tables in reasonable time.
ORACLE_SQL: dict[str, str] = {
    "op7_line_dedup": OP7_SQL,
    "op13_filter_audit": OP13_SQL,
}
