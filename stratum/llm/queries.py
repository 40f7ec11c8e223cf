"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from stratum.llm.ann import op1_ann
from stratum.llm.bpe import op4_bpe
from stratum.llm.conversations import op13_conversation_repair
from stratum.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from stratum.llm.license_scan import op9_license_scan, op9_sql
from stratum.llm.mixing import op10_mix_sources
from stratum.llm.periodic_runs import op11_periodic_runs
from stratum.llm.quality import op8_quality_classifier
from stratum.llm.secret_scan import op12_secret_scan
from stratum.llm.simhash import op2_simhash_near_dedup
from stratum.llm.suffix_dedup import op7_suffix_dedup
from stratum.llm.token_files import op6_token_files
from stratum.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {f.__name__: f for f in (
    op1_ann, op2_simhash_near_dedup, op3_url_filter, op4_bpe, op5_exact_dedup, op6_token_files,
    op7_suffix_dedup, op8_quality_classifier, op9_license_scan, op10_mix_sources, op11_periodic_runs,
    op12_secret_scan, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the others are tested by brute force."""
    return {"op3_url_filter": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op9_license_scan": op9_sql()}
