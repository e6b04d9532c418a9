"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from treeferry.llm import conversation_repair, exact_dedup, license_scan, quality_rules, spelling_variants, url_filter, warc_zstd

ORACLES: dict[str, str] = {
    "op5_license_scan": license_scan.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op10_warc": warc_zstd.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_spelling_variants": spelling_variants.ORACLE,
}
