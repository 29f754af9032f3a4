"""Queries of the operators in this package, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from . import p1_lookalikes as p1
from . import p2_scans as p2
from . import p3_pieces as p3
from . import p4_names as p4
from . import p5_site_lines as p5
from . import p6_near_duplicates as p6
from . import p7_windows as p7
from . import p8_leaks as p8
from . import p9_language as p9


def queries() -> dict:
    return {
        "p1_found": p1.p1_found, "p1_values": p1.p1_values,
        "p2_found": p2.p2_found, "p2_repaired": p2.p2_repaired,
        "p3_found": p3.p3_found, "p3_pieces": p3.p3_pieces,
        "p4_found": p4.p4_found, "p4_links": p4.p4_links,
        "p5_found": p5.p5_found, "p5_cleaned": p5.p5_cleaned,
        "p6_found": p6.p6_found, "p6_classes": p6.p6_classes, "p6_links": p6.p6_links,
        "p7_windows": p7.p7_windows, "p7_report": p7.p7_report,
        "p8_found": p8.p8_found, "p8_leaks": p8.p8_leaks,
        "p9_found": p9.p9_found, "p9_languages": p9.p9_languages,
    }


def oracle_sql() -> dict[str, str]:
    """p3_found alone is plain SQL; the others are tested against brute force in tests/llm."""
    one = "SELECT '{t}.{c}' AS field_name, {i} AS item_id FROM {t}, size_limits WHERE field_name = '{t}.{c}' AND length({c}) > max_chars"
    parts = [one.format(t=t, c=c, i=i) for t, c, i in (("legal_docs", "raw_text", "uid"), ("court_cases", "raw_text", "uid"), ("legal_articles", "content", "article_uid"))]
    return {"p3_found": "SELECT DISTINCT * FROM (" + " UNION ALL ".join(parts) + ")"}
