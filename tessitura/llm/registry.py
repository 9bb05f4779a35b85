"""The queries of this subpackage and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from tessitura.llm.language_id import op7_language_id
from tessitura.llm.licenses import op8_license_scan
from tessitura.llm.mixing import op3_mixing
from tessitura.llm.packing import op5_packing
from tessitura.llm.simhash import op10_simhash
from tessitura.llm.sketches import op6_fingerprints
from tessitura.llm.substring_dedup import op1_substring_dedup
from tessitura.llm.token_counts import op2_token_counts
from tessitura.llm.token_files import op9_token_files
from tessitura.llm.topk import TOPK_SQL, op4_topk

_SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM w WHERE len(w) >= 20),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(w[s:s+19], ' ') ORDER BY doc_id, s) > 1 AS later FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM r WHERE later),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
k AS (SELECT u.doc_id, string_agg(u.x, ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.p = c.p WHERE c.p IS NULL GROUP BY u.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN k ON w.doc_id = k.doc_id
"""

QUERIES = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_token_counts, op3_mixing, op4_topk, op5_packing, op6_fingerprints, op7_language_id, op8_license_scan, op9_token_files, op10_simhash)
}
ORACLE_SQL = {"op1_substring_dedup": _SUBSTRING_SQL, "op4_topk": TOPK_SQL}
