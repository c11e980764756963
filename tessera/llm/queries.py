"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.ball_search import op13_ranked_search
from tessera.llm.bloom_lm import op5_bloom_lm
from tessera.llm.bwt_dedup import op7_bwt_dedup
from tessera.llm.decontaminate import op10_decontaminate
from tessera.llm.html_extract import op2_html_extract
from tessera.llm.line_runs import op8_line_runs
from tessera.llm.minmax_dedup import op3_minmax_dedup
from tessera.llm.packing import op6_packing
from tessera.llm.quality_forest import op9_quality_forest
from tessera.llm.recompression import op4_recompression
from tessera.llm.repacking import op12_best_fit
from tessera.llm.spelling import op11_spelling_variants
from tessera.llm.token_output import op1_token_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_html_extract": op2_html_extract,
    "op3_minmax_dedup": op3_minmax_dedup,
    "op4_recompression": op4_recompression,
    "op5_bloom_lm": op5_bloom_lm,
    "op6_packing": op6_packing,
    "op7_bwt_dedup": op7_bwt_dedup,
    "op8_line_runs": op8_line_runs,
    "op9_quality_forest": op9_quality_forest,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_best_fit": op12_best_fit,
    "op13_ranked_search": op13_ranked_search,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

_UP_TO_Y = "".join(map(chr, range(0xC0, 0x100)))

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLES: dict[str, str] = {
    "op13_ranked_search": f"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS ts FROM documents),
        s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
        q AS (
          SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_TERM})) AS t FROM benchmark),
        t AS (
          SELECT r, doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d)
          WHERE t IN (SELECT t FROM q) GROUP BY 1, 2, 3, 4),
        w AS (
          SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
          FROM t, s GROUP BY t, n_docs),
        v AS (
          SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total))) AS v
          FROM t JOIN w USING (t), s),
        g AS (
          SELECT item_id, r, doc_id, sum(v)::BIGINT AS score FROM q JOIN v USING (t) GROUP BY 1, 2, 3 HAVING sum(v) > 0),
        k AS (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM g)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
    "op11_spelling_variants": f"""
        WITH RECURSIVE bits(b, c, k) AS (  -- the checksum's table: each byte, eight shifts
          SELECT b, b, 0 FROM range(256) t(b) UNION ALL
          SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
        tab AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
        r AS (
          SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z{_UP_TO_Y}]+')) AS w FROM documents),
        d AS (
          SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, count(*) AS n FROM r WHERE length(w) >= 7 GROUP BY 1, 2),
        h AS (
          SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(s, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
                                                 ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h FROM d, tab),
        v AS (
          SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w,
                 n FROM h),
        words AS (SELECT w, sum(n)::BIGINT AS n, length(w) AS l FROM v WHERE length(w) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
        gaps AS (
          SELECT w, n, l, i, left(w, i - 1) || substr(w, i + 1) AS g FROM (SELECT *, unnest(range(1, l + 1)) AS i FROM words)),
        pairs AS (
          SELECT a.w, b.w AS o, b.n AS on_ FROM gaps a JOIN gaps b ON a.g = b.g AND a.i = b.i AND a.l = b.l AND a.w <> b.w
          UNION SELECT a.w, b.w, b.n FROM gaps a JOIN words b ON a.g = b.w
          UNION SELECT b.w, a.w, a.n FROM gaps a JOIN words b ON a.g = b.w),
        near AS (
          SELECT w, count(*) AS n_near, max(on_) AS most, arg_min(o, (-on_, o)) AS o FROM pairs GROUP BY 1),
        f AS (
          SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN o END AS form,
                 CASE WHEN most >= 10 * n THEN most END AS form_n FROM words LEFT JOIN near USING (w)),
        chain(w, here) AS (SELECT w, w FROM f UNION ALL SELECT c.w, f.form FROM chain c JOIN f ON f.w = c.here WHERE form IS NOT NULL),
        root AS (SELECT c.w, c.here AS root FROM chain c JOIN f ON f.w = c.here WHERE f.form IS NULL)
        SELECT f.w AS word, form, root, n, n_near, form_n FROM f JOIN root USING (w)""",
    "op3_minmax_dedup": f"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
        s AS (
          SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
        l AS (
          SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id AS d, doc_id AS t FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.t),
        c AS (SELECT d, min(t) AS component_id FROM r GROUP BY 1)
        SELECT c.d AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, component_id = c.d AS kept
        FROM c LEFT JOIN n ON n.doc_id = c.d""",
    "op4_recompression": f"""
        WITH w AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
        g AS (
          SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
        m AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS f FROM g) WHERE f < doc_id),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM m, range(13) t(k)),
        x AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
        k AS (
          SELECT x.doc_id, count(gone.i) AS n_removed,
                 string_agg(word, ' ' ORDER BY x.i) FILTER (gone.i IS NULL) AS kept
          FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY 1)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k ON k.doc_id = w.doc_id""",
    "op8_line_runs": r"""
        WITH l AS (
          SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        e AS (
          SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM l),
        k AS (
          SELECT doc_id, i, line,
                 translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
        f AS (
          SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k)
        SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id""",
}
