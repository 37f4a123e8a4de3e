"""SQL twins (DuckDB) of the operators that need more than a few lines."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(range(strlen({text})::BIGINT), lambda i: [ascii(substr({text}, CAST(i + 1 AS BIGINT), 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295)"


def _record(text: str) -> str:
    fields = [f"CAST({f} AS VARCHAR)" for f in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


MERKLE = f"""
    WITH RECURSIVE
    d AS (SELECT doc_id, source, {_record("text")} AS leaf,
                 CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_record("replace(text, chr(10), '')")} END AS other
          FROM documents),
    p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                 count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, row_number() OVER () AS id
          FROM d),
    t AS (SELECT tree, 0 AS k, place AS i, leaf AS h, n FROM p
          UNION ALL
          SELECT tree, k + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY tree, k, i // 3, n),
    s AS (SELECT tree, h FROM t WHERE n = 1),
    u AS (SELECT 0 AS k, tree - 1 AS i, h, count(*) OVER () AS n FROM s
          UNION ALL
          SELECT k + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY k, i // 3, n),
    nodes AS (SELECT tree, k, i, h FROM t UNION ALL SELECT 0, k, i, h FROM u),
    w AS (SELECT x.tree, x.k, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS before,
                 coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS after
          FROM nodes x JOIN nodes y ON x.tree = y.tree AND x.k = y.k AND x.i // 3 = y.i // 3 GROUP BY x.tree, x.k, x.i),
    f AS (SELECT id, tree, 0 AS k, place AS i, n, coalesce(other, leaf) AS own, '' AS proof FROM p
          UNION ALL
          SELECT id, CASE WHEN n > 1 THEN f.tree ELSE 0 END, CASE WHEN n > 1 THEN f.k + 1 ELSE 0 END,
                 CASE WHEN n > 1 THEN f.i // 3 ELSE f.tree - 1 END, CASE WHEN n > 1 THEN (n + 2) // 3 ELSE (SELECT count(*) FROM s) END,
                 CASE WHEN n > 1 THEN sha256(before || own || after) ELSE own END, CASE WHEN n > 1 THEN proof || before || after ELSE proof END
          FROM f JOIN w ON w.tree = f.tree AND w.k = f.k AND w.i = f.i WHERE n > 1 OR f.tree > 0)
    SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = r.h AS verified
    FROM p JOIN s ON s.tree = p.tree JOIN f ON f.id = p.id AND f.tree = 0 AND f.n = 1 JOIN u r ON r.n = 1"""


_BLANK = r"'^[\x20\x09-\x0D]*$'"
_END = r"'[.!?][\x20\x09-\x0D]*$'"
_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

CONVERSATIONS = f"""
    WITH RECURSIVE
    k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32("name")} % 20 AS kind
          FROM (SELECT *, {_KEY} AS name FROM conversations)),
    d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM k WHERE kind <> 0),
    c AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
    o AS (SELECT c.conv, turn, role, text, left(role, 1) AS initial,
                 row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, unhex(md5(CAST(length(role) AS VARCHAR) || ':' || role || text))) AS i
          FROM d JOIN c ON c.conv_id IS NOT DISTINCT FROM d.conv_id),
    r AS (SELECT *, CASE WHEN regexp_matches(text, {_BLANK}) THEN 1
                         WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
                         WHEN NOT regexp_matches(text, {_END}) THEN 3 ELSE 0 END AS fault,
                 lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
          FROM o),
    ins(state, goes, letters, price, made) AS (VALUES
          (0, 0, '', 0, CAST([] AS VARCHAR[])), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), (0, 2, 'I', 5, ['user:']), (0, 3, 'II', 10, ['user:', 'assistant:']),
          (1, 2, 'I', 5, ['user:']), (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 3, 'I', 5, ['assistant:']), (3, 2, 'I', 5, ['user:'])),
    arc(letter, state, goes, initial, price) AS (
          SELECT 'D', s, s, CAST(NULL AS VARCHAR), 2 FROM (VALUES (0), (1), (2), (3)) t(s)
          UNION ALL VALUES ('K', 0, 1, 's', 0), ('K', 0, 2, 'u', 0), ('K', 1, 2, 'u', 0), ('K', 3, 2, 'u', 0), ('K', 2, 3, 'a', 0),
                           ('R', 0, 2, NULL, 1), ('R', 1, 2, NULL, 1), ('R', 3, 2, NULL, 1), ('R', 2, 3, NULL, 1)),
    p AS (SELECT conv, 0 AS i, goes AS state, {{'cost': price, 'audit': letters, 'made': made}} AS best
          FROM (SELECT DISTINCT conv FROM r) JOIN ins ON ins.state = 0
          UNION ALL
          SELECT p.conv, p.i + 1, ins.goes,
                 min({{'cost': p.best.cost + arc.price + CASE WHEN r.fault = 3 AND arc.letter <> 'D' THEN 5 ELSE 0 END + ins.price,
                       'audit': p.best.audit || arc.letter || ins.letters,
                       'made': p.best.made || CASE arc.letter WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
                               ELSE [CASE arc.goes WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] END || ins.made}})
          FROM p JOIN r ON r.conv = p.conv AND r.i = p.i + 1
          JOIN arc ON arc.state = p.state AND (arc.initial IS NULL OR arc.initial = r.initial) AND (arc.letter = 'D' OR r.fault NOT IN (1, 2))
          JOIN ins ON ins.state = arc.goes
          GROUP BY p.conv, p.i + 1, ins.goes),
    n AS (SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM r GROUP BY conv),
    b AS (SELECT p.conv, min(best) AS best FROM p JOIN n ON n.conv = p.conv AND n.n = p.i WHERE state IN (0, 3) GROUP BY p.conv)
    SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
           coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
    FROM c LEFT JOIN n USING (conv) LEFT JOIN b USING (conv)"""
