"""DuckDB SQL of the queries on runs, manifests and mixtures, from their definitions."""

from __future__ import annotations

#: The unsigned crc32 of the decimal digits of ``doc_id``, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
              lambda sum, byte: list_reduce(list_prepend(xor(sum, byte), range(8)), lambda s, z: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END)),
              4294967295::BIGINT)"""

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

RUNS = f"""
    WITH crc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w, {_CRC} AS h FROM documents),
         cut AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM crc),
         doc AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
                        ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w
                 FROM cut),
         word AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS x FROM doc),
         same AS (SELECT a.r, b.i - a.i AS q, a.i FROM word a JOIN word b ON a.r = b.r AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
         line AS (SELECT r, q, min(i) AS s, count(*) + q AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same)
                  GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
         run AS (SELECT * FROM line l WHERE NOT EXISTS (FROM line k WHERE k.r = l.r AND k.q < l.q AND k.s <= l.s AND k.s + k.n >= l.s + l.n)),
         best AS (SELECT r, s, n, q FROM run
                  QUALIFY row_number() OVER (PARTITION BY r ORDER BY (CAST(n AS DOUBLE) / q) DESC, s, q) = 1),
         text AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY r),
         gone AS (SELECT DISTINCT r, unnest(range(s + q, s + n)) AS i FROM run),
         kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS rest FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.n AS length, best.q AS period, 1000 * best.n // best.q AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
    FROM doc LEFT JOIN best USING (r) LEFT JOIN text USING (r) LEFT JOIN kept USING (r)"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_TAMPERED = f"CASE WHEN ({_CRC}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"

MERKLE = f"""
    WITH RECURSIVE
         hashed AS (SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf(f'({_TAMPERED})')} AS claim FROM documents),
         leaves AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
                    FROM hashed),
         low AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
                 UNION ALL
                 SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 3, n),
         sub AS (SELECT tree, h AS subroot, count(*) OVER () AS n FROM low WHERE n = 1),
         high AS (SELECT 0 AS level, tree AS pos, n, subroot AS h FROM sub
                  UNION ALL
                  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 3, n),
         depth AS (SELECT tree, max(level) AS height FROM low GROUP BY tree),
         side AS (SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                  FROM (SELECT * FROM low WHERE n > 1) a JOIN low b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
                  GROUP BY ALL),
         upper_side AS (SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                               coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                        FROM (SELECT * FROM high WHERE n > 1) a JOIN high b ON a.level = b.level AND a.pos // 3 = b.pos // 3
                        GROUP BY ALL),
         first_fold AS (SELECT tree, pos AS leaf_pos, 0 AS level, pos, claim AS fold, '' AS proof FROM leaves
                        UNION ALL
                        SELECT f.tree, leaf_pos, f.level + 1, f.pos // 3, sha256(l || fold || r), proof || l || r
                        FROM first_fold f JOIN side s ON f.tree = s.tree AND f.level = s.level AND f.pos = s.pos),
         at_sub AS (SELECT f.* FROM first_fold f JOIN depth d ON f.tree = d.tree AND level = height),
         fold AS (SELECT tree, leaf_pos, 0 AS level, tree AS pos, fold, proof FROM at_sub
                  UNION ALL
                  SELECT f.tree, leaf_pos, f.level + 1, f.pos // 3, sha256(l || fold || r), proof || l || r
                  FROM fold f JOIN upper_side s ON f.level = s.level AND f.pos = s.pos),
         done AS (SELECT tree, leaf_pos, fold, proof FROM fold WHERE level = (SELECT max(level) FROM high))
    SELECT doc_id, leaf, subroot, top.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = top.h AS verified
    FROM leaves JOIN sub USING (tree) JOIN done ON leaves.tree = done.tree AND leaves.pos = done.leaf_pos, (SELECT h FROM high WHERE n = 1) AS top"""

MIXING = f"""
    WITH doc AS (SELECT doc_id, source, coalesce(len({_WORDS}), 0) AS size,
                        CAST('0x' || substr(sha256(concat_ws('|', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), '-'), coalesce(sha256(text), '-'))), 1, 13) AS BIGINT) / 16.0 ** 13 AS u
                 FROM documents),
         src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM doc GROUP BY source),
         lim AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS words, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weights
                 FROM src WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
         -- by rising limit per weight: the first source whose limit is above the share of what is left sets the share of the rest
         free AS (SELECT words, weights FROM lim WHERE 3 * source_size * weights > w * words ORDER BY 3 * source_size / w, source NULLS LAST LIMIT 1),
         tgt AS (SELECT source, source_size, CASE WHEN free.words IS NULL OR 3 * source_size * free.weights <= w * free.words THEN CAST(3 * source_size AS DOUBLE)
                                                  ELSE CAST(free.words AS DOUBLE) * w / CAST(free.weights AS DOUBLE) END AS target
                 FROM src LEFT JOIN free ON true),
         rate AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM tgt)
    SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM doc JOIN rate ON doc.source IS NOT DISTINCT FROM rate.source"""
