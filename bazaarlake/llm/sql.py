"""The same results in DuckDB SQL, for the queries SQL can express."""

from __future__ import annotations

from bazaarlake.llm.mixing import MOST_REPEATS, SEED, SIZE_BITS, TOTAL_SHARE, WEIGHTS

# Documents dealt to sources as in ``mixing``: level by sorted caps, copies by running sums.
OP5_MIXING = f"""
WITH docs AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS digest,
           coalesce('s' || source, 'n') AS name
    FROM documents
), sources AS (
    SELECT name, any_value(source) AS source, sum(size)::DOUBLE AS source_size FROM docs GROUP BY name
), weighed AS (
    SELECT *, {list(WEIGHTS)}[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT]::DOUBLE AS weight,
           {float(MOST_REPEATS)} * source_size AS cap,
           {TOTAL_SHARE} * sum(source_size) OVER () AS want
    FROM sources
), filled AS (
    SELECT *, sum(cap) OVER w + cap / weight * (sum(weight) OVER () - sum(weight) OVER w) <= want AS cut
    FROM weighed WINDOW w AS (ORDER BY cap / weight)
), levels AS (
    SELECT (any_value(want) - coalesce(sum(cap) FILTER (cut), 0)) / nullif(sum(weight) FILTER (NOT cut), 0) AS level
    FROM filled
), targets AS (
    SELECT name, source_size, CASE WHEN cut THEN cap ELSE least(cap, level * weight) END AS target
    FROM filled, levels
), ranked AS (
    SELECT *, greatest(CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END - {SIZE_BITS}, 0) AS shift
    FROM docs
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY name ORDER BY shift, size >> shift, left(digest, 2), size, digest, doc_id) AS place
    FROM ranked
), rated AS (
    SELECT placed.*, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           ('0x' || left(md5('{SEED}|' || name), 8))::BIGINT / 4294967296.0::DOUBLE AS start
    FROM placed JOIN targets USING (name)
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       ((floor(rate * place + start) - floor(rate * (place - 1) + start)) * size)::BIGINT AS taken
FROM rated
"""



def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    mixed = f"CASE WHEN k % 8 = 0 THEN xor(c, ascii(({text})[(k // 8 + 1)::BIGINT])::UBIGINT) ELSE c END"
    step = f"CASE WHEN {mixed} % 2 = 1 THEN xor({mixed} // 2, 3988292384::UBIGINT) ELSE {mixed} // 2 END"
    bits = f"list_prepend(4294967295::UBIGINT, range(0, 8 * length({text}))::UBIGINT[])"
    return f"xor(list_reduce({bits}, lambda c, k: {step}), 4294967295::UBIGINT)"


# The tree level by level: a node's parent is at half its place; a node of an odd run stands alone.
OP13_MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang,
           sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", "text"]))}) AS leaf,
           sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "(n_chars + 1)", "text"]))}) AS more,
           crc % 7 = 0 AS chosen
    FROM (SELECT *, {_crc32("doc_id::VARCHAR")} AS crc FROM documents)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS total
    FROM leaves
), nodes AS (
    SELECT 0 AS level, lang, place, total, leaf AS digest FROM placed
    UNION ALL
    SELECT level + 1, lang, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE total > 1 GROUP BY level, lang, place // 2, total
), subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
           count(*) OVER () AS total
    FROM nodes WHERE total = 1
), tops AS (
    SELECT 0 AS level, place, total, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE total > 1 GROUP BY level, place // 2, total
), folded AS (
    SELECT 0 AS phase, 0 AS level, doc_id, p.lang, p.place, p.total, s.place AS top_place, s.total AS top_total,
           CASE WHEN chosen THEN more ELSE leaf END AS digest, '' AS proof
    FROM placed p
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
    UNION ALL
    SELECT phase, level, doc_id, lang, place, total, top_place, top_total, digest, proof FROM (
        SELECT 0 AS phase, f.level + 1 AS level, doc_id, f.lang, f.place // 2 AS place, (f.total + 1) // 2 AS total,
               top_place, top_total,
               sha256(CASE WHEN f.place % 2 = 0 THEN f.digest || coalesce(n.digest, '') ELSE n.digest || f.digest END) AS digest,
               proof || coalesce(n.digest, '') AS proof
        FROM folded f LEFT JOIN nodes n ON n.level = f.level AND n.lang IS NOT DISTINCT FROM f.lang
             AND n.place = CASE WHEN f.place % 2 = 0 THEN f.place + 1 ELSE f.place - 1 END
        WHERE phase = 0 AND f.total > 1
        UNION ALL
        SELECT 1, 0, doc_id, lang, place, total, top_place, top_total, digest, proof
        FROM folded WHERE phase = 0 AND total = 1
        UNION ALL
        SELECT 1, f.level + 1, doc_id, f.lang, f.place, f.total, top_place // 2, (top_total + 1) // 2,
               sha256(CASE WHEN top_place % 2 = 0 THEN f.digest || coalesce(n.digest, '') ELSE n.digest || f.digest END),
               proof || coalesce(n.digest, '')
        FROM folded f LEFT JOIN tops n ON n.level = f.level
             AND n.place = CASE WHEN top_place % 2 = 0 THEN top_place + 1 ELSE top_place - 1 END
        WHERE phase = 1 AND top_total > 1
    )
)
SELECT f.doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM folded f JOIN placed p USING (doc_id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN tops t ON t.total = 1
WHERE phase = 1 AND top_total = 1
"""

ORACLE = {"op5_mixing": OP5_MIXING, "op13_merkle": OP13_MERKLE}
