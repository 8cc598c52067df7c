"""DuckDB SQL for the results of the queries that SQL can express."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}


def near_sql(length: int, documents: str = "documents") -> str:
    """CTEs ending in ``near``: ``doc_id, n_shingles, component_id, kept``."""
    return rf"""
    near_words AS (
        SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM {documents}),
    near_sets AS (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(ws) >= {length}
            THEN list_transform(range(1, len(ws) - {length} + 2), lambda i: array_to_string(ws[i:i + {length} - 1], ' '))
            WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
        FROM near_words),
    near_sizes AS (SELECT doc_id, count(*) AS n FROM near_sets GROUP BY doc_id),
    near_pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM near_sets x JOIN near_sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
    near_links AS (
        SELECT p.a, p.b FROM near_pairs p
        JOIN near_sizes s ON s.doc_id = p.a JOIN near_sizes t ON t.doc_id = p.b
        WHERE 100 * p.n >= 80 * (s.n + t.n - p.n)),
    near_both AS (SELECT a, b FROM near_links UNION ALL SELECT b, a FROM near_links),
    near_reach AS (
        SELECT doc_id, doc_id AS other FROM {documents}
        UNION SELECT r.doc_id, l.b FROM near_reach r JOIN near_both l ON r.other = l.a),
    near AS (
        SELECT doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(other) AS component_id,
            doc_id = min(other) AS kept
        FROM near_reach LEFT JOIN near_sizes USING (doc_id) GROUP BY doc_id)"""


def exact_sql(documents: str = "documents") -> str:
    """CTEs ending in ``exact``."""
    return rf"""
    exact_rows AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM {documents}),
    exact_best AS (
        SELECT text_sha256, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size
        FROM exact_rows GROUP BY text_sha256),
    exact AS (
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM exact_rows JOIN exact_best USING (text_sha256))"""


def contamination_sql(documents: str = "documents") -> str:
    """CTEs ending in ``judged``."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
    item_words AS (SELECT item_id, regexp_extract_all({_LOWERED}, '{word}') AS ws FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, least(len(ws), 13) AS size, unnest(list_transform(
            range(1, greatest(len(ws) - 13, 0) + 2), lambda i: array_to_string(ws[i:i + 12], ' '))) AS win
        FROM item_words WHERE len(ws) > 0),
    doc_words AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{word}') AS ws FROM {documents}),
    doc_windows AS (
        SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS place,
            unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS win
        FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(ws) >= size),
    hits AS (
        SELECT doc_id, place, w.size, item_id FROM doc_windows w
        JOIN item_windows i ON w.size = i.size AND w.win = i.win),
    hit_words AS (
        SELECT doc_id, count(DISTINCT spot) AS n_hit
        FROM (SELECT doc_id, unnest(range(place, place + size)) AS spot FROM hits) GROUP BY doc_id),
    hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id),
    judged AS (
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id))"""


BYTES_SQL = r"""
    WITH input AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hexed FROM documents),
    blocks AS (
        SELECT doc_id, unnest(range(0, len(hexed) // 2 - 49, 64)) AS base,
            unnest(list_transform(range(0, len(hexed) // 2 - 49, 64), lambda i: substring(hexed, 2 * i + 1, 226))) AS part
        FROM input WHERE len(hexed) >= 100),
    windows AS (
        SELECT doc_id, base + unnest(range(0, len(part) // 2 - 49)) AS place,
            unnest(list_transform(range(0, len(part) // 2 - 49), lambda i: md5_number(substring(part, 2 * i + 1, 100)))) AS win
        FROM blocks),
    firsts AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)),
    gone AS (
        SELECT doc_id, place,
            place > lag(place, 1, -51) OVER (PARTITION BY doc_id ORDER BY place) + 50 AS fresh
        FROM windows JOIN firsts USING (win) WHERE doc_id > first_id),
    numbered AS (
        SELECT doc_id, place,
            sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS span
        FROM gone),
    spans AS (SELECT doc_id, min(place) AS start, max(place) + 50 AS stop FROM numbered GROUP BY doc_id, span),
    gaps AS (
        SELECT doc_id, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS start, start AS stop FROM spans
        UNION ALL SELECT doc_id, max(stop), 1000000000 FROM spans GROUP BY doc_id),
    kept AS (
        SELECT doc_id, string_agg(hexed[2 * start + 1:2 * stop], '' ORDER BY start) AS kept
        FROM gaps JOIN input USING (doc_id) GROUP BY doc_id),
    counts AS (SELECT doc_id, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, (len(hexed) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, hexed))) AS kept_sha256
    FROM input LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)"""

WORDS_SQL = r"""
    WITH input AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(ws) - 48)) AS place,
            unnest(list_transform(range(1, len(ws) - 48), lambda i: array_to_string(ws[i:i + 49], ' '))) AS win
        FROM input WHERE len(ws) >= 50),
    firsts AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)),
    gone AS (
        SELECT doc_id, list(DISTINCT place) AS places
        FROM (SELECT doc_id, unnest(range(place, place + 50)) AS place
            FROM windows JOIN firsts USING (win) WHERE doc_id > first_id) GROUP BY doc_id),
    kept AS (
        SELECT doc_id, ws, coalesce(len(places), 0) AS n_removed,
            list_filter(ws, lambda w, i: NOT coalesce(list_contains(places, i), false)) AS left_over
        FROM input LEFT JOIN gone USING (doc_id))
    SELECT doc_id, len(ws) AS n_words, n_removed, sha256(array_to_string(left_over, ' ')) AS kept_sha256 FROM kept"""



def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_encoded, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


# The checksum of a text in ASCII, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda sign: ascii(sign)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""

MERKLE_SQL = rf"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, {_leaf("text")} AS leaf,
            CASE WHEN {_CRC32.format(text="doc_id::VARCHAR")} % 2 = 0
            THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
        FROM documents),
    levels AS (
        SELECT source, 0 AS h, place, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
        UNION ALL
        SELECT source, h + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
        FROM levels WHERE n > 1 GROUP BY source, h, place // 3, n),
    subroots AS (
        SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
        FROM levels WHERE n = 1),
    tops AS (
        SELECT 0 AS h, place, digest, n FROM subroots
        UNION ALL
        SELECT h + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
        FROM tops WHERE n > 1 GROUP BY h, place // 3, n),
    runs AS (
        SELECT s.place AS tree, h, l.place // 3 AS run, list(l.digest ORDER BY l.place) AS kids, (l.n + 2) // 3 AS above
        FROM levels l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source WHERE l.n > 1 GROUP BY s.place, h, l.place // 3, l.n
        UNION ALL
        SELECT -1, h, place // 3, list(digest ORDER BY place), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY h, place // 3, n),
    climb AS (
        SELECT doc_id, s.place AS own, 0 AS step, CASE WHEN l.n > 1 THEN s.place ELSE -1 END AS tree, 0 AS h,
            CASE WHEN l.n > 1 THEN l.place ELSE s.place END AS place, claimed AS folded, '' AS siblings
        FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM leaves) l
        JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
        UNION ALL
        SELECT doc_id, own, step + 1, CASE WHEN above = 1 THEN -1 ELSE c.tree END,
            CASE WHEN above = 1 AND c.tree >= 0 THEN 0 ELSE c.h + 1 END,
            CASE WHEN above = 1 AND c.tree >= 0 THEN own ELSE c.place // 3 END,
            sha256(array_to_string(list_transform(kids, lambda k, i: CASE WHEN i - 1 = c.place % 3 THEN folded ELSE k END), '')),
            siblings || array_to_string(list_filter(kids, lambda k, i: i - 1 <> c.place % 3), '')
        FROM climb c JOIN runs r ON r.tree = c.tree AND r.h = c.h AND r.run = c.place // 3),
    ways AS (
        SELECT doc_id, own, arg_max(folded, step) AS folded_root, arg_max(siblings, step) AS siblings
        FROM climb GROUP BY doc_id, own)
    SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(siblings) AS proof_sha256, folded_root,
        folded_root = t.digest AS verified
    FROM ways JOIN leaves USING (doc_id) JOIN subroots s ON s.place = own, (SELECT digest FROM tops WHERE n = 1) t"""

PHRASES_SQL = rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?
-]')) AS piece
        FROM documents),
    parts AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
    grams AS (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM parts, (VALUES (1), (2), (3)) lengths(k)),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
    sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
    cuts AS (
        SELECT lang, phrase, k, a, cut, array_to_string(ws[:cut], ' ') AS lhs, array_to_string(ws[cut + 1:], ' ') AS rhs
        FROM candidates, (VALUES (1), (2)) places(cut) WHERE cut < k),
    judged AS (
        SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r,
            ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = lhs JOIN f y ON y.lang = c.lang AND y.phrase = rhs
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
    longer AS (
        SELECT lang, phrase, max(a) AS a FROM (
            SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
            FROM candidates WHERE k = 3) GROUP BY lang, phrase)
    SELECT j.lang, row_number() OVER (PARTITION BY j.lang ORDER BY score DESC, j.a DESC, j.phrase) AS rank,
        j.phrase, j.a, l, r, n, score
    FROM judged j JOIN sizes USING (lang) LEFT JOIN longer o ON o.lang = j.lang AND o.phrase = j.phrase
    WHERE o.a IS NULL OR 100 * o.a < 50 * j.a
    QUALIFY rank <= 2000"""

ORACLES["op11_merkle_manifest"] = MERKLE_SQL
ORACLES["op12_collocations"] = PHRASES_SQL
ORACLES["op4_suffix_array_dedup"] = BYTES_SQL
ORACLES["op6_suffix_tree_dedup"] = WORDS_SQL
ORACLES["op8_winnowing"] = f"WITH {contamination_sql()} SELECT * FROM judged"
ORACLES["op7_minhash_near_dedup"] = f"WITH RECURSIVE {near_sql(4)} SELECT * FROM near"
ORACLES["op10_exact_dedup"] = f"WITH {exact_sql()} SELECT * FROM exact"
