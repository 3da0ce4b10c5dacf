"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: A-Z lower-cased, then runs of digits, letters and non-ASCII characters. Shared by several oracles.
_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 9 * count(*) >= 4 * (na.n + nb.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, c.class_id, coalesce(k.n_links, 0) AS n_links
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN k ON k.a = d.doc_id
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = (("assign", 0, _ASSIGN, 6, 2), ("access", 1, "AKIA[A-Z0-9]+", 20, 0), ("hex", 2, "[0-9a-f]+", 24, 0), ("pem", 3, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 20, 0), ("jwt", 4, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 36, 0))


def _matches(kind: str, rank: int, pattern: str, least: int, group: int) -> str:
    """Each match's start and end from the pieces between matches."""
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, s AS start_, s + length(m[i]) AS end_ FROM (
      SELECT doc_id, m, g, i, coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s FROM (
        SELECT doc_id, m, g, b, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {group}) AS g, regexp_split_to_array(text, '{pattern}') AS b FROM d WHERE regexp_matches(text, '{pattern}')))) WHERE length(g[i]) >= {least}"""


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_matches(*x) for x in _SECRETS)}),
l AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l ON d.doc_id = l.doc_id
"""

_CONTROL = ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")


def _escaped(value: str, more: tuple[str, ...] = ()) -> str:
    out = f"replace({value}, '\\', '\\\\')"
    for c in _CONTROL + more:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped("role", ("|>",))}) + length({_escaped("text")}) + 12)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents), i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
x AS (SELECT DISTINCT item_id, len(w) AS n, least(len(w), 10) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda p: array_to_string(w[p:p + least(len(w), 10) - 1], ' '))) AS g FROM i WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM x),
p AS (SELECT doc_id, k.k AS k, unnest(range(1, len(w) - k.k + 2)) AS pos, w FROM d, k WHERE len(w) >= k.k),
h AS (SELECT p.doc_id, p.pos, p.k, x.item_id FROM p JOIN x ON x.k = p.k AND x.g = array_to_string(p.w[p.pos:p.pos + p.k - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS pos FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages), s AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM s)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

_ABOVE = "(ORDER BY most / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
#: Targets by one sort: the sources that reach their limit are those of the least limit for their weight. Copies by the prefix sums themselves.
MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, ('0x' || left(md5('20240607:' || doc_id || ':' || md5(coalesce(text, ''))), 12))::BIGINT AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][r % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * n AS most FROM s),
o AS (SELECT *, (SELECT 1.5::DOUBLE * sum(n) FROM w) - coalesce(sum(most) OVER {_ABOVE}, 0) AS unspent, (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER {_ABOVE}, 0) AS total FROM w),
c AS (SELECT unspent, total FROM o WHERE unspent * weight / total <= most ORDER BY most / weight, r LIMIT 1),
t AS (SELECT source, n, least(c.unspent * weight / c.total, most) AS target, ('0x' || left(md5('20240607:offset:' || coalesce('=' || source, 'null')), 12))::BIGINT / 281474976710656.0::DOUBLE AS off FROM o, c),
k AS (SELECT d.*, t.n, t.target, t.off, CASE WHEN t.n > 0 THEN t.target / t.n ELSE 0 END AS e, row_number() OVER (PARTITION BY d.source ORDER BY size DESC, u, doc_id) AS i FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, n AS source_size, target, (CASE WHEN size = 0 THEN 0 WHEN e = floor(e) THEN e ELSE floor(i * e + off) - floor((i - 1) * e + off) END * size)::BIGINT AS taken FROM k
"""

ORACLES: dict[str, str] = {
    "op3_secret_ledger": SECRETS,
    "op4_mix_systematic": MIX,
    "op5_chat_fingerprint": CHAT,
    "op8_decontaminate": DECONTAMINATE,
    "op9_warc_index": WARC,
    "op10_jaccard_join": JACCARD,
}
