"""DuckDB SQL of the queries, written from the operators' contracts and independent of the Spark plans."""

from __future__ import annotations

_ORDER = "l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate"
_UP = "upper(translate({0}, 'iı', 'İI'))"
_LOW = "lower(translate({0}, 'Iİ', 'ıi'))"
_LETTERS = "translate(n_name, '0123456789_', 'ABCDEFGHIJ ')"
_MONTHS = "['ocak','şubat','mart','nisan','mayıs','haziran','temmuz','ağustos','eylül','ekim','kasım','aralık']"

_RAW = """CASE WHEN l_linenumber = 1 THEN replace(format('{:,}', n), ',', '.') WHEN l_linenumber = 2 THEN '(' || replace(format('{:,}', n), ',', '.') || ')' WHEN l_linenumber = 3 THEN format('{:,}', n)
  WHEN l_linenumber = 4 THEN replace(format('{:,}', n), ',', ',.') WHEN l_linenumber = 5 THEN translate(replace(format('{:,}', n), ',', '.'), '01', 'Ol')
  WHEN l_linenumber = 6 THEN CASE l_suppkey % 3 WHEN 0 THEN '%10,5' WHEN 1 THEN '-' ELSE '%2-%4' END WHEN l_suppkey % 2 = 0 THEN '' ELSE n::VARCHAR END"""

#: The amount grammar over a relation r(raw, ...): adds kind, value and repairs.
_AMOUNT = r"""
a1 AS (SELECT *, trim(raw) AS s, replace(trim(raw), ' ', '') AS tight FROM r),
a2 AS (SELECT *, translate(tight, 'OoDlI|iSB', '000111158') AS digits FROM a1),
a3 AS (SELECT *, trim(digits, '()-') AS bare, starts_with(digits, '(') AS o, ends_with(digits, ')') AS c FROM a2),
a4 AS (SELECT *, regexp_replace(bare, '[.,]{2,}', '.', 'g') AS one FROM a3),
a5 AS (SELECT *, regexp_full_match(one, '[0-9]+([.,][0-9]+)*') AS plain, length(one) - length(replace(replace(one, '.', ''), ',', '')) AS seps FROM a4),
a6 AS (SELECT *, seps = 1 AND contains(one, ',') AND starts_with(one, '0,') AS fraction, CASE WHEN plain THEN replace(replace(one, '.', ''), ',', '')::DOUBLE END AS whole FROM a5),
a7 AS (SELECT *, CASE WHEN s = '' THEN 'empty' WHEN s IN ('-', '–', '—', '_', '~', '−') THEN 'dash' WHEN regexp_full_match(s, '%\s*[0-9]+([.,][0-9]+)?') THEN 'percent'
  WHEN regexp_full_match(s, '%\s*[0-9]+([.,][0-9]+)?\s*-\s*%?\s*[0-9]+([.,][0-9]+)?') THEN 'percent_range' WHEN NOT plain THEN 'unparseable' WHEN fraction OR whole <> 0 THEN 'number' ELSE 'zero' END AS kind FROM a6),
a8 AS (SELECT *, CASE WHEN kind = 'percent' THEN replace(trim(s[2:]), ',', '.')::DOUBLE WHEN kind IN ('number', 'zero') THEN (CASE WHEN fraction THEN replace(one, ',', '.')::DOUBLE ELSE whole END) * (CASE WHEN o OR c THEN -1 ELSE 1 END) END AS value,
  CASE WHEN kind IN ('empty', 'dash', 'percent', 'percent_range') THEN [] ELSE list_filter([CASE WHEN digits <> tight THEN 'letter_as_digit' END, CASE WHEN o <> c THEN 'unbalanced_parenthesis' END, CASE WHEN one <> bare THEN 'doubled_separator' END,
    CASE WHEN NOT plain OR fraction THEN NULL WHEN seps = 0 AND length(one) > 3 THEN 'missing_thousands_separator' WHEN seps > 0 AND NOT regexp_full_match(one, '[0-9]{1,3}([.,][0-9]{3})+') THEN 'irregular_grouping'
      WHEN seps > 0 AND contains(one, ',') THEN 'comma_as_thousands_separator' END], lambda x: x IS NOT NULL) END AS repairs FROM a7)"""

_LADDER = """CASE WHEN date IS NOT NULL THEN CASE WHEN date = odate THEN 1.0 WHEN o_orderkey % 2 = 0 AND date = odate + 1 THEN 0.8 ELSE 0.0 END WHEN yr IS NOT NULL THEN CASE WHEN yr = year(odate) THEN 0.6 ELSE 0.0 END ELSE 0.3 END"""
_ORDER_LINES = """SELECT l.*, o.*, l_shipdate::DATE AS sdate, o_orderdate::DATE AS odate,
  CASE WHEN l_linenumber % 3 <> 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN o_orderdate::DATE + (l_suppkey % 3)::INT ELSE l_shipdate::DATE END END AS date, CASE WHEN l_linenumber <> 6 THEN year(l_shipdate) END AS yr
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey"""
_VALUE_CONFIDENCE = "round(0.4 * {ocr} + 0.2 * {fmt} + 0.4 * {proof}, 4)"
_FINAL = """
l AS (SELECT l_orderkey, l_linenumber, max(l_discount) AS d, max(l_tax) AS t, min(l_quantity) AS q, max(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN l_linenumber <= 5 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'equals_total' ELSE 'equals_movement' END END AS ra, CASE WHEN l_linenumber >= 3 THEN CASE WHEN l_linenumber % 3 = 0 THEN 'equals_total' ELSE 'equals_movement' END END AS rb,
  q > 10 AS amount_ok, CASE WHEN v > 60000 THEN 1.0::DOUBLE WHEN v > 20000 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS period_match FROM l),
c AS (SELECT *, round(0.35::DOUBLE * (CASE WHEN rb IS NOT NULL THEN round(1 - t, 4) ELSE round(1 - d, 4) END) + 0.25::DOUBLE * amount_ok::INT + 0.15::DOUBLE * period_match + 0.15::DOUBLE * (CASE WHEN ra IS NULL OR rb IS NULL THEN 0.3::DOUBLE WHEN ra = rb THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END) + 0.1::DOUBLE * 0.8::DOUBLE, 4) AS confidence FROM m),
f AS (SELECT *, coalesce(rb, ra) AS relation, CASE WHEN NOT amount_ok OR period_match = 0 THEN 'rejected' WHEN confidence < 0.7 THEN 'low_confidence' ELSE 'accepted' END AS status FROM c)"""
_SUMS = """
p AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS computed, count(*) AS n_parts FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey, o_totalprice AS expected, computed, n_parts, round(o_totalprice - computed, 2) AS difference, abs(round(o_totalprice - computed, 2)) <= 1 AS passed FROM orders JOIN p ON l_orderkey = o_orderkey)"""
_LINES = f"""
l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS k FROM lineitem)"""
_LIKENESS = """
h AS (SELECT label AS head_label, arg_min(embedding, vec_id) AS head, min(vec_id) AS head_id FROM embeddings GROUP BY label),
s AS (SELECT vec_id, label, head_label, head_id, round(list_inner_product(embedding::DOUBLE[], head::DOUBLE[]), 4) AS score FROM embeddings JOIN h ON head_label IN (label, label + 1))"""
_METHODS = """
a AS (SELECT doc_id, CASE WHEN n_chars > 2500 THEN '1' ELSE '0' END AS ra FROM documents WHERE n_chars > 800),
b AS (SELECT doc_id, max(quality)::VARCHAR AS rb FROM labels GROUP BY 1),
j AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, ra, rb FROM a FULL JOIN b ON a.doc_id = b.doc_id)"""

_EDGES = "e AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier)"
_BANDS = """
c AS (SELECT c_nationkey AS nation, c_mktsegment, min(c_acctbal) AS c0, quantile_cont(c_acctbal, 0.4) AS c1 FROM customer GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY c_mktsegment) - 1 AS col_idx FROM c),
w AS (SELECT s_suppkey, col_idx, greatest(0.0::DOUBLE, least(c1, s_acctbal + 500) - greatest(c0, s_acctbal - 500)) AS ov, abs(c1 - (s_acctbal + 500)) AS d FROM supplier JOIN k ON nation = s_nationkey)"""
_BLOCKS = """
k AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'header' WHEN role = 'assistant' THEN 'row' WHEN turn % 3 = 1 THEN 'row' ELSE 'text' END AS kind FROM conversations),
p AS (SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM k)"""
_NATION = f"""
n AS (SELECT n_nationkey, n_regionkey, {_LETTERS} AS letters, n_nationkey % 4 AS k, replace((n_nationkey + 1)::VARCHAR, '1', 'l') AS no FROM nation)"""
_REF = "list_filter(list_transform(regexp_extract_all(translate({0}, 'IlL|!iOoS', '111111005'), '[0-9]{{1,2}}'), lambda x: x::INT), lambda x: x BETWEEN 1 AND 99)"
_CAPS = r"(length(regexp_replace({0}, '[^\p{{L}}]', '', 'g')) >= 3 AND length(regexp_replace({0}, '[^\p{{Lu}}]', '', 'g')) / length(regexp_replace({0}, '[^\p{{L}}]', '', 'g')) > 0.8)"
_WORD = r"regexp_matches(low, '(^|[^\p{{L}}\p{{N}}_]){0}([^\p{{L}}\p{{N}}_]|$)')"

ORACLES: dict[str, str] = {
    "reconciliation": f"""WITH r AS (SELECT l_orderkey, 1 - l_discount AS ocr, {_RAW} AS raw FROM (SELECT *, floor(l_extendedprice)::BIGINT AS n FROM lineitem)), {_AMOUNT},
      b AS (SELECT *, CASE WHEN len(repairs) = 0 THEN 1.0 WHEN list_has_any(repairs, ['unbalanced_parenthesis', 'irregular_grouping', 'unreadable_ink']) THEN 0.0 ELSE 0.6 END AS fmt FROM a8),
      p AS (SELECT l_orderkey, sum(CASE WHEN kind IN ('number', 'zero') THEN value ELSE 0 END) AS computed, sum((kind = 'unparseable' OR fmt = 0.0)::INT)::BIGINT AS n_severe, avg({_VALUE_CONFIDENCE.format(ocr='ocr', fmt='fmt', proof='0.5')}::DECIMAL(10,4))::DOUBLE AS conf FROM b GROUP BY 1)
      SELECT o_orderkey, floor(o_totalprice)::DOUBLE AS expected, computed, floor(o_totalprice)::DOUBLE - computed AS difference, abs(floor(o_totalprice)::DOUBLE - computed) <= 1 AS passed, n_severe, round(conf, 4) AS confidence FROM orders JOIN p ON l_orderkey = o_orderkey""",
    "parse_amounts": f"""WITH r AS (SELECT l_orderkey, l_linenumber, {_RAW} AS raw FROM (SELECT *, floor(l_extendedprice)::BIGINT AS n FROM lineitem)), {_AMOUNT}
      SELECT l_orderkey, l_linenumber, raw, kind, value, array_to_string(repairs, '+') AS repairs FROM a8""",
    "amount_tokens": r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \n]+'), lambda x: x <> '') AS t FROM documents)
      SELECT doc_id, len(t) AS n_tokens, len(list_filter(t, lambda x: regexp_matches(x, '[0-9][0-9.,]{2,}') OR regexp_full_match(x, '\(?0,[0-9]+\)?'))) AS n_amounts FROM t""",
    "label_clean": rf"""WITH r AS (SELECT p_partkey, ['- ', '~', '__ ', ''][(p_partkey % 4 + 1)::INT] || replace(p_name, ' ', '_ ') || ' .:' AS raw FROM part),
      s AS (SELECT p_partkey, trim(regexp_replace(replace(regexp_replace(raw, '^\s*[-~–—_]+\s*', ''), '_', ' '), '\s+', ' ', 'g'), ' .:;') AS s FROM r)
      SELECT p_partkey, CASE WHEN regexp_matches(s, '^\p{{Ll}}') THEN {_UP.format('s[1:1]')} || s[2:] ELSE s END AS label FROM s""",
    "tr_casefold": f"SELECT p_partkey, {_UP.format('s')} AS up, {_LOW.format('s')} AS low FROM (SELECT p_partkey, p_name || ' ' || p_type || ' ıİ' AS s FROM part)",
    "all_caps_lines": f"SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, len(list_filter(string_split(text, chr(10)), lambda x: coalesce({_CAPS.format('x')}, false))) AS n_caps FROM documents",
    "note_refs": f"""WITH s AS (SELECT DISTINCT l_suppkey, l_linenumber, l_linenumber || 'I ' || (l_suppkey % 97) || CASE WHEN l_suppkey % 2 = 0 THEN 'l' ELSE '' END AS s FROM lineitem)
      SELECT l_suppkey, l_linenumber, array_to_string({_REF.format('s')}, ',') AS refs, translate(s, 'IlL|!iOoS', '111111005') <> s AS repaired FROM s""",
    "period_headers": rf"""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 4 AS k FROM orders),
      h AS (SELECT o_orderkey, CASE k WHEN 0 THEN 'Bağımsız Denetimden Geçmiş 1 Ocak - ' || said WHEN 1 THEN said WHEN 2 THEN 'Denetimden Geçmemiş 31 Şubat ' || year(d) ELSE 'Dipnot' END AS header FROM (SELECT *, day(d) || ' ' || ['Ocak','Şubat','Mart','Nisan','Mayıs','Haziran','Temmuz','Ağustos','Eylül','Ekim','Kasım','Aralık'][month(d)] || ' ' || year(d) AS said FROM o)),
      l AS (SELECT o_orderkey, {_LOW.format('header')} AS low FROM h),
      y AS (SELECT *, regexp_extract_all(low, '(?:19|20)[0-9]{{2}}')[-1]::INT AS year, regexp_extract_all(low, '([0-9]{{1,2}})\s*(?:ocak|şubat|mart|nisan|mayıs|haziran|temmuz|ağustos|eylül|ekim|kasım|aralık)', 1) AS ds, regexp_extract_all(low, '[0-9]{{1,2}}\s*(ocak|şubat|mart|nisan|mayıs|haziran|temmuz|ağustos|eylül|ekim|kasım|aralık)', 1) AS ms FROM l),
      t AS (SELECT *, CASE WHEN year IS NULL THEN [] ELSE list_filter(list_transform(range(1, len(ds) + 1), lambda i: try_cast(year || '-' || lpad(list_position({_MONTHS}, ms[i])::VARCHAR, 2, '0') || '-' || lpad(ds[i], 2, '0') AS DATE)), lambda x: x IS NOT NULL) END AS dates FROM y)
      SELECT o_orderkey, CASE WHEN year IS NULL THEN NULL WHEN len(dates) >= 2 THEN 'duration' ELSE 'instant' END AS type, CASE WHEN len(dates) >= 2 THEN strftime(dates[1], '%Y-%m-%d') END AS start,
        CASE WHEN year IS NULL THEN NULL WHEN len(dates) >= 2 THEN strftime(dates[-1], '%Y-%m-%d') WHEN len(dates) = 1 THEN strftime(dates[1], '%Y-%m-%d') ELSE year || '-12-31' END AS "end", year, contains(low, 'denetim') AND NOT contains(low, 'denetimden geçmemiş') AS audited FROM t""",
    "currency_units": f"""WITH s AS (SELECT p_partkey, {_LOW.format("['Tutarlar TL olarak', 'bin Türk Lirası', 'milyon ABD Doları', 'Avro', 'atlı binek', 'Tutarlar bin TL'][p_size % 6 + 1]")} AS low FROM part)
      SELECT p_partkey, CASE WHEN contains(low, 'türk lirası') OR {_WORD.format('tl')} THEN 'TRY' WHEN contains(low, 'abd doları') THEN 'USD' WHEN contains(low, 'avro') THEN 'EUR' END AS currency, CASE WHEN {_WORD.format('bin')} THEN 1000 WHEN contains(low, 'milyon') THEN 1000000 ELSE 1 END AS scale FROM s""",
    "date_ladder": f"WITH j AS ({_ORDER_LINES}) SELECT o_orderpriority, ({_LADDER})::DOUBLE AS period_match, count(*) AS n FROM j GROUP BY 1, 2",
    "value_columns": """WITH s AS (SELECT *, CASE WHEN value - lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) > 5 THEN 1 ELSE 0 END AS f FROM events),
      c AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM s)
      SELECT user_id, cluster, count(*) AS n, round(quantile_cont(value, 0.05), 6) AS x0, round(quantile_cont(value, 0.9), 6) AS x1 FROM c GROUP BY 1, 2 HAVING count(*) >= 3""",
    "indent_levels": """WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 7 <> 0 THEN round_even(p_size * 3.5, 0) END AS x FROM part), d AS (SELECT DISTINCT p_brand, x FROM p WHERE x IS NOT NULL),
      g AS (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY p_brand ORDER BY x) > 5 THEN 1 ELSE 0 END AS f FROM d), l AS (SELECT p_brand, x, sum(f) OVER (PARTITION BY p_brand ORDER BY x ROWS UNBOUNDED PRECEDING)::INT AS indent FROM g)
      SELECT p_partkey, coalesce(indent, -1) AS indent FROM p LEFT JOIN l ON p.p_brand = l.p_brand AND p.x = l.x""",
    "interval_assign": f"WITH {_BANDS} SELECT s_suppkey, first(col_idx ORDER BY ov DESC, col_idx) AS best, round(max(ov), 6) AS best_overlap FROM w GROUP BY 1",
    "nearest_edge": f"WITH {_BANDS} SELECT s_suppkey, first(col_idx ORDER BY d, col_idx) AS nearest FROM w GROUP BY 1",
    "line_text_agg": "SELECT conv_id, count(*) AS n, sha256(string_agg(text, ' ' ORDER BY turn, role, text)) AS sha FROM conversations GROUP BY 1",
    "page_offset_mode": f"""WITH j AS ({_ORDER_LINES}), v AS (SELECT o_orderpriority, (sdate - DATE '1970-01-01') - (odate - DATE '1970-01-01') AS page_offset, count(*) AS votes, min(sdate) AS f FROM j WHERE odate <> DATE '1970-01-01' GROUP BY 1, 2)
      SELECT o_orderpriority, first(page_offset ORDER BY votes DESC, f) AS page_offset FROM v GROUP BY 1""",
    "heading_regex": rf"""WITH {_NATION}, h AS (SELECT n_nationkey, CASE k WHEN 0 THEN no || '. ' || letters WHEN 1 THEN 'NOT ' || no || ' - ' || letters || ' (devamı)' WHEN 2 THEN no || ' ' || lower(letters) ELSE letters END AS s FROM n),
      m AS (SELECT *, regexp_extract(s, '^(?:NOT\s*)?([0-9IlL|]{{1,2}})\s*[.:\-_]?\s+([^0-9]{{3,}})$', 1) AS g1, trim(regexp_extract(s, '^(?:NOT\s*)?([0-9IlL|]{{1,2}})\s*[.:\-_]?\s+([^0-9]{{3,}})$', 2)) AS g2 FROM h),
      r AS (SELECT *, trim(regexp_replace(g2, '(?i)\(devam.*$', '')) AS title, {_REF.format('g1')} AS refs FROM m), q AS (SELECT *, g1 <> '' AND len(refs) > 0 AND coalesce({_CAPS.format('title')}, false) AS ok FROM r)
      SELECT n_nationkey, CASE WHEN ok THEN refs[1] END AS note_no, CASE WHEN ok THEN title END AS title, CASE WHEN ok THEN regexp_matches(g2, '(?i)\(devam') END AS continued FROM q""",
    "toc_regex": rf"""WITH {_NATION}, t AS (SELECT n_nationkey, regexp_replace(trim('NOT ' || no || '  ' || letters || CASE WHEN k = 3 THEN '' ELSE ' .... ' || (n_regionkey + 10) || CASE WHEN k = 1 THEN ' - ' || (n_nationkey + 20) ELSE '' END END), '\s+', ' ', 'g') AS s FROM n),
      m AS (SELECT *, regexp_extract(s, '^NOT\s*([0-9IlL|]{{1,2}})\s+(.+?)[\s.\-_]*([0-9]{{1,3}})(?:\s*-\s*([0-9]{{1,3}}))?$', ['a', 'b', 'c', 'd']) AS g FROM t), r AS (SELECT *, {_REF.format('g.a')} AS refs FROM m)
      SELECT n_nationkey, CASE WHEN g.a <> '' AND len(refs) > 0 THEN refs[1] END AS note_no, CASE WHEN g.a <> '' AND len(refs) > 0 THEN trim(g.b, ' .-_') END AS title, CASE WHEN g.a <> '' AND len(refs) > 0 THEN try_cast(g.c AS INT) END AS first_page, CASE WHEN g.a <> '' AND len(refs) > 0 THEN try_cast(coalesce(nullif(g.d, ''), g.c) AS INT) END AS last_page FROM r""",
    "contiguous_run": """WITH b AS (SELECT *, sum(CASE WHEN (turn < 4 AND role <> 'assistant') OR turn = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS broken FROM conversations) SELECT conv_id, turn, role FROM b WHERE broken = 0""",
    "trailing_values": f"""WITH w AS (SELECT p_partkey, string_split(p_name || ' ' || p_size || ' ' || CASE WHEN p_size % 2 = 0 THEN 'adet' ELSE '-' END || ' ' || (p_partkey * 37) || ' ' || CASE WHEN p_size % 3 = 0 THEN '%5' ELSE '0' END, ' ') AS ws FROM part),
      r AS (SELECT p_partkey, i, ws[i] AS raw FROM (SELECT p_partkey, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)), {_AMOUNT},
      t AS (SELECT *, bool_and(kind IN ('number', 'zero', 'dash', 'percent', 'percent_range')) OVER (PARTITION BY p_partkey ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM a8)
      SELECT p_partkey, count(*) AS n_words, count(*) FILTER (v) AS n_values FROM t GROUP BY 1""",
    "row_blocks": f"""WITH {_BLOCKS} SELECT conv_id, turn, kind, CASE WHEN kind = 'row' THEN (sum((kind = 'row' AND coalesce(prev, '') <> 'row')::INT) OVER w)::BIGINT END AS block, (sum((kind = 'header' AND coalesce(prev, '') <> 'header')::INT) OVER w)::BIGINT AS header_run
      FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""",
    "sum_checks": f"WITH {_SUMS} SELECT o_orderkey, expected, computed, n_parts, difference, passed FROM s",
    "prefix_match": f"""WITH {_LINES}, r AS (SELECT *, sum(l_extendedprice::DECIMAL(18,2)) OVER (PARTITION BY l_orderkey ORDER BY k ROWS UNBOUNDED PRECEDING) AS running FROM l), t AS (SELECT l_orderkey, max(CASE WHEN k <= 2 + l_orderkey % 3 THEN running END) AS target FROM r GROUP BY 1)
      SELECT r.l_orderkey, min(k) AS length, min(target)::DOUBLE AS target FROM r JOIN t ON r.l_orderkey = t.l_orderkey WHERE k BETWEEN 2 AND 14 AND abs(running - target) <= 1 GROUP BY 1""",
    "single_component": f"WITH {_LINES}, n AS (SELECT *, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY k) AS a FROM l) SELECT l_orderkey, k, l_quantity FROM n WHERE abs(l_quantity - a) <= 1",
    "subtree_size": f"""WITH RECURSIVE {_EDGES}, b(node, member) AS (SELECT node, node FROM (SELECT parent AS node FROM e UNION SELECT child FROM e) UNION ALL SELECT b.node, e.child FROM b JOIN e ON e.parent = b.member) SELECT node, count(*) AS size FROM b GROUP BY 1""",
    "cell_row_confidence": f"""WITH c AS (SELECT l_orderkey, {_VALUE_CONFIDENCE.format(ocr='(1 - l_discount)', fmt="(CASE WHEN l_linenumber < 4 THEN 1.0::DOUBLE WHEN l_linenumber < 6 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END)", proof="(CASE l_returnflag WHEN 'A' THEN 1.0::DOUBLE WHEN 'R' THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END)")} AS c FROM lineitem)
      SELECT l_orderkey, round(avg(c::DECIMAL(10,4))::DOUBLE, 4) AS values_conf, count(*) FILTER (c < 0.7) AS n_low FROM c GROUP BY 1""",
    "best_candidate": f"""WITH j AS ({_ORDER_LINES}), m AS (SELECT *, CASE WHEN abs(o_totalprice - l_extendedprice) <= 1 THEN 1.0 WHEN abs(abs(o_totalprice) - abs(l_extendedprice)) <= 1 THEN 0.8 ELSE 0.0 END AS vm, ({_LADDER})::DOUBLE AS pm FROM j)
      SELECT o_orderkey, first(l_linenumber ORDER BY vm DESC, pm DESC, (l_returnflag = 'A') DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS best_line, max(pm) AS best_period FROM m WHERE pm > 0 GROUP BY 1""",
    "embedding_score": f"WITH {_LIKENESS} SELECT vec_id, label, score FROM s WHERE label = head_label",
    "fit_threshold": f"""WITH {_LIKENESS}, d AS (SELECT score, count(*) AS n, count(*) FILTER (label = head_label) AS tp FROM s GROUP BY 1),
      c AS (SELECT score, lag(score) OVER (ORDER BY score) AS lower, sum(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pred, sum(tp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp FROM d), g AS (SELECT sum(tp) AS gold FROM d)
      SELECT round(first((score + lower) / 2 ORDER BY 2.0 * tp / (pred + gold) DESC, score), 4) AS threshold, 'control_examples' AS source FROM c, g WHERE lower IS NOT NULL""",
    "topk_candidates": "WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY round(o_totalprice / 100000, 0) DESC, o_orderkey) AS rank FROM orders) SELECT * FROM r WHERE rank <= 30",
    "breakdown_expand": f"""WITH {_LINES}, t AS (SELECT l_orderkey, max(k) AS m FROM l GROUP BY 1 HAVING count(*) >= 2)
      SELECT l.l_orderkey::VARCHAR AS item_id, l.l_orderkey || '_' || lpad(k::VARCHAR, 3, '0') AS note_row, floor(l_extendedprice)::DOUBLE AS value FROM l JOIN t ON l.l_orderkey = t.l_orderkey WHERE l.l_orderkey % 2 = 0""",
    "compare_methods": f"WITH {_METHODS} SELECT CASE WHEN rb IS NULL THEN 'only_a' WHEN ra IS NULL THEN 'only_b' WHEN ra = rb THEN 'both_same_relation' ELSE 'both_different_relation' END AS verdict, count(*) AS n FROM j GROUP BY 1",
    "evaluate_links": f"""WITH {_METHODS}, c AS (SELECT count(*) FILTER (ra IS NOT NULL AND rb IS NOT NULL) AS tp, count(ra) AS p, count(rb) AS g, count(*) FILTER (ra = rb) AS same FROM j)
      SELECT round(tp / p, 3) AS precision, round(tp / g, 3) AS recall, round(2 * (tp / p) * (tp / g) / (tp / p + tp / g), 3) AS f1, round(same / tp, 3) AS relation_accuracy, p - tp AS n_false, g - tp AS n_missed FROM c""",
    "fallback_union": "SELECT doc_id, quality, 'B' AS method FROM labels UNION ALL SELECT doc_id, (n_chars > 2500)::INT, 'A_fallback' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "final_links": f"WITH {_FINAL} SELECT l_orderkey, l_linenumber, relation, amount_ok, period_match, confidence, status FROM f",
    "validation_checks": f"""WITH {_FINAL.replace("l AS", "ln AS").replace("FROM l)", "FROM ln)")}, {_SUMS}, r AS (SELECT l_linenumber, l_suppkey, l_returnflag, l_shipdate, {_RAW} AS raw FROM (SELECT *, floor(l_extendedprice)::BIGINT AS n FROM lineitem)), {_AMOUNT},
      v AS (SELECT 'links_between_compatible_periods' AS "check", count(*) FILTER (period_match = 0) AS n_bad, count(*) AS n FROM f UNION ALL SELECT 'linked_amounts_agree', count(*) FILTER (NOT amount_ok), count(*) FROM f
      UNION ALL SELECT 'summary_table_sums', count(*) FILTER (NOT passed), count(*) FROM s UNION ALL SELECT 'note_table_sums', count(*) FILTER (NOT passed), count(*) FROM s WHERE n_parts >= 4
      UNION ALL SELECT 'tables_on_configured_pages', count(*) FILTER (l_linenumber NOT BETWEEN 1 AND 7), count(*) FROM a8 UNION ALL SELECT 'note_refs_on_value_rows', count(*) FILTER (kind = 'empty'), count(*) FROM a8 WHERE l_suppkey % 97 = 11
      UNION ALL SELECT 'numbers_parsed', count(*) FILTER (kind = 'unparseable' OR list_has_any(repairs, ['unbalanced_parenthesis', 'irregular_grouping', 'unreadable_ink'])), count(*) FROM a8 UNION ALL SELECT 'periods_present', count(*) FILTER (l_shipdate IS NULL), count(*) FROM a8
      UNION ALL SELECT 'assets_equal_liabilities_plus_equity', 0, CASE WHEN count(DISTINCT l_returnflag) = 2 THEN count(*) ELSE 0 END FROM lineitem
      UNION ALL SELECT 'period_columns_distinct', count(*) FILTER (o_orderdate IS NULL), count(*) FROM orders UNION ALL SELECT 'currency_present_and_consistent', count(DISTINCT o_orderstatus) - 1, count(*) FROM orders UNION ALL SELECT 'note_pages_found', (count(*) = 0)::INT, 1 FROM orders)
      SELECT "check", CASE WHEN n > 0 THEN n_bad = 0 END AS passed, n_bad::BIGINT AS n_bad, n::BIGINT AS n FROM v""",
    "document_json": """SELECT o_orderkey, to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'order': {'o_custkey': o_custkey, 'o_totalprice': o_totalprice},
      'lines': (SELECT list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey, 'l_quantity': l_quantity, 'l_extendedprice': l_extendedprice} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) FROM lineitem WHERE l_orderkey = o_orderkey)})::VARCHAR AS document
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
}
