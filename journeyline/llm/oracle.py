"""DuckDB SQL for the queries whose results SQL can express, written from the contracts and not from the operators."""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_WORDS.format(_LOWER)}, []) AS w FROM documents),
sh AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM d),
n AS (SELECT d.doc_id, count(s) AS n FROM d LEFT JOIN sh USING (doc_id) GROUP BY d.doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN comp USING (doc_id)
"""

OP2 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
h AS (SELECT page_id, octet_length(raw) AS payload_bytes, sha1(raw) AS hex FROM p),
bits AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111',
           '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', hex[i])]), lambda a, b: a || b) AS b FROM h),
coded AS (SELECT *, list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
            1 + 16 * b[5 * i + 1]::INT + 8 * b[5 * i + 2]::INT + 4 * b[5 * i + 3]::INT + 2 * b[5 * i + 4]::INT + b[5 * i + 5]::INT]),
            lambda x, y: x || y) AS payload_digest, min(page_id) OVER (PARTITION BY hex) AS first FROM bits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS complete FROM coded
"""

# the offset's start comes from eight hexadecimal digits of an md5; the sums of all offsets are compared with the target
OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0) AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
       substr(md5(coalesce('source:' || source, 'no source')), 1, 8) AS hex FROM s0),
fill AS (SELECT *, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS left_weight,
                sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS left_size
         FROM s1 WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT *, left_size::DOUBLE / left_weight AS share FROM fill),
factor AS (SELECT arg_min(share, 3 * source_size / weight) AS factor FROM share WHERE weight * share <= 3 * source_size),
t AS (SELECT source, source_size, CASE WHEN factor IS NULL THEN (3 * source_size)::DOUBLE ELSE least((3 * source_size)::DOUBLE, weight * factor) END AS target,
      list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', hex[i]) - 1) * (16 ** (8 - i))))::DOUBLE / 4294967296.0 AS start
      FROM share LEFT JOIN factor ON true),
r AS (SELECT d.*, source_size, target, start, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
      row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT source, k, CASE WHEN start + k / 32.0::DOUBLE >= 1 THEN start + k / 32.0::DOUBLE - 1 ELSE start + k / 32.0::DOUBLE END AS turn
      FROM t, range(0, 32) AS x(k)),
sums AS (SELECT r.source, k, turn, abs(sum(least(floor(place * each + turn) - floor((place - 1) * each + turn), 3) * size) - any_value(target)) AS off
         FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source GROUP BY ALL),
best AS (SELECT source, arg_min(turn, (off, k)) AS turn FROM sums GROUP BY source)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies
FROM (SELECT r.*, least(floor(place * each + turn) - floor((place - 1) * each + turn), 3)::BIGINT AS copies
      FROM r JOIN best ON r.source IS NOT DISTINCT FROM best.source)
"""

# no seeds: of 13 words of which 10 agree, three neighbours agree, so every diagonal with three equal words in a row is compared
OP8 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format('lower(text)')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('lower(text)')} AS w FROM benchmark),
dk AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS k FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d)),
bk AS (SELECT item_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS k FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM b WHERE len(w) > 5)),
hit AS (SELECT DISTINCT doc_id, item_id, dk.i - bk.i AS diagonal FROM dk JOIN bk USING (k)
        UNION ALL SELECT DISTINCT doc_id, item_id, 0 FROM d JOIN b USING (w) WHERE len(w) BETWEEN 1 AND 5),
win AS (SELECT doc_id, item_id, diagonal, unnest(range(1, greatest(len(b.w) - 12, 1) + 1)) AS s, d.w AS own, b.w AS theirs
        FROM hit JOIN d USING (doc_id) JOIN b USING (item_id)),
m AS (SELECT doc_id, item_id, diagonal, s - 1 AS item_start, len(theirs) AS n, len(list_filter(range(s, least(s + 13, len(theirs) + 1)),
        lambda x: x + diagonal >= 1 AND x + diagonal <= len(own) AND own[greatest(x + diagonal, 1)] = theirs[x])) AS matched FROM win)
SELECT doc_id, item_id, matched, item_start + diagonal AS text_start, item_start FROM m WHERE matched >= least(10, n)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, item_start, diagonal) = 1
"""


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


# CRC-32 of the decimal doc_id: each byte is put in, then eight shifts (marked -1) follow
_CRC = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

# nodes of every level by source, then over the subroots; a leaf's run at a level is known by its rank
OP11 = f"""
WITH RECURSIVE d AS (SELECT *, {_leaf("text::VARCHAR")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS stripped, {_CRC} AS crc FROM documents),
ranked AS (SELECT row_number() OVER () AS id, doc_id, source, leaf, CASE WHEN crc % 2 = 0 THEN stripped ELSE leaf END AS now,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
lv AS (SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM ranked GROUP BY source
       UNION ALL
       SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM lv WHERE len(nodes) > 1),
sub AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM lv WHERE len(nodes) = 1),
tv AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM sub
       UNION ALL
       SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM tv WHERE len(nodes) > 1),
runs AS (SELECT id, 0 AS tree, level, nodes, place // (3 ** level)::BIGINT AS pos FROM ranked JOIN lv ON ranked.source IS NOT DISTINCT FROM lv.source WHERE len(nodes) > 1
         UNION ALL
         SELECT id, 1, level, nodes, sub.place // (3 ** level)::BIGINT FROM ranked JOIN sub ON ranked.source IS NOT DISTINCT FROM sub.source, tv WHERE len(nodes) > 1),
sides AS (SELECT id, tree, level, array_to_string(list_filter(nodes[pos // 3 * 3 + 1:pos // 3 * 3 + 3], lambda x, i: pos // 3 * 3 + i <= pos), '') AS l,
                 array_to_string(list_filter(nodes[pos // 3 * 3 + 1:pos // 3 * 3 + 3], lambda x, i: pos // 3 * 3 + i > pos + 1), '') AS r FROM runs),
paths AS (SELECT id, string_agg(l || r, '' ORDER BY tree, level) AS beside, list(l || '|' || r ORDER BY tree, level) AS steps FROM sides GROUP BY id),
proved AS (SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tv WHERE len(nodes) = 1) AS root, sha256(coalesce(beside, '')) AS proof_sha256,
                  list_reduce(list_prepend(now, coalesce(steps, [])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
           FROM ranked JOIN sub ON ranked.source IS NOT DISTINCT FROM sub.source LEFT JOIN paths USING (id))
SELECT *, folded_root = root AS verified FROM proved
"""

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format('t')} AS w FROM d),
f AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM letters p, letters q, letters r, letters s, letters u
           WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (SELECT filter_order, step::INT AS step, 1 << (strpos('ABCDE', substr(filter_order, step, 1)) - 1)::INT AS own,
                 coalesce(list_sum(list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda x: CASE WHEN x <> '' THEN 1 << (strpos('ABCDE', x) - 1)::INT ELSE 0 END)), 0)::INT AS past
          FROM orders, range(1, 6) AS k(step))
SELECT part, filter_order, step, coalesce(sum(n) FILTER (mask & (own | past) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & own <> 0 AND mask & past = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & own <> 0 AND mask & past <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (mask & own <> 0 AND mask & past = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & past = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & own <> 0), 0)::BIGINT AS shapley
FROM m, steps GROUP BY ALL
"""

OP13 = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS asked FROM p),
c AS (SELECT page_id, host, path, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') AS name,
             regexp_replace(path, '/+$', '') || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS tail FROM h),
rules(rule, act, its_host, its_path) AS (VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
      ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')),
r AS (SELECT *, CASE WHEN name <> '' THEN name || tail END AS url_key,
             (SELECT arg_max(rule, len(rule)) FROM rules WHERE (host = its_host OR ends_with(host, '.' || its_host)) AND starts_with(path, its_path)) AS its_rule FROM c),
listed AS (SELECT DISTINCT url_key FROM r WHERE url_key IS NOT NULL
           AND list_has_any(string_split(replace(host, '-', '.'), '.'), ['casino', 'pills', 'bets', 'adult', 'spam', 'ads'])),
v AS (SELECT r.*, act, act IS NULL AND l.url_key IS NOT NULL AS listed FROM r LEFT JOIN rules ON its_rule = rule LEFT JOIN listed l ON r.url_key = l.url_key)
SELECT page_id, host, path, its_rule AS rule, coalesce(act, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM v
"""

ORACLE = {"op1_minhash": OP1, "op2_warc": OP2, "op3_mixing": OP3, "op8_decontamination": OP8, "op11_merkle": OP11, "op12_filter_audit": OP12,
          "op13_url_filters": OP13}
