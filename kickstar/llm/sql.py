"""DuckDB SQL for the training-data queries that SQL can express, written from their definitions."""

from __future__ import annotations

from kickstar.llm import licenses, quality

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "regexp_extract_all(translate(coalesce({t}, ''), '" + UP + "', '" + LOW + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACE_WORDS = "regexp_extract_all(coalesce({t}, ''), '[^\\x20\\x09-\\x0D]+')"


def _w(t: str = "text") -> str:
    return _WORDS.format(t=t)


def _s(t: str = "text") -> str:
    return _SPACE_WORDS.format(t=t)


OP1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS hex FROM p),
f AS (SELECT hex, min(page_id) AS first FROM h GROUP BY hex),
d AS (SELECT page_id, n, hex, first, list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)) AS chars
      FROM h JOIN f USING (hex))
SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(chars, '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def _op2() -> str:
    phrases, labels, weights, places, base = [], [], [], [], []
    for t in licenses.BASE:
        run = licenses.split_words(t.markup)
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(run))
        at = f"list_filter(range(0, len(w)), lambda i: {test})"
        places.append(at)
        base.append(f"CASE WHEN len({at}) > 0 THEN '{t.label}' END")
        weights.append(f"CASE WHEN len({at}) > 0 THEN {licenses.weight(len(run))!r} ELSE 0 END")

    def pattern(items: list) -> str:
        out = ""
        for x in items:
            out += f"{x} " if isinstance(x, str) else f"(?:{pattern(x)})?" if isinstance(x, list) else f"(?:[^ ]+ ){{{x[1]},{x[2]}}}"
        return out

    for t in licenses.TEMPLATES:
        test = f"regexp_matches(j, '(?:^| ){pattern(licenses.parts(t.markup))}')"
        labels.append(f"CASE WHEN {test} THEN '{t.label}' END")
        weights.append(f"CASE WHEN {test} THEN {licenses.weight(licenses.mandatory_words(t.markup))!r} ELSE 0 END")
    joined = "array_to_string(list_sort(list_distinct(list_filter([{}], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH t AS (SELECT doc_id, {_w()} AS w FROM documents),
u AS (SELECT doc_id, w, array_to_string(list_transform(w, lambda x: x || ' '), '') AS j,
             list_concat(list_concat({places[0]}, {places[1]}), {places[2]}) AS places FROM t)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       {joined.format(', '.join(base))} AS base_labels, {joined.format(', '.join(base + labels))} AS labels,
       greatest({', '.join(weights)})::DOUBLE AS score
FROM u
"""


def _op3() -> str:
    stops = ", ".join(f"'{x}'" for x in dict.fromkeys(quality.STOP_WORDS))
    fails = []
    for r in quality.RULES:
        for bound, sign in ((r.low, "<"), (r.high, ">")):
            if bound is not None:
                p, q = quality.fraction(bound)
                fails.append(f"{r.metric} * {q} {sign} {r.per} * {p}")
    return f"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_s()} AS w FROM documents),
l AS (SELECT k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
g AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
d AS (SELECT k, g FROM g GROUP BY k, g HAVING count(*) > 1),
c AS (SELECT k, count(DISTINCT i + o) AS n FROM g JOIN d USING (k, g), (VALUES (0), (1), (2)) AS v(o) GROUP BY k),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l) AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words
      FROM t JOIN l USING (k) LEFT JOIN c USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {' OR '.join(fails)}) AS kept
FROM b
"""


OP4 = f"""
WITH r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS url FROM pages),
u AS (SELECT k, page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UP}', '{LOW}') AS host,
             regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
f AS (SELECT k, rh || rp AS rule, rv, row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC, length(rh) DESC) AS n
      FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM f WHERE n = 1) USING (k)
"""

OP5 = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, length(coalesce(text, '')) AS n,
                  coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS who FROM documents),
z AS (SELECT source, sum(n)::DOUBLE AS size FROM d GROUP BY source),
r AS (SELECT source, CASE WHEN size = 0 THEN 1.0
             ELSE sqrt(size) / sum(sqrt(size)) OVER () * sum(size) OVER () / size END AS rate FROM z),
s AS (SELECT source, ceil(rate / 16)::INT AS parts, rate / ceil(rate / 16) AS part FROM r WHERE rate > 0),
c AS (SELECT source, i, sum(exp(i * ln(part) - part - lgamma(i + 1))) OVER (PARTITION BY source ORDER BY i) AS cdf
      FROM s, range(0, 81) AS t(i)),
u AS (SELECT k, source, j, ('0x' || substr(md5('17:' || who || ':' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
      FROM (SELECT k, d.source, who, unnest(range(1, parts + 1)) AS j FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)),
n AS (SELECT k, count(*) AS n FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND cdf <= u GROUP BY k)
SELECT doc_id, source, copy, d.n::BIGINT AS n_chars, md5('17:order:' || who || ':' || copy) AS shuffle_key
FROM (SELECT k, unnest(range(0, n)) AS copy FROM n) JOIN d USING (k)
"""

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_w()} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS m FROM (SELECT item_id, {_w()} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
lens AS (SELECT DISTINCT m FROM win),
pos AS (SELECT k, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens)),
hit AS (SELECT pos.k, pos.i, pos.m, win.item_id FROM pos JOIN win USING (m, s)),
n AS (SELECT k, count(DISTINCT x) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + m)) AS x FROM hit) GROUP BY k),
it AS (SELECT k, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, item_id::VARCHAR AS id FROM hit) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (k) LEFT JOIN it USING (k)
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, {_w()} AS w FROM documents),
g AS (SELECT DISTINCT k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT k, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
z AS (SELECT k, count(*) AS n FROM g GROUP BY k),
p AS (SELECT x.k AS a, y.k AS b, count(*) AS common FROM g AS x JOIN g AS y USING (g) WHERE x.k <> y.k GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN z AS za ON a = za.k JOIN z AS zb ON b = zb.k WHERE 9 * common >= 4 * (za.n + zb.n)),
r(k, o) AS (SELECT k, k FROM d UNION SELECT r.k, e.b FROM r JOIN e ON r.o = e.a),
c AS (SELECT r.k, min(d.doc_id) AS class_id FROM r JOIN d ON r.o = d.k GROUP BY r.k),
l AS (SELECT a AS k, count(*) AS n FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links FROM d JOIN c USING (k) LEFT JOIN l USING (k)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i, l[i + 1] AS line FROM (SELECT doc_id, l, unnest(range(0, len(l))) AS i FROM d)),
t AS (SELECT doc_id, i, line, len({_s('line')}) AS w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq
      FROM x WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
pairs AS (SELECT b.doc_id, b.seq, b.i, b.w, a.doc_id AS other, b.seq - a.seq AS shift
          FROM t AS a JOIN t AS b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.seq < b.seq))),
runs AS (SELECT *, seq - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY seq) AS run FROM pairs),
long AS (SELECT doc_id, other, shift, run FROM runs GROUP BY ALL HAVING sum(w) >= 50),
g AS (SELECT DISTINCT runs.doc_id, runs.i FROM runs JOIN long USING (doc_id, other, shift, run)),
kept AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY x.i) AS text, count(*) AS n
         FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i WHERE g.i IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n, 0))::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL OR coalesce(n, 0) < len(l) THEN md5(coalesce(kept.text, '')) END AS text_md5
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP10 = f"""
WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT source, lang, CASE WHEN quality = 1 THEN 'words-2' ELSE 'space-words-1' END AS tokenizer,
             CASE WHEN quality = 1 THEN len({_w()}) ELSE len({_s()}) END AS n
      FROM documents LEFT JOIN l USING (doc_id) WHERE coalesce(toxic, 0) <> 1)
SELECT source, lang, tokenizer, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens FROM d GROUP BY ALL
"""

OP11 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d WHERE length(h) >= 200)),
r AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
b AS (SELECT *, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS gap FROM r),
s AS (SELECT doc_id, min(p) AS lo, max(p) + 100 AS hi FROM (SELECT *, sum(gap) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM b) GROUP BY doc_id, run),
k AS (SELECT doc_id, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS lo, lo AS hi FROM s
      UNION ALL SELECT doc_id, coalesce(max(hi), 0), max(length(h) // 2) FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(hi - lo) AS n, count(*) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n.n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP12 = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UP}', '{LOW}') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
      FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d)),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS v(m) WHERE len(w) >= m)
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE m > 1),
cut AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
        JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
        JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cut) WHERE nth = 1),
kept AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = s.lang AND length(c.phrase) > length(s.phrase) AND 100 * c.a >= 80 * s.a
                                           AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, words.n AS n, score::BIGINT AS score FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

def _op13() -> str:
    """The grammar as an automaton: 0 nothing yet, 1 after the system row, 2 an assistant is due,
    3 a user is due or the end. Backwards over the rows, the least (cost, audit) of every state."""
    due, after = {0: "u", 1: "u", 2: "a", 3: "u"}, {0: 2, 1: 2, 2: 3, 3: 2}
    touch, insert = [], []
    for p in range(4):
        q = after[p]
        ways = [f"{{'c': 4 + v.s{p}.c, 'a': 'D' || v.s{p}.a}}",
                f"CASE WHEN fault NOT IN ('b', 'd') AND letter = '{due[p]}' THEN {{'c': extra + v.s{q}.c, 'a': 'K' || v.s{q}.a}} END",
                f"CASE WHEN fault NOT IN ('b', 'd') AND letter <> '{due[p]}' THEN {{'c': 3 + extra + v.s{q}.c, 'a': 'R' || v.s{q}.a}} END"]
        if p == 0:
            ways.append("CASE WHEN fault NOT IN ('b', 'd') AND letter = 's' THEN {'c': extra + v.s1.c, 'a': 'K' || v.s1.a} END")
        touch.append(f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL)) AS t{p}")
    for p in range(4):
        q, r = after[p], after[after[p]]
        insert.append(f"list_min([t{p}, {{'c': 3 + t{q}.c, 'a': 'I' || t{q}.a}}, {{'c': 6 + t{r}.c, 'a': 'II' || t{r}.a}}]) AS s{p}")
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    crc = ("list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)), "
           "lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT for _ in range(8)]), lambda x, _: " + bit + "))")
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, xor({crc}, 4294967295) % 20 AS kind FROM k),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM (SELECT *, unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE kind <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
r AS (SELECT *, left(role, 1) AS letter,
             CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '-' END AS fault FROM o),
e AS (SELECT *, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS extra, lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS two FROM r),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id),
v AS (SELECT conv_id, n + 1 AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS s2, {{'c': 0, 'a': ''}} AS s3 FROM c
      UNION ALL
      SELECT conv_id, i, {', '.join(insert)}
      FROM (SELECT e.conv_id, e.i, {', '.join(touch)} FROM v JOIN e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = v.i - 1) AS t),
a AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM v WHERE i = 1),
edits AS (SELECT conv_id, audit, j, substr(audit, j, 1) AS edit, 1 + length(regexp_replace(audit[1:j - 1], 'I', '', 'g')) AS i,
                 length(regexp_replace(audit[1:j - 1], 'D', '', 'g')) AS place FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS j FROM a)),
kept AS (SELECT d.conv_id, d.j, d.edit, d.place, e.role, e.text, e.letter FROM edits AS d LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM d.conv_id AND e.i = d.i AND d.edit <> 'I'
         WHERE d.edit <> 'D'),
sys AS (SELECT *, max(CASE WHEN place = 0 AND edit = 'K' AND letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM kept),
lines AS (SELECT conv_id, j, CASE WHEN edit = 'K' THEN role WHEN (place - s) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
                 CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM sys),
sha AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS sha FROM lines GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS d LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN sha ON sha.conv_id IS NOT DISTINCT FROM d.conv_id
"""


#: op8 is left out: SQL has no byte-pair encoding; tests compare it with the library.
SQL = {"op1_warc": OP1, "op2_license_scan": _op2(), "op3_quality_rules": _op3(), "op4_url_rules": OP4, "op5_mixing": OP5,
       "op6_decontamination": OP6, "op7_ngram_jaccard": OP7, "op9_line_dedup": OP9, "op10_token_counts": OP10,
       "op11_suffix_dedup": OP11, "op12_collocations": OP12,
       "op13_conversation_repair": _op13()}
