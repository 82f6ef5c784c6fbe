"""The same rows in SQL (DuckDB), for the operators that SQL can express; plain joins, fit for small inputs."""

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles(words: str, k: int) -> str:
    joined = " || ' ' || ".join(f"{words}[i + {j}]" if j else f"{words}[i]" for j in range(k))
    return f"list_transform(range(1, len({words}) - {k - 2}), lambda i: {joined})"


def _reach(nodes: str) -> str:
    """Smallest id that links (a, b) reach from each node (id)."""
    return f"""both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (SELECT id, id FROM {nodes} UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)"""


OP2 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT *, regexp_extract_all(line, '{_WORD}') AS w FROM lines),
sets AS (SELECT doc_id, i, CASE WHEN len(w) >= 5 THEN list_distinct({_shingles('w', 5)}) ELSE [array_to_string(w, ' ')] END AS s
         FROM words WHERE len(w) >= 1),
tokens AS (SELECT doc_id, i, len(s) AS n, unnest(s) AS t FROM sets),
later AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT x.doc_id, x.i FROM tokens x JOIN tokens y ON x.t = y.t AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.i < x.i)
    GROUP BY x.doc_id, x.i, x.n, y.doc_id, y.i, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*)))),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(r.i) AS n_removed,
         sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (r.i IS NULL), '')) AS kept_sha256
  FROM lines l LEFT JOIN later r ON r.doc_id = l.doc_id AND r.i = l.i GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

OP5 = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM bytes),
named AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM starts),
repeated AS (SELECT doc_id, i FROM named QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
marked AS (SELECT *, i - lag(i, 1, -101) OVER (PARTITION BY doc_id ORDER BY i) > 100 AS new FROM repeated),
numbered AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
ordered AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
cut AS (
  SELECT o.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM ordered o JOIN bytes USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)"""

OP6 = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM texts),
named AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM windows),
repeated AS (SELECT doc_id, i FROM named QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
covered AS (SELECT DISTINCT doc_id, i + s AS i FROM repeated, (SELECT unnest(range(0, 13)) AS s)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
kept AS (
  SELECT x.doc_id, count(*) AS n_words, count(c.i) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL), '')) AS kept_sha256
  FROM words x LEFT JOIN covered c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY 1)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP7 = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE {_FINITE}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.w) = len(q.w) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10"""

OP8 = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id AS id, list_distinct(CASE WHEN len(w) >= 4 THEN {_shingles('w', 4)}
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM texts),
tokens AS (SELECT id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT x.id AS a, y.id AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.id < y.id
  GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
{_reach('sets')}
SELECT sets.id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM sets JOIN reach ON reach.id = sets.id GROUP BY 1, 2"""

OP9 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_reach('nodes')},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY 1),
found AS (SELECT id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, component_id = id AS kept
FROM found LEFT JOIN counts ON counts.a = found.id"""


def _split(children: str, parent: str, child: str) -> str:
    return f"""(SELECT *, CAST(CASE WHEN is_full THEN cap ELSE open_left * weight // open_of END AS BIGINT) AS given FROM (
  SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER g, 0) AS open_left,
         sum(CASE WHEN NOT is_full THEN weight END) OVER g AS open_of
  FROM (SELECT *, cap * (sum(weight) OVER g - coalesce(sum(weight) OVER e, 0)) <= (budget - coalesce(sum(cap) OVER e, 0)) * weight AS is_full
        FROM {children} WHERE weight > 0
        WINDOW g AS (PARTITION BY {parent}),
               e AS (PARTITION BY {parent} ORDER BY cap / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WINDOW g AS (PARTITION BY {parent})))"""


OP3 = rf"""
WITH placed AS (
  SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS leaf_source,
         CASE WHEN regexp_matches(source, '\d+$') THEN 'domain' || (CAST(regexp_extract(source, '(\d+)$', 1) AS HUGEINT) % 4) ELSE 'other' END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS n
  FROM documents),
leaves AS (SELECT domain, language, leaf_source, sum(n) AS tokens, 2 * sum(n) AS cap FROM placed GROUP BY ALL),
domains AS (
  SELECT domain, 0 AS root, sum(cap) AS cap, (SELECT sum(tokens) FROM leaves) AS budget,
         CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY 1),
languages AS (
  SELECT l.domain, language, sum(l.cap) AS cap, any_value(d.given) AS budget,
         CASE language WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight
  FROM leaves l JOIN {_split('domains', 'root', 'domain')} d USING (domain) GROUP BY 1, 2),
sources AS (
  SELECT l.domain, l.language, leaf_source, l.cap, l.tokens, d.given AS budget, 1 AS weight
  FROM leaves l JOIN {_split('languages', 'domain', 'language')} d USING (domain, language)),
plan AS (
  SELECT domain, language, leaf_source, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
  FROM {_split('sources', 'domain, language', 'leaf_source')}),
ordered AS (
  SELECT placed.*, whole, rest, coalesce(sum(n) OVER (
    PARTITION BY domain, language, leaf_source ORDER BY md5('17:' || whole || ':' || doc_id), doc_id, n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM placed JOIN plan USING (domain, language, leaf_source))
SELECT doc_id, unnest(range(CAST(whole + CASE WHEN before + n <= rest THEN 1 ELSE 0 END AS BIGINT))) AS epoch, n AS n_tokens,
       domain, language, leaf_source
FROM ordered"""

OP13 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS r
           FROM documents),
     w AS (SELECT lang, source, r, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY 1, 2, 3),
     kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
     g AS (SELECT DISTINCT lang, source FROM d),
     cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS n_lang
               FROM g JOIN kept k ON k.lang = g.lang
               LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     s AS (SELECT lang, source, term, n,
                  1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // CAST(sum(n + 1) OVER (PARTITION BY lang, source) AS HUGEINT) AS p,
                  1 + (CAST(1000000000 AS HUGEINT) * (n_lang + 1))
                      // CAST(sum(n_lang + 1) OVER (PARTITION BY lang, source) AS HUGEINT) AS q
           FROM cells),
     pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
               FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY 1, 2, 3),
     found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
               UNION ALL
               SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM s WHERE n > 0 AND p > q),
     ranked AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
                       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
                FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
