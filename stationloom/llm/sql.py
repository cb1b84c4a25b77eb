"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
NORM = r"trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
gram AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
line AS (SELECT doc_id, source, {NORM} AS l FROM (SELECT doc_id, source, unnest(lines) AS l FROM d)),
host AS (SELECT source, count(DISTINCT doc_id) AS documents FROM d GROUP BY source),
failed AS (
  SELECT doc_id, len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS failed FROM d LEFT JOIN covered USING (doc_id)),
often AS (
  SELECT source, l, count(DISTINCT doc_id) AS n, min(doc_id) FILTER (NOT failed) AS first_id
  FROM line JOIN failed USING (doc_id) GROUP BY source, l),
over_limit AS (
  SELECT o.* FROM often o JOIN host h ON o.source IS NOT DISTINCT FROM h.source WHERE o.n > 20 OR (o.n > 5 AND o.n > 0.05 * h.documents)),
lost AS (
  SELECT x.doc_id, sum(len(regexp_extract_all(x.l, '[^ ]+'))) AS removed_words
  FROM line x JOIN over_limit o ON x.l = o.l AND x.source IS NOT DISTINCT FROM o.source AND x.doc_id <> o.first_id
  GROUP BY x.doc_id),
counted AS (
  SELECT d.doc_id, source AS host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept
FROM counted
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))) AS key FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, 2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS all_sizes,
         CAST(coalesce(sum(2 * source_size) OVER before, 0) AS BIGINT) AS clamped,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weights_left
  FROM s WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (3 * all_sizes - 2 * clamped) / (2 * weights_left) AS lev FROM o),
t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), (SELECT arg_min(lev, cap / weight) FROM l WHERE lev * weight <= cap) * weight) AS target
  FROM l),
g AS (SELECT *, CAST(round(target) AS BIGINT) AS goal FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.goal // g.source_size ELSE 0 END AS passes, g.goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, goal - passes * source_size - start)) AS BIGINT) AS taken
FROM r
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
often AS (SELECT s.*, count(*) OVER (PARTITION BY g) AS k FROM s),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM often a JOIN often b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE a.k > 1 GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(c.m, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

# crc32 of a short string, bit by bit
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

OP13 = f"""
WITH c AS (
  SELECT conv_id, list(md5(coalesce(role, '') || chr(1) || coalesce(text, '')) ORDER BY turn NULLS FIRST) AS s,
         list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {_CRC} % 6 AS h FROM c),
r AS (
  SELECT h.conv_id, list_concat(coalesce(c.s[1:h], []), h.s[h + 1:]) AS s, list_concat(coalesce(c.l[1:h], []), h.l[h + 1:]) AS l
  FROM h LEFT JOIN c ON c.conv_id = h.conv_id - ((h.conv_id % 100) + 100) % 100),
p AS (
  SELECT conv_id, len(s) AS n, d AS depth, s[1:d] AS k, CASE WHEN d > 0 THEN l[d] ELSE 0 END AS last
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r)),
node AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(last) AS last,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM p GROUP BY k, depth),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON node.k = kids.k),
up AS (
  SELECT k[1:d] AS k, sum((n_convs - 1) * last) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY 1)
SELECT own.conv_id, own.depth, above.conv_id AS parent_conv_id, own.n_convs, own.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, own.ends_sha256
FROM own JOIN up ON own.k = up.k LEFT JOIN node above ON own.depth > 0 AND above.k = own.k[1:own.depth - 1]
"""


def _op11() -> str:
    """Places by splitting at the pattern; the rounds of the graph written out one after the other."""
    local, label = "[A-Za-z0-9._%+-]+", "[A-Za-z0-9-]+"
    patterns = {
        "email": rf"{local}@{label}(?:\.{label})+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i:
        CASE WHEN i % 2 = 1 THEN CAST(c AS INT) ELSE (2 * CAST(c AS INT)) // 10 + (2 * CAST(c AS INT)) % 10 END)) % 10 = 0"""
    valid = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND CAST('0' || right(ltrim(x, '0'), 3) AS INT) <= 255))",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 9 AND 15",
    }
    t = r"[\p{L}0-9@._%+/#-]"
    ident = rf"{patterns['phone']}|[0-9]{{2,}}(?:[\x20-][0-9]{{2,}}){{2,}}|{t}*[\p{{L}}0-9]"
    white = r"[\x20\x09-\x0D]+"

    def places(name: str, pattern: str) -> str:
        # gaps and matches take turns; a running sum of lengths gives the offsets
        return rf"""
{name}_m AS (SELECT row, i, g, v FROM (SELECT row, unnest(string_split_regex(text, '{pattern}')) AS g,
    unnest(list_append(regexp_extract_all(text, '{pattern}'), NULL)) AS v, generate_subscripts(list_append(regexp_extract_all(text, '{pattern}'), NULL), 1) AS i FROM d)),
{name}_p AS (SELECT row, i, g, v, CAST(sum(length(g) + coalesce(length(v), 0)) OVER (PARTITION BY row ORDER BY i) AS BIGINT) - length(v) AS start FROM {name}_m),
"""

    base = "".join(
        places(k, patterns[k]) + f"{k}_s AS (SELECT row, start, '{k}:' || start || ':' || (start + length(v)) AS s FROM {k}_p WHERE v IS NOT NULL AND {valid[k]}),\n"
        for k in patterns
    )
    seed = "CASE " + " ".join(f"WHEN regexp_full_match(v, '{p}') AND {valid[k]} THEN '{k}'" for k, p in patterns.items()) + " END"
    rounds = ""
    for r in range(3):
        known = "seeds" if not r else f"(SELECT * FROM seeds UNION ALL SELECT * FROM scores{r - 1})"
        rounds += f"""
pat{r} AS (
  SELECT phrase, kind, w // places AS confidence
  FROM (SELECT phrase, kind, sum(n * score) AS w, count(DISTINCT v) AS support
        FROM (SELECT unnest([one, two]) AS phrase, v, n FROM graph) JOIN {known} USING (v) WHERE phrase IS NOT NULL GROUP BY phrase, kind)
  JOIN total USING (phrase) WHERE support >= 5 AND w // places >= 600000),
best{r} AS (
  SELECT g.*, CASE WHEN q.confidence >= coalesce(p.confidence, 0) THEN q.kind ELSE p.kind END AS kind,
         greatest(coalesce(p.confidence, 0), coalesce(q.confidence, 0)) AS confidence
  FROM graph g LEFT JOIN pat{r} p ON g.one = p.phrase LEFT JOIN pat{r} q ON g.two = q.phrase),
scores{r} AS (
  SELECT v, arg_max(kind, (w, kind)) AS kind, max(w) // max(all_n) AS score
  FROM (SELECT v, kind, sum(n * confidence) AS w, sum(sum(n)) OVER (PARTITION BY v) AS all_n FROM best{r} WHERE seed IS NULL GROUP BY v, kind)
  WHERE kind IS NOT NULL GROUP BY v HAVING max(w) // max(all_n) >= 500000),
"""
    joined = " UNION ALL ".join(f"SELECT row, {i} AS o, start, s FROM {k}_s" for i, k in enumerate(patterns))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
{base}{places("ident", ident)}
element AS (
  SELECT row, start, v, g, regexp_extract(g, '{white}$') = '' AS glued, trim(regexp_replace(lower(
    CASE WHEN length(g) > 96 THEN regexp_replace(right(g, 96), '^[^ 	-
]+', '') ELSE g END), '{white}', ' ', 'g'), ' ') AS words
  FROM (SELECT row, start, v, i,
          -- words without a digit are no identifiers: they belong to what stands before the next one
          string_agg(g || CASE WHEN regexp_matches(v, '[0-9@]') THEN '' ELSE v END, '' ORDER BY i) OVER (PARTITION BY row, part ORDER BY i) AS g
        FROM (SELECT *, coalesce(sum(CAST(regexp_matches(v, '[0-9@]') AS INT)) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
              FROM ident_p WHERE v IS NOT NULL))
  WHERE regexp_matches(v, '[0-9@]')),
place AS (
  SELECT row, start, v, glued, nullif(regexp_extract(words, '[^ ]+$'), '') AS one, nullif(regexp_extract(words, '[^ ]+ [^ ]+$'), '') AS two
  FROM element WHERE length(v) >= 5 AND (contains(v, '@') OR length({digits}) >= 3)),
graph AS (SELECT v, one, two, count(*) AS n, count(*) FILTER (glued) AS n_glued, {seed} AS seed FROM place GROUP BY v, one, two),
phrases AS (
  SELECT phrase, sum(n_glued) AS n_glued, sum(n) AS n_after FROM (SELECT unnest([one, two]) AS phrase, v, n, n_glued FROM graph)
  WHERE phrase IS NOT NULL GROUP BY phrase HAVING count(DISTINCT v) >= 5),
word AS (
  SELECT w, lag(w) OVER (PARTITION BY row ORDER BY i) AS before
  FROM (SELECT row, unnest(w) AS w, generate_subscripts(w, 1) AS i
        FROM (SELECT row, string_split(lower(trim(regexp_replace(text, '{white}', ' ', 'g'), ' ')), ' ') AS w FROM d))),
total AS (
  SELECT phrase, greatest(sum(n), max(n_after)) AS places FROM (
    SELECT phrase, n_glued AS n FROM phrases
    UNION ALL SELECT w AS phrase, count(*) AS n FROM word WHERE w IN (SELECT phrase FROM phrases) GROUP BY w
    UNION ALL SELECT before || ' ' || w AS phrase, count(*) AS n FROM word WHERE before || ' ' || w IN (SELECT phrase FROM phrases) GROUP BY before || ' ' || w)
  JOIN phrases USING (phrase) GROUP BY phrase),
seeds AS (SELECT DISTINCT v, seed AS kind, 1000000 AS score FROM graph WHERE seed IS NOT NULL),
{rounds}
ends AS (
  SELECT row, list_position(['email', 'ip', 'card', 'phone'], b.kind) + 10 AS o, start,
         'found_' || b.kind || ':' || start || ':' || (start + length(v)) AS s
  FROM place p JOIN best2 b USING (v) JOIN scores2 s USING (v)
  WHERE b.kind = s.kind AND p.one IS NOT DISTINCT FROM b.one AND p.two IS NOT DISTINCT FROM b.two),
base AS (SELECT row, string_agg(s, ',' ORDER BY o, start) AS base, {", ".join(f"count(*) FILTER (o = {i}) AS n_{k}" for i, k in enumerate(patterns))}
  FROM ({joined}) GROUP BY row),
more AS (SELECT row, string_agg(s, ',' ORDER BY o, start) AS more FROM ends GROUP BY row)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in patterns)},
       sha256(coalesce(base, '')) AS base_sha256, concat_ws(',', base, more) AS spans
FROM d LEFT JOIN base USING (row) LEFT JOIN more USING (row)
"""


OP11 = _op11()
