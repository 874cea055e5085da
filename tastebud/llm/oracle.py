"""DuckDB SQL for the queries that plain SQL can state in full; the others are tested against brute force.

Written from the contracts, not from the operators: pairs of shingle sets are
counted through a join on shingles, and rules are tried one by one.
"""

from __future__ import annotations

from .chat import INST
from .rules import RULES, SYMBOLS

SPACES = r"[\x20\x09-\x0D]+"

_WORDS = f"list_filter(regexp_split_to_array({{}}, '{SPACES}'), lambda w: w <> '')"

OP3 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END)) AS grams
  FROM d),
classes AS (SELECT row_number() OVER () AS c, grams, len(grams) AS n, min(doc_id) AS low
            FROM s WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT c, n, unnest(grams) AS gram FROM classes),
common AS (SELECT a.c AS a, b.c AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k
           FROM g a JOIN g b ON a.gram = b.gram AND a.c < b.c AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
           GROUP BY a.c, b.c),
links AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (m + n - k)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT c, c FROM classes UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a),
comp AS (SELECT reach.a AS c, min(x.low) AS component_id FROM reach JOIN classes x ON x.c = reach.b GROUP BY reach.a)
SELECT s.doc_id, len(s.grams) AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN classes ON classes.grams = s.grams LEFT JOIN comp ON comp.c = classes.c
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for s in INST.controls:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


def _by_role(known, other: str) -> str:
    cases = " ".join(f"WHEN '{role}' THEN {known(turn)}" for role, turn in INST.turns.items())
    return f"CASE role {cases} ELSE {other} END"


OP4 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length({_escaped('text')}) + {_by_role(
      lambda x: len(x.open) + len(x.close),
      f"{len(INST.other.open) + len(INST.role_end) + len(INST.other.close)} + length({_escaped('role')})")} AS chars
  FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned,
         string_agg(role || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS roles
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars, regexp_full_match(roles, '(system\\n)?(user\\nassistant\\n)+') AS valid
FROM c
"""

OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
five AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, i FROM five QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM again) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(replace(text, '!', '')) AS n_exclaims
  FROM d LEFT JOIN covered USING (r)),
b AS (SELECT *, CAST({' + '.join(f'CASE WHEN {sql} THEN {1 << i} ELSE 0 END' for i, (_, sql) in enumerate(RULES))} AS BIGINT) AS fail_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""


def url_rules(listed: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The verdicts of ``judged`` for a short list, every rule tried on every url."""
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in listed)
    return f"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, verdict) AS (VALUES {rules}),
best AS (
  SELECT r, arg_max(h || rules.p, length(h || rules.p)) AS rule, arg_max(verdict, length(h || rules.p)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM p LEFT JOIN best USING (r)
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
whole AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS occurrences FROM d WHERE len(t) > 0),
held AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM held
       WHERE term IN (SELECT term FROM q) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (
  SELECT q.item_id, tf.r, any_value(tf.doc_id) AS doc_id,
         sum(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // occurrences))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) CROSS JOIN whole GROUP BY q.item_id, tf.r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def centroid_rounds(k: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """All distances of every round, as long rows (vector, component)."""
    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT p.r, c.c, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d FROM p JOIN c{r} c ON c.i = p.i GROUP BY p.r, c.c)
  GROUP BY r)"""

    def moved(r: int) -> str:
        return f"""
c{r + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN (
    SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
      SELECT a.best.c AS c, p.i, sum(p.x) AS s, count(*) AS n FROM a{r} a JOIN p ON p.r = a.r GROUP BY a.best.c, p.i)) m
  ON m.c = o.c AND m.i = o.i)"""

    steps = [text for r in range(rounds) for text in (assigned(r), moved(r))]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
p AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(v) AS x FROM v),
f AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), vec_id, v) - 1 AS c, v FROM v QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(v) AS x FROM f),{",".join(steps)},{assigned(rounds)},
told AS (SELECT best.c AS c, sum(best.d)::BIGINT AS s FROM a{rounds} GROUP BY best.c),
named AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT v.vec_id, a.best.c::INT AS cluster, a.best.d AS distance, told.s AS cluster_inertia,
       (SELECT sum(s)::BIGINT FROM told) AS inertia, named.h AS centroid_sha256
FROM a{rounds} a JOIN v ON v.r = a.r JOIN told ON told.c = a.best.c JOIN named ON named.c = a.best.c
"""
