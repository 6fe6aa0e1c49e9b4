"""DuckDB SQL for the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
i AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + least(10, len(w)) - 1) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS m FROM win),
places AS (
  SELECT r, m, s, list_slice(w, s, s + m - 1) AS words
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m)),
found AS (SELECT r, m, s, item_id FROM places JOIN win USING (words)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT r, m, s FROM found)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (
  SELECT r, pos, parts[pos] AS line,
    regexp_replace(translate(parts[pos], '{_UPPER}', '{_LOWER}'),
      '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key
  FROM (SELECT r, parts, unnest(range(1, len(parts) + 1)) AS pos FROM d)),
shared AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT r, count(*) AS n_dropped_not, string_agg(line, chr(10) ORDER BY pos) AS kept
  FROM l WHERE key NOT IN (SELECT key FROM shared) GROUP BY r)
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_lines,
  CAST(len(parts) - coalesce(n_dropped_not, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def chat_rotation() -> str:
    from . import chat as C
    settings = ", ".join(f"'{s}'" for s in C.SETTINGS)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), '{C.UNKNOWN}') AS speaker, coalesce(text, '') AS text
  FROM conversations),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, text) - 1 AS pos FROM t),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker NOT IN ({settings})),
m AS (
  SELECT p.conv_id, perspective, CAST(pos // {C.PART_TURNS} AS INTEGER) AS part, pos,
    coalesce(speaker = perspective, false) AS mine,
    '{C.BEGIN}' || CASE WHEN coalesce(speaker = perspective, false) THEN 'assistant'
      WHEN speaker IN ({settings}) THEN speaker ELSE 'user name=' || speaker END || chr(10) AS header,
    text || '{C.END.rstrip()}' || chr(10) AS body
  FROM p LEFT JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
l AS (
  SELECT *, sum(length(header) + length(body)) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY pos) AS stop FROM m)
SELECT conv_id, perspective, part, CAST(count(*) AS INTEGER) AS n_turns,
  string_agg(header || body, '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(stop - length(body) AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY pos)
    FILTER (WHERE mine), '') AS masks
FROM l GROUP BY conv_id, perspective, part
"""


def quality_rules() -> str:
    """The counts, the votes, and the estimate as a chain of one query for each round."""
    from . import quality as Q
    spaces = r"\x20\x09-\x0D"
    k = range(len(Q.RULES))
    digit = lambda i: f"(votes // {3 ** i}) % 3"
    votes = " + ".join(
        f"{3 ** i} * CASE WHEN n_words = 0 THEN 1 WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END"
        for i, (_, good, bad) in enumerate(Q.RULES))
    def side(is_good: bool) -> str:
        start = "good" if is_good else "(1 - good)"
        return start + "".join(
            f" * CASE v{i} WHEN 2 THEN {f'a{i}' if is_good else f'(1 - b{i})'}"
            f" WHEN 0 THEN {f'(1 - a{i})' if is_good else f'b{i}'} ELSE 1 END" for i in k)

    posterior = f"(({side(True)}) / (({side(True)}) + ({side(False)})))"
    start = ", ".join([f"CAST({Q.START_GOOD} AS DOUBLE) AS good"]
                      + [f"CAST({Q.START_RIGHT_GOOD} AS DOUBLE) AS a{i}, CAST({Q.START_RIGHT_BAD} AS DOUBLE) AS b{i}"
                         for i in k])
    def share(these: str, others: str, start: float) -> str:
        n = f"({these} + {others})"
        return f"(({these} + 1 + {start * Q.PRIOR} * {n}) / ({n} + 2 + {Q.PRIOR} * {n}))"

    def total(weight: str, i: int, vote: int) -> str:
        return f"coalesce(sum({weight}) FILTER (WHERE v{i} = {vote}), 0)"

    on_good = [share(total("n * q", i, 2), total("n * q", i, 0), Q.START_RIGHT_GOOD) for i in k]
    on_bad = [share(total("n * (1 - q)", i, 0), total("n * (1 - q)", i, 2), Q.START_RIGHT_BAD) for i in k]
    new = ", ".join([f"{share('sum(n * q)', 'sum(n * (1 - q))', Q.START_GOOD)} AS good"] + [
        f"{on_good[i]} AS a{i}, greatest({on_bad[i]}, 1 - {on_good[i]}) AS b{i}" for i in k])
    rounds = ",\n".join(
        f"e{r + 1} AS MATERIALIZED (SELECT {new} FROM (SELECT *, {posterior} AS q FROM pat, e{r}))"
        for r in range(Q.ROUNDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^{spaces}]+') AS w FROM d),
l AS (
  SELECT r, count(*) AS n_word_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^{spaces}]') GROUP BY r),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY r),
c AS MATERIALIZED (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_word_lines, 0) AS BIGINT) AS n_word_lines,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(replace(text, '!', '')) AS n_exclaims, len(list_distinct(w)) AS n_distinct
  FROM d JOIN w USING (r) LEFT JOIN l USING (r) LEFT JOIN rep USING (r)),
v AS MATERIALIZED (SELECT *, {votes} AS votes FROM c),
pat AS MATERIALIZED (
  SELECT votes, count(*) AS n, {', '.join(f'{digit(i)} AS v{i}' for i in k)} FROM v GROUP BY votes),
e0 AS MATERIALIZED (SELECT {start}),
{rounds},
p AS (SELECT votes, {posterior} AS p_good FROM pat, e{Q.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND p_good >= {Q.MIN_POSTERIOR} AS kept
FROM (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM v) JOIN p USING (votes)
"""


SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
lc AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM c GROUP BY lang, term),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM lc JOIN v USING (lang)),
gp AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
  FROM gn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""
