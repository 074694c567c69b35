"""The registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from firmscout.llm.mixing import BLOCK_WORDS, SEED, SHARD_WORDS
from firmscout.llm.quality import (
    GOOD_SHARE,
    GUESS_SHARE,
    KEEP_FROM,
    LEAST_WORDS,
    MOST_REPEATED_PCT,
    PRIOR_BAD,
    PRIOR_GOOD,
    ROUNDS,
    RULES,
)

WORDS = r"[^\x20\x09-\x0D]+"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE: dict[str, str] = {}


def seeded(*parts: str) -> str:
    text = f"'{SEED}' || " + " || ".join(f"':' || coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def mix_sql(docs: str) -> str:
    """The mix of the rows of ``docs``: quotients are listed one by one and the highest taken."""
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src, {seeded("doc_id")} AS place,
    CAST(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS BIGINT) AS size
  FROM {docs}
), ranks AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n,
    [5, 2, 1][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY src
), levels AS (
  SELECT 0 AS step, 1.5 * sum(source_size) / CAST(sum(weight) AS DOUBLE) AS level FROM ranks
  UNION ALL
  SELECT step + 1, (SELECT (1.5 * sum(source_size) - sum(CASE WHEN 2 * source_size <= level * weight THEN 2 * source_size ELSE 0 END))
      / CAST(nullif(sum(CASE WHEN 2 * source_size <= level * weight THEN 0 ELSE weight END), 0) AS DOUBLE) FROM ranks)
  FROM levels WHERE step < 60 AND level IS NOT NULL
), sources AS (
  SELECT src, source_size, CAST(ceil((source_size + n) / {SHARD_WORDS}) AS BIGINT) AS shards,
    CASE WHEN 2 * source_size <= lv * weight THEN CAST(2 * source_size AS DOUBLE) ELSE lv * weight END AS target
  FROM ranks, (SELECT CASE WHEN count(*) FILTER (level IS NULL) > 0 THEN 'inf'::DOUBLE ELSE max(level) END AS lv FROM levels)
), parts AS (
  SELECT sized.*, source_size, target, place % shards AS shard FROM sized JOIN sources USING (src)
), units AS (
  SELECT src, shard, CAST(sum(size) AS BIGINT) AS unit_size,
    CASE WHEN any_value(source_size) > 0 THEN any_value(target) * sum(size) / any_value(source_size) ELSE 0 END AS goal
  FROM parts GROUP BY src, shard
), seats AS (
  SELECT src, shard, row_number() OVER (ORDER BY goal / (2 * k - 1) DESC, src, shard) AS place
  FROM (SELECT src, shard, goal, unnest(range(1, CAST(ceil(goal / {BLOCK_WORDS}) * 2 + 3 AS BIGINT))) AS k FROM units WHERE goal > 0)
), quotas AS (
  SELECT src, shard, count(*) AS quota FROM seats
  WHERE place <= (SELECT floor(sum(target) / {BLOCK_WORDS} + 0.5) FROM sources) GROUP BY src, shard
), runs AS (
  SELECT src, shard, unit_size, coalesce(quota, 0) AS quota, least(coalesce(quota, 0) * {BLOCK_WORDS}, unit_size * 2) AS words,
    {seeded("src", "shard")} % greatest(CAST(ceil(unit_size / {BLOCK_WORDS}) AS BIGINT), 1) * {BLOCK_WORDS} AS run_start
  FROM units LEFT JOIN quotas USING (src, shard)
), line AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY src, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS pos
  FROM parts JOIN runs USING (src, shard)
)
SELECT doc_id, size, source_size, target,
  CASE WHEN unit_size > 0 THEN CAST(words // unit_size * size
    + greatest(0, least(pos + size, run_start + words % unit_size) - greatest(pos, run_start))
    + greatest(0, least(pos + unit_size + size, run_start + words % unit_size) - greatest(pos + unit_size, run_start)) AS BIGINT)
  ELSE 0 END AS taken, quota
FROM line"""


ORACLE["op3_mix_sources"] = mix_sql("documents")

_CONTROLS = r"(<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)"
ORACLE["op7_chat_format"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
      + len(regexp_extract_all(text, '{_CONTROLS}')) + length(role) + 12 + 1 + 11 AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def _level(source: str, k: int) -> str:
    return f"""c{k} AS (
  SELECT host, t, s[{k}] AS c, count(*) AS n FROM {source} WHERE len(s) >= {k} GROUP BY ALL
), w{k} AS (
  SELECT host, t FROM c{k} GROUP BY ALL HAVING count(*) >= 10 AND (count(*) * 10 >= sum(n) OR count(*) >= 1000)
), l{k} AS (
  SELECT p.* EXCLUDE (t), p.t || CASE WHEN len(s) < {k} THEN '' WHEN w.host IS NOT NULL THEN '/*' ELSE '/' || s[{k}] END AS t
  FROM {source} p LEFT JOIN w{k} w ON p.host = w.host AND p.t = w.t
)"""


ORACLE["op6_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality = 1 THEN 0 END) AS bad FROM labels GROUP BY doc_id
), l0 AS (
  SELECT page_id, host, path, bad, '' AS t,
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: CASE x WHEN '*' THEN '%2A' ELSE x END) AS s
  FROM parts LEFT JOIN marks ON doc_id = TRY_CAST(nullif(regexp_extract(path, '([0-9]{{1,18}})(\.html)?/?$', 1), '') AS BIGINT)
), {", ".join(_level(f"l{k - 1}", k) for k in (1, 2, 3))},
branches AS (
  SELECT host, t, regexp_replace(replace(t || '/', '/*/', '/*//') , '/[^/*][^/]*', '/x', 'g') AS form,
    count(bad) AS l, coalesce(sum(bad), 0) AS b FROM l3 GROUP BY host, t
), told AS (
  SELECT *, sum(l) OVER f AS al, sum(b) OVER f AS ab FROM branches WINDOW f AS (PARTITION BY host, form)
), own AS (
  SELECT *, CASE WHEN l > 0 AND al - l > 0 THEN
      abs(b / l - (ab - b) / (al - l)) > 1.96 * sqrt((ab / al) * (1 - ab / al) * (1 / l + 1 / (al - l))) ELSE false END AS alone
  FROM told
), merged AS (
  SELECT *, CASE WHEN alone THEN l ELSE sum(CASE WHEN alone THEN 0 ELSE l END) OVER (PARTITION BY host, form) END AS n,
    CASE WHEN alone THEN b ELSE sum(CASE WHEN alone THEN 0 ELSE b END) OVER (PARTITION BY host, form) END AS bad_n,
    coalesce(1 - sum(b) OVER () / nullif(sum(l) OVER (), 0), 1.0) AS good
  FROM own
), ruled AS (
  SELECT l3.*, (n - bad_n + 10 * good) / (n + 10) AS purity,
    CASE WHEN (l3.host = 'example.com' OR l3.host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (l3.host = 'example.net' OR l3.host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (l3.host = 'org' OR l3.host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (l3.host = 'net' OR l3.host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM l3 JOIN merged m ON l3.host = m.host AND l3.t = m.t
)
SELECT page_id, host, path, rule, t AS template,
  CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


def _round(k: int) -> str:
    """One round of expectation-maximisation over the vote patterns, from the model of the round before."""
    rules = range(1, len(RULES) + 1)

    def share(mass: str, prior: float, held: float, j: int) -> str:
        cast = f"sum(CASE WHEN votes[{j}] {{}} THEN {mass} ELSE 0 END)"
        return f"({cast.format('= -1')} + {GUESS_SHARE} * sum(n) * {held} * {prior}) / ({cast.format('<> 0')} + {GUESS_SHARE} * sum(n) * {held})"

    bad = ", ".join(share("n * (1 - p)", PRIOR_BAD, round(1 - GOOD_SHARE, 6), j) for j in rules)
    good = ", ".join(share("n * p", PRIOR_GOOD, GOOD_SHARE, j) for j in rules)
    return f"""m{k} AS MATERIALIZED (
  SELECT (sum(n * p) + {GUESS_SHARE} * sum(n) * {GOOD_SHARE}) / (sum(n) * (1 + {GUESS_SHARE})) AS good, [{bad}] AS b, [{good}] AS g
  FROM (SELECT votes, n, {_posterior()} AS p FROM patterns, m{k - 1})
)"""


def _posterior() -> str:
    odds = " + ".join(
        f"CASE votes[{j}] WHEN -1 THEN ln(g[{j}] / b[{j}]) WHEN 1 THEN ln((1 - g[{j}]) / (1 - b[{j}])) ELSE 0 END"
        for j in range(1, len(RULES) + 1)
    )
    return f"1 / (1 + exp(-(ln(good) - ln(1 - good) + {odds})))"


def quality_sql(docs: str) -> str:
    votes = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END" for _, bad, good in RULES)
    count = "length(t) - length(translate(t, '{}', ''))"
    repeat = lambda x: f"list_transform(range({len(RULES)}), lambda i: CAST({x} AS DOUBLE))"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS ls
  FROM {docs}
), windows AS (
  SELECT rid, i, w[i:i + 4] AS five FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) > 5)
), again AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, five) > 1
), covered AS (
  SELECT rid, sum(step) AS c FROM (
    SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS step FROM again) GROUP BY rid
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST({count.format("#*$%&|<>")} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
    {count.format("ABCDEFGHIJKLMNOPQRSTUVWXYZ")} AS n_capitals, {count.format("!")} AS n_exclaims,
    len(regexp_extract_all(t, '[#*$%&|<>]+')) AS n_symbol_runs,
    len(list_filter(w, lambda x: regexp_full_match(x, '\p{{L}}+[.,;:!?]?'))) AS n_plain_words
  FROM texts LEFT JOIN covered USING (rid)
), voted AS (
  SELECT *, [{votes}] AS votes FROM counts
), patterns AS MATERIALIZED (
  SELECT votes, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY votes
), m0 AS (
  SELECT CAST({GOOD_SHARE} AS DOUBLE) AS good, {repeat(PRIOR_BAD)} AS b, {repeat(PRIOR_GOOD)} AS g
), {", ".join(_round(k) for k in range(1, ROUNDS + 1))},
judged AS (
  SELECT votes, {_posterior()} AS p FROM patterns, m{ROUNDS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PCT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PCT} * n_words) AND p >= {KEEP_FROM} AS kept
FROM voted JOIN judged USING (votes)"""


ORACLE["op9_quality_rules"] = quality_sql("documents")


def substrings_sql(docs: str) -> str:
    """All 50-byte windows as hexadecimal text, the smallest document of each, and the ranges they cover."""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
    hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
  FROM {docs}
), windows AS (
  SELECT rid, place, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS s
  FROM (SELECT *, unnest(range(0, CAST(greatest(n - 49, 0) AS BIGINT))) AS i FROM texts)
), hits AS (
  SELECT rid, i FROM windows JOIN (SELECT s, min(place) AS least FROM windows GROUP BY s) USING (s) WHERE place > least
), marked AS (
  SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hits
), numbered AS (
  SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS span FROM marked
), spans AS (
  SELECT rid, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY rid, span
), pieces AS (
  SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM spans
), cut AS (
  SELECT rid, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
    string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a) AS kept
  FROM pieces JOIN texts USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE kept || substr(h, CAST(2 * last + 1 AS BIGINT)) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (rid)"""


def near_duplicates_sql(docs: str) -> str:
    """Links by joining on shingles, then everything that can be reached along them."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORDS}') AS w
  FROM {docs}
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets WHERE doc_id IS NOT NULL
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT doc_id AS id, doc_id AS c FROM sets
  UNION
  SELECT id, b FROM reached JOIN links ON c = a
), components AS (
  SELECT id, min(c) AS c FROM reached GROUP BY id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id IS NOT DISTINCT FROM c AS kept
FROM sets LEFT JOIN components ON doc_id = id"""


ORACLE["op1_substring_dedup"] = substrings_sql("documents")
ORACLE["op8_near_duplicates"] = near_duplicates_sql("documents")


def search_sql(docs: str, items: str) -> str:
    """Scores of every document that shares a term with an item, then the ten best."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"unnest(regexp_extract_all({lower}, '{TERMS}'))"
    return f"""
WITH words AS MATERIALIZED (SELECT doc_id, {terms} AS term FROM {docs}),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS n_all, sum(n)::BIGINT AS l_all FROM lengths),
wanted AS (SELECT DISTINCT item_id, {terms} AS term FROM {items}),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, n_all
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_all) // l_all))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 10"""


ORACLE["op11_lexical_search"] = search_sql("documents", "benchmark")


def collocations_sql(docs: str) -> str:
    """All sequences of one to five words are counted; candidates are compared with everything longer."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM {docs})
), grams AS MATERIALIZED (
  SELECT lang, phrase, size, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM pieces, (VALUES (1), (2), (3), (4), (5)) sizes(size) WHERE len(w) >= size
  ) GROUP BY lang, phrase, size
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 100),
inner_ones AS (
  SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, size),
    lambda s: list_transform(range(1, size - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase
  FROM candidates
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM inner_ones i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 100 * c.a)
), cuts AS (
  SELECT k.lang, k.phrase, k.a, n, k.cut, l.f AS l, r.f AS r, (1000::HUGEINT * k.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM kept) k JOIN totals t ON t.lang = k.lang
  JOIN grams l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k.cut], ' ')
  JOIN grams r ON r.lang = k.lang AND r.phrase = array_to_string(w[k.cut + 1:k.size], ' ')
), best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed WHERE rank <= 2000"""


ORACLE["op12_collocations"] = collocations_sql("documents")
