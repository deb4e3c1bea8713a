"""DuckDB SQL for the registered queries: lexicons as VALUES joined to tokens, pairs by nested loops, clusters by recursion."""

from __future__ import annotations

from functools import reduce

from .functions import lexicon as L
from .queries import CELLS, FIXES, KEYWORDS, MIX, REPLIES, TITLES, WORDS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in rows)


def _nested(expr: str, pairs) -> str:
    return reduce(lambda t, p: f"replace({t}, {_q(p[0])}, {_q(p[1])})", pairs, expr)


LEX = L.DEFAULT
PREFIX = "CASE " + " ".join(f"WHEN starts_with(t, {_q(p)}) THEN substr(t, {len(p) + 1})" for p in L.QUESTION_PREFIXES) + " ELSE t END"
ARTICLE = rf"'\b({'|'.join(L.ARTICLES)})\b'"
PLURAL = """CASE WHEN w LIKE '%ies' AND length(w) > 4 THEN left(w, length(w) - 3) || 'y' WHEN w LIKE '%ses' AND length(w) > 4 THEN left(w, length(w) - 2)
  WHEN w LIKE '%s' AND w NOT LIKE '%ss' AND w NOT LIKE '%us' AND length(w) > 3 THEN left(w, length(w) - 1) ELSE w END"""
VARIANTS = """list_transform(list_sort(list_transform(list_distinct(list_filter([lower(tool), CASE WHEN contains(lower(tool), '.') THEN replace(lower(tool), '.', '') END,
  CASE WHEN contains(lower(tool), ' ') THEN replace(lower(tool), ' ', '') END, lower(tool) || ' software', lower(tool) || ' cloud'], lambda v: v IS NOT NULL)),
  lambda v: {'n': -length(v), 'v': v})), lambda s: s.v)"""


def _category(c: str) -> str:
    low = f"lower({c})"
    return (
        f"CASE WHEN {' OR '.join(f'contains({low}, {_q(s)})' for s in L.INTEGRATION_SIGNALS)} THEN 'integration' WHEN {' OR '.join(f'starts_with({low}, {_q(s)})' for s in L.HOWTO_PREFIXES)} THEN 'howto' "
        f"WHEN contains({low}, 'tutorial') THEN 'tutorial' ELSE 'other' END"
    )


IRRELEVANT = " OR ".join(
    [f"trim(lower(keyword)) = {_q(a)} || lower(tool) || {_q(b)}" for a, b in (t.split("{}") for t in L.IRRELEVANT_TEMPLATES)]
    + [f"contains(lower(keyword), {_q(p)})" for p in L.IRRELEVANT_PATTERNS]
)
LOOKS = f"""(length(v) <= 200 AND {' AND '.join(f'NOT starts_with(v, {_q(p)})' for p in L.COMMAND_PREFIXES)} AND NOT regexp_matches(v, '^[0-9.]+$')
  AND length(v) - length(replace(v, '/', '')) <= 3 AND length(regexp_replace(v, '[^\\p{{L}}]', '', 'g')) >= 3)"""
TIER = "CASE WHEN lower(keyword) LIKE 'how to%' AND (contains(lower(keyword), ' a ') OR contains(lower(keyword), ' an ')) THEN 0 WHEN lower(keyword) LIKE 'how to%' THEN 1 WHEN contains(lower(keyword), 'integration') THEN 2 ELSE 3 END"
TOOL = r"""trim(regexp_replace(regexp_replace(regexp_replace(trim(sheet), '(?i)\s*-\s*(10\+|below 10|less than 10|<\s*10).*$', ''), '\s*\(.*$', ''), '\s*10\+\s*$', ''))"""

_NEVER = " OR ".join(f"(least(a, b) = {_q(x)} AND greatest(a, b) = {_q(y)})" for x, y in LEX.never_merge)


def _opposed(a: str, b: str) -> str:
    return "coalesce(" + _NEVER.replace("(a, b)", f"({a}, {b})") + ", false)"


def _jac(a: str, b: str) -> tuple[str, str]:
    i = f"len(list_intersect({a}, {b}))"
    return i, f"(len({a}) + len({b}) - {i})"


_I, _U = _jac("x.key", "y.key")


def _cluster(name: str, batch: str, num: int, den: int) -> str:
    i, u = _jac("g.key", "l.key")
    return f"""
{name} AS (
  SELECT tool, batch, 0::BIGINT AS r, []::STRUCT(rank BIGINT, "key" VARCHAR[], "lead" VARCHAR)[] AS leaders, NULL::BIGINT AS leader FROM (SELECT DISTINCT tool, batch FROM g WHERE batch = '{batch}')
  UNION ALL
  SELECT tool, batch, r, CASE WHEN best IS NULL THEN list_append(leaders, {{'rank': r, 'key': "key", 'lead': "lead"}}) ELSE leaders END, coalesce(best, r)
  FROM (SELECT s.tool, s.batch, g.group_rank AS r, g.key, g.lead, s.leaders,
      -(list_sort(list_transform(list_filter(s.leaders, lambda l: {den} * {i} >= {num} * {u} AND NOT {_opposed('g.lead', 'l.lead')}),
        lambda l: {{'s': {i} / {u}, 'n': -l.rank}}), 'DESC')[1]).n AS best
    FROM {name} s JOIN g ON g.tool = s.tool AND g.batch = s.batch AND g.group_rank = s.r + 1))"""


def _results(name: str, cluster: str, minimum: int, signal: str, source: str, freq: str) -> str:
    return f"""
{name}_m AS (SELECT r.*, c.leader, g.group_rank, lg.key_str AS leader_key FROM {cluster} c JOIN g ON g.tool = c.tool AND g.batch = c.batch AND g.group_rank = c.r
  JOIN g lg ON lg.tool = c.tool AND lg.batch = c.batch AND lg.group_rank = c.leader JOIN kr r ON r.tool = g.tool AND r.batch = g.batch AND r.key_str = g.key_str),
{name}_a AS (SELECT tool, batch, leader AS leader_rank, count(*) AS n, arg_min(keyword, (({TIER}), length(keyword), group_rank, pos)) AS canonical_keyword,
  array_to_string(list_slice(list(keyword ORDER BY group_rank, pos), 1, 15), ' | ') AS all_variants FROM {name}_m WHERE leader_key NOT IN (SELECT key_str FROM cov) GROUP BY ALL HAVING count(*) >= {minimum}),
{name} AS (SELECT tool, batch, leader_rank, canonical_keyword, {_category('canonical_keyword')} AS category, n AS variant_count, {signal} AS signal_strength, '{source}' AS source, {freq} AS frequency_count, all_variants FROM {name}_a)"""


# Normalization of (tool, keyword) pairs in table ``src``; ``out`` has key_str.
def _norm(src: str, out: str) -> str:
    return f"""
{out}1 AS (SELECT DISTINCT tool, keyword, list_reduce([trim(lower(keyword))] || {VARIANTS}, lambda t, v: replace(t, v, ' ')) AS t FROM {src}),
{out}2 AS (SELECT tool, keyword, {_nested("trim(regexp_replace(regexp_replace(" + PREFIX + ", " + ARTICLE + r", ' ', 'g'), '\?+$', ''))", LEX.phrases(LEX.verbs))} AS t FROM {out}1),
{out}3 AS (SELECT tool, keyword, {_nested("string_agg(coalesce(canon, w), ' ' ORDER BY i)", LEX.phrases(LEX.objects))} AS t
  FROM (SELECT tool, keyword, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT *, string_split_regex(t, '\\s+') AS ws FROM {out}2)) LEFT JOIN verbs ON w = phrase GROUP BY tool, keyword),
{out}4 AS (SELECT tool, keyword, coalesce(canon, w) AS w FROM (SELECT tool, keyword, unnest(string_split_regex(t, '\\s+')) AS w FROM {out}3) LEFT JOIN objects ON w = phrase),
{out} AS (SELECT tool, keyword, array_to_string(list_sort(list_distinct(list({PLURAL}))), ' ') AS key_str FROM {out}4 WHERE length(w) > 1 AND w NOT IN (SELECT word FROM stops) GROUP BY tool, keyword)"""


BASE = f"""WITH RECURSIVE
verbs(phrase, canon) AS ({_values(LEX.verbs.items())}),
objects(phrase, canon) AS ({_values(LEX.objects.items())}),
stops(word) AS ({_values([(w,) for w in LEX.stop_words])}),
kw AS ({KEYWORDS}), ti AS ({TITLES}), ce AS ({CELLS}), mx AS ({MIX}),
rel AS (SELECT * FROM kw WHERE NOT ({IRRELEVANT})),
{_norm("rel", "nk")},
kr AS (SELECT rel.*, key_str FROM rel JOIN nk USING (tool, keyword)),
tk1 AS (SELECT title_pos, unnest(string_split_regex(trim(regexp_replace(regexp_replace({PREFIX}, {ARTICLE}, ' ', 'g'), '\\?+$', '')), '\\s+')) AS w0 FROM (SELECT title_pos, trim(lower(title)) AS t FROM ti)),
tk2 AS (SELECT title_pos, coalesce(o.canon, coalesce(v.canon, w0)) AS w FROM tk1 LEFT JOIN verbs v ON w0 = v.phrase LEFT JOIN objects o ON coalesce(v.canon, w0) = o.phrase
  WHERE w0 NOT IN (SELECT word FROM stops WHERE word NOT IN ({', '.join(map(_q, L.TITLE_KEEPS))}))),
tk AS (SELECT title_pos, array_to_string(list_sort(list_distinct(list({PLURAL}))), ' ') AS key_str FROM tk2 GROUP BY title_pos),
g0 AS (SELECT tool, batch, key_str, count(*) AS n, min(pos) AS first_pos FROM kr GROUP BY ALL),
g AS (SELECT *, row_number() OVER (PARTITION BY tool, batch ORDER BY n DESC, first_pos) AS group_rank, string_split(key_str, ' ') AS "key",
  list_filter(string_split(key_str, ' '), lambda w: list_contains([{', '.join(map(_q, LEX.canonical_verbs))}], w))[1] AS "lead" FROM g0),
cov AS (SELECT DISTINCT x.key_str FROM (SELECT DISTINCT key_str, "key" FROM g) x JOIN (SELECT DISTINCT key_str, string_split(key_str, ' ') AS "key" FROM tk) y ON 5 * {_I} >= 4 * {_U})"""

CLUSTERS = BASE + "," + _cluster("cs", "standard", 7, 10) + "," + _cluster("cl", "low_volume", 13, 20)
RESULTS = (
    CLUSTERS
    + ","
    + _results("rs", "cs", 2, "CASE WHEN n >= 5 THEN 'high' WHEN n >= 3 THEN 'medium' ELSE 'low' END", "volume_10+", "''")
    + ","
    + _results("rl", "cl", 6, "'frequency'", "frequency_matched", "CAST(n AS VARCHAR)")
)
_TITLE = """CASE WHEN lower(c) LIKE 'how to%' THEN regexp_replace(trim(regexp_replace(regexp_replace(c, '(?i)' || tool, tool, 'g'), '\\s+', ' ', 'g')), '^\\S+', 'How') ELSE c END"""
FINAL = (
    RESULTS
    + f""",
ra AS (SELECT * FROM rs UNION ALL SELECT * FROM rl), rk0 AS (SELECT tool, canonical_keyword AS keyword FROM ra),
{_norm("rk0", "rk")},
rkk AS (SELECT ra.*, string_split(rk.key_str, ' ') AS "key" FROM ra LEFT JOIN rk ON rk.tool = ra.tool AND rk.keyword = ra.canonical_keyword),
cd AS (SELECT x.* EXCLUDE ("key") FROM rkk x WHERE NOT (batch = 'low_volume' AND EXISTS (SELECT 1 FROM rkk y WHERE y.tool = x.tool AND y.batch = 'standard' AND 4 * {_I} >= 3 * {_U}))),
fi AS (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY variant_count DESC, category, batch = 'low_volume', leader_rank) AS final_rank, {_TITLE.replace('(c', '(canonical_keyword').replace('ELSE c', 'ELSE canonical_keyword')} AS suggested_title FROM cd)"""
)

NEW_KEYS = f"""{BASE}, rr AS (SELECT DISTINCT CAST(floor(pos / 500.0) AS BIGINT) AS run, tool, batch, key_str FROM kr), fr AS (SELECT tool, batch, key_str, min(run) AS began FROM rr GROUP BY ALL)
SELECT run, tool, batch, count(*) AS n_keys, count(*) FILTER (run = began) AS n_new FROM rr JOIN fr USING (tool, batch, key_str) GROUP BY ALL"""

FIRST_SHEET = "first_value(name) OVER (PARTITION BY lower(name) ORDER BY sheet_idx)"
POS = "(sheet_idx::BIGINT * 17179869184 + row_idx::BIGINT * 16384 + col_idx)"
CELL_OK = f"""lower(v) NOT IN ({', '.join(map(_q, L.SKIP_VALUES))}) AND length(v) >= 3 AND {' AND '.join(f'NOT starts_with(v, {_q(p)})' for p in L.CELL_PREFIXES)} AND NOT (v LIKE '**%' AND v LIKE '%**') AND {LOOKS}"""
SKIP = " OR ".join(f"contains(lower(sheet), {_q(t)})" for t in L.SKIP_TABS)
LOW = "CASE WHEN contains(lower(sheet), 'below 10') OR contains(lower(sheet), '< 10') OR contains(lower(sheet), '<10') THEN 'low_volume' ELSE 'standard' END"
TAB = f"ck AS (SELECT *, trim(value) AS v FROM ce WHERE value IS NOT NULL AND NOT ({SKIP})), cf AS (SELECT * FROM ck WHERE {CELL_OK})"
MIXED = f"""mv AS (SELECT *, trim(value) AS v FROM mx WHERE value IS NOT NULL), mh AS (SELECT sheet_idx, col_idx, v AS tool FROM mv WHERE row_idx = 0 AND v <> ''),
mb AS (SELECT mv.*, tool FROM mv JOIN mh USING (sheet_idx, col_idx) WHERE row_idx > 0 AND length(v) >= 3 AND {LOOKS})"""

REPORT = "replace(tool, ' ', '_') || '_cleaned' AS tool_file, canonical_keyword, suggested_title, category, variant_count, signal_strength, source, frequency_count, all_variants"
# From a workbook, keywords come stripped and without the cells that its filters drop.
FROM_BOOK = FINAL.replace(f"kw AS ({KEYWORDS})", f"kw AS (SELECT pos, tool, batch, v AS keyword FROM (SELECT *, trim(keyword) AS v FROM ({KEYWORDS})) WHERE {CELL_OK})")

ORACLE_SQL: dict[str, str] = {
    "workbook_cells": f"{BASE} SELECT CAST(dense_rank() OVER (ORDER BY sheet_idx) - 1 AS INTEGER) AS sheet_idx, 'tab ' || sheet_idx AS sheet, row_idx, col_idx, value FROM ce WHERE value IS NOT NULL",
    "titles_csv": f"{BASE} SELECT title FROM ti",
    "mix_second_pass": f"""{BASE}, {MIXED}, ck AS (SELECT *, trim(value) AS v FROM mx WHERE value IS NOT NULL)
      SELECT 'Mix of Tools' AS tool, 'standard' AS batch, v AS keyword FROM ck WHERE {CELL_OK}
      UNION ALL SELECT tool, 'standard', v FROM mb WHERE (tool, col_idx) IN (SELECT (tool, max(col_idx)) FROM mb GROUP BY tool)""",
    "csv_sink": f"{FINAL} SELECT {REPORT} FROM fi",
    "cli_run": f"{FROM_BOOK} SELECT {REPORT} FROM fi",
    "title_counts": f"{BASE} SELECT 'titles' AS stage, count(*) AS n FROM ti UNION ALL SELECT 'title keys', count(DISTINCT key_str) FROM tk",
    "corpus_scan": KEYWORDS,
    "cell_filters": f"{BASE}, {TAB} SELECT sheet_idx, row_idx, col_idx, v AS keyword FROM cf",
    "looks_like_keyword": f"{BASE} SELECT row_idx, v AS value, {LOOKS} AS ok FROM (SELECT *, trim(value) AS v FROM ce WHERE value IS NOT NULL)",
    "tool_name": f"{BASE} SELECT DISTINCT sheet, {TOOL} AS tool FROM ce",
    "batch_route": f"{BASE} SELECT DISTINCT sheet, {LOW} AS batch FROM ce",
    "tool_merge_ci": f"{BASE} SELECT sheet_idx, name, {FIRST_SHEET} AS tool FROM (SELECT DISTINCT sheet_idx, {TOOL} AS name FROM ce WHERE sheet <> 'Clean')",
    "tab_keywords": f"{BASE}, {TAB}, tn AS (SELECT sheet_idx, batch, {FIRST_SHEET} AS tool FROM (SELECT DISTINCT sheet_idx, {TOOL} AS name, {LOW} AS batch FROM cf)) SELECT tool, batch, {POS} AS pos, v AS keyword FROM cf JOIN tn USING (sheet_idx)",
    "mix_unpivot": f"{BASE}, {MIXED} SELECT tool, 'standard' AS batch, {POS} + 4611686018427387904 AS pos, v AS keyword FROM mb WHERE (tool, col_idx) IN (SELECT (tool, max(col_idx)) FROM mb GROUP BY tool)",
    "tool_select": f"{BASE} SELECT pos, tool FROM kw WHERE lower(tool) IN ('small', 'standard')",
    "irrelevant_filter": f"{BASE} SELECT pos, tool, keyword FROM rel",
    "large_lexicon": f"{BASE} SELECT pos, regexp_matches(lower(trim(keyword)), '[bk][a-z][a-z]') AS held FROM kw",
    "categorize": f"{BASE} SELECT pos, {_category('keyword')} AS category FROM kw",
    "tool_variants": f"{BASE} SELECT tool, array_to_string({VARIANTS}, '|') AS variants FROM (SELECT tool FROM kw UNION SELECT 'node.js pro' UNION SELECT 'r')",
    "plural": f"{BASE} SELECT w AS word, {PLURAL} AS singular FROM (SELECT unnest(string_split_regex(trim(lower(keyword)), '\\s+')) AS w FROM kw UNION {_values([(w,) for w in WORDS])})",
    "verb_phrases": f"{BASE}, {_norm('kw', 'ak')} SELECT pos, t AS text FROM kw JOIN ak2 USING (tool, keyword)",
    "token_canon": f"{BASE} SELECT w AS word, coalesce(v.canon, w) AS verb, coalesce(o.canon, v.canon, w) AS object FROM (SELECT DISTINCT unnest(string_split_regex(trim(lower(keyword)), '\\s+')) AS w FROM kw) LEFT JOIN verbs v ON w = v.phrase LEFT JOIN objects o ON coalesce(v.canon, w) = o.phrase",
    "normalize_keyword": f"{BASE}, {_norm('kw', 'ak')} SELECT pos, coalesce(key_str, '') AS key_str FROM kw LEFT JOIN ak USING (tool, keyword)",
    "title_key": f"{BASE} SELECT title_pos, key_str FROM ti LEFT JOIN tk USING (title_pos)",
    "cms_index": f"{BASE} SELECT key_str, count(*) AS n_titles FROM tk GROUP BY key_str",
    "intent_groups": f"{BASE} SELECT tool, batch, key_str, n, first_pos FROM g",
    "group_rank": f"{BASE} SELECT tool, batch, key_str, group_rank FROM g",
    "lead_verb": f'{BASE} SELECT tool, batch, key_str, "lead" FROM g',
    "jaccard_pairs": f"{BASE} SELECT x.tool, x.batch, x.group_rank AS l_id, y.group_rank AS r_id, CAST({_I} AS BIGINT) AS inter, CAST({_U} AS BIGINT) AS uni FROM g x JOIN g y ON x.tool = y.tool AND x.batch = y.batch AND y.group_rank < x.group_rank WHERE 10 * {_I} >= 7 * {_U}",
    "never_merge_guard": f"{BASE} SELECT x.tool, x.batch, x.group_rank AS i, y.group_rank AS j FROM g x JOIN g y ON x.tool = y.tool AND x.batch = y.batch AND y.group_rank < x.group_rank WHERE 2 * {_I} >= {_U} AND NOT {_opposed('x.lead', 'y.lead')}",
    "leader_cluster_std": f"{CLUSTERS} SELECT tool, batch, r AS group_rank, leader AS leader_rank FROM cs WHERE r > 0",
    "leader_cluster_low": f"{CLUSTERS} SELECT tool, batch, r AS group_rank, leader AS leader_rank FROM cl WHERE r > 0",
    "leader_cluster_rounds": f"{CLUSTERS} SELECT tool, batch, r AS group_rank, leader AS leader_rank FROM cs WHERE r > 0",
    "leader_cluster_rounds_low": f"{CLUSTERS} SELECT tool, batch, r AS group_rank, leader AS leader_rank FROM cl WHERE r > 0",
    "coverage_exact": f"{BASE} SELECT tool, batch, key_str FROM g WHERE key_str IN (SELECT key_str FROM tk)",
    "coverage_similar": f"{BASE} SELECT key_str FROM cov",
    "uncovered": f"{BASE} SELECT tool, batch, key_str FROM g WHERE key_str NOT IN (SELECT key_str FROM cov)",
    "pick_canonical": f"{BASE} SELECT tool, batch, key_str, arg_min(keyword, (({TIER}), length(keyword), pos)) AS canonical_keyword FROM kr GROUP BY ALL",
    "signal_bucket": f"{BASE} SELECT tool, batch, key_str, n, CASE WHEN n >= 5 THEN 'high' WHEN n >= 3 THEN 'medium' ELSE 'low' END AS signal_strength FROM g",
    "variants_top15": f"{BASE} SELECT tool, batch, key_str, array_to_string(list_slice(list(keyword ORDER BY pos), 1, 15), ' | ') AS all_variants FROM kr GROUP BY ALL",
    "std_results": f"{RESULTS} SELECT * FROM rs",
    "low_results": f"{RESULTS} SELECT * FROM rl",
    "cross_dedup": f"{FINAL} SELECT * FROM cd",
    "final_ranked": f"{FINAL} SELECT * FROM fi",
    "suggested_title": f"{BASE} SELECT pos, {_TITLE.replace('(c', '(keyword').replace('ELSE c', 'ELSE keyword')} AS suggested_title FROM kw",
    "safe_name": f"{BASE} SELECT tool, replace(trim(regexp_replace(tool, '[^\\w\\s.-]', '', 'g')), ' ', '_') AS name FROM (SELECT tool FROM kw UNION SELECT ' C++ tools ' UNION SELECT 'a/b: c.d-e')",
    "cross_tool_dup": f"{FINAL} SELECT tool, final_rank, canonical_keyword, CASE WHEN o <> tool THEN o END AS cross_tool_dup FROM (SELECT *, min(tool) OVER (PARTITION BY trim(lower(canonical_keyword))) AS o FROM fi)",
    "chunk25": f"{FINAL} SELECT tool, final_rank, CAST((final_rank - 1) // 25 AS BIGINT) AS chunk, CAST((final_rank - 1) % 25 AS BIGINT) AS idx_in_chunk FROM fi",
    "new_keys": NEW_KEYS,
    "new_keys_sketched": NEW_KEYS,
    "ask_requests": f"""{FINAL} SELECT tool, CAST((final_rank - 1) // 25 AS BIGINT) AS chunk, count(*) AS n, min_by(canonical_keyword, final_rank) AS first_keyword, count(*) AS n_entries
      FROM fi GROUP BY ALL""",
    "reply_fixes": f"""WITH q AS ({REPLIES}), t AS (SELECT *, trim(reply, concat(chr(10), ' ')) AS r FROM q),
      b AS (SELECT *, CASE WHEN starts_with(r, '```') THEN trim(regexp_replace(regexp_replace(r, '^```[^\\n]*\\n', ''), '```$', ''), concat(chr(10), ' ')) ELSE r END AS body FROM t),
      j AS (SELECT *, TRY_CAST(body AS JSON) AS v FROM b),
      bad AS (SELECT * FROM j WHERE v IS NULL OR json_type(v) <> 'ARRAY'),
      e AS (SELECT tool, chunk, n, unnest(json_extract(v, '$[*]')) AS x FROM j WHERE json_type(v) = 'ARRAY'),
      f AS (SELECT tool, chunk, n, TRY_CAST(x ->> '$.index' AS INTEGER) AS i, x ->> '$.fixed_title' AS title, coalesce(TRY_CAST(x ->> '$.irrelevant' AS BOOLEAN), FALSE) AS gone, TRY_CAST(x ->> '$.duplicate_of' AS INTEGER) AS dup FROM e)
      SELECT tool, CAST(chunk * 3 + i AS BIGINT) AS idx, CASE WHEN i IS NOT NULL THEN title END AS fixed_title, CASE WHEN i IS NOT NULL THEN gone END AS irrelevant,
        CAST(CASE WHEN i IS NOT NULL THEN chunk * 3 + dup END AS BIGINT) AS duplicate_of, CASE WHEN i IS NULL THEN 'record without an index' END AS error
      FROM f WHERE i IS NULL OR (i >= 0 AND i < n)
      UNION ALL SELECT tool, NULL, NULL, NULL, NULL, CASE WHEN reply IS NULL THEN 'no reply' ELSE 'no JSON array' END FROM bad""",
    "apply_fixes": f"{FINAL}, fx AS ({FIXES} FROM fi) SELECT fi.tool, final_rank, coalesce(fixed_title, canonical_keyword) AS canonical_keyword, variant_count FROM fi JOIN fx ON fi.tool = fx.tool AND fx.idx = final_rank - 1 WHERE NOT irrelevant AND duplicate_of IS NULL",
    "stage_counts": f"""{FINAL} SELECT tool, batch, 'raw' AS stage, count(*) AS n FROM kw GROUP BY ALL UNION ALL SELECT tool, batch, 'relevant', count(*) FROM rel GROUP BY ALL UNION ALL SELECT tool, batch, 'groups', count(*) FROM g GROUP BY ALL
      UNION ALL SELECT tool, batch, 'clusters', count(*) FROM (SELECT * FROM cs UNION ALL SELECT * FROM cl) WHERE r = leader GROUP BY ALL
      UNION ALL SELECT tool, batch, 'covered', count(*) FROM (SELECT * FROM cs UNION ALL SELECT * FROM cl) c JOIN g USING (tool, batch) WHERE r = leader AND g.group_rank = r AND key_str IN (SELECT key_str FROM cov) GROUP BY ALL
      UNION ALL SELECT tool, batch, 'results', count(*) FROM ra GROUP BY ALL UNION ALL SELECT tool, batch, 'kept', count(*) FROM cd GROUP BY ALL""",
    "summary_by_tool": f"{FINAL} SELECT tool, count(*) AS n_keywords, count(*) FILTER (source = 'volume_10+') AS n_volume, count(*) FILTER (source = 'frequency_matched') AS n_frequency FROM fi GROUP BY ROLLUP (tool)",
}
