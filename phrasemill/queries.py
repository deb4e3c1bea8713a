"""Registered queries: every operator over a keyword corpus made from ``part``. ``oracle.py`` has their SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cli
from .functions import text as X
from .functions.lexicon import CELL_PREFIXES
from .operators import cluster as C
from .operators import consolidate as O
from .operators import enrich, history
from .operators.setsim import similar_pairs
from .plans.consolidation import Consolidation
from .plans.ship import ship
from .plans.storage import shared_path, stored
from .sources import keywords as K
from .sources.files import located, put_file
from .sources.sinks import COLUMNS, read_results, write_results
from .sources.workbook_writer import workbook
from .sources.xlsx import read_cells

# The corpus. Both engines run this text; ``part`` is the table of that name.

KEYWORDS = """
SELECT pos, tool, batch,
  CASE CAST(CASE WHEN batch = 'low_volume' AND pos % 10 IN (4, 9) THEN 3 ELSE pos % 10 END AS INT)
    WHEN 0 THEN concat('how to ', verb, ' a ', adj, ' ', noun, ' in ', lower(tool))
    WHEN 1 THEN concat('How to ', verb, ' ', adj, ' ', noun, 's?')
    WHEN 2 THEN concat(lower(tool), ' how can we ', verb, ' ', adj, ' ', noun)
    WHEN 3 THEN concat(lower(tool), ' ', noun, ' integration')
    WHEN 4 THEN concat(verb, ' the ', noun, ' ticket tutorial')
    WHEN 5 THEN concat('how to use ', lower(tool))
    WHEN 6 THEN concat(adj, ' ', noun, ' vs ', noun)
    WHEN 7 THEN concat('   ', verb, ' user story ', adj, ' ', noun, '   ')
    WHEN 8 THEN concat('how do you ', verb, ' ', adj, ' ', noun, ' cards')
    ELSE concat('https://example.com/', noun) END AS keyword
FROM (
  SELECT p_partkey AS pos, p_type AS tool,
    CASE WHEN p_partkey % 3 = 0 THEN 'low_volume' ELSE 'standard' END AS batch,
    split_part(p_name, ' ', 2) AS noun, CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE split_part(p_name, ' ', 1) END AS adj,
    CASE CAST(CASE WHEN p_partkey % 3 = 0 THEN 2 + 4 * (p_size % 2) ELSE p_size % 8 END AS INT) WHEN 0 THEN 'add' WHEN 1 THEN 'insert' WHEN 2 THEN 'remove' WHEN 3 THEN 'get rid of'
      WHEN 4 THEN 'set up' WHEN 5 THEN 'Create' WHEN 6 THEN 'turn off' ELSE 'connect' END AS verb
  FROM part) v
"""

TITLES = """
SELECT p_partkey AS title_pos,
  CASE CAST(p_partkey % 4 AS INT)
    WHEN 0 THEN concat('How to Remove ', split_part(p_name, ' ', 1), ' ', split_part(p_name, ' ', 2), ' Story ', p_brand)
    WHEN 2 THEN concat('How to Add a ', split_part(p_name, ' ', 1), ' ', split_part(p_name, ' ', 2), '?')
    ELSE concat('How do I Delete ', split_part(p_name, ' ', 1), ' ', split_part(p_name, ' ', 2), 's in ', p_type) END AS title
FROM part
"""

#: Tabs: a tool's standard tab, its low-volume tab in lower case, a skipped tab.
CELLS = f"""
SELECT CAST(dense_rank() OVER (ORDER BY tool, batch DESC) AS INT) AS sheet_idx,
  CASE WHEN pos % 97 = 0 THEN 'Clean' WHEN batch = 'standard' THEN concat(' ', tool, ' - 10+ (old)') ELSE concat(lower(tool), ' - below 10') END AS sheet,
  CAST(pos AS INT) AS row_idx, CAST(pos % 3 AS INT) AS col_idx,
  CASE CAST(pos % 13 AS INT) WHEN 0 THEN 'Keyword' WHEN 1 THEN '12.5' WHEN 2 THEN '**bold**' WHEN 3 THEN '=A1+B1' WHEN 4 THEN '<loc>x'
    WHEN 5 THEN 'ab' WHEN 6 THEN 'a/b/c/d/e' WHEN 7 THEN NULL WHEN 8 THEN concat('{CELL_PREFIXES[0]}=', keyword) WHEN 9 THEN concat('python3 ', keyword)
    WHEN 10 THEN concat(keyword, repeat(' long', 40)) ELSE concat('  ', keyword) END AS value
FROM ({KEYWORDS}) k
"""

#: A tab with a tool a column; the last column repeats the first column's name.
MIX = f"""
WITH k AS (SELECT *, CAST(dense_rank() OVER (ORDER BY tool) AS INT) - 1 AS col FROM ({KEYWORDS}) q),
h AS (SELECT DISTINCT col, tool FROM k)
SELECT 9 AS sheet_idx, ' Mix of Tools' AS sheet, 0 AS row_idx, col AS col_idx, tool AS value FROM h
UNION ALL SELECT 9, ' Mix of Tools', 0, 100, tool FROM h WHERE col = 0
UNION ALL SELECT 9, ' Mix of Tools', CAST(pos AS INT), col, keyword FROM k
UNION ALL SELECT 9, ' Mix of Tools', CAST(pos AS INT), 100, concat(keyword, ' again') FROM k WHERE col = 0
"""

FIXES = """
SELECT tool, CAST(final_rank - 1 AS BIGINT) AS idx, CASE WHEN final_rank % 3 = 0 THEN concat('Fixed ', canonical_keyword) END AS fixed_title,
  final_rank % 7 = 0 AS irrelevant, CAST(CASE WHEN final_rank % 11 = 0 THEN 0 END AS BIGINT) AS duplicate_of
"""

#: Replies of a service to chunks of three entries: plain, fenced, cut short, no array, indices out of the chunk, prose, none, odd records.
REPLIES = """
SELECT p_type AS tool, p_partkey AS chunk, 3 AS n, CAST(NULL AS STRING) AS error,
  CASE CAST(p_partkey % 11 AS INT)
    WHEN 0 THEN concat('[{"index": 0, "fixed_title": "How to hold a ', p_name, '", "irrelevant": false, "duplicate_of": null}, {"index": 1, "irrelevant": true}, {"index": 2, "duplicate_of": 0}]')
    WHEN 1 THEN concat('```json', chr(10), '[{"index": 1, "fixed_title": "', p_name, '"}]', chr(10), '```')
    WHEN 2 THEN concat('  ```', chr(10), '[{"index": 2, "fixed_title": "', p_name, '", "irrelevant": true}]  ')
    WHEN 3 THEN concat('[{"index": 0, "fixed_title": "', p_name)
    WHEN 4 THEN concat('{"index": 0, "fixed_title": "', p_name, '"}')
    WHEN 5 THEN concat('[{"index": 3, "fixed_title": "', p_name, '"}, {"index": -1}, {"index": 2, "duplicate_of": 1}]')
    WHEN 6 THEN concat('I can not help with ', p_name, '.')
    WHEN 7 THEN '[]'
    WHEN 8 THEN NULL
    WHEN 9 THEN concat('[{"fixed_title": "', p_name, '"}, {"index": "2", "fixed_title": 5}, 7, {"index": null}, {"index": 0}]')
    ELSE concat('[{"index": 0, "fixed_title": "', p_name, '", "more": [1, {"a": 2}]}, {"index": 0, "fixed_title": null, "irrelevant": null}]') END AS reply
FROM part
"""

#: More phrases than an expression takes: b or k and two letters.
MANY = tuple(a + b + c for a in "bk" for b in ascii_lowercase for c in ascii_lowercase)

WORDS = ("ties", "stories", "cases", "uses", "status", "access", "bus", "gas", "classes", "s", "ies", "series")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def _made(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    text = sql.replace("{", "{{").replace("}", "}}").replace("FROM part", "FROM {part}")
    return lambda spark, sf_dir: spark.sql(text, part=_part(spark, sf_dir))


def _numbered(sql: str, number: str, keys: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    """``sql`` over stored keywords, its window ``number`` taken over their distinct ``keys`` (a row a tab) and joined.

    Over all keywords the window would sort the corpus in one task; the numbers are the same. Stored, keywords are
    made once, and filters of later steps don't repeat their expressions.
    """
    names, joined = ", ".join(keys), " AND ".join(f"w.{k} <=> n.{k}" for k in keys)
    numbers = f"SELECT {names}, {number} AS number FROM (SELECT DISTINCT {names} FROM {{rows}}) v"
    text = sql.replace(number, "number").replace(f"({KEYWORDS})", "{rows}")

    def made(spark, sf_dir):
        rows = keywords(spark, sf_dir)
        rows = spark.sql(f"SELECT /*+ BROADCAST(n) */ w.*, n.number FROM {{rows}} w JOIN ({numbers}) n ON {joined}", rows=rows)
        return spark.sql(text, rows=stored(rows, "numbered"))

    return made


keywords, titles = _made(KEYWORDS), _made(TITLES)
cells = _numbered(CELLS, "dense_rank() OVER (ORDER BY tool, batch DESC)", ("tool", "batch"))
mix_cells = _numbered(MIX, "dense_rank() OVER (ORDER BY tool)", ("tool",))


def job(spark: SparkSession, sf_dir: str) -> Consolidation:
    return Consolidation(keywords(spark, sf_dir), titles(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def corpus_scan(spark, d):
    return keywords(spark, d)


def book_files(spark: SparkSession, made: DataFrame, label: str) -> str:
    """Workbooks of cells (book, sheet_idx from 1 or 9, sheet, row_idx, col_idx, value), each written by a task of its own.

    Every workbook has all tabs in their order (some may be empty); a tab's name is its first cell's. Gives a pattern of their names.
    """
    at = F.struct("row_idx", "col_idx")
    tabs = [(r.sheet_idx, r.sheet) for r in made.groupBy("sheet_idx").agg(F.min_by("sheet", at).alias("sheet")).orderBy("sheet_idx").collect()]  # a row a tab
    folder = shared_path(spark, label)

    def write(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["row_idx", "col_idx"])
        of = {i: list(zip(p.row_idx, p.col_idx, p.value)) for i, p in pdf.groupby("sheet_idx")}
        store, place = located(folder)
        put_file(store, f"{place}/{key[0]:08d}.xlsx", [workbook([(name, of.get(i, [])) for i, name in tabs])])
        return pd.DataFrame({"book": [key[0]]})

    ship(spark)
    cells = made.where("value is not null").select(F.col("book").cast("long"), "sheet_idx", "row_idx", "col_idx", "value")
    cells.groupBy("book").applyInPandas(write, "book long").write.format("noop").mode("overwrite").save()
    return f"{folder}/*.xlsx"


def titles_file(spark: SparkSession, d: str) -> str:
    path = shared_path(spark, "titles")
    titles(spark, d).select("title_pos", F.col("title").alias("Name")).write.csv(path, header=True, escape='"')
    return path


@query
def workbook_cells(spark, d):
    """Cells of workbooks (5,000 rows each) that were written first; tabs are numbered in their order."""
    made = cells(spark, d).withColumn("sheet", F.concat(F.lit("tab "), "sheet_idx")).withColumn("book", F.floor(F.col("row_idx") / 5000))
    return read_cells(spark, book_files(spark, made, "book")).select("sheet_idx", "sheet", "row_idx", "col_idx", "value")


@query
def titles_csv(spark, d):
    return K.read_titles(spark, titles_file(spark, d)).select("title")


@query
def mix_second_pass(spark, d):
    """Ordinary tabs of workbooks (one a tool, which has one or two columns), then their mixed tab once more with a tool a column."""
    made = mix_cells(spark, d).withColumn("book", F.col("col_idx") % 100)
    return K.all_keywords(read_cells(spark, book_files(spark, made, "mix"))).select("tool", "batch", "keyword")


@query
def csv_sink(spark, d):
    """Report files that were written first."""
    path = shared_path(spark, "report")
    write_results(job(spark, d).final(), path)
    return read_results(spark, path).select("tool_file", *COLUMNS)


@query
def cli_run(spark, d):
    """The command line's run: workbooks (one a tool) and a titles file in, report files out and read back."""
    made = keywords(spark, d).selectExpr(
        "dense_rank() over (order by tool) as book",
        "cast(dense_rank() over (order by tool, batch desc) as int) as sheet_idx", "concat(tool, if(batch = 'standard', ' - 10+', ' - below 10')) as sheet",
        "cast(pos as int) as row_idx", "0 as col_idx", "keyword as value",
    )
    out = shared_path(spark, "output")
    cli.run(spark, cli.arguments(["--xlsx", book_files(spark, made, "book"), "--cms", titles_file(spark, d), "-o", out]))
    return read_results(spark, out).select("tool_file", *COLUMNS)


@query
def title_counts(spark, d):
    return job(spark, d).title_counts()


@query
def cell_filters(spark, d):
    return K.cell_keywords(cells(spark, d)).select("sheet_idx", "row_idx", "col_idx", "keyword")


@query
def looks_like_keyword(spark, d):
    v = X.strip(F.col("value"))
    return cells(spark, d).where("value is not null").select("row_idx", v.alias("value"), X.looks_like_keyword(v).alias("ok"))


@query
def tool_name(spark, d):
    return cells(spark, d).select("sheet", X.tool_name(F.col("sheet")).alias("tool")).distinct()


@query
def batch_route(spark, d):
    return cells(spark, d).select("sheet", F.when(X.is_low_volume(F.col("sheet")), "low_volume").otherwise("standard").alias("batch")).distinct()


@query
def tool_merge_ci(spark, d):
    tabs = cells(spark, d).where("sheet <> 'Clean'").select("sheet_idx", X.tool_name(F.col("sheet")).alias("name")).distinct()
    return K.merged_tools(tabs).select("sheet_idx", "name", "tool")


@query
def tab_keywords(spark, d):
    return K.tab_keywords(cells(spark, d))


@query
def mix_unpivot(spark, d):
    return K.mix_keywords(mix_cells(spark, d)).select("tool", "batch", "pos", "keyword")


@query
def tool_select(spark, d):
    return K.selected_tools(keywords(spark, d), " small,STANDARD").select("pos", "tool")


@query
def irrelevant_filter(spark, d):
    return O.relevant(keywords(spark, d)).select("pos", "tool", "keyword")


@query
def large_lexicon(spark, d):
    return keywords(spark, d).select("pos", X.contains_any(X.lowered(F.col("keyword")), MANY).alias("held"))


@query
def categorize(spark, d):
    return keywords(spark, d).select("pos", X.category(F.col("keyword")).alias("category"))


@query
def tool_variants(spark, d):
    names = keywords(spark, d).select("tool").union(spark.createDataFrame([("node.js pro",), ("r",)], "tool string")).distinct()
    return names.select("tool", F.array_join(X.tool_variants(F.lower("tool")), "|").alias("variants"))


@query
def plural(spark, d):
    words = keywords(spark, d).select(F.explode(X.split_words(X.lowered(F.col("keyword")))).alias("word"))
    return words.union(spark.createDataFrame([(w,) for w in WORDS], "word string")).distinct().select("word", X.singular(F.col("word")).alias("singular"))


@query
def verb_phrases(spark, d):
    text = X.replace_all(X.phrase_text(F.col("keyword"), F.col("tool")), X.DEFAULT.phrases(X.DEFAULT.verbs))
    return keywords(spark, d).select("pos", text.alias("text"))


@query
def token_canon(spark, d):
    words = keywords(spark, d).select(F.explode(X.split_words(X.lowered(F.col("keyword")))).alias("word")).distinct()
    verb = X.lookup(X.DEFAULT.verbs, F.col("word"))
    return words.select("word", verb.alias("verb"), X.lookup(X.DEFAULT.objects, verb).alias("object"))


@query
def normalize_keyword(spark, d):
    return keywords(spark, d).select("pos", X.key_string(X.keyword_key(F.col("keyword"), F.col("tool"))).alias("key_str"))


@query
def title_key(spark, d):
    return titles(spark, d).select("title_pos", X.key_string(X.title_key(F.col("title"))).alias("key_str"))


@query
def cms_index(spark, d):
    return O.title_index(titles(spark, d)).select("key_str", "n_titles")


@query
def intent_groups(spark, d):
    return job(spark, d).groups().select("tool", "batch", "key_str", "n", "first_pos")


@query
def group_rank(spark, d):
    return job(spark, d).groups().select("tool", "batch", "key_str", "group_rank")


@query
def lead_verb(spark, d):
    return job(spark, d).groups().select("tool", "batch", "key_str", "lead")


@query
def jaccard_pairs(spark, d):
    side = job(spark, d).groups().select("tool", "batch", F.col("group_rank").alias("id"), "key")
    pairs = similar_pairs(side, side, ["tool", "batch"], 7, 10, F.col("r_id") < F.col("l_id"))
    return pairs.select("tool", "batch", "l_id", "r_id", F.col("inter").cast("long"), F.col("uni").cast("long"))


@query
def never_merge_guard(spark, d):
    return C.edges(job(spark, d).groups(), 1, 2).select("tool", "batch", "i", "j")


@query
def leader_cluster_std(spark, d):
    return job(spark, d).clusters().where("batch = 'standard'")


@query
def leader_cluster_low(spark, d):
    return job(spark, d).clusters().where("batch = 'low_volume'")


@query
def leader_cluster_rounds(spark, d):
    """The distributed form, whatever the size."""
    return C.iterated(job(spark, d).groups().where("batch = 'standard'"), *O.STD_THRESHOLD)


@query
def leader_cluster_rounds_low(spark, d):
    return C.iterated(job(spark, d).groups().where("batch = 'low_volume'"), *O.LOW_THRESHOLD)


@query
def coverage_exact(spark, d):
    j = job(spark, d)
    return O.covered_exact(j.groups(), j.index()).select("tool", "batch", "key_str")


@query
def coverage_similar(spark, d):
    j = job(spark, d)
    return O.covered(j.groups(), j.index())


@query
def uncovered(spark, d):
    j = job(spark, d)
    return O.uncovered(j.groups(), j.index()).select("tool", "batch", "key_str")


@query
def pick_canonical(spark, d):
    return job(spark, d).rows().groupBy("tool", "batch", "key_str").agg(O.canonical(F.col("keyword"), F.col("pos")).alias("canonical_keyword"))


@query
def signal_bucket(spark, d):
    return job(spark, d).groups().select("tool", "batch", "key_str", "n", X.signal(F.col("n")).alias("signal_strength"))


@query
def variants_top15(spark, d):
    return O.shown_variants(job(spark, d).rows(), ["tool", "batch", "key_str"], ["pos"])


@query
def std_results(spark, d):
    return job(spark, d).results().where("batch = 'standard'")


@query
def low_results(spark, d):
    return job(spark, d).results().where("batch = 'low_volume'")


@query
def cross_dedup(spark, d):
    return job(spark, d).combined()


@query
def final_ranked(spark, d):
    return job(spark, d).final()


@query
def suggested_title(spark, d):
    return keywords(spark, d).select("pos", X.suggested_title(F.col("keyword"), F.col("tool")).alias("suggested_title"))


@query
def safe_name(spark, d):
    names = keywords(spark, d).select("tool").union(spark.createDataFrame([(" C++ tools ",), ("a/b: c.d-e",)], "tool string")).distinct()
    return names.select("tool", X.safe_name(F.col("tool")).alias("name"))


@query
def cross_tool_dup(spark, d):
    return O.cross_tool_duplicates(job(spark, d).final()).select("tool", "final_rank", "canonical_keyword", "cross_tool_dup")


@query
def chunk25(spark, d):
    return O.chunked(job(spark, d).final()).select("tool", "final_rank", "chunk", "idx_in_chunk")


@query
def reply_fixes(spark, d):
    """Replies taken apart: fix records and what was wrong with the others."""
    return enrich.fixes(_made(REPLIES)(spark, d), 3)


@query
def ask_requests(spark, d):
    """What a service would be asked: a request a chunk of 25 rows, entries as JSON."""
    asked = enrich.requests(job(spark, d).final(), "m")
    return asked.select("tool", "chunk", F.col("n").cast("long").alias("n"), F.get_json_object("entries", "$[0].keyword").alias("first_keyword"), F.expr("json_array_length(entries)").cast("long").alias("n_entries"))


@query
def apply_fixes(spark, d):
    final = job(spark, d).final()
    fixes = spark.sql(FIXES + "FROM {final}", final=final)
    return O.apply_fixes(final, fixes).select("tool", "final_rank", "canonical_keyword", "variant_count")


@query
def stage_counts(spark, d):
    return job(spark, d).stage_counts()


def run_rows(spark, d):
    """Keyed keywords with the run they came in: 500 positions a run."""
    return job(spark, d).rows().select(F.floor(F.col("pos") / 500).alias("run"), "tool", "batch", "key_str")


@query
def new_keys(spark, d):
    return history.new_keys(run_rows(spark, d))


@query
def new_keys_sketched(spark, d):
    """The same from sketches, which are exact for so few keys a tool."""
    return history.new_keys_estimated(history.run_sketches(run_rows(spark, d)))


@query
def summary_by_tool(spark, d):
    return O.summary(job(spark, d).final())
