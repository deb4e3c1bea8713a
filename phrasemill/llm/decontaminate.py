"""Benchmark decontamination with DataFrame and SQL functions only (operator 1).

Words: runs of ASCII digits, letters (A-Z lower-cased) and any non-ASCII characters. Every run of
``n`` item words is a window; an item of fewer words is one window. A document word that lies
inside an occurrence of a window is hit.

The distinct windows of the benchmark are counted first. Up to ``max_windows`` their hashes
become a hash set inside the scan expression (sent to every task, like a broadcast): a document's
token windows are hashed where they stand, hits are verified against the set of window texts,
and spans follow within the row, without a shuffle. A larger benchmark goes another way:
document windows are joined with benchmark windows by an ordinary shuffled join (``_joined``).

Edge cases: null text and text without words have no words and no hits; items without words
have no windows; repeated items with the same id count once; null item_ids have no name, so they
hit but aren't listed; texts of any length are scanned whole; every input row gives its own output row, repeated or not; an empty benchmark hits
nothing; an empty table gives no rows; ``clean`` keeps all columns of its input, ``report`` none
but doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, shielded, split_text_key

N = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows that may be sent to every task (each is a hash and a text of some 60 bytes).
MAX_WINDOWS = 50_000
#: Bytes of (window, item) rows that may be broadcast: a window that many items share has many. More are joined by a shuffle.
MAX_BROADCAST = 16 << 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows_of(benchmark: DataFrame, n: int = N) -> DataFrame:
    """w (window text), size (its words), item_id; distinct."""
    w = F.col("_words")
    size = F.least(F.lit(n), F.size(w))
    all_windows = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("_words"))
        .where("size(_words) > 0")
        .select("item_id", size.alias("size"), F.explode(all_windows).alias("w"))
        .distinct()
    )


def _literal_set(values: list, kind: str) -> str:
    if kind == "long":
        return ",".join(f"{v}L" if v != -(2**63) else "(-9223372036854775807L - 1L)" for v in values)
    return ",".join("'" + v + "'" for v in values)  # window texts hold letters, digits, spaces and non-ASCII only


def _spans(by_size: dict[int, list[str]], hashes: dict[str, int]) -> Column:
    """Array of struct(pos, end, h) of verified window occurrences; pos counts words from 0, end is exclusive.

    Tests from cheap to exact: first word, hash of the window, text of the window.
    """
    found = []
    for size, texts in sorted(by_size.items()):
        firsts = _literal_set(sorted({t.split(" ", 1)[0] for t in texts}), "string")
        longs = _literal_set(sorted({hashes[t] for t in texts}), "long")
        exact = _literal_set(texts, "string")
        found.append(
            f"""transform(
              filter(
                transform(
                  filter(
                    if(size(_words) < {size}, array(), sequence(0, size(_words) - {size})),
                    i -> get(_words, i) IN ({firsts}) AND xxhash64(slice(_words, i + 1, {size})) IN ({longs})),
                  i -> struct(i AS pos, array_join(slice(_words, i + 1, {size}), ' ') AS w)),
                s -> s.w IN ({exact})),
              s -> struct(s.pos AS pos, s.pos + {size} AS end, xxhash64(split(s.w, ' ')) AS h))"""
        )
    return F.expr(f"concat({', '.join(found)})") if len(found) > 1 else F.expr(found[0])


NO_SPANS = "cast(array() as array<struct<pos:int,end:int,h:bigint>>)"
#: Words under the union of the spans: walk them in order with the end reached so far.
COVERED = """aggregate(array_sort(_spans), struct(0 AS end, 0L AS n),
    (a, s) -> struct(greatest(a.end, s.end) AS end, a.n + greatest(0, s.end - greatest(a.end, s.pos)) AS n), a -> a.n)"""


def annotate(docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS) -> DataFrame | None:
    """``docs`` with _words, _spans and _n_hit; None if the benchmark is too large to send to every task."""
    distinct = windows_of(benchmark, n).select("w", "size", F.xxhash64(F.split("w", " ")).alias("h")).distinct()
    rows = distinct.limit(max_windows + 1).collect()  # bounded; one more than fits tells that it doesn't
    if len(rows) > max_windows:
        return None
    by_size: dict[int, list[str]] = {}
    for r in rows:
        by_size.setdefault(r["size"], []).append(r["w"])
    spans = _spans({k: sorted(v) for k, v in by_size.items()}, {r["w"]: r["h"] for r in rows}) if rows else F.expr(NO_SPANS)
    return docs.withColumn("_words", words_of(F.col("text"))).withColumn("_spans", spans).withColumn("_n_hit", F.expr(COVERED))


def _joined(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """doc_id, _k, pos, end, item_id of every hit, by a shuffled join on window text; for benchmarks of any size."""
    windows = windows_of(benchmark, n)
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # at most n
    at = [f"transform(if(size(_words) < {s}, array(), sequence(0, size(_words) - {s})), i -> struct(i AS pos, i + {s} AS end, {s} AS size, array_join(slice(_words, i + 1, {s}), ' ') AS w))" for s in sizes]
    if not at:
        at = ["cast(array() as array<struct<pos:int,end:int,size:int,w:string>>)"]
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), words_of(F.col("text")).alias("_words"))
    return every.select("doc_id", "_k", F.explode(F.expr(f"concat({', '.join(at)})")).alias("s")).select("doc_id", "_k", "s.*").join(windows, ["w", "size"]).select("doc_id", "_k", "pos", "end", "item_id")


def report(docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    marked = annotate(docs, benchmark, n, max_windows)
    if marked is None:
        return _report_joined(docs, benchmark, n)
    # One marker row a document beside its distinct windows: documents without hits stay, repeated rows are counted.
    windows = F.expr("concat(array(cast(null as bigint)), array_distinct(transform(_spans, s -> s.h)))")
    hits = marked.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), F.size("_words").cast("long").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.explode(windows).alias("h"))
    windows = windows_of(benchmark, n).select(F.xxhash64(F.split("w", " ")).alias("h"), "w", "item_id")
    n_windows, n_hashes, n_bytes = windows.agg(F.count_distinct("w"), F.count_distinct("h"), F.coalesce(F.sum(F.octet_length("item_id") + 16), F.lit(0))).first()
    if n_windows != n_hashes:  # a hash would name the items of two windows
        return _report_joined(docs, benchmark, n)
    # Marker rows have no window; they spread over all partitions by a key of their own.
    items = windows.select("h", F.lit(False).alias("marker"), "item_id")
    spread = hits.withColumn("marker", F.col("h").isNull()).withColumn("h", F.coalesce("h", F.xxhash64("doc_id", "_k")))
    found = (
        spread.join(F.broadcast(items) if n_bytes <= MAX_BROADCAST else items, ["h", "marker"], "left")
        .groupBy("doc_id", "_k")
        # Aggregates, so that a filter on them isn't pushed down to the scan and its words (see ``_clean``).
        .agg(F.max("n_words").alias("n_words"), F.max("n_hit").alias("n_hit"), F.count_if("marker").alias("times"), F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return _described(found)


def _described(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("_time"),
    ).drop("_time")


def _report_joined(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    hits = _joined(docs, benchmark, n).groupBy("doc_id", "_k").agg(F.collect_set(F.struct("pos", "end")).alias("_spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_text_key(F.col("text")).alias("_k"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    rows = every.groupBy("doc_id", "_k", "n_words").agg(F.count("*").alias("times"))
    both = rows.alias("d").join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d._k") == F.col("h._k")), "left").select("d.*", "h._spans", F.coalesce("h.items", F.array().cast("array<string>")).alias("items"))
    return _described(both.withColumn("n_hit", F.coalesce(F.expr(COVERED), F.lit(0).cast("long"))))


def clean(docs: DataFrame, benchmark: DataFrame, n: int = N, remove: str = "documents", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without the words of hit spans (``"spans"``).

    Span removal cuts the text from the first to the last character of each run of hit words.
    """
    return shielded(docs, ("_words", "_spans", "_n_hit", "_gaps", "_raw", "_key", "_id", "_k"), lambda mine: _clean(mine, benchmark, n, remove, max_windows))


def _clean(docs: DataFrame, benchmark: DataFrame, n: int, remove: str, max_windows: int) -> DataFrame:
    marked = annotate(docs, benchmark, n, max_windows)
    if marked is None:
        hits = _joined(docs, benchmark, n).groupBy("doc_id", "_k").agg(F.collect_set(F.expr("struct(pos, end, 0L AS h)")).alias("_spans")).withColumnRenamed("doc_id", "_id")
        keyed = docs.withColumn("_key", split_text_key(F.col("text")))
        marked = keyed.join(hits, keyed["doc_id"].cast("long").eqNullSafe(hits["_id"]) & (keyed["_key"] == hits["_k"]), "left").drop("_id", "_k", "_key")
        marked = marked.withColumn("_spans", F.coalesce("_spans", F.expr(NO_SPANS))).withColumn("_n_hit", F.expr(COVERED)).withColumn("_words", words_of(F.col("text")))
    if remove == "documents":
        # A filter on _n_hit would be pushed below the projections, which would then split the text anew for
        # every word; it can't pass the row that explode makes.
        return marked.select(*docs.columns, F.explode(F.array("_n_hit")).alias("_n_hit")).where("_n_hit = 0").select(*docs.columns)
    # Words in their own case, and the text before each and after the last: the two alternate.
    any_case = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    kept = """transform(sequence(0, size(_words)), i -> concat(
        if(exists(_spans, s -> s.pos < i AND i < s.end), '', get(_gaps, i)),
        if(i = size(_words) OR exists(_spans, s -> s.pos <= i AND i < s.end), '', get(_raw, i))))"""
    gaps, raw = F.split("text", any_case, -1), F.regexp_extract_all("text", F.lit(any_case), F.lit(0))
    out = marked.withColumn("_gaps", gaps).withColumn("_raw", raw).withColumn("text", F.when(F.col("_n_hit") > 0, F.array_join(F.expr(kept), "")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_hit") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


ORACLE = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS t
  FROM (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, CAST(len(ws) - least(10, len(ws)) + 2 AS BIGINT))) AS i FROM w WHERE len(ws) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
spot AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS t
  FROM (SELECT doc_id, ws, k, unnest(range(1, CAST(greatest(1, len(ws) - k + 2) AS BIGINT))) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM win))),
hit AS (SELECT spot.doc_id, spot.i, spot.k, win.item_id FROM spot JOIN win ON spot.t = win.t AND spot.k = win.k),
n_hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""
