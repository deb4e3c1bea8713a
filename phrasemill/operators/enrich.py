"""Optional enrichment: an injected callable proposes fixes for chunks of result rows.

The callable takes a tool and a list of {"keyword", "category", "variants"} and returns either a reply text (JSON, fenced or not) or
a list of records {"index", "fixed_title", "irrelevant", "duplicate_of"}. ``ChatService`` is such a callable for a chat service
behind HTTP. What is asked and what came back are tables:

* ``requests``: a row a chunk, with its entries as JSON and a key (hash of the model and the entries);
* ``Ledger``: a folder of replies by key. Requests that it holds aren't asked again, neither by a later run nor by a task that is
  tried again, since every reply is put there before the next one is asked for. Two attempts of one task that run at the same time (speculation)
  may both ask;
* ``answers``: asks for what is missing, with a token bucket a worker, retries and growing pauses;
* ``fixes``: replies taken apart as VARIANT columns. A reply that is no JSON array, and a record without a whole-number index, are
  rows with ``error``; the other records of the reply count. Records whose index isn't in the chunk are dropped.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.error import HTTPError
from urllib.request import Request, urlopen

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..plans.ship import ship
from ..plans.storage import shared_path, stored
from ..sources.files import listed, located, put_file
from .consolidate import CHUNK, apply_fixes, chunked

Ask = Callable[[str, list[dict]], str | list[dict]]
SHOWN_CHARS = 200
REPLIES = "tool string, chunk long, n int, reply string, error string"
#: Answers of a service that may be better the next time.
PASSING = (408, 409, 425, 429, 500, 502, 503, 504, 529)


def requests(ranked: DataFrame, model: str = "", size: int = CHUNK) -> DataFrame:
    """tool, chunk, n (entries), entries (a JSON array in order), key. A chunk has at most ``size`` rows."""
    entry = F.struct("idx_in_chunk", F.col("canonical_keyword").alias("keyword"), "category", F.left("all_variants", F.lit(SHOWN_CHARS)).alias("variants"))
    listed_ = F.array_sort(F.collect_list(entry))
    text = F.to_json(F.transform(listed_, lambda e: e.dropFields("idx_in_chunk")), {"ignoreNullFields": "false"})
    out = chunked(ranked, size).groupBy("tool", "chunk").agg(F.count("*").cast("int").alias("n"), text.alias("entries"))
    return out.withColumn("key", F.sha2(F.concat_ws("\n", F.lit(model), "tool", "entries").cast("binary"), 256))


class TokenBucket:
    """At most ``rate`` calls a second on average, ``burst`` at once."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            now = self.clock()
            self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        self.tokens -= 1


_BUCKETS: dict[float, TokenBucket] = {}


def bucket(pause: float) -> TokenBucket | None:
    """The worker's bucket for one call in ``pause`` seconds, kept between tasks."""
    return _BUCKETS.setdefault(pause, TokenBucket(1 / pause)) if pause > 0 else None


class Ledger:
    """Replies by key: a file a reply as they come, folded into one table by ``fold``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, key: str) -> str | None:
        """The reply to ``key`` if it came since the last ``fold``."""
        store, place = located(f"{self.path}/fresh/{key}.json")
        if not store.get_file_info(place).is_file:
            return None
        with store.open_input_stream(place) as f:
            return json.loads(f.read())["reply"]

    def put(self, key: str, reply: str) -> None:
        store, place = located(f"{self.path}/fresh/{key}.json")
        put_file(store, place, [json.dumps({"key": key, "reply": reply}).encode()])

    def _has(self, name: str) -> bool:
        store, place = located(f"{self.path}/{name}")
        return store.get_file_info(place).type.name == "Directory"

    def replies(self, spark) -> DataFrame:
        """key, reply of all that is known."""
        schema = "key string, reply string"
        known = spark.createDataFrame([], schema)
        if self._has("replies"):
            known = known.union(spark.read.schema(schema).parquet(f"{self.path}/replies"))
        if self._has("fresh"):
            known = known.union(spark.read.schema(schema).json(f"{self.path}/fresh"))
        return known.dropDuplicates(["key"])

    def fold(self, spark) -> None:
        """Move fresh replies to the table, so that files stay few."""
        if not self._has("fresh"):
            return
        files = listed(f"{self.path}/fresh")
        spark.read.schema("key string, reply string").json(f"{self.path}/fresh").coalesce(1).write.mode("append").parquet(f"{self.path}/replies")
        store, _ = located(self.path)
        for place in files:
            store.delete_file(place)


def answered(ask: Ask, tool: str, entries: list[dict], key: str, tries: int, wait: float, pause: float) -> str:
    """The reply, asked for up to ``tries`` times; the pause between tries doubles (and differs by key)."""
    tokens = bucket(pause)
    for n in range(tries):
        if tokens is not None:
            tokens.take()
        try:
            reply = ask(tool, entries)
            return reply if isinstance(reply, str) else json.dumps(reply)
        except Exception as e:  # noqa: BLE001  what a remote service does must not end the job
            lasting = isinstance(e, HTTPError) and e.code not in PASSING
            if lasting or n == tries - 1:
                raise
            time.sleep(wait * 2**n * (0.5 + int(key[n : n + 4], 16) / 65536))
    raise ValueError("no try at all")


def answers(asked: DataFrame, ask: Ask, ledger: Ledger, tries: int = 4, wait: float = 1.0, pause: float = 0.0) -> DataFrame:
    """tool, chunk, n, reply, error of every request. Replies that the ledger has are taken from it by a join; others are asked for."""
    spark = asked.sparkSession
    ship(spark)
    known = ledger.replies(spark)

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for pdf in frames:
            rows = []
            for r in pdf.itertuples():
                reply, error = ledger(r.key), None  # an earlier attempt of this task may have it
                if reply is None:
                    try:
                        reply = answered(ask, r.tool, json.loads(r.entries), r.key, tries, wait, pause)
                        ledger.put(r.key, reply)
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                rows.append((r.tool, r.chunk, r.n, reply, error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in REPLIES.split(", ")])

    missing = asked.join(known, "key", "left_anti").repartition("key").mapInPandas(run, REPLIES)
    return asked.join(known, "key").select("tool", "chunk", "n", "reply", F.lit(None).cast("string").alias("error")).unionByName(missing)


def _get(record: str, name: str, kind: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", kind)


def fixes(replies: DataFrame, size: int = CHUNK) -> DataFrame:
    """tool, idx, fixed_title, irrelevant, duplicate_of, error from ``replies`` (tool, chunk, n, reply, error)."""
    # The parser stops behind the first value; inside brackets, nothing else may follow it.
    around = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), X.without_fence(F.col("reply")), F.lit("]"))), "$", "array<variant>")
    parsed = replies.withColumn("_all", around).withColumn("_items", F.when(F.size("_all") == 1, F.try_variant_get(F.get("_all", F.lit(0)), "$", "array<variant>")))
    first = F.col("chunk") * size
    null = {"idx": "long", "fixed_title": "string", "irrelevant": "boolean", "duplicate_of": "long"}
    why = F.coalesce("error", F.when(F.col("reply").isNull(), "no reply").when(F.col("_items").isNull(), "no JSON array"))
    failed = parsed.withColumn("error", why).where("error is not null").select("tool", *(F.lit(None).cast(t).alias(c) for c, t in null.items()), "error")
    records = parsed.where("error is null").select("tool", "n", first.alias("_first"), F.explode("_items").alias("_r"))
    typed = records.select(
        "tool", "n", "_first", _get("_r", "index", "int").alias("_at"), _get("_r", "fixed_title", "string").alias("fixed_title"),
        F.coalesce(_get("_r", "irrelevant", "boolean"), F.lit(False)).alias("irrelevant"), _get("_r", "duplicate_of", "int").alias("_dup"),
    )
    good = typed.where("_at is null or (_at >= 0 and _at < n)")
    return failed.unionByName(
        good.select(
            "tool", (F.col("_first") + F.col("_at")).alias("idx"), F.when(F.col("_at").isNotNull(), F.col("fixed_title")).alias("fixed_title"),
            F.when(F.col("_at").isNotNull(), F.col("irrelevant")).alias("irrelevant"), F.when(F.col("_at").isNotNull(), F.col("_first") + F.col("_dup")).alias("duplicate_of"),
            F.when(F.col("_at").isNull(), "record without an index").alias("error"),
        )
    )


def propose(ranked: DataFrame, ask: Ask, size: int = CHUNK, pause: float = 0.0, ledger: str | None = None, tries: int = 4, wait: float = 1.0) -> DataFrame:
    """Fix records of every chunk; what failed are rows with ``error``. ``ledger``: a folder that later runs may go on with."""
    book = Ledger(ledger or shared_path(ranked.sparkSession, "ledger"))
    asked = stored(requests(ranked, getattr(ask, "model", ""), size), "requests")
    replies = stored(answers(asked, ask, book, tries, wait, pause), "replies")
    book.fold(ranked.sparkSession)
    return fixes(replies, size)


def enrich(ranked: DataFrame, ask: Ask, size: int = CHUNK, pause: float = 0.0, ledger: str | None = None, tries: int = 4, wait: float = 1.0) -> DataFrame:
    """``ranked`` with the proposed fixes applied; suggested titles (where there are any) follow the fixed keywords."""
    found = stored(propose(ranked, ask, size, pause, ledger, tries, wait), "fixes")
    fixed = apply_fixes(ranked, found.where("error is null"))
    if "suggested_title" in ranked.columns:
        fixed = fixed.withColumn("suggested_title", X.suggested_title(F.col("canonical_keyword"), F.col("tool")))
    return fixed


def prompt(tool: str, entries: list[dict]) -> str:
    """The request for one chunk: what the fields of a reply mean, then a JSON record a line."""
    lines = "\n".join(json.dumps({"index": i, **e}, ensure_ascii=False) for i, e in enumerate(entries))
    return (
        f"You keep the topic list of a help center for the product {tool}. Every line below is one topic as a JSON record: its index, the keyword that stands for it, "
        "a category, and some spellings that people typed.\n"
        "Answer with nothing but a JSON array. Put an object into it for each topic, with these fields:\n"
        "- index: the topic's index\n"
        "- fixed_title: how an article on it should be called, with names spelled right; null if the keyword is good as it is\n"
        f"- irrelevant: true where no article about {tool} could be written\n"
        "- duplicate_of: the index of another topic here that asks for the same; null if there is none\n\n"
        f"{lines}\n"
    )


def reply_text(reply: dict) -> str:
    """The text of a chat service's JSON reply, in either of the two usual shapes."""
    if "choices" in reply:
        return reply["choices"][0]["message"]["content"]
    return "".join(part.get("text", "") for part in reply["content"])


@dataclass(frozen=True)
class ChatService:
    """``ask`` by HTTP: posts a chat request as JSON. Sent to the workers, so it holds plain values only."""

    url: str
    model: str
    key: str = field(repr=False, default="")
    max_tokens: int = 4096
    timeout: float = 120.0

    def __call__(self, tool: str, entries: list[dict]) -> str:
        body = {"model": self.model, "max_tokens": self.max_tokens, "messages": [{"role": "user", "content": prompt(tool, entries)}]}
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}", "x-api-key": self.key}
        with urlopen(Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as reply:
            return reply_text(json.load(reply))


def api_key(variable: str = "PHRASEMILL_API_KEY", file: str = ".api_key") -> str | None:
    """The service's key: from the environment, else from a file in the working folder, else None."""
    key = os.environ.get(variable, "").strip()
    if not key and os.path.exists(file):
        with open(file, encoding="utf-8") as f:
            key = f.read().strip()
    return key or None
