"""Requests, the ledger of replies, retries and odd replies."""

import json
import os
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.error import HTTPError

import pytest

from phrasemill.operators import enrich
from phrasemill.operators.enrich import ChatService, Ledger, TokenBucket

FINAL = "tool string, final_rank long, canonical_keyword string, category string, all_variants string"


@pytest.fixture
def ranked(spark):
    return spark.createDataFrame([(t, i, f'{t} "kw" {i}', None if i == 2 else "howto", "v" * 300) for t in ("x", "y") for i in range(1, 12)], FINAL)


@pytest.fixture
def server():
    """Fails each prompt's first request, then answers."""
    seen, answered = Counter(), Counter()
    lock = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][0]["content"]
            with lock:
                seen[asked] += 1
                first = seen[asked] == 1
                answered[asked] += not first
            if first:
                self.send_response(503)
                self.end_headers()
                return
            n = asked.count('"index":')
            reply = json.dumps({"choices": [{"message": {"content": json.dumps([{"index": n - 1, "fixed_title": "Last"}])}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(reply)))
            self.end_headers()
            self.wfile.write(reply)

        def log_message(self, *a):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/", seen, answered
    s.shutdown()


def test_each_prompt_is_answered_once(spark, ranked, server, tmp_path):
    url, seen, answered = server
    ask = ChatService(url, "m")
    for _ in range(2):  # the second run goes on with the first one's ledger
        got = {(r.tool, r.idx): r.fixed_title for r in enrich.propose(ranked, ask, 4, ledger=str(tmp_path / "ledger"), wait=0.01).collect()}
        assert got == {(t, i): "Last" for t in "xy" for i in (3, 7, 10)}
    assert len(seen) == 6 and set(seen.values()) == {2} and set(answered.values()) == {1}
    assert os.listdir(tmp_path / "ledger" / "fresh") == []  # folded into the table
    enrich.propose(ranked, ChatService(url, "other"), 4, ledger=str(tmp_path / "ledger"), wait=0.01).collect()
    assert set(answered.values()) == {2}  # another model is asked for itself


def test_a_dead_task_does_not_ask_again(spark, ranked, tmp_path):
    """A worker dies behind its third reply; the next run asks for the others only."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def ask(tool, entries):
        here = calls / entries[0]["keyword"].replace('"', "").replace(" ", "_")
        here.write_text(here.read_text() + "." if here.exists() else ".")
        if len(list(calls.iterdir())) == 4 and not (tmp_path / "died").exists():
            (tmp_path / "died").write_text("")
            os._exit(1)
        return [{"index": 0, "fixed_title": "T"}]

    path = str(tmp_path / "ledger")
    with pytest.raises(Exception):
        enrich.propose(ranked.coalesce(1), ask, 3, ledger=path).collect()
    kept = len(os.listdir(tmp_path / "ledger" / "fresh"))
    assert kept >= 1
    got = enrich.propose(ranked.coalesce(1), ask, 3, ledger=path).collect()
    assert len(got) == 8 and {r.error for r in got} == {None}
    asked = [len(p.read_text()) for p in calls.iterdir()]
    assert len(asked) == 8 and sum(n == 1 for n in asked) >= kept


def test_requests_are_tables(spark, ranked):
    rows = {(r.tool, r.chunk): r for r in enrich.requests(ranked, "m", 5).collect()}
    assert {k: r.n for k, r in rows.items()} == {(t, c): n for t in "xy" for c, n in ((0, 5), (1, 5), (2, 1))}
    entries = json.loads(rows["x", 0].entries)
    assert entries[1] == {"keyword": 'x "kw" 2', "category": None, "variants": "v" * 200}
    assert len({r.key for r in rows.values()}) == 6
    other = {(r.tool, r.chunk): r.key for r in enrich.requests(ranked, "n", 5).collect()}
    assert all(other[k] != r.key for k, r in rows.items())


def test_lasting_errors_are_not_tried_again():
    calls = []

    def ask(code):
        def call(tool, entries):
            calls.append(code)
            raise HTTPError("u", code, "no", None, None)

        return call

    for code, n in ((400, 1), (503, 3)):
        calls.clear()
        with pytest.raises(HTTPError):
            enrich.answered(ask(code), "t", [], "0123456789abcdef", 3, 0.001, 0)
        assert len(calls) == n


def test_token_bucket():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s

    b = TokenBucket(2.0, 2, lambda: now[0], sleep)
    for _ in range(4):
        b.take()
    assert slept == [0.5, 0.5]  # two at once, then one in half a second
    now[0] += 10
    b.take(), b.take()
    assert slept == [0.5, 0.5]


def test_odd_replies(spark):
    replies = [
        ("t", 0, 2, None, "OSError: down"), ("t", 1, 2, None, None), ("t", 2, 2, "", None), ("t", 3, 2, "```", None), ("t", 4, 2, '```json\n[{"index": 1, "fixed_title": "A"}]\n``` ', None),
        ("t", 5, 2, '[{"index": 0, "irrelevant": true, "duplicate_of": 1}, {"index": 2}, {"x": 1}, [], null]', None), ("t", 6, 2, "[]", None), ("t", 7, 2, '[{"index": 0}] and more', None),
    ]
    got = sorted(map(tuple, enrich.fixes(spark.createDataFrame(replies, enrich.REPLIES), 2).collect()), key=str)
    want = [("t", 9, "A", False, None, None), ("t", 10, None, True, 11, None)]
    want += [("t", None, None, None, None, e) for e in ["OSError: down", "no reply", *["no JSON array"] * 3, *["record without an index"] * 3]]
    assert got == sorted(want, key=str)


def test_ledger_without_anything(spark, tmp_path):
    book = Ledger(str(tmp_path / "none"))
    assert book("k") is None and book.replies(spark).count() == 0
    book.fold(spark)
    book.put("k", "a\nreply")
    book.put("k", "a\nreply")
    assert book("k") == "a\nreply" and book.replies(spark).count() == 1
    book.fold(spark)
    assert book("k") is None and [r.reply for r in book.replies(spark).collect()] == ["a\nreply"]
