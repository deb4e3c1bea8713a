"""Joins, clusters, sources, sinks, enrichment and the whole job."""

import csv
import zipfile
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasemill import cli, oracle, queries
from phrasemill.operators import cluster, consolidate, enrich, ranks, setsim
from phrasemill.plans.consolidation import Consolidation, Settings
from phrasemill.sources import keywords as K
from phrasemill.sources.xlsx import column_number, read_cells
from phrasemill.streaming.keywords import group_sizes

SMALL = "/root/testdata/sf0.001"


def jac(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(2)
    words = ["add", "remove", "create", *(f"w{i}" for i in range(14))]
    keys = sorted({tuple(sorted(set(rng.choice(words, rng.integers(1, 7)).tolist()))) for _ in range(260)})
    rng.shuffle(keys)
    rows = [("t" if i % 3 else "u", "b", i, list(k), next((w for w in k if w in ("add", "remove", "create")), None)) for i, k in enumerate(map(tuple, keys))]
    return spark.createDataFrame(rows, "tool string, batch string, group_rank long, key array<string>, lead string").cache()


@pytest.mark.parametrize("num,den", [(7, 10), (13, 20), (1, 2)])
def test_similar_pairs_equal_nested_loops(sets, num, den):
    side = sets.select("tool", F.col("group_rank").alias("id"), "key")
    got = {(r.tool, r.l_id, r.r_id) for r in setsim.similar_pairs(side, side, ["tool"], num, den, F.col("l_id") < F.col("r_id")).collect()}
    rows = [(r.tool, r.group_rank, set(r.key)) for r in sets.collect()]
    assert got == {(t, i, j) for t, i, a in rows for u, j, b in rows if t == u and i < j and den * len(a & b) >= num * len(a | b)}


def slow_clusters(rows, num, den):
    out, leaders = {}, defaultdict(list)
    never = {frozenset(p) for p in consolidate.DEFAULT.never_merge}
    for t, rank, key, lead in sorted(rows, key=lambda r: r[1]):
        best = None
        for r, k, v in leaders[t]:
            if den * len(key & k) >= num * len(key | k) and frozenset((lead, v)) not in never and (best is None or jac(key, k) > best[0]):
                best = jac(key, k), r
        if best:
            out[t, rank] = best[1]
        else:
            leaders[t].append((rank, key, lead))
            out[t, rank] = rank
    return out


@pytest.mark.parametrize("num,den", [(7, 10), (1, 2)])
def test_clusters(sets, num, den):
    want = slow_clusters([(r.tool, r.group_rank, set(r.key), r.lead) for r in sets.collect()], num, den)
    for found in (cluster.local(sets, num, den), cluster.iterated(sets, num, den), cluster.leader_clusters(sets, num, den, max_local=90)):
        assert {(r.tool, r.group_rank): r.leader_rank for r in found.collect()} == want


def test_chain_and_tie(spark):
    rows = [("t", "b", 1, ["a", "b", "c"], None), ("t", "b", 2, ["d", "e", "f"], None), ("t", "b", 3, ["a", "b", "c", "d", "e", "f"], None), ("t", "b", 4, ["a", "b", "c", "d", "e", "f", "g"], None)]
    df = spark.createDataFrame(rows, "tool string, batch string, group_rank long, key array<string>, lead string")
    for f in (cluster.local, cluster.iterated):
        assert {r.group_rank: r.leader_rank for r in f(df, 1, 2).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}


@pytest.mark.parametrize("num,den,i,u,ok", [(3, 4, 3, 4, True), (4, 5, 4, 5, True), (7, 10, 7, 10, True), (13, 20, 13, 20, True), (4, 5, 3, 4, False)])
def test_thresholds_are_inclusive(spark, num, den, i, u, ok):
    df = spark.createDataFrame([([f"a{k}" for k in range(i)], [f"a{k}" for k in range(u)])], "a array<string>, b array<string>")
    assert df.select(setsim.at_least(F.col("a"), F.col("b"), num, den)).collect()[0][0] is ok


def test_canonical(spark):
    def pick(*kws):
        df = spark.createDataFrame(list(enumerate(kws)), "pos long, keyword string")
        return df.agg(consolidate.canonical(F.col("keyword"), F.col("pos")).alias("c")).collect()[0].c

    assert pick("x", "how to add row", "How to add a long row") == "How to add a long row"
    assert pick("x", "how to b", "how to a") == "how to b"
    assert pick("x", "my integration") == "my integration" and pick("bb", "aa") == "bb"


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def write_book(path, sheets, shared):
    with zipfile.ZipFile(path, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><numFmts><numFmt numFmtId="170" formatCode="yyyy/mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        for i, (_, body) in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")


def inline(ref, text):
    return f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'


def row(n, *cells):
    return f'<row r="{n}">' + "".join(inline(f"{chr(65 + i)}{n}", t) for i, t in enumerate(cells) if t is not None) + "</row>"


@pytest.fixture
def book(tmp_path):
    path = tmp_path / "book.xlsx"
    kinds = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="AA1"><v>12</v></c></row><row r="3"><c r="A3"><v>12.5</v></c><c r="B3" t="b"><v>1</v></c><c r="C3" t="e"><v>#REF!</v></c><c r="D3" s="1"><v>45000</v></c><c r="E3" s="2"><v>45000.5</v></c><c r="F3"/></row>'
    sheets = [
        ("kinds", kinds),
        ("Jira - 10+", row(1, "Keyword", "how to add a board") + row(2, "how to add board in jira", "add boards") + row(3, "how to insert a board")),
        ("JIRA - below 10", "".join(row(i + 1, f"how to delete a sprint {'' if i % 2 else 'now'}") for i in range(8))),
        ("Clean", row(1, "never seen here")),
        ("Mix of tools", row(1, "Asana", "None", "Asana", "Trello") + row(2, "add asana task", "zzz words", "later column", None) + row(3, "x", None, None, "trello card")),
    ]
    write_book(path, sheets, ["<t>plain</t>", '<r><t>rich </t></r><r><t xml:space="preserve">text</t></r><rPh><t>hint</t></rPh>'])
    return path


def test_workbook(spark, book):
    cells = read_cells(spark, str(book)).cache()
    got = {(r.row_idx, r.col_idx): r.value for r in cells.where("sheet = 'kinds'").collect()}
    assert got == {(0, 0): "plain", (0, 2): "rich text", (0, 26): "12", (2, 0): "12.5", (2, 1): "True", (2, 2): "#REF!", (2, 3): "2023-03-15 00:00:00", (2, 4): "2023-03-15 12:00:00"}
    assert column_number("AB12") == 27
    kws = K.all_keywords(cells).collect()
    assert {r.tool for r in kws} == {"kinds", "Jira", "Mix of tools", "Asana", "Trello"}
    jira = sorted((r.pos, r.keyword) for r in kws if r.tool == "Jira" and r.batch == "standard")
    assert [k for _, k in jira] == ["how to add a board", "how to add board in jira", "add boards", "how to insert a board"]
    assert sum(r.batch == "low_volume" for r in kws) == 8
    assert {r.keyword for r in kws if r.tool == "Asana"} == {"later column"}
    assert {r.tool for r in K.all_keywords(cells, compat=False).collect()} == {"kinds", "Jira", "Asana", "Trello"}


def test_cli(spark, book, tmp_path):
    titles = tmp_path / "titles.csv"
    titles.write_text('Id,Name\r\n1,"How to Track a ""time"" log, daily"\r\n2,\r\n3,"two\nlines"\r\n4\r\n', encoding="utf-8-sig")
    assert {r.title for r in K.read_titles(spark, str(titles)).collect()} == {'How to Track a "time" log, daily', "two\nlines"}
    out = tmp_path / "out"
    final = cli.run(spark, cli.arguments(["--xlsx", str(book), "--cms", str(titles), "-o", str(out), "--tools", "jira"]))
    rows = {r.batch: r for r in final.collect()}
    assert rows["standard"].canonical_keyword == "how to add a board" and rows["standard"].variant_count == 4 and rows["standard"].signal_strength == "medium"
    assert rows["low_volume"].variant_count == 8 and rows["low_volume"].frequency_count == "8"
    assert sorted(p.name for p in out.glob("*") if not p.name.startswith(("_", "."))) == ["Jira_cleaned.csv"]
    lines = list(csv.DictReader(Path(out, "Jira_cleaned.csv").open(newline="")))
    assert [(r["canonical_keyword"], r["suggested_title"], r["variant_count"]) for r in lines] == [(r.canonical_keyword, r.suggested_title, str(r.variant_count)) for r in final.orderBy("final_rank").collect()]


def test_enrichment(spark):
    final = spark.createDataFrame([("t", i, f"kw {i}", "howto", "v" * 300) for i in range(1, 8)], "tool string, final_rank long, canonical_keyword string, category string, all_variants string")

    def ask(tool, entries):
        assert tool == "t" and len(entries) <= 3 and len(entries[0]["variants"]) == 200
        if entries[0]["keyword"] == "kw 4":
            raise OSError("down")
        return '```json\n[{"index": 0, "fixed_title": "New", "irrelevant": false, "duplicate_of": null}, {"index": 1, "irrelevant": true}, {"index": 2, "duplicate_of": 0}, {"index": 9, "fixed_title": "no"}]\n```'

    got = {r.final_rank: r.canonical_keyword for r in enrich.enrich(final, ask, size=3, tries=1).collect()}
    assert got == {1: "New", 4: "kw 4", 5: "kw 5", 6: "kw 6", 7: "New"}
    assert [r.error for r in enrich.propose(final, ask, size=3, tries=2, wait=0.01).where("error is not null").collect()] == ["OSError: down"]


def test_enrichment_by_http(spark, book, tmp_path, monkeypatch):
    """The command line's service, key and report against a small server."""
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.headers["Authorization"], body["model"], body["max_tokens"], body["messages"][0]["content"]))
            text = "```json\n" + json.dumps([{"index": 0, "fixed_title": "How to add boards", "irrelevant": False, "duplicate_of": None}, {"index": 1, "irrelevant": True}]) + "\n```"
            reply = json.dumps({"content": [{"type": "text", "text": text}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(reply)))
            self.end_headers()
            self.wfile.write(reply)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("PHRASEMILL_API_KEY", raising=False)
    titles = tmp_path / "titles.csv"
    titles.write_text("Name\nnothing like it\n")
    argv = ["--xlsx", str(book), "--cms", str(titles), "-o", str(tmp_path / "out"), "--tools", "jira", "--ai-cleanup", "--ai-url", f"http://127.0.0.1:{server.server_port}/v1", "--ai-model", "m", "--ai-pause", "0"]
    assert cli.service(cli.arguments(argv)) is None  # no key
    (tmp_path / ".api_key").write_text("sesame\n")
    args, reports = cli.arguments(argv), []
    rows = cli.run(spark, args, cli.service(args), lambda df: reports.append({tuple(r)[-2:] for r in df.collect()})).collect()
    server.shutdown()
    assert [(r.batch, r.canonical_keyword, r.suggested_title) for r in rows] == [("low_volume", "How to add boards", "How to add boards")]
    assert len(seen) == 1 and seen[0][:3] == ("Bearer sesame", "m", 4096) and '"index": 1, "keyword": "how to add a board"' in seen[0][3] and "Jira" in seen[0][3]
    assert ("titles", 1) in reports[1] and {s for s, _ in reports[0]} >= {"raw", "relevant", "groups", "clusters", "results", "kept"}
    assert enrich.reply_text({"choices": [{"message": {"content": "x"}}]}) == "x"


def test_two_workbooks_keep_apart(spark):
    rows = [("a.xlsx", 0, "Jira", 0, 0, "add board"), ("b.xlsx", 0, "Notion", 0, 0, "add page"), ("b.xlsx", 1, "JIRA", 0, 0, "add sprint")]
    rows += [(b, 2, "mix of tools", r, 0, v) for b, vs in (("a.xlsx", ("Asana", "add task")), ("b.xlsx", ("Trello", "add card"))) for r, v in enumerate(vs)]
    cells = spark.createDataFrame(rows, "path string, sheet_idx int, sheet string, row_idx int, col_idx int, value string")
    got = sorted((r.pos, r.tool, r.keyword) for r in K.all_keywords(cells, compat=False).collect())
    assert [g[1:] for g in got] == [("Jira", "add board"), ("Notion", "add page"), ("Jira", "add sprint"), ("Asana", "add task"), ("Trello", "add card")]
    far = cells.withColumn("sheet_idx", F.lit(5000))
    with pytest.raises(Exception, match="more workbooks, tabs"):
        K.all_keywords(far).collect()


def test_numbering_large_scopes_by_ranges(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 10 == 0 else "t" if i % 3 else "u", int(rng.integers(0, 20)), i) for i in range(600)]
    df = spark.createDataFrame(rows, "tool string, n long, pos long")
    order = [(-F.col("n")).alias("a"), F.col("pos").alias("b")]
    small, large = (sorted((r.pos, r.k) for r in ranks.numbered(df, ["tool"], order, "k", m).collect()) for m in (10**6, 50))
    assert small == large
    want = {}
    for t in (None, "t", "u"):
        want |= {pos: k for k, (_, _, pos) in enumerate(sorted((r for r in rows if r[0] == t), key=lambda r: (-r[1], r[2])), 1)}
    assert dict(small) == want


def test_keys_are_made_once(spark):
    """The normalizer stands once in the plan: no filter or aggregate has a copy of it."""
    keywords = spark.createDataFrame([("t", "standard", 1, "add a board")], "tool string, batch string, pos long, keyword string")
    plan = consolidate.keyed(keywords)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(array_distinct(") == 1


def test_low_volume_branch_is_live(spark):
    """On sf0.01 low-volume clusters qualify, and some of them repeat a standard one."""
    rows = {r.stage: r.n for r in queries.stage_counts(spark, "/root/testdata/sf0.01").where("batch = 'low_volume'").groupBy("stage").agg(F.sum("n").alias("n")).collect()}
    assert rows["results"] > rows["kept"] > 0 and rows["clusters"] > rows["results"]


def test_empty_input(spark):
    keywords = spark.createDataFrame([], "tool string, batch string, pos long, keyword string")
    titles = spark.createDataFrame([], "title_pos long, title string")
    assert Consolidation(keywords, titles).final().count() == 0


def test_large_partitions_go_by_rounds(spark):
    kw, ti = queries.keywords(spark, SMALL), queries.titles(spark, SMALL)
    a, b = (Consolidation(kw, ti, Settings(max_local=n)).final().orderBy("tool", "final_rank").collect() for n in (5, 1000))
    assert a == b and a


def test_stream(spark, tmp_path):
    queries.keywords(spark, SMALL).write.parquet(str(tmp_path / "in"))
    stream = group_sizes(spark.readStream.schema("pos long, tool string, batch string, keyword string").parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("sizes").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.tool, r.batch, r.key_str): r.n for r in spark.table("sizes").collect()}
    want = {(r.tool, r.batch, r.key_str): r.n for r in queries.intent_groups(spark, SMALL).collect()}
    assert got == want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, tmp_path, name):
    import duckdb

    df = queries.QUERIES[name](spark, SMALL)
    df.write.parquet(str(tmp_path / "q"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{SMALL}/part.parquet'")
    cols = ", ".join(f'"{c}"' for c in df.columns)
    want = sorted(map(repr, con.sql(f"select {cols} from ({oracle.ORACLE_SQL[name]})").fetchall()))
    assert sorted(map(repr, con.sql(f"select {cols} from '{tmp_path}/q/*.parquet'").fetchall())) == want


def test_rounds_query_of_each_batch_equals_the_scan(spark):
    from phrasemill.queries import QUERIES

    rows = lambda name: sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    for rounds, scan in (("leader_cluster_rounds", "leader_cluster_std"), ("leader_cluster_rounds_low", "leader_cluster_low")):
        assert rows(rounds) == rows(scan) != []
