"""New keys over runs, exactly and by sketches."""

from pyspark.sql import functions as F

from phrasemill.operators import history


def test_sketches_of_many_keys_stay_within_their_error(spark):
    """40,000 keys a run, of which half came before, from small sketches."""
    n = 40_000
    runs = [spark.range(r * n // 2, r * n // 2 + n).select(F.lit(r).cast("long").alias("run"), F.lit("t").alias("tool"), F.lit("b").alias("batch"), F.concat(F.lit("k"), "id").alias("key_str")) for r in range(3)]
    rows = runs[0].union(runs[1]).union(runs[2]).union(runs[2])
    exact = {r.run: (r.n_keys, r.n_new) for r in history.new_keys(rows).collect()}
    assert exact == {0: (n, n), 1: (n, n // 2), 2: (n, n // 2)}
    kept = history.run_sketches(rows)
    assert kept.select(F.max(F.length("sketch"))).first()[0] < 40_000
    for r in history.new_keys_estimated(kept).collect():
        assert abs(r.n_keys - n) < 0.08 * n and abs(r.n_new - exact[r.run][1]) < 0.12 * n


def test_few_keys_are_exact(spark):
    rows = spark.createDataFrame([(2, "t", "b", "x"), (2, "t", "b", "y"), (1, "t", "b", "x"), (1, "t", "b", "x"), (3, "t", "b", "x"), (1, "u", "b", "x")], "run long, tool string, batch string, key_str string")
    want = {(1, "t", 1, 1), (2, "t", 2, 1), (3, "t", 1, 0), (1, "u", 1, 1)}
    for found in (history.new_keys(rows), history.new_keys_estimated(history.run_sketches(rows))):
        assert {(r.run, r.tool, r.n_keys, r.n_new) for r in found.collect()} == want
    assert history.new_keys_estimated(history.run_sketches(rows.where("false"))).count() == 0
