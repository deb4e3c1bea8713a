"""Queries beside each other in one session give what they give alone, and the pipeline leaves one table."""

import os
import threading

import corpus_pipeline
from phrasemill.llm.common import Scope
from phrasemill.llm.queries import op4_simhash

SMALL = "/root/testdata/sf0.001"


def folders(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_simhash_and_the_pipeline_side_by_side(spark):
    before = folders(spark)
    with Scope(spark):
        alone = sorted(map(tuple, op4_simhash(spark, SMALL).collect()))
    assert folders(spark) == before
    packed = corpus_pipeline.run(spark, SMALL)
    want = sorted(map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))
    assert {f.rpartition("-")[0] for f in folders(spark) - before} == {"pipeline-pack"}
    got, failed = [], []

    def run(work):
        try:
            got.append(work())
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    def simhash():
        with Scope(spark):
            return sorted(map(tuple, op4_simhash(spark, SMALL).collect()))

    pipeline = lambda: sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "length", "ids_crc32").collect()))
    threads = [threading.Thread(target=run, args=(w,)) for w in (simhash, simhash, simhash, pipeline)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert sorted(got, key=len) == sorted([alone] * 3 + [want], key=len)


def test_columns_of_op7_come_in_their_order(spark):
    from phrasemill.llm.queries import op7_secrets

    assert op7_secrets(spark, SMALL).columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
