"""Leaders on a stream against one scan in the order of arrival."""

import pytest
from pyspark.sql import functions as F

from phrasemill import queries
from phrasemill.operators import cluster, consolidate
from phrasemill.streaming import leaders

SMALL = "/root/testdata/sf0.001"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocksdb(spark):
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(PROVIDER)


def scanned(spark, rows):
    """key -> leader's key by one scan of the keys in order of their first arrival."""
    keys = consolidate.keyed(consolidate.relevant(rows)).groupBy("tool", "batch", "key_str").agg(F.first("key").alias("key"), F.min("pos").alias("group_rank"))
    groups = keys.withColumn("lead", consolidate.X.lead_verb(F.col("key"))).cache()
    of_batch = {"standard": consolidate.STD_THRESHOLD, "low_volume": consolidate.LOW_THRESHOLD}
    found = cluster.local(groups, *({b: t[i] for b, t in of_batch.items()} for i in (0, 1)))
    name = {(r.tool, r.batch, r.group_rank): r.key_str for r in groups.collect()}
    return {(r.tool, r.batch, name[r.tool, r.batch, r.group_rank]): name[r.tool, r.batch, r.leader_rank] for r in found.collect()}


@pytest.mark.parametrize("files, posted", [(1, 64), (3, 64), (5, 2)])
def test_any_split_gives_the_leaders_of_one_scan(spark, tmp_path, rocksdb, files, posted):
    rows = queries.keywords(spark, SMALL)
    data = rows.toPandas().sort_values("pos")
    step = -(-len(data) // files)
    for i in range(files):  # files arrive in this order, one a micro-batch
        part = spark.createDataFrame(data.iloc[i * step : (i + 1) * step], rows.schema)
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = leaders.leader_stream(source, posted=posted).writeStream.format("memory").queryName(f"leaders{files}").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    batches = len({p["batchId"] for p in q.recentProgress if p["numInputRows"]})
    q.stop()
    got = spark.table(f"leaders{files}").collect()
    assert batches == files
    want = scanned(spark, rows)
    assert {(r.tool, r.batch, r.key_str): r.leader_key for r in got} == want
    assert len(got) == consolidate.keyed(consolidate.relevant(rows)).count() and any(k[2] != v for k, v in want.items())
