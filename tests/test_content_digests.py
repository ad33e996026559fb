"""Content digests are put together from sums in longs, with the values of exact decimal sums."""

from pyspark.sql import functions as F

from martlet.sources.driver_tables import SECOND_BATCH as SECOND
from martlet.sources.driver_tables import SELECTED_BATCH as FIRST
from martlet.sources.landing import content_digests


def test_content_digests_keep_their_values(spark):
    df = spark.createDataFrame([(i, "x" * (i % 5), FIRST if i % 2 else SECOND) for i in range(200)], "id long, t string, _BATCH_ID string")
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("_BATCH_ID", "id", "t")]
    sums = [F.sum(F.xxhash64(F.lit(s), F.lit("ID,T,_BATCH_ID"), *[texts[1], texts[2], texts[0]]).cast("decimal(38,0)")) for s in (1, 2)]
    want = {r[0]: f"content:{r[1]}:{r[2]}:{r[3]}" for r in df.groupBy("_BATCH_ID").agg(F.count("*"), *sums).collect()}
    assert content_digests(df, "_BATCH_ID") == want
