import tempfile

from pyspark.sql import functions as F

from starloom.plans.layers import Warehouse
from starloom.plans.models.staging import stg_games
from starloom.sources.sinks import read_layer
from starloom.streaming import read_raw_stream, start_upsert_stream


def test_stream_upsert_equals_batch(spark, sf_small):
    w = Warehouse(spark, sf_small)
    games = w.raw.games
    k = F.regexp_extract("game_id", r"G(\d+)", 1).cast("int")
    base = tempfile.mkdtemp(prefix="stream-")
    src, out = f"{base}/in", f"{base}/stg_games"
    line_scores = w.stg_line_scores  # static side of the per-batch join

    first = games.filter(k % 2 == 0)
    first.write.parquet(f"{src}/drop1")
    q = start_upsert_stream(spark, read_raw_stream(spark, f"{src}/*", games.schema),
                            lambda b: stg_games(b, line_scores), out, "game_id",
                            version_col="updated_at", checkpoint_location=f"{base}/ckpt")
    q.awaitTermination()
    # second drop: the other games, plus a newer version of some earlier ones
    later = (games.filter(k % 10 == 0).withColumn("home_pts", F.col("home_pts") + 1)
             .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY")))
    games.filter(k % 2 == 1).unionByName(later).write.parquet(f"{src}/drop2")
    q = start_upsert_stream(spark, read_raw_stream(spark, f"{src}/*", games.schema),
                            lambda b: stg_games(b, line_scores), out, "game_id",
                            version_col="updated_at", checkpoint_location=f"{base}/ckpt")
    q.awaitTermination()

    expected_raw = games.filter(k % 10 != 0).unionByName(later)
    expected = stg_games(expected_raw, line_scores)
    got = read_layer(spark, out).drop("_month")
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
