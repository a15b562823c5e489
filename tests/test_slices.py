"""What a large run leaves on the disk: shuffles and tables of a slice go before the next one is made."""

import random
import time

from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.plans import funnel as PF
from vetrina.sources import sinks
from test_funnel import frame


def shuffle_files(spark):
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}


def test_the_shuffles_of_a_kept_table_go_with_it(spark):
    before = shuffle_files(spark)
    with sinks.cleared(spark):
        sinks.kept(spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count(), "x")
        for _ in range(50):  # files go a moment later
            if left := shuffle_files(spark) - before:
                time.sleep(0.2)
    assert not left and spark.conf.get(sinks.FREED) == "false"


def listings(spark):
    r = random.Random(5)
    rows = [{"item_id": f"{i:04d}", "key": "hot" if i % 3 else None if i % 6 else f"k{i % 25}", "price": float(r.choice([900, 2000, 2100, 2500, 40000])), "seller_name": f"s{r.randrange(300)}",
             "images_count": r.randrange(3), "image_hash": f"h{r.randrange(200)}", "title": r.choice(["t", "used", "x"])} for i in range(1200)]
    return frame(spark, rows).repartition(3)


def test_slices_of_keys_make_the_same_funnel(spark):
    cfg, rows = Config(min_price=1000.0, min_items=3, stopwords=("used",)), listings(spark)
    before = len(sinks._KEPT)
    with sinks.cleared(spark):
        whole = sorted(map(repr, PF.funnel(rows, cfg, F.col("price") > 2000).collect()))
        states = sorted(map(repr, PF.final_states(rows, cfg, F.col("price") > 2000).collect()))
    with sinks.cleared(spark):
        sliced = PF.funnel(rows, cfg, F.col("price") > 2000, slices=4)
        assert len(sinks._KEPT) == before + 4 and all("/slice-" in p for p in sinks._KEPT[before:])  # nothing but the results is left
        assert sorted(map(repr, sliced.collect())) == whole and len(whole) == 1200
    with sinks.cleared(spark):
        assert sorted(map(repr, PF.final_states(rows, cfg, F.col("price") > 2000, slices=4).collect())) == states
    assert {"VALIDATED", "REJECTED_BY_MIN_COUNT"} <= {s.split("state='")[1].split("'")[0] for s in states}
