from pyspark.sql import functions as F

from tablelift.session import RELEASE, released, stage


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(k).getName() for k in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE, None)
    grouped = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = stage(grouped.join(grouped.withColumnRenamed("count", "again"), "k"), "released")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(RELEASE, None) == setting
    assert sorted(r["count"] for r in kept.collect()) == [285, 285, 286, 286, 286, 286, 286]


def test_the_setting_of_the_session_comes_back(spark):
    setting = spark.conf.get(RELEASE, None)
    try:
        for own in ("false", "true"):
            spark.conf.set(RELEASE, own)
            with released(spark):
                with released(spark):
                    pass
                assert spark.conf.get(RELEASE) == "true"
            assert spark.conf.get(RELEASE) == own
    finally:
        spark.conf.unset(RELEASE) if setting is None else spark.conf.set(RELEASE, setting)
