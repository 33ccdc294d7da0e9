"""Session settings this package is tuned for."""

from pyspark.sql import SparkSession

# Wide projections compile to methods above the 8000 bytes that HotSpot is willing to JIT. With this limit Spark
# falls back to projections split into small methods, which do get compiled (up to twice as fast for 130 columns).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # state of streaming aggregates on disk, of which a trigger uploads what it changed
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

METHODS = "spark.sql.codegen.hugeMethodLimit"


def tuned(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the method limit of ``SETTINGS``, unless it has one of its own.

    Spark's default, 65535 bytes, keeps projections of up to 100 columns in one method that the JVM only interprets.
    """
    if spark.conf.get(METHODS) == "65535":
        spark.conf.set(METHODS, SETTINGS[METHODS])
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass ``SETTINGS`` to your own builder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("siltline")
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
