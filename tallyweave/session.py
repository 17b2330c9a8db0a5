"""Session settings the library is tuned for.  Callers may bring any session of their own."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Compressed files are larger in memory; the planner should not broadcast one by its file size.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # A few megabytes are work for all cores, in a scan as in a shuffle.
    "spark.sql.files.openCostInBytes": "256k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # A table clustered by the first of two keys stays in place in a join on both.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "tallyweave") -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster supplies its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
