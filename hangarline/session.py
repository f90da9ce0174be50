"""A local session. The plans rely on no setting of the session."""

from pyspark.sql import SparkSession

def local_session(cpus: int | str = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use spark-submit settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hangarline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
