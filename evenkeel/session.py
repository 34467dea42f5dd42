"""Session settings the library relies on."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Stored bytes per shuffle partition, and the number beyond which more partitions cost more than they help.
SHUFFLE_BYTES = 256 << 20
MOST_PARTITIONS = 1 << 16
BATCH_ROWS = 1000
# Up to so many estimated bytes a side is broadcast where sides grow with the input: estimates are of compressed files.
BROADCAST_BYTES = 256 << 10


def build_session(master: str | None = None, name: str = "evenkeel", **conf: str) -> SparkSession:
    """A session with adaptive execution; partition counts are left to the cluster's configuration."""
    builder = (SparkSession.builder.appName(name)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # Python sees whole pages and files: a thousand of them are a batch of tolerable size.
               .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a table scan with fewer splits than the session has cores.

    One small file is one task, however heavy the regexes above it. A large input has more splits than
    cores and is returned as it is, so nothing large is ever shuffled here. For plain scans only: asking
    a plan with joins for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` on the same cluster, whose settings are its own from now on."""
    session = spark.newSession()
    for name, value in dict(spark.conf.getAll).items():
        if session.conf.isModifiable(name) and session.conf.get(name, None) != value:
            session.conf.set(name, value)
    return session


@contextmanager
def sized_shuffles(spark: SparkSession, stored_bytes: int) -> Iterator[int]:
    """Shuffle partitions in proportion to the input, never fewer than configured.

    Adaptive execution merges partitions that turn out small but does not split large ones, so the
    number to start from has to grow with the data.
    """
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    wanted = min(-(-stored_bytes // SHUFFLE_BYTES), MOST_PARTITIONS)
    spark.conf.set(name, str(max(int(configured), wanted)))
    try:
        yield max(int(configured), wanted)
    finally:
        spark.conf.set(name, configured)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most so many rows for jobs that run inside, where a row is a whole text or set.

    The setting is read when a job starts: it holds for what is written inside, not for frames that are returned.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    configured = spark.conf.get(name)
    spark.conf.set(name, str(min(int(configured), rows) if int(configured) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, configured)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job that runs inside go when it ends, not when the driver next collects its garbage.

    For results that are written and read back. The setting is read when a job starts: it does not hold for frames that
    are returned.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    configured = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, configured)


@contextmanager
def small_broadcasts(spark: SparkSession, most: int = BROADCAST_BYTES) -> Iterator[None]:
    """Jobs that run inside broadcast a side of a join unasked only up to so many estimated bytes.

    A broadcast is built in the driver, several of a plan at a time, and takes many times its estimate there. The setting
    is read when a job starts: frames that are returned need a hint.
    """
    static, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {}
    for name, configured in ((static, spark.conf.get(static)), (adaptive, spark.conf.get(adaptive, None))):
        if configured and not configured.startswith("-") and (
                spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(configured) > most):
            before[name] = configured
            spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, configured in before.items():
            spark.conf.set(name, configured)
