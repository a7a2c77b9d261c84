"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: set[str] = set()
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VECTORED = "parquet.hadoop.vectored.io.enabled"
#: Reading columns as streams, and pages that end where they are long enough, looked at every few rows.
SMALL_BUFFERS = {VECTORED: "false", "parquet.page.size.check.estimate": "false", "parquet.page.size.row.check.min": "20"}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings only, so it can be applied to a session somebody else made."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # merge the sessions of a busy key before they are shuffled
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


def small_buffers(spark: SparkSession) -> None:
    """Keep what Parquet holds outside the heap small, unless the session says otherwise.

    A vectored read asks for the whole range of a column at once; of a local file, each thread that ever read one then keeps a
    buffer of that length. The codecs keep buffers as long as the longest page, and the writer guesses from the rows so far when to look
    at a page's length again: where rows stand by size, pages become many times as long as they should be.
    """
    for key, value in SMALL_BUFFERS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("meterline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder for cut lineage and replays: ``spark.checkpoint.dir``, else one below the warehouse folder.

    Both are folders that every executor reaches. What this session writes goes to one folder in it, which is
    removed when the driver's JVM ends.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    top = named or context.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/meterline-shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(top)
    own = f"{top.rstrip('/')}/meterline-{context.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        path = context._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return own


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from that table.

    Used where a reduced input is read more than once: the work before it runs once, later
    reads prune columns, and a lost executor costs nothing but a re-read.
    """
    path = fresh_dir(df.sparkSession, label)
    small_buffers(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
