"""Session settings the engine relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics: dates and DATETIME carry no zone in the source dialect -> UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Execution: AQE re-plans joins from runtime sizes (broadcast when the measured side is
# small, split skewed partitions), coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the cluster's session and
    call ``configure(spark)``."""
    b = SparkSession.builder.master(master).appName("ordermart")
    conf = {**DEFAULT_CONF, **REQUIRED_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "16g", **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on; keep whatever the cluster already set for the rest."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def hash_small_partitions(spark: SparkSession) -> None:
    """Let adaptive execution join by hash, without sorting either side, where the measured partitions of one side are no
    larger than the size it makes partitions of.  Larger ones are sorted as before; a cluster's own setting stays."""
    limit = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(limit, "0b") in ("0", "0b"):
        spark.conf.set(limit, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))


def apply_defaults(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """``configure``, and the execution settings that the cluster's session leaves at Spark's defaults."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and spark.sparkContext.getConf().get(k) is None:
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(spark)


_private: dict[str, str] = {}  # application id -> folder of a local session that has none
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    Only a local master (tests, the bench) may do without: it gets one private folder per
    application.  On a cluster a missing setting is an error, because a machine-local folder
    would silently lose rows."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _private:
        _private[sc.applicationId] = tempfile.mkdtemp(prefix="ordermart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _private[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``drop_scratch`` (or the end of the program) deletes it."""
    path = f"{shared_dir(spark)}/ordermart-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut_lineage(df, name: str = "rows", partition_by: str | None = None, **options):
    """Materialise ``df`` as a Parquet table in the shared folder and read it back.

    Later branches then read the written rows instead of re-running the joins above, and a
    lost executor costs a re-read, not a recomputation of the upstream plan.  Parquet (not
    an RDD checkpoint) because most readers need a few of the columns: they get column
    pruning and compressed input.  ``partition_by``, the last column, puts its values into folders of their own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.options(**options).partitionBy(partition_by) if partition_by else df.write.options(**options)).parquet(path)
    # nothing reads the shuffles above any more; Spark deletes their files once the driver has collected its garbage
    spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def keeping(made: list, cut=cut_lineage):
    """``cut``, with every table that it writes put into ``made``, for ``drop_cut``."""
    def kept(df, *args, **options):
        made.append(cut(df, *args, **options))
        return made[-1]
    return kept


def drop_cut(*tables) -> None:
    """Delete tables made by ``cut_lineage`` as soon as nothing reads them any more: once the table made
    from them stands, they only hold disk."""
    for df in tables:
        path = df._scratch_path
        for entry in [e for e in _written if e[1] == path]:
            _delete(entry)


def _delete(entry: tuple[SparkSession, str]) -> None:
    owner, path = entry
    try:
        jvm, conf = owner._jvm, owner._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    except Exception:  # the session is gone: its folder is the cluster's to clean
        pass
    _written.remove(entry)


def drop_scratch(spark: SparkSession | None = None) -> None:
    """Delete the scratch tables written so far (of ``spark``, or of every session).  Call it once
    the results that read them are stored; it also runs when the program ends."""
    for entry in [e for e in _written if spark is None or e[0] is spark]:
        _delete(entry)


atexit.register(drop_scratch)
