"""Spark session defaults for the report jobs."""

from __future__ import annotations

import contextlib
import math
import os
import re
import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. AQE re-plans joins from runtime sizes (small
# sides become broadcasts, skewed partitions are split) and coalesces small
# shuffle partitions; the session time zone pins datetime semantics.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key also where later joins on it shared its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join on (file, status, account) may reuse a partitioning by file
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g")))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by the cluster in
    ``spark.checkpoint.dir``. Only a local master may leave it unset (tests,
    trial runs); then a fresh scratch folder is made and registered. On several
    machines a folder of one of them would give incomplete reads, so there
    the setting is required."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


# What one task may hold, so that its sorts and hash maps stay small whatever
# the size of the tables: bytes of the job's input files for each shuffle
# partition planned, shuffled bytes that AQE puts together again, and bytes of
# files in one scan task (groupings begin there, and on a nearly unique key
# their map holds a row for each row read).
INPUT_BYTES_PER_PARTITION = 8 << 20
SHUFFLED_BYTES_PER_PARTITION = 16 << 20
SCANNED_BYTES_PER_PARTITION = 16 << 20
_PARTITIONS, _ADVISORY = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SCANNED = "spark.sql.files.maxPartitionBytes"
_sized: dict = {"depth": 0, "saved": {}, "lock": threading.RLock()}


def _bytes(text: str) -> int:
    n, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(n) << 10 * " kmgt".index(unit or " ")


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads (0 for literal rows); no row is read."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def partitions_for(*dfs: DataFrame) -> int:
    """Shuffle partitions for a job that reads ``dfs``: the session's number, more where the input is large."""
    needed = math.ceil(sum(input_bytes(df) for df in dfs) / INPUT_BYTES_PER_PARTITION)
    return max(int(dfs[0].sparkSession.conf.get(_PARTITIONS)), needed)


@contextlib.contextmanager
def sized_shuffles(df: DataFrame):
    """While ``df`` is written: as many shuffle partitions as its input asks for,
    they and the scans' parts of a bounded size. A session whose own settings are finer keeps them; what
    was set before is back when the last of several writes at once has ended."""
    conf = df.sparkSession.conf
    n = partitions_for(df)
    with _sized["lock"]:
        if not _sized["depth"]:
            _sized["saved"] = {k: conf.get(k) for k in (_PARTITIONS, _ADVISORY, _SCANNED)}
        _sized["depth"] += 1
        conf.set(_PARTITIONS, str(max(n, int(conf.get(_PARTITIONS)))))
        for k, most in ((_ADVISORY, SHUFFLED_BYTES_PER_PARTITION), (_SCANNED, SCANNED_BYTES_PER_PARTITION)):
            conf.set(k, str(min(_bytes(conf.get(k)), most)))
    try:
        yield
    finally:
        with _sized["lock"]:
            _sized["depth"] -= 1
            if not _sized["depth"]:
                for k, v in _sized["saved"].items():
                    conf.set(k, v)
