"""Session settings the operators rely on."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings; each is safe to set on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange: a
    # customer or account holding a third of the rows must not become one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compressed columnar files unpack to several times their size; without this the
    # planner takes a file just below the broadcast threshold for a small table.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # Columnar rows unpack to ten times their size in a shuffle or a hash table: with a
    # quarter of the default a task's share of memory holds them and nothing is spilled.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Skip the sort of a shuffle join when every build partition, as measured after
    # the shuffle, is small; larger ones stay sort-merge joins.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


# Fixed at start-up, so only sessions built here have them.
STATIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # The report plans compile more than the default hundred stages.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(app_name: str = "ledgermill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the runtime settings applied; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the session's owner has left open."""
    chosen = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Where none is named, a session on one machine gets a temporary folder, remembered
    on the session; on a cluster that is an error, since no executor would see the files
    of another.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgermill-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one written intermediate."""
    return f"{shared_dir(spark).rstrip('/')}/ledgermill/{uuid.uuid4().hex}/{name}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whatever store it is in."""
    files, at = file_system(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, in place of one that is there."""
    files, at = file_system(spark, path)
    stream = files.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of name, length and time of change of every file at or below a path; empty where there is none.

    A store may give folders no time of change, and a part that is rewritten at equal
    length changes neither their length nor, where it is replaced in place, their time.
    """
    files, at = file_system(spark, path)
    if not files.exists(at):
        return ""
    found, listing = [], files.listFiles(at, True)
    while listing.hasNext():
        f = listing.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more."""
    files, at = file_system(spark, path)
    files.delete(at, True)
