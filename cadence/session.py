"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_spark(master: str | None = None, app: str = "cadence", shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session: AQE on, UI off, UTC, Arrow on.  On a cluster, pass nothing and
    let the cluster's defaults (master, checkpoint dir, partitions) stand."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The Python state channel of transformWithState: unix socket, no TCP port.
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session (the cluster names it).  Only when it is unset, as in
    local tests, a fresh temporary folder is created and registered; on a cluster, where
    executors cannot see the driver's folders, an unset name is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system that Spark itself would use for ``path``, and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    path = os.path.join(checkpoint_root(spark), f"cadence-{label}-{uuid.uuid4().hex[:12]}")
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)
    return path


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)


def move_folder(spark: SparkSession, source: str | None, target: str) -> bool:
    """Rename ``source`` to ``target`` unless ``target`` is there; whether it was there already.
    Without a source it only looks."""
    fs, to = _file_system(spark, target)
    if fs.exists(to):
        return True
    if source is not None:
        fs.mkdirs(to.getParent())
        if not fs.rename(_file_system(spark, source)[1], to):
            raise OSError(f"cannot rename {source} to {target}")
    return False


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (needed by the stateful
    processors, whose objects are unpickled there).  Zips the package once per
    SparkContext and adds it with ``addPyFile``, Spark's own way of shipping code, and
    puts it on the workers' PYTHONPATH for the driver-side initialization runner."""
    sc = spark.sparkContext
    if getattr(sc, "_cadence_shipped", False):
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    folder = os.path.join(root, f"cadence-pyfiles-{uuid.uuid4().hex[:12]}") if "://" not in root else tempfile.mkdtemp()
    os.makedirs(folder, exist_ok=True)
    zpath = os.path.join(folder, "cadence.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    # The driver-side runner that initializes a stateful Python processor does not
    # read addPyFile includes, only the PYTHONPATH of the function's environment.
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc.environment["PYTHONPATH"] = os.pathsep.join([zpath, *paths])
    sc._cadence_shipped = True


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text record to whatever file system ``path`` lies on (written aside,
    then renamed, so a reader never sees half of it)."""
    fs, p = _file_system(spark, path)
    _, aside = _file_system(spark, f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    """The record at ``path``, or None if there is none; other failures are raised."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
