"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every flowlens job relies on. AQE re-plans shuffles at runtime
# (coalescing small partitions, splitting skewed ones); UTC keeps any
# TIMESTAMP <-> text conversion stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "flowlens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the flowlens defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_ROOTS: dict[str, str] = {}


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (HDFS/S3/...) and is only
    read here. When it is unset (local tests), the SparkContext's checkpoint
    directory is used if one was registered; otherwise a temporary folder is
    created and registered with ``setCheckpointDir`` (the config itself
    cannot be changed at runtime), so ``DataFrame.checkpoint()`` and our
    written tables share one root.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    key = sc.applicationId
    if key not in _ROOTS:
        existing = sc.getCheckpointDir()
        if existing:
            _ROOTS[key] = existing.rstrip("/")
        elif not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        elif sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir: executors do not share the driver's temporary folder")
        else:
            tmp = tempfile.mkdtemp(prefix="flowlens-ckpt-")
            sc.setCheckpointDir(tmp)
            _ROOTS[key] = tmp
    return _ROOTS[key]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = _checkpoint_root(spark)
    path = f"{root}/flowlens/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flowlens`` importable in Python workers (data sources, pandas
    functions): zip the package once per SparkContext and ``addPyFile`` it,
    which distributes it to every executor. The zip is staged under the
    shared checkpoint root."""
    import io
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    root = _checkpoint_root(spark)
    local_root = root.replace("file:", "", 1) if root.startswith("file:") or "://" not in root else None
    if local_root is not None:
        os.makedirs(local_root, exist_ok=True)
        target = os.path.join(local_root, f"flowlens-{key}-{uuid.uuid4().hex[:8]}.zip")
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
    else:
        import pyarrow.fs as pafs
        fs, p = pafs.FileSystem.from_uri(root)
        target = f"{root}/flowlens-{key}-{uuid.uuid4().hex[:8]}.zip"
        with fs.open_output_stream(f"{p}/{os.path.basename(target)}") as out:
            out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)


def clean_work(spark: SparkSession, older_than_hours: float = 24.0, tables: bool = False) -> list[str]:
    """Delete flowlens work folders under the shared checkpoint root that are
    older than ``older_than_hours`` (per-run outputs: stream sinks and
    checkpoints, rewritten cell tables, packet tables). With ``tables=True``
    also delete derived tables (packet tables, stream records, flow datasets)
    of the same age except the newest one of each name. Returns the deleted
    paths. Uses the Hadoop FileSystem API, so it works on any shared store."""
    import time
    root = _checkpoint_root(spark) + "/flowlens"
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    cutoff = (time.time() - older_than_hours * 3600) * 1000
    deleted = []
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if name == "tables" or not st.isDirectory():
            continue
        if st.getModificationTime() < cutoff and fs.delete(st.getPath(), True):
            deleted.append(st.getPath().toString())
    tdir = jvm.org.apache.hadoop.fs.Path(root + "/tables")
    if tables and fs.exists(tdir):
        newest: dict[str, int] = {}
        entries = [(st.getPath(), st.getModificationTime()) for st in fs.listStatus(tdir)]
        for p, mt in entries:
            stem = p.getName().rsplit("-", 1)[0]
            newest[stem] = max(newest.get(stem, 0), mt)
        for p, mt in entries:
            stem = p.getName().rsplit("-", 1)[0]
            if mt < cutoff and mt < newest[stem] and fs.delete(p, True):
                deleted.append(p.toString())
    return deleted
