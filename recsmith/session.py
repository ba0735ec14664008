"""Session helpers.

On a cluster the session is created by the launcher; these helpers only fill
in what is unset.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only invents a local folder when nothing is configured (tests).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


STAGE_TABLE = "recsmith_stage_"
_SCOPES: list[str] = []  # names of the open scopes of stage tables, outermost first


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "recsmith", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RECSMITH_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent (local tests) a scratch folder is made and
    registered, so ``DataFrame.checkpoint()`` and ``materialise`` work the same way.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="recsmith-ckpt-", dir="/tmp")
    if sc is not None:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _table_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{app_id(spark)}"


def remove_stage_tables(spark: SparkSession) -> None:
    """Delete the stage tables that this application wrote (call it when its results are written)."""
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith(STAGE_TABLE)]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fs, path = file_system(spark, _table_root(spark))
    fs.delete(path, True)


@contextlib.contextmanager
def stage_scope(spark: SparkSession):
    """Stage tables written inside are deleted at the end: for a step whose result has been written
    (outside the scope) by then."""
    name = uuid.uuid4().hex
    _SCOPES.append(name)
    root = "/".join([_table_root(spark), *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.remove(name)
        fs, path = file_system(spark, root)
        fs.delete(path, True)


class LazyInputs:
    """Base of a job's input tables: one may be given as a function that makes it, which is called when the
    table is first read.  So a query that stops at an early stage derives only the tables of that stage."""

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        if name in type(self).__dataclass_fields__ and callable(value):
            value = value()
            object.__setattr__(self, name, value)
        return value


class Stages:
    """The named stages of a job, each made when it is first asked for (so a query that stops at an
    early stage writes none of the later tables) and made once.  A maker takes the stages."""

    def __init__(self, **makers):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str):
        if name not in self._made:
            self._made[name] = self._makers[name](self)
        return self._made[name]


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (stage tables and caches are scoped by it)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a table written by ``materialise``: as many as shuffle partitions, within the limit of buckets."""
    return min(int(spark.conf.get(f"spark.sql.{c}")) for c in ("shuffle.partitions", "sources.bucketing.maxBuckets"))


def materialise(df, by: str | None = None, outer: bool = False, placed: bool = False):
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint folder
    (``spark.checkpoint.dir``) and reading it back; never a local checkpoint.

    The plan restarts from the written table, so a stage referenced several times
    downstream is computed once and a lost executor re-reads files instead of
    recomputing.  Parquet keeps scans columnar and pruned and gives the planner real
    sizes (small tables are then broadcast by the size threshold).  Tables of one run sit
    under ``tables/<application id>/`` so the run's scratch can be removed as a whole.

    ``by`` names a column that the table is bucketed by (one file per bucket, as many buckets as
    shuffle partitions, within ``spark.sql.sources.bucketing.maxBuckets``; ``placed``: the rows lie by that
    column already, so they are written where they are): later joins, aggregates and windows on it plan no exchange.  Only for
    tables whose rows per value are bounded.  ``outer``: the table belongs to the scope around
    the innermost one (see ``stage_scope``)."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    path = "/".join([_table_root(spark), *(_SCOPES[:-1] if outer else _SCOPES), name])
    if by is not None:
        n = bucket_count(spark)
        table = STAGE_TABLE + name
        ((df if placed else df.repartition(n, by)).write.bucketBy(n, by).format("parquet").option("path", path).saveAsTable(table))
        return spark.table(table)
    if os.environ.get("RECSMITH_TIMING"):
        import time
        t0 = time.time()
        df.write.parquet(path)
        print(f"[materialise] {time.time() - t0:.2f}s", flush=True)
    else:
        df.write.parquet(path)
    return spark.read.parquet(path)
