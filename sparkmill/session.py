"""Sessions, table access and durable cuts of lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_LOCAL_WORK: str | None = None
_WRITTEN: dict[str, SparkSession] = {}


def session(app: str = "sparkmill", cores: str = "*", **conf: str) -> SparkSession:
    """A session with the settings every operator expects; on a cluster, pass the cluster's own settings through `conf`."""
    b = SparkSession.builder.appName(app)
    settings = {
        "spark.master": f"local[{cores}]",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only where that is unset and everything runs in this one
    process (a local master), it is a temporary folder; on a cluster an unset folder is an error, as each machine would write to its own disk."""
    global _LOCAL_WORK
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if _LOCAL_WORK is None:
        _LOCAL_WORK = tempfile.mkdtemp(prefix="sparkmill-")
    return f"file://{_LOCAL_WORK}"


def _forget(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is None:
        return
    try:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone; the folder's owner then clears it
        pass


@atexit.register
def _forget_all() -> None:
    for path in list(_WRITTEN):
        _forget(path)
    if _LOCAL_WORK:
        shutil.rmtree(_LOCAL_WORK, ignore_errors=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the program ends."""
    path = f"{shared_dir(spark)}/sparkmill/{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    return path


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table made by `cut` that no later plan reads."""
    _forget(getattr(df, "_cut_path", ""))


def mark_small(df: DataFrame, most: int = 500_000, weight: Column | None = None) -> DataFrame:
    """A written narrow table, marked for broadcast if it has few enough rows; else as it is, for a shuffled join. Where rows may be long, `weight` says how
    many short ones each stands for."""
    n = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if n <= most else df
