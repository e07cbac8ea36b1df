"""Session helpers: sessions for tests and benches, the shared folder, table cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Folders that were made because a session had none, by application id.
_OWN: dict[str, str] = {}
#: Paths given out, by application id.
_WRITTEN: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cinderspan")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A session on one machine (a local master) that has none gets a new folder. Anywhere else a folder of
    one machine would lose rows, so a missing setting is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _OWN[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; ``remove_written`` removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_written(spark: SparkSession) -> int:
    """Remove what this application has written to the shared folder, once no DataFrame over it is needed."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        system, root = fs.FileSystem.from_uri(path)
        kind = system.get_file_info(root).type
        if kind == fs.FileType.Directory:
            system.delete_dir(root)
        elif kind == fs.FileType.File:
            system.delete_file(root)
    return len(paths)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    This ends the lineage: later jobs read files that outlive any executor.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_cinderspan_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))) / "cinderspan.zip"
    with zipfile.ZipFile(to, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(to))
    context._cinderspan_shipped = True
