"""Local sessions for tests and bench, and the shared folder for written tables."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_own_folders: dict[str, str] = {}
_made: set[str] = set()


def local_session(
    cpus: int | str = "*", app_name: str = "tidemark", options: dict[str, str] | None = None
) -> SparkSession:
    """Session for one machine. On a cluster use the session spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return builder.config(map=options or {}).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors all reach, named by spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _own_folders[context.applicationId]


def _application_folder(spark: SparkSession) -> str:
    """Folder below the shared one for this application; gone when its driver ends."""
    context = spark.sparkContext
    path = f"{shared_folder(spark)}/tidemark/{context.applicationId}"
    if path not in _made:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(place)
        system.deleteOnExit(place)
        _made.add(path)
    return path


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder no other run uses; Spark creates it when it writes.

    It lasts as long as the application: what is to stay belongs elsewhere.
    """
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named, if it is there."""
    if not path.startswith(_application_folder(spark) + "/"):
        raise ValueError(f"not a folder of this application: {path}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(place, True)


def remove_files(spark: SparkSession, path: str, ending: str) -> None:
    """Delete the files with that ending right below a folder that ``new_folder`` named or holds."""
    if not path.startswith(_application_folder(spark) + "/"):
        raise ValueError(f"not a folder of this application: {path}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*{ending}")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(place) or []:
        system.delete(status.getPath(), False)
