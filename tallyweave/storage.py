"""Written tables that cut lineage between the steps of a multi-job operator.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``, so an executor
lost at any time costs a task retry and never the intermediate result.  Parquet rather than an RDD
checkpoint keeps column pruning and gives the planner true file sizes to choose joins by.
"""

import re
import tempfile
import uuid
import weakref
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_PATHS: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()
_WRITTEN: dict[str, list[str]] = {}  # paths of the tables of each application, in order


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for an unset local session."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        named = context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    # Only a session whose executors are this process may use a folder of this machine.
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tallyweave-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tallyweave/{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once into a parquet table of the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def kept(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``df`` itself where :func:`written` gave it, else its columns written: a table that is cheap to count."""
    return df if df in _PATHS else written(df.select(*columns), label)


def tables_written(spark: SparkSession) -> list[str]:
    """Paths of the intermediate tables of this application so far, oldest first."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def delete_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        _delete(spark, path)


def forget(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` gave, once nothing reads them any more."""
    for table in tables:
        _delete(table.sparkSession, _PATHS[table])


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result of it is needed any more."""
    _delete(spark, f"{shared_folder(spark)}/tallyweave/{spark.sparkContext.applicationId}")
    _WRITTEN.pop(spark.sparkContext.applicationId, None)
