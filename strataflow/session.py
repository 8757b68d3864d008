"""Session helpers: settings, shared folder, tuning knobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

HOT_ROWS_CONF = "spark.strataflow.hotGroupRows"
HOT_ROWS_DEFAULT = 1_000_000

# Folders of local runs that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}
# Part of the folder of intermediate tables that new ones go to.
_AREA: ContextVar[str] = ContextVar("area", default="common")


def build_session(
    app: str = "strataflow", cores: str = "*", partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """Session for tests and local runs; a cluster brings its own."""
    builder = SparkSession.builder
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def hot_rows(spark: SparkSession) -> int:
    """Groups with more rows than this are split over several tasks."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def shared_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a local run without one sets its own, once."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="strataflow-")
    return _LOCAL_DIRS[application]


def stage_dir(spark: SparkSession, area: str | None = None) -> str:
    """Folder of this application's intermediate tables, or of one area of it."""
    root = f"{shared_dir(spark).rstrip('/')}/stages-{spark.sparkContext.applicationId}"
    return root if area is None else f"{root}/{area}"


def stage(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Lineage ends here: a lost executor costs no recomputation, nondeterministic columns
    are fixed, and the optimizer knows the size and columns of the rows. ``group_rows`` is for rows that
    are large blocks: so many at most are held at once by the task that writes or reads them.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage_path(df, group_rows))


def stage_path(df: DataFrame, group_rows: int | None = None) -> str:
    """Write the rows to the shared folder; returns where they are."""
    path = f"{stage_dir(df.sparkSession, _AREA.get())}/{uuid.uuid4().hex}"
    # A reader holds a whole row group, of which Parquet checks the size only every 100 rows.
    options = {} if group_rows is None else {"parquet.block.row.count.limit": str(group_rows)}
    df.write.options(**options).parquet(path)
    return path


@contextmanager
def stage_area(area: str) -> Iterator[None]:
    """Intermediate tables made meanwhile go to an area that can be cleared by itself."""
    token = _AREA.set(area)
    try:
        yield
    finally:
        _AREA.reset(token)


def clear_stages(spark: SparkSession, area: str | None = None) -> None:
    """Remove intermediate tables, all or those of an area, once the results that rest on them are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_dir(spark, area))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Name of ``stage`` where only the cut matters."""
    return stage(df)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Few rows as a table whose size the optimizer knows, so that it can choose to broadcast it."""
    fields = T.StructType.fromDDL(schema)
    table = pa.Table.from_pylist([dict(zip(fields.names, r)) for r in rows], schema=to_arrow_schema(fields))
    return spark.createDataFrame(table, fields)
