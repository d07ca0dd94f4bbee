"""Reading and writing the linkage tables: CSV and Parquet, with declared schemas."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CATALOGUE = "Supplier string, Brand string, NPC string, MPC string, `EAN/GTIN` string, `Base Description` string, `Secondary Description` string"
DEVICES = "index long, CLN_Manufacturer string, CLN_Manufacturer_Device_Name string, CLN_Device_Serial_Number string"
MISSING = "Supplier_missing string"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder that driver and executors share and read back, which cuts lineage.

    Without ``spark.checkpoint.dir`` a temporary folder serves where both are one process; a cluster must name it.
    """
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_fernlink_written", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = spark._fernlink_written = tempfile.mkdtemp(prefix="fernlink-")
    path = f"{where.rstrip('/')}/linkage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, columns: str, order: str | None = None) -> DataFrame:
    """Columns by name from CSV with a header, as strings cast to the declared types.

    ``order`` adds the row order of the input: files by name, and the lines of each in their order.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    wanted = spark.createDataFrame([], columns).schema
    missing = [f.name for f in wanted if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: missing columns: {', '.join(missing)}")
    out = raw
    if order:
        # a file with quoted line breaks is read by one task, so the numbers grow along a file
        out = raw.withColumns({"__file": F.input_file_name(), "__line": F.monotonically_increasing_id()})
        starts = out.groupBy("__file").agg(F.min("__line").alias("__first"), F.count("*").alias("__n"))
        before = F.coalesce(F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a file
        out = out.join(starts.withColumn("__before", before).drop("__n"), "__file").withColumn(order, F.col("__before") + F.col("__line") - F.col("__first"))
    picked = (F.col(f"`{f.name}`").try_cast("double").cast(f.dataType).alias(f.name) if f.dataType.simpleString() == "bigint" else F.col(f"`{f.name}`").alias(f.name) for f in wanted)
    return out.select(*picked, *([order] if order else []))


def timestamped(folder: str, name: str, now: datetime | None = None) -> str:
    """Path of a result that sorts by its time: folder/nameYYYYMMDD_HHMMSS."""
    return f"{folder.rstrip('/')}/{name}{(now or datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def latest(spark: SparkSession, folder: str, prefix: str = "") -> str:
    """Path of the last entry of a folder by name, in any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    names = [e.getPath().getName() for e in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    found = [n for n in names if n.startswith(prefix) and not n.startswith((".", "_"))]
    if not found:
        raise FileNotFoundError(f"{folder}: nothing begins with {prefix!r}")
    return f"{folder.rstrip('/')}/{max(found)}"


def read_excel(spark: SparkSession, path: str, columns: str, order: str | None = None) -> DataFrame:
    """Columns by name from the first sheet of a workbook, read on the driver: a sheet holds about a million rows at most.

    Needs a reader of workbooks for pandas; without one, save the sheet as CSV and use ``read_csv``.
    """
    try:
        import openpyxl  # noqa: F401
        import pandas as pd
    except ImportError as e:
        raise ImportError("reading workbooks needs openpyxl; save the sheet as CSV instead") from e
    sheet = pd.read_excel(path, dtype=str)
    wanted = spark.createDataFrame([], columns).schema
    missing = [f.name for f in wanted if f.name not in sheet.columns]
    if missing:
        raise ValueError(f"{path}: missing columns: {', '.join(missing)}")
    names = [f.name for f in wanted]
    rows = [(*(None if pd.isna(v) else v for v in r), i) for i, r in enumerate(sheet[names].itertuples(index=False, name=None))]
    out = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names) + ", __order long")
    cast = [F.col(f"`{f.name}`").try_cast("double").cast(f.dataType).alias(f.name) if f.dataType.simpleString() == "bigint" else F.col(f"`{f.name}`") for f in wanted]
    return out.select(*cast, *([F.col("__order").alias(order)] if order else []))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    writer = rows.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def label_of(c: str):
    """A label that may have been written as a decimal number."""
    return F.col(c).try_cast("double").cast("long")
