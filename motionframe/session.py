"""What a job needs from its session: the shared folder, cut lineage, and this package on the executors."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("motionframe")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once for each application, and keep Arrow batches of texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = Path(tempfile.mkdtemp(prefix="motionframe-")) / "motionframe_src.zip"
    path.write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on one machine, a temporary one where that is unset."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("motionframe.local.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("motionframe.local.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it again, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
