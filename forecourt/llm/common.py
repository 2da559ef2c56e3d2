"""What the operators share: written intermediate tables, free column names, row keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import tune

_own: list[str] = []


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive settings, and the package on the executors, as ``--py-files`` would put it there."""
    context = spark.sparkContext
    if "forecourt.zip" not in context._python_includes:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="forecourt-")) / "forecourt.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see, from ``spark.checkpoint.dir``; a temporary one where that is unset and Spark runs
    on this machine only (tests). Other machines wouldn't see that, so without the setting a cluster is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='forecourt-')}")
    return _own[0]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in the shared folder. It cuts the lineage: a lost
    executor costs the tasks that read it, not the work before it."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the table doesn't have yet, whatever columns it brings along."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def fingerprint(text: str | Column) -> Column:
    """128 bits that stand for a text; null for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.isNotNull(), F.unhex(F.md5(c.cast("binary"))))


def bucket(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
