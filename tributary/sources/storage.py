"""Files of a table folder through Spark's file systems (any store the cluster can reach).

Only names and small texts pass here; data is read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; any other trouble with the store is an error."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly under ``path`` (none if it isn't there), hidden ones left out."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False if the name is taken already."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{jvm.java.util.UUID.randomUUID()}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        where = fs.makeQualified(p)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(draft), where, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception:
        fs.delete(draft, False)
        if fs.exists(p):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def done(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write of ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")
