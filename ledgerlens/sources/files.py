"""Small text files and folder listings through the session's own file systems, so the same
code works on local paths and object stores."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target and rename over it, so readers see the old file or the new one."""
    fs, target = _fs(spark, path)
    _, fresh = _fs(spark, f"{path}.new")
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    # FileContext replaces the target in one step where the file system can
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(fresh), context.makeQualified(target), overwrite)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, None when it is absent."""
    if not exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none when it is absent."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def trim_batches(spark: SparkSession, root: str, batch_id: int, keep: int = 2) -> None:
    """Drop the folders of batches before the last `keep`, which a restart can no longer ask for."""
    for name in list_names(spark, root):
        number = name.removeprefix("batch=")
        if number != name and number.isdigit() and int(number) <= batch_id - keep:
            remove_folder(spark, f"{root}/{name}")


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty folder; False when somebody else has created it."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return False
    marker = spark._jvm.org.apache.hadoop.fs.Path(target, "_claimed")
    try:
        fs.create(marker, False).close()  # creation without overwriting succeeds once
    except Exception:  # noqa: BLE001  the file system's own exception arrives wrapped
        return False
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
