"""Folders and small files of whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """File system, context (for a rename that replaces) and path."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place, conf


def exists(spark: SparkSession, path: str) -> bool:
    system, place, _ = _at(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place, _ = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def count_files(spark: SparkSession, path: str) -> int:
    """Files below a folder."""
    system, place, _ = _at(spark, path)
    return system.getContentSummary(place).getFileCount() if system.exists(place) else 0


def make(spark: SparkSession, path: str) -> None:
    """Create a folder, if it is not there."""
    system, place, _ = _at(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing if it is not there."""
    system, place, _ = _at(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder; one of that name at the target is replaced."""
    system, place, conf = _at(spark, source)
    _, goal, _ = _at(spark, target)
    system.mkdirs(goal.getParent())
    if system.exists(goal) and system.getFileStatus(goal).isDirectory():
        system.delete(goal, True)  # only a file can be replaced by a rename
    jvm = spark._jvm
    replace = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = replace
    qualified = system.makeQualified(place)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(
        qualified, system.makeQualified(goal), options
    )


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files at a path (a file, or a folder and those below); none if it is not there."""
    system, place, _ = _at(spark, path)
    if not system.exists(place):
        return []
    found, rest = [], system.listFiles(place, True)
    while rest.hasNext():
        status = rest.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append(status.getPath().toString())
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, unpacked if its name says that it is packed."""
    system, place, conf = _at(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = system.open(place)
    try:
        text = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is not there."""
    system, place, _ = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name, then move it into place: readers see all or nothing."""
    system, place, _ = _at(spark, path + ".new")
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, path + ".new", path)


def stamp(spark: SparkSession, path: str) -> str | None:
    """Length and time of change of a file; another one under its name has another stamp."""
    system, place, _ = _at(spark, path)
    if not system.exists(place):
        return None
    status = system.getFileStatus(place)
    return f"{status.getLen()}-{status.getModificationTime()}"
