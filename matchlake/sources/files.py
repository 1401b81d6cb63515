"""The few file-system calls tables need, through Hadoop's client (any file system)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def rename(spark: SparkSession, old: str, new: str) -> None:
    if not _fs(spark, old).rename(_path(spark, old), _path(spark, new)):
        raise OSError(f"could not rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def beginning_with(spark: SparkSession, path: str) -> list[str]:
    """Paths in the same folder whose names go on after this one's."""
    escaped = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)
    found = _fs(spark, path).globStatus(_path(spark, f"{escaped}*"))
    return [f"{path}{str(s.getPath().getName())[len(path.rsplit('/', 1)[-1]):]}" for s in found or []]


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes with the application, unless it is deleted before."""
    _fs(spark, path).mkdirs(_path(spark, path))
    _fs(spark, path).deleteOnExit(_path(spark, path))


def path_of_uri(spark: SparkSession, uri: str) -> str:
    """A plain path from the URL-encoded form Spark reports for files."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def inside(spark: SparkSession, folder: str, uri: str) -> str:
    """The name below a folder of a file Spark reports by its URL-encoded form."""
    jvm, fs = spark._jvm, _fs(spark, folder)
    found = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toUri().getPath()
    root = fs.makeQualified(_path(spark, folder)).toUri().getPath().rstrip("/")
    if not found.startswith(f"{root}/"):
        raise ValueError(f"{uri} is not below {folder}")
    return found[len(root) + 1 :]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder of the files that readers see."""
    if not exists(spark, path):
        return []
    root = _fs(spark, path).makeQualified(_path(spark, path)).toUri().getPath().rstrip("/")
    found, out = _fs(spark, path).listFiles(_path(spark, path), True), []
    while found.hasNext():
        name = found.next().getPath().toUri().getPath()[len(root) + 1 :]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            out.append(name)
    return out


def make_parents(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path).getParent())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    out = _fs(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file such that ``read_whole`` finds the old or the new text."""
    write_text(spark, f"{path}.new", text)
    if exists(spark, path):
        delete(spark, path)
    rename(spark, f"{path}.new", path)


def read_whole(spark: SparkSession, path: str) -> str | None:
    # Without the file, what was to take its place is complete.
    return read_text(spark, path if exists(spark, path) else f"{path}.new")


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    fs = _fs(spark, path)
    size = fs.getFileStatus(_path(spark, path)).getLen()
    stream = fs.open(_path(spark, path))
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8")
    finally:
        stream.close()


def has_data_file(spark: SparkSession, path: str) -> bool:
    """True at the first visible file; the listing is not gone through to its end."""
    if not exists(spark, path):
        return False
    root = _path(spark, path).toUri().getPath()
    files = _fs(spark, path).listFiles(_path(spark, path), True)
    while files.hasNext():
        inside = files.next().getPath().toUri().getPath()[len(root) :].strip("/")
        if not any(part.startswith(("_", ".")) for part in inside.split("/")):
            return True
    return False
