"""Folders and first lines of files, read in tasks.

The driver sees neither the list of files nor their contents. File systems are those that Arrow can
open from an executor; for others ``can_open`` is false, and Spark's own readers are used instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work_folder import work_folder

# Schemes of addresses that Arrow opens, and how it writes them.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}
_FIRST = 64 << 10  # bytes read at a time in search of the end of a line
#: Folders that a task lists at once, about.
FOLDERS = 16


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system, as Spark's file sources write it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _scheme(path: str) -> str:
    head, sep, _ = path.partition(":/")
    return head.lower() if sep else ""


def can_open(path: str | None) -> bool:
    """If tasks can open a qualified path: a known scheme, and no pattern."""
    return path is not None and _scheme(path) in _SCHEMES and not any(c in path for c in "*?[{")


def _opened(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    scheme = _scheme(path)
    if _SCHEMES[scheme] == "file":
        return fs.LocalFileSystem(), "/" + path[len(scheme) + 1 :].lstrip("/")
    return fs.FileSystem.from_uri(_SCHEMES[scheme] + path[len(scheme) :])


def _entries(folders: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What lies in each folder, but for hidden names."""
    from pyarrow import fs

    for part in folders:
        rows = []
        for folder in part["path"]:
            system, inner = _opened(folder)
            for found in system.get_file_info(fs.FileSelector(inner)):
                if not found.base_name.startswith(("_", ".")):
                    is_folder = found.type == fs.FileType.Directory
                    rows.append((folder.rstrip("/") + "/" + found.base_name, is_folder, None if is_folder else found.mtime))
        yield pd.DataFrame(
            {
                "path": pd.Series([r[0] for r in rows], dtype=str),
                "is_folder": pd.Series([r[1] for r in rows], dtype=bool),
                "modified": pd.Series(pd.to_datetime([r[2] for r in rows], utc=True)),
            }
        )


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified) of all files below a folder, as a written table.

    The folders of one depth are listed by as many tasks as there are some of them, and those they
    hold are listed next; one row of counts for each depth comes to the driver.
    """
    work = work_folder(spark, "files")
    folders = spark.createDataFrame([(folder.rstrip("/"),)], "path string")
    count, depth = 1, 0
    while count:
        path = f"{work}/depth={depth}"
        dealt = folders.repartition(max(1, -(-count // FOLDERS)))
        dealt.mapInPandas(_entries, "path string, is_folder boolean, modified timestamp").write.parquet(path)
        folders = spark.read.parquet(path).where("is_folder").select("path")
        count, depth = folders.count(), depth + 1
    return spark.read.parquet(work).where("not is_folder").select("path", "modified")


def _lines(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in files:
        found = []
        for path in part["path"]:
            system, inner = _opened(path)
            line, more = b"", b" "
            with system.open_input_stream(inner) as stream:
                while more and b"\n" not in line:
                    more = stream.read(_FIRST)
                    line += more
            found.append(line.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace"))
        yield pd.DataFrame({"path": part["path"], "line": pd.Series(found, dtype=str)})


def first_lines(files: DataFrame) -> DataFrame:
    """(path, line) of files; what follows the first line is not read, but for the rest of a block."""
    return files.select("path").mapInPandas(_lines, "path string, line string")
