"""Zip archives as a Spark source: one partition a member, streamed line by line, and a sink that packs rows into members.

``spark.read.format("archive").load(path)`` after ``register(spark)``. Paths are opened by the Python workers, so they must
be reachable from every machine: a shared mount, or a store that Arrow's file systems know.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import posixpath
import zipfile
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vitalgrid.sources import sniff

LINES = "archive string, member string, line_no long, line string, error string"
#: What a damaged archive or member raises.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError)


def file_system(path: str):
    """Arrow file system and the path in it; plain paths are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Member(InputPartition):
    """A member of an archive, or an archive that cannot be read."""

    archive: str
    member: str | None
    error: str | None = None


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.pattern = options["path"], options.get("pattern", "*")

    def partitions(self):
        """Only the table of contents at the end of each archive is read here."""
        from pyarrow import fs

        store, base = file_system(self.path)
        found = store.get_file_info(fs.FileSelector(base, recursive=True)) if store.get_file_info(base).type == fs.FileType.Directory else [store.get_file_info(base)]
        out = []
        for info in sorted(found, key=lambda i: i.path):
            if info.type != fs.FileType.File or not info.path.endswith(".zip"):
                continue
            try:
                with store.open_input_file(info.path) as f, zipfile.ZipFile(f) as z:
                    out += [Member(info.path, m.filename) for m in z.infolist() if not m.is_dir() and fnmatch.fnmatch(m.filename, self.pattern)]
            except BROKEN as error:
                out.append(Member(info.path, None, str(error)))
        return out or [Member("", None)]

    def read(self, partition):
        """The member's lines; a damaged one gives the lines before the damage and a row that tells of it."""
        if partition.member is None:
            if partition.error:
                yield partition.archive, None, None, None, partition.error
            return
        store, _ = file_system(self.path)
        number = 0
        try:
            with store.open_input_file(partition.archive) as f, zipfile.ZipFile(f) as z, z.open(partition.member) as m:
                for number, line in enumerate(io.TextIOWrapper(m, "utf-8", errors="replace", newline=None), 1):
                    yield partition.archive, partition.member, number - 1, line.rstrip("\n"), None
        except BROKEN as error:
            yield partition.archive, partition.member, None, None, str(error) or type(error).__name__


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return "archive"

    def schema(self):
        return LINES

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """archive, member, line_no, line, error of all members below a path whose name matches."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive").option("pattern", pattern).load(path)


def header_names(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header]), [])]


def read_series(lines: DataFrame, metric_of) -> DataFrame | None:
    """Long series of all CSV members, each read by its own header; ``metric_of`` makes a metric from the member's name.

    As with plain files, members without a metric are left out; rows of damaged members up to the damage are kept.
    """
    good = lines.where(F.col("line").isNotNull())
    heads = good.where("line_no = 0").select("archive", "member", F.col("line").alias("header"))
    out = None
    for (header,) in heads.select("header").distinct().orderBy("header").collect():
        names = header_names(header)
        schema = ", ".join(f"`{n}` string" for n in names)
        rows = good.where("line_no > 0").join(heads.where(F.col("header") == header), ["archive", "member"])
        named = rows.select(F.from_csv("line", schema).alias("r"), metric_of(F.col("member")).alias("metric")).select("r.*", "metric")
        long = sniff.extract_series(named, keep=("metric",)).where(F.col("metric").isNotNull())
        out = long if out is None else out.unionByName(long)
    return out


def write_archive(df: DataFrame, path: str, member: str, rows_of_member: int = 100_000) -> DataFrame:
    """Pack each partition's rows as CSV members of an archive of its own; returns the archives written, so run it.

    Names follow the partition: a task that runs again writes the same archive.
    """
    names = df.columns

    def pack(batches):
        import pandas as pd
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId(), io.BytesIO()
        written = 0
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for part, pdf in enumerate(batches):
                for lo in range(0, len(pdf), rows_of_member):
                    z.writestr(f"{member}/{part:05d}-{lo}.csv", pdf[names].iloc[lo : lo + rows_of_member].to_csv(index=False))
                    written += 1
        if written:
            store, base = file_system(path)
            store.create_dir(base, recursive=True)
            with store.open_output_stream(posixpath.join(base, f"{member}-{number:05d}.zip")) as f:
                f.write(held.getvalue())
            yield pd.DataFrame({"archive": [f"{member}-{number:05d}.zip"], "members": [written]})

    return df.mapInPandas(pack, "archive string, members long")
