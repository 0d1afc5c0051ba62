"""Bulk load by a stored ledger of files.

The ledger has a line per loaded file: path, length, time stamp, number of rows, and a digest
of its rows' text. A load lists one folder after another, joins the listing with the
folder's part of the ledger, and reads the files that have no line. A file with another length or
time stamp than its line is read to compare digests: if its content changed under its name it
is reported, and not loaded. A load writes folders of its own, and its rows are visible once the
ledger has its lines, so a load that fails leaves nothing behind.

The driver holds the listing of one folder at a time, and the names of the loads, never all files ever.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.session import list_folders, make_folder

LINE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("rows", T.LongType()),
    T.StructField("digest", T.StringType()),
    T.StructField("load", T.StringType()),
])
FOLDER = T.StructField("folder", T.StringType())
REPORT = T.StructType([
    FOLDER, *LINE.fields[:1], T.StructField("status", T.StringType()), T.StructField("rows", T.LongType()),
])
NEW, CHANGED, SAME = "new", "changed", "same"
HERE = "."  # files beside the folders
HIDDEN = ("_", ".")


def _digest() -> tuple[Column, Column]:
    """Rows of a file and a digest of them that does not depend on how the file was split; a line's place does not count."""
    line = F.xxhash64("value")
    total = F.sum(line.cast("decimal(38,0)")).cast("string")
    return F.count(F.lit(1)).alias("rows"), F.concat_ws(":", total, F.hex(F.bit_xor(line))).alias("digest")


@dataclass(frozen=True)
class Ledger:
    """``root`` holds the ledger and the rows it has loaded, of JSON files with one object per line."""

    spark: SparkSession
    root: str
    schema: T.StructType

    def lines(self, folder: str | None = None) -> DataFrame:
        path = f"{self.root}/ledger" if folder is None else f"{self.root}/ledger/folder={folder}"
        make_folder(self.spark, path)
        return self.spark.read.schema(LINE if folder else T.StructType([*LINE.fields, FOLDER])).parquet(path)

    def rows(self) -> DataFrame:
        """All rows loaded, with ``source_file`` and ``folder``."""
        loads = [r.load for r in self.lines().select("load").distinct().collect()]
        schema = T.StructType([*self.schema.fields, T.StructField("source_file", T.StringType()), FOLDER])
        if not loads:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(T.StructType([*schema.fields, LINE["load"]])).option("basePath", f"{self.root}/rows")
        return reader.parquet(*[f"{self.root}/rows/load={load}" for load in loads]).select(schema.fieldNames())

    def _listing(self, paths: str | list[str]) -> DataFrame:
        """The files of one folder, empty ones left out; no content is read."""
        files = self.spark.read.format("binaryFile").load(paths)
        return files.select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))

    def _measured(self, paths: list[str]) -> DataFrame:
        """Rows and digest of some files, read as lines."""
        if not paths:
            return self.spark.createDataFrame([], T.StructType([LINE["path"], LINE["rows"], LINE["digest"]]))
        lines = self.spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
        return lines.groupBy("path").agg(*_digest())

    def _load_folder(self, paths: str | list[str], folder: str) -> DataFrame:
        listing = self._listing(paths).alias("f")
        known = self.lines(folder).alias("k")
        found = listing.join(known, "path", "left").select(
            "path", "f.length", "f.modified", F.col("k.digest").alias("before"), F.col("k.path").isNotNull().alias("is_known"),
            ((F.col("f.length") != F.col("k.length")) | (F.col("f.modified") != F.col("k.modified"))).alias("touched"),
        )
        # New and touched files only: what a load works on.
        todo = found.filter("NOT is_known OR touched").collect()
        new = [r for r in todo if not r.is_known]
        measured = {r.path: r for r in self._measured([r.path for r in todo]).collect()}
        empty = Row(path="", rows=0, digest="")
        load = uuid.uuid4().hex
        if new:
            rows = self.spark.read.schema(self.schema).json([r.path for r in new])
            named = rows.withColumn("source_file", F.col("_metadata.file_path")).withColumn("folder", F.lit(folder))
            named.write.partitionBy("folder").parquet(f"{self.root}/rows/load={load}")
            lines = [
                (r.path, r.length, r.modified, *((m := measured.get(r.path, empty)).rows, m.digest), load) for r in new
            ]
            self.spark.createDataFrame(lines, LINE).coalesce(1).write.mode("append").parquet(f"{self.root}/ledger/folder={folder}")
        report = []
        for r in todo:
            m = measured.get(r.path, empty)
            status = NEW if not r.is_known else SAME if m.digest == r.before else CHANGED
            report.append((folder, r.path, status, m.rows))
        return self.spark.createDataFrame(report, REPORT)

    def load(self, files: str) -> DataFrame:
        """Load what is new in the folders under ``files``, or beside them.

        The report has a line per file that was new or touched: ``folder, path, status, rows``. A
        touched file of the same content is ``same``; one that changed is ``changed`` until it is put
        right, and its rows stay as they were first loaded.
        """
        report = self.spark.createDataFrame([], REPORT)
        beside = self._beside(files)
        folders = [(f"{files}/{name}", name) for name in list_folders(self.spark, files) if not name.startswith(HIDDEN)]
        for paths, name in [(beside, HERE)] * bool(beside) + folders:
            report = report.unionByName(self._load_folder(paths, name))
        return report

    def _beside(self, path: str) -> list[str]:
        """The files of the top folder itself."""
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in system.listStatus(there) if s.isFile()]
        return [p.toString() for p in found if not p.getName().startswith(HIDDEN)]
