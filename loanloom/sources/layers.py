"""Stored tables: one folder per layer, replaced in full on every write.

A write goes to a version folder of its own and only then becomes the table, by a
pointer that names it. Pointers are numbered and never changed: the next number is
created only if no file of that name exists, so of two writers one takes it and the other
the number after, and a reader sees a whole pointer or the one before. A job that fails
leaves the table as it was. Removed are versions that older pointers name, never one that
is still being written; readers that were planned on the version before can finish.

Listing and creating pointers goes through the JVM's file systems (``_files``), which a
Spark Connect session does not offer; nothing else here does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Pointers to versions, by number; hidden from readers of the folder.
POINTER = "_pointer-"
#: Pointers whose versions stay: the present one and the one before.
KEPT = 2
#: Files of different values that one task keeps open; with more values it sorts the rest.
OPEN_FILES = 128
#: What such a file holds in memory before it writes a row group, a page and a dictionary, in
#: bytes. Usual row groups are as large as whole files here: all would grow till the end.
OPEN_FILE_BUFFERS = {
    "parquet.block.size": 512 * 1024,
    "parquet.page.size": 64 * 1024,
    "parquet.dictionary.page.size": 32 * 1024,
}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder


#: Rows of a piece or bucket, so that what one task holds does not grow with the table.
ROWS_PER_PIECE = 300_000


def pieces_for(spark: SparkSession, rows: int, rows_per_piece: int = ROWS_PER_PIECE) -> int:
    """How many pieces so many rows are dealt into; the session's partitions at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_piece))


class Layers:
    """Writes and reads tables under ``<root>/<layer>/<table>``.

    Without ``root`` they stand in a new folder of the shared one, which ``close``
    removes.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self._owned = root is None
        self._bucketed: list[str] = []
        self.root = root or f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def current(self, layer: str, name: str) -> str:
        """Folder of the table's present version."""
        for _, version in self._pointers(layer, name):
            return f"{self.path(layer, name)}/{version}"
        raise FileNotFoundError(f"no table {layer}.{name} in {self.root}")

    def write(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the table and read it back, which also cuts the lineage.

        A stored table survives lost executors, is pruned by column and gives the
        planner its true size. With ``partition_by`` rows are written where they lie, one
        file a task and value: they are neither shuffled nor sorted, so the write takes no
        more disk than the table. How large the files are follows from the tasks; what a
        task holds of them does not, as each writes its rows out in small groups.
        """
        version = f"v-{uuid.uuid4().hex}"

        def save(rows: DataFrame) -> None:
            writer = rows.write.option("compression", "zstd")
            if partition_by:
                writer = writer.partitionBy(*partition_by).options(**OPEN_FILE_BUFFERS)
            writer.parquet(f"{self.path(layer, name)}/{version}")

        def save_by_value(rows: DataFrame) -> None:
            open_files = "spark.sql.maxConcurrentOutputFileWriters"
            before = self.spark.conf.get(open_files, None)
            self.spark.conf.set(open_files, str(OPEN_FILES))
            try:
                save(rows)
            finally:
                if before is None:
                    self.spark.conf.unset(open_files)
                else:
                    self.spark.conf.set(open_files, before)

        self._replace(df, layer, name, version, save_by_value if partition_by else save)
        return self.read(df.schema, layer, name)

    def write_bucketed(
        self, df: DataFrame, layer: str, name: str, key: str, buckets: int | None = None
    ) -> DataFrame:
        """Like ``write``, dealt and sorted by the key into buckets.

        Tables of one bucket count join, group and window by the key without another
        shuffle. The count is the session's shuffle partitions unless given. One file a
        bucket, so no key may hold a large share of the rows: sum them first.
        """
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        version = f"v-{uuid.uuid4().hex}"

        def save(rows: DataFrame) -> None:
            (
                rows.write.bucketBy(buckets, key)
                .sortBy(key)
                .option("path", f"{self.path(layer, name)}/{version}")
                .option("compression", "zstd")
                .format("parquet")
                .saveAsTable(self._table(version))
            )

        # A bucket is what the hash puts into one partition, so each makes one file.
        self._replace(df.repartition(buckets, key), layer, name, version, save)
        self._bucketed.append(self._table(version))
        return self.spark.table(self._table(version))

    def _replace(
        self, df: DataFrame, layer: str, name: str, version: str, save: Callable
    ) -> None:
        try:
            self._written(df, name, save)
        except BaseException:
            # What a writer that is killed leaves behind is named by no pointer.
            files, folder = self._files(f"{self.path(layer, name)}/{version}")
            files.delete(folder, True)
            raise
        self._publish(layer, name, version)

    def _written(self, df: DataFrame, name: str, save: Callable[[DataFrame], None]) -> None:
        """Runs the job that writes a table's rows, dealt as they are written."""
        save(df)

    def read(self, schema, layer: str, name: str) -> DataFrame:
        return (
            self.spark.read.schema(schema)
            .parquet(self.current(layer, name))
            .select(*schema.fieldNames())
        )

    def close(self) -> None:
        """Removes the tables, unless their folder was given by the caller."""
        for table in self._bucketed:
            # The catalog's entry only: the files are the folder's.
            self.spark.sql(f"drop table if exists {table}")
        self._bucketed.clear()
        if self._owned:
            files, root = self._files(self.root)
            files.delete(root, True)

    @staticmethod
    def _table(version: str) -> str:
        return f"stored_{version.removeprefix('v-')}"

    def _files(self, path: str):
        """The path and its file system, as the cluster is configured for it."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hadoop.getFileSystem(configuration), hadoop

    def _numbers(self, layer: str, name: str) -> list[int]:
        """Numbers of all pointers, the latest first."""
        files, folder = self._files(self.path(layer, name))
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        numbers = [n.removeprefix(POINTER) for n in names if n.startswith(POINTER)]
        return sorted((int(n) for n in numbers if n.isdigit()), reverse=True)

    def _pointer(self, layer: str, name: str, number: int) -> str:
        return f"{self.path(layer, name)}/{POINTER}{number:012d}"

    def _pointers(self, layer: str, name: str):
        """Number and version of the whole pointers, the latest first."""
        for number in self._numbers(layer, name):
            files, pointer = self._files(self._pointer(layer, name, number))
            stream = files.open(pointer)
            try:
                if files.getFileStatus(pointer).getLen():
                    yield number, stream.readUTF()
            finally:
                stream.close()

    def _publish(self, layer: str, name: str, version: str) -> None:
        """Makes the version the table's present one, then removes outdated ones."""
        number = max(self._numbers(layer, name), default=0) + 1
        while not self._claim(layer, name, number, version):
            number += 1
        files, folder = self._files(self.path(layer, name))
        for old, outdated in list(self._pointers(layer, name))[KEPT:]:
            for gone in (f"{folder}/{outdated}", self._pointer(layer, name, old)):
                files.delete(self._files(gone)[1], True)

    def _claim(self, layer: str, name: str, number: int, version: str) -> bool:
        """Creates the pointer of a number; false if it is taken."""
        files, pointer = self._files(self._pointer(layer, name, number))
        if files.exists(pointer):
            return False
        try:
            stream = files.create(pointer, False)
        except Exception as error:
            if "already exists" in str(error):
                return False
            raise
        try:
            stream.writeUTF(version)
        finally:
            stream.close()
        return True
