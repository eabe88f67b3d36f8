"""Small files and folders on the shared file system, through Spark's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few file operations the warehouse needs besides Spark's own readers and writers."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; an absent folder is empty."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs(folder).listStatus(self._path(folder)))

    def make(self, folder: str) -> None:
        self._fs(folder).mkdirs(self._path(folder))

    def delete(self, path: str) -> bool:
        return self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create_text(self, path: str, text: str, token: str) -> None:
        """Publish a whole file under a name that must be free.

        The text goes to a private name first; the rename refuses an existing target, so
        of two writers one fails and no reader sees half a file.
        """
        draft = f"{path}.{token}.draft"
        stream = self._fs(draft).create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._path(path).toUri(), self._conf)
        context.rename(self._path(draft), self._path(path), self._gateway.new_array(fs.Options.Rename, 0))
