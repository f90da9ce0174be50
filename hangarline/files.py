"""Small files and folders beside the tables, on whatever file system the warehouse is on."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system of a folder, reached through the session's JVM, which has its credentials.

    A session without one (Spark Connect) cannot create, list or remove files; it says so instead of failing midway.
    """

    def __init__(self, spark: SparkSession, folder: str):
        if not hasattr(spark, "_jvm"):
            raise NotImplementedError("publishing and cleaning need a session with its own JVM, not Spark Connect")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._utf8 = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString
        self.folder = self._hadoop.Path(folder)
        self._system = self.folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self._hadoop.Path(self.folder, name)

    def names(self) -> list[str]:
        """What the folder holds, sorted; nothing if it does not exist."""
        if not self._system.exists(self.folder):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self.folder))

    def text(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return self._read(stream, self._utf8)
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Creates a file unless it exists; False if it does. Of several writers one gets True.

        That rests on the file system: HDFS decides it in one place, object stores by conditional writes where the
        connector has them switched on.
        """
        path = self._path(name)
        if self._system.exists(path):
            return False
        from py4j.protocol import Py4JJavaError

        try:
            stream = self._system.create(path, False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def remove(self, name: str) -> None:
        self._system.delete(self._path(name), True)
