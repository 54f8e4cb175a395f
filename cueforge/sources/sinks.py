"""Writers: one file for each row's text, and versioned snapshots of state tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def write_texts(df: DataFrame, path: str, name: str = "file_name", text: str = "content", bom: bool = False) -> DataFrame:
    """Write each row's text as a file of its own under a shared path; returns (file_name, n_chars) of those written.

    A file is written under another name and then moved, so a repeated task leaves no half of one.
    """
    columns = df.select(name, text)

    def run(batches):
        import os

        import pandas as pd

        for pdf in batches:
            for file, value in zip(pdf[name], pdf[text], strict=True):
                target = os.path.join(path, file)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                part = f"{target}.{uuid.uuid4().hex}.tmp"
                with open(part, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
                    f.write(value)
                os.replace(part, target)
            yield pd.DataFrame({"file_name": pdf[name], "n_chars": pdf[text].str.len()})

    return columns.mapInPandas(run, "file_name string, n_chars long")


class Snapshots:
    """A state table as versions: each write is a new folder, and a small pointer file with the next number comes last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _turns(self) -> list[int]:
        """The numbers of the pointers that are there."""
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.path))]
        return sorted(int(n.removeprefix("CURRENT-")) for n in names if n.startswith("CURRENT-"))

    def read(self) -> DataFrame | None:
        """The present version, or None."""
        turns = self._turns()
        if not turns:
            return None
        version = json.loads(self.spark.read.text(f"{self.path}/CURRENT-{turns[-1]}", wholetext=True).first()[0])["version"]
        return self.spark.read.parquet(f"{self.path}/{version}")

    def write(self, df: DataFrame) -> str:
        """A new version; readers see the old or the new one, never a mixture, and never none.

        The new pointer is written aside and then named after the highest number; the one before stays until the next write.
        """
        turns, version = self._turns(), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{version}")
        part = self._path(f"{self.path}/pointer-{version}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps({"version": version}).encode()))
        out.close()
        target = self._path(f"{self.path}/CURRENT-{turns[-1] + 1 if turns else 0}")
        if not self._fs.rename(part, target):
            raise OSError(f"can't name {target}")
        for old in turns[:-1]:
            self._fs.delete(self._path(f"{self.path}/CURRENT-{old}"), False)
        return version

    def reset(self) -> None:
        """Forget all versions."""
        self._fs.delete(self._path(self.path), True)
