"""The manifest of an iterative run: which rounds are done, and of what.

A run's folder holds one small JSON file per finished round. It is written
under a temporary name and renamed once the round's data is complete, so a
driver lost at any moment leaves whole rounds only. The input's fingerprint
(number of rows, and order-independent sums of row hashes) keeps a run from
going on with other data.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.session import delete_path


def fingerprint(df: DataFrame) -> list[int]:
    """Rows, and two sums of their hashes: the same for the same bag of rows, whatever its order."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("x"),
               F.coalesce(F.sum(F.shiftrightunsigned(h, 32)), F.lit(0)).alias("s")).first()
    return [r["n"], r["x"], r["s"]]


class Manifest:
    """Finished rounds of the run in one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def path(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def _files(self) -> list[str]:
        fs, p = self._fs(self.path("rounds"))
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def last(self) -> dict | None:
        """What the last finished round says, None before the first."""
        names = self._files()
        if not names:
            return None
        text = self.spark.read.text(self.path("rounds", names[-1]), wholetext=True).first()[0]
        return json.loads(text)

    def add(self, number: int, said: dict) -> None:
        """Enter a finished round; earlier rounds' entries and data folders go."""
        done = self._files()
        name, jvm = f"round-{number:06d}.json", self.spark.sparkContext._jvm
        fs, draft = self._fs(self.path("rounds", f"_{name}.{uuid.uuid4().hex[:8]}"))
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(said | {"round": number}), "utf-8"))
        finally:
            out.close()
        if not fs.rename(draft, jvm.org.apache.hadoop.fs.Path(self.path("rounds", name))):
            raise OSError(f"round {number} could not be entered in {self.root}")
        for old in done:
            if old != name:
                before = json.loads(self.spark.read.text(self.path("rounds", old), wholetext=True).first()[0])
                if before.get("ranks") != said.get("ranks"):
                    delete_path(self.spark, before["ranks"])
                delete_path(self.spark, self.path("rounds", old))
