"""What a run has finished, so that the next one does only what is new or was left undone."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(part) for part in parts]).encode()).hexdigest()


def table_version(frame: DataFrame) -> str:
    """A digest of the plan of ``frame`` and of the names, sizes and times of its files.

    Two tables of one version hold the same rows, as long as the plan has no random part. A table
    that reads no files, whose rows lie in the plan itself, gets a version of its own each time.
    """
    files = frame.inputFiles()
    if not files:
        return uuid.uuid4().hex
    listed = frame.sparkSession.read.format("binaryFile").load(files)  # no content is read
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    row = listed.agg(F.count(F.lit(1)).alias("n"), mark.alias("mark")).first()
    plan = re.sub(r"#\d+L?", "", frame._jdf.queryExecution().analyzed().toString())
    return digest(plan, frame.schema.json(), row.n, row.mark)


class Manifest:
    """Finished stages and the versions of what they were made from, in one small file.

    The file is replaced by a rename. A stage is struck off before it is done again, so one that
    breaks off is never taken for finished.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.path = spark, f"{folder}/_manifest.json"
        self._file = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = self._file.getFileSystem(spark._jsc.hadoopConfiguration())
        self.stages: dict[str, str] = {}
        if system.exists(self._file):
            stream = system.open(self._file)
            try:
                self.stages = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()

    def _save(self) -> None:
        files = self.spark._jvm.org.apache.hadoop.fs
        fresh = files.Path(f"{self.path}.{uuid.uuid4().hex}")
        conf = self.spark._jsc.hadoopConfiguration()
        stream = self._file.getFileSystem(conf).create(fresh)
        try:
            stream.write(json.dumps(self.stages).encode())
        finally:
            stream.close()
        kind = getattr(files, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        files.FileContext.getFileContext(self._file.toUri(), conf).rename(fresh, self._file, options)

    def run(self, stage: str, version: str, work: Callable[[], object]) -> bool:
        """Do ``work`` unless ``stage`` was finished at this version; says whether it was done."""
        if self.stages.get(stage) == version:
            return False
        if self.stages.pop(stage, None) is not None:
            self._save()
        work()
        self.stages[stage] = version
        self._save()
        return True
