"""Results of one run, counted as they are written and published together."""

from __future__ import annotations

import uuid
from types import TracebackType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opinionlens.sources.results import RESULTS, in_order, result_path

REPORT = "result string, rows bigint"


class StagedResults:
    """Writes results beside the published ones, and puts them in their place at the end.

    Used in a ``with`` statement. Rows are counted in the pass that writes them. Results
    named ``add`` by :meth:`write` gather the rows of several writes of one run; others hold
    those of the last write. If the statement ends with an error, what was published before
    stays whole and what was staged is deleted. Results are put in place one after the other
    by renaming their folders; one that was moved aside is deleted after all are in place,
    and goes back if a later one cannot be put in place.
    """

    def __init__(self, spark: SparkSession, out_dir: str, file_format: str = "csv"):
        self.spark, self.out_dir, self.file_format = spark, out_dir.rstrip("/"), file_format
        self.run = uuid.uuid4().hex
        self.staging = f"{self.out_dir}/_staging-{self.run}"
        self.rows: dict[str, int] = {}

    def __enter__(self) -> StagedResults:
        return self

    def write(self, df: DataFrame, out_dir: str | None, name: str, file_format: str | None = None, add: bool = False) -> str:
        """Stage a result and return the path that it will have.

        Takes the arguments of ``write_result``; the folder and format are those of the run.
        """
        if name not in RESULTS:
            raise ValueError(f"unknown result {name!r}")
        counted = Observation()
        rows = in_order(df, name).observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = rows.write.mode("append" if add else "overwrite").format(self.file_format)
        if self.file_format == "csv":
            writer = writer.option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"')
        writer.save(result_path(self.staging, name))
        self.rows[name] = counted.get["rows"] + (self.rows.get(name, 0) if add else 0)
        return result_path(self.out_dir, name)

    def report(self) -> DataFrame:
        """``result`` and ``rows`` of all results of the run."""
        return self.spark.createDataFrame(sorted(self.rows.items()), REPORT)

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()

        def path(text: str):
            return jvm.org.apache.hadoop.fs.Path(text)

        files = path(self.out_dir).getFileSystem(conf)
        try:
            if error is None:
                self._publish(files, path)
        finally:
            files.delete(path(self.staging), True)

    def _publish(self, files, path) -> None:
        moved: list[tuple[str, str]] = []  # from, to
        try:
            for name in self.rows:
                target, aside = result_path(self.out_dir, name), f"{self.staging}/_before/{name}"
                if files.exists(path(target)):
                    files.mkdirs(path(aside).getParent())
                    self._move(files, path, target, aside, moved)
                files.mkdirs(path(target).getParent())
                self._move(files, path, result_path(self.staging, name), target, moved)
        except BaseException:
            for old, new in reversed(moved):
                files.rename(path(new), path(old))
            raise

    @staticmethod
    def _move(files, path, old: str, new: str, moved: list[tuple[str, str]]) -> None:
        if not files.rename(path(old), path(new)):
            raise OSError(f"{old} could not be moved to {new}")
        moved.append((old, new))
