"""Result tables, partitioned by run, and exports of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


class Store:
    """Tables in a folder that Hadoop's file systems reach, one parquet folder each, partitioned by Run_ID."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def has(self, table: str) -> bool:
        return _exists(self.spark, self.path(table))

    def append(self, table: str, df: DataFrame, run_id: int) -> None:
        """Columns may be added over time; reads fill older rows with nulls."""
        df.write.mode("append").parquet(f"{self.path(table)}/Run_ID={run_id}")  # a file with the schema even without rows

    def read(self, table: str, run_id: int | None = None) -> DataFrame:
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        return df if run_id is None else df.filter(F.col("Run_ID") == run_id)

    def replace_run(self, table: str, df: DataFrame, run_id: int) -> None:
        """Writes one run's rows anew, as an update would."""
        df.write.mode("overwrite").parquet(f"{self.path(table)}/Run_ID={run_id}")

    def add_missing(self, table: str, seed: DataFrame, key: str) -> int:
        """Appends the rows of seed whose key is not there yet."""
        new = seed.join(self.spark.read.parquet(self.path(table)).select(key), key, "left_anti") if self.has(table) else seed
        n = new.count()
        if n:
            new.write.mode("append").parquet(self.path(table))
        return n

    def drop_run(self, table: str, run_id: int) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/Run_ID={run_id}")
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def truncate(self, table: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path(table))
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def next_run(self) -> int:
        return (self.read("RunLog").agg(F.max("Run_ID")).first()[0] or 0) + 1 if self.has("RunLog") else 1

    def log_run(self, run_id: int, **values: object) -> None:
        row = self.spark.createDataFrame([{k: str(v) for k, v in values.items()} or {"note": ""}]).withColumn("Recorded_At", F.current_timestamp())
        self.append("RunLog", row, run_id)

    def update_run(self, run_id: int, **values: object) -> None:
        """Adds values to a run's row, or changes them; a row that is not there is made."""
        rows = self.read("RunLog", run_id).drop("Run_ID").limit(1).collect() if self.has("RunLog") else []
        known = {k: v for k, v in (rows[0].asDict() if rows else {}).items() if v is not None}
        began = known.pop("Recorded_At", None)
        new = {**known, **{k: str(v) for k, v in values.items()}} or {"note": ""}
        row = self.spark.createDataFrame([new]).withColumn("Recorded_At", F.lit(began).cast("timestamp") if began else F.current_timestamp())
        self.replace_run("RunLog", row, run_id)

    def latest_run(self) -> int | None:
        return self.read("RunLog").agg(F.max("Run_ID")).first()[0] if self.has("RunLog") else None


def export_csv(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """CSV with a header; sorted over the whole output if an order is given, one file only if asked for."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(1) if single else out).write.mode("overwrite").csv(path, header=True)


def export_legacy(detail: DataFrame, summary: DataFrame, folder: str) -> None:
    """The detail rows and the summary of the older matcher, as two CSV outputs in the order they are read in."""
    flat = detail.select(*[c for c, t in detail.dtypes if not t.startswith("struct")])
    export_csv(flat, f"{folder.rstrip('/')}/detail", ["principal_id", "uid", "match_field", "matchtype"])
    export_csv(summary, f"{folder.rstrip('/')}/summary", ["principal_id"])


def export_run(store: Store, run_id: int, folder: str, tables: list[str]) -> dict[str, int]:
    """Exports the run's rows of the tables that are there; how many each had."""
    counts = {}
    for t in tables:
        if store.has(t):
            df = store.read(t, run_id)
            export_csv(df, f"{folder.rstrip('/')}/{t}", ["Input_Record_ID", "Match_Type"] if t == "Report" else None)
            counts[t] = df.count()
    return counts


def export_non_passing(df: DataFrame, path: str, run_date: str, list_version: str) -> None:
    """df: of audit.non_passing_report. The lines that open the audit file in path/preamble, and its rows, in as many compressed parts as they need, in path/rows."""
    lines = ["Reason for not Including as a match: InsufficientNameMatch", f"Run Date: {run_date}", f"SDN List Version: {list_version}", ""]
    df.sparkSession.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/preamble")
    df.write.mode("overwrite").option("compression", "gzip").csv(f"{path.rstrip('/')}/rows", header=True)


def write_back(rows: DataFrame, path: str | None = None, table: str | None = None, jdbc: dict[str, str] | None = None) -> None:
    """Appends rows to the source they are meant for: a folder of parquet files, a table, or a table behind JDBC (url, dbtable and so on)."""
    out = rows.write.mode("append")
    if path:
        out.parquet(path)
    elif table:
        out.saveAsTable(table)
    else:
        out.format("jdbc").options(**(jdbc or {})).save()


def run_log_text(store: Store, run_id: int, path: str) -> None:
    rows = store.read("RunLog", run_id)
    line = F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in rows.columns])
    rows.select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)
