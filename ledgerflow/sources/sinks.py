"""Writers: processed datasets, exports, tables, alert log, JSON summaries, transformation log."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.schemas import PRIMARY_KEY, TABLES
from ledgerflow.sources.quality import duplicate_keys


def save_processed(datasets: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write every dataset as ``<folder>/<name>.<fmt>``; part files in parallel, never one task."""
    paths = []
    for name, df in datasets.items():
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        writer = df.write.mode("overwrite")
        writer.csv(path, header=True, quote='"', escape='"') if fmt == "csv" else writer.format(fmt).save(path)
        paths.append(path)
    return paths


def export_for_bi(daily: DataFrame, forecast: DataFrame, kpis: DataFrame, folder: str) -> list[str]:
    return save_processed({"cash_flow_daily": daily, "forecast_results": forecast, "kpis": kpis}, folder, "csv")


def conform(df: DataFrame, name: str, spark: SparkSession) -> DataFrame:
    """Declared columns and types of a table, dates included; absent columns become null."""
    schema = spark.createDataFrame([], TABLES[name]).schema
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _staged(spark: SparkSession, df: DataFrame, name: str, path: str, check_key: bool) -> None:
    """Evaluate and write a table once; if its key is not unique in what was written, remove it and raise."""
    conform(df, name, spark).write.parquet(path)
    if check_key and name in PRIMARY_KEY:
        if duplicate_keys(spark.read.schema(TABLES[name]).parquet(path), PRIMARY_KEY[name]).limit(1).count():
            _files(spark, path).delete(_path(spark, path), True)
            raise ValueError(f"{name}: key {PRIMARY_KEY[name]} is not unique")


def load_tables(
    spark: SparkSession, datasets: Mapping[str, DataFrame], folder: str, database: str | None = None, check_key: bool = True
) -> dict[str, DataFrame]:
    """Replace several tables at once.

    Every table is written to a folder of this load and its key checked there, then moved to a place that nothing names yet. One
    rename then puts the load's list of tables in place: a reader (:func:`open_tables`) sees all of them or none, and a failed load leaves the set as it was.
    Tables that the load does not hold stay. Named tables of ``database`` are pointed at the load afterwards, one by one.
    """
    base, version = folder.rstrip("/"), uuid.uuid4().hex
    names = [name for name in datasets if name in TABLES]
    for name in names:
        _staged(spark, datasets[name], name, f"{base}/.loading/{version}/{name}", check_key)
    for name in names:
        files, target = _files(spark, base), _path(spark, f"{base}/{name}/{version}")
        files.mkdirs(target.getParent())
        if not files.rename(_path(spark, f"{base}/.loading/{version}/{name}"), target):
            raise OSError(f"{name} can't be moved to {target.toString()}")
    last, held = _current(spark, base)
    _put(spark, f"{base}/_sets/{last + 1:012d}", json.dumps({**held, **{name: f"{name}/{version}" for name in names}}))
    loaded = {name: spark.read.schema(TABLES[name]).parquet(f"{base}/{name}/{version}") for name in names}
    if database:
        for name in names:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            spark.catalog.createTable(f"{database}.{name}", path=f"{base}/{name}/{version}", source="parquet", schema=loaded[name].schema)
            loaded[name] = spark.table(f"{database}.{name}")
    return loaded


def load_table(
    spark: SparkSession, df: DataFrame, name: str, folder: str, check_key: bool = True, database: str | None = None
) -> DataFrame:
    """Replace one table under ``folder``, named ``database.name`` when a database is given."""
    return load_tables(spark, {name: df}, folder, database, check_key)[name]


def open_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the last finished load; a load that goes on or failed is not seen."""
    base = folder.rstrip("/")
    return {name: spark.read.schema(TABLES[name]).parquet(f"{base}/{place}") for name, place in _current(spark, base)[1].items()}


def _current(spark: SparkSession, base: str) -> tuple[int, dict[str, str]]:
    """Number and content of the newest list of tables; 0 and nothing before the first load."""
    names = [n for n in _listed(spark, f"{base}/_sets") if n.isdigit()]
    if not names:
        return 0, {}
    newest = max(names)
    stream = _files(spark, base).open(_path(spark, f"{base}/_sets/{newest}"))
    try:
        return int(newest), json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _listed(spark: SparkSession, folder: str) -> list[str]:
    files = _files(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(_path(spark, folder))] if files.exists(_path(spark, folder)) else []


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file by a rename, so that it is there whole or not at all; raise if the name is taken."""
    files, target = _files(spark, path), _path(spark, path)
    draft = _path(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(f"{path} was written meanwhile")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def append_rows(spark: SparkSession, rows: DataFrame | Sequence[tuple], name: str, folder: str, token: str | None = None) -> DataFrame:
    """Append a batch to a table and return the table.

    A batch is named by its ``token`` (a run's id; a new one if none is given), and counts once its marker is there. The same
    token again changes nothing, so a run can be repeated; without the marker, as after a crash, the batch is written anew.
    """
    base = f"{folder.rstrip('/')}/{name}"
    token = token or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", token):
        raise ValueError(f"not a token: {token!r}")
    if token not in _listed(spark, f"{base}/_committed"):
        batch = rows if isinstance(rows, DataFrame) else spark.createDataFrame(list(rows), TABLES[name])
        conform(batch, name, spark).write.mode("overwrite").parquet(f"{base}/batch={token}")
        try:
            _put(spark, f"{base}/_committed/{token}", "")
        except FileExistsError:
            pass  # the same batch was committed meanwhile
    return appended(spark, name, folder)


def appended(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """The committed batches of a table that grows by :func:`append_rows`."""
    base = f"{folder.rstrip('/')}/{name}"
    paths = [f"{base}/batch={t}" for t in sorted(_listed(spark, f"{base}/_committed")) if not t.startswith(".")]
    return spark.read.schema(TABLES[name]).parquet(*paths) if paths else spark.createDataFrame([], TABLES[name])


def save_alerts(spark: SparkSession, alerts: DataFrame, folder: str, token: str | None = None) -> DataFrame:
    """Append triggered alerts with the time and ``resolved = 0``; the same ``token`` logs them once."""
    stamped = alerts.where("triggered").select(
        F.col("code").alias("alert_code"),
        "severity",
        "message",
        F.current_timestamp().alias("triggered_at"),
        F.lit(0).alias("resolved"),
    )
    return append_rows(spark, stamped, "alerts", folder, token)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def forecast_summary_document(summary: DataFrame, indicators: DataFrame) -> DataFrame:
    """One nested row: period, statistics, risk indicators."""
    statistics = ["min_balance", "max_balance", "mean_balance", "std_balance"]
    period = F.struct(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"), "days")
    nested = summary.select(period.alias("forecast_period"), F.struct(*statistics).alias("statistics"))
    risk = indicators.select(F.struct(*indicators.columns).alias("r")).scalar()
    return nested.withColumn("risk_indicators", risk)


def metrics_document(report: DataFrame) -> DataFrame:
    model = ["mae", "rmse", "mape", "smape", "coverage", "interval_level", "n_evaluations"]
    return report.select(
        F.struct(*model).alias("model_metrics"),
        F.struct("naive_mae", "naive_rmse", "naive_mape").alias("benchmark_metrics"),
        F.struct("mae_improvement", "mape_improvement").alias("improvement_vs_benchmark"),
    )


def config_document(spark: SparkSession, config: ModelConfig) -> DataFrame:
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in vars(config).items()])


def logged_write(
    source: DataFrame, result, step: str, source_name: str, target: str, steps: Sequence[str]
) -> DataFrame:
    """Write ``result(source)`` to ``target`` and return its log row.

    Rows in and out are counted by observers during the write itself, not by extra jobs.
    """
    rows_in, rows_out = Observation(), Observation()
    watched = source.observe(rows_in, F.count(F.lit(1)).alias("n"))
    result(watched).observe(rows_out, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    spark = source.sparkSession
    return spark.range(1).select(
        F.lit(step).alias("step"),
        F.lit(source_name).alias("input"),
        F.lit(target).alias("output"),
        F.lit(rows_in.get["n"]).cast("bigint").alias("rows_in"),
        F.lit(rows_out.get["n"]).cast("bigint").alias("rows_out"),
        F.array(*[F.lit(s) for s in steps]).alias("transformations"),
        F.current_timestamp().alias("timestamp"),
    )
