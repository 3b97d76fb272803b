"""Source, sink, schema and quality queries."""

from datetime import date

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.functions.keyed import attach_stats
from ledgerflow.operators import clean, forecast, kpi, series
from ledgerflow.operators.evaluate import evaluation_report
from ledgerflow.plans.queries_cleaning import AS_OF
from ledgerflow.plans.registry import query
from ledgerflow.schemas import OPTIONAL, REQUIRED
from ledgerflow.sources import catalog, quality, sinks
from ledgerflow.sources.shared import fresh_path

RAW_VIEWS = {
    "invoices": "fx_invoices_raw",
    "bank_movements": "fx_bank_raw",
    "crm_deals": "fx_deals_raw",
    "employees": "fx_employees_raw",
    "suppliers": "fx_suppliers_raw",
    "external_factors": "fx_factors",
}


def _counts(views: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS dataset, count(*) AS rows FROM {view}" for name, view in views.items())


def _raw_csv_folder(fx) -> str:
    """The raw datasets written once as CSV, as a source system would deliver them."""
    folder = fresh_path(fx.spark, "raw")
    datasets = {name: df.drop("load_seq") for name, df in fx.raw().items()}
    sinks.save_processed(datasets, folder, "csv")
    return folder


@query("s01_read_catalog", "dataset:s rows:i", _counts(RAW_VIEWS))
def _(fx):
    return quality.row_counts(catalog.read_catalog(fx.spark, _raw_csv_folder(fx)))


@query(
    "s01_line_breaks_in_fields",
    "doc_id:i text_md5:s lang:s source:s",
    "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents",
)
def _(fx):
    folder = fresh_path(fx.spark, "quoted")
    kept = {"quote": '"', "escape": '"', "quoteAll": True, "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fx.table("documents").select("doc_id", "text", "lang", "source").na.fill("", ["text", "lang", "source"]).write.csv(f"{folder}/documents.csv", **kept)
    read = catalog.read_csv(fx.spark, f"{folder}/documents.csv", multi_line=True)
    empty = F.lit("")
    return read.select("doc_id", F.md5(F.coalesce("text", empty)).alias("text_md5"), F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"))


def _headed(header: str):
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
        yield from batches

    return run


@query(
    "s01_malformed_rows",
    "dataset:s rows:i malformed:i",
    "SELECT 'customers' AS dataset, count(*) AS rows, count(*) FILTER (WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0) AS malformed FROM customer",
)
def _(fx):
    folder = fresh_path(fx.spark, "dirty")
    name = F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit("\n")), F.lit('"'))
    key = F.col("c_custkey").cast("string")
    line = F.when(key % 10 == 0, key).when(key % 7 == 0, F.concat_ws(",", key, name, F.lit("more"))).otherwise(F.concat_ws(",", key, name))
    fx.table("customer").select(line.alias("value")).mapInArrow(_headed("id,name"), "value string").write.text(f"{folder}/customers.csv")
    found = catalog.malformed_rows(fx.spark, folder)
    return found.groupBy("dataset").agg(F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"))


@query("s02_read_with_fallback", "movement_id:s date:s amount:s", "SELECT movement_id, CAST(date AS VARCHAR) AS date, CAST(amount AS VARCHAR) AS amount FROM fx_bank")
def _(fx):
    folder = fresh_path(fx.spark, "second")
    ledger = fx.bank().select("movement_id", F.col("date").cast("string").alias("date"), F.col("amount").cast("string").alias("amount"))
    sinks.save_processed({"bank_movements": ledger}, folder, "csv")
    return catalog.read_or_empty(fx.spark, "bank_movements", f"{folder}/absent", folder)


def _schema_sql() -> str:
    parts = []
    for name, view in RAW_VIEWS.items():
        known = ", ".join(f"'{c}'" for c in REQUIRED[name] + OPTIONAL[name])
        required = ", ".join(f"'{c}'" for c in REQUIRED[name])
        parts.append(
            f"""SELECT '{name}' AS dataset, count(*) FILTER (WHERE column_name IN ({required})) = {len(REQUIRED[name])} AS valid,
             {len(REQUIRED[name])} - count(*) FILTER (WHERE column_name IN ({required})) AS missing, count(*) FILTER (WHERE column_name NOT IN ({known})) AS extra,
             count(*) AS total_columns, (SELECT count(*) FROM {view}) AS total_rows
            FROM (SELECT unnest([{', '.join("'" + c + "'" for c in _data_columns(name))}]) AS column_name) c"""
        )
    return " UNION ALL ".join(parts)


def _data_columns(name: str) -> list[str]:
    return [*REQUIRED[name], *OPTIONAL[name]]


CHECKS = "dataset:s valid:b missing:i extra:i total_columns:i total_rows:i"


def _sizes(checks):
    return checks.withColumns({"missing": F.size("missing_required"), "extra": F.size("extra_columns")})


@query("s03_check_schema", CHECKS, f"SELECT * FROM ({_schema_sql()}) x WHERE dataset = 'invoices'")
def _(fx):
    return _sizes(quality.check_schema("invoices", fx.invoices_raw()))


@query(
    "s03_check_schema_missing",
    "dataset:s valid:b missing_required:s extra_columns:s total_columns:i total_rows:i",
    "SELECT 'invoices' AS dataset, FALSE AS valid, 'status' AS missing_required, 'state' AS extra_columns, 12 AS total_columns, count(*) AS total_rows FROM fx_invoices_raw",
)
def _(fx):
    renamed = fx.invoices_raw().withColumnRenamed("status", "state")
    checks = quality.check_schema("invoices", renamed)
    return checks.withColumns({c: F.array_join(c, ",") for c in ("missing_required", "extra_columns")})


@query("s04_check_all_schemas", CHECKS, _schema_sql())
def _(fx):
    return _sizes(quality.check_all_schemas(fx.raw()))


@query("s04_all_schemas_valid", "all_valid:b datasets:i", f"SELECT bool_and(valid) AS all_valid, count(*) AS datasets FROM ({_schema_sql()}) x")
def _(fx):
    return quality.all_valid(quality.check_all_schemas(fx.raw()))


def _null_sql(name: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, count(*) AS total FROM {RAW_VIEWS[name]}"
        for c in _data_columns(name)
    ]
    return f"SELECT \"column\", null_count, null_count * 100.0 / total AS null_pct FROM ({' UNION ALL '.join(parts)}) x WHERE null_count > 0"


@query("s05_null_profile", "column:s null_count:i null_pct:f2", _null_sql("invoices"))
def _(fx):
    return quality.null_profile(fx.invoices_raw())


@query("s05_null_profile_bank", "column:s null_count:i null_pct:f2", _null_sql("bank_movements"))
def _(fx):
    return quality.null_profile(fx.bank_raw())


def _outlier_sql(view: str, columns: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", min(q25) AS q25, min(q75) AS q75, count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outliers
         FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {view}) a, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75 FROM {view}) b"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


OUTLIERS = "column:s q25:f4 q75:f4 outliers:i"


@query("s06_outliers", OUTLIERS, f"SELECT * FROM ({_outlier_sql('events', ['value'])}) x WHERE outliers > 0")
def _(fx):
    return quality.outlier_counts(fx.table("events"), ["value"])


@query("s06_outliers_bank", OUTLIERS, _outlier_sql("fx_bank", ["amount", "balance_after"]))
def _(fx):
    return quality.outlier_counts(fx.bank(), ["amount", "balance_after"], keep_zero=True)


@query("s06_outliers_lineitem", OUTLIERS, _outlier_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def _(fx):
    return quality.outlier_counts(fx.table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], keep_zero=True)


def _cleaned(fx):
    return clean.clean_all(fx.raw(), AS_OF)


CLEAN_COUNTS = """SELECT 'invoices_clean' AS dataset, count(*) AS rows FROM v_invoices UNION ALL SELECT 'bank_clean', count(*) FROM v_bank
 UNION ALL SELECT 'crm_deals_clean', count(*) FROM v_deals UNION ALL SELECT 'employees_clean', count(*) FROM customer
 UNION ALL SELECT 'suppliers_clean', count(*) FROM supplier UNION ALL SELECT 'external_factors_clean', count(*) FROM fx_factors"""


@query("s07_save_processed", "dataset:s rows:i", CLEAN_COUNTS)
def _(fx):
    folder = fresh_path(fx.spark, "processed")
    sinks.save_processed(_cleaned(fx), folder)
    return quality.row_counts(catalog.read_catalog(fx.spark, folder, "parquet"))


def _forecast(fx, daily):
    return forecast.predict_base(forecast.fit_base(series.target_series(daily)))


@query(
    "s08_export_for_bi",
    "dataset:s rows:i",
    "SELECT 'cash_flow_daily' AS dataset, count(*) AS rows FROM v_cash UNION ALL SELECT 'forecast_results', count(*) FROM v_fc UNION ALL SELECT 'kpis', 1",
)
def _(fx):
    folder = fresh_path(fx.spark, "bi")
    daily = series.cash_flow_daily(fx.bank())
    ahead = _forecast(fx, daily)
    sinks.export_for_bi(daily, ahead, kpi.kpi_row(daily, ahead), folder)
    return quality.row_counts(catalog.read_catalog(fx.spark, folder))


@query("s08_exported_rows", "date:d cash_balance:f0 net_cash:f0", "SELECT date, cash_balance, net_cash FROM v_cash")
def _(fx):
    folder = fresh_path(fx.spark, "bi")
    daily = series.cash_flow_daily(fx.bank())
    ahead = _forecast(fx, daily)
    sinks.export_for_bi(daily, ahead, kpi.kpi_row(daily, ahead), folder)
    return catalog.read_csv(fx.spark, f"{folder}/cash_flow_daily.csv")


@query("s07_processed_rows", "invoice_id:s customer_name:s total:m is_overdue:b", "SELECT invoice_id, customer_name, total, is_overdue FROM v_invoices")
def _(fx):
    folder = fresh_path(fx.spark, "processed")
    sinks.save_processed({"invoices_clean": _cleaned(fx)["invoices_clean"]}, folder)
    return catalog.read_catalog(fx.spark, folder, "parquet")["invoices_clean"]


@query(
    "s09_load_tables",
    "dataset:s rows:i",
    _counts({"invoices": "v_invoices", "bank_movements": "v_bank", "crm_deals": "v_deals", "cash_flow_daily": "v_cash"}),
)
def _(fx):
    cleaned = _cleaned(fx)
    tables = {
        "invoices": cleaned["invoices_clean"],
        "bank_movements": cleaned["bank_clean"],
        "crm_deals": cleaned["crm_deals_clean"],
        "cash_flow_daily": series.cash_flow_daily(fx.bank()),
    }
    return quality.row_counts(sinks.load_tables(fx.spark, tables, fresh_path(fx.spark, "tables")))


@query(
    "s10_parameter_sql",
    "category:s movements:i amount:m",
    "SELECT category, count(*) AS movements, sum(amount) AS amount FROM fx_bank WHERE date >= DATE '1996-01-01' AND amount < 0 GROUP BY category",
)
def _(fx):
    return catalog.run_sql(
        fx.spark,
        "SELECT category, count(*) AS movements, sum(amount) AS amount FROM {bank} WHERE date >= ? AND amount < ? GROUP BY category",
        [date(1996, 1, 1), 0],
        bank=fx.bank(),
    )


@query("s10_sql_over_views", "cash_balance:m", "SELECT cash_balance FROM v_cash ORDER BY date DESC LIMIT 1")
def _(fx):
    catalog.register({"cash_flow_daily": series.cash_flow_daily(fx.bank())})
    return catalog.run_sql(fx.spark, "SELECT cash_balance FROM cash_flow_daily ORDER BY date DESC LIMIT 1")


_LOADED = {
    "invoices": ("v_invoices", "invoice_id", "total"),
    "bank_movements": ("v_bank", "movement_id", "amount"),
    "crm_deals": ("v_deals", "deal_id", "expected_amount"),
}


@query(
    "s09_loaded_rows",
    "dataset:s id:s value:m",
    " UNION ALL ".join(f"SELECT '{n}' AS dataset, {k} AS id, {v} AS value FROM {view}" for n, (view, k, v) in _LOADED.items()),
)
def _(fx):
    cleaned = _cleaned(fx)
    folder = fresh_path(fx.spark, "tables")
    sinks.load_tables(fx.spark, {"invoices": cleaned["invoices_clean"].limit(0), "bank_movements": cleaned["bank_clean"]}, folder)
    sinks.load_tables(fx.spark, {"invoices": cleaned["invoices_clean"], "crm_deals": cleaned["crm_deals_clean"]}, folder)
    tables = sinks.open_tables(fx.spark, folder)
    parts = [tables[n].select(F.lit(n).alias("dataset"), F.col(k).alias("id"), F.col(v).alias("value")) for n, (_, k, v) in _LOADED.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "s11_save_alerts",
    "alert_code:s severity:s resolved:i n:i",
    "SELECT 'A5' AS alert_code, 'MEDIUM' AS severity, 0 AS resolved, 2 * count(*) AS n FROM fx_bank WHERE CAST(abs(amount) AS DOUBLE) > 3 * (SELECT CAST(sum(abs(amount)) AS DOUBLE) / count(*) FROM fx_bank)",
)
def _(fx):
    from ledgerflow.operators.alerts import anomalous_movements

    odd = anomalous_movements(fx.bank()).select(
        F.lit("A5").alias("code"), F.lit("MEDIUM").alias("severity"), F.col("movement_id").alias("message"), F.lit(True).alias("triggered")
    )
    folder = fresh_path(fx.spark, "log")
    sinks.save_alerts(fx.spark, odd, folder)
    log = sinks.save_alerts(fx.spark, odd, folder)
    return log.groupBy("alert_code", "severity", "resolved").agg(F.count("*").alias("n"))


@query(
    "s11_repeated_run_logs_once",
    "alert_code:s severity:s message:s resolved:i",
    "SELECT 'A5' AS alert_code, 'MEDIUM' AS severity, movement_id AS message, 0 AS resolved FROM fx_bank WHERE CAST(abs(amount) AS DOUBLE) > 3 * (SELECT CAST(sum(abs(amount)) AS DOUBLE) / count(*) FROM fx_bank)",
)
def _(fx):
    from ledgerflow.operators.alerts import anomalous_movements

    odd = anomalous_movements(fx.bank()).select(
        F.lit("A5").alias("code"), F.lit("MEDIUM").alias("severity"), F.col("movement_id").alias("message"), F.lit(True).alias("triggered")
    )
    folder = fresh_path(fx.spark, "log")
    sinks.save_alerts(fx.spark, odd, folder, token="run-1")
    return sinks.save_alerts(fx.spark, odd, folder, token="run-1")


@query("s12_append_rows", "movement_id:s amount:m", "SELECT movement_id, amount FROM fx_bank UNION ALL SELECT 'M-' || movement_id, amount FROM fx_bank WHERE amount < 0")
def _(fx):
    folder = fresh_path(fx.spark, "appended")
    sinks.append_rows(fx.spark, fx.bank(), "bank_movements", folder)
    more = fx.bank().where(F.col("amount") < 0).withColumn("movement_id", F.concat(F.lit("M-"), "movement_id"))
    return sinks.append_rows(fx.spark, more, "bank_movements", folder)


@query("s13_duplicate_keys", "movement_id:s copies:i", "SELECT movement_id, count(*) AS copies FROM fx_bank_raw GROUP BY movement_id HAVING count(*) > 1")
def _(fx):
    return quality.duplicate_keys(fx.bank_raw(), ["movement_id"])


@query(
    "s13_key_uniqueness",
    "dataset:s repeated:i",
    """SELECT 'invoices' AS dataset, count(*) AS repeated FROM (SELECT invoice_id FROM fx_invoices_raw GROUP BY 1 HAVING count(*) > 1) a
     UNION ALL SELECT 'bank_movements', count(*) FROM (SELECT movement_id FROM fx_bank GROUP BY 1 HAVING count(*) > 1) b
     UNION ALL SELECT 'crm_deals', count(*) FROM (SELECT deal_id FROM fx_deals GROUP BY 1 HAVING count(*) > 1) c
     UNION ALL SELECT 'cash_flow_daily', count(*) FROM (SELECT date FROM v_cash GROUP BY 1 HAVING count(*) > 1) d""",
)
def _(fx):
    from functools import reduce

    from pyspark.sql import DataFrame

    from ledgerflow.schemas import PRIMARY_KEY

    frames = {"invoices": fx.invoices_raw(), "bank_movements": fx.bank(), "crm_deals": fx.deals(), "cash_flow_daily": series.cash_flow_daily(fx.bank())}
    parts = [
        quality.duplicate_keys(df, PRIMARY_KEY[name]).agg(F.count("*").alias("repeated")).select(F.lit(name).alias("dataset"), "repeated")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "s14_json_summary",
    "start:s end:s days:i min_balance:f0 max_balance:f0 mean_balance:f0 std_balance:f0 risk_level:s",
    """SELECT CAST(min(ds) AS VARCHAR) AS start, CAST(max(ds) AS VARCHAR) AS "end", count(*) AS days, min(yhat) AS min_balance, max(yhat) AS max_balance,
     avg(yhat) AS mean_balance, stddev_samp(yhat) AS std_balance, CASE WHEN min(yhat) < 25000 THEN 'ALTO' WHEN min(yhat) < 50000 THEN 'MEDIO' ELSE 'BAJO' END AS risk_level FROM v_fc""",
)
def _(fx):
    path = fresh_path(fx.spark, "forecast_summary.json")
    ahead = _forecast(fx, series.cash_flow_daily(fx.bank()))
    sinks.save_json(sinks.forecast_summary_document(forecast.forecast_summary(ahead), forecast.risk_indicators(ahead)), path)
    return fx.spark.read.json(path).select("forecast_period.*", "statistics.*", "risk_indicators.risk_level")


@query(
    "s14_json_metrics",
    "mae:f0 naive_mae:f0 n_evaluations:i",
    """SELECT avg(abs(y - yhat)) AS mae, (SELECT avg(abs(y - p)) FROM (SELECT y, lag(y) OVER (ORDER BY ds) AS p FROM v_test) t WHERE p IS NOT NULL) AS naive_mae,
     count(*) AS n_evaluations FROM v_pairs""",
)
def _(fx):
    path = fresh_path(fx.spark, "model_metrics.json")
    parts = series.prepare_forecasting(series.cash_flow_daily(fx.bank()))
    ahead = forecast.predict_base(forecast.fit_base(parts["train"]))
    sinks.save_json(sinks.metrics_document(evaluation_report(parts["test"], ahead)), path)
    return fx.spark.read.json(path).select("model_metrics.mae", "benchmark_metrics.naive_mae", "model_metrics.n_evaluations")


@query(
    "s14_json_config",
    "growth:s seasonality_mode:s yearly_order:i weekly_order:i changepoints:i changepoint_prior_scale:f4 interval_level:f4 horizon_days:i days:i",
    """SELECT 'linear' AS growth, 'multiplicative' AS seasonality_mode, 10 AS yearly_order, 3 AS weekly_order, 25 AS changepoints, 0.05 AS changepoint_prior_scale,
     0.80 AS interval_level, 90 AS horizon_days, count(*) AS days FROM v_full""",
)
def _(fx):
    path = fresh_path(fx.spark, "model_config.json")
    sinks.save_json(sinks.config_document(fx.spark, ModelConfig()), path)
    days = series.target_series(series.cash_flow_daily(fx.bank())).agg(F.count("*").alias("days"))
    return attach_stats(fx.spark.read.json(path), days, [])


@query("s15_row_counts", "dataset:s rows:i", _counts({"cash_flow_daily": "v_cash", "forecast": "v_fc", "invoices": "v_invoices", "crm_deals": "v_deals"}))
def _(fx):
    daily = series.cash_flow_daily(fx.bank())
    cleaned = _cleaned(fx)
    return quality.row_counts(
        {"cash_flow_daily": daily, "forecast": _forecast(fx, daily), "invoices": cleaned["invoices_clean"], "crm_deals": cleaned["crm_deals_clean"]}
    )


@query(
    "s16_transformation_log",
    "step:s input:s rows_in:i rows_out:i steps:i",
    "SELECT 'clean' AS step, 'invoices' AS input, (SELECT count(*) FROM fx_invoices_raw) AS rows_in, (SELECT count(*) FROM v_invoices) AS rows_out, 3 AS steps",
)
def _(fx):
    steps = ["standardize_dates", "remove_duplicates", "normalize_status"]
    log = sinks.logged_write(
        fx.invoices_raw(), lambda raw: clean.clean_invoices(raw, AS_OF), "clean", "invoices", fresh_path(fx.spark, "invoices_clean"), steps
    )
    return log.withColumn("steps", F.size("transformations"))
