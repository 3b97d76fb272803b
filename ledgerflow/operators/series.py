"""Daily series: aggregation, densifying, gap filling, features and splits.

Ledgers are reduced to one row per series and day first; every ordered window below runs on that
day grain, where a series has at most one row per calendar day however many movements it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.config import INDICATORS, MONEY, SEASONAL_FACTOR, TOTAL
from ledgerflow.functions.dates import first_weekday, month_start
from ledgerflow.functions.keyed import attach_stats, by_series, join_series
from ledgerflow.functions.measures import literal_map
from ledgerflow.operators.ordered import running_totals

FLOWS = ["net_cash", "cash_inflow", "cash_outflow", "transaction_count"]


def closing_order(bank: DataFrame) -> str:
    """The load sequence where the ledger has a numeric one, else the movement id.

    A fixed-width order keeps the daily aggregation a hash aggregation; text would sort every input row.
    """
    kinds = dict(bank.dtypes)
    numeric = kinds.get("load_seq", "").startswith(("bigint", "int", "decimal"))
    return "load_seq" if numeric else "movement_id"


def daily_totals(bank: DataFrame, keys: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Per series and day: net amount, closing balance (last non-null in order), movement count.

    Gross sums ride along in the same aggregate.
    """
    amount = F.col("amount")
    order = order or closing_order(bank)
    nothing = F.lit(0).cast(TOTAL)
    return bank.groupBy(*keys, "date").agg(
        F.coalesce(F.sum("amount").cast(TOTAL), nothing).alias("net_cash"),
        F.max_by("balance_after", F.when(F.col("balance_after").isNotNull(), F.col(order))).alias("cash_balance"),
        F.count("movement_id").alias("transaction_count"),
        F.coalesce(F.sum(F.when(amount > 0, amount)).cast(TOTAL), nothing).alias("gross_inflow"),
        F.coalesce(F.sum(F.when(amount < 0, -amount)).cast(TOTAL), nothing).alias("gross_outflow"),
    )


def split_flows(daily: DataFrame, basis: str = "net") -> DataFrame:
    """``net``: positive and negative part of the daily net. ``gross``: sums of the movements."""
    if basis == "gross":
        flows = {"cash_inflow": F.col("gross_inflow"), "cash_outflow": F.col("gross_outflow")}
    elif basis == "net":
        zero = F.lit(0).cast(TOTAL)
        flows = {
            "cash_inflow": F.greatest("net_cash", zero),
            "cash_outflow": F.greatest(-F.col("net_cash"), zero),
        }
    else:
        raise ValueError(f"unknown basis: {basis}")
    return daily.withColumns(flows).drop("gross_inflow", "gross_outflow")


def densify(daily: DataFrame, keys: Sequence[str] = (), day: str = "date") -> DataFrame:
    """One row for each calendar day from first to last; new days have nulls.

    Each row expands over the gap up to the next one, so there is no spine table and no join.
    """
    following = F.lead(day).over(by_series(keys, day))
    until = F.greatest(F.coalesce(F.date_sub("__next", 1), F.col(day)), F.col(day))
    spread = daily.withColumn("__next", following).withColumn("__day", F.explode(F.sequence(F.col(day), until)))
    own = F.col("__day") == F.col(day)
    columns = [
        F.col("__day").alias(c) if c == day else F.col(c) if c in keys else F.when(own, F.col(c)).alias(c)
        for c in daily.columns
    ]
    return spread.select(*columns)


def interpolate_linear(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), day: str = "date") -> DataFrame:
    """Linear by row position inside, last value after the end, null before the first value.

    The look-ahead is a look-back over the reversed order, which stays linear in the series length.
    """
    forward = by_series(keys, F.col(day).asc())
    backward = by_series(keys, F.col(day).desc())
    so_far = Window.unboundedPreceding, Window.currentRow
    numbered = df.withColumn("__pos", F.row_number().over(forward))

    def known(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(value.isNotNull(), F.struct(value.alias("v"), F.col("__pos").alias("p")))

    framed = numbered.withColumns(
        {f"__before_{c}": F.last(known(c), ignorenulls=True).over(forward.rowsBetween(*so_far)) for c in columns}
    ).withColumns(
        {f"__after_{c}": F.last(known(c), ignorenulls=True).over(backward.rowsBetween(*so_far)) for c in columns}
    )

    def filled(c: str) -> Column:
        before, after = F.col(f"__before_{c}"), F.col(f"__after_{c}")
        step = (after["v"] - before["v"]) * (F.col("__pos") - before["p"]) / (after["p"] - before["p"])
        return (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(before.isNotNull() & after.isNotNull(), before["v"] + step)
            .otherwise(before["v"])
        )

    return framed.select(*[filled(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def zero_fill(df: DataFrame, columns: Sequence[str] = FLOWS) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns if c in df.columns}
    )


def cash_flow_daily(
    bank: DataFrame, keys: Sequence[str] = (), basis: str = "net", order: str | None = None
) -> DataFrame:
    """The dense daily cash-flow series of each account."""
    daily = split_flows(daily_totals(bank, keys, order), basis)
    dense = interpolate_linear(densify(daily, keys), ["cash_balance"], keys)
    return zero_fill(dense).select(
        *keys, "date", "cash_balance", "cash_inflow", "cash_outflow", "net_cash", "transaction_count"
    )


def running_balance(
    movements: DataFrame,
    keys: Sequence[str] = (),
    opening=0,
    order: Sequence[str] = ("date", "movement_id"),
    name: str = "balance_after",
    block: Sequence[str] = (),
) -> DataFrame:
    """Opening balance plus the cumulative amount, in order; any account may hold most rows.

    ``block``: see ``ordered``; the movements are then a stored table.
    """
    summed = running_totals(movements, keys, order, {name: F.col("amount")}, block)
    return summed.withColumn(name, (F.lit(opening).cast(MONEY) + F.col(name)).cast(MONEY))


def target_series(daily: DataFrame, target: str = "cash_balance", keys: Sequence[str] = ()) -> DataFrame:
    """``ds, y`` with missing targets dropped."""
    return daily.select(*keys, F.col("date").alias("ds"), F.col(target).cast("double").alias("y")).where(
        F.col("y").isNotNull()
    )


def calendar_features(df: DataFrame, day: str = "ds") -> DataFrame:
    ds = F.col(day)
    return df.withColumns(
        {
            "day_of_week": F.weekday(ds),
            "month": F.month(ds),
            "quarter": F.quarter(ds),
            "day_of_month": F.day(ds),
            "week_of_year": F.weekofyear(ds),
            "is_month_end": (F.last_day(ds) == ds).cast("int"),
            "is_month_start": (F.day(ds) == 1).cast("int"),
        }
    )


def attach_flows(df: DataFrame, daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    flows = daily.select(*keys, F.col("date").alias("ds"), "cash_inflow", "cash_outflow", "net_cash")
    return join_series(df, flows, keys, "left", ["ds"])


def factors_wide(factors: DataFrame, indicators: Sequence[str] = tuple(INDICATORS)) -> DataFrame:
    """Long indicators to one column each, one row per day; listed values avoid a pivot pre-scan."""
    return factors.groupBy("date").pivot("indicator", list(indicators)).agg(F.min_by("value", "source"))


def merge_factors(
    df: DataFrame, wide: DataFrame | None, indicators: Sequence[str] = tuple(INDICATORS), keys: Sequence[str] = ()
) -> DataFrame:
    """Left-join the factors on the day and fill their gaps; without factors, pass through."""
    if wide is None:
        return df
    joined = join_series(df, wide.withColumnRenamed("date", "ds"), [], "left", ["ds"])
    return interpolate_linear(joined, indicators, keys, "ds")


def split_train_test(df: DataFrame, keys: Sequence[str] = (), test_size: float = 0.2, day: str = "ds") -> DataFrame:
    """Flag the first ``int(n * (1 - test_size))`` rows of each series as training rows."""
    size = F.count("*").over(Window.partitionBy(*keys))
    position = F.row_number().over(by_series(keys, day))
    cut = F.floor(size * F.lit(1.0 - test_size))
    return df.withColumn("is_train", position <= cut)


def prepare_forecasting(
    daily: DataFrame,
    factors: DataFrame | None = None,
    target: str = "cash_balance",
    keys: Sequence[str] = (),
    test_size: float = 0.2,
) -> dict[str, DataFrame]:
    """Target, calendar, flows and factors; full, train and test frames."""
    featured = attach_flows(calendar_features(target_series(daily, target, keys)), daily, keys)
    wide = factors_wide(factors) if factors is not None else None
    flagged = split_train_test(merge_factors(featured, wide, keys=keys), keys, test_size)
    return {
        "full": flagged.drop("is_train"),
        "train": flagged.where("is_train").drop("is_train"),
        "test": flagged.where("NOT is_train").drop("is_train"),
        "flagged": flagged,
    }


def rolling_mean(df: DataFrame, column: str, rows: int = 7, keys: Sequence[str] = (), day: str = "ds") -> DataFrame:
    frame = by_series(keys, day).rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn(f"rolling_mean_{rows}d", F.avg(F.col(column)).over(frame))


def collections_from_invoices(invoices: DataFrame) -> DataFrame:
    """One incoming movement per paid invoice."""
    return invoices.where(F.col("paid_date").isNotNull()).select(
        F.concat(F.lit("I-"), "invoice_id").alias("movement_id"),
        F.col("paid_date").alias("date"),
        F.col("total").alias("amount"),
        F.concat(F.lit("Cobro factura "), "invoice_id", F.lit(" - "), "customer_name").alias("description"),
        F.lit("invoice_payment").alias("category"),
        F.col("invoice_id").alias("reference"),
    )


def ledger_union(*sources: DataFrame) -> DataFrame:
    """One ledger from several movement sources; columns a source lacks become null."""
    ledger = sources[0]
    for source in sources[1:]:
        ledger = ledger.unionByName(source, allowMissingColumns=True)
    return ledger


def date_bounds(df: DataFrame, day: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def payroll_calendar(bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First weekday of each month inside the bounds."""
    months = bounds.where(F.col("first_day").isNotNull()).withColumn(
        "month_start",
        F.explode(F.sequence(month_start(F.col("first_day")), F.col("last_day"), F.expr("INTERVAL 1 MONTH"))),
    )
    return (
        months.withColumn("payroll_date", first_weekday(F.col("month_start")))
        .where(F.col("payroll_date").between(F.col("first_day"), F.col("last_day")))
        .select(*keys, "month_start", "payroll_date")
    )


def every_n_days(bounds: DataFrame, days: int, keys: Sequence[str] = (), months: Sequence[int] = ()) -> DataFrame:
    """Every n-th day from the first one, optionally only in certain months."""
    dates = bounds.where(F.col("first_day").isNotNull()).select(
        *keys,
        F.explode(F.sequence("first_day", "last_day", F.expr(f"INTERVAL {int(days)} DAY"))).alias("date"),
    )
    return dates.where(F.month("date").isin(list(months))) if months else dates


def day_of_month(bounds: DataFrame, day: int, keys: Sequence[str] = (), months: Sequence[int] = ()) -> DataFrame:
    """The given day of each month inside the bounds, optionally only in certain months."""
    starts = bounds.where(F.col("first_day").isNotNull()).withColumn(
        "__m",
        F.explode(F.sequence(month_start(F.col("first_day")), F.col("last_day"), F.expr("INTERVAL 1 MONTH"))),
    )
    dates = (
        starts.withColumn("date", F.date_add("__m", day - 1))
        .where((F.month("date") == F.month("__m")) & F.col("date").between(F.col("first_day"), F.col("last_day")))
        .select(*keys, "date")
    )
    return dates.where(F.month("date").isin(list(months))) if months else dates


def vat_due_dates(bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The 20th of the month after each calendar quarter."""
    return day_of_month(bounds, 20, keys, months=[1, 4, 7, 10])


def recurring_dates(bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The company's recurring payments as one schedule of (rule, date)."""
    rules = {
        "supplier_run": every_n_days(bounds, 30, keys),
        "electricity": every_n_days(bounds, 30, keys, months=[2, 5, 8, 11]),
        "gas": every_n_days(bounds, 30, keys, months=[3, 6, 9, 12]),
        "social_security": day_of_month(bounds, 28, keys),
        "rent": day_of_month(bounds, 15, keys),
    }
    return ledger_union(*[dates.withColumn("rule", F.lit(rule)) for rule, dates in rules.items()])


def seasonal_factor(df: DataFrame, day: str, factors: dict[int, float] = SEASONAL_FACTOR) -> DataFrame:
    return df.withColumn("seasonal_factor", literal_map(factors)[F.month(day)])


def latest_day(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys).agg(F.max("date").alias("today"))


def last_days(daily: DataFrame, days: int = 30, keys: Sequence[str] = (), today: date | None = None) -> DataFrame:
    """Rows with ``date >= today - days``; today is the series' last day unless given."""
    if today is not None:
        return daily.where(F.col("date") >= F.date_sub(F.lit(today), days))
    return (
        attach_stats(daily, latest_day(daily, keys), keys)
        .where(F.col("date") >= F.date_sub("today", days))
        .drop("today")
    )
