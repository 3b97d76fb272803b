"""The cash-flow datasets derived from the TPC-H-style tables of a test-data folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.config import INITIAL_BALANCE, MONEY, STAGE_PROBABILITY
from ledgerflow.functions.measures import literal_map
from ledgerflow.operators.ordered import dealt, running_totals
from ledgerflow.operators.series import running_balance
from ledgerflow.sources.events import event_ledger
from ledgerflow.sources.shared import store, stored_once


#: Columns of a movement before its balance and number.
MOVEMENT = ["movement_id", "date", "amount", "category", "reference"]


def _str(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _copies(key: Column, first: int = 0) -> Column:
    """Second copy of some rows, as dirt: copy numbers to explode."""
    once = F.array(F.lit(first))
    return F.explode(F.when(key, F.array(F.lit(first), F.lit(first + 1))).otherwise(once))


class Fixtures:
    """Lazy views over one folder; only the two balance ledgers are stored, once per application."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- invoices ------------------------------------------------------------------------

    def invoices_base(self) -> DataFrame:
        priority = F.substring("o_orderpriority", 1, 1)
        cycle = F.when(priority == "1", 15).when(priority == "2", 30).when(priority == "3", 45).when(priority == "4", 60)
        status = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "P", "pending")
        price = F.col("o_totalprice")
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("d"),
            cycle.otherwise(90).alias("cyc"),
            status.otherwise("overdue").alias("status"),
            price.cast(MONEY).alias("total"),
            (price / 1.21).cast(MONEY).alias("amount"),
        )

    def invoices_raw(self) -> DataFrame:
        k, d, cyc = F.col("o_orderkey"), F.col("d"), F.col("cyc")
        paid_on = F.date_add(d, (k % cyc).cast("int"))
        method = F.when(k % 4 == 0, "transfer").when(k % 4 == 1, "confirming").when(k % 4 == 2, "receipt")
        return self.invoices_base().select(
            F.concat(F.lit("INV-"), _str(k)).alias("invoice_id"),
            _str(d).alias("invoice_date"),
            _str(F.when(k % 101 == 0, F.date_sub(d, 1)).otherwise(F.date_add(d, cyc))).alias("due_date"),
            F.concat(F.lit("C"), _str("o_custkey")).alias("customer_id"),
            F.concat(F.lit("Customer "), _str("o_custkey")).alias("customer_name"),
            _str("amount").alias("amount"),
            _str((F.col("total") - F.col("amount")).cast(MONEY)).alias("vat"),
            F.when(k % 97 == 0, "n/a").otherwise(_str("total")).alias("total"),
            F.when(k % 89 != 0, F.col("status")).alias("status"),
            F.when(k % 83 == 0, "not-a-date").when(F.col("status") == "paid", _str(paid_on)).alias("paid_date"),
            method.alias("payment_method"),
            F.when(k % 10 < 9, "product").otherwise("service").alias("category"),
            _copies(k % 50 == 0, first=1).alias("load_seq"),
        )

    # ---- bank ------------------------------------------------------------------------------

    def bank_base(self) -> DataFrame:
        k = F.col("o_orderkey")
        late = F.when(k % 71 == 0, 100).otherwise(0)
        collections = (
            self.invoices_base()
            .where((F.col("status") == "paid") & (k % 67 != 0))
            .select(
                F.concat(F.lit("I"), _str(k)).alias("movement_id"),
                F.date_add("d", (k % F.col("cyc")).cast("int") + late).alias("date"),
                F.col("total").alias("amount"),
                F.lit("invoice_payment").alias("category"),
                F.concat(F.lit("INV-"), _str(k)).alias("reference"),
            )
        )
        key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        kind = F.col("l_suppkey") % 10
        price = F.col("l_extendedprice")
        signed = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
        payments = (
            dealt(self.table("lineitem").select(*key, "l_shipdate", signed.alias("paid")), key)
            .groupBy(*key)
            .agg(F.min("l_shipdate").alias("l_shipdate"), F.sum("paid").alias("paid"))
            .select(
                F.concat_ws("-", F.lit("S"), *[_str(c) for c in key]).alias("movement_id"),
                F.col("l_shipdate").cast("date").alias("date"),
                (-F.col("paid").cast(MONEY)).cast(MONEY).alias("amount"),
                F.when(kind == 0, "salary").when(kind == 1, "tax").when(kind == 2, "utility").otherwise("supplier").alias("category"),
                F.lit(None).cast("string").alias("reference"),
            )
        )
        return collections.unionByName(payments)

    def _summed_movements(self) -> DataFrame:
        base = store(self.bank_base(), "movements")
        # a row stands at its day for the balance and at the day it is seen for the number: two halves if these days differ
        half = lambda day, paid, seen: F.struct(day.alias("day"), F.lit(paid).alias("paid"), F.lit(seen).alias("seen"))
        day = F.col("date")
        at = F.when(F.col("movement_id").like("%77"), F.array(half(day, True, False), half(F.date_add(day, 30), False, True))).otherwise(F.array(half(day, True, True)))
        halves = base.select("*", F.inline(at))
        totals = {"balance_after": F.when(F.col("paid"), F.col("amount")), "load_seq": F.when(F.col("seen"), F.lit(1).cast("bigint"))}
        balance = (F.lit(INITIAL_BALANCE).cast(MONEY) + F.col("balance_after")).cast(MONEY)
        summed = running_totals(halves, [], ["day", "movement_id"], totals, ["day"]).drop("day")
        return summed.withColumns({"balance_after": F.when(F.col("paid"), balance), "load_seq": F.when(F.col("seen"), F.col("load_seq"))})

    def _bank_halves(self) -> DataFrame:
        return stored_once(self.spark, ("bank_halves", self.folder), self._summed_movements)

    def _joined_halves(self) -> DataFrame:
        halves = self._bank_halves().where("NOT (paid AND seen)")
        totals = ["balance_after", "load_seq"]
        pairs = halves.groupBy(*MOVEMENT).agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in totals])
        return pairs.select(*MOVEMENT, F.inline(F.arrays_zip(*totals)))

    def _bank_ledger(self) -> DataFrame:
        """The sums are stored once, and the few movements whose halves are put together again beside them: neither is written or summed twice."""
        joined = stored_once(self.spark, ("bank_joined", self.folder), self._joined_halves)
        return self._bank_halves().where("paid AND seen").select(*joined.columns).unionByName(joined)

    def bank(self) -> DataFrame:
        stored = self._bank_ledger()
        return stored.select(
            "movement_id",
            "date",
            F.col("date").alias("value_date"),
            F.when(F.length("movement_id") % 5 != 0, F.concat(F.lit("mov "), "movement_id")).alias("description"),
            "amount",
            "balance_after",
            "category",
            "reference",
            F.lit("ES7621000000001234567890").alias("bank_account"),
            "load_seq",
        )

    def _account_ledger(self) -> DataFrame:
        split = self.bank().select(
            "movement_id",
            "date",
            "amount",
            "category",
            "reference",
            "load_seq",
            F.concat(F.lit("ACC-"), F.right("movement_id", F.lit(1))).alias("bank_account"),
        )
        return running_balance(split, ["bank_account"], opening=INITIAL_BALANCE // 10, block=["date"])

    def bank_multi(self) -> DataFrame:
        return stored_once(self.spark, ("bank_multi", self.folder), self._account_ledger)

    def bank_raw(self) -> DataFrame:
        m = F.col("movement_id")
        return (
            self.bank()
            .withColumn("copy", _copies(m.like("%23")))
            .select(
                "movement_id",
                _str("date").alias("date"),
                F.when(m.like("%8"), "bad").otherwise(_str("value_date")).alias("value_date"),
                "description",
                F.when(m.like("%51"), "n/a").otherwise(_str("amount")).alias("amount"),
                _str("balance_after").alias("balance_after"),
                F.when(~m.like("%9"), F.col("category")).alias("category"),
                "reference",
                "bank_account",
                (F.col("load_seq") * 2 + F.col("copy")).alias("load_seq"),
            )
        )

    # ---- deals, factors, staff, suppliers, events ------------------------------------------

    def deals(self) -> DataFrame:
        k, d = F.col("o_orderkey"), F.col("d")
        turn = F.floor(k / 5).cast("int") % 6
        stages = list(STAGE_PROBABILITY)
        stage = reduce(lambda e, i: e.when(turn == i, stages[i]), range(1, 5), F.when(turn == 0, stages[0])).otherwise(stages[5])
        base = (
            self.invoices_base()
            .select(
                k.alias("k"),
                F.concat(F.lit("DEAL-"), _str(k)).alias("deal_id"),
                F.concat(F.lit("C"), _str("o_custkey")).alias("customer_id"),
                stage.alias("stage"),
                F.col("amount").alias("expected_amount"),
                F.date_sub(d, 75).alias("created_date"),
                F.when(k % 7 < 2, F.date_add(d, 10)).otherwise(F.date_sub(d, 40)).alias("expected_close"),
            )
        )
        closed = F.col("stage").isin("won", "lost")
        closed_on = F.date_sub("expected_close", (F.col("k") % 15).cast("int"))
        return base.select(
            "deal_id",
            F.concat(F.lit("Deal "), "deal_id").alias("deal_name"),
            "customer_id",
            F.concat(F.lit("Customer "), F.expr("substr(customer_id, 2)")).alias("customer_name"),
            "stage",
            literal_map(STAGE_PROBABILITY)[F.col("stage")].alias("probability"),
            "expected_amount",
            "created_date",
            F.when(F.col("k") % 41 != 0, F.col("expected_close")).alias("expected_close"),
            F.when(closed | (F.col("k") % 205 == 0), closed_on).alias("actual_close"),
            F.when(closed, closed_on).alias("closed_date"),
        )

    def deals_raw(self) -> DataFrame:
        deal = F.col("deal_id")
        return self.deals().select(
            "deal_id",
            "deal_name",
            "customer_id",
            "customer_name",
            F.when(~deal.like("%15"), F.col("stage")).alias("stage"),
            F.when(deal.like("%25"), "?").otherwise(_str("probability")).alias("probability"),
            F.when(deal.like("%35"), "n/a").otherwise(_str("expected_amount")).alias("expected_amount"),
            *[_str(c).alias(c) for c in ("created_date", "expected_close", "actual_close", "closed_date")],
        )

    def factors(self) -> DataFrame:
        lines = self.table("lineitem").select(
            F.trunc(F.col("l_shipdate").cast("date"), "month").alias("date"), "l_tax", "l_discount", "l_quantity"
        )
        wide = lines.groupBy("date").agg(
            F.round(F.avg("l_tax") * 100, 4).alias("interest_rate"),
            F.round(F.avg("l_discount") * 100, 4).alias("inflation"),
            F.round(F.avg("l_quantity") / 10, 4).alias("sector_growth"),
        )
        long = wide.unpivot(["date"], ["interest_rate", "inflation", "sector_growth"], "indicator", "value")
        source = literal_map({"interest_rate": "bank_spain", "inflation": "ine", "sector_growth": "market"})
        return long.withColumn("source", source[F.col("indicator")])

    def employees_raw(self) -> DataFrame:
        k, pay = F.col("c_custkey"), F.abs("c_acctbal")
        return self.table("customer").select(
            F.concat(F.lit("E"), _str(k)).alias("employee_id"),
            F.col("c_name").alias("name"),
            F.when(k % 23 != 0, F.col("c_mktsegment")).alias("department"),
            F.when(k % 10 == 0, "temporary").when(k % 29 != 0, "permanent").alias("contract_type"),
            F.when(k % 31 == 0, "x").otherwise(_str(pay.cast(MONEY))).alias("salary"),
            _str((pay * 0.32).cast(MONEY)).alias("ss_contribution"),
            F.when(k % 37 == 0, "unknown").otherwise("2020-01-15").alias("start_date"),
        )

    def suppliers_raw(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            F.concat(F.lit("S"), _str(k)).alias("supplier_id"),
            F.col("s_name").alias("name"),
            F.when(k % 7 != 0, "raw_material").alias("category"),
            F.when(k % 9 == 0, "net").otherwise(_str(15 * (1 + k % 6))).alias("payment_cycle"),
            _str(F.col("s_acctbal").cast(MONEY)).alias("typical_amount"),
        )

    def event_ledger(self) -> DataFrame:
        return event_ledger(self.table("events"))

    def raw(self) -> dict[str, DataFrame]:
        return {
            "invoices": self.invoices_raw(),
            "bank_movements": self.bank_raw(),
            "crm_deals": self.deals_raw(),
            "employees": self.employees_raw(),
            "suppliers": self.suppliers_raw(),
            "external_factors": self.factors(),
        }
