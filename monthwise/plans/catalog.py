"""Registered queries: one per operator of the build list, on the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  The fixed anchor (``AS_OF``) puts the trailing window on the last eight
months of the ship dates, as described in FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions import formatting as FM
from monthwise.functions.periods import (DEFAULT_RUN_DAYS, local_date, period_key,
                                         previous_month_label)
from monthwise.operators import crosstab as X
from monthwise.operators import gating as G
from monthwise.operators import measures as M
from monthwise.operators import outbox as O
from monthwise.operators import ranking as RK
from monthwise.operators import render as R
from monthwise.operators.window import trailing_months
from monthwise.plans.report import ReportBase, ReportConfig, report_mail, report_sections
from monthwise.session import (apply_session_conf, ensure_checkpoint_dir, materialize,
                               shared_path)
from monthwise.sources import export as E
from monthwise.sources import tables as T
from monthwise.sources.outbox_store import OutboxStore
from monthwise.streaming.drain import drain_once

# Fixed fixture anchor: window 200104..200111 on every scale factor.
AS_OF = dt.date(2001, 11, 15)
N_BACK = 7
TOP_N = 10
OUTBOX_TO = "destinatario"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_session_conf(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapped
    return wrapped


def cfg() -> ReportConfig:
    return ReportConfig(as_of=AS_OF, n_back=N_BACK, top_n=TOP_N)


def base(spark, sf_dir, materialize=False) -> ReportBase:
    """The one-pass labelled aggregate.  Queries that branch off it more than
    once materialize it, so the fact table is scanned once."""
    return ReportBase.from_tables(spark, sf_dir, cfg(), materialize=materialize)


# -- step 1: periods and window ------------------------------------------------------

@query
def trailing_months_q(spark, d):
    rows = T.subscriber_rows(spark, d)
    w = trailing_months(rows, "PERIODO", AS_OF, N_BACK, date_col="l_shipdate")
    return w.select("PERIODO", "TIPO", "SVA_SMS", "Q_LINEAS_SUSCRITAS")


@query
def period_key_q(spark, d):
    li = T.read_table(spark, d, "lineitem")
    return li.groupBy(period_key("l_shipdate").alias("PERIODO")).agg(
        F.count(F.lit(1)).alias("n_rows"))


# -- step 2-3: sums and weighted means -------------------------------------------------

def period_facts(spark, d):
    """The windowed facts without labels: period totals need no dimension."""
    return T.windowed_facts(spark, d, AS_OF, N_BACK)


@query
def sum_by_type(spark, d):
    return M.sum_by_type(period_facts(spark, d), qty="Q")


@query
def sum_by_label_sva(spark, d):
    return base(spark, d).qty_by_label("SVA")


@query
def sum_by_label_smsp(spark, d):
    return base(spark, d).qty_by_label("SMSP")


@query
def weighted_mean_label(spark, d):
    return base(spark, d).mean_by_label("SVA", "error")


@query
def weighted_mean_period(spark, d):
    return M.weighted_mean_by_period(period_facts(spark, d), "SVA", qty="Q")


@query
def weighted_mean_zero_null(spark, d):
    return base(spark, d).mean_by_label("SMSP", "null")


@query
def weighted_mean_rows(spark, d):
    """The weighted mean straight from transaction rows (no pre-aggregation)."""
    rows = trailing_months(T.transaction_rows(spark, d), "PERIODO", AS_OF, N_BACK, "l_shipdate")
    return M.weighted_mean(rows.where(F.col("TIPO") == "SMSP"), ["SVA_SMS", "PERIODO"],
                           zero="null")


def _edge_rows(spark, d):
    """Transactions with the cases that the tables lack: labels of every seventh key
    carry no quantity (zero denominators) and those of every fifth key are NULL."""
    f = T.windowed_facts(spark, d, AS_OF, N_BACK).join(T.label_dim(spark, d), "label_key", "left")
    key = F.col("label_key")
    return f.select("PERIODO", "TIPO", F.when(key % 5 != 0, F.col("SVA_SMS")).alias("SVA_SMS"),
                    F.when(key % 7 == 0, F.lit(0)).otherwise(F.col("Q")).cast("bigint").alias("Q_TRANSACCIONES"),
                    F.when(key % 11 != 0, F.col("MONTO_NETO")).alias("MONTO_NETO"))


@query
def weighted_mean_edges(spark, d):
    """Zero denominators give NULL, NULL amounts leave the numerator only, NULL labels
    are one group."""
    return M.weighted_mean(_edge_rows(spark, d).where(F.col("TIPO") == "SMSP"), ["SVA_SMS", "PERIODO"], zero="null")


@query
def crosstab_edges(spark, d):
    """Quantity table with a NULL label: it has a rank and a zero row, and its
    quantities count in the column totals."""
    rows = _edge_rows(spark, d).where(F.col("TIPO") == "SMSP")
    facts = rows.groupBy("SVA_SMS", "PERIODO").agg(F.sum("Q_TRANSACCIONES").alias("Q"))
    return X.to_long(X.quantity_crosstab(materialize(facts, "edge-facts")))


# -- step 4: ranking -------------------------------------------------------------------

@query
def first_per_key(spark, d):
    """Largest transaction per (label, period).  The pick is associative, so it
    runs first per label *key* (no join, reduced map-side), and only those
    winners are labelled and reduced again."""
    facts = T.windowed_facts(spark, d, AS_OF, N_BACK).select(
        "label_key", "PERIODO", "TIPO", F.col("Q").alias("Q_TRANSACCIONES"), "MONTO_NETO",
        "l_orderkey", "l_linenumber")
    order = ["MONTO_NETO", "l_orderkey", "l_linenumber"]
    per_key = RK.first_per_key(facts, ["label_key", "PERIODO"], order, descending=True)
    labelled = per_key.join(T.label_dim(spark, d), "label_key", "left").drop("label_key")
    best = RK.first_per_key(labelled, ["SVA_SMS", "PERIODO"], order, descending=True)
    return best.select("SVA_SMS", "PERIODO", "TIPO", "Q_TRANSACCIONES", "l_orderkey",
                       "l_linenumber")


@query
def top_n_by_total(spark, d):
    return RK.top_n_by_total(base(spark, d).qty_by_label("SMSP"), n=TOP_N)


@query
def top_n_by_mean(spark, d):
    return RK.top_n_by_mean(base(spark, d).mean_by_label("SMSP", "null"), n=TOP_N)


@query
def rank_labels(spark, d):
    labels = base(spark, d, True).qty_by_label("SVA").select("SVA_SMS").distinct()
    return RK.rank_labels(labels, [F.col("SVA_SMS").asc_nulls_first()])


@query
def rank_orders(spark, d):
    """All orders numbered by price and key over several ranges, with a payload."""
    o = T.read_table(spark, d, "orders").select("o_totalprice", "o_orderkey", "o_orderpriority")
    return RK.rank_labels(o, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], partitions=8)


# -- step 5: grid and totals -------------------------------------------------------------

@query
def dense_grid(spark, d):
    return X.dense_grid(base(spark, d, True).qty_by_label("SMSP"))


@query
def row_totals(spark, d):
    return X.row_totals(X.dense_grid(base(spark, d, True).qty_by_label("SMSP")))


@query
def column_totals(spark, d):
    return X.column_totals(base(spark, d, True).qty_by_label("SVA"))


@query
def column_totals_of_top(spark, d):
    facts = base(spark, d, True).qty_by_label("SMSP")
    return X.column_totals_of_top(facts, RK.top_n_by_total(facts, n=TOP_N))


# -- step 6: the four tables (long rows) ------------------------------------------------------

@query
def crosstab_sva_qty(spark, d):
    return X.to_long(base(spark, d, True).sva_qty())


@query
def crosstab_smsp_qty_top10(spark, d):
    return X.to_long(base(spark, d, True).smsp_qty())


@query
def crosstab_sva_mean(spark, d):
    return X.to_long(base(spark, d, True).sva_mean())


@query
def crosstab_smsp_mean_top10(spark, d):
    return X.to_long(base(spark, d, True).smsp_mean())


@query
def crosstab_narrow_qty(spark, d):
    """SVA quantity table with the narrow label (part type): no missing cells."""
    b = ReportBase.from_tables(spark, d, cfg(), label="part_type", materialize=True)
    return X.to_long(b.sva_qty())


# -- step 7: formatting ----------------------------------------------------------------

@query
def group_digits(spark, d):
    c = T.read_table(spark, d, "customer")
    return c.select("c_custkey", FM.round_int(F.col("c_acctbal") * 100).alias("cents"),
                    FM.group_digits(F.col("c_acctbal") * 100).alias("grouped"),
                    FM.group_digits(F.col("c_acctbal") * 100, prefix="$ ").alias("money"))


@query
def group_digits_legacy(spark, d):
    c = T.read_table(spark, d, "customer")
    return c.select("c_custkey", FM.group_digits(F.col("c_acctbal") * 100, legacy=True)
                    .alias("grouped"))


@query
def stacked_bar_geometry(spark, d):
    return R.stacked_bar_geometry(M.sum_by_type(period_facts(spark, d), qty="Q"))


@query
def kilo_label(spark, d):
    o = T.read_table(spark, d, "orders")
    return o.select("o_orderkey", FM.kilo_label("o_totalprice").alias("kilo"),
                    FM.bar_height("o_totalprice").alias("px"))


@query
def zebra_rows(spark, d):
    labels = base(spark, d, True).qty_by_label("SVA").select("SVA_SMS").distinct()
    ranked = RK.rank_labels(labels, [F.col("SVA_SMS").asc_nulls_first()])
    return ranked.select("SVA_SMS", "rn", FM.zebra("rn").alias("background"))


# -- step 8: ordered text aggregation and report -------------------------------------------

@query
def ordered_concat_cells(spark, d):
    ct = base(spark, d, True).smsp_qty()
    return R.cells_row(ct.grid, ["SVA_SMS", "rn"])


@query
def ordered_concat_header(spark, d):
    periods = base(spark, d).qty_by_label("SVA").select("PERIODO").distinct()
    return R.header_row(periods, first=("SVA",), total=True)


@query
def report_sections_q(spark, d):
    return report_sections(base(spark, d, True))


@query
def report_sections_narrow(spark, d):
    """The rendered sections with the narrow label (part type): few labels, no gaps."""
    b = ReportBase.from_tables(spark, d, cfg(), label="part_type", materialize=True)
    return report_sections(b)


@query
def template_hook(spark, d):
    return report_mail(base(spark, d, True))


# -- step 9: gates -----------------------------------------------------------------------

@query
def has_recent_data(spark, d):
    # Counting rows needs no label: the keyed facts (no dimension join) suffice.
    rows = T.keyed_facts(spark, d)
    return G.recent_row_count(rows, "PERIODO", AS_OF, N_BACK, date_col="l_shipdate")


@query
def calendar_gate(spark, d):
    return G.calendar_gate(T.calendar(spark, d), AS_OF)


@query
def calendar_gate_days(spark, d):
    """The gate on three days: the calendar's last run day (open), its last other day
    (closed) and a day that it lacks."""
    cal = materialize(T.calendar(spark, d), "calendar")
    run = F.col("DAYNAMELONG").isin(list(DEFAULT_RUN_DAYS))
    last = cal.agg(F.max(F.when(run, F.col("DIA_FECHA"))).alias("open"), F.max(F.when(~run, F.col("DIA_FECHA"))).alias("shut"),
                   F.date_add(F.max("DIA_FECHA"), 1).alias("none")).first()
    parts = [G.calendar_gate(cal, day) for day in last]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def gate_schedule(spark, d):
    return G.gate_schedule(T.calendar(spark, d), n_back=N_BACK)


@query
def local_date_offset(spark, d):
    """Outbox dates at the fixed UTC-3 offset (the record date of the original
    trigger), compared with the UTC date, per event day."""
    ev = T.read_table(spark, d, "events")
    return ev.groupBy(F.to_date("ts").alias("utc_date"),
                      local_date("ts", "-03:00").alias("local_date")).agg(
        F.count(F.lit(1)).alias("n_events"))


# -- step 10: outbox ----------------------------------------------------------------------

def _last_day(outbox: DataFrame):
    """The outbox's last date: one value fetched once (like a gate result), so the
    scenario filters below are literals and add no extra scans."""
    return F.lit(outbox.agg(F.max("FECHA")).first()[0])


def _incoming(outbox: DataFrame) -> DataFrame:
    """A re-run of the last day's trigger: one fresh pending row per subject of that day."""
    last = outbox.where(F.col("FECHA") == _last_day(outbox))
    return last.groupBy("SUBJECT").agg(F.max("FECHA").alias("FECHA")).select(
        "FECHA", F.lit(OUTBOX_TO).alias("PARA"), F.lit(None).cast("string").alias("CC"),
        "SUBJECT", F.concat(F.lit("resend "), F.col("SUBJECT")).alias("BODY"),
        F.lit("N").alias("PROCESADO"))


def _delivered(pending_rows: DataFrame, outbox: DataFrame) -> DataFrame:
    """Subjects delivered by an earlier drain: everything pending before the last day."""
    return pending_rows.where(F.col("FECHA") < _last_day(outbox)).select("SUBJECT")


@query
def outbox_row(spark, d):
    mail = report_mail(base(spark, d, True))
    return O.outbox_row(mail, OUTBOX_TO, None, AS_OF)


@query
def replace_by_key(spark, d):
    ob = T.outbox(spark, d)
    return O.replace_by_key(ob, _incoming(ob))


@query
def pending(spark, d):
    return O.pending(T.outbox(spark, d))


@query
def mark_processed(spark, d):
    ob = T.outbox(spark, d)
    return O.mark_processed(ob, _delivered(O.pending(ob), ob))


@query
def outbox_drain(spark, d):
    """Store the outbox, drain its pending rows (delivering what was pending before
    the last day), and return the table afterwards."""
    ob = T.outbox(spark, d)
    store = OutboxStore(spark, shared_path(spark, "drain", "outbox"))
    store.write_all(ob)
    drain_once(store, lambda todo: _delivered(todo, ob))
    return store.read()


@query
def outbox_store_null_dates(spark, d):
    """Persist an outbox of which some rows have no date, replace by subject (some of the
    new rows without a date too), mark what is sent, and read the table back."""
    ob = T.outbox(spark, d)
    ob = ob.withColumn("FECHA", F.when(F.length("BODY") % 4 != 0, F.col("FECHA")))
    store = OutboxStore(spark, shared_path(spark, "null-dates", "outbox"))
    store.write_all(ob)
    again = ob.where(F.substring("SUBJECT", -1, 1) == "3").groupBy("SUBJECT").agg(F.max("FECHA").alias("FECHA")).select(
        F.when(F.substring("SUBJECT", -2, 1) != "1", F.col("FECHA")).alias("FECHA"), F.lit(OUTBOX_TO).alias("PARA"),
        F.lit(None).cast("string").alias("CC"), "SUBJECT", F.concat(F.lit("resend "), F.col("SUBJECT")).alias("BODY"),
        F.lit("N").alias("PROCESADO"))
    store.replace(materialize(again, "null-dates-incoming"))
    store.mark_processed(ob.where(F.substring("SUBJECT", -1, 1).isin("3", "5", "8")).select("SUBJECT"))
    return store.read()


# -- step 11: exports -------------------------------------------------------------------------

@query
def export_csv_roundtrip(spark, d):
    orders = T.read_table(spark, d, "orders")
    path = E.export_csv(orders, shared_path(spark, "export", "orders"))
    return E.read_csv(spark, path, orders.schema)


@query
def export_documents_roundtrip(spark, d):
    """Every text with its quotes, line breaks and padding through CSV and back."""
    docs = T.read_table(spark, d, "documents")
    return E.read_csv(spark, E.export_csv(docs, shared_path(spark, "export", "documents")), docs.schema)


@query
def export_tables_contents(spark, d):
    """All rows of three exported sheets, each as one text of its fields."""
    names = ["region", "nation", "supplier"]
    tables = [(T.read_table(spark, d, n), n.upper()) for n in names]
    done = E.export_tables(spark, tables, shared_path(spark, "export", "contents"), name="Parque", as_of=AS_OF)
    out = None
    for (sheet, path), (df, _) in zip(done, tables):
        back = E.read_csv(spark, path, df.schema)
        one = back.select(F.lit(path.rsplit("/", 2)[1]).alias("folder"), F.lit(sheet).alias("sheet"),
                          F.col(back.columns[0]).cast("bigint").alias("key"), F.col(back.columns[1]).alias("name"),
                          (F.col(back.columns[2]).cast("bigint") if len(back.columns) > 2 else F.lit(None).cast("bigint"))
                          .alias("ref"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def export_tables_counts(spark, d):
    names = ["region", "nation", "supplier"]
    tables = [(T.read_table(spark, d, n), n.upper()) for n in names]
    done = E.export_tables(spark, tables, shared_path(spark, "export", "tables"))
    out = None
    for (sheet, path), (df, _), name in zip(done, tables, names):
        back = E.read_csv(spark, path, df.schema)
        one = back.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(sheet).alias("sheet"), F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query
def previous_month_label_q(spark, d):
    o = T.read_table(spark, d, "orders")
    days = o.select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select("d", previous_month_label("d").alias("label"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from monthwise.plans import catalog_stores  # noqa: F401  (registers its queries)
    rename = {"trailing_months_q": "trailing_months", "period_key_q": "period_key",
              "report_sections_q": "report_sections",
              "previous_month_label_q": "previous_month_label"}
    return {rename.get(k, k): v for k, v in QUERIES.items()}
