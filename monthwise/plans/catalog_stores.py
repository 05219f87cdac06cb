"""Registered queries of the stored forms: fact layouts, maintained month parts, the cube,
exact means and the outbox's key sketch.  Same rules as in ``catalog``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.periods import DEFAULT_RUN_DAYS
from monthwise.operators import crosstab as X
from monthwise.operators import cube as C
from monthwise.operators import measures as M
from monthwise.operators import outbox as O
from monthwise.operators.skew_join import salted_join
from monthwise.plans.catalog import AS_OF, N_BACK, OUTBOX_TO, _edge_rows, cfg, query
from monthwise.plans import sql_functions
from monthwise.plans.report import ReportBase
from monthwise.session import materialize, shared_path
from monthwise.sources import tables as T
from monthwise.sources.bucketed import join_stored, store_bucketed
from monthwise.sources.export_manifest import export_parts, verify_parts
from monthwise.sources.fact_layout import FactLayout
from monthwise.sources.month_parts import MonthParts
from monthwise.sources.outbox_store import OutboxStore
from monthwise.sources.text_sink import read_text, write_text

FACTS_SCHEMA = "PERIODO int, TIPO string, SVA_SMS string, Q bigint, MONTO_NETO decimal(38,4)"
# Lines of this number arrive after the first refresh of the incremental queries.
LATE_LINE = 7
LATE_PERIODS = (200105, 200109)


def _facts(spark, d) -> DataFrame:
    """Facts of all months with their label, and the line number."""
    rows = T.transaction_rows(spark, d)
    return rows.select("PERIODO", "TIPO", "SVA_SMS", F.col("Q_TRANSACCIONES").alias("Q"), "MONTO_NETO", "l_linenumber")


def _maintained(spark, d) -> MonthParts:
    """Month parts summed in two steps: all facts but some late lines of two months, then
    these lines, which change the sums of their months only."""
    facts = FactLayout(spark, shared_path(spark, "layout", "facts"), FACTS_SCHEMA)
    rows = materialize(_facts(spark, d), "layout-rows")
    late = F.col("PERIODO").isin(list(LATE_PERIODS)) & (F.col("l_linenumber") == LATE_LINE)
    facts.append(rows.where(~late))
    parts = MonthParts(spark, shared_path(spark, "layout", "parts"), facts)
    parts.refresh()
    facts.append(rows.where(late))
    parts.refresh()
    return parts


# -- derived tables kept per month ------------------------------------------------------

@query
def month_parts(spark, d):
    """The kept sums of every month after a late arrival."""
    return _maintained(spark, d).read()


@query
def crosstab_sva_qty_from_parts(spark, d):
    """The quantity table from maintained month parts: no fact is read for it."""
    return X.to_long(ReportBase.from_parts(_maintained(spark, d).read(), cfg()).sva_qty())


@query
def crosstab_smsp_mean_from_parts(spark, d):
    return X.to_long(ReportBase.from_parts(_maintained(spark, d).read(), cfg()).smsp_mean())


# -- cube ----------------------------------------------------------------------------------

@query
def cube_quantities(spark, d):
    """Cells, row totals, column totals and grand total in one grouping, with NULL labels."""
    return C.cube_quantities(_edge_rows(spark, d).where(F.col("TIPO") == "SMSP"), value="Q_TRANSACCIONES")


@query
def cube_means(spark, d):
    """Weighted means by cell, label, period and over all, from one grouping."""
    return C.cube_means(_edge_rows(spark, d).where(F.col("TIPO") == "SMSP"), zero="null")


# -- exact means ----------------------------------------------------------------------------

@query
def weighted_mean_exact(spark, d):
    """Means of amounts beyond 2^53 with ties, per order: DOUBLE would lose both."""
    li = T.read_table(spark, d, "lineitem")
    big = ((F.col("l_linenumber") - 4).cast("decimal(20,0)") * F.lit(10 ** 16).cast("decimal(20,0)")
           + F.col("l_linenumber") * F.lit(2) + 1).cast("decimal(20,0)")
    rows = li.select("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, 3).otherwise(1).cast("bigint").alias("q"), big.alias("m"))
    return M.weighted_mean(rows, ["l_orderkey"], "q", "m", out="mean", out_type="bigint")


# -- fact layout -----------------------------------------------------------------------------

def _layout(spark, d) -> FactLayout:
    facts = FactLayout(spark, shared_path(spark, "layout", "gated"), "PERIODO int, TIPO string, label_key bigint, Q bigint", cluster=["label_key"])
    facts.append(T.keyed_facts(spark, d))
    return facts


@query
def layout_gated_window(spark, d):
    """Sums of the window on the calendar's last run day (the gate is open) and last other
    day (shut: no folder is opened)."""
    facts, cal = _layout(spark, d), materialize(T.calendar(spark, d), "calendar")
    run = F.col("DAYNAMELONG").isin(list(DEFAULT_RUN_DAYS))
    last = cal.agg(F.max(F.when(run, F.col("DIA_FECHA"))).alias("open"), F.max(F.when(~run, F.col("DIA_FECHA"))).alias("shut")).first()
    parts = [facts.gated_window(cal, day, N_BACK).groupBy("PERIODO", "TIPO").agg(F.sum("Q").alias("Q"), F.count("*").alias("n_rows"))
             .select(F.lit(name).alias("gate"), "PERIODO", "TIPO", "Q", "n_rows") for name, day in zip(("open", "shut"), last)]
    return parts[0].unionByName(parts[1])


@query
def layout_run_months(spark, d):
    """Sums of the months of which a Monday 31st is known: the calendar prunes the folders."""
    facts, cal = _layout(spark, d), materialize(T.calendar(spark, d), "calendar")
    days = cal.where((F.col("DAYNAMELONG") == DEFAULT_RUN_DAYS[0]) & (F.dayofmonth("DIA_FECHA") == 31))
    return facts.months_of(days).groupBy("PERIODO").agg(F.sum("Q").alias("Q"), F.count("*").alias("n_rows"))


# -- outbox with a key sketch ------------------------------------------------------------------

@query
def outbox_store_by_sketch(spark, d):
    """Replace by subject where the subjects' dates come from the sketch: one row a subject of
    some subjects is moved to a new date, others are marked, and the table is read back."""
    ob = T.outbox(spark, d)
    store = OutboxStore(spark, shared_path(spark, "sketch", "outbox"))
    store.write_all(ob)
    picked = ob.where(F.substring("SUBJECT", -1, 1).isin("4", "7"))
    again = picked.groupBy("SUBJECT").agg(F.max("FECHA").alias("last")).select(
        F.date_add("last", 1).alias("FECHA"), F.lit(OUTBOX_TO).alias("PARA"), F.lit(None).cast("string").alias("CC"), "SUBJECT",
        F.concat(F.lit("moved "), F.col("SUBJECT")).alias("BODY"), F.lit(O.PENDING).alias("PROCESADO"))
    store.replace(again)
    store.mark_processed(ob.where(F.substring("SUBJECT", -1, 1).isin("2", "7")).select("SUBJECT"))
    return store.read()


# -- joins with a dimension -------------------------------------------------------------------

@query
def salted_label_join(spark, d):
    """Row-level labels where one key holds a third of the facts and another third has none."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_orderkey") % 3 == 1, F.col("label_key")).cast("bigint")
    facts = T.keyed_facts(spark, d).select("PERIODO", "Q", "l_orderkey", key.alias("label_key"))
    joined = salted_join(facts, T.label_dim(spark, d), "label_key")
    return joined.groupBy("SVA_SMS", "PERIODO").agg(F.sum("Q").alias("Q"), F.count("*").alias("n_rows"))


@query
def bucketed_label_join(spark, d):
    """Stored month parts by label key joined to the stored dimension, bucket by bucket, and
    the parts of a second measure to both."""
    facts = T.keyed_facts(spark, d)
    parts = facts.groupBy("label_key", "PERIODO").agg(F.sum("Q").alias("Q"), F.sum(F.col("Q") * F.col("MONTO_NETO")).cast("decimal(38,4)").alias("QM"))
    stored = store_bucketed(parts, "label_key", 8, "parts")
    dim = store_bucketed(T.label_dim(spark, d), "label_key", 8, "labels")
    return join_stored(stored, dim).select("SVA_SMS", "PERIODO", "Q", "QM")


# -- ordered text of any size ------------------------------------------------------------------

@query
def ordered_text_parts(spark, d):
    """One fragment per order in price order, stored as consecutive parts: lengths, offsets
    and a checksum of each part."""
    o = T.read_table(spark, d, "orders")
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td>"), F.col("o_orderpriority"), F.lit("</td></tr>"))
    path = write_text(o.select("o_totalprice", "o_orderkey", row.alias("row")), "row",
                      [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], shared_path(spark, "text", "orders"), fanout=100, partitions=8)
    return read_text(spark, path).select("part", "offset", "n_chars", F.md5(F.col("text").cast("binary")).alias("text_md5"))


# -- exports with a manifest --------------------------------------------------------------------

@query
def export_manifest_check(spark, d):
    """All documents as CSV parts of 256 KB at most, read back and held against the manifest."""
    docs = T.read_table(spark, d, "documents")
    path = shared_path(spark, "export", "parts")
    manifest = export_parts(docs, path, max_part_bytes=256 << 10)
    checked = verify_parts(spark, path, docs.schema).join(manifest.select("part", "n_bytes"), "part")
    return checked.groupBy("status").agg(F.sum("n_rows").alias("n_rows"), F.sum("found_rows").alias("found_rows"),
                                         F.max((F.col("n_bytes") <= 256 << 10).cast("int")).alias("bounded"))


# -- SQL table functions -------------------------------------------------------------------------

def _sql(spark, d, call: str) -> DataFrame:
    """The functions over a view of their own, so that two calls do not share one."""
    view = f"monthwise_rows_{abs(hash(d)) % 10 ** 8}"
    T.subscriber_rows(spark, d).createOrReplaceTempView(view)
    sql_functions.register(spark, view)
    return spark.sql(call.format(day=f"DATE'{AS_OF.isoformat()}', {N_BACK}"))


@query
def sql_crosstab(spark, d):
    return _sql(spark, d, "SELECT * FROM monthwise_crosstab('SVA', {day})")


@query
def sql_grid(spark, d):
    return _sql(spark, d, "SELECT * FROM monthwise_grid('SMSP', {day})")


@query
def sql_sum_by_type(spark, d):
    return _sql(spark, d, "SELECT * FROM monthwise_sum_by_type({day})")
