"""The subscriber report as one Spark plan per fact table.

``ReportBase`` holds the only two aggregations that touch the fact tables:
subscribers summed per (period, type, label) and transactions reduced to the
additive parts ``SUM(q)`` and ``SUM(q*m)`` per (period, type, label).  Both are
written as Parquet under the shared checkpoint folder, which cuts the lineage back to the
large scans; every section (chart, four tables, totals, top-n) then works on
these label-sized parts.  The original ran four scans of each fact table.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.periods import as_date, dd_mm_yyyy, yyyymmdd
from monthwise.operators import crosstab as X
from monthwise.operators import measures as M
from monthwise.operators import ranking as RK
from monthwise.operators import render as R
from monthwise.operators.window import trailing_months
from monthwise.session import materialize, release
from monthwise.sources import tables as T

# Section titles, totals captions and subject of the report.
TITLE_SVA_QTY = "Detalle SVA por Tipo"
TITLE_SMSP_QTY = "Top 10 Suscripciones SMSP"
TITLE_SVA_MEAN = "Ticket promedio por Tipo"
TITLE_SMSP_MEAN = "Top 10 Ticket promedio SMSP"
CAPTION_TOTAL = "Total"
CAPTION_TOTAL_TOP = "Total Top 10"
CAPTION_MEAN = "Ticket promedio"
REPORT_TITLE = "Reporte Parque Suscriptores"
SUBJECT_PREFIX = "[BA] Reporte Parque Suscriptores ["
SUBJECT_SUFFIX = "]"


@dataclass
class ReportConfig:
    as_of: dt.date | str | None = None
    n_back: int = 7
    top_n: int = 10
    sva: str = "SVA"
    smsp: str = "SMSP"
    theme: R.Theme = field(default_factory=R.Theme)
    intro: str = "<p>Hola,</p>"
    outro: str = "<p>Saludos cordiales,</p>"
    button: str = ""
    chart_title: str = "Suscriptores por mes"

    def as_of_date(self) -> dt.date:
        d = as_date(self.as_of)
        return d if d is not None else dt.datetime.now(dt.timezone.utc).date()

    def frozen(self) -> "ReportConfig":
        """The same settings with the day fixed: gates, window, subject and date then
        share one clock, also past midnight."""
        return replace(self, as_of=self.as_of_date())


@dataclass
class ReportBase:
    """subs: PERIODO, TIPO, SVA_SMS, Q.  trx: PERIODO, TIPO, SVA_SMS, Q, QM."""
    subs: DataFrame
    trx: DataFrame
    cfg: ReportConfig

    @staticmethod
    def materialize(df: DataFrame) -> DataFrame:
        return materialize(df, "report-base")

    @classmethod
    def from_rows(cls, subscribers: DataFrame, transactions: DataFrame, cfg: ReportConfig,
                  materialize: bool = True) -> "ReportBase":
        """From tables in the original layout (label column in the fact table)."""
        cfg = cfg.frozen()
        s = trailing_months(subscribers, "PERIODO", cfg.as_of, cfg.n_back)
        s = s.groupBy("PERIODO", "TIPO", "SVA_SMS").agg(F.sum("Q_LINEAS_SUSCRITAS").alias("Q"))
        t = trailing_months(transactions, "PERIODO", cfg.as_of, cfg.n_back)
        t = t.groupBy("PERIODO", "TIPO", "SVA_SMS").agg(
            F.sum("Q_TRANSACCIONES").alias("Q"),
            F.sum(F.col("Q_TRANSACCIONES") * F.col("MONTO_NETO")).alias("QM"))
        if materialize:
            # two independent scans: submit both jobs at once
            with ThreadPoolExecutor(max_workers=2) as pool:
                s, t = pool.map(cls.materialize, [s, t])
        return cls(s, t, cfg)

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, cfg: ReportConfig,
                    label: str = "supplier", materialize: bool = True) -> "ReportBase":
        """From the driver's tables: one windowed scan of ``lineitem`` with eager
        aggregation before the label join; both inputs come from that one pass."""
        cfg = cfg.frozen()
        facts = T.windowed_facts(spark, sf_dir, cfg.as_of, cfg.n_back, label)
        parts = T.labelled_parts(facts, T.label_dim(spark, sf_dir, label), with_amount=True)
        if materialize:
            parts = cls.materialize(parts)
        base = cls(parts.select("PERIODO", "TIPO", "SVA_SMS", "Q"), parts, cfg)  # trx holds the path
        base._one_source = True
        return base

    @classmethod
    def from_parts(cls, parts: DataFrame, cfg: ReportConfig, trx: DataFrame | None = None) -> "ReportBase":
        """From maintained month parts (``MonthParts.read()``): the window reads the kept
        sums of its months and no facts.  ``trx``: the parts of the transactions, if these are
        a table of their own."""
        cfg = cfg.frozen()
        parts = trailing_months(parts, "PERIODO", cfg.as_of, cfg.n_back)
        means = parts if trx is None else trailing_months(trx, "PERIODO", cfg.as_of, cfg.n_back)
        base = cls(parts.select("PERIODO", "TIPO", "SVA_SMS", "Q"), means, cfg)
        base._one_source = trx is None
        return base

    def release(self) -> None:
        """Delete the materialized aggregates (call when the report is written)."""
        for df in {id(self.subs): self.subs, id(self.trx): self.trx}.values():
            release(df)

    def periods(self, which: str, type_value: str) -> list:
        """Sorted periods of one of the report's two types in the subscriber or
        transaction parts (one value for a month), fetched once per base."""
        cache = self.__dict__.setdefault("_periods", {})
        if self.__dict__.get("_one_source"):
            which = "trx"          # subs is a projection of the same parts
        if which not in cache:
            df = self.subs if which == "subs" else self.trx
            rows = df.where(F.col("TIPO").isin(self.cfg.sva, self.cfg.smsp) & F.col("PERIODO").isNotNull()) \
                .select("TIPO", "PERIODO").distinct().collect()
            cache[which] = {t: sorted(p for x, p in rows if x == t) for t in (self.cfg.sva, self.cfg.smsp)}
        return cache[which].get(type_value, [])

    # -- measures over the parts ------------------------------------------------
    def by_type(self) -> DataFrame:
        return M.sum_by_type(self.subs, qty="Q")

    def qty_by_label(self, type_value: str) -> DataFrame:
        return M.sum_by_label(self.subs, type_value, qty="Q")

    def mean_by_label(self, type_value: str, zero: str) -> DataFrame:
        t = self.trx.where(F.col("TIPO") == type_value).select(
            "SVA_SMS", "PERIODO", F.col("Q").alias(M.Q_SUM), F.col("QM").alias(M.QM_SUM))
        return M.mean_from_parts(t, ["SVA_SMS", "PERIODO"], zero=zero)

    def mean_by_period(self, type_value: str, zero: str) -> DataFrame:
        t = self.trx.where(F.col("TIPO") == type_value).select(
            "PERIODO", F.col("Q").alias(M.Q_SUM), F.col("QM").alias(M.QM_SUM))
        return M.mean_from_parts(t, ["PERIODO"], zero=zero)

    # -- the four tables ------------------------------------------------------------
    def sva_qty(self) -> X.Crosstab:
        return X.quantity_crosstab(self.qty_by_label(self.cfg.sva),
                                   periods=self.periods("subs", self.cfg.sva))

    def smsp_qty(self) -> X.Crosstab:
        return X.quantity_crosstab(self.qty_by_label(self.cfg.smsp), top_n=self.cfg.top_n,
                                   periods=self.periods("subs", self.cfg.smsp))

    def sva_mean(self) -> X.Crosstab:
        # The original divides the SVA means unguarded and the SMSP ones with NULLIF.
        return X.mean_crosstab(self.mean_by_label(self.cfg.sva, "error"),
                               self.mean_by_period(self.cfg.sva, "error"),
                               periods=self.periods("trx", self.cfg.sva))

    def smsp_mean(self) -> X.Crosstab:
        return X.mean_crosstab(self.mean_by_label(self.cfg.smsp, "null"),
                               self.mean_by_period(self.cfg.smsp, "null"), top_n=self.cfg.top_n,
                               periods=self.periods("trx", self.cfg.smsp))


# -- rendering -------------------------------------------------------------------

def _alpha(cells: DataFrame) -> DataFrame:
    return RK.rank_labels(cells.select("SVA_SMS").distinct(), [F.col("SVA_SMS").asc_nulls_first()])


def _top(cells: DataFrame, labels: DataFrame) -> DataFrame:
    return cells.join(labels.select("SVA_SMS"), "SVA_SMS", "left_semi")


def _table_builders(base: ReportBase) -> list[tuple[str, object]]:
    """The four tables as (name, builder) pairs; each builder returns a one-row
    html frame rendered from a pivot on the collected period list."""
    cfg, th, n = base.cfg, base.cfg.theme, base.cfg.top_n
    sva, smsp = cfg.sva, cfg.smsp

    def sva_qty():
        cells = base.qty_by_label(sva)
        return R.table_section(
            cells, _alpha(cells), cells, base.periods("subs", sva), TITLE_SVA_QTY, (sva,), False,
            False, CAPTION_TOTAL, "cells", True, value="Q", total_value="Q", totals_how="sum",
            theme=th)

    def smsp_qty():
        cells = base.qty_by_label(smsp)
        top = RK.top_n_by_total(cells, n=n)
        kept = _top(cells, top)
        return R.table_section(
            kept, top, kept, base.periods("subs", smsp), TITLE_SMSP_QTY, ("#", smsp), True, False,
            CAPTION_TOTAL_TOP, "total_general", True, value="Q", total_value="Q",
            totals_how="sum", theme=th)

    def sva_mean():
        cells = base.mean_by_label(sva, "error")
        return R.table_section(
            cells, _alpha(cells), base.mean_by_period(sva, "error"), base.periods("trx", sva),
            TITLE_SVA_MEAN, (sva,), False, True, CAPTION_MEAN, None, False, value="ARPU",
            total_value="ARPU", theme=th)

    def smsp_mean():
        cells = base.mean_by_label(smsp, "null")
        top = RK.top_n_by_mean(cells, n=n)
        return R.table_section(
            _top(cells, top), top, base.mean_by_period(smsp, "null"), base.periods("trx", smsp),
            TITLE_SMSP_MEAN, ("#", smsp), True, True, CAPTION_MEAN, None, False, value="ARPU",
            total_value="ARPU", theme=th)

    def chart():
        return R.chart_html(R.stacked_bar_geometry(base.by_type()), title=cfg.chart_title,
                            theme=th)

    return [("chart", chart), ("sva_qty", sva_qty), ("smsp_qty", smsp_qty),
            ("sva_mean", sva_mean), ("smsp_mean", smsp_mean)]


def report_tables(base: ReportBase) -> list[tuple[str, DataFrame]]:
    """The four tables as one-row html frames (lazy)."""
    return [(name, build()) for name, build in _table_builders(base)[1:]]


def report_sections(base: ReportBase, concurrent: bool = True) -> DataFrame:
    """One row per section: ``ord`` (0 = chart, 1-4 = tables), ``name``, ``html``.

    With ``concurrent`` the five independent sections are planned and run as
    parallel jobs from driver threads and each one-row result is written; the
    returned frame only unions those rows.
    """
    base.periods("subs", base.cfg.sva)     # fetch the period lists once, before the threads
    base.periods("trx", base.cfg.sva)
    builders = _table_builders(base)

    def one(item):
        i, (name, build) = item
        df = build().select(F.lit(i).alias("ord"), F.lit(name).alias("name"), "html")
        return materialize(df, "section") if concurrent else df

    if concurrent:
        with ThreadPoolExecutor(max_workers=len(builders)) as pool:
            parts = list(pool.map(one, enumerate(builders)))
    else:
        parts = [one(x) for x in enumerate(builders)]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def report_mail(base: ReportBase, template=R.default_template) -> DataFrame:
    """One row: ``SUBJECT``, ``BODY`` (template applied to title, date, body, button)."""
    cfg = base.cfg
    d = F.lit(cfg.as_of_date())
    body = R.assemble_body(report_sections(base), intro=cfg.intro, outro=cfg.outro)
    return body.select(
        F.concat(F.lit(SUBJECT_PREFIX), yyyymmdd(d), F.lit(SUBJECT_SUFFIX)).alias("SUBJECT"),
        template(F.lit(REPORT_TITLE), dd_mm_yyyy(d), F.col("body"), F.lit(cfg.button)).alias("BODY"))
