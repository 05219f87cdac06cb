"""monthwise: monthly period reporting on Spark DataFrames.

Main entry points:
  monthwise.session.get_session                   session with the library's settings
  monthwise.plans.report.ReportBase               one materialized pass per fact table
  monthwise.plans.report.report_sections / report_mail
  monthwise.plans.trigger.run_report_trigger      gates + report + outbox write
  monthwise.streaming.drain.drain_once            incremental outbox drain
Operators live in monthwise.operators, Column functions in monthwise.functions,
sources and sinks in monthwise.sources.
"""

__version__ = "0.1.0"
