"""tallyspark — a PySpark engine for daily lending / buy-now-pay-later KPI panels.

Layers:

* ``sources``   — role views (decisions, loans, installments, ...) read with
                  explicit column lists so Catalyst prunes and pushes filters.
* ``functions`` — column-level helpers (safe division, map attributes, dates,
                  report formats); all built-in Spark expressions.
* ``operators`` — reusable DataFrame -> DataFrame operators (cohort conversion,
                  first-payment default, cost per acquisition, ...).
* ``plans``     — the twenty metric jobs composed from operators, and the panel
                  (long metric table, targets, day-over-day change, report).
* ``streaming`` — incremental daily refresh of the panel with Structured
                  Streaming (``availableNow`` trigger).
"""

from tallyspark.params import Params
from tallyspark.session import get_session

__all__ = ["Params", "get_session"]
