"""Report lines: layout rows dealt to the days of a metric table and formatted
with built-in string functions.  One output row per day and report line.

A layout is data: rows of (variant, section, line_no, slot, text, param, metric,
fmt).  A slot is a text followed by a metric in a format, or by a text parameter
(the day, the currency), or by nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import fmt

_SLOT = re.compile(r"\{(?:\$(?P<param>[a-z_]+)|(?P<metric>[A-Za-z0-9_]+):(?P<fmt>[a-z0-9]+))\}")
FIELDS = ("variant", "section", "line_no", "slot", "text", "param", "metric", "fmt")
_KIND = "array<struct<variant:string,section:string,line_no:int,slot:int,text:string,param:string,metric:string,fmt:string>>"


def layout_rows(variant: str, layout: Sequence[tuple[str, Sequence[str]]]) -> list[tuple]:
    """The rows of a layout from templates such as ``"label {metric:fmt} on {$as_of}"``.  Text after
    the last placeholder becomes a slot of its own."""
    rows = []
    for section, lines in layout:
        for line_no, template in enumerate(lines, start=1):
            slot, at = 0, 0
            for m in _SLOT.finditer(template):
                rows.append((variant, section, line_no, slot, template[at:m.start()], m["param"], m["metric"], m["fmt"]))
                slot, at = slot + 1, m.end()
            if at < len(template) or not slot:
                rows.append((variant, section, line_no, slot, template[at:], None, None, None))
    return rows


def report_lines(metrics: DataFrame, layout: Sequence[tuple], params: Mapping[str, str] | None = None) -> DataFrame:
    """(as_of, variant, section, line_no, text) for every day of ``metrics`` (as_of, metric, value).

    ``layout``: rows as ``layout_rows`` makes them, of one variant or several.  A
    metric that a day lacks prints as ``null`` (``N/A`` for changes) instead of
    failing the report; the parameter ``as_of`` is the row's own day, an unknown
    parameter is an error."""
    params = dict(params or {})
    unknown = {r[5] for r in layout if r[5] and r[5] != "as_of"} - set(params)
    if unknown:
        raise ValueError(f"the layout needs the parameters {sorted(unknown)}")
    # the layout is configuration: dealt to the days as a literal, no join
    slots = F.from_json(F.lit(json.dumps([dict(zip(FIELDS, r)) for r in layout])), _KIND)
    days = metrics.select("as_of").distinct().select("as_of", F.explode(slots).alias("s")).select("as_of", "s.*")
    j = days.join(metrics.select("as_of", "metric", "value"), ["as_of", "metric"], "left")
    given = F.create_map(*[F.lit(x) for kv in params.items() for x in kv]) if params else F.create_map().cast("map<string,string>")
    filled = (F.when(F.col("param") == "as_of", F.date_format("as_of", "yyyy-MM-dd"))
              .when(F.col("param").isNotNull(), given[F.col("param")])
              .when(F.col("metric").isNotNull(), fmt.by_name("fmt", "value")).otherwise(F.lit("")))
    line = ["as_of", "variant", "section", "line_no"]
    return (j.select(*line, F.struct("slot", F.concat("text", filled).alias("piece")).alias("p")).groupBy(*line)
            .agg(F.array_sort(F.collect_list("p")).alias("ps"))
            .select(*line, F.array_join(F.transform("ps", lambda x: x["piece"]), "").alias("text")))
