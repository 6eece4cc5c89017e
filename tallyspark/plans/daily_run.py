"""One day's run from the targets file to the report.

    python -m tallyspark.plans.daily_run ROOT STORE AS_OF [--targets FILE] [--layout compact] [--out PATH]

ROOT holds a dataset for each role (``WarehouseRoles``).  The day's partials and
panel are committed below STORE, the report of the stored day is printed (some
forty lines) or written.
"""

from __future__ import annotations

import argparse
import datetime as _dt
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.params import Params, load_targets
from tallyspark.plans import panel
from tallyspark.streaming.daily_refresh import PanelStores, refresh


def daily_run(R, p: Params, store: str, targets: str | None = None, variant: str = "full",
              changed: Mapping[str, Iterable[_dt.date]] | None = None, params: Mapping[str, str] | None = None) -> DataFrame:
    """(as_of, variant, section, line_no, text) of the day ``p.as_of``.

    ``targets``: a JSON file whose numbers replace the built-in targets.
    ``changed``: source days that changed since the last run, by role; the stored
    days that they touch are replaced as well."""
    if targets is not None:
        p = replace(p, targets=load_targets(targets, p.targets))
    stores = PanelStores(R.spark, store)
    done = refresh(R, p, stores, changed or {}, [p.as_of])
    if p.as_of not in done:  # stored by an earlier run: nothing it uses was named as changed; the targets may have
        panel.sink_panel(R, p, stores.panel_path, panel.panel_of_days(stores.partials.read(), p, [p.as_of]))
    day = stores.panel.verified().where(F.col("as_of") == F.lit(p.as_of))
    return panel.report(R, p, day, variant, params)


def main(argv: list[str] | None = None) -> None:
    ask = argparse.ArgumentParser(prog="daily_run")
    ask.add_argument("root")
    ask.add_argument("store")
    ask.add_argument("as_of", type=_dt.date.fromisoformat)
    ask.add_argument("--targets")
    ask.add_argument("--layout", default="full")
    ask.add_argument("--out")
    a = ask.parse_args(argv)
    from tallyspark.session import get_session
    from tallyspark.sources.roles import WarehouseRoles
    lines = daily_run(WarehouseRoles(get_session(), a.root), Params(as_of=a.as_of), a.store, a.targets, a.layout)
    if a.out:
        lines.write.mode("overwrite").json(a.out)
        return
    section = None
    for r in lines.orderBy("section", "line_no").collect():  # the layout's lines
        if r["section"] != section:
            section = r["section"]
            print(f"\n[{section}]")
        print(r["text"])


if __name__ == "__main__":
    main()
