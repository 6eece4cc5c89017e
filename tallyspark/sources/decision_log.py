"""The decision log as it is stored: attributes spread over six string maps,
times and the partition day as text.

``ATTRIBUTES`` is the one key table: which map and key hold an attribute, and
the type its text must parse as.  ``decisions`` makes the role of a stored log,
``rejected_attributes`` counts the text that doesn't parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.schemas import SchemaError, conform, rejected_values, rejects

# FIXED VALUES — attribute of the role: (stored map, its key, type of its text).
ATTRIBUTES: dict[str, tuple[str, str, str]] = {
    "biz_id": ("b_column", "bizId", "string"),
    "process_flag": ("p_column", "processFlag", "int"),
    "is_reloan": ("i_column", "isReloanCustomer", "int"),
    "is_white_list": ("i_column", "isWhiteListUser", "int"),
    "is_cyclic": ("i_column", "isCyclic", "boolean"),
    "paid_loans_cnt": ("u_column", "userPayedLoansCnt", "int"),
    "credit_limit": ("c_column", "creditLimit", "double"),
    "risk_grade": ("a_column", "auditNewRiskGradeV1", "string"),
}
MAPS = ("a_column", "b_column", "c_column", "i_column", "p_column", "u_column")
PLAIN = ("user_id", "flow_id", "listing_id", "inserttime", "dt")


def _check(log: DataFrame) -> None:
    have = {f.name: f.dataType.simpleString() for f in log.schema.fields}
    faults = [f"{c} is missing" for c in (*PLAIN, *MAPS) if c not in have]
    faults += [f"{c} is {have[c]}, declared map<string,string>" for c in MAPS if c in have and have[c] != "map<string,string>"]
    if faults:
        raise SchemaError("stored decision log: " + "; ".join(faults))


def stored(attribute: str) -> Column:
    """The text of an attribute as the log stores it."""
    column, key, _ = ATTRIBUTES[attribute]
    return F.col(column)[key]


def decisions(log: DataFrame) -> DataFrame:
    """The ``decisions`` role of a stored log.  An attribute keeps its text, with blanks around it
    taken off; one that doesn't parse as its type is NULL, as one that is missing."""
    _check(log)

    def clean(name: str) -> Column:
        text, kind = F.trim(stored(name)), ATTRIBUTES[name][2]
        return text if kind == "string" else F.when(text.try_cast(kind).isNotNull(), text)

    attrs = F.create_map(*[x for name in ATTRIBUTES for x in (F.lit(name), clean(name))])
    return conform(log.withColumn("attrs", attrs), "decisions")


def rejected_attributes(log: DataFrame) -> DataFrame:
    """(column, rejected, example) of the log's attributes, times and ids."""
    _check(log)
    checks = {name: F.when(F.trim(stored(name)).try_cast(kind).isNull(), stored(name))
              for name, (_, _, kind) in ATTRIBUTES.items() if kind != "string"}
    plain = rejected_values(log.withColumn("attrs", F.create_map().cast("map<string,string>")), "decisions")
    return rejects(log, checks).union(plain)
