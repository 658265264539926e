"""Column and row policies of roles, as one table.

(role, table_name, kind, column_name, rule):

* kind ``column``: the role sees the column under a rule of RULES; column
  ``*`` is every column without a rule of its own;
* kind ``row``: the role sees rows whose column holds ``rule`` as text; several
  values of a column are alternatives, several columns must all agree.

A role sees nothing that no policy shows: without a column rule there is no
column, and a table for which a role has no policy cannot be read at all. The
column rules (at most one per column of the table) compile into one projection,
the row rules into one semi join per column; grants are broadcast only if
their number is checked to be small. Predicates on shown columns still reach
the scan. NULL never equals a grant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fn
from .joins import broadcast_if_small

RULES = {
    "show": lambda c: F.col(c),
    "hash": lambda c: fn.sha256(c),
    "mask_digits": lambda c: fn.mask_digits(F.col(c).cast("string")),
    "mask_email": lambda c: fn.mask_email(c),
    "null": lambda c: None,
}
POLICY = "role string, table_name string, kind string, column_name string, rule string"


class PolicyError(PermissionError):
    pass


def column_rules(policies: DataFrame, role: str, table: str, columns: list[str]) -> dict[str, str]:
    """Rule of each column that the role may see."""
    own = policies.where((F.col("role") == role) & (F.col("table_name") == table) & (F.col("kind") == "column"))
    # at most one rule per column and the general one: as wide as the table
    found = own.where(F.col("column_name").isin([*columns, "*"])).select("column_name", "rule").distinct().collect()
    rules: dict[str, str] = {}
    for r in found:
        if r.rule not in RULES:
            raise PolicyError(f"{role} on {table}.{r.column_name}: unknown rule {r.rule}")
        if rules.setdefault(r.column_name, r.rule) != r.rule:
            raise PolicyError(f"{role} on {table}.{r.column_name}: two rules")
    general = rules.pop("*", None)
    return {c: rules.get(c, general) for c in columns if rules.get(c, general)}


def _shown(df: DataFrame, column: str, rule: str) -> Column:
    out = RULES[rule](column)
    return (F.lit(None).cast(df.schema[column].dataType) if out is None else out).alias(column)


def as_role(df: DataFrame, table: str, policies: DataFrame, role: str) -> DataFrame:
    """What ``role`` sees of ``df``, the table ``table``."""
    rules = column_rules(policies, role, table, df.columns)
    if not rules:
        raise PolicyError(f"{role} may not read {table}")
    rows = policies.where((F.col("role") == role) & (F.col("table_name") == table) & (F.col("kind") == "row"))
    bound = [r[0] for r in rows.select("column_name").distinct().collect()]     # columns of the table
    out = df
    for c in sorted(bound):
        if c not in df.columns:
            raise PolicyError(f"{role} on {table}: row rule on the unknown column {c}")
        grants = rows.where(F.col("column_name") == c).select(F.col("rule").alias("_grant")).distinct()
        out = out.join(broadcast_if_small(grants), F.col(c).cast("string") == F.col("_grant"), "left_semi")
    return out.select(*[_shown(df, c, r) for c, r in rules.items()])
