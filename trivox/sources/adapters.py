"""From what an adapter landed to the contract's tables: a table of paths, and a reason for each row that does not fit.

A landed line is read as a VARIANT, so each adapter may have a shape of its own. What a column is taken from is a path or
one of a few forms; nothing of the shape is written elsewhere, and the core never sees it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivox.sources.schemas import KEYS, SCHEMAS, empty


@dataclass(frozen=True)
class From:
    """Where a column comes from: the first of ``paths`` that is there. ``unit`` is that of a time given as a number."""

    paths: tuple[str, ...]
    unit: str | None = None


@dataclass(frozen=True)
class Adapter:
    """Paths by table and column. A column that is not named is taken from the field of its own name, unless ``strict``;
    ``constants`` are the same for all rows."""

    name: str
    columns: dict[str, dict[str, str | From]] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)
    strict: bool = False

    def of(self, table: str, column: str) -> From | None:
        said = self.columns.get(table, {}).get(column)
        if said is None:
            return None if self.strict else From((f"$.{column}",))
        return From((said,)) if isinstance(said, str) else said


#: What has the contract's own names.
PLAIN = Adapter("plain")
_UNITS = {"seconds": 1_000_000, "milliseconds": 1_000, "microseconds": 1}


def _there(raw: Column, path: str) -> Column:
    found = F.try_variant_get(raw, path, "variant")
    return found.isNotNull() & ~F.coalesce(F.is_variant_null(found), F.lit(True))


def _value(raw: Column, path: str, kind: str, unit: str | None) -> Column:
    if kind == "timestamp" and unit:
        return F.timestamp_micros(F.try_variant_get(raw, path, "bigint") * _UNITS[unit])
    return F.try_variant_get(raw, path, kind)


def normalised(lines: DataFrame, table: str, adapter: Adapter = PLAIN, line: str = "value") -> DataFrame:
    """``lines`` in the columns of ``table``, with ``reason`` and the ``line``: null where a row meets the contract, else
    ``unparsable``, ``missing:<key>`` or ``type:<column>``, the first that holds, keys before other columns.

    A field that is null or not there is null in its column; one that is there and cannot be read as the column's type is
    a fault, also of columns that may be null.
    """
    schema = empty(lines.sparkSession, table).schema
    raw, made, faults = F.col("__v"), {}, {}
    for f in schema:
        kind, taken = f.dataType.simpleString(), adapter.of(table, f.name)
        if f.name in adapter.constants:
            made[f.name], faults[f.name] = F.lit(adapter.constants[f.name]).cast(kind), F.lit(False)
        elif taken is None:
            made[f.name], faults[f.name] = F.lit(None).cast(kind), F.lit(False)
        else:
            value = F.lit(None).cast(kind)
            for path in reversed(taken.paths):
                value = F.when(_there(raw, path), _value(raw, path, kind, taken.unit)).otherwise(value)
            some = F.lit(False)
            for path in taken.paths:
                some = some | _there(raw, path)
            made[f.name], faults[f.name] = value, some
    order = [*KEYS[table], *[f.name for f in schema if f.name not in KEYS[table]]]
    parsed = lines.select(F.col(line).alias("line"), F.try_parse_json(F.col(line)).alias("__v"))
    wide = parsed.select("line", F.col("__v").isNull().alias("__none"), *[made[n].alias(n) for n in made], *[faults[n].alias(f"__f_{n}") for n in faults])
    reason = F.when(F.col("__none"), "unparsable")
    for n in order:
        reason = reason.when(F.col(n).isNull() & F.col(f"__f_{n}"), f"type:{n}")
        if n in KEYS[table]:
            reason = reason.when(F.col(n).isNull(), f"missing:{n}")
    return wide.withColumn("reason", reason).select(*[f.name for f in schema], "reason", "line")


def split(rows: DataFrame, table: str, at=None) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of what ``normalised`` made: rows of the contract, and ``(kind, reason, line)`` of others."""
    columns = [x.split(" ")[0] for x in SCHEMAS[table].split(", ")]
    return rows.where("reason is null").select(*columns), rows.where("reason is not null").select(F.lit(table).alias("kind"), "reason", "line")
