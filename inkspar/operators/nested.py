"""Records nested in records: fields set along a path of the schema, and children that must share their parent's provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: What entries of one capture have in common.
PROVENANCE = ("response_sha256", "archive_url", "archive_timestamp", "source_url", "retrieved_at", "snapshot", "observation_kind", "selected_indexed_timestamp", "latest_indexed_timestamp", "selection_reason", "selection_provenance")


def _set(column: Column, kind: DataType, steps: list[str], value: Column) -> Column:
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda item: _set(item, kind.elementType, steps, value))
    if not steps:
        return value
    if not isinstance(kind, StructType):
        raise ValueError(f"{steps[0]} can't be below a {kind.simpleString()}")
    step, *rest = steps
    names = {f.name: f.dataType for f in kind.fields}
    if step not in names and rest:
        raise ValueError(f"no field {step} to go through")
    inner = _set(column[step], names[step], rest, value) if rest else value
    # A null record stays null, and isn't made of nulls.
    return F.when(column.isNotNull(), column.withField(step, inner))


def with_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """df with a field set, or added, at a path such as ``additional_entries.license.url``: in every element of the arrays on the way, at any depth.

    Nothing is exploded or shuffled; ``value`` is over the columns of df. Null records and arrays on the way stay as they are.
    """
    first, *rest = path.split(".")
    if not rest:
        return df.withColumn(first, value)
    if first not in df.columns:
        raise ValueError(f"no column {first}")
    return df.withColumn(first, _set(F.col(first), df.schema[first].dataType, rest, value))


def paths_of(kind: DataType, nested: str) -> list[str]:
    """The paths of all levels of records under a field of this name: additional_entries, additional_entries.additional_entries, ..."""
    found, at = [], kind
    while True:
        at = at.elementType if isinstance(at, ArrayType) else at
        if not isinstance(at, StructType) or nested not in at.names:
            return found
        found.append(".".join([*found[-1:], nested]))
        at = at[nested].dataType


def annotated(df: DataFrame, nested: str, **fields: Column) -> DataFrame:
    """df with fields set on its records and on those nested in them at every level; a child's older value is replaced by its parent's."""
    paths = paths_of(df.schema, nested)
    for name, value in fields.items():
        for path in paths:
            df = with_path(df, f"{path}.{name}", value)
        df = df.withColumn(name, value)
    return df


def foreign_fields(df: DataFrame, nested: str, fields: tuple[str, ...] = PROVENANCE) -> DataFrame:
    """df with ``foreign``: the fields, of those that parent and children have, in which a child differs from its parent, in order of name; empty where all agree.

    A field that only the parent has differs in every child.
    """
    child = df.schema[nested].dataType.elementType
    shared = [f for f in fields if f in df.columns]

    def differs(field: str):
        return lambda c: ~(c[field] if field in child.names else F.lit(None)).eqNullSafe(F.col(field))

    tests = [F.when(F.exists(nested, differs(f)), F.lit(f)) for f in sorted(shared)]
    own = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return df.withColumn("foreign", F.coalesce(F.when(F.size(nested) > 0, own), F.array().cast("array<string>")))


def expanded(df: DataFrame, nested: str, key: str, fields: tuple[str, ...] = PROVENANCE) -> DataFrame:
    """(key, position, record): each record and, behind it, those nested in it; a child of another provenance raises an error."""
    checked = foreign_fields(df, nested, fields)
    own = [c for c in df.columns if c not in (nested, key)]
    child = df.schema[nested].dataType.elementType
    parent = F.struct(*[F.col(c) for c in own])
    kin = F.transform(nested, lambda c: F.struct(*[(c[n] if n in child.names else F.lit(None)).cast(df.schema[n].dataType).alias(n) for n in own]))
    wrong = F.concat(F.lit("a child of another capture: "), F.array_join("foreign", ", "))
    every = F.when(F.size("foreign") > 0, F.raise_error(wrong)).otherwise(F.concat(F.array(parent), F.coalesce(kin, F.array())))
    return checked.select(key, F.posexplode(every).alias("position", "record"))
