"""Column-level operators: rename, fill, conform, align and union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.schemas import RENAMES


def final_name(name: str, renames: dict[str, str]) -> str:
    """Follow a rename chain to its end."""
    seen = {name}
    while name in renames and renames[name] not in seen:
        name = renames[name]
        seen.add(name)
    return name


def rename_columns(df: DataFrame, renames: dict[str, str] = RENAMES) -> DataFrame:
    """Rename exact, case-sensitive matches; absent columns are ignored.

    ``toDF`` renames by position, so names that differ only in case cannot be mixed up
    even when the session resolves names without regard to case.
    """
    return df.toDF(*[final_name(name, renames) for name in df.columns])


def add_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each absent column as a constant; ``None`` or a typed null ``Column`` is fine too."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in absent.items()}
    ) if absent else df


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace null (and NaN in float columns) by a per-column default."""
    present = {name: value for name, value in defaults.items() if name in df.columns}
    return df.fillna(present) if present else df


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def tag(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Raises when the name sets differ. Casts follow ANSI rules: a value that does not
    fit its type is an error, not a silent wrap-around.
    """
    have, want = set(df.columns), set(schema.fieldNames())
    if have != want:
        raise ValueError(f"missing columns {sorted(want - have)}, unexpected columns {sorted(have - want)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _common_type(types: list[T.DataType]) -> T.DataType:
    """Widest of the given types: equal types stay, numbers widen, anything else is text."""
    distinct = list({t.simpleString(): t for t in types}.values())
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, T.IntegralType) for t in distinct):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in distinct):
        return T.DoubleType()
    return T.StringType()


def union_aligned(
    frames: dict[str, DataFrame], source_column: str = "source", as_string: bool = False
) -> DataFrame:
    """Union of frames with different columns, each row tagged with its source.

    Columns are sorted by name; a column absent on one side is null there. A column whose
    type differs between frames is widened; ``as_string`` turns every column into text.
    """
    tagged = [df.withColumn(source_column, F.lit(name)) for name, df in frames.items()]
    kinds: dict[str, list[T.DataType]] = {}
    for df in tagged:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    target = {name: T.StringType() if as_string else _common_type(ts) for name, ts in sorted(kinds.items())}
    aligned = [
        df.select(
            *[
                (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)
                for name, kind in target.items()
            ]
        )
        for df in tagged
    ]
    return union_all(aligned)
