"""Schemas that change from one generation of files or messages to the next: compared field by field, widened, renamed, filled.

Only widening is done by itself: a value that was written is read back with the same meaning. Whatever would lose
something, as a text where a number was, is an error that names the field, unless the caller gives the type it wants.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard import schemas

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
OTHERS = "other_fields"


class SchemaConflict(ValueError):
    """Two types of a field that no wider type holds."""


@dataclass(frozen=True)
class Change:
    field: str
    kind: str  # added, removed, renamed, widened, narrowed, conflict
    before: str | None
    after: str | None


def _decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_DIGITS[type(t)], 0) if isinstance(t, _WHOLE) else None


def wider(a: T.DataType, b: T.DataType, field: str = "") -> T.DataType:
    """The narrowest type that holds all values of both. A whole number beside a fraction is a double as long as it
    has 53 bits."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if kinds == {T.FloatType, T.DoubleType} or kinds <= {T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if _decimal(a) and _decimal(b):
        x, y = _decimal(a), _decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if kinds == {T.StructType}:
        return merged_schema([a, b], f"{field}.")
    if kinds == {T.ArrayType}:
        return T.ArrayType(wider(a.elementType, b.elementType, f"{field}[]"), a.containsNull or b.containsNull)
    if kinds == {T.MapType} and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType, f"{field}[]"), a.valueContainsNull or b.valueContainsNull)
    raise SchemaConflict(f"{field}: {a.simpleString()} and {b.simpleString()}")


def merged_schema(generations: Iterable[T.StructType], prefix: str = "") -> T.StructType:
    """All fields of all generations, in the order in which they came up, each as wide as needed, nullable."""
    found: dict[str, T.DataType] = {}
    for schema in generations:
        for f in schema:
            found[f.name] = wider(found[f.name], f.dataType, prefix + f.name) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def renamed(schema: T.StructType, renames: dict[str, str]) -> T.StructType:
    """Old names replaced by new ones. A frame that has both keeps the new one's name for both, which is an error."""
    names = [renames.get(f.name, f.name) for f in schema]
    if len(set(names)) < len(names):
        raise SchemaConflict(f"two fields of one name after renaming: {sorted(n for n in names if names.count(n) > 1)}")
    return T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, schema)])


def changes(old: T.StructType, new: T.StructType, renames: dict[str, str] | None = None) -> list[Change]:
    """What became of each field of `old` in `new`, then what is new."""
    renames = renames or {}
    after = {f.name: f.dataType for f in new}
    out, seen = [], set()
    for f in old:
        name = renames.get(f.name, f.name)
        if name not in after:
            out.append(Change(f.name, "removed", f.dataType.simpleString(), None))
            continue
        seen.add(name)
        before, now = f.dataType.simpleString(), after[name].simpleString()
        if name != f.name:
            out.append(Change(f.name, "renamed", f.name, name))
        if before != now:
            try:
                whole = wider(f.dataType, after[name], f.name)
                kind = "widened" if whole == after[name] else "narrowed"
            except SchemaConflict:
                kind = "conflict"
            out.append(Change(name, kind, before, now))
    return out + [Change(n, "added", None, t.simpleString()) for n, t in after.items() if n not in seen]


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """`value` in the wanted type: casts of atoms, fields of structs by name, elements one by one."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have}
        fields = [
            (_fitted(value.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: _fitted(x, have.valueType, want.valueType))
    return value.try_cast(want)


def evolved(df: DataFrame, target: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """`df` with the fields of `target`, in its order: renamed, widened, missing ones null, others left out. Where `target` is
    narrower than the frame, values that do not fit become null: that was the caller's choice."""
    own = renamed(df.schema, renames or {})
    rows = df.toDF(*own.names)
    kinds = {f.name: f.dataType for f in own}
    return rows.select(*[
        (_fitted(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target
    ])


def read_generations(
    spark: SparkSession,
    paths: Iterable[str],
    fmt: str = "parquet",
    renames: dict[str, str] | None = None,
    target: T.StructType | None = None,
) -> DataFrame:
    """Folders written with different schemas as one frame. Each is read with its own schema, so that scans read and filter
    stored columns, and widened afterwards; `target` overrules the merged schema."""
    parts = [spark.read.format(fmt).load(p) for p in paths]
    target = target or merged_schema([renamed(p.schema, renames or {}) for p in parts])
    frames = [evolved(p, target, renames) for p in parts]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionAll(f)
    return whole


def decode_open(
    messages: DataFrame, ddl: str = schemas.TRANSACTION, keep: tuple[str, ...] = (), renames: dict[str, str] | None = None
) -> DataFrame:
    """As `payload.decode`, and fields that the layout does not know as they are in `other_fields`: a map from names to
    variants, for `variant_get`, null for messages that are no objects. Fields under an old name count under the new one."""
    renames = renames or {}
    wanted = schemas.struct(ddl)
    older = {new: old for old, new in renames.items()}
    both = T.StructType([*wanted.fields, *[T.StructField(older[f.name], f.dataType) for f in wanted if f.name in older]])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN}
    data = F.from_json(text, both.add(schemas.CORRUPT_COLUMN, "string"), options)
    known = F.array(*[F.lit(f.name) for f in both])
    others = F.map_filter(F.from_json(text, "map<string,variant>"), lambda name, _: ~F.array_contains(known, name))
    rows = messages.select(*keep, data.alias("data"), others.alias(OTHERS))
    fields = [
        F.coalesce(f"data.{f.name}", f"data.{older[f.name]}").alias(f.name) if f.name in older else F.col(f"data.{f.name}")
        for f in wanted
    ]
    return rows.select(*keep, *fields, f"data.{schemas.CORRUPT_COLUMN}", OTHERS)
