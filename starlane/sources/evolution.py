"""Schemas that widen over time, and one table of files written under all of them.

A type may become a wider one: int, bigint, decimal, double; date, timestamp; nothing, anything.
Structs and arrays widen by their parts, and fields may be added. Anything else is an error
that names the field.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.session import create_new

# Fixed order: a value of any type here can be written as one of each later type of its row.
WIDENING = (
    ("tinyint", "smallint", "int", "bigint", "decimal", "double"),
    ("float", "double"),
    ("date", "timestamp_ntz", "timestamp"),
)


class SchemaError(ValueError):
    """A field changed in a way that loses values."""


def _name(kind: T.DataType) -> str:
    return "decimal" if isinstance(kind, T.DecimalType) else kind.simpleString()


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and behind the point that hold every value of a whole or decimal type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}[kind.simpleString()], 0


def widest(a: T.DataType, b: T.DataType, field: str) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b, f"{field}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType, f"{field}[]"))
    for order in WIDENING:
        if _name(a) in order and _name(b) in order:
            first, last = sorted((a, b), key=lambda t: order.index(_name(t)))
            if _name(last) != "decimal":
                return last
            whole, part = (max(x) for x in zip(_digits(first), _digits(last), strict=True))
            return T.DecimalType(whole + part, part) if whole + part <= 38 else T.DoubleType()
    raise SchemaError(f"{field}: {a.simpleString()} and {b.simpleString()} have no common type")


def merged(declared: T.StructType, found: T.StructType, prefix: str = "") -> T.StructType:
    """The schema that holds rows of both: the declared fields in their order, then those only found."""
    other = {f.name: f.dataType for f in found}
    fields = [
        T.StructField(f.name, widest(f.dataType, other[f.name], prefix + f.name) if f.name in other else f.dataType)
        for f in declared
    ]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in found if f.name not in declared.names])


def narrowed(before: T.StructType, after: T.StructType, prefix: str = "") -> list[str]:
    """Fields of ``before`` that ``after`` lacks or gives a type that cannot hold all their values."""
    later = {f.name: f.dataType for f in after}
    out = []
    for f in before:
        name = prefix + f.name
        if f.name not in later:
            out.append(f"{name} is missing")
        elif isinstance(f.dataType, T.StructType) and isinstance(later[f.name], T.StructType):
            out += narrowed(f.dataType, later[f.name], f"{name}.")
        elif widest(f.dataType, later[f.name], name) != later[f.name]:
            out.append(f"{name} narrows from {f.dataType.simpleString()} to {later[f.name].simpleString()}")
    return out


def conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of a narrower type as one of a wider type; fields it lacks are NULL."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        mine = {f.name: f.dataType for f in have}
        parts = [
            (conformed(value[f.name], mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    return value.cast(want)


def conform_rows(rows: DataFrame, want: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in rows.schema}
    return rows.select(*[
        (conformed(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in want
    ])


def _untyped(found: T.StructType, want: T.StructType, prefix: str = "") -> list[tuple[str, bool]]:
    """Fields found as text, or lists of text, that the table has otherwise: JSON has no type for what is only null or empty."""
    other, out = {f.name: f.dataType for f in want}, []
    for f in found:
        have, kind = f.dataType, other.get(f.name)
        if isinstance(have, T.StructType) and isinstance(kind, T.StructType):
            out += _untyped(have, kind, f"{prefix}{f.name}.")
        elif kind is not None and kind != have and have in (T.StringType(), T.ArrayType(T.StringType())):
            out.append((prefix + f.name, isinstance(have, T.ArrayType)))
    return out


def _with_types(found: T.StructType, want: T.StructType, of: set[str], prefix: str = "") -> T.StructType:
    other = {f.name: f.dataType for f in want}

    def kind(f: T.StructField) -> T.DataType:
        if prefix + f.name in of:
            return other[f.name]
        if isinstance(f.dataType, T.StructType) and isinstance(other.get(f.name), T.StructType):
            return _with_types(f.dataType, other[f.name], of, f"{prefix}{f.name}.")
        return f.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in found])


@dataclass(frozen=True)
class EvolvingTable:
    """Rows under ``root``, in a folder per schema version; no file is written anew when the schema widens."""

    spark: SparkSession
    root: str

    def versions(self) -> list[tuple[int, T.StructType]]:
        try:
            lines = self.spark.read.schema("number int, schema string").json(f"{self.root}/schemas").dropna().collect()
        except Exception as error:  # no version yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return sorted(((r.number, T.StructType.fromJson(json.loads(r.schema))) for r in lines), key=lambda v: v[0])

    def schema(self) -> T.StructType:
        """The schema that holds all rows."""
        out = T.StructType([])
        for _, schema in self.versions():
            out = merged(out, schema)
        return out

    def declare(self, schema: T.StructType) -> T.StructType:
        """Widen the table to ``schema``; an error names the fields that it would narrow."""
        lost = narrowed(self.schema(), schema)
        if lost:
            raise SchemaError("; ".join(lost))
        return self._version(schema)[1]

    def _version(self, schema: T.StructType) -> tuple[int, T.StructType]:
        """The version with exactly this schema, a new one if there is none."""
        while True:
            known = self.versions()
            for number, old in known:
                if old.jsonValue() == schema.jsonValue():
                    return number, old
            number = known[-1][0] + 1 if known else 1
            line = json.dumps({"number": number, "schema": json.dumps(schema.jsonValue())})
            if create_new(self.spark, f"{self.root}/schemas/{number:06}.json", line + "\n"):
                return number, schema

    def append(self, rows: DataFrame) -> None:
        """Add rows as they are; their fields must go together with those of the table."""
        merged(self.schema(), rows.schema)  # an error if not
        number, _ = self._version(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]))
        rows.write.parquet(f"{self.root}/rows/version={number}/{uuid.uuid4().hex}")

    def append_json(self, path: str, multi_line: bool = False) -> None:
        """Add JSON files with the schema found in them; a field without any value has the table's type."""
        reader = self.spark.read.option("multiLine", multi_line)
        found, want = reader.json(path).schema, self.schema()
        doubtful = _untyped(found, want)
        if doubtful:
            rows = reader.schema(found).json(path)
            held = rows.agg(*[
                F.count_if(F.size(F.col(name)) > 0 if is_list else F.col(name).isNotNull()).alias(str(i))
                for i, (name, is_list) in enumerate(doubtful)
            ]).first()
            found = _with_types(found, want, {name for n, (name, _) in zip(held, doubtful, strict=True) if not n})
        self.append(self.spark.read.option("multiLine", multi_line).schema(found).json(path))

    def read(self) -> DataFrame:
        """All rows, those of older versions too, under the schema that holds all."""
        want = self.schema()
        out = self.spark.createDataFrame([], want)
        for number, schema in self.versions():
            path = f"{self.root}/rows/version={number}"
            there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            if there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there):
                rows = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
                out = out.unionByName(conform_rows(rows, want))
        return out
