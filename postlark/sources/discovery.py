"""Schema discovery: the fields, types and counts of JSON lines that no schema describes.

Lines are parsed once into variants, and one aggregate merges the schemas of all of them, whatever
files they lie in: only its result, as long as the schema, reaches the driver. A second pass counts
how often each field has which type; these counts add up over files, so they can be stored and
summed when new files arrive.

Rules: numbers without a fraction are BIGINT, or DECIMAL(38,0) beyond 64 bits; others are DOUBLE. A
field of several types that have no common one, and one that is never filled, is a STRING: its JSON
text stays as it is. A line that is not valid JSON is broken and has no fields; an empty line is no
document. A document that is no object has no fields either.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "broken"
ROOT = "$"


def _variants(lines: DataFrame) -> DataFrame:
    """``json`` with the variant of each document, NULL for a broken line."""
    filled = lines.where(F.trim("value") != "")
    return filled.select(F.try_parse_json("value").alias("json"))


def _is_object(json: Column) -> Column:
    return F.startswith(F.schema_of_variant(json), F.lit("OBJECT<"))


def _ddl_of(found: str) -> str:
    """A schema of variants as DDL: objects are structs. Names in backquotes stay."""
    parts = found.split("`")
    return "`".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))


def _merged(lines: DataFrame) -> T.StructType:
    """The schemas of all objects merged, as the variants have them."""
    objects = _variants(lines).where(_is_object(F.col("json")))
    found = objects.agg(F.schema_of_variant_agg("json")).first()[0]
    merged = T._parse_datatype_string(_ddl_of(found))
    return merged if isinstance(merged, T.StructType) else T.StructType()


def _settled(kind: T.DataType) -> T.DataType:
    """A type that any value of a field can be read with and that files can hold."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _settled(f.dataType)) for f in kind.fields]
        return T.StructType(fields) if fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, 0) if kind.scale == 0 else T.DoubleType()
    return T.DoubleType() if isinstance(kind, T.FloatType) else kind


def found_schema(lines: DataFrame) -> T.StructType:
    """The schema of the JSON lines in ``value``; without objects it has no fields."""
    return T.StructType(
        [T.StructField(f.name, _settled(f.dataType)) for f in _merged(lines).fields]
    )


def ddl(schema: T.StructType) -> str:
    """A schema as text, with all names quoted, as readers and ``from_json`` take it."""
    return ", ".join(f"{_quoted(f.name)} {_type_text(f.dataType)}" for f in schema.fields)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _type_text(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        fields = ", ".join(f"{_quoted(f.name)}: {_type_text(f.dataType)}" for f in kind.fields)
        return f"STRUCT<{fields}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_type_text(kind.elementType)}>"
    return kind.simpleString().upper()


def read_schema(spark: SparkSession, path: str | list[str]) -> str:
    """The schema of JSON files or folders, as text."""
    return ddl(found_schema(spark.read.text(path)))


# Names with other characters have no place in a variant path.
_PLAIN_NAME = re.compile(r"[^'?\\]+")


class _Stages:
    """Columns that others are made from, one projection after the other, so each is made once."""

    def __init__(self):
        self.levels: list[list[Column]] = []

    def add(self, column: Column, level: int) -> Column:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"_values_{level}_{len(self.levels[level])}"
        self.levels[level].append(column.alias(name))
        return F.col(name)

    def applied(self, df: DataFrame) -> DataFrame:
        for columns in self.levels:
            df = df.select("*", *columns)
        return df


def _occurrences(
    kind: T.DataType, base: Column, path: str, field: str, stages: _Stages, level: int = 0
) -> list[tuple[str, T.DataType, Column]]:
    """Every field at or below one, with all its values in a document as an array of variants.

    ``base`` is an array of variants, and ``path`` leads from each of them to the field.
    """
    values = base
    if path:
        values = F.transform(base, lambda x: F.try_variant_get(x, "$" + path, "variant"))
    out = [(field, kind, F.filter(values, lambda x: x.isNotNull()))]
    if isinstance(kind, T.StructType):
        for child in kind.fields:
            name = child.name if field == ROOT else f"{field}.{child.name}"
            if _PLAIN_NAME.fullmatch(child.name):
                below = f"{path}['{child.name}']"
                out += _occurrences(child.dataType, base, below, name, stages, level)
            else:
                own = stages.add(F.transform(values, _by_name(child.name)), level)
                out += _occurrences(child.dataType, own, "", name, stages, level + 1)
    elif isinstance(kind, T.ArrayType):
        none = F.array().cast("array<variant>")
        lists = F.transform(values, lambda x: F.coalesce(x.try_cast("array<variant>"), none))
        own = stages.add(F.flatten(lists), level)
        out += _occurrences(kind.elementType, own, "", f"{field}[]", stages, level + 1)
    return out


def _by_name(name: str) -> Callable[[Column], Column]:
    return lambda x: F.try_element_at(x.try_cast("map<string,variant>"), F.lit(name))


_NAMES = {"VOID": "null"}

# If all values of a field have one of these types, each that is not null has it.
_ONLY = {
    T.StructType: "object",
    T.ArrayType: "array",
    T.StringType: "string",
    T.LongType: "bigint",
    T.BooleanType: "boolean",
}


def field_counts(lines: DataFrame) -> DataFrame:
    """``field``, ``type``, ``documents``, ``values``: how often each field has which type.

    A field within an array has ``[]`` behind the array's name; the document itself is ``$``, and a
    broken line counts as its type ``broken``. ``documents`` counts documents with such a value and
    ``values`` the values. Fields below one that is an object in some documents and something else
    in others are not looked into.
    """
    schema = _merged(lines)
    json = F.col("json")
    names = F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])

    def kind_of(x: Column) -> Column:
        plain = F.regexp_extract(F.schema_of_variant(x), "^[A-Z]+", 0)
        return F.coalesce(names[plain], F.lower(plain))

    def kinds_of(field: str, kind: T.DataType, values: Column) -> Column:
        only = _ONLY.get(type(kind))
        # Documents that are no objects are not in the schema.
        if only is None or field == ROOT:
            return F.transform(values, kind_of)
        return F.transform(
            values, lambda x: F.when(F.is_variant_null(x), "null").otherwise(F.lit(only))
        )

    def counted(field: str, kinds: Column) -> Column:
        return F.transform(
            F.array_distinct(kinds),
            lambda kind: F.struct(
                F.lit(field).alias("field"),
                kind.alias("type"),
                F.size(F.filter(kinds, lambda x: x == kind)).cast("bigint").alias("values"),
            ),
        )

    stages = _Stages()
    fields = _occurrences(schema, F.array(json), "", ROOT, stages)
    kinds = [kinds_of(*field).alias(f"_kinds_{i}") for i, field in enumerate(fields)]
    staged = stages.applied(_variants(lines)).select("json", *kinds)
    found = F.concat(
        *[counted(field, F.col(f"_kinds_{i}")) for i, (field, _, _) in enumerate(fields)]
    )
    broken = F.array(
        F.struct(
            F.lit(ROOT).alias("field"), F.lit(BROKEN).alias("type"),
            F.lit(1).cast("bigint").alias("values"),
        )
    )
    rows = staged.select(F.inline(F.when(json.isNull(), broken).otherwise(found)))
    return merged_counts(rows.withColumn("documents", F.lit(1).cast("bigint")))


def merged_counts(counts: DataFrame) -> DataFrame:
    """Field counts of several files or days as those of all of them."""
    return counts.groupBy("field", "type").agg(
        F.sum("documents").alias("documents"), F.sum("values").alias("values")
    )
