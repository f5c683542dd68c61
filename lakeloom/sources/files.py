"""File readers with declared schemas.

Each reader takes whole folders, globs or prefixes, so Spark lists and splits the
files; nothing loops over files in Python. Schemas are declared, because inferring
one costs another pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

Schema = StructType | str


def json_tree(spark: SparkSession, root: str, schema: Schema, pattern: str = "*.json") -> DataFrame:
    """JSON lines from every matching file at any depth below ``root``."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .json(root)
    )


def json_glob(spark: SparkSession, glob: str, schema: Schema | None = None) -> DataFrame:
    """JSON lines from a glob; without a schema Spark makes one more pass to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(glob)


def _by_name(text: Column, target: StructType) -> Column:
    """A struct of the target's fields from a JSON object's text. Its names are folded once,
    in a list that every field looks into."""
    folded = F.transform(F.map_entries(F.from_json(text, "map<string,string>")), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))

    def field(entries: Column, name: str, kind: DataType) -> Column:
        value = F.get(F.filter(entries, lambda e: (e["k"] == name.lower()) & e["v"].isNotNull()), F.lit(0))["v"]
        if isinstance(kind, StructType):
            return _by_name(value, kind)
        if isinstance(kind, ArrayType):
            texts = F.from_json(value, "array<string>")
            if isinstance(kind.elementType, StructType):
                return F.transform(texts, lambda x: _by_name(x, kind.elementType))
            return F.transform(texts, lambda x: x if kind.elementType == StringType() else x.try_cast(kind.elementType))
        return value if kind == StringType() else value.try_cast(kind)

    # A list of one, so that the entries are bound once, not computed for each field.
    row = F.transform(F.array(folded), lambda e: F.struct(*[field(e, f.name, f.dataType).alias(f.name) for f in target.fields]))
    return F.when(folded.isNotNull(), F.get(row, F.lit(0)))


def json_by_name(
    spark: SparkSession, path: str | list[str], target: StructType, ignore_case: bool = True
) -> DataFrame:
    """JSON lines whose fields map to the target columns by name, at any depth.

    The JSON reader matches names letter by letter. To ignore case each line is read
    as a map, still in one pass and without inferring a schema; where several
    spellings occur in one object the first non-null one counts. A field of the target may
    be a struct, or an array of structs or values: what a line has there is read in the
    same way. A line that is no object gives a row of nulls.
    """
    if not ignore_case:
        return spark.read.schema(target).json(path)
    rows = spark.read.text(path).select(_by_name(F.col("value"), target).alias("r"))
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in target.fields])


def csv_files(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    sep: str = ",",
    header: bool = False,
    infer: bool = False,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV from a file, folder, glob or list of them.

    With neither ``schema`` nor ``infer`` every column is a string, named by the
    header or ``_c0``, ``_c1``, ... Doubled quotes inside a quoted field are read as
    one quote. A quoted field may hold line breaks only with ``multi_line``: a file is then
    read whole by one task, so write such data in many files of moderate size.
    """
    reader = spark.read.options(sep=sep, header=header, inferSchema=infer, quote='"', escape='"', multiLine=multi_line).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def gzip_parts(spark: SparkSession, prefix: str, schema: Schema, sep: str = ";", header: bool = False) -> DataFrame:
    """All gzip CSV parts that start with ``prefix``: one task per part."""
    return csv_files(spark, f"{prefix}*", schema=schema, sep=sep, header=header)


def gzip_single(
    spark: SparkSession, path: str, schema: Schema, partitions: int, sep: str = ";", header: bool = False
) -> DataFrame:
    """One gzip CSV. Gzip cannot be split, so one task must unpack it; rows are then
    spread round-robin, so all later work runs in ``partitions`` tasks."""
    return csv_files(spark, path, schema=schema, sep=sep, header=header).repartition(partitions)


def gzip_tables(spark: SparkSession, root: str, schemas: Mapping[str, Schema], sep: str = "|") -> dict[str, DataFrame]:
    """One frame per table from its gzip parts: files in ``<root>/<table>/``, or files
    named by the table and a digit, dot or hyphen after it, so ``part`` leaves ``partsupp``."""
    return {name: csv_files(spark, f"{root}/{name}{{[0-9.-]*,/*}}", schema=schema, sep=sep) for name, schema in schemas.items()}


def array_literal(column: str, element_type: str = "string"):
    """``{a,b,c}`` text to an array; ``{}`` is an empty array. An element in double quotes
    may hold commas, and quotes and backslashes after a backslash; NULL without quotes is null."""
    body = F.regexp_replace(F.trim(F.col(column)), r"^\{|\}$", "")
    found = F.regexp_extract_all(body, F.lit(r'(?:^|,)(\s*"(?:[^"\\]|\\.)*"\s*|[^,]*)'), F.lit(1))

    def element(raw):
        text = F.trim(raw)
        unquoted = F.regexp_replace(F.regexp_replace(text, '^"|"$', ""), r"\\(.)", "$1")
        plain = F.when(F.upper(text) != "NULL", text)
        return F.when(text.startswith('"'), unquoted).otherwise(plain).try_cast(element_type)

    return F.when(F.trim(body) == "", F.array().cast(f"array<{element_type}>")).otherwise(F.transform(found, element))


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``; compressed files are unpacked."""
    return spark.read.text(path)


def manifest(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Path, size and modification time of files, without reading their content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")
