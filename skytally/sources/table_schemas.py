"""The schema of a table, kept beside its files and widened by each write.

Files of one table differ in their columns, as documents get new fields and CSVs new headers. Instead of
merging the footers of all files on each read, a table's folder holds its schema as numbered JSON files; the
highest number counts. A write widens it before its rows become visible, so a reader that uses it sees
every column, and files without a column give nulls. Two writers cannot take the same number: the slower
one reads the other's schema and widens that.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

FOLDER = "_schema"
WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def widened_type(old: T.DataType, new: T.DataType, name: str = "value") -> T.DataType:
    """The type that holds both and that files of either can be read as."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return widened(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened_type(old.elementType, new.elementType, name))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, widened_type(old.valueType, new.valueType, name))
    kinds = {type(old), type(new)}
    if kinds <= set(WHOLE):
        return max(old, new, key=lambda t: WHOLE.index(type(t)))
    if kinds <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise ValueError(f"column {name} holds {old.simpleString()} and cannot hold {new.simpleString()} as well")


def widened(old: T.StructType, new: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of both, the old ones first, all of them nullable."""
    fresh = {f.name: f.dataType for f in new}
    fields = [(f.name, widened_type(f.dataType, fresh.get(f.name, f.dataType), prefix + f.name)) for f in old]
    known = set(old.names)
    fields += [(f.name, f.dataType) for f in new if f.name not in known]
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


def _place(spark: SparkSession, table: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{FOLDER}")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _latest(spark: SparkSession, table: str) -> tuple[int, T.StructType | None]:
    folder, files = _place(spark, table)
    if not files.exists(folder):
        return 0, None
    numbers = [int(m[1]) for s in files.listStatus(folder) if (m := re.fullmatch(r"(\d+)\.json", s.getPath().getName()))]
    if not numbers:
        return 0, None
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{max(numbers)}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), T.StructType.fromJson(json.loads(text))


def stored_schema(spark: SparkSession, table: str) -> T.StructType | None:
    """The table's schema by its folder; None for tables written without one. No Spark job runs."""
    return _latest(spark, table)[1]


def _numbered(spark: SparkSession, files, draft, final) -> bool:
    """Give a draft its number; False if another writer has taken that.

    A rename on a local disk replaces what is there, so a link is made, which cannot.
    """
    if files.getUri().getScheme() != "file":
        return not files.exists(final) and files.rename(draft, final)
    link, whole = (spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, draft))
    try:
        spark._jvm.java.nio.file.Files.createLink(link, whole)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def keep_schema(spark: SparkSession, table: str, schema: T.StructType) -> T.StructType:
    """Widen the table's schema by ``schema`` and return it; fails on types that do not go together."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    while True:
        number, stored = _latest(spark, table)
        wanted = widened(stored if stored is not None else T.StructType(), schema)
        if wanted == stored:
            return wanted
        folder, files = _place(spark, table)
        draft, final = path_of(folder, f".{uuid.uuid4().hex}"), path_of(folder, f"{number + 1}.json")
        out = files.create(draft, False)
        try:
            out.write(bytearray(wanted.json(), "utf-8"))
        finally:
            out.close()
        # The draft is whole before it gets its number.
        taken = _numbered(spark, files, draft, final)
        files.delete(draft, False)
        if taken:
            return wanted
