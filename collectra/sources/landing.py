"""Landed report sheets: text tables read with a declared schema.

Spreadsheets have no Spark source; each sheet is landed as Parquet text (cells
may hold line breaks, files split) or as CSV, with the number of the row in
the sheet, and read as text; then null tokens are mapped to NULL and columns
are safely cast to their declared types.  No schema inference.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collectra.functions.columns import q
from collectra.functions.dates import mixed_date
from collectra.schemas import NULL_TOKENS

CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "escape": '"', "multiLine": "true"}
ROW = "_fila"  # number of the row in the sheet


ERRORS = "hoja string, archivo string, fila long, columna string, valor string, motivo string"


def _load(spark: SparkSession, path: str, fmt: str) -> DataFrame | str:
    """The landed cells, without files that cannot be read; why not, if the sheet cannot be read at all."""
    reader = spark.read.format(fmt).option("ignoreCorruptFiles", "true")
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    try:
        return reader.load(path)
    except AnalysisException as e:  # no such folder, or no file with a schema in it
        return e.getCondition() or "UNREADABLE"


def _typed(cell, dtype: T.DataType):
    return cell if isinstance(dtype, T.StringType) else mixed_date(cell) if isinstance(dtype, T.DateType) else cell.try_cast(dtype)


def _cell(name: str, null_tokens):
    s = q(name).cast("string")
    return F.when(s.isin(*null_tokens), F.lit(None).cast("string")).otherwise(s)


def scan_sheet(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               null_tokens=NULL_TOKENS, order_col: str | None = None) -> DataFrame:
    """Read one sheet: required columns (``schema``) that exist, typed.

    Extra columns in the file are ignored; missing required columns stay away
    (the cleaning rules have defaults of their own for absent columns); values
    equal to a null token become NULL; unparsable values become NULL
    (``try_cast``; dates through the mixed-layout parser).  ``order_col``: name
    under which the row number comes back, where the landed sheet has one.

    A sheet that cannot be read as a whole gives an empty table of ``schema``,
    a file of it that cannot be read gives no rows: :func:`sheet_errors` tells.
    """
    raw = _load(spark, path, fmt)
    if isinstance(raw, str):
        return spark.createDataFrame([], T.StructType([*schema.fields, *([T.StructField(order_col, T.LongType())] if order_col else [])]))
    present = set(raw.columns)
    cols = [_typed(_cell(f.name, null_tokens), f.dataType).alias(f.name) for f in schema.fields if f.name in present]
    if order_col and ROW in present:
        cols.append(q(ROW).cast("long").alias(order_col))
    return raw.select(*cols)


def sheet_errors(spark: SparkSession, sheet: str, path: str, schema: T.StructType, fmt: str = "parquet", null_tokens=NULL_TOKENS) -> DataFrame:
    """What :func:`scan_sheet` could not read: (hoja, archivo, fila, columna, valor, motivo).

    One row for a sheet that cannot be read as a whole, one for each of its
    files that gives no row and is no whole Parquet file, and one for each cell
    that is not of its column's type (the row itself is kept, the cell is NULL).
    """
    def one(*values):
        return spark.createDataFrame([values], ERRORS)

    raw = _load(spark, path, fmt)
    if isinstance(raw, str):
        return one(sheet, path, None, None, None, raw)
    present = set(raw.columns)
    cells = [F.when(_cell(f.name, null_tokens).isNotNull() & (F.btrim(q(f.name).cast("string")) != "") & _typed(_cell(f.name, null_tokens), f.dataType).isNull(),
                    F.struct(F.lit(f.name).alias("columna"), q(f.name).cast("string").alias("valor"), F.lit(f"not a {f.dataType.simpleString()}").alias("motivo")))
             for f in schema.fields if f.name in present and not isinstance(f.dataType, T.StringType)]
    row = q(ROW).cast("long") if ROW in present else F.lit(None).cast("long")
    file = F.col("_metadata.file_path")
    if cells:
        bad = raw.select(file.alias("archivo"), row.alias("fila"), F.explode(F.array_compact(F.array(*cells))).alias("e")) \
            .select(F.lit(sheet).alias("hoja"), "archivo", "fila", "e.columna", "e.valor", "e.motivo")
    else:
        bad = spark.createDataFrame([], ERRORS)
    if fmt != "parquet":
        return bad
    seen = {r[0].split(":", 1)[-1].lstrip("/") for r in raw.select(file).distinct().collect()}  # files of one sheet
    for f in _files(spark, path):
        if f.toString().split(":", 1)[-1].lstrip("/") not in seen and not _is_parquet(spark, f):
            bad = bad.unionByName(one(sheet, f.toString(), None, None, None, "FILE_NOT_READABLE"))
    return bad


def _files(spark: SparkSession, path: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(p) if f.isFile()] if fs.getFileStatus(p).isDirectory() else [p]
    return [f for f in found if not f.getName().startswith(("_", "."))]


def _is_parquet(spark: SparkSession, p) -> bool:
    """Does the file end as a Parquet file does?"""
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getFileStatus(p).getLen()
    if size < 12:
        return False
    stream = fs.open(p)
    try:
        stream.seek(size - 4)
        return bytes(stream.read() for _ in range(4)) == b"PAR1"
    finally:
        stream.close()


def land_as_text(df: DataFrame, path: str, null_token: str = "NA", fmt: str = "parquet", row: str | None = None) -> str:
    """Write a frame as an all-text sheet (NULL written as a null token).

    ``row``: the column that numbers the rows of the sheet.
    """
    cells = [c for c in df.columns if c != row]
    txt = df.select(*[F.coalesce(q(c).cast("string"), F.lit(null_token)).alias(c) for c in cells],
                    *([q(row).cast("string").alias(ROW)] if row else []))
    out = txt.write.mode("overwrite").format(fmt)
    (out.options(**CSV_OPTIONS) if fmt == "csv" else out).save(path)
    return path
