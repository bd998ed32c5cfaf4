"""Readers and writers for the core tables and the CSV extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from freightlens.sources import schemas


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in schema order; a column that ``df`` lacks gets its
    declared default, else NULL (S9).  A stored NULL stays NULL."""
    defaults = schemas.DEFAULTS.get(table, {})
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
                       for f in schemas.TABLES[table].fields])


def inline_rows(spark: SparkSession, table: str, rows) -> DataFrame:
    """Typed DataFrame from literal rows (S2), tuples in schema order or
    dicts by column name; a column that a dict omits takes its declared
    default, an explicit None is NULL."""
    schema = schemas.TABLES[table]
    names, defaults = [f.name for f in schema.fields], schemas.DEFAULTS.get(table, {})
    data = [tuple(r.get(n, defaults.get(n)) for n in names) if isinstance(r, dict) else tuple(r) for r in rows]
    return spark.createDataFrame(data, schema)


def append_rows(df: DataFrame, path: str) -> None:
    """``INSERT INTO``: append the rows to the table stored at ``path``."""
    df.write.mode("append").parquet(path)


def _as_boolean(c):
    v = F.lower(F.trim(F.col(c)))
    return (F.when(v.isin("1", "true", "t", "yes"), F.lit(True))
            .when(v.isin("0", "false", "f", "no"), F.lit(False))
            .when(v.isNotNull(), F.raise_error(F.concat(F.lit(f"{c}: not a boolean: "), v)).cast("boolean")).alias(c))


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Typed scan of one core table (S1): explicit schema, no inference.

    In CSV, booleans may be written ``0``/``1`` (MySQL) or ``true``/``false``;
    a boolean read schema would turn the former into NULL without a word,
    so boolean columns are read as text and converted.  A cell that is not of
    its column's type is an error.  Columns are found by name (the header or
    the file's schema); absent ones take their defaults.
    """
    fields = {f.name: f for f in schemas.TABLES[table].fields}
    if fmt != "csv":
        present = [c for c in spark.read.format(fmt).load(path).columns if c in fields]
        return apply_defaults(spark.read.schema(StructType([fields[c] for c in present])).format(fmt).load(path), table)
    header = spark.read.option("header", True).csv(path).columns
    text = StructType([StructField(c, fields[c].dataType if c in fields and not isinstance(fields[c].dataType, BooleanType) else StringType(), True)
                       for c in header])
    df = spark.read.option("header", True).option("nullValue", "NULL").option("mode", "FAILFAST").schema(text).csv(path)
    df = df.select(*[_as_boolean(c) if isinstance(fields[c].dataType, BooleanType) else F.col(c) for c in header if c in fields])
    return apply_defaults(df, table)


def _cell(c: str, t: DataType) -> tuple[Column, Column]:
    """The cell of column ``c`` as type ``t``, and what is wrong with it (null: nothing)."""
    raw = F.col(c)
    if isinstance(t, BooleanType):
        v = F.lower(F.trim(raw))
        value = F.when(v.isin("1", "true", "t", "yes"), F.lit(True)).when(v.isin("0", "false", "f", "no"), F.lit(False))
    elif isinstance(t, DecimalType):  # too many places or digits are wrong, not rounded
        wide = F.expr(f"try_cast(`{c}` AS DECIMAL(38,{t.scale}))")
        value = F.expr(f"try_cast(`{c}` AS {t.simpleString()})")
        value = F.when(value.eqNullSafe(wide) & (F.expr(f"try_cast(`{c}` AS DECIMAL(38,18))") == value), value)
    else:
        value = F.expr(f"try_cast(`{c}` AS {t.simpleString()})")
    wrong = F.when(raw.isNotNull() & value.isNull(), F.concat(F.lit(f"{c}: not {t.simpleString()}: "), raw))
    return value.alias(c), wrong


def read_with_rejects(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """The good rows of a core table in CSV, and the rejects.

    The good rows are those ``read_table`` would give.  A reject is
    ``file, line, reasons``: the source file, the line's cells as JSON and an
    array of what is wrong - a cell that is not of its column's type (with a
    boolean's or decimal's own rules), a required column that is NULL, or a line
    with more or fewer cells than the header.  Every line is in exactly one of
    the two, and neither needs a shuffle.  ``read_table`` stays the strict
    reader, which stops at the first bad cell.
    """
    fields = {f.name: f for f in schemas.TABLES[table].fields}
    header = spark.read.option("header", True).csv(path).columns
    text = StructType([*[StructField(c, StringType(), True) for c in header], StructField("_corrupt", StringType(), True)])
    raw = (spark.read.option("header", True).option("nullValue", "NULL").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
           .schema(text).csv(path).withColumn("_file", F.col("_metadata.file_path")))
    cells = {c: _cell(c, fields[c].dataType) for c in header if c in fields}
    required = [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in cells if not fields[c].nullable]
    broken = F.when(F.col("_corrupt").isNotNull(), F.lit("line: not as many cells as the header"))
    checked = raw.withColumn("_reasons", F.array_compact(F.array(broken, *[wrong for _, wrong in cells.values()], *required)))
    good = apply_defaults(checked.where(F.size("_reasons") == 0).select(*[value for value, _ in cells.values()]), table)
    line = F.to_json(F.struct(*[F.col(c) for c in header], F.col("_corrupt")))
    rejects = checked.where(F.size("_reasons") > 0).select(F.col("_file").alias("file"), line.alias("line"), F.col("_reasons").alias("reasons"))
    return good, rejects


def quarantine(rejects: DataFrame, path: str, load: str) -> DataFrame:
    """Append rejects to a quarantine table, in the partition of this load, and
    return its counts: ``load, file, reason, rows`` (a line counts once for
    each of its reasons).  The partition of a load that is run again is replaced."""
    spark = rejects.sparkSession
    (rejects.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path))
    kept = spark.read.schema("file string, line string, reasons array<string>, load string").parquet(path).where(F.col("load") == load)
    reason = F.regexp_extract("reason", "^([^:]*: [^:]*)", 1)
    return kept.select("load", "file", F.explode("reasons").alias("reason")).withColumn("reason", reason).groupBy("load", "file", "reason").agg(F.count(F.lit(1)).alias("rows"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Idempotent rebuild (S8): replace whatever was at ``path``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_view_csv(spark: SparkSession, path: str, view: str) -> DataFrame:
    """Read an exported view (S3): header, ``NULL`` for missing, typed.

    Booleans exported as ``0``/``1`` are read as int and cast, because a
    boolean read schema would silently turn them into NULL.  Decimals keep
    their places but not a width, as totals grow with the data.
    """
    df = (spark.read.option("header", True).option("nullValue", "NULL")
          .option("mode", "FAILFAST").schema(_wide(schemas.VIEW_CSV[view])).csv(path))
    for c in schemas.BOOLEAN_AS_INT.get(view, []):
        df = df.withColumn(c, F.col(c).cast("boolean"))
    return df


def _wide(schema: StructType) -> StructType:
    """Integers as LONG and decimals with 38 digits."""
    def widen(t):
        return DecimalType(38, t.scale) if isinstance(t, DecimalType) else LongType() if isinstance(t, IntegerType) else t
    return StructType([StructField(f.name, widen(f.dataType), True) for f in schema.fields])


def write_view_csv(df: DataFrame, path: str, view: str | None = None, crlf: bool = True) -> None:
    """Export a view as CSV with a header and the word ``NULL`` for missing.

    Booleans are written 0/1; with ``view`` its numbers have the places of the
    view's columns (``97.50``, not ``97.5``)."""
    kinds = {f.name: f.dataType for f in _wide(schemas.VIEW_CSV[view]).fields} if view else {}
    df = df.select(*[F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, BooleanType) else
                     F.col(f.name).cast(kinds[f.name]).alias(f.name) if isinstance(kinds.get(f.name), DecimalType) else F.col(f.name)
                     for f in df.schema.fields])
    (df.write.mode("overwrite").option("header", True).option("nullValue", "NULL")
     .option("emptyValue", "").option("lineSep", "\r\n" if crlf else "\n").csv(path))
