"""File and JDBC scans (S2, S4-S7, S9-S12) and sinks (K1, K2, K6)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import integral_long
from ..operators.vocab import last_entries
from ..schema import VOCAB_TABLES
from .batches import CSV_READ, normalise_columns

_FORMATS = {".parquet": "parquet", ".csv": "csv", ".orc": "orc", ".json": "json", ".tsv": "csv"}


# ---------------------------------------------------------------- scans
def read_table(spark: SparkSession, path: str, *, fmt: str | None = None, encoding: str | None = None,
               sep: str | None = None) -> DataFrame:
    """Read by extension; CSV with a header, an optional charset (EUC-KR
    and x-windows-949 need ``spark.sql.legacy.javaCharsets=true`` at session
    start) and separator."""
    if fmt is None:
        ext = "." + path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
        fmt = _FORMATS.get(ext)
        if fmt is None:
            raise ValueError(f"unsupported file type: {path}")
    r = spark.read
    if fmt == "csv":
        r = r.options(**CSV_READ)
        if encoding:
            r = r.option("encoding", encoding)
        if sep or path.lower().endswith(".tsv"):
            r = r.option("sep", sep or "\t")
    return r.format(fmt).load(path)


def read_db(spark: SparkSession, table: str, url: str, *, schema: str | None = None,
            usecols: Sequence[str] | None = None, properties: dict | None = None) -> DataFrame:
    """JDBC table; case-insensitive column choice (all columns when none match).
    The projection is pushed into the database's SELECT list."""
    name = f"{schema}.{table}" if schema else table
    df = spark.read.jdbc(url, name, properties=properties or {})
    if usecols:
        want = {c.lower() for c in usecols}
        keep = [c for c in df.columns if c.lower() in want]
        if keep:
            df = df.select(*keep)
    return df


def read_db_partitioned(spark: SparkSession, table: str, url: str, *, column: str, lower: int, upper: int,
                        partitions: int, fetchsize: int = 500_000, properties: dict | None = None) -> DataFrame:
    """Partitioned JDBC scan (one range of ``column`` per task)."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=props)


def read_vocab_tsv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Vocabulary TSV, all strings, no quoting.  Spark yields NULL for an empty
    field, so every emptiness test downstream is ``coalesce(c, '') = ''``."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in VOCAB_TABLES[table]])
    return (spark.read.option("sep", "\t").option("quote", "").option("header", "true")
            .schema(schema).csv(path))


def read_lab_directory(spark: SparkSession, raw_dir: str, codes: Sequence[str] = (), *,
                       ext: str = "csv") -> DataFrame:
    """One headerless file per lab code; the code is the file name.  All files
    when ``codes`` is empty; missing codes simply match no file."""
    df = spark.read.option("header", "false").csv(f"{raw_dir}/*.{ext}")
    df = df.withColumn("code", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1))
    if codes:
        df = df.where(F.col("code").isin(list(codes)))
    return df


def read_supplement(df: DataFrame) -> DataFrame:
    """First column = code, second = concept id; row-wise parse (T16), nulls dropped.
    Of entries that repeat a code the last in input order stays, so the fill of J16 never
    multiplies a row."""
    c0, c1 = df.columns[:2]
    return last_entries(df.select(F.col(c0).cast("string").alias("code"), integral_long(F.col(c1)).alias("concept_id")))


def read_pseudonym_map(df: DataFrame) -> DataFrame:
    """(person_id, pid)."""
    df = normalise_columns(df)
    return df.select(integral_long(F.col("person_id")).alias("person_id"), F.col("pid").cast("string").alias("pid"))


def read_provider_list(df: DataFrame, *, order_col: str | None = None) -> DataFrame:
    """(care_site_id, care_site_rawname, concept_id) plus the input ordinal ``_ord``."""
    df = normalise_columns(df)
    if order_col:  # a sheet read as text carries its ordinal as text: order it as a number
        ordc = integral_long(F.col(order_col)) if dict(df.dtypes)[order_col] == "string" else F.col(order_col)
    else:
        ordc = F.monotonically_increasing_id()
    return df.select(integral_long(F.col("care_site_id")).alias("care_site_id"),
                     F.col("care_site_rawname").cast("string").alias("care_site_rawname"),
                     integral_long(F.col("concept_id")).alias("concept_id"), ordc.alias("_ord"))


# ---------------------------------------------------------------- sinks
def write_cdm(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1: parquet (default) or CSV with a header (no byte-order mark).  CSV quotes are
    doubled and fields may hold line breaks; timestamps keep microseconds; an empty
    string and a null both become an empty field, as in any plain CSV."""
    w = df.write.mode(mode)
    if fmt == "csv":
        (w.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
    else:
        w.format(fmt).save(path)


def write_db(df: DataFrame, table: str, url: str, *, schema: str | None = None, mode: str = "overwrite",
             batchsize: int = 50_000, properties: dict | None = None) -> None:
    """K2: JDBC table, ``batchsize`` rows per insert batch."""
    props = dict(properties or {})
    props["batchsize"] = str(batchsize)
    name = f"{schema}.{table}" if schema else table
    df.write.mode(mode).jdbc(url, name, properties=props)


def write_tsv(df: DataFrame, path: str) -> None:
    """K6: tab separated with a header (used-vocabulary export).  Empty strings
    are written as empty fields, as in the vocabulary files S6 reads back."""
    df.write.mode("overwrite").option("sep", "\t").option("header", "true").option("emptyValue", "").csv(path)
