"""Job entry points over written CDM folders: QC (D14 with S13), dedupe of all
tables (D17), gap-report export (D15 with K7) and side loading (S14)."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lenient
from ..operators.dedupe import dedupe_natural_key, keep_rule
from ..schema import CDM_TABLES
from ..sources.batches import CSV_READ, path_exists
from ..sources.files import read_db, write_cdm
from . import compare as CMP
from . import quality as Q


def load_cdm_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """``<root>/<name>`` (parquet, or CSV when its files are CSV), ``<root>/<name>.parquet``
    or ``<root>/<name>.csv``; ``None`` when there is none of them.  A table that is there
    but cannot be read is an error.

    CSV is read as text in one pass (no schema inference, which would scan the
    files twice); the columns of a CDM table are read leniently as their layout types."""
    for path, fmt in ((f"{root}/{name}", None), (f"{root}/{name}.parquet", "parquet"), (f"{root}/{name}.csv", "csv")):
        if path_exists(spark, path):
            fmt = fmt or ("csv" if path_exists(spark, f"{path}/*.csv") else "parquet")
            df = spark.read.options(**CSV_READ if fmt == "csv" else {}).format(fmt).load(path)
            return _cast_layout(df, name) if fmt == "csv" else df
    return None


def _cast_layout(df: DataFrame, name: str | None) -> DataFrame:
    """Read the text columns of a CDM table as their layout types (C4 / C5): ``8507.0`` is
    an integer, a value that cannot be read is null."""
    if name not in CDM_TABLES:
        return df
    types = dict(CDM_TABLES[name])
    return df.withColumns({c: lenient(F.col(c), types[c]) for c in df.columns if types.get(c, "string") != "string"})


def load_cdm_tables(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    out = {}
    for n in (names or CDM_TABLES):
        df = load_cdm_table(spark, root, n)
        if df is not None:
            out[n] = df
    return out


def qc_job(spark: SparkSession, root: str, *, lo: str = Q.DATE_LO, hi: str = Q.DATE_HI) -> tuple[DataFrame, DataFrame]:
    """(report, totals) over every CDM table found under ``root``."""
    tables = {k: v for k, v in load_cdm_tables(spark, root).items() if k in Q.QC_SPEC}
    report = Q.qc_report(tables, lo=lo, hi=hi)
    return report, Q.qc_totals(report)


def dedupe_job(spark: SparkSession, root: str, out_root: str, names: Iterable[str] | None = None) -> DataFrame:
    """Dedupe each written CDM table on its natural key into ``out_root``;
    returns (table_name, rows_before, rows_after, removed) from the written data."""
    parts = []
    for name, df in load_cdm_tables(spark, root, names).items():
        write_cdm(dedupe_natural_key(df, name, keep=keep_rule(name)), f"{out_root}/{name}")
        after = spark.read.parquet(f"{out_root}/{name}")
        parts.append(df.select(F.lit(name).alias("table_name"), F.lit(1).alias("_b"), F.lit(0).alias("_a"))
                     .unionByName(after.select(F.lit(name).alias("table_name"), F.lit(0).alias("_b"),
                                               F.lit(1).alias("_a"))))
    u = spark.createDataFrame([], "table_name string, _b int, _a int")  # a folder without tables: an empty report
    for p in parts:
        u = u.unionByName(p)
    agg = u.groupBy("table_name").agg(F.sum("_b").cast("bigint").alias("rows_before"),
                                      F.sum("_a").cast("bigint").alias("rows_after"))
    return agg.withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def load_side(spark: SparkSession, *, path: str | None = None, url: str | None = None, table: str | None = None,
              schema: str | None = None, cdm_table: str | None = None) -> DataFrame:
    """One side of a comparison: a file (parquet / csv) or a JDBC table.

    A CSV side of a known CDM table (``cdm_table``) is read as text in one pass and
    cast by the layout; any other CSV is typed by schema inference (one extra pass)."""
    if path:
        fmt = "csv" if path.endswith(".csv") else "parquet"
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.options(**CSV_READ)
            if cdm_table in CDM_TABLES:
                return _cast_layout(r.load(path), cdm_table)
            r = r.option("inferSchema", "true")
        return r.load(path)
    if url and table:
        return read_db(spark, table, url, schema=schema)
    raise ValueError("a comparison side needs a path or a JDBC url and table")


def gap_job(gen: DataFrame, base: DataFrame, domain: str, out_dir: str | None = None) -> dict[str, DataFrame]:
    """Key comparison, mapping comparison and the three gap tables; written
    as CSV under ``out_dir`` when given (K7)."""
    keys, concept, source = CMP.COMPARE_SPEC[domain]
    out = {"keys": CMP.compare_keys(gen, base, keys)}
    if concept is not None:
        comp = CMP.compare_mapping(gen, base, source, concept)
        out.update({"mapping_counts": CMP.compare_mapping_counts(comp), "mapping_compare": comp,
                    "missing": CMP.gap_missing(comp), "common_unmapped": CMP.gap_common_unmapped(comp)})
        if out_dir:
            for k in ("mapping_compare", "missing", "common_unmapped"):
                write_cdm(out[k], f"{out_dir}/{domain}_{k}", fmt="csv")
    return out


def reconcile_job(spark: SparkSession, gen: DataFrame, base: DataFrame, domain: str, *, top: int = 10,
                  out_dir: str | None = None) -> dict[str, DataFrame]:
    """A table against another: row counts, columns of one side, key overlap, date
    range and the largest differences of the concept distribution; written as CSV under
    ``out_dir`` when given."""
    keys, concept, _ = CMP.COMPARE_SPEC[domain]
    date = next(k for k in keys if k in CMP.DATES)
    out = {"counts": CMP.recon_counts(gen, base), "columns": CMP.recon_columns(spark, gen, base),
           "keys": CMP.recon_keys(gen, base, [k for k in keys if k != date]), "dates": CMP.recon_date_range(gen, base, date)}
    if concept is not None:
        out["concepts"] = CMP.recon_concept_top(gen, base, concept, top)
    if out_dir:
        for k, df in out.items():
            write_cdm(df, f"{out_dir}/{domain}_{k}", fmt="csv")
    return out
