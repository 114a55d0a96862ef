"""Table scans (S1-S3, S6), missing-value rules and sinks.

Every scan goes through ``spark.read`` so Catalyst prunes columns and pushes
filters into the parquet reader; nothing here materialises data.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.hashing import bucket, key_text, sql_bucket, sql_key_text
from fathom.functions.numeric import clean_double

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Row keys of the driver tables (lineitem's (orderkey, linenumber) is not unique).
ROW_KEYS = {
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "embeddings": ("vec_id",),
}

DEFAULT_MISSING_PCT = 15


def table_path(sf_dir: str, name: str) -> str:
    override = os.environ.get(f"FATHOM_TABLE_{name.upper()}")  # S3: local path override
    return override or f"{sf_dir.rstrip('/')}/{name}.parquet"


# where the library lies: Python tasks look here too, whatever folder the driver was started in
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; how it is split is left to the reader's settings."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders`` is a parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header; an explicit schema avoids an inference pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_by_candidates(spark: SparkSession, paths: Sequence[str], aliases: Mapping[str, str],
                       expected: Iterable[str], min_match: int) -> DataFrame:
    """First readable table among ``paths``; lower-case names, rename
    known synonyms, and accept it only when at least ``min_match`` of the
    expected columns are present."""
    expected = [e.lower() for e in expected]
    last_error: Exception | None = None
    for path in paths:
        try:
            df = spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)
        except Exception as exc:  # unreadable candidate: try the next one
            last_error = exc
            continue
        df = normalise_names(df, aliases)
        if len(set(df.columns) & set(expected)) >= min_match:
            return df
    raise ValueError(f"no candidate matched the expected signature ({last_error})")


def normalise_names(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case, spaces to underscores, then alias renames."""
    aliases = {k.lower(): v for k, v in (aliases or {}).items()}
    mapping = {}
    for c in df.columns:
        n = c.strip().lower().replace(" ", "_").replace(".", "_")
        mapping[c] = aliases.get(n, n)
    return df.withColumnsRenamed(mapping)


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN and +-inf to NULL at the scan for floating columns."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or floats) if c in floats]
    return df.withColumns({c: clean_double(c) for c in cols}) if cols else df


def with_injected_missing(df: DataFrame, key_cols: Sequence[str], cols: Iterable[str],
                          pct: int = DEFAULT_MISSING_PCT) -> DataFrame:
    """Cell c of a row is NULL when h32(key text || c) mod 100 < pct."""
    kt = key_text(*key_cols)
    return df.withColumns({
        c: F.when(bucket(kt, c) < pct, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c in cols
    })


def sql_injected_missing(col: str, key_cols: Sequence[str], pct: int = DEFAULT_MISSING_PCT) -> str:
    return f"CASE WHEN {sql_bucket(sql_key_text(*key_cols), col)} < {pct} THEN NULL ELSE {col} END"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Row and report tables as parquet (default) or CSV with header."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested reports as JSON lines; NaN and inf become null first, at
    any depth of structs, arrays and map values."""
    df.select(*[_finite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]) \
        .write.mode(mode).json(path)


def _finite(c, kind: T.DataType):
    """``c`` with NaN and infinities replaced by null wherever its type holds floats."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return clean_double(c)
    if isinstance(kind, T.StructType):
        fields = [_finite(c.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _finite(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: _finite(x, kind.valueType))
    return c


def first_n_sample(df: DataFrame, key_cols: Sequence[str], n: int, label: str | None = None) -> DataFrame:
    """First-N rows by key without the target column (limit is the feature)."""
    out = df.orderBy(*key_cols).limit(n)
    return out.drop(label) if label else out
