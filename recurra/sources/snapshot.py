"""Typed snapshot load of the operational tables.

The dump is delimited text with a header. Money and flag columns are read as
text and converted afterwards with ``try_cast`` (under ANSI a plain cast
raises on bad input); nothing is inferred. The separator and the null marker
are options: a ``mysql --batch`` export is tab separated with ``NULL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recurra import schemas

# Columns carried as text in the file and typed after reading.
TEXT_COLUMNS = {
    "subscriptions": {"montant_mensuel_cad": "money", "annulation_schedulee": "flag"},
    "invoices": {"montant_cad": "money"},
}
TARGET = {"subscriptions": schemas.SUBSCRIPTIONS, "invoices": schemas.INVOICES}


def read_schema(table: str) -> StructType:
    text = TEXT_COLUMNS[table]
    return StructType([StructField(f.name, StringType() if f.name in text else f.dataType, True)
                       for f in TARGET[table].fields])


def _options(sep: str, null_value: str | None) -> dict:
    opts = {"sep": sep, "mode": "PERMISSIVE"}
    if null_value is not None:
        opts["nullValue"] = null_value
    return opts


def type_snapshot(df: DataFrame, table: str) -> DataFrame:
    """S3: text money -> DECIMAL(10,2); text 0/1 -> int -> BOOLEAN."""
    out = df
    for name, kind in TEXT_COLUMNS[table].items():
        c = F.col(name)
        out = out.withColumn(name, c.try_cast("decimal(10,2)") if kind == "money"
                             else c.try_cast("int").cast("boolean"))
    return out.select(*[f.name for f in TARGET[table].fields])


def load_snapshot(spark: SparkSession, path: str, table: str, sep: str = ",",
                  null_value: str | None = None) -> DataFrame:
    """Header + declared schema (positional) -> typed DataFrame."""
    reader = spark.read.schema(read_schema(table)).option("header", True)
    for k, v in _options(sep, null_value).items():
        reader = reader.option(k, v)
    return type_snapshot(reader.csv(path), table)


def parse_snapshot_lines(lines: DataFrame, table: str, sep: str = ",",
                         null_value: str | None = None, column: str = "value") -> DataFrame:
    """Same typing for dump lines that are already in a DataFrame column
    (no header), e.g. lines arriving from a stream."""
    parsed = F.from_csv(F.col(column), read_schema(table).simpleString(), _options(sep, null_value))
    return type_snapshot(lines.select(parsed.alias("r")).select("r.*"), table)


def dump_lines(df: DataFrame, table: str, sep: str = "\t", null_value: str = "NULL") -> DataFrame:
    """Inverse of ``parse_snapshot_lines``: rows -> delimited text, as a
    ``mysql --batch`` export writes them (flags as 0/1)."""
    cols = []
    for f in TARGET[table].fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "boolean":
            c = c.cast("int")
        # timestamp_ntz and date render zone-free with a plain cast
        cols.append(F.coalesce(c.cast("string"), F.lit(null_value)))
    return df.select(F.concat_ws(sep, *cols).alias("value"))


def write_snapshot(df: DataFrame, path: str) -> int:
    """K3 + S4: full overwrite; the row count is observed during the write
    (one pass, no second scan)."""
    obs = Observation("snapshot")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])
