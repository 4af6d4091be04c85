"""Cleaning: renames, id stripping, time parsing, projection, dedup,
numeric casts, quarantine of malformed rows, entity filters, struct/JSON
flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import clean_id, parse_epoch_ms, to_numeric
from tidewatch.operators.sequence import as_list, join_on


def to_numeric_columns(df: DataFrame, columns: Sequence[str], decimals: int | None = 2) -> DataFrame:
    """Cast listed columns to rounded double in one projection; malformed
    text becomes null; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_numeric(c, decimals) for c in present})


def filter_entities(df: DataFrame, key: str, ids) -> DataFrame:
    """Keep rows whose ``key`` is in ``ids`` (a list or a one-column
    DataFrame).  A null id selects rows with a null key.  Always a null-safe
    left-semi join: the plan carries no literal list, and Spark broadcasts
    the id side when it is small."""
    if isinstance(ids, DataFrame):
        right = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
        return join_on(df, right, [key], "left_semi")
    ids = list(ids)
    spark = df.sparkSession
    right = spark.createDataFrame([(i,) for i in ids], T.StructType([df.schema[key]]))
    return join_on(df, right, [key], "left_semi")


def clean_raw(df: DataFrame, features: Sequence[str], *, entity: str = "sn", id_col: str = "mdn",
              ts_col: str = "ts", time: str = "time", filters=None, decimals: int = 2) -> DataFrame:
    """Raw header CSV rows -> clean wide frame.

    rename ``mdn -> MDN``, strip quotes, epoch-ms text -> time (whole
    seconds), apply ``filters`` *before* projecting, project the catalogue
    columns (absent ones skipped), drop duplicate rows, cast features.
    """
    d = df
    if id_col in d.columns:
        d = d.withColumnRenamed(id_col, id_col.upper()).withColumn(id_col.upper(), clean_id(id_col.upper()))
    d = d.withColumn(time, parse_epoch_ms(ts_col))
    for f in as_list(filters):
        d = d.filter(f)
    keep = [c for c in [entity, id_col.upper(), time, *features] if c in d.columns]
    d = d.select(*keep).dropDuplicates()
    return to_numeric_columns(d, features, decimals)


#: Layouts of time text that are tried one after the other, after epoch milliseconds.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "yyyyMMddHHmmss", "yyyy-MM-dd")
BAD_TIME, NO_TIME, BAD_VALUE, BAD_ID = "bad time", "no time", "bad value", "no entity"


def parse_time(c, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """Time text -> TIMESTAMP_NTZ: epoch milliseconds (of 11 to 13 digits),
    or the first layout that fits; anything else gives null, never an error.
    Surrounding blanks are ignored."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    at = F.when(text.rlike(r"^-?[0-9]{11,13}$"), parse_epoch_ms(text, truncate_to_second=False))
    return F.coalesce(at, *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def quarantine(df: DataFrame, entity: str, time: str, values: Sequence[str],
               formats: Sequence[str] = TIME_FORMATS) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows of raw text whose time and ``values`` can be
    read, with time and values typed, and the others as they came, with
    ``reasons``, an array: ``no entity``, ``no time`` (null or blank), ``bad
    time``, ``bad value: <column>`` (text that is no finite number; null and
    blank are missing values, not bad ones).  One pass each over the input."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    number = {v: F.trim(v).try_cast("double") for v in values}
    bad = lambda v: ~blank(v) & F.coalesce(F.isnan(number[v]) | (F.abs(number[v]) == float("inf")), number[v].isNull())
    at = parse_time(time, formats)
    marks = [F.when(blank(entity), F.lit(BAD_ID)), F.when(blank(time), F.lit(NO_TIME)).when(at.isNull(), F.lit(BAD_TIME)),
             *[F.when(bad(v), F.lit(f"{BAD_VALUE}: {v}")) for v in values]]
    d = df.withColumn("reasons", F.array_compact(F.array(*marks)))
    good = d.filter(F.size("reasons") == 0).withColumns({time: at, **number}).drop("reasons")
    return good, d.filter(F.size("reasons") > 0)


def reject_counts(rejected: DataFrame, by=()) -> DataFrame:
    """(by, reason, rows): rejected rows per reason; a row with two reasons
    counts for both."""
    d = rejected.select(*as_list(by), F.explode("reasons").alias("reason"))
    return d.groupBy(*as_list(by), "reason").agg(F.count(F.lit(1)).alias("rows"))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursively expand struct columns into ``parent_child`` columns."""
    def expand(dt, prefix, path):
        out = []
        for f in dt.fields:
            name, p = f"{prefix}{sep}{f.name}" if prefix else f.name, path + [f.name]
            if isinstance(f.dataType, T.StructType):
                out += expand(f.dataType, name, p)
            else:
                c = F.col(".".join(f"`{x}`" for x in p))
                out.append(c.alias(name))
        return out
    return df.select(*expand(df.schema, "", []))


def extract_json_metric(df: DataFrame, column: str, fields: dict) -> DataFrame:
    """Parse a JSON text column with an explicit schema (``from_json``) and
    add the requested fields as typed columns; bad JSON gives nulls."""
    schema = T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items()])
    parsed = F.from_json(F.col(column), schema)
    return df.withColumns({k: parsed[k] for k in fields})
