"""CSV extracts to typed raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOADED_AT = "_loaded_at"
LOADED_MICROS = "_loaded_micros"

#: Tables of each source system. ``payments`` exists twice, with different grain.
SOURCES: dict[str, tuple[str, ...]] = {
    "raw": ("customers", "products", "orders", "order_items", "payments"),
    "raw_billing": ("plans", "subscriptions", "invoices", "invoice_lines", "payments", "refunds"),
    "raw_events": ("events",),
}

@dataclass(frozen=True)
class Rule:
    """A type a text column takes if every one of its values has this shape and converts."""

    shape: str
    convert: Callable[[Column], Column]


# Fixed formats: a timestamp is tried before a date, so a time of day is never lost. The casts read
# the text as it stands, whatever the session's time zone.
TEMPORAL = (
    Rule(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", lambda c: c.try_cast("timestamp_ntz")),
    Rule(r"^\d{4}-\d{2}-\d{2}$", lambda c: c.try_cast("date")),
)
# Nothing is lost on the way: whole numbers stay whole, with or without gaps, and codes with leading
# zeros stay text. A double takes 15 significant digits; longer fractions stay text unless declared.
_WHOLE = r"^[+-]?(0|[1-9]\d*)$"
NUMERIC = (
    Rule(_WHOLE, lambda c: c.try_cast("bigint")),
    Rule(_WHOLE, lambda c: c.try_cast("decimal(38,0)")),
    Rule(
        r"^[+-]?(?=([^0-9eE]*\d){1,15}([^0-9]*|[eE].*)$)((0|[1-9]\d*)\.\d*|\.\d+|(0|[1-9]\d*))([eE][+-]?\d+)?$",
        lambda c: c.try_cast("double"),
    ),
    Rule(r"^(?i)(true|false)$", lambda c: c.try_cast("boolean")),
)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    line_breaks: bool | None = None,
    landing: str | None = None,
) -> DataFrame:
    """CSV with a header, to the types its values have or to a declared schema.

    A declared schema names the columns in any order; the result has its order. A column that only one
    of file and schema has, or a value that does not convert, is an error. Either way text columns end
    up as timestamps or dates where all their values are. Quotes inside quoted text are doubled.

    A file is read by many tasks unless its quoted text holds line breaks, which ``line_breaks`` tells or,
    if it does not, the lines with an odd number of quotes. With a ``landing`` folder the text is parsed
    once, into Parquet there, and types are found and cast from that; without one each pass parses it again.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no extract at {path}")
    if landing is not None:
        text = _land_text(spark, path, landing, line_breaks)
    else:
        if line_breaks is None:
            line_breaks = bool(spark.read.text(path).filter(_open_quote()).head(1))
        text = _parsed(spark, path, line_breaks)
    if schema is None:
        return _coerce(text, NUMERIC + TEMPORAL)
    return coerce_temporal(_as_declared(text, schema, path))


_QUOTING = {"quote": '"', "escape": '"'}


def _open_quote() -> Column:
    """Whether a line of text begins or ends within quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return quotes % 2 == 1


def _parsed(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    """All columns as text, by Spark's own reader; with ``line_breaks`` a file is one task."""
    reader = spark.read.options(header=True, enforceSchema=False, multiLine=line_breaks, **_QUOTING)
    return reader.csv(path)


def _land_text(spark: SparkSession, path: str, landing: str, line_breaks: bool | None) -> DataFrame:
    """All columns as text, written to ``landing`` by one scan of the file.

    Lines are split off and parsed by many tasks. The same pass counts lines with an odd number of quotes,
    which only a line break within quotes makes: if there are any, the file is parsed again as a whole. It also
    counts header lines, one a file, so that a folder of files with different headers is an error.
    """
    if not line_breaks:
        lines = spark.read.text(path)
        head = lines.first()
        if head is None:
            raise ValueError(f"{path}: no header")
        names = _parsed(spark, path, False).columns
        columns = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
        seen = Observation()
        counted = lines.observe(
            seen, F.count_if(_open_quote()).alias("odd"), F.count_if(F.col("value") == head["value"]).alias("headers")
        )
        body = counted.filter((F.col("value") != head["value"]) & (F.trim("value") != ""))
        rows = body.select(F.from_csv("value", columns, _QUOTING).alias("r")).select("r.*")
        rows.write.mode("overwrite").parquet(landing)
        found = seen.get
        if not found["odd"]:
            files = len(lines.inputFiles())
            if found["headers"] < files:
                raise ValueError(f"{path}: {files} files, but {found['headers']} with the header {head['value']}")
            return spark.read.schema(rows.schema).parquet(landing)
        if line_breaks is False:
            raise ValueError(f"{path}: {found['odd']} lines with an open quote, though no line breaks are declared")
    whole = _parsed(spark, path, True)
    whole.write.mode("overwrite").parquet(landing)
    return spark.read.schema(whole.schema).parquet(landing)


def _as_declared(text: DataFrame, schema: T.StructType | str, path: str) -> DataFrame:
    """Select by header name and cast; raises for names that differ and for values that do not convert."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    lacking = sorted(set(schema.fieldNames()) - set(text.columns))
    unknown = sorted(set(text.columns) - set(schema.fieldNames()))
    if lacking or unknown:
        raise ValueError(f"{path}: columns missing: {lacking}, not declared: {unknown}")
    cast = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    if typed:
        bad = [F.count_if(F.col(f"`{f.name}`").isNotNull() & cast[f.name].isNull()).alias(f.name) for f in typed]
        counts = {k: v for k, v in text.agg(*bad).first().asDict().items() if v}
        if counts:
            raise ValueError(f"{path}: values that do not convert: {counts}")
    return text.select(*[c.alias(n) for n, c in cast.items()])


def coerce_temporal(df: DataFrame) -> DataFrame:
    """Turn text columns that hold only timestamps, or only dates, into those types.

    All-or-nothing per column: one value that does not parse, or no value at all, leaves the
    column as text.
    """
    return _coerce(df, TEMPORAL)


def _coerce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the first rule that fits all values of a text column; one aggregation decides for all."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    tests = []
    for i, name in enumerate(texts):
        value = F.col(f"`{name}`")
        tests.append(F.count(value).alias(f"n{i}"))
        for j, rule in enumerate(rules):
            fits = value.rlike(rule.shape) & rule.convert(value).isNotNull()
            tests.append(F.count_if(fits).alias(f"n{i}_{j}"))
    counts = df.agg(*tests).first()

    def typed(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name in texts and counts[f"n{texts.index(name)}"]:
            i = texts.index(name)
            for j, rule in enumerate(rules):
                if counts[f"n{i}_{j}"] == counts[f"n{i}"]:
                    value = rule.convert(value)
                    break
        return value.alias(name)

    return df.select(*[typed(f.name) for f in df.schema.fields])


def stamp_loaded_at(df: DataFrame, loaded_at: Column | datetime) -> DataFrame:
    """One load time per run, apart from any business date."""
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return df.withColumn(LOADED_AT, stamp.cast("timestamp"))


def with_load_micros(df: DataFrame) -> DataFrame:
    """The load time as a whole number of microseconds too: Parquet footers answer a maximum of those, not of timestamps."""
    return df.withColumn(LOADED_MICROS, F.unix_micros(LOADED_AT))


def load_tables(
    spark: SparkSession,
    source: str,
    data_dir: str,
    loaded_at: Column | datetime,
    tables: Sequence[str] | None = None,
    schemas: Mapping[str, T.StructType | str] | None = None,
    landing: str | None = None,
    line_breaks: Mapping[str, bool] | None = None,
) -> dict[str, DataFrame]:
    """All tables of a source system, typed and stamped, as ``{table: DataFrame}``.

    ``landing`` is a folder for the parsed text; ``line_breaks`` tells of tables whether quoted text holds any.
    """
    schemas = schemas or {}
    loaded = {}
    for table in tables if tables is not None else SOURCES[source]:
        path = f"{data_dir.rstrip('/')}/{table}.csv"
        folder = f"{landing.rstrip('/')}/{table}" if landing else None
        text = load_csv(spark, path, schemas.get(table), (line_breaks or {}).get(table), folder)
        loaded[table] = stamp_loaded_at(text, loaded_at)
    return loaded
