"""File sources: CSV, JSON (lines or arrays of objects) and Parquet, plus JSON-lines landing.

Every reader returns a lazy DataFrame; filters and projections applied later are pushed
into the scan by Catalyst.  A missing path is reported as ``FileNotFoundError`` naming it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from flowtable.errors import SourceError
from flowtable.session import scratch_path


def _not_found(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    return (cond() if cond else "") == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc)


def missing_path(reader: Callable[[], DataFrame], path: str | list[str], kind: str) -> DataFrame:
    """``reader()``; a path that does not exist is a ``FileNotFoundError`` naming it."""
    try:
        return reader()
    except AnalysisException as exc:
        if _not_found(exc):
            raise FileNotFoundError(f"{kind} source not found: {path}") from exc
        raise


BAD_VALUE = "MALFORMED_RECORD_IN_PARSING"  # how a FAILFAST read names a value that does not fit

# Texts that stand for a missing value in CSV, as common data-frame readers take them.
NULL_TOKENS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
               "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer: bool = True,
    null_tokens: Sequence[str] = NULL_TOKENS,
    check_quotes: bool = True,
    **options: str,
) -> DataFrame:
    """CSV with a header row, any file extension, column names kept verbatim.

    Files are split between tasks, a record being a line.  A source whose quoted values hold line breaks says
    so with ``multiLine="true"``; then one task reads each file.  Without it a pass over the lines stops the
    read with a ``SourceError`` if a quote stays open at the end of a line (``check_quotes=False`` leaves the pass
    out).  Values equal to one of ``null_tokens`` are NULL, before types are inferred.

    With ``schema`` nothing is inferred (the production choice: inference costs an extra
    pass over the data).  A header-only file gives an empty frame of string columns.
    """
    opts = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "multiLine": "false", **options}

    def load(**more) -> DataFrame:
        reader = spark.read.options(**opts, **more)
        return missing_path(lambda: (reader if wanted is None else reader.schema(wanted)).csv(path), path, "CSV")

    wanted = None
    text = load()  # all columns as text
    if check_quotes and opts["multiLine"].lower() == "false":
        _require_closed_quotes(spark, path, opts)
    if schema is not None:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    elif infer:
        wanted = _inferred(spark, text, load(inferSchema="true").schema, null_tokens)
    if null_tokens and wanted is not None and opts["mode"].upper() == "FAILFAST":
        return _strictly_typed(_without_tokens(text, null_tokens), wanted)
    return _without_tokens(load(), null_tokens)


def _require_closed_quotes(spark: SparkSession, path: str, opts: dict[str, str]) -> None:
    """Stop if a line ends inside a quoted value: it holds an odd number of quotes, these being doubled inside values."""
    if opts.get("quote", '"') != '"' or opts["escape"] != '"' or "encoding" in opts or "charset" in opts:
        return  # other rules: the reader alone knows them
    lines = spark.read.options(**{k: v for k, v in opts.items() if k in ("lineSep", "recursiveFileLookup", "pathGlobFilter")}).text(path)
    open_quote = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
    if opts.get("comment"):
        open_quote = open_quote & ~F.col("value").startswith(opts["comment"])
    found = lines.where(open_quote).take(1)
    if found:
        raise SourceError(f"CSV source {path}: a quote stays open at the end of a line, as in {found[0][0][:80]!r}; "
                          'if values hold line breaks, set the option multiLine="true"')


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _without_tokens(df: DataFrame, null_tokens: Sequence[str]) -> DataFrame:
    """Texts that stand for a missing value (and a number that is not one) become NULL."""
    if not null_tokens:
        return df
    out = []
    for field in df.schema.fields:
        c = _column(field.name)
        if isinstance(field.dataType, StringType):
            c = F.when(~c.isin(*null_tokens), c)
        elif isinstance(field.dataType, (FloatType, DoubleType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(field.name))
    return df.select(*out)


_PLAIN = r"^[-+0-9.,:/ TZeE]+$|^(?i:true|false)$"  # what a number, date, time or boolean can be written with


def _inferred(spark: SparkSession, text: DataFrame, found: StructType, null_tokens: Sequence[str]) -> StructType:
    """Spark's own inference.  Columns that came out as text, hold null tokens and nothing else that must be text are
    inferred again without the tokens; only these columns are written for that."""
    texts = [f.name for f in found.fields if isinstance(f.dataType, StringType)]
    if not null_tokens or not texts:
        return found
    marks = {}
    for i, name in enumerate(texts):
        token = _column(name).isin(*null_tokens)
        marks[f"t{i}"] = F.bool_or(token)
        marks[f"p{i}"] = F.bool_and(token | _column(name).rlike(_PLAIN))
    seen = text.agg(*[e.alias(k) for k, e in marks.items()]).first()
    again = [name for i, name in enumerate(texts) if seen[f"t{i}"] and seen[f"p{i}"]]
    if not again:
        return found
    masked = scratch_path(spark, "csv-columns")
    _without_tokens(text.select(*[_column(n) for n in again]), null_tokens).write.option("header", "false").option("escape", '"').csv(masked)
    types = [f.dataType for f in spark.read.option("inferSchema", "true").option("escape", '"').csv(masked).schema.fields]
    better = dict(zip(again, types)) if len(types) == len(again) else {}
    return StructType([StructField(f.name, better.get(f.name, f.dataType)) for f in found.fields])


def _strictly_typed(text: DataFrame, wanted: StructType) -> DataFrame:
    """Text as the wanted types by position; a value that does not fit stops the query."""
    names = [*text.columns, *[None] * (len(wanted.fields) - len(text.columns))]  # absent columns are NULL
    out = []
    for name, field in zip(names, wanted.fields):
        c = _column(name) if name else F.lit(None).cast("string")
        value = c.try_cast(field.dataType)
        message = F.concat(F.lit(f"{BAD_VALUE}: column {field.name} can't hold "), c)
        value = F.when(c.isNotNull() & value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return text.select(*out)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    array: bool = False,
    **options: str,
) -> DataFrame:
    """JSON records: one object per line (splittable), or files holding one array of objects.

    For arrays each element becomes a row and the keys of all elements are unioned; such a
    file is parsed by one task, so landing files should stay near the split size.
    """
    reader = spark.read.options(**{"multiLine": str(bool(array)).lower(), **options})
    if schema is not None:
        reader = reader.schema(schema)
    return missing_path(lambda: reader.json(path), path, "JSON")


def read_parquet(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return missing_path(lambda: spark.read.options(**options).parquet(*paths), path, "Parquet")


_READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "json": read_json,
    "parquet": read_parquet,
}


def read_source(spark: SparkSession, source) -> DataFrame:
    """Dispatch on ``source.type``: csv, json, parquet, or api (landed JSON arrays)."""
    kind = source.type
    options = dict(getattr(source, "options", None) or {})
    schema = getattr(source, "schema", None)
    if kind == "api":
        path = source.path or source.endpoint
        return read_json(spark, path, schema=schema, array=True, **options)
    if kind not in _READERS:
        raise SourceError(f"Unsupported source type: {kind}")
    if not source.path:
        raise SourceError(f"source of type {kind} needs a path")
    if kind == "parquet":
        return read_parquet(spark, source.path, **options)
    return _READERS[kind](spark, source.path, schema=schema, **options)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Land ``df`` as JSON, one object on a line (splittable, rendered in the JVM, NULLs kept)."""
    df.write.option("ignoreNullFields", "false").mode("errorifexists").json(path)
