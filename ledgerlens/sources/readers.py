"""Readers for files, record batches and external stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.split import hash_bucket
from ..operators.validate import nan_to_null

_FORMATS = ("csv", "parquet", "json")


class UnsupportedFormatError(ValueError):
    """The file format is not one of csv, parquet, json."""


def read_table(
    spark: SparkSession, path: str, file_format: str = "csv", schema: T.StructType | None = None, **options
) -> DataFrame:
    """A whole table. Give a schema: without one, csv needs a pass to infer types."""
    kind = file_format.lower()
    if kind not in _FORMATS:
        raise UnsupportedFormatError(f"{file_format}: expected one of {', '.join(_FORMATS)}")
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "parquet":
        return nan_to_null(reader.parquet(path))
    if kind == "json":
        return nan_to_null(reader.json(path))
    reader = reader.options(header=True, nanValue="nan", nullValue="", escape='"', quote='"')
    if schema is None and "inferSchema" not in options:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def first_rows(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """The first `n` rows; by `key` when they must be the same every time."""
    return df.orderBy(key).limit(n) if key else df.limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 6, key: str | None = None) -> DataFrame:
    """A random share of the rows. With `key` the choice depends on the key only, so it is the
    same for any partitioning."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    if key is None:
        return df.sample(False, fraction, seed)
    return df.where(hash_bucket(key, seed, 1_000_000) < F.lit(round(fraction * 1_000_000)))


def read_rows(df: DataFrame, nrows: int | float | None, seed: int = 6, key: str | None = None) -> DataFrame:
    """`nrows` as users give it: a whole number is a limit, a fraction a sample, None all."""
    if nrows is None:
        return df
    if isinstance(nrows, float) and 0.0 < nrows <= 1.0:
        return sample_rows(df, nrows, seed, key)
    return first_rows(df, int(nrows), key)


# ---- delimited text with an unknown delimiter ------------------------------------------------

_DELIMITERS = ("\t", ",", ";", "|")


def sniff_delimiter(header: str) -> str | None:
    """The most frequent of tab, comma, semicolon and pipe; None means blanks."""
    counts = [(header.count(d), -i, d) for i, d in enumerate(_DELIMITERS)]
    best = max(counts)
    return best[2] if best[0] else None


def _unquote(value: str) -> str:
    return value.strip().strip("\"'") if value is not None else value


def read_delimited(spark: SparkSession, path: str, numeric: bool = True) -> DataFrame:
    """Text with a header line and a delimiter found from it.

    Quotes around values are dropped, lines with fewer than two values or no content are left
    out, absent values become null. With `numeric`, columns holding only numbers become doubles.
    """
    lines = spark.read.text(path)
    first = lines.where("length(trim(value)) > 0").first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    header = first[0].strip("\r\n ")
    delimiter = sniff_delimiter(header)
    names = [_unquote(h) for h in (header.split(delimiter) if delimiter else header.split())]
    if len(names) < 2:
        return spark.createDataFrame([], T.StructType([]))
    pattern = r"\s+" if delimiter is None else ("[|]" if delimiter == "|" else delimiter)
    content = F.rtrim(F.regexp_replace("value", "\r$", ""))
    # Every file of the folder may repeat the header line.
    body = lines.where((F.trim("value") != "") & (F.trim(content) != header.strip()))
    split = body.select(F.split(F.regexp_replace("value", "\r$", "") if delimiter else F.trim(content), pattern).alias("v"))
    split = split.where(F.size("v") >= 2)
    cell = lambda i: F.nullif(
        F.regexp_replace(F.trim(F.try_element_at("v", F.lit(i + 1))), "^[\"']|[\"']$", ""), F.lit("")
    )
    table = split.select(*[cell(i).alias(n) for i, n in enumerate(names)])
    table = table.dropna(how="all")
    if not numeric:
        return table
    checks = table.agg(
        *[F.expr(f"count(`{n}`) > 0 AND count(`{n}`) = count(try_cast(`{n}` AS DOUBLE))").alias(n) for n in names]
    ).first()
    return table.select(*[F.col(n).cast("double").alias(n) if checks[n] else F.col(n) for n in names])


# ---- record batches --------------------------------------------------------------------------

def records_to_table(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """JSON text holding a list of objects (or one object) per row becomes one row per object;
    absent keys are null."""
    text = F.trim(F.col(column))
    as_list = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return df.select(F.inline(F.from_json(as_list, T.ArrayType(schema))))


# ---- external stores ---------------------------------------------------------------------------

def object_store_uri(bucket: str, key: str, scheme: str = "s3a") -> str:
    return f"{scheme}://{bucket.strip('/')}/{key.lstrip('/')}"


def configure_object_store(spark: SparkSession, access_key: str, secret_key: str, region: str | None = None) -> None:
    """Credentials for `s3a` paths; clusters usually bring their own and need no call."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.s3a.access.key", access_key)
    conf.set("fs.s3a.secret.key", secret_key)
    if region:
        conf.set("fs.s3a.endpoint.region", region)


def read_object_store(
    spark: SparkSession, bucket: str, key: str, file_format: str = "csv",
    schema: T.StructType | None = None, nrows: int | float | None = None, **options,
) -> DataFrame:
    return read_rows(read_table(spark, object_store_uri(bucket, key), file_format, schema, **options), nrows)


def document_options(
    database: str, collection: str, query: dict | None = None, connection: str | None = None,
    host: str = "localhost", port: int = 27017, username: str | None = None, password: str | None = None,
    auth_source: str = "admin",
) -> dict[str, str]:
    """Options of the document-store connector; the filter runs in the store."""
    import json
    from urllib.parse import quote

    if connection is None:
        login = f"{quote(username, safe='')}:{quote(password, safe='')}@" if username and password else ""
        connection = f"mongodb://{login}{host}:{port}/" + (f"?authSource={auth_source}" if login else "")
    options = {"connection.uri": connection, "database": database, "collection": collection}
    if query:
        options["aggregation.pipeline"] = json.dumps([{"$match": query}])
    return options


def read_documents(
    spark: SparkSession, database: str, collection: str, projection: list[str] | None = None,
    limit: int | None = None, **options,
) -> DataFrame:
    """A document collection; ids become text. Needs the connector on the class path."""
    df = spark.read.format("mongodb").options(**document_options(database, collection, **options)).load()
    if projection:
        df = df.select(*projection)
    if "_id" in df.schema.names:
        df = df.withColumn("_id", F.col("_id").cast("string"))
    return df.limit(limit) if limit else df


def warehouse_options(
    project: str, query: str | None = None, dataset: str | None = None, table: str | None = None,
    credentials: str | None = None,
) -> dict[str, str]:
    """Options of the warehouse connector: a query, or a whole table read in parallel."""
    if query is None and (dataset is None or table is None):
        raise ValueError("give a query, or both dataset and table")
    options = {"parentProject": project}
    if query is not None:
        options.update(query=query, viewsEnabled="true")
        if dataset:
            options["materializationDataset"] = dataset
    else:
        options["table"] = f"{project}.{dataset}.{table}"
    if credentials:
        options["credentialsFile"] = credentials
    return options


def read_warehouse(spark: SparkSession, project: str, **source) -> DataFrame:
    return spark.read.format("bigquery").options(**warehouse_options(project, **source)).load()


def relational_options(
    url: str | None = None, query: str | None = None, table: str | None = None, schema: str = "public",
    host: str = "localhost", port: int = 5432, database: str | None = None,
    username: str | None = None, password: str | None = None,
    partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 32,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read. With a partition column and bounds, executors read ranges of it
    in parallel instead of one connection reading everything."""
    if url is None:
        if not all([database, username, password]):
            raise ValueError("give a url, or database, username and password")
        url = f"jdbc:postgresql://{host}:{port}/{database}"
    if query is None and table is None:
        raise ValueError("give a query or a table")
    options = {"url": url, "fetchsize": str(fetch_rows)}
    if username:
        options.update(user=username, password=password or "")
    if partition_column and bounds:
        source = f'"{schema}"."{table}"' if query is None else f"({query}) AS source"
        options.update(
            dbtable=source, partitionColumn=partition_column, lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]), numPartitions=str(partitions),
        )
    elif query is not None:
        options["query"] = query
    else:
        options["dbtable"] = f'"{schema}"."{table}"'
    return options


def read_relational(spark: SparkSession, **source) -> DataFrame:
    return spark.read.format("jdbc").options(**relational_options(**source)).load()
