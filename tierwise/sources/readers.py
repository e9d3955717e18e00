"""Landing-file readers (S1, S2) and the ingest stamp (S3).

Landing files are read with an explicit all-text schema by default: typing
happens in silver with ``try_cast`` so one bad value cannot change a column's
type or fail the job. ``infer=True`` reproduces the reference's inferred read.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.operators.clean import CORRUPT

# The reference's landing-file columns, in file order.
ORDERS_COLUMNS = ["order_id", "customer_id", "product_id", "order_date", "quantity",
                  "unit_price", "amount", "channel", "discount_pct"]
CUSTOMERS_COLUMNS = ["customer_id", "name", "email", "region", "segment", "country_code",
                     "updated_at"]
PRODUCTS_COLUMNS = ["product_id", "name", "category", "brand", "unit_cost"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_schema(spark: SparkSession, path: str, columns: list[str]) -> T.StructType:
    """All-text schema in the order of the files' own header (names decide, not
    positions), with a column for records that do not fit it."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header ({', '.join(header)})")
    return text_schema([*header, CORRUPT])


#: The header of every file is compared with the schema, so a file whose columns are in
#: another order stops the read instead of filling the wrong columns.
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "enforceSchema": "false",
               "columnNameOfCorruptRecord": CORRUPT}

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def scan_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header row. Splittable: large files are read in parallel. With
    ``columns`` they are taken by name from each file's own header: files are grouped by header
    and a group is read with its schema, so columns may stand in any order, and further
    ones are left out. A record with too many or too few fields keeps its whole text in
    ``_corrupt_record``, as does every line of a file that lacks a column while others
    have all (if none has, the path is wrong and the read stops); ``_file`` names the file of each row."""
    if infer or columns is None:
        return spark.read.option("header", True).option("inferSchema", infer).csv(path)
    groups = csv_headers(spark, path)
    parts = []
    for header in sorted(groups):
        if set(columns) <= set(header):
            rows = spark.read.options(**CSV_OPTIONS).schema(text_schema([*header, CORRUPT])).csv(groups[header])
            parts.append(rows.select(*columns, CORRUPT, F.col("_metadata.file_path").alias("_file")))
    if not parts:
        missing = {h: [c for c in columns if c not in h] for h in groups}
        raise ValueError(f"{path}: no file has a header with all columns; missing: "
                         + "; ".join(f"{', '.join(m)} in ({', '.join(h)})" for h, m in missing.items()))
    for header in sorted(groups):
        if not set(columns) <= set(header) and header:  # an empty file has no line
            lines = spark.read.text(groups[header])
            parts.append(lines.select(*[F.lit(None).cast("string").alias(c) for c in columns],
                                      F.col("value").alias(CORRUPT), F.col("_metadata.file_path").alias("_file")))
    return reduce(DataFrame.unionByName, parts)


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files under ``path`` by their header. Only first lines are read, some files at a time."""
    from tierwise.sources.snapshots import Store

    store = Store(spark)
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda f: store.first_line(unquote(f)), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        out.setdefault(tuple(next(csv.reader([line]), ())), []).append(unquote(file))
    return out


def scan_json(spark: SparkSession, path: str, columns: list[str] | None = None,
              multiline: bool = True) -> DataFrame:
    """JSON. ``multiline`` reads a file holding one array (the reference's
    landing format); such a file is one task. Use JSON lines
    (``multiline=False``) for large inputs, which split across tasks. With ``columns``
    what cannot be parsed (a whole file, or a line) keeps its text in ``_corrupt_record``."""
    reader = spark.read.option("multiLine", multiline)
    if columns is None:
        return reader.json(path)
    rows = reader.options(**JSON_OPTIONS).schema(text_schema([*columns, CORRUPT])).json(path)
    return rows.select(*columns, CORRUPT, F.col("_metadata.file_path").alias("_file"))


def stamp_ingest(df: DataFrame, source: str) -> DataFrame:
    """Bronze metadata: ``_ingest_at`` (processing time) and ``_source``."""
    return df.withColumn("_ingest_at", F.current_timestamp()).withColumn("_source", F.lit(source))
