"""CSV files. Columns are found by header name and cast to declared types."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.operators.dense_index import file_order_index


Paths = str | list[str]


def _read_text(spark: SparkSession, path: Paths, required: list[str], **options: str) -> DataFrame:
    """All columns as text. The first header names them; each other file must agree."""
    reader = spark.read.options(header=True, **options)
    names = reader.csv(path).columns
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return reader.schema(text).options(enforceSchema=False).csv(path)


def read_transactions_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TRANSACTION, **options: str
) -> DataFrame:
    """Transactions with the declared types; columns beyond the schema stay text.

    A cell that does not fit its type is null, and so is left out by the validity filter.
    """
    rows = _read_text(spark, path, schema.names, **options)
    types = {field.name: field.dataType for field in schema.fields}
    return rows.select(
        *[
            F.col(f"`{name}`").try_cast(types[name]).alias(name)
            if name in types
            else F.col(f"`{name}`")
            for name in rows.columns
        ]
    )


def read_sales_csv(
    spark: SparkSession, path: Paths, indexed: bool = False, folder: str | None = None, **options: str
) -> DataFrame:
    """The four sales columns as text; with `indexed` also `row_index` in file order.

    A quote inside a quoted cell is doubled. Cells with line breaks need `multiLine=True`.
    """
    options = {"escape": '"'} | options
    rows = _read_text(spark, path, schemas.SALES.names, **options).select(*schemas.SALES.names)
    return file_order_index(rows, folder=folder) if indexed else rows


def first_sales_files(spark: SparkSession, path: Paths, rows: int, **options: str) -> list[str]:
    """The first files, in file order, that hold `rows` rows together, or all files.

    Rows of the first file are counted, then of the first two, four and so on: what is read
    follows the number of rows and not the size of the input.
    """
    found = read_sales_csv(spark, path, **options).inputFiles()
    files = [unquote(name) for name in sorted(found)]
    taken = 1
    while taken < len(files) and read_sales_csv(spark, files[:taken], **options).count() < rows:
        taken *= 2
    return files[:taken]
