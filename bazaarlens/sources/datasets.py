"""The nine raw datasets and how to read them from CSV."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import to_double


#: Headers of files that are read at the same time, each by a job that reads one line.
HEADERS_AT_ONCE = 16


@dataclass(frozen=True)
class Dataset:
    """One raw dataset: its file name pattern and the types of the columns in use.

    Columns that are not declared are kept as text. ``multiline`` datasets hold
    free text, with line breaks and doubled quotes inside quoted fields.
    """

    pattern: str
    types: Mapping[str, str] = field(default_factory=dict)
    multiline: bool = False


# Raw file names (any publisher prefix) and column types.
DATASETS: dict[str, Dataset] = {
    "orders": Dataset(
        "*_orders_dataset.csv",
        {
            "order_id": "string",
            "customer_id": "string",
            "order_status": "string",
            "order_purchase_timestamp": "timestamp_ntz",
            "order_delivered_customer_date": "timestamp_ntz",
            "order_estimated_delivery_date": "timestamp_ntz",
        },
    ),
    "order_items": Dataset(
        "*_order_items_dataset.csv",
        {
            "order_id": "string",
            "product_id": "string",
            "seller_id": "string",
            "price": "double",
            "freight_value": "double",
        },
    ),
    "products": Dataset(
        "*_products_dataset.csv",
        {"product_id": "string", "product_category_name": "string"},
    ),
    "customers": Dataset(
        "*_customers_dataset.csv",
        {"customer_id": "string", "customer_state": "string"},
    ),
    "sellers": Dataset(
        "*_sellers_dataset.csv",
        {"seller_id": "string", "seller_city": "string", "seller_state": "string"},
    ),
    "reviews": Dataset(
        "*_order_reviews_dataset.csv",
        {"order_id": "string", "review_score": "string"},
        multiline=True,
    ),
    "payments": Dataset(
        "*_order_payments_dataset.csv",
        {"order_id": "string", "payment_value": "double", "payment_installments": "double"},
    ),
    "geolocation": Dataset("*_geolocation_dataset.csv"),
    "category": Dataset(
        "product_category_name_translation.csv",
        {"product_category_name": "string", "product_category_name_english": "string"},
    ),
}


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    reader = spark.read.option("header", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader


def read_text_csv(
    spark: SparkSession, path: str | list[str], multiline: bool = False, drop_broken: bool = False
) -> DataFrame:
    """A headered CSV with every column as text.

    Plain CSV is split within files. Multi-line CSV is split by file only, so
    large free-text datasets should come as many files. All files must have the
    same columns in the same order: reading fails on a file whose header differs.

    A record with too few cells has nulls for the others, and one with too many loses the rest; with
    ``drop_broken`` such records are left out. :func:`read_records` finds them.
    """
    reader = _reader(spark, multiline).option("enforceSchema", False)
    if drop_broken:
        # Without column pruning the cells of a record are counted whichever columns are asked for.
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", False)
    return reader.csv(path)


def read_records(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every record of a raw dataset as it stands in its file, by the same splitting into records.

    Columns: ``record``; ``cells``, how many it has, null if a quote that opens a cell is never closed; and
    ``expected``, the columns of the header.
    """
    spec = DATASETS[name]
    path = f"{root}/{spec.pattern}"
    columns = read_text_csv(spark, path, spec.multiline).columns
    # Read as a single column, every record of more cells counts as corrupt, and so its text is kept. A
    # record of one cell is that cell, without quotes around it.
    reader = _reader(spark, spec.multiline).schema("cell string, record string")
    reader = reader.option("columnNameOfCorruptRecord", "record").option("columnPruning", False)
    rows = reader.csv(path).select(F.coalesce("record", "cell", F.lit("")).alias("record"))
    # Escaped quotes go, and then whole quoted cells, up to the comma. What still begins with a quote is open.
    plain = F.replace("record", F.lit('""'), F.lit("")) if spec.multiline else F.regexp_replace("record", r"\\.", "")
    outside = F.regexp_replace(plain, '(^|,)"[^"]*+"[^,]*+', "$1")
    counted = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    cells = F.when(~F.regexp_like(outside, F.lit('(^|,)"')), counted)
    return rows.select("record", cells.cast("int").alias("cells"), F.lit(len(columns)).alias("expected"))


def publishers(frame: DataFrame, pattern: str) -> set[str]:
    """The distinct file or folder names that the pattern found."""
    return {
        part
        for path in frame.inputFiles()
        for part in unquote(path).split("/")
        if fnmatchcase(part, pattern)
    }


def typed(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Declared types for text columns. A value that does not parse becomes null."""

    def column(name: str) -> Column:
        kind = types.get(name, "string")
        if kind == "double":
            return to_double(f"`{name}`").alias(name)
        value = F.col(f"`{name}`")
        return value if kind == "string" else value.try_cast(kind).alias(name)

    return frame.select(*(column(name) for name in frame.columns))


def united_by_header(
    spark: SparkSession, path: str, spec: Dataset, drop_broken: bool = False
) -> DataFrame:
    """Files with different headers as one table: columns by name, null where a file lacks one.

    The header of every file is read first, a few at a time, and files with one header are read together. A file that
    lacks a declared column, or has a column twice, is refused by name.
    """
    files = [unquote(name) for name in sorted(spark.read.text(path).inputFiles())]

    def header(file: str) -> tuple[str, ...]:
        first = spark.read.option("header", False).option("multiLine", spec.multiline).csv(file).head()
        return tuple((cell or "").removeprefix("\ufeff") for cell in first or ())

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = dict(zip(files, pool.map(header, files), strict=True))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in headers.items():
        lacking = set(spec.types) - set(names)
        if lacking or len(set(names)) < len(names):
            raise ValueError(f"{file} lacks {sorted(lacking)}" if lacking else f"{file} has a column twice: {names}")
        groups.setdefault(names, []).append(file)
    parts = [read_text_csv(spark, group, spec.multiline, drop_broken) for group in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_dataset(
    spark: SparkSession,
    root: str,
    name: str,
    raw: bool = False,
    drop_broken: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """One raw dataset below ``root``; with ``raw``, all columns stay text.

    With ``mixed_headers`` its files may have their columns in any order, and some may have more of them.
    """
    spec = DATASETS[name]
    path = f"{root}/{spec.pattern}"
    if mixed_headers:
        text = united_by_header(spark, path, spec, drop_broken)
    else:
        text = read_text_csv(spark, path, spec.multiline, drop_broken)
    found = publishers(text, spec.pattern)
    if len(found) > 1:
        raise ValueError(f"several files or folders match {spec.pattern}: {sorted(found)}")
    return text if raw else typed(text, spec.types)


def read_datasets(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(DATASETS),
    raw: bool = False,
    drop_broken: bool = False,
    mixed_headers: bool = False,
) -> dict[str, DataFrame]:
    """The raw datasets by logical name."""
    return {
        name: read_dataset(spark, root, name, raw, drop_broken, mixed_headers) for name in names
    }
