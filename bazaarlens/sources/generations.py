"""Tables in generations: many folders, one log, and views that one append moves on together.

Every write of a table goes to a folder of its own::

    OUT/<table>/<schema>/run=<run>/                            a table written whole
    OUT/<table>/<schema>/run=<run>/purchase_month=<yyyymm>/    a table kept by months

``<schema>`` is a digest of the columns, so one folder never holds two. The log ``OUT/generations`` gets
the lines of a generation by one append of one file, after all its folders are written: for each table the run
that holds it, or for each of its months, which an older run may hold. The last generation is the one with
the largest number, and then run; numbers go up from the largest seen, so clocks do not matter.

The catalog views select by the log's last generation, as a filter on the partition columns ``run`` and
``purchase_month``. A reader between any two steps of a refresh sees all tables of one generation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarlens.sources.storage import read_parquet

#: The log of complete refreshes below the output folder.
GENERATIONS = "generations"
MONTH = "purchase_month"
LOG = (
    "generation long, run string, finished timestamp, table_name string, purchase_month int, "
    "stored_run string, columns string"
)


@dataclass(frozen=True)
class Line:
    """Where one table, or one month of it, is held."""

    table: str
    run: str
    columns: str
    month: int | None = None


def columns_of(frame: DataFrame) -> str:
    """The columns of a table in DDL, its month left out."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name != MONTH)


def table_folder(out: str, table: str, columns: str) -> str:
    return f"{out}/{table}/{hashlib.sha256(columns.encode()).hexdigest()[:12]}"


def run_folder(out: str, table: str, columns: str, run: str) -> str:
    return f"{table_folder(out, table, columns)}/run={run}"


def log_of(spark: SparkSession, out: str) -> DataFrame:
    """The log; empty before the first refresh."""
    try:
        return read_parquet(spark, f"{out}/{GENERATIONS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def last_lines(spark: SparkSession, out: str) -> list[Row]:
    """The last generation's lines: one per table, or per table and month."""
    log = log_of(spark, out)
    key = F.struct("generation", "run")
    last = log.agg(F.max(key).alias("last")).first()["last"]
    if last is None:
        return []
    return log.where((F.col("generation") == last.generation) & (F.col("run") == last.run)).collect()


def add_generation(spark: SparkSession, out: str, run: str, lines: Iterable[Line]) -> int:
    """Append one generation to the log, after which readers find it. Returns its number."""
    seen = log_of(spark, out).agg(F.max("generation")).first()[0] or 0
    rows = [(seen + 1, run, line.table, line.month, line.run, line.columns) for line in lines]
    kinds = "generation long, run string, table_name string, purchase_month int, stored_run string, columns string"
    frame = spark.createDataFrame(rows, kinds).withColumn("finished", F.current_timestamp())
    names = [name.split()[0] for name in LOG.split(", ")]
    frame.select(*names).coalesce(1).write.mode("append").parquet(f"{out}/{GENERATIONS}")
    return seen + 1


def open_table(spark: SparkSession, out: str, table: str, lines: Iterable[Row]) -> DataFrame:
    """One table of the generation with these lines, as its columns and, if it is kept by months, ``purchase_month``."""
    own = sorted((line for line in lines if line["table_name"] == table), key=lambda r: (r["finished"], r["purchase_month"] or 0))
    by_schema: dict[str, list[Row]] = {}
    for line in own:
        by_schema.setdefault(line["columns"], []).append(line)
    parts = []
    for columns, held in by_schema.items():
        months = [r for r in held if r["purchase_month"] is not None]
        if months:
            paths = [f"{run_folder(out, table, columns, r['stored_run'])}/{MONTH}={r['purchase_month']}" for r in months]
            stored = spark.read.schema(f"{columns}, run string, {MONTH} int")
            parts.append(stored.option("basePath", table_folder(out, table, columns)).parquet(*paths).drop("run"))
        else:
            parts.extend(read_parquet(spark, run_folder(out, table, columns, r["stored_run"])) for r in held)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def tables_of(lines: Iterable[Row]) -> list[str]:
    return list(dict.fromkeys(line["table_name"] for line in lines))


def _cells(columns: str, all_columns: Mapping[str, str]) -> str:
    own = {f.name for f in StructType.fromDDL(columns).fields}
    return ", ".join(f"`{n}`" if n in own else f"CAST(NULL AS {kind}) AS `{n}`" for n, kind in all_columns.items())


def view_sql(spark: SparkSession, out: str, table: str, versions: list[str], monthly: bool) -> str:
    """A query for the last generation of a table; ``versions`` are its columns so far, the newest last."""
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(versions[-1]).fields}
    log = f"parquet.`{out}/{GENERATIONS}`"
    selects = []
    for columns in versions:
        stored = f"parquet.`{table_folder(out, table, columns)}`"
        cells, these = _cells(columns, kinds), f"columns = {_text(columns)}"
        if monthly:
            selects.append(
                f"SELECT {cells}, {MONTH} FROM {stored} AS stored JOIN ("
                f"SELECT stored_run, purchase_month AS held_month FROM {log} WHERE table_name = '{table}' AND {these} "
                f"AND struct(generation, run) = (SELECT max(struct(generation, run)) FROM {log})"
                f") AS held ON run = stored_run AND {MONTH} = held_month"
            )
        else:
            # Every generation has a line for such a table; the last one has these columns, or there are no rows.
            selects.append(
                f"SELECT {cells} FROM {stored} WHERE run = (SELECT max_by(if({these}, stored_run, NULL), "
                f"struct(generation, run)) FROM {log} WHERE table_name = '{table}')"
            )
    return " UNION ALL ".join(selects)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, out: str, database: str, lines: Iterable[Line]) -> None:
    """Views of all tables of a generation that is about to be added, its folders written.

    The log must exist, so the first generation is added first; nobody has read the views before.

    A view is replaced only where the table's columns are new. It reads the folders of all
    columns so far, each by the log, so it shows the last generation before the append and the new one after.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    log = log_of(spark, out)
    known = {
        (r["table_name"], r["columns"]): r["first"]
        for r in log.groupBy("table_name", "columns").agg(F.min(F.struct("generation", "run")).alias("first")).collect()
    }
    found: dict[str, list[str]] = {}
    for table, columns in sorted(known, key=lambda k: known[k]):
        found.setdefault(table, []).append(columns)
    lines = list(lines)
    for table in dict.fromkeys(line.table for line in lines):
        own = [line for line in lines if line.table == table]
        versions = [v for v in found.get(table, ()) if v != own[-1].columns] + [own[-1].columns]
        sql = view_sql(spark, out, table, versions, own[-1].month is not None)
        create_view(spark, database, table, sql)


def create_view(spark: SparkSession, database: str, name: str, sql: str) -> None:
    """Make the view, unless it stands with this definition. Replacing is one step for its readers."""
    digest = hashlib.sha256(sql.encode()).hexdigest()
    if spark.catalog.tableExists(f"{database}.{name}"):
        if _digest(spark, f"{database}.{name}") == digest:
            return
        if spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE `{database}`.`{name}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` TBLPROPERTIES ('definition' = '{digest}') AS {sql}")


def _digest(spark: SparkSession, name: str) -> str | None:
    shown = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'definition'").first()
    return shown["value"] if shown else None
