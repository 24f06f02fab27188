"""Reading and writing the catalogue's files, and their integrity.

The ordinal of a row in its file is data here (keep-first rules and row numbers depend on it), so ingestion assigns
``_ord`` once: by file name, then position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom import schema
from catloom.schema import SchemaMismatch, check_header, filled, strings
from catloom.runtime import cut
from catloom.sources import integrity
from catloom.sources.split_csv import read_split_csv


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def require(spark: SparkSession, path: str, label: str) -> None:
    """A file must be there and hold something."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(f"{label}: {path} does not exist")
    if fs.isFile(at) and not fs.getFileStatus(at).getLen():
        raise ValueError(f"{label}: {path} is empty")


def header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns


def with_order(df: DataFrame, name: str = "_ord") -> DataFrame:
    """A dense ordinal from 0 by file name and position, without a global window: counts per partition are summed."""
    marked = cut(df.withColumn("__file", F.col("_metadata.file_name")).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = marked.groupBy("__file", part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first"))
    from pyspark.sql.window import Window

    # one row per file and partition: the only thing that is ordered as a whole
    before = F.coalesce(F.sum("n").over(Window.orderBy("__file", "p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("__file").alias("f"), F.col("p"), "first", before.alias("before"))
    joined = marked.join(F.broadcast(starts), (F.col("__file") == F.col("f")) & (part == F.col("p")))
    return joined.withColumn(name, F.col("before") + F.col("__id") - F.col("first")).drop("f", "p", "first", "before", "__id", "__file")


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """All cells as strings, empty ones as empty strings; quotes and line breaks inside cells are kept. Files are read in ranges."""
    found = read_split_csv(spark, path, columns or header(spark, path))
    return found.drop("file") if ordered else found.drop("_ord", "file")


def read_strict(spark: SparkSession, path: str, columns: list[str] | None = None, min_rows: int = 1) -> DataFrame:
    """A table that must have exactly these columns in this order, and enough rows."""
    columns = columns or schema.FACT
    require(spark, path, "input")
    check_header(path, header(spark, path), columns)
    df = read_csv(spark, path, columns)
    if min_rows and df.limit(min_rows).count() < min_rows:
        raise SchemaMismatch(path, [], [], f"fewer than {min_rows} rows")
    return df


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A missing file is an empty table."""
    if not exists(spark, path):
        from pyspark.sql import types as T

        return spark.createDataFrame([], strings(columns).add("_ord", T.LongType()))
    return read_csv(spark, path, columns)


def read_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """All feeds of a folder in file order, ten stripped columns; the source defaults to the file's name."""
    from catloom.functions.text import strip

    df = read_split_csv(spark, folder, schema.SOURCE, "*.csv")
    stem = F.regexp_replace(F.url_decode(F.element_at(F.split("file", "/"), -1)), r"\.csv$", "")
    source = F.when(strip("discovery_source") == "", stem).otherwise(strip("discovery_source"))
    return df.select("_ord", *[(source if c == "discovery_source" else strip(c)).alias(c) for c in schema.SOURCE])


def row_number(order: str = "_ord"):
    """Line number in the file: the header is line 1."""
    return F.col(order) + 2


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the search log; a missing file has none."""
    from catloom.operators.reconcile import ENTRY, LOG

    if not exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    log = spark.read.schema(LOG).option("multiLine", True).json(path)
    return log.select(F.posexplode("entries").alias("_ord", "e")).select("_ord", "e.*")


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Whole files as ``file, payload``."""
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(folder)
    return raw.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("payload"))


def guard(new_rows: int, columns: list[str], expected: list[str] | None, old_rows: int | None, min_rows: int = 0, max_shrink: float = 10.0) -> None:
    """Refuse writes with too few rows, other columns, or a shrink beyond ``max_shrink`` percent."""
    if new_rows < min_rows:
        raise ValueError(f"{new_rows} rows, at least {min_rows} are expected")
    if expected is not None:
        check_header("output", columns, expected)
    if old_rows and (old_rows - new_rows) * 100.0 / old_rows > max_shrink:
        raise ValueError(f"{new_rows} rows would replace {old_rows}")


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, expected: list[str] | None = None, min_rows: int = 0, backup: bool = True, order: str | None = "_ord") -> None:
    """Replace a table: written beside the target, guarded, the old one kept as ``.bak``, then renamed."""
    spark = df.sparkSession
    columns = columns or [c for c in df.columns if c != order]
    fs, target = _fs(spark, path)
    old = read_csv(spark, path, ordered=False).count() if fs.exists(target) else None
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    out = df.orderBy(order) if order in df.columns else df
    out.select(*columns).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(temporary)
    written = read_csv(spark, temporary, columns, ordered=False).count()
    _, at = _fs(spark, temporary)
    try:
        guard(written, columns, expected, old, min_rows)
    except ValueError:
        fs.delete(at, True)
        raise
    if old is not None:
        _, saved = _fs(spark, path + ".bak")
        fs.delete(saved, True)
        if backup:
            fs.rename(target, saved)
        else:
            fs.delete(target, True)
    fs.rename(at, target)


def append_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Union with what is there, then replace."""
    old = read_optional(df.sparkSession, path, columns).drop("_ord")
    write_csv(cut(old.unionByName(df.select(*columns))), path, columns, order=None)


def save_manifest(df: DataFrame, path: str) -> None:
    """The hash tree of a table, with its root, row count and time."""
    integrity.save_tree(df, path)


def verify_manifest(df: DataFrame, path: str) -> tuple[bool, str]:
    """Whether a table is what its manifest says; without a readable manifest there is nothing to hold against it."""
    return integrity.verify_tree(df, path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def markdown(df: DataFrame, columns: list[str], limit: int = 200) -> str:
    """The first rows as a table; only these reach the driver."""
    clean = lambda v: str("" if v is None else v).replace("|", "\\|").replace("\n", " ")
    rows = [f"| {' | '.join(clean(r[c]) for c in columns)} |" for r in df.limit(limit).select(*columns).collect()]
    return "\n".join([f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}", *rows])


class Change:
    """A planned table replacement: ``plan()`` reports it, only ``commit()`` writes."""

    def __init__(self, df: DataFrame, path: str, **options):
        self.df, self.path, self.options = df, path, options

    def plan(self) -> dict:
        return {"path": self.path, "rows": self.df.count(), "columns": self.df.columns}

    def commit(self) -> None:
        write_csv(self.df, self.path, **self.options)


def read_sidecars(spark: SparkSession, pattern: str) -> DataFrame:
    """Patch rows ``row_index, field_name, value`` of all files of a pattern with their ``file`` and ``line`` (from 0), the
    order in which they apply."""
    raw = spark.read.text(pattern).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    cells = F.from_csv("value", "row_index string, field_name string, value string", {"mode": "PERMISSIVE"})
    rows = raw.select("file", "at", cells.alias("c")).filter("c.row_index is not null and c.row_index <> 'row_index'")
    line = F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1
    return rows.select("c.*", "file", line.alias("line"))
