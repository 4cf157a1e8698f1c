"""Headered delimited files with types inferred in one pass, also from files of different columns.

One scan gives, for each file, its header and how many cells of each kind each
column holds (partial counts before the shuffle: a few rows for each file and
column).  Kinds form a lattice -- int below long below double, date below
timestamp, everything below string -- and a column's type is the smallest that all
its kinds, in all files, fit.  Files are then read once more with that schema; a
file without a column has nulls there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: what a column of cells of these kinds becomes; the first row whose kinds suffice
_LATTICE = ((("int",), T.IntegerType()), (("int", "long"), T.LongType()), (("int", "long", "double"), T.DoubleType()),
            (("boolean",), T.BooleanType()), (("date",), T.DateType()), (("date", "timestamp"), T.TimestampType()))


def kind_of(cell: Column) -> Column:
    """The narrowest kind of a cell; null for an empty one."""
    whole = cell.rlike(r"^[+-]?\d{1,18}$")
    number = cell.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,3})?$") | cell.isin("NaN", "Infinity", "-Infinity")
    day = cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull()
    moment = cell.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$") & cell.try_cast("timestamp").isNotNull()
    return (F.when(cell.isNull() | (cell == ""), None)
            .when(whole, F.when(cell.try_cast("int").isNotNull(), "int").otherwise("long"))
            .when(number, "double").when(F.lower(cell).isin("true", "false"), "boolean").when(day, "date").when(moment, "timestamp")
            .otherwise("string"))


def merged_type(kinds: set[str]) -> T.DataType:
    """The type of a column whose cells have these kinds (none at all: string)."""
    return next((t for fit, t in _LATTICE if kinds and kinds <= set(fit)), T.StringType())


def _cells(line: Column, sep: str) -> Column:
    """The cells of a line; separators between double quotes do not count."""
    import re
    mark = re.escape(sep)
    parts = F.when(line.contains('"'), F.split(line, mark + r'(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)).otherwise(F.split(line, mark, -1))
    return F.transform(parts, lambda c: F.when(c.rlike(r'^".*"$'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')))
                       .otherwise(c))


def _profile(spark: SparkSession, path, sep: str) -> list:
    """For each file: its path, header cells, and for each column place the cells counted by kind (the header's among them)."""
    lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file"),
                                         (F.col("_metadata.file_block_start") == 0).alias("top"), F.monotonically_increasing_id().alias("at"))
    cells = lines.where(F.trim("value") != "").select("file", "top", "at", _cells(F.col("value"), sep).alias("cells"))
    placed = cells.select("file", F.when(F.col("top"), F.col("at")).alias("at"), F.posexplode("cells").alias("place", "cell"))
    # the header is the first line of the file's first part
    seen = placed.groupBy("file", "place", kind_of(F.col("cell")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("at").isNotNull(), F.struct("at", "cell"))).alias("first"))
    columns = seen.groupBy("file", "place").agg(F.min("first").alias("first"), F.collect_list(F.struct("kind", "n")).alias("kinds"))
    return columns.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("place", "first", "kinds"))).alias("columns"),
                                       F.min("first.at").alias("at")).orderBy("file").collect()  # a row for each file


def infer_schema(spark: SparkSession, path, sep: str = ";") -> tuple[T.StructType, dict[tuple[str, ...], list[str]]]:
    """The merged schema, columns in the order in which they first appear, and the files of each header."""
    kinds: dict[str, set[str]] = {}
    headers: dict[tuple[str, ...], list[str]] = {}
    for f in _profile(spark, path, sep):
        # columns of the header line; longer lines have cells without a name
        named = [c for c in f["columns"] if c["first"] is not None and c["first"]["at"] == f["at"]]
        names = tuple(c["first"]["cell"] or f"_c{c['place']}" for c in named)
        if len(set(names)) < len(names):
            raise ValueError(f"{f['file']}: a column name stands twice")
        headers.setdefault(names, []).append(f["file"])
        for name, c in zip(names, named):
            counts = {k["kind"]: k["n"] for k in c["kinds"]}
            own = _plain_kind(spark, c["first"]["cell"])
            counts[own] = counts.get(own, 0) - 1  # the header's own cell
            kinds.setdefault(name, set()).update(k for k, n in counts.items() if k is not None and n > 0)
    return T.StructType([T.StructField(name, merged_type(k)) for name, k in kinds.items()]), headers


def _plain_kind(spark: SparkSession, cell: str | None) -> str | None:
    """``kind_of`` for a header's cell: a name is a string unless it looks like something else."""
    if cell and (cell[0].isalpha() or cell[0] == "_") and cell.lower() not in ("true", "false", "nan", "infinity"):
        return "string"
    return spark.range(1).select(kind_of(F.lit(cell).cast("string"))).first()[0]


def read_inferred(spark: SparkSession, path, sep: str = ";") -> DataFrame:
    """The files of ``path`` (one or several, or a folder) as one table of the merged schema.

    Every line is looked at.  Line breaks inside quotes are not supported; blank
    lines are skipped; a column without any value is a string; without files with a
    header there are no columns and no rows.
    """
    schema, headers = infer_schema(spark, path, sep)
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    parts = []
    for names, files in headers.items():
        own = T.StructType([schema[n] for n in names])
        rows = spark.read.schema(own).option("header", "true").option("sep", sep).option("escape", '"').csv(files)
        parts.append(rows.select(*[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]))
    return reduce(DataFrame.unionAll, parts)
