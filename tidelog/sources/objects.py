"""Object-store drops: data files `...-table-hex.ndjson` between `<33 digits>.RESOLVED` markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import hlc, values
from tidelog.sources import envelope

MARKER = r"(?:^|/)([0-9]{33})\.RESOLVED$"
#: Names begin with a clock, whose first characters are a second.
STRETCH_CHARS = 14


def listing(spark: SparkSession, folder: str, after: str | None = None, limit: int | None = None, recursive: bool = True) -> DataFrame:
    """(path) of a folder's files, empty ones as well: those behind a position, the first so many in order.

    The store's listing goes through the driver, as every listing does; it holds names, not contents.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found, paths = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, recursive), []
    while found.hasNext():
        path = found.next().getPath().toString()
        if not after or path > after:
            paths.append((path,))
    paths.sort()
    return spark.createDataFrame(paths[:limit], "path string")


def ranges(paths: DataFrame) -> DataFrame:
    """(path, tbl, marker, nanos, logical): each data file with the first marker after it; files behind the last marker aren't final yet.

    Markers of one folder are in order of path, and so are the files before each. Folders are independent.
    Names of a folder that begin alike are next to each other in that order, so each such stretch is searched by itself, backwards,
    with one step for each file; where no marker follows in a stretch, it is the first one of the next stretch that has any.
    """
    digits = F.regexp_extract("path", MARKER, 1)
    rows = paths.select("path", F.when(digits != "", digits).alias("digits"), F.regexp_extract("path", r"^(.*/)?[^/]*$", 1).alias("folder"))
    rows = rows.withColumn("stretch", F.substr("path", F.length("folder") + 1, F.lit(STRETCH_CHARS)))
    stretch = Window.partitionBy("folder", "stretch").orderBy(F.desc("path")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy("folder").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("folder", "stretch").agg(F.min_by("digits", F.when(F.col("digits").isNotNull(), F.col("path"))).alias("first"))
    later = first.select("folder", "stretch", F.last("first", ignorenulls=True).over(behind).alias("later"))
    rows = rows.withColumn("marker", F.last("digits", ignorenulls=True).over(stretch)).join(later, ["folder", "stretch"], "left")
    rows = rows.withColumn("marker", F.coalesce("marker", "later"))
    data = rows.where("digits IS NULL AND marker IS NOT NULL AND path LIKE '%.ndjson'")
    clock = hlc.resolved_name(F.col("marker"))
    return data.select("path", values.table_of_path(F.col("path")).alias("tbl"), "marker", clock["nanos"].alias("nanos"), clock["logical"].alias("logical"))


def mutations(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Mutations of data files, as ranges() gives them; the file's name says the table. Their number, not their content, is known to the driver."""
    paths = [r.path for r in files.select("path").toLocalIterator()]
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path")) if paths else spark.createDataFrame([], "value string, path string")
    return envelope.bulk_lines(lines, values.table_of_path(F.col("path")))


#: What the last two parts of a landing path are.
DATED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}/"
NDJSON, RESOLVED = DATED + r"(?:[^-/]+-){5}([^/]+)-[^-/]+\.ndjson$", DATED + r"([0-9]{33})\.RESOLVED$"
#: Paths have fewer parts than this.
MAX_PARTS = 8


def route(path: Column) -> Column:
    """(kind, db, schema, table, marker) of a URL path; null if it leads nowhere.

    Two parts name a schema, and a third one a table. What follows is nothing for a webhook, or a date and a file
    for ndjson and resolved markers. Empty parts don't count, escapes are undone. A file for a
    schema has the table's name in its own; a schema in that name doesn't count.
    """
    parts = F.transform(F.filter(F.split(path, "/"), lambda p: p != ""), F.try_url_decode)
    n, at = F.size(parts), lambda i: F.try_element_at(parts, F.lit(i))
    tail = F.concat(at(-2), F.lit("/"), at(-1))
    fits = F.forall(parts, lambda p: p.isNotNull()) & (n < MAX_PARTS)
    kind = F.when(n.isin(2, 3), "webhook").when(n.isin(4, 5) & tail.rlike(NDJSON), "ndjson").when(n.isin(4, 5) & tail.rlike(RESOLVED), "resolved")
    topic = F.try_element_at(values.raw_parts(F.regexp_extract(tail, NDJSON, 1)), F.lit(-1))
    table = F.when(n.isin(3, 5), at(3)).when(kind == "ndjson", topic)
    marker = F.when(kind == "resolved", F.regexp_extract(tail, RESOLVED, 1))
    found = F.struct(kind.alias("kind"), at(1).alias("db"), at(2).alias("schema"), table.alias("table"), marker.alias("marker"))
    return F.when(fits & kind.isNotNull(), found)
