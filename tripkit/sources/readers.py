"""Batch readers: trip files whose schema drifts, partitioned trips, CSV side tables, JSON results."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.functions.codes import joined_name, whole_number
from tripkit.functions.geo import STATE_PLANE, ConformalConic, parse_polygons, polygons_centroid
from tripkit.operators.schema import rename_columns
from tripkit.schemas import RENAMES


def list_files(spark: SparkSession, root: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """Path and size of the files below folders (or of the files themselves), listed by Spark without opening them."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return listing.select("path", "length")


FOOTER = "path string, fields string, num_rows long, row_groups int"


def _read_footer(path: str) -> tuple[str | None, int | None, int | None]:
    """Leaf columns with their stored types, rows and row groups of one file; nulls where only Spark can open it."""
    import pyarrow as pa
    import pyarrow.fs
    import pyarrow.parquet as pq

    try:
        if path.startswith("file:"):
            path = "file:///" + path.removeprefix("file:").lstrip("/")
        store, place = pyarrow.fs.FileSystem.from_uri(path)
        with store.open_input_file(place) as source:
            file = pq.ParquetFile(source)
            columns = [file.schema.column(i) for i in range(len(file.schema))]
            fields = json.dumps([(c.path, c.physical_type, str(c.logical_type)) for c in columns])
            return fields, file.metadata.num_rows, file.metadata.num_row_groups
    except (pa.ArrowException, OSError):
        return None, None, None


def footers(files: DataFrame) -> DataFrame:
    """Footers of listed files (``path`` and any other columns), read where the tasks run: ``fields``, ``num_rows``, ``row_groups``.

    ``fields`` is equal for files whose columns have the same names, order and stored types; nullability does not count. No data
    page is read. A store that the workers cannot open without Spark gives nulls.
    """
    kept = [f for f in files.schema if f.name != "length"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *FOOTER.split(", ")[1:]])

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame([_read_footer(path) for path in frame["path"]], columns=["fields", "num_rows", "row_groups"], index=frame.index)
            yield frame.join(found.astype({"num_rows": "Int64", "row_groups": "Int32"}))

    return files.drop("length").mapInPandas(read, schema)


def schema_groups(spark: SparkSession, paths: list[str], threads: int = 16) -> list[list[str]]:
    """Paths (files, or folders) grouped by the schema of their footers; a folder with several schemas is given as its files.

    One job reads all footers. Files in stores that only Spark can open are asked one by one, a few at a time.
    """
    found = footers(list_files(spark, paths, "*")).where(F.element_at(F.split("path", "/"), -1).rlike("^[^_.]"))
    rows = [(r.path, r.fields) for r in found.select("path", "fields").collect()]  # names of files, which the driver plans with anyway

    def ask(path: str) -> str:
        schema = spark.read.parquet(path).schema
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json()

    closed = [path for path, fields in rows if fields is None]
    with ThreadPoolExecutor(threads) as pool:
        asked = dict(zip(closed, pool.map(ask, closed)))
    kinds = {path: fields if fields is not None else asked[path] for path, fields in rows}
    plain = {path: re.sub("^[a-z0-9]+:/*", "/", path) for path in kinds}
    groups: dict[str, list[str]] = {}
    for path in paths:
        root = re.sub("^[a-z0-9]+:/*", "/", path).rstrip("/")
        own = [p for p in sorted(kinds) if plain[p] == root or plain[p].startswith(f"{root}/")]
        for kind in dict.fromkeys(kinds[p] for p in own):
            same = [p for p in own if kinds[p] == kind]
            groups.setdefault(kind, []).extend([path] if len(same) == len(own) else same)
    return list(groups.values())


def read_drifted(
    spark: SparkSession,
    paths: list[str],
    columns: dict[str, str] | None = None,
    renames: dict[str, str] = RENAMES,
) -> DataFrame:
    """One frame over files whose column names, types and presence differ.

    Each group of equal schemas is one scan; columns are renamed, given the target type of
    ``columns`` (name to type) if listed there, and the groups united by name. Columns that a
    group lacks are null.
    """
    frames = []
    for group in schema_groups(spark, sorted(set(paths))):
        df = rename_columns(spark.read.parquet(*group), renames)
        if columns:
            df = df.select(
                *[
                    F.col(f"`{name}`").cast(columns[name]).alias(name) if name in columns else F.col(f"`{name}`")
                    for name in df.columns
                ]
            )
        frames.append(df)
    if not frames:
        raise ValueError("no input paths")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


# A dataset by year holds a folder per write and a folder of manifest entries, one per finished write.
MANIFEST, VERSION = "_loads", "version"
MANIFEST_SCHEMA = "load string, version string, at bigint, years array<string>, rows bigint, sources array<string>"


def _entries(spark: SparkSession, root: str) -> list[Row]:
    """The latest word on each write of a dataset: a row per write, without the rows of data."""
    try:
        found = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    emptied = F.struct((F.col("rows") == 0).alias("emptied"), "years", "rows", "sources")
    once = found.groupBy("load", "version", "at").agg(F.max(emptied).alias("e"))
    return once.select("load", "version", "at", "e.years", "e.rows", "e.sources").collect()


def live_loads(spark: SparkSession, root: str) -> list[Row]:
    """The newest finished write of each load: ``load``, ``version``, ``at``, ``years``, ``rows``, ``sources``."""
    newest: dict[str, Row] = {}
    for entry in sorted(_entries(spark, root), key=lambda e: (e.at, e.version)):
        newest[entry.load] = entry
    return list(newest.values())


def read_partitioned(spark: SparkSession, root: str, year: int | list[int] | None = None) -> DataFrame:
    """A dataset partitioned by year: the newest write of each load, and no other.

    Given years leave out loads without them and prune partitions before any file is opened. A dataset without manifest is
    read as it is.
    """
    years = None if year is None else [year] if isinstance(year, int) else list(year)
    loads = live_loads(spark, root)
    if loads:
        filled = [entry for entry in loads if entry.rows] or loads
        wanted = [entry for entry in filled if years is None or {str(y) for y in years} & set(entry.years)] or filled[:1]
        df = spark.read.option("basePath", root).parquet(*[f"{root}/{VERSION}={entry.version}" for entry in wanted]).drop(VERSION)
    else:
        df = spark.read.parquet(root)
    return df if years is None else df.where(F.col("year").isin(*years))


def row_counts(services: dict[str, DataFrame]) -> DataFrame:
    """Rows per service of any frames. Spark answers a bare count from Parquet footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("service"), "num_rows")
        for name, df in services.items()
    ]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


def stored_rows(spark: SparkSession, services: dict[str, list[str]]) -> DataFrame:
    """Files, row groups and rows per service, from the footers of all its files in one job.

    Where a store can only be opened by Spark, ``num_rows`` is null: count such a service with `row_counts`.
    """
    listed = [list_files(spark, paths).withColumn("service", F.lit(name)) for name, paths in services.items()]
    read = footers(reduce(lambda a, b: a.unionByName(b), listed))
    whole = F.count_if(F.col("fields").isNull()) == 0
    return read.groupBy("service").agg(
        F.count(F.lit(1)).alias("files"), F.when(whole, F.sum("row_groups")).alias("row_groups"), F.when(whole, F.sum("num_rows")).alias("num_rows")
    )


def read_csv(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    *,
    header: bool = True,
    sep: str = ",",
    positions: dict[int, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Chosen CSV columns with given types; text that does not fit a type becomes null.

    For files without a header, ``positions`` names columns by their zero-based position.
    ``multi_line`` allows line breaks inside quotes; such files cannot be split among tasks.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("multiLine", multi_line)
    raw = reader.option("escape", '"').csv(path)
    if positions:
        raw = raw.select(*[F.col(f"_c{i}").alias(name) for i, name in positions.items()])
    return raw.select(*[F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in columns.items()])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup with borough and, if present, centroid."""
    raw = spark.read.option("header", True).csv(path)
    kinds = {"LocationID": "int", "centroid_lat": "double", "centroid_lng": "double"}
    return raw.select(*[F.col(f"`{c}`").try_cast(kinds.get(c, "string")).alias(c) for c in raw.columns])


def read_zip_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated postal table without header: ZIP, state and coordinates."""
    return read_csv(
        spark, path,
        {"ZIP Code": "bigint", "State": "string", "lat": "double", "lng": "double"},
        header=False, sep="\t", positions={1: "ZIP Code", 4: "State", 9: "lat", 10: "lng"},
    )


def read_businesses(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv(
        spark, path,
        {"Business Name": "string", "ZIP Code": "string", "Latitude": "double", "Longitude": "double"},
    )
    return raw.withColumn("ZIP Code", whole_number(F.col("ZIP Code"))).dropna(subset=["ZIP Code"])


def read_schools(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv(
        spark, path,
        {
            "nta_name": "string", "location_category_description": "string",
            "latitude": "double", "longitude": "double",
        },
    )
    name = joined_name(F.col("nta_name"), F.col("location_category_description"), null_text="nan")
    return raw.select(name.alias("Name"), "latitude", "longitude")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather as stored: UTC times."""
    return read_csv(
        spark, path, {"time": "timestamp_ntz", "Temperature": "double", "Weather Code": "int"}
    )


def centroids_from_text(df: DataFrame, geometry: str, lon: str = "lng", lat: str = "lat") -> DataFrame:
    """Replace a polygon text column by its centroid, computed in the text's own units."""
    parsed = df.withColumn("_polygons", parse_polygons(F.col(geometry)))
    x, y = polygons_centroid(F.col("_polygons"))
    return parsed.withColumns({lon: x, lat: y}).drop("_polygons", geometry)


def centroids_projected(
    df: DataFrame, geometry: str, grid: ConformalConic = STATE_PLANE, lon: str = "centroid_lng", lat: str = "centroid_lat"
) -> DataFrame:
    """Centroid taken in projected map units and turned back into degrees."""
    planar = centroids_from_text(df, geometry, "_x", "_y")
    degrees = grid.inverse(F.col("_x"), F.col("_y"))
    return planar.withColumns({lon: degrees[0], lat: degrees[1]}).drop("_x", "_y")


def read_precincts(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv(spark, path, {"precinct": "bigint", "the_geom": "string"})
    return centroids_from_text(raw, "the_geom")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Permitted events; times in ISO or in US month/day/year form with AM / PM."""
    names = ["Event Name", "Start Date/Time", "End Date/Time", "Police Precinct"]
    raw = read_csv(spark, path, {name: "string" for name in names})

    def moment(name: str) -> Column:
        us = F.try_to_timestamp(F.col(name), F.lit("M/d/yyyy h:mm:ss a")).cast("timestamp_ntz")
        return F.coalesce(F.col(name).try_cast("timestamp_ntz"), us).alias(name)

    return raw.select("Event Name", moment("Start Date/Time"), moment("End Date/Time"), "Police Precinct")


def read_json_results(spark: SparkSession, paths: list[str], whole_files: bool = False) -> dict[str, DataFrame]:
    """Stored results by path; missing ones are skipped.

    Rows are one JSON object per line; with ``whole_files`` each file is one document.
    """
    found = {}
    for path in paths:
        try:
            found[path] = spark.read.option("multiLine", whole_files).json(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def flatten_counts(df: DataFrame, document: str, levels: list[str], value: str = "trips") -> DataFrame:
    """Nested count documents, ``{level: {level: ... n}}``, to one row per leaf.

    The document is text; level names become columns, ``value`` the count.
    """
    kind = "bigint"
    for _ in levels:
        kind = f"map<string,{kind}>"
    keep = [name for name in df.columns if name != document]
    out = df.select(*keep, F.from_json(F.col(document), kind).alias("_m"))
    done: list[str] = []
    for level in levels:
        out = out.select(*keep, *done, F.explode("_m").alias(level, "_m"))
        done.append(level)
    return out.withColumnRenamed("_m", value)


def register(tables: dict[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
