"""Reading: tables of text, register metadata, document inventories, statistics cubes."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..functions.text import blank_to_null, first_path_part

CONTRACT = S.StructType([S.StructField(n, S.StringType()) for n in (
    "id", "contract_id", "filename", "launthegi_canonical", "launthegi", "launthegi_felag_id",
    "atvinnurekandi", "heildarsamtok", "markadsflokk", "tegund", "fra", "til", "pdf_url", "ocr_text")])


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def text_schema(columns: Sequence[str]) -> S.StructType:
    return S.StructType([S.StructField(c, S.StringType()) for c in columns])


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV with header (and byte-order mark), all text. A missing file is an
    empty table; rows without any value are dropped."""
    schema = text_schema(columns)
    try:
        df = spark.read.csv(path, header=True, schema=schema, multiLine=True, quote='"', escape='"',
                            enforceSchema=False)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)
    return df.select(*[blank_to_null(F.col(c)).alias(c) for c in columns]).dropna("all")


def _pieces(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """Files cut after each ``mark``, read in byte ranges: ``_file, _range, _pos, _piece``; ``_pos`` grows along a range."""
    return spark.read.text(path, lineSep=mark).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_pos"), F.col("value").alias("_piece"))


def _carried(rows: DataFrame, *columns: str) -> DataFrame:
    """Adds to each column the sum over all pieces of the file before it, as ``<column>_before``: running inside a range, and over one row per range."""
    before = Window.partitionBy("_file", "_range").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_file", "_range").agg(*[F.sum(c).alias(c) for c in columns])
    starts = sums.select("_file", "_range", *[F.coalesce(F.sum(c).over(ranges), F.lit(0)).alias(c + "_start") for c in columns])
    return rows.join(starts, ["_file", "_range"]).select(
        *rows.columns, *[(F.col(c + "_start") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(c + "_before") for c in columns])


def read_objects(spark: SparkSession, path: str, schema: S.StructType) -> DataFrame:
    """The objects of JSON arrays (or of JSON lines, or single objects) under ``path``, a large file being read by many tasks.

    Files are read in byte ranges and cut after each ``}``. Which quotes are open and how deep a piece lies in objects follows from
    counts over the pieces before it: running ones inside a range, and one row per range. Pieces up to a ``}`` that closes an outermost object are put
    together again; an object is one row, whatever its file's size. Objects that don't parse are rows of nulls.
    """
    read = _pieces(spark, path, "}")
    # outside strings JSON has no backslashes: what one stands before is inside
    parts = F.split(F.regexp_replace("_piece", r"(?s)\\.", ""), '"')
    opened = lambda odd: F.aggregate(F.transform(parts, lambda x, i: F.when(i % 2 == odd, F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit("")))).otherwise(0)),
                                     F.lit(0), lambda a, x: a + x)
    pieces = read.select("*", ((F.size(parts) - 1) % 2).alias("_turns"), opened(0).alias("_outside"), opened(1).alias("_inside"))
    quoted = _carried(pieces, "_turns").withColumn("_in", F.col("_turns_before") % 2)
    closes = ((F.col("_in") + F.col("_turns")) % 2 == 0).cast("int")
    deep = _carried(quoted.select("_file", "_range", "_pos", "_piece", F.when(F.col("_in") == 0, F.col("_outside")).otherwise(F.col("_inside")).alias("_opens"),
                                 closes.alias("_closes")).withColumn("_depth", F.col("_opens") - F.col("_closes")), "_depth")
    ends = deep.withColumn("_ends", ((F.col("_closes") == 1) & (F.col("_depth_before") + F.col("_depth") == 0)).cast("int"))
    numbered = _carried(ends.select("_file", "_range", "_pos", "_piece", "_ends"), "_ends")
    whole = numbered.groupBy("_file", F.col("_ends_before").alias("_object")).agg(
        F.max("_ends").alias("_ended"), F.array_sort(F.collect_list(F.struct("_range", "_pos", "_piece"))).alias("_pieces"))
    text = F.concat(F.array_join(F.transform("_pieces", lambda p: p["_piece"]), "}"), F.lit("}"))
    # what stands between two objects stays in front of the second
    own = F.regexp_replace(text, r"^[^{]*", "")
    return whole.where("_ended = 1").select(F.from_json(own, schema).alias("_row")).select("_row.*")


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Register metadata, JSON arrays of contracts with their text, of any size."""
    df = read_objects(spark, path, CONTRACT)
    return df.withColumn("fra", F.left("fra", F.lit(10)).try_cast("date")).withColumn(
        "til", F.left("til", F.lit(10)).try_cast("date"))


def register_summary(contracts: DataFrame, text: str = "ocr_text") -> DataFrame:
    """The metadata with the length of the text in place of the text."""
    return contracts.withColumn("text_length", F.length(F.coalesce(text, F.lit("")))).drop(text)


def document_inventory(spark: SparkSession, listed: str, pattern: str = "*.pdf", root: str | None = None) -> DataFrame:
    """(path, source, size, sha256) of the files under a folder; paths count from ``root``, the folder itself where
    ``listed`` holds a pattern for it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", pattern).load(listed)
    # file systems differ in how they write scheme and authority; what follows the folder is the path, whatever its characters
    place = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?"
    base = re.sub(place, "", (root or listed).rstrip("/") + "/")
    full = F.regexp_replace("path", place, "")
    at = F.instr(full, F.lit(base))
    path = F.when(at > 0, F.substring(full, at + len(base), F.length(full))).otherwise(full)
    return files.select(path.alias("path"), first_path_part(path).alias("source"),
                        F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def apply_types(df: DataFrame, ints: Sequence[str] = (), floats: Sequence[str] = (),
                dates: Sequence[str] = ()) -> DataFrame:
    """Text to numbers, late: blank is NULL, other columns stay text."""
    kinds = {**dict.fromkeys(ints, "bigint"), **dict.fromkeys(floats, "double"), **dict.fromkeys(dates, "date")}

    def typed(name: str, kind: str) -> Column:
        if kind != "string":
            return F.col(name)
        value = blank_to_null(F.col(name))
        return value.try_cast(kinds[name]) if name in kinds else value

    return df.select(*[typed(f.name, f.dataType.typeName()).alias(f.name) for f in df.schema.fields])


# ------------------------------------------------------------------- cubes

CUBE = S.StructType([
    S.StructField("id", S.ArrayType(S.StringType())),
    S.StructField("size", S.ArrayType(S.LongType())),
    S.StructField("labels", S.ArrayType(S.StringType())),
    S.StructField("members", S.ArrayType(S.ArrayType(S.StringType()))),
    S.StructField("value", S.ArrayType(S.DoubleType())),
])


def cube_columns(raw: DataFrame, json: str, ids: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A json-stat cube text -> its value array, sizes, and ordered members per dimension.

    ``ids`` are the dimension ids in order, which a caller knows from the table.
    """
    fields = []
    for i in ids:
        fields.append(S.StructField(i, S.StructType([
            S.StructField("label", S.StringType()),
            S.StructField("category", S.StructType([
                S.StructField("index", S.MapType(S.StringType(), S.LongType())),
                S.StructField("label", S.MapType(S.StringType(), S.StringType()))]))])))
    schema = S.StructType([
        S.StructField("size", S.ArrayType(S.LongType())),
        S.StructField("dimension", S.StructType(fields)),
        S.StructField("value", S.ArrayType(S.DoubleType()))])
    parsed = raw.select(*keep, F.from_json(json, schema).alias("_c"))

    def members(i: str) -> Column:
        category = F.col("_c").getField("dimension").getField(i).getField("category")
        ordered = F.array_sort(F.transform(F.map_entries(category["index"]),
                                           lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code"))))
        return F.transform(ordered, lambda m: F.coalesce(
            F.try_element_at(category["label"], m["code"]), m["code"]))

    return parsed.select(*keep, F.col("_c.size").alias("size"), F.col("_c.value").alias("value"),
                         *[members(i).alias(i) for i in ids])


def read_cubes(spark: SparkSession, path: str, ids: Sequence[str], chosen: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """The cells of json-stat files under ``path``, a cube each: ``ids`` and ``value``; empty cells are dropped.

    A large cube is read by many tasks: files are cut at commas, a value's place is the number of pieces since the values began, and its members follow from
    the strides of the sizes. With ``chosen`` only cells of those members are parsed. What stands around the values is one row per file.
    """
    begins = r'(?s)^(.*(?<!\\)"value"\s*:\s*\[)'
    pieces = _carried(_pieces(spark, path, ",").withColumn("_one", F.lit(1)), "_one").select("_file", F.col("_one_before").alias("_at"), "_piece")
    start = pieces.where(F.rlike("_piece", F.lit(begins))).groupBy("_file").agg(F.min("_at").alias("_from"))
    opened = pieces.join(start, "_file")
    own = F.when(F.col("_at") == F.col("_from"), F.regexp_replace("_piece", begins, "")).otherwise(F.col("_piece"))
    opened = opened.withColumn("_own", F.when(F.col("_at") >= F.col("_from"), own))
    end = opened.where(F.contains("_own", F.lit("]"))).groupBy("_file").agg(F.min("_at").alias("_to"))
    told = opened.join(end, "_file")
    head = F.when(F.col("_at") == F.col("_from"), F.regexp_extract("_piece", begins, 1)).otherwise("")
    tail = F.when(F.col("_at") == F.col("_to"), F.substr("_own", F.locate("]", F.col("_own")))).otherwise("")
    around = told.where("_at <= _from or _at >= _to").select("_file", "_at", F.when(
        (F.col("_at") < F.col("_from")) | (F.col("_at") > F.col("_to")), F.col("_piece")).otherwise(F.concat(head, tail)).alias("_text"),
        ((F.col("_at") < F.col("_from")) | (F.col("_at") >= F.col("_to"))).alias("_comma"))
    whole = around.groupBy("_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_text", "_comma"))), lambda p: F.concat(
        p["_text"], F.when(p["_comma"], ",").otherwise(""))), "").alias("_text"))
    described = cube_columns(whole, "_text", ids, keep=["_file"]).drop("value").withColumnsRenamed({i: "_d_" + i for i in ids})
    cells = told.where("_at between _from and _to").select("_file", (F.col("_at") - F.col("_from")).alias("_place"), F.substring_index("_own", "]", 1).alias("_text"))
    cells = cells.join(described, "_file")
    for k, i in enumerate(ids):
        stride = F.aggregate(F.slice("size", k + 2, len(ids)), F.lit(1).cast("bigint"), lambda a, x: a * x)
        cells = cells.withColumn("_m_" + i, F.get("_d_" + i, F.pmod(F.floor(F.col("_place") / stride), F.get("size", F.lit(k))).cast("int")))
    for i, names in (chosen or {}).items():
        cells = cells.where(F.col("_m_" + i).isin(*names))
    return cells.select(*[F.col("_m_" + i).alias(i) for i in ids], F.trim("_text").try_cast("double").alias("value")).where("value is not null")


def flatten_cube(cube: DataFrame, dims: Sequence[str], chosen: dict[str, Sequence[str]] | None = None,
                 value: str = "value", size: str = "size", keep: Sequence[str] = ()) -> DataFrame:
    """Flat row-major values -> one row per cell with its members; empty cells are dropped.

    ``chosen`` limits dimensions to some members.
    """
    cells = cube.select(*keep, *dims, size, F.posexplode(value).alias("_at", "_value")).where("_value is not null")
    for i, dim in enumerate(dims):
        stride = F.aggregate(F.slice(F.col(size), i + 2, len(dims)), F.lit(1).cast("bigint"), lambda a, x: a * x)
        place = F.pmod(F.floor(F.col("_at") / stride), F.get(F.col(size), F.lit(i)))
        cells = cells.withColumn("_m_" + dim, F.get(F.col(dim), place.cast("int")))
    rows = cells.select(*keep, *[F.col("_m_" + d).alias(d) for d in dims], F.col("_value").alias(value))
    for dim, names in (chosen or {}).items():
        rows = rows.where(F.col(dim).isin(*names))
    return rows
