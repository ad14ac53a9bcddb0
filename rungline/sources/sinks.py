"""Writing: ordered tables, documents per year and per union, indices, manifest."""
from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator, Sequence

from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.text import slug
from ..operators.ranking import number_within
from ..session import cut_lineage


def order_output(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*keys)


def export_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order; dates as ISO text, flags as 0/1, lists joined by commas."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def out(c: str) -> Column:
        if kinds[c] in ("date", "timestamp"):
            return F.col(c).cast("string")
        if kinds[c] == "boolean":
            return F.col(c).cast("int")
        if kinds[c] == "array":
            return F.array_join(c, ",")
        return F.col(c)

    return df.select(*[out(c).alias(c) for c in columns])


def write_table(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str | Column] = (),
                fmt: str = "csv", compression: str | None = None, mode: str = "overwrite") -> None:
    """Range-sorted over many files, so no task holds the whole table."""
    shaped = export_columns(df, columns)
    if order:
        shaped = order_output(shaped, order)
    writer = shaped.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


_NUMBERED = r"^(.*)-([1-9]\d{0,17})$"


def _settled(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``_base, _m, _other, _skip, _gone`` for slugs ``_base`` beside names ``_other`` that are its number ``_m``.

    ``_skip``: the name was first, so the slug passes over the number; ``_gone``: the slug was first, so the name's first row is displaced. Who is
    first is settled in rounds: the more numbers a slug passes over, the earlier the row that proposes the next one, so a first
    round in which it passes over all and one in which it passes over what is then left bound the answer, and rounds go on until
    nothing changes.
    """
    below = Window.partitionBy("_base").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.select(F.col("_base").alias("_b"), F.col("_n").alias("_k"), F.col("_order").alias("_proposed"))
    now = cut_lineage(pairs.withColumn("_skip", F.lit(1)).withColumn("_gone", F.lit(0)))
    while True:
        displaced = now.where("_gone = 1").select(F.col("_other").alias("_d"), F.lit(1).alias("_away"))
        k = F.col("_m") - F.coalesce("_away", F.lit(0)) - F.coalesce(F.sum("_skip").over(below), F.lit(0))
        asked = now.join(displaced, F.col("_base") == F.col("_d"), "left").withColumn("_row", k)
        met = asked.join(at, (F.col("_base") == F.col("_b")) & (F.col("_row") == F.col("_k")), "left")
        then = cut_lineage(met.select("_base", "_m", "_other", "_first",
                                      F.coalesce((F.col("_first") < F.col("_proposed")).cast("int"), F.lit(0)).alias("_skip"),
                                      F.coalesce((F.col("_first") > F.col("_proposed")).cast("int"), F.lit(0)).alias("_gone")))
        if then.exceptAll(now).isEmpty():
            return then
        now = then


def with_slugs(df: DataFrame, name: str, order: str, alias: str = "slug", block: int = 1_000_000) -> DataFrame:
    """A URL-ready id per row, given in the order of ``order`` (unique integers): a slug that is taken gets the
    smallest number from 2 on that makes it free, whether names or numbers took it.

    Rows are numbered within their slug, in blocks. Only a name that is itself another slug with a number ("x" and "x-2") can be in the way: for such
    pairs it is settled who was first, and the rows of a slug pass over the numbers that names took before.
    """
    numbered = number_within(df.withColumn("_base", slug(F.col(name))), ["_base"], order, block, "_n")
    rows = numbered.select("_base", "_n", F.col(order).alias("_order"))
    slugs = rows.groupBy("_base").agg(F.count(F.lit(1)).alias("_rows"), F.min("_order").alias("_first"))
    number = F.regexp_extract("_base", _NUMBERED, 2).try_cast("bigint")
    names = slugs.select(F.col("_base").alias("_other"), "_first", F.regexp_extract("_base", _NUMBERED, 1).alias("_base"), number.alias("_m")).where("_m >= 2")
    pairs = cut_lineage(names.join(slugs.select("_base"), "_base").select("_base", "_m", "_other", "_first"))
    if pairs.isEmpty():
        value, given = F.col("_n"), numbered
    else:
        settled = _settled(pairs, cut_lineage(rows))
        away = settled.where("_gone = 1").select(F.col("_other").alias("_base"), F.lit(1).alias("_away"))
        # the j-th number passed over moves the rows from that one on which would take it
        j = F.row_number().over(Window.partitionBy("_base").orderBy("_m"))
        moved = (settled.where("_skip = 1").withColumn("_j", j).join(away, "_base", "left")
                 .select("_base", (F.col("_m") - F.coalesce("_away", F.lit(0)) - F.col("_j") + 1).alias("_n"), F.lit(1).alias("_moved")))
        # both are counted in blocks of row numbers: those of earlier blocks come from one row per block
        part = F.floor(F.col("_n") / block)
        steps = moved.groupBy("_base", "_n").agg(F.count(F.lit(1)).alias("_moves")).withColumn("_part", part)
        blocks = steps.groupBy("_base", "_part").agg(F.sum("_moves").alias("_sum"))
        upto = Window.partitionBy("_base").orderBy("_part")
        touched = numbered.join(moved.select("_base").distinct(), "_base", "left_semi")
        some = touched.select("_base", "_n").withColumn("_part", part)
        inside = Window.partitionBy("_base", "_part").orderBy("_n", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = some.select("_base", "_part", "_n", F.lit(1).alias("_order"), F.lit(0).alias("_moves")).unionByName(
            steps.select("_base", "_part", "_n", F.lit(0).alias("_order"), "_moves"))
        counted = both.withColumn("_here", F.sum("_moves").over(inside)).where("_order = 1").select("_base", "_part", "_n", "_here")
        parts = some.select("_base", "_part").distinct()
        ahead = (parts.select("_base", "_part", F.lit(0).alias("_sum")).unionByName(blocks.select("_base", "_part", "_sum"))
                 .groupBy("_base", "_part").agg(F.sum("_sum").alias("_sum"))
                 .select("_base", "_part", (F.sum("_sum").over(upto) - F.col("_sum")).alias("_ahead")))
        shift = counted.join(ahead, ["_base", "_part"]).select("_base", "_n", (F.col("_here") + F.col("_ahead")).alias("_shift"))
        given = numbered.join(shift, ["_base", "_n"], "left").join(away, "_base", "left")
        value = F.col("_n") + F.coalesce("_shift", F.lit(0)) + F.coalesce("_away", F.lit(0))
    return (given.withColumn("_number", value)
            .withColumn(alias, F.when(F.col("_number") == 1, F.col("_base")).otherwise(F.concat(F.col("_base"), F.lit("-"), F.col("_number").cast("string"))))
            .select(*df.columns, alias))


# ---------------------------------------------------------------- documents

def year_documents(df: DataFrame, date: str, columns: Sequence[str], order: str, block: int = 1_000_000) -> DataFrame:
    """The increases of each year in order: ``ar``, ``fjoldi`` (how many the year has), ``saeti`` (place, from 1), ``columns``.

    A year may hold any share of the rows, so its document is a list of rows, one per increase, in the
    same form for every year. ``order`` holds unique integers.
    """
    rows = df.withColumn("ar", F.year(date).cast("string"))
    sizes = rows.groupBy("ar").agg(F.count(F.lit(1)).alias("fjoldi"))
    return number_within(rows, ["ar"], order, block, "saeti").join(sizes, "ar").select("ar", "fjoldi", "saeti", *columns)


def write_by_year(df: DataFrame, path: str, date: str, columns: Sequence[str], order: str) -> None:
    """JSON lines in a folder per year, sorted by place within each file, and the years' counts beside them."""
    rows = year_documents(df, date, columns, order)
    spread = rows.repartitionByRange("ar", "saeti").sortWithinPartitions("ar", "saeti")
    spread.drop("fjoldi").write.mode("overwrite").partitionBy("ar").json(f"{path}/haekkanir")
    (df.groupBy(F.year(date).cast("string").alias("ar")).agg(F.count(F.lit(1)).alias("fjoldi"))
     .write.mode("overwrite").json(f"{path}/fjoldi"))


def line_documents(series: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("union_key", "counterparty"),
                   date: str = "valid_from") -> DataFrame:
    """Rows of each line as one array in date order; the calendar bounds its length."""
    row = F.struct(F.col(date), *[F.col(c) for c in columns if c != date])
    return series.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("haekkanir"))


def union_documents(unions: DataFrame, lines: DataFrame, series: DataFrame, rates: DataFrame,
                    columns: Sequence[str], line_columns: Sequence[str], key: str = "union_key",
                    counterparty: str = "counterparty", main: str = "main_line", order: Sequence[str] = (),
                    date: str = "valid_from") -> DataFrame:
    """One nested document per union: main rows, all lines with their rows by ``order`` and counterparty, rate changes by date.

    Arrays are gathered per line first: a line has a row per day at most, a union a line per counterparty, and
    rate changes one entry per pair of dates.
    """
    per_line = line_documents(series, columns, (key, counterparty), date)
    shown = F.struct(F.col(counterparty), *[F.col(c) for c in line_columns], F.col("haekkanir"))
    entry = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.col(counterparty).alias("_c"), shown.alias("line"))
    joined = lines.join(per_line, [key, counterparty]).join(unions.select(key, F.col(main).alias("_main")), key)
    nested = joined.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["line"]).alias("samningar"),
        F.first(F.when(F.col(counterparty) == F.col("_main"), F.col("haekkanir")), ignorenulls=True).alias("haekkanir"))
    changes = rates.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        "to_date", *[c for c in rates.columns if c not in (key, "to_date")]))).alias("taxtahaekkanir"))
    return unions.join(nested, key).join(changes, key, "left")


class DocumentFiles(DataSource):
    """Writes rows ``(name, body)`` as one file each into a new folder, which is there as a whole or not at all.

    Tasks write into a folder beside the target; when all have ended it is renamed, and a task that fails, or is run twice, leaves
    nothing in the target. The folder may be in any file system that Arrow knows by its URI.
    """

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _DocumentWriter(self.options["path"])


class _DocumentWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.staged = path.rstrip("/"), f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        files, folder = _file_system(self.staged)
        files.create_dir(folder, recursive=True)
        for row in iterator:
            # an attempt that is lost leaves at most a part under a name of its own
            part = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write(row["body"].encode())
            files.move(part, f"{folder}/{row['name']}")
        return WriterCommitMessage()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _file_system(self.staged)
        files.create_dir(folder, recursive=True)  # without rows no task has made it
        for left in files.get_file_info(FileSelector(folder)):
            if left.base_name.startswith("."):
                files.delete_file(left.path)
        files.move(folder, _file_system(self.path)[1])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _file_system(self.staged)
        gone = 0
        for _ in range(50):  # tasks that are just being ended may still write: until it stays away
            try:
                if files.get_file_info(folder).type == FileType.NotFound:
                    gone += 1
                else:
                    gone = 0
                    files.delete_dir(folder)
            except OSError:
                gone = 0
            if gone == 3:
                return
            time.sleep(0.1)
        raise OSError(f"still written to: {self.staged}")


def _file_system(path: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else FileSystem.from_uri(f"file://{os.path.abspath(path)}")


def write_documents(df: DataFrame, path: str) -> None:
    """``name`` and ``body`` of each row as a file in the new folder ``path``; names are unique."""
    df.sparkSession.dataSource.register(DocumentFiles)
    df.select("name", "body").write.format("document_files").option("path", path).mode("append").save()


def publish_folder(path: str, index: str) -> None:
    """Replaces ``index.json`` under ``path`` at once; what it names is there as a whole before."""
    files, folder = _file_system(path)
    part = f"{folder}/.index-{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(index.encode())
    files.move(part, f"{folder}/index.json")


def union_index(unions: DataFrame, base_url: str, slug_column: str = "slug") -> DataFrame:
    return unions.withColumn("slod", F.concat(F.lit(base_url + "/felog/"), F.col(slug_column), F.lit(".json")))


def index_documents(df: DataFrame, series: str = "series", order: str = "month",
                    columns: Sequence[str] = ("month", "value")) -> DataFrame:
    """{heiti, fjoldi, gildi[]} per published index: one value per series and month."""
    row = F.struct(F.col(order), *[F.col(c) for c in columns if c != order])
    return df.groupBy(F.col(series).alias("heiti")).agg(
        F.count(F.lit(1)).alias("fjoldi"), F.array_sort(F.collect_list(row)).alias("gildi"))


def manifest(unions: DataFrame, increases: DataFrame, series: DataFrame, lines: DataFrame,
             rates: DataFrame, date: str = "valid_from") -> DataFrame:
    """One row: how much each output holds, first and last year."""
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return increases.agg(
        F.count(F.lit(1)).alias("haekkanir"),
        F.min(F.year(date)).alias("fyrsta_ar"), F.max(F.year(date)).alias("sidasta_ar"),
    ).select(
        "*", count(unions).alias("felog"), count(series).alias("maelipunktar"),
        count(lines).alias("samningslinur"), count(rates).alias("taxtahaekkanir"))
