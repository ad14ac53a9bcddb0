"""Which union and which counterparty does a record belong to?

Dictionaries are DataFrames and look-ups are joins. They run over the distinct
names, not the rows that carry them, so a name that a third of all rows share
is resolved once; the answer then goes back to the rows.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from ..session import cut_lineage
from .ranking import join_lookup, keep_first


def known_unions(df: DataFrame, name: str = "union_name", row: str = "row_id") -> DataFrame:
    """Normalised name (three characters or more) -> name as first written."""
    norm = T.normalize_union(F.col(name))
    return (df.where(F.length(norm) >= 3)
            .groupBy(norm.alias("norm")).agg(F.min_by(name, row).alias("union_name")))


def _parts(col: Column) -> Column:
    return F.split(F.replace(F.coalesce(col, F.lit("")), F.lit(" og "), F.lit(",")), ",")


def _candidates(fields: Sequence[str], whole_first: bool) -> Column:
    """Texts to try, in order: all whole fields and then parts, or field by field."""
    whole = [F.array(F.coalesce(F.col(f), F.lit(""))) for f in fields]
    parts = [_parts(F.col(f)) for f in fields]
    order = [*whole, *parts] if whole_first else [a for pair in zip(whole, parts) for a in pair]
    return F.concat(*order)


def resolve_parties(df: DataFrame, known: DataFrame, fields: Sequence[str] = ("party_1", "party_2"),
                    whole_first: bool = True) -> DataFrame:
    """Distinct party fields -> the first known union they name."""
    pairs = df.select(*[F.coalesce(f, F.lit("")).alias(f) for f in fields]).distinct()
    tried = pairs.select(*fields, F.posexplode(_candidates(fields, whole_first)).alias("_pos", "_text"))
    return (
        tried.withColumn("norm", T.normalize_union(F.col("_text"))).where("norm <> ''")
        .join(known.select("norm", "union_name"), "norm")
        .groupBy(*fields).agg(F.min_by("union_name", "_pos").alias("_party_union"))
    )


def resolve_union(df: DataFrame, known: DataFrame, row: str = "row_id",
                  fields: Sequence[str] = ("party_1", "party_2"), site: str = "site",
                  sites: dict[str, str] | None = None, whole_first: bool = True) -> DataFrame:
    """Adds ``union_name`` and ``tracing``: party from the document, else site owner, else none.

    ``whole_first`` tries both whole fields before any part of a list; without
    it each field is finished, whole and parts, before the next.
    """
    filled = df
    for f in fields:
        filled = filled.withColumn(f, F.coalesce(f, F.lit("")))
    found = resolve_parties(filled, known, fields, whole_first)
    joined = join_lookup(filled, found, fields)
    owner = T.lookup(F.col(site), X.UNION_SITES if sites is None else sites)
    return (
        joined.withColumn("union_name", F.coalesce("_party_union", owner))
        .withColumn("tracing", F.when(F.col("_party_union").isNotNull(), X.TRACE_PARTY)
                    .when(owner.isNotNull(), X.TRACE_SITE).otherwise(X.TRACE_NONE))
        .drop("_party_union")
    )


def tally(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- companies

OPEN = "word string, stems array<string>, block int"


def _nested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stems and words of a block to words with the stems they begin with, and a last row with the stems still open.

    A stem is open from itself to the last string that begins with it; open stems contain each other, so they are a stack. A word
    that begins with no stem of its block has none here.
    """
    open_, block, last = [], None, ""
    for batch in batches:
        words, found = [], []
        for text, is_word, number in zip(*(c.to_pylist() for c in batch.columns)):
            while open_ and not text.startswith(open_[-1]):
                open_.pop()
            if is_word:
                words.append(text)
                found.append(list(open_))
            else:
                open_.append(text)
            block, last = number, text
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(found, pa.list_(pa.string())), pa.array([block] * len(words), pa.int32())],
                                         names=["word", "stems", "block"])
    if block is not None:  # the last string stands in front of the stems still open
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([[last, *open_]], pa.list_(pa.string())), pa.array([block], pa.int32())],
                                         names=["word", "stems", "block"])


def beginnings(words: DataFrame, stems: DataFrame) -> DataFrame:
    """Distinct ``word`` -> ``stems``, those of the distinct ``stem`` (both of one column) that it begins with, the shortest first.

    Stems and words are sorted together over ranges, each of them one row; blocks take over the stems that are open at their beginning from one
    row per block. Words that begin with no stem are left out.
    """
    spark = words.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stem, word = stems.columns[0], words.columns[0]
    first = F.left(F.col("_s"), F.lit(X.STEM_CHARS))
    listed = stems.select(F.col(stem).alias("_s"), F.lit(False).alias("_is_word")).where(F.length("_s") >= X.STEM_CHARS)
    # only words that begin as some stem does are sorted
    asked = words.select(F.col(word).alias("_s"), F.lit(True).alias("_is_word")).withColumn("_first", first).join(
        listed.select(first.alias("_first")).distinct(), "_first", "left_semi").drop("_first")
    both = listed.unionByName(asked).distinct()
    dealt = both.repartitionByRange(partitions, "_s").sortWithinPartitions("_s", "_is_word").withColumn("_block", F.spark_partition_id())
    nested = cut_lineage(dealt.mapInArrow(_nested, OPEN))
    carried, now = [], []
    for block, (last, *own) in sorted((r.block, r.stems) for r in nested.where("word is null").collect()):  # one row per partition
        carried.append((block, now))
        now = [s for s in now if last.startswith(s)] + own
    before = spark.createDataFrame(carried, "block int, _before array<string>")
    return (nested.where("word is not null").join(before, "block")
            .select("word", F.concat(F.filter("_before", lambda s: F.startswith(F.col("word"), s)), F.col("stems")).alias("stems"))
            .where(F.size("stems") > 0))


def company_stems(companies: DataFrame, unions: DataFrame, company: str = "company",
                  union: str = "union_name") -> DataFrame:
    """(stem, id, name) of companies that are neither known counterparties nor unions."""
    distinct = companies.select(F.col(company).alias("_c")).where(T.not_blank(F.col("_c"))).distinct()
    names = cut_lineage(
        T.with_values(distinct, _known=T.classify_counterparty(F.col("_c")), stem=T.company_stem(F.col("_c")))
        .where(F.col("_known").isNull() & (F.length("stem") >= X.STEM_CHARS)).drop("_known")
    )
    own = names.select("stem").distinct()
    union_stems = cut_lineage(
        unions.select(T.company_stem(F.col(union)).alias("_u")).distinct().where(F.length("_u") >= X.STEM_CHARS))
    # one stem begins with the other, in either direction
    begun = beginnings(union_stems, own).select(F.explode("stems").alias("stem"))
    hit = begun.unionByName(beginnings(own, union_stems).select(F.col("word").alias("stem"))).distinct()
    named = T.with_values(names.join(hit, "stem", "left_anti"), _who=T.counterparty_from_register(F.col("_c")))
    return (
        named.select("stem", F.col("_who.id").alias("company_id"), F.col("_who.name").alias("company_name"))
        .groupBy("stem").agg(F.min(F.struct("company_id", "company_name")).alias("_best"))
        .select("stem", "_best.company_id", "_best.company_name")
    )


def find_company(texts: DataFrame, stems: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts -> the company with the longest stem that begins a word."""
    distinct = texts.select(text).where(T.not_blank(F.col(text))).distinct()
    words = F.split(F.trim(F.regexp_replace(T.ascii_fold(F.col(text)), "[^a-z0-9]+", " ")), " ")
    told = distinct.select(text, F.explode(F.array_distinct(F.filter(words, lambda w: F.length(w) >= X.STEM_CHARS))).alias("word"))
    told, stems = cut_lineage(told), cut_lineage(stems)
    innermost = beginnings(told.select("word").distinct(), stems.select("stem")).select(
        "word", F.try_element_at("stems", F.lit(-1)).alias("stem")).join(stems.hint("merge"), "stem")
    longest = F.max_by(F.struct("company_id", "company_name"),
                       F.struct(F.length("stem"), F.col("stem")))
    return told.join(innermost.hint("merge"), "word").groupBy(text).agg(longest.alias("_found")).select(
        text, "_found.company_id", "_found.company_name")


def counterparty_from_document(df: DataFrame, stems: DataFrame | None = None,
                               fields: Sequence[str] = ("party_1", "party_2"), document: str = "document",
                               site: str = "site", row: str = "row_id") -> DataFrame:
    """Adds ``counterparty`` and its name: rules on the parties and the file name,
    then companies by stem in the same order, then the site's owner, else unknown.

    The rules are tried once per distinct text, the rest is decided once per distinct set of texts.
    """
    named = df.withColumn("_file", T.file_name(F.col(document)))
    for f in fields:
        named = named.withColumn(f, F.coalesce(f, F.lit("")))
    tried = [*fields, "_file"]
    texts = cut_lineage(named.select(*tried).distinct())
    ids = cut_lineage(T.with_values(texts.select(F.explode(F.array(*tried)).alias("_text")).distinct(),
                                    _known=T.classify_counterparty(F.col("_text"))).where("_known is not null"))
    known = texts
    for c in tried:
        known = known.join(ids.select(F.col("_text").alias(c), F.col("_known").alias(f"_known_{c}")).hint("merge"), c, "left")
    known = cut_lineage(known.select(*tried, F.coalesce(*[f"_known_{c}" for c in tried]).alias("_id")))
    if stems is not None:
        asked = known.where("_id is null").select(*tried, F.posexplode(F.array(*tried)).alias("_pos", "_text")).where(T.not_blank(F.col("_text")))
        found = asked.join(find_company(asked, stems, "_text").hint("merge"), "_text").groupBy(*tried).agg(
            F.min(F.struct("_pos", "company_id", "company_name")).alias("_company"))
        known = known.join(found.hint("merge"), tried, "left").select(
            *tried, F.coalesce("_id", "_company.company_id").alias("_id"), F.col("_company.company_name").alias("_name"))
    else:
        known = known.withColumn("_name", F.lit(None).cast("string"))
    answered = join_lookup(named, known.hint("merge"), tried)
    owner = T.lookup(F.col(site), X.COUNTERPARTY_SITES)
    return (
        answered.withColumn("counterparty", F.coalesce("_id", owner, F.lit(X.UNKNOWN_COUNTERPARTY)))
        .withColumn("counterparty_name", F.coalesce(T.counterparty_name(F.col("counterparty")), "_name"))
        .drop("_file", "_id", "_name")
    )


# ---------------------------------------------------------------- documents

def attach_urls(df: DataFrame, contracts: DataFrame, manifests: DataFrame, extra: DataFrame,
                contract_id: str = "contract_id", document: str = "document", place: str = "place") -> DataFrame:
    """``url`` by contract id, else by local path.

    ``contracts``: (contract_id, url, place); ``manifests``, ``extra``: (document, url, place); ``place`` is the position in the
    list (without it all entries rank alike and the smallest URL counts). Of repeated ids the last entry counts, of repeated paths the first; the extra list comes after the manifests.
    """
    at = lambda df: F.col(place) if place in df.columns else F.lit(0)
    by_id = contracts.where(T.not_blank(F.col("url"))).groupBy(contract_id).agg(F.max_by("url", at(contracts)).alias("_by_id"))
    listed = (
        manifests.where(T.not_blank(F.col("document")) & T.not_blank(F.col("url")))
        .select("document", "url", F.lit(0).alias("_priority"), at(manifests).cast("bigint").alias("_place"))
        .unionByName(extra.select("document", "url", F.lit(1).alias("_priority"), at(extra).cast("bigint").alias("_place")))
    )
    by_path = listed.groupBy("document").agg(
        F.min(F.struct("_priority", "_place", "url")).alias("_best")).select(
        F.col("document").alias("_path"), F.col("_best.url").alias("_by_path"))
    path = F.replace(F.coalesce(F.col(document), F.lit("")), F.lit("\\"), F.lit("/"))
    return (
        df.join(by_id, contract_id, "left").withColumn("_path", path).join(by_path, "_path", "left")
        .withColumn("url", F.coalesce("_by_id", "_by_path", F.lit("")))
        .drop("_path", "_by_id", "_by_path")
    )


def lookup_with_default(df: DataFrame, table: DataFrame, keys: Sequence[str] = ("url", "norm"),
                        values: Sequence[str] = ("counterparty",), row: str = "row_id") -> DataFrame:
    """Look up by all keys, else by the first alone; the first row of ``table`` wins each time."""
    first, *_ = keys
    exact = keep_first(table, keys, [F.col(row)]).select(
        *keys, *[F.col(v).alias("_exact_" + v) for v in values], F.lit(True).alias("_exact"))
    loose = keep_first(table, [first], [F.col(row)]).select(
        first, *[F.col(v).alias("_loose_" + v) for v in values])
    out = df.join(exact, list(keys), "left").join(loose, first, "left")
    for v in values:
        out = out.withColumn(v, F.when(F.col("_exact"), F.col("_exact_" + v)).otherwise(F.col("_loose_" + v)))
    return out.drop("_exact", *["_exact_" + v for v in values], *["_loose_" + v for v in values])
