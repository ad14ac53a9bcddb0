"""The whole batch: texts and records in, series, summaries, documents and checks out.

Every stage is a function from DataFrames to DataFrames. Lineage is cut after
extraction (the costly read of all texts) and after the series, which the
summaries, documents and checks all read.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from ..operators import consensus as C
from ..operators import extract as E
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import resolve as R
from ..operators import series as S
from ..session import cut_lineage
from ..sources import sinks

DESCRIBE = ("type", "union_name", "union_id", "market", "umbrella", "document", "url")


@dataclass
class Series:
    increases: DataFrame
    main: DataFrame
    points: DataFrame
    series: DataFrame
    lines: DataFrame
    unions: DataFrame


def register_increases(contracts: DataFrame) -> DataFrame:
    """Increases of the register's contracts, with their metadata."""
    named = contracts.select(
        F.col("id").alias("contract_id"), F.col("launthegi_felag_id").alias("union_id"),
        F.coalesce(T.blank_to_null(F.col("launthegi_canonical")), F.col("launthegi")).alias("union_name"),
        F.col("atvinnurekandi").alias("employer"), F.col("markadsflokk").alias("market"),
        F.col("heildarsamtok").alias("umbrella"), F.col("filename").alias("document"),
        F.col("pdf_url").alias("url"), F.col("fra").alias("validity_from"), F.col("til").alias("validity_to"),
        F.col("ocr_text").alias("text"))
    keep = ["contract_id", "union_id", "union_name", "employer", "market", "umbrella", "document", "url"]
    return E.extract_increases(named.where(T.not_blank(F.col("text"))), keep)


def web_increases(documents: DataFrame) -> DataFrame:
    """Increases of collected documents (path, text) that look like contracts."""
    name = T.file_name(F.col("path"))
    contracts = T.with_values(
        documents.where(T.is_contract(name, F.col("text"))),
        _parties=T.extract_parties(F.col("text")), _valid=T.extract_validity(F.col("text"), name))
    read = contracts.select(
        F.col("path").alias("document"), T.first_path_part(F.col("path")).alias("site"), "text",
        F.col("_parties.party_1").alias("party_1"), F.col("_parties.party_2").alias("party_2"),
        F.col("_valid.valid_from").alias("validity_from"), F.col("_valid.valid_to").alias("validity_to"))
    return E.extract_increases(read, ["document", "site", "party_1", "party_2"])


def with_row_ids(df: DataFrame, *order: str) -> DataFrame:
    """A stable id that only depends on the row's own values.

    Ties are broken by "first in (date, name) order", so the high bits are the
    day and the low bits a hash of the row.
    """
    day = F.coalesce(F.unix_date("valid_from"), F.lit(0)).cast("bigint") + 1_000_000
    low = F.pmod(F.xxhash64(*order, "pct", "amount", "basis"), F.lit(1 << 41))
    return df.withColumn("row_id", day * (1 << 41) + low)


def in_publication_order(df: DataFrame) -> DataFrame:
    """``row_id`` counts the rows from 1 by date, then name, so that "first seen" means the same in every run.

    Rows are numbered within (date, name); the rows before come from one row per date and name, and
    those of earlier dates from one row per day of the calendar.
    """
    key = [F.coalesce(F.col("valid_from").cast("string"), F.lit("")).alias("_day"), F.coalesce("union_name", F.lit("")).alias("_name")]
    other = [c for c in df.columns if c != "row_id"]
    rows = df.select("*", *key)
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    named = rows.groupBy("_day", "_name").agg(F.count(F.lit(1)).alias("_n"))
    before = named.withColumn("_in_day", earlier(Window.partitionBy("_day").orderBy("_name"))).drop("_n")
    days = named.groupBy("_day").agg(F.sum("_n").alias("_n")).withColumn("_days", earlier(Window.orderBy("_day"))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_day", "_name").orderBy("row_id"))
    return (rows.withColumn("_place", place).join(before, ["_day", "_name"]).join(days, "_day")
            .select((F.col("_days") + F.col("_in_day") + F.col("_place")).alias("row_id"), *other).select(*df.columns))


def merge(register: DataFrame, web: DataFrame, manual: DataFrame, companies: DataFrame,
          contracts: DataFrame, manifests: DataFrame, extra_urls: DataFrame) -> DataFrame:
    """The three sources with union, counterparty, URL and provenance per row."""
    register = with_row_ids(register, "union_name", "document")
    # the name a union is first written by is the first in order of date and name, not of a hash
    known = R.known_unions(in_publication_order(register))
    web = with_row_ids(web, "document")
    resolved = R.resolve_union(web, known)
    stems = R.company_stems(companies, contracts.select("union_name"))
    placed = R.counterparty_from_document(resolved, stems)
    linked = R.attach_urls(placed.withColumn("contract_id", F.lit(None).cast("string")),
                           contracts.select("contract_id", "url"), manifests, extra_urls)
    manual = with_row_ids(manual, "union_name", "source")
    return in_publication_order(M.merge_sources(register, linked.drop("contract_id"), manual))


def build_series(increases: DataFrame, as_of: Column, federations: DataFrame, overrides: DataFrame,
                 confirmed: DataFrame) -> Series:
    """From merged increases to the series and its summaries.

    ``federations``: (member, federation, counterparty) and ``overrides``:
    (union_key, counterparty), by union key; ``confirmed``: (union_key,
    counterparty, gap_from, gap_to).
    """
    rows = cut_lineage(
        C.trusted(increases).withColumn("union_key", T.union_key(F.col("union_name"), F.col("union_id"))))
    members = federations.select(F.col("member").alias("union_key"), "counterparty").distinct()
    main = cut_lineage(C.choose_main(rows, as_of, members, overrides))
    lined = C.assign_line(rows, main)
    points = C.consensus(lined, describe=DESCRIBE, origin="origin", name="counterparty_name")
    folded = S.fold_company_lines(points, main, name="counterparty_name")
    inherited = cut_lineage(S.inherit(folded, federations, describe=("union_name", "union_id", "market", "umbrella"),
                                      federation_name="union_name"))
    flagged = inherited.join(main, "union_key", "left").withColumn(
        "is_main", (F.col("counterparty") == F.col("main_counterparty")).cast("int")).drop("main_counterparty")
    series = cut_lineage(S.build_series(flagged, confirmed, replaced=("basis", "type", "document", "url", "amount")))
    lines = S.line_summary(series, inherited="inherited_from")
    return Series(rows, main, inherited, series, lines, described_unions(series, S.union_summary(lines, main)))


def described_unions(series: DataFrame, unions: DataFrame) -> DataFrame:
    """Unions with the name on the first row of their line, the most frequent id, market and umbrella of all lines, and a slug.

    Slugs are given in order of size, equal ones as first seen.
    """
    name = F.coalesce(F.min_by("union_name", F.when(F.col("counterparty") == F.col("main_line"), F.struct("valid_from", "first_row"))),
                      F.min_by("union_name", "first_row"))
    named = (series.join(unions.select("union_key", "main_line"), "union_key").groupBy("union_key")
             .agg(name.alias("union_name"), F.min("first_row").alias("_seen")))
    full = unions.join(named, "union_key").join(S.union_modes(series), "union_key", "left")
    size = F.lit(1_000_000) - F.least(F.col("n_increases"), F.lit(1_000_000))
    return sinks.with_slugs(full.withColumn("_order", size * 1_000_000_000_000 + F.col("_seen")), "union_name", "_order").drop("_order", "_seen")


#: Names that published rows, lines and unions carry, and the columns they come from.
ROW_FIELDS = {"dagsetning": "valid_from", "a_vid": "basis", "prosenta": "pct", "kronur": "amount", "tegund": "type", "visitala": "index",
              "visitala_samfella": "stretch_index", "innan_samfellu": "in_stretch", "i_kedju": "in_chain", "bil_manudir": "gap_months",
              "visitala_athugasemd": "note", "heimildir": "sources", "olik_gildi": "distinct_pcts", "sameinad": "merged", "upprunar": "origins",
              "erft_fra": "inherited_from", "ur_serssamningi": "filled_from", "skjal": "document", "slod": "url"}
LINE_FIELDS = {"motadili_heiti": "counterparty_name", "tegund": "kind", "adalsamningur": "is_main", "erft_fra": "inherited_from",
               "fjoldi_haekkana": "n_increases", "fyrsta": "first_date", "sidasta": "last_date", "samfelld_fra": "stretch_from",
               "samfelld_ar": "stretch_years", "eldri_eydur": "older_gaps", "heilleiki": "grade"}
UNION_FIELDS = {"audkenni": "slug", "felag": "union_name", "felag_id": "union_id", "markadur": "market", "heildarsamtok": "umbrella",
                "fyrsta": "first_date", "sidasta": "last_date", "fjoldi_haekkana": "n_increases", "fjoldi_samninga": "n_lines", "heilleiki": "grade",
                "samfelld_fra": "stretch_from", "samfelld_ar": "stretch_years", "eldri_eydur": "older_gaps", "mesta_bil_manudir": "longest_gap"}


def _renamed(df: DataFrame, fields: dict[str, str], *keep: str) -> DataFrame:
    """The columns ``fields`` names that ``df`` has, under the names they are published by; blank texts are null."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    told = {n: F.nullif(F.col(c), F.lit("")) if kinds.get(c) == "string" else F.array_join(c, ",") if kinds.get(c) == "array" else F.col(c)
            for n, c in fields.items() if c in kinds}
    return df.select(*keep, *[c.alias(n) for n, c in told.items()])


def documents_by_union(built: Series, rates: DataFrame) -> DataFrame:
    """``audkenni`` and the whole document of each union as JSON: its header, the main line's rows, all lines with theirs, measured rate changes.

    Lines go main line first, then by size. Values that are lacking are told as null.
    """
    key = ["union_key", "counterparty"]
    names = (built.series.groupBy(*key).agg(F.min_by("counterparty_name", "valid_from").alias("counterparty_name"))
             if "counterparty_name" in built.series.columns else built.lines.select(*key, T.counterparty_name(F.col("counterparty")).alias("counterparty_name")))
    lines = (built.lines.join(names, key).join(built.unions.select("union_key", "main_line"), "union_key")
             .withColumn("is_main", F.col("counterparty") == F.col("main_line")).withColumn("kind", T.counterparty_kind(F.col("counterparty"))))
    order = {"_other": ~F.col("is_main"), "_size": -F.col("n_increases")}
    shaped = _renamed(lines.withColumns(order), LINE_FIELDS, "union_key", "counterparty", *order).withColumnRenamed("counterparty", "motadili")
    rows = _renamed(built.series, ROW_FIELDS, "union_key", "counterparty").withColumnRenamed("counterparty", "motadili")
    main = shaped.where("adalsamningur").select("union_key", F.struct("motadili", F.col("motadili_heiti").alias("heiti")).alias("_main"))
    unions = _renamed(built.unions, UNION_FIELDS, "union_key", "main_line").join(main, "union_key", "left")
    changes = rates.select("union_key", F.col("from_date").alias("fra_dags"), F.col("to_date").alias("til_dags"), F.col("pct").alias("prosenta"),
                           *[c for c in rates.columns if c not in ("union_key", "from_date", "to_date", "pct")]).withColumnRenamed("til_dags", "to_date")
    nested = sinks.union_documents(unions, shaped, rows, changes, [c for c in rows.columns if c not in ("union_key", "motadili")],
                                   [n for n in LINE_FIELDS if n in shaped.columns], counterparty="motadili", order=list(order), date="dagsetning")
    header = [n for n in UNION_FIELDS if n in unions.columns]
    fields = [*header[:5], F.col("_main").alias("adalsamningur"), *header[5:], "haekkanir", "samningar",
              F.transform(F.coalesce("taxtahaekkanir", F.array()), lambda t: t.withField("til_dags", t["to_date"]).dropFields("to_date")).alias("taxtahaekkanir")]
    return nested.select("audkenni", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("body"))


def publish(built: Series, rates: DataFrame, index: DataFrame, prices: DataFrame, path: str, base_url: str, version: str | None = None) -> str:
    """All outputs as a new version under ``path``: a file per union by its slug, increases by year, the union index, both indices.

    ``index.json`` holds the counts and names the version; it is replaced last and at once, so that a run that is stopped leaves the last publication
    as it was. Returns the version's folder. ``rates``: (union_key, from_date, to_date, pct); ``index`` and ``prices``: (month, value).
    """
    version = version or f"utgafa-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    columns = ["row_id", "union_key", "union_name", "counterparty", "valid_from", "pct", "amount", "basis", "type", "origin", "document", "url"]
    sinks.write_by_year(built.increases, f"{folder}/ar", "valid_from", [c for c in columns if c in built.increases.columns], "row_id")
    documents = documents_by_union(built, rates)
    sinks.write_documents(documents.select(F.concat("audkenni", F.lit(".json")).alias("name"), "body"), f"{folder}/felog")
    sinks.union_index(built.unions, f"{base_url}/{version}").write.json(f"{folder}/felog_skra")
    both = index.select("month", "value", F.lit("launavisitala").alias("series")).unionByName(
        prices.select("month", "value", F.lit("visitala_neysluverds").alias("series")))
    sinks.index_documents(both).write.json(f"{folder}/visitolur")
    counts = sinks.manifest(built.unions, built.increases, built.series, built.lines, rates)
    told = counts.select(F.to_json(F.struct(
        F.lit(version).alias("utgafa"), F.lit(base_url).alias("grunnslod"), F.struct("felog", "haekkanir", "maelipunktar", "samningslinur", "taxtahaekkanir",
                                                                                   F.when(F.col("fyrsta_ar").isNotNull(), F.array("fyrsta_ar", "sidasta_ar")).alias("ar")).alias("tolur")),
        {"ignoreNullFields": "false"})).first()[0]
    sinks.publish_folder(path, told)
    return folder


def check(built: Series, index: DataFrame, prices: DataFrame, cap: Column) -> DataFrame:
    """The quality gate over increases, series, unions and benchmark."""
    main_series = built.series.where("is_main = 1")
    low, high = X.EXTRACT_PERCENT
    return Q.quality_report([
        Q.check_nonempty(built.increases, "hækkanir til"),
        Q.check_nonempty(built.series, "tímaröð til"),
        Q.check_nonempty(index, "launavísitala til"),
        Q.check_nonempty(prices, "vísitala neysluverðs til", Q.WARNING),
        Q.check_range(built.increases, "prósentur innan marka", "pct", low, high, open_low=True),
        Q.check_range(built.increases, "krónutölur innan marka", "amount", *X.EXTRACT_AMOUNT),
        Q.check_median(built.increases, "miðgildi prósentu trúverðugt", "pct", 2.0, 5.0),
        Q.check_dates(built.increases, "engar fjarlægar framtíðardagsetningar", high=F.lit("2030-01-01").cast("date")),
        Q.check_dates(built.increases, "engar fjarlægar fortíðardagsetningar", low=F.lit("1960-01-01").cast("date")),
        Q.check_unique(built.series, "ein lína á hvert (félag, mótaðila, dagsetning)"),
        Q.check_single_main(built.series, "einn aðalsamningur á hvert félag"),
        Q.check_has_main(built.series, "hvert félag á aðalsamning"),
        Q.check_main_reference(built.series, built.unions, "félög vísa á aðalsamninginn"),
        Q.check_ceiling(Q.over_ceiling(main_series, built.unions, index, cap), "engin samfelld röð yfir launavísitölu"),
        Q.check_not_blank(built.increases, "allar hækkanir bera tilvitnun", "quotation"),
    ])
