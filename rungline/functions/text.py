"""Column functions on names, numbers, dates and context text.

All stay inside the JVM: no Python runs per row.
"""
from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed as X


# every character Unicode calls white space, as a plain character class
# (letters, digits and signs are left out first, by two ranges instead of ten)
_RARE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf"[[^!-~\xa1-\u167f]&&[ {_RARE}]]"
# the runs that are not a single blank already
_TO_SQUEEZE = rf"[[^ -~\xa1-\u167f]&&[{_RARE}]]{SPACE}*+| {SPACE}++"


def squeeze(col: Column) -> Column:
    """Runs of white space become one blank, the ends are trimmed."""
    return F.trim(F.regexp_replace(col, _TO_SQUEEZE, " "))


# no white space but blanks, as in most windows of a text: told several times faster than runs are found
_ONLY_BLANKS = r"^[ -~\xa1-\u167f]*\z"


def squeeze_column(name: str) -> Column:
    """``squeeze`` of a column at hand, which is used more than once."""
    col = F.col(name)
    return F.when(~F.contains(col, F.lit("  ")) & col.rlike(_ONLY_BLANKS), F.trim(col)).otherwise(squeeze(col))


def _alternatives(pattern: str) -> list[str]:
    found, depth, start = [], 0, 0
    for i, c in enumerate(pattern + "|"):
        depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(c, 0)
        if c == "|" and depth == 0:
            found.append(pattern[start:i])
            start = i + 1
    return found


_SYNTAX = set("\\[](){}?*+.^$|")
# letters and blanks in a row, without one that need not be there
_PLAIN_RUN = re.compile(r"[^\W\d_](?:[^\W\d_]| )*(?![?*{])")
_GROUP = re.compile(r"(?<!\\)\(\?:((?:[^()\[\]]|\[[^\]]*\]|\((?:[^()])*\))*)\)(?![?*{])")


def needed(alternative: str) -> list[str]:
    """Plain texts one of which any match of an alternative has; none if that can't be told."""
    outer, depth = "", 0
    for c in re.sub(r"\\.", "\0", alternative):
        depth += c in "(["
        outer += "\0" if depth else c
        depth -= c in ")]"
    longest = max(_PLAIN_RUN.findall(outer), key=len, default="")
    choices = [[longest]] if longest else []
    for group in _GROUP.findall(alternative):
        each = [needed(a) for a in _alternatives(group)]
        if all(each):
            choices.append(sum(each, []))
    return max(choices, key=lambda n: min(map(len, n)), default=[])


def _grouped(words: list[str]) -> list[tuple[str, list[str]]]:
    """Words with a piece that they share: one search rules all of them out."""
    left = [w for w in dict.fromkeys(words) if not any(v != w and v in w for v in words)]
    groups = []
    while left:
        pieces = sorted({w[i:j] for w in left for i in range(len(w)) for j in range(i + 4, len(w) + 1)})
        best = max(pieces, key=lambda p: (sum(p in w for w in left), len(p)), default="")
        some = [w for w in left if best in w]
        if not best or len(some) < 2:
            return groups + [(w, [w]) for w in left]
        groups.append((best, some))
        left = [w for w in left if w not in some]
    return groups


def _has_word(low: Column, words: list[str]) -> Column:
    # one small loop over a literal list: spelled out, the generated code of a
    # stage grows past what the JVM compiles
    groups = F.array(*[F.struct(F.lit(piece).alias("piece"), F.array(*map(F.lit, some)).alias("words")) for piece, some in _grouped(words)])
    return F.exists(groups, lambda g: F.contains(low, g["piece"]) & F.exists(g["words"], lambda w: F.contains(low, w)))


def _split(pattern: str) -> tuple[list[str], list[str]]:
    """The alternatives without any pattern syntax, and the others."""
    every = _alternatives(pattern.removeprefix(X.LOWER))
    return [a for a in every if not set(a) & _SYNTAX], [a for a in every if set(a) & _SYNTAX]


def mentions(low: Column, pattern: str) -> Column:
    """Whether a lower-case text has a word of an alternation.

    Alternatives without any pattern syntax are searched as plain text, which
    is several times faster than one large pattern; the others are tried only
    where plain text occurs that they need.
    """
    words, patterns = _split(pattern)
    tests = [_has_word(low, words)] if words else []
    for p in patterns:
        test = low.rlike(X.LOWER + p)
        if p.startswith(r"\b") and not set(p[2:]) & _SYNTAX and p[2:3].isalpha():
            test = F.contains(low, F.lit(" " + p[2:])) | test
        plain = needed(p)
        tests.append(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in plain]) & test if plain else test)
    return reduce(lambda a, b: a | b, tests)


def may_mention(low: Column, pattern: str) -> Column:
    """Whether a lower-case text has the plain text that any match needs, in a part of it or as a whole."""
    words, patterns = _split(pattern)
    plain = [needed(p) for p in patterns]
    return _has_word(low, words + [w for some in plain for w in some]) if all(plain) else F.lit(True)


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) != "", col)


def not_blank(col: Column) -> Column:
    return F.coalesce(F.trim(col) != "", F.lit(False))


def group_or_null(col: Column, pattern: str, group: int) -> Column:
    """One capture group of the first match; NULL without a match."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_values(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns worked out exactly once per row.

    Going through a generator keeps the optimizer from copying costly
    expressions (patterns over long texts) into every later filter and use.
    """
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def lookup(col: Column, table: dict) -> Column:
    """A literal lookup table of fixed size as a map expression."""
    pairs = [F.lit(part) for entry in table.items() for part in entry]
    return F.try_element_at(F.create_map(*pairs), col)


# ---------------------------------------------------------------- names

def normalize_union(col: Column) -> Column:
    """A union name in comparable form (case, tails, brackets, genitives)."""
    name = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    name = F.split(name, r"(?U)\s+[-–]\s+").getItem(0)
    name = F.regexp_replace(name, r"(?U)\s*\(.*?\)", "")
    name = F.regexp_replace(name, r"(?U)\s+stéttarfélag(?:s)?$", "")
    name = F.trim(F.regexp_replace(name, r"[.,]", ""))
    name = F.regexp_replace(name, r"(samband|félag)s$", "$1")
    return F.regexp_replace(name, r"^samiðnar$", "samiðn")


def union_key(name: Column, union_id: Column) -> Column:
    norm = normalize_union(name)
    return (
        F.when(norm != "", F.concat(F.lit("nafn:"), norm))
        .when(not_blank(union_id), F.concat(F.lit("id:"), union_id))
        .otherwise(F.lit(X.UNKNOWN))
    )


def _accent_pairs() -> tuple[str, str]:
    """Accented Latin letter -> base letter, derived from Unicode decomposition."""
    source, target = [], []
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for code in block:
            letter = chr(code)
            if letter in X.LETTER_FOLD:
                continue
            base = "".join(c for c in unicodedata.normalize("NFKD", letter)
                           if not unicodedata.combining(c))
            if len(base) == 1 and base != letter:
                source.append(letter)
                target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_pairs()


def ascii_fold(col: Column) -> Column:
    """Lower case without accents; þ, æ, ö, ð become th, ae, o, d."""
    text = F.lower(F.coalesce(col, F.lit("")))
    for letter, plain in X.LETTER_FOLD.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{M}+", "")


def _dashed(folded: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(folded, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def slug(col: Column, chars: int = X.SLUG_CHARS, empty: str = X.EMPTY_SLUG) -> Column:
    text = F.left(_dashed(ascii_fold(col)), F.lit(chars))
    return F.when(text == "", F.lit(empty)).otherwise(text)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.coalesce(path, F.lit("")), "/"), -1)


def first_path_part(path: Column) -> Column:
    return F.split(path, "/").getItem(0)


# --------------------------------------------------------- counterparties

def classify_counterparty(col: Column) -> Column:
    """Id of the known counterparty a text names, else NULL. Rules are ordered."""
    plain = squeeze(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[_-]", " "))

    def first_rule(text: Column, folded: Column) -> Column:
        result = None
        for ident, _, _, patterns in X.COUNTERPARTIES:
            pattern = "(?U)" + "|".join(f"(?:{p})" for p in patterns)
            hit = text.rlike(pattern) | folded.rlike(pattern)
            result = F.when(hit, ident) if result is None else result.when(hit, ident)
        return result

    return once(plain, lambda text: once(ascii_fold(text), lambda folded: first_rule(text, folded)))


def company_id(col: Column) -> Column:
    name = F.regexp_replace(F.coalesce(col, F.lit("")), X.LEGAL_FORM, "")
    name = F.regexp_replace(name, r"\(.*?\)", "")
    name = F.split(name, ",").getItem(0)
    short = F.left(_dashed(ascii_fold(name)), F.lit(X.COMPANY_SLUG_CHARS))
    short = F.coalesce(lookup(short, X.COMPANY_ALIASES), short)
    return (F.when(short == "", F.lit(X.UNKNOWN_COUNTERPARTY))
            .otherwise(F.concat(F.lit(X.COMPANY_PREFIX), short)))


def counterparty_name(ident: Column) -> Column:
    names = {i: name for i, name, _, _ in X.COUNTERPARTIES}
    names[X.UNKNOWN_COUNTERPARTY] = X.UNKNOWN_COUNTERPARTY_NAME
    return lookup(ident, names)


def counterparty_kind(ident: Column) -> Column:
    kinds = {i: kind for i, _, kind, _ in X.COUNTERPARTIES}
    kinds[X.UNKNOWN_COUNTERPARTY] = X.KIND_UNKNOWN
    return F.coalesce(lookup(ident, kinds), F.lit(X.KIND_COMPANY))


def counterparty_from_register(col: Column, placeholders: tuple[str, ...] = ()) -> Column:
    """struct(id, name) for a register name: known, unknown (blank) or company.

    ``placeholders`` (lower case) are treated as blank; none by default, as
    in the published data.
    """
    name = F.coalesce(col, F.lit(""))
    if placeholders:
        name = F.when(F.lower(F.trim(name)).isin(*placeholders), "").otherwise(name)
    short = F.trim(F.split(F.regexp_replace(name, X.LEGAL_FORM, ""), ",").getItem(0))
    unknown = F.trim(name) == ""

    def answer(known: Column) -> Column:
        return F.struct(
            F.when(known.isNotNull(), known)
            .when(unknown, F.lit(X.UNKNOWN_COUNTERPARTY))
            .otherwise(company_id(name)).alias("id"),
            F.when(known.isNotNull(), counterparty_name(known))
            .when(unknown, F.lit(X.UNKNOWN_COUNTERPARTY_NAME))
            .otherwise(F.when(short != "", short).otherwise(F.trim(name))).alias("name"),
        )

    return once(classify_counterparty(name), answer)


def company_stem(col: Column) -> Column:
    """First word of a company name without its case ending."""
    folded = F.trim(squeeze(ascii_fold(
        F.regexp_replace(F.coalesce(col, F.lit("")), X.LEGAL_FORM, ""))))
    word = F.regexp_replace(F.split(folded, " ").getItem(0), "[^a-z0-9]", "")
    return F.when(F.length(word) < 6, word).otherwise(F.left(word, F.length(word) - 1))


# ------------------------------------------------------------ numbers, dates

def round_places(col: Column, places: int = 2) -> Column:
    """Round half up, after floating-point noise beyond eight decimals is gone; of any size."""
    return F.round(F.round(col, 8), places)


def parse_percent(col: Column) -> Column:
    return F.replace(F.trim(col), F.lit(","), F.lit(".")).try_cast("double")


def parse_amount(col: Column) -> Column:
    return F.replace(F.trim(col), F.lit("."), F.lit("")).try_cast("bigint")


def parse_wage(col: Column) -> Column:
    return F.replace(F.replace(F.trim(col), F.lit("."), F.lit("")),
                     F.lit(","), F.lit(".")).try_cast("double")


def parse_review_percent(col: Column) -> Column:
    """A reviewer's percent; NULL when blank or unreadable (see ``unreadable``)."""
    cleaned = F.regexp_replace(F.trim(F.coalesce(col, F.lit(""))), "[% ]", "")
    return F.replace(F.nullif(cleaned, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def parse_review_amount(col: Column, currency: bool = False) -> Column:
    drop = r"(?iU)kr\.?|\s|\." if currency else r"[% .]"
    cleaned = F.regexp_replace(F.trim(F.coalesce(col, F.lit(""))), drop, "")
    return F.nullif(cleaned, F.lit("")).try_cast("bigint")


def unreadable(raw: Column, parsed: Column) -> Column:
    """Something was written but it is no number."""
    return not_blank(F.regexp_replace(F.coalesce(raw, F.lit("")), "[% ]", "")) & parsed.isNull()


def make_date(year: Column, month: Column, day: Column) -> Column:
    """A date, or NULL where the calendar has none (31 February)."""
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    exists = year.between(1, 9999) & month.between(1, 12) & day.between(F.lit(1), F.dayofmonth(F.last_day(first)))
    return F.when(exists, F.date_add(first, day.cast("int") - 1))


def month_number(word: Column) -> Column:
    return lookup(F.lower(word), X.MONTHS)


def parse_is_date(col: Column) -> Column:
    """The first date in a text: ``1. júní 1988`` or ``1.6.1988``."""
    worded = make_date(
        group_or_null(col, X.DATE_IN_TEXT, 3).try_cast("int"),
        month_number(F.regexp_extract(col, X.DATE_IN_TEXT, 2)),
        group_or_null(col, X.DATE_IN_TEXT, 1).try_cast("int"),
    )
    numeric = r"(?<!\d)(\d{1,2})\.\s?(\d{1,2})\.\s?(\d{4})(?!\d)"
    digits = make_date(*[group_or_null(col, numeric, g).try_cast("int") for g in (3, 2, 1)])
    return F.coalesce(worded, digits)


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy'M'MM")


def month_index(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def month_gap(earlier: Column, later: Column) -> Column:
    """Calendar months between two dates; the day is ignored."""
    return month_index(later) - month_index(earlier)


# ------------------------------------------------------- increase wording

def classify_basis(context: Column, low: Column | None = None) -> Column:
    """The basis an increase is named for; ``low``: the context in lower case, where that is at hand."""
    def first_pattern(low: Column) -> Column:
        chain = None
        for name, pattern in X.BASIS_PATTERNS:
            hit = mentions(low, pattern)
            chain = F.when(hit, name) if chain is None else chain.when(hit, name)
        return chain.otherwise(X.BASIS_UNSPECIFIED)

    return once(F.lower(context), first_pattern) if low is None else first_pattern(low)


def increase_type(pct: Column, amount: Column, context: Column, low: Column | None = None) -> Column:
    both = pct.isNotNull() & amount.isNotNull()
    low = F.lower(context) if low is None else low
    return (
        F.when(both & low.rlike(X.OR_WORD), X.TYPE_EITHER)
        .when(both & low.rlike(X.FLOOR_WORD), X.TYPE_FLOOR)
        .when(both, X.TYPE_BOTH)
        .when(pct.isNotNull(), X.TYPE_PERCENT)
        .otherwise(X.TYPE_AMOUNT)
    )


def manual_type(pct: Column, amount: Column) -> Column:
    """Type of a manually entered increase, from which values are given."""
    return (F.when(pct.isNotNull() & amount.isNull(), X.TYPE_PERCENT)
            .when(amount.isNotNull() & pct.isNull(), X.TYPE_AMOUNT)
            .otherwise(X.TYPE_BOTH))


def _decimal_comma(text: Column) -> Column:
    return F.translate(text, ".,", ",.")


def describe(pct: Column, amount: Column) -> Column:
    """``3,50% / 23.750 kr`` with Icelandic separators, ``-`` when empty."""
    pct_text = F.concat(_decimal_comma(F.format_number(F.nullif(pct, F.lit(0.0)), 2)), F.lit("%"))
    amount_text = F.concat(
        _decimal_comma(F.format_number(F.nullif(amount.cast("bigint"), F.lit(0)), 0)), F.lit(" kr"))
    text = F.concat_ws(" / ", pct_text, amount_text)
    return F.when(text == "", "-").otherwise(text)


def signed_percent(value: Column) -> Column:
    """``+3,5%`` or ``−1,2%`` (with a true minus sign)."""
    size = _decimal_comma(F.format_number(F.abs(value), 1))
    rounded_down = (value < 0)
    return F.concat(F.when(rounded_down, "−").otherwise("+"), size, F.lit("%"))


# --------------------------------------------------------------- documents

def is_relevant(text: Column, wanted: str = X.RELEVANT_FILE,
                unwanted: str = X.IRRELEVANT_FILE) -> Column:
    return ~text.rlike(unwanted) & text.rlike(wanted)


def is_contract(name: Column, text: Column) -> Column:
    """Looks like a contract: long enough, no newsletter, several markers."""
    head = F.left(text, F.lit(X.CONTRACT_MARKER_CHARS))
    return (
        (F.length(text) >= X.CONTRACT_MIN_CHARS)
        & ~name.rlike(X.NOT_CONTRACT_NAME)
        & (F.regexp_count(head, F.lit(X.CONTRACT_MARKER)) >= X.CONTRACT_MARKERS_NEEDED)
    )


def _clean_party(col: Column) -> Column:
    text = squeeze(col)
    text = F.regexp_replace(text, r"(?iuU)^(?:annars vegar|hins vegar|samnings?)\s+", "")
    text = F.regexp_replace(text, r"(?iuU)\s+(?:annars|hins)\s+vegar$", "")
    return F.regexp_replace(F.left(text, F.lit(110)), r"^[ ,.\-:]+|[ ,.\-:]+$", "")


def extract_parties(text: Column) -> Column:
    """struct(party_1, party_2) from the head of a contract, or NULL."""
    head = F.left(text, F.lit(X.PARTY_CHARS))
    tries = []
    for pattern in X.PARTY_PATTERNS:
        pair = [_clean_party(F.regexp_extract(head, pattern, g)) for g in (1, 2)]
        fits = reduce(lambda a, b: a & b, [F.length(p).between(3, 110) for p in pair])
        tries.append(F.when(fits, F.struct(pair[0].alias("party_1"), pair[1].alias("party_2"))))
    return F.coalesce(*tries)


def extract_validity(text: Column, name: Column) -> Column:
    """struct(valid_from, valid_to): wording in the head, else years in the file name."""
    head = F.left(text, F.lit(X.VALIDITY_CHARS))
    part = [F.regexp_extract(head, X.VALIDITY, g) for g in range(1, 7)]
    start = make_date(part[2].try_cast("int"), month_number(part[1]), part[0].try_cast("int"))
    end = make_date(part[5].try_cast("int"), month_number(part[4]), part[3].try_cast("int"))
    years = [group_or_null(name, X.YEARS_IN_NAME, g).try_cast("int") for g in (1, 2)]
    worded = part[0] != ""
    return F.struct(
        F.when(worded, start).otherwise(make_date(years[0], F.lit(1), F.lit(1))).alias("valid_from"),
        F.when(worded, end).otherwise(make_date(years[1], F.lit(12), F.lit(31))).alias("valid_to"),
    )


def parse_form(body: Column) -> Column:
    """Sections of a ``### Heading`` form as a map from field to value."""
    def value(section: Column) -> Column:
        after = F.substr(section, F.length(F.substring_index(section, "\n", 1)) + 2)
        return once(F.regexp_replace(after, r"(?U)^\s+|\s+$", ""), lambda v: F.when(v == X.FORM_NO_RESPONSE, "").otherwise(v))

    def fields(known: Column) -> Column:
        # of several sections with one heading the last counts
        last = F.filter(known, lambda s, i: ~F.exists(F.slice(known, i + 2, F.size(known)), lambda later: later["key"] == s["key"]))
        return F.map_from_entries(F.transform(last, lambda s: F.struct(s["key"].alias("key"), value(s["section"]).alias("value"))))

    def headed(sections: Column) -> Column:
        found = F.transform(F.slice(sections, 2, F.size(sections)), lambda s: F.struct(
            lookup(F.rtrim(F.substring_index(s, "\n", 1)), X.FORM_HEADINGS).alias("key"), s.alias("section")))
        return F.filter(found, lambda s: s["key"].isNotNull())

    # each section's heading is read once, and only the values that are kept are worked out
    return once(once(F.split(F.concat(F.lit("\n"), F.coalesce(body, F.lit(""))), r"\n###\s+"), headed), fields)
