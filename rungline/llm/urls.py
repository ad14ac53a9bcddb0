"""URL rules on hosts and directories, looked up by hashed expressions.

A URL is expanded into the expressions a rule could be written as: every suffix of its host at a dot, with every prefix of its path at a
slash. Expressions whose first 32 bits of SHA-256 no rule has are done with; the whole digests of the others are joined with the rules', and
of the rules that fit the longest counts. Pages are first brought down to their hosts and leading directories, so a host is expanded
once, whatever its share of the pages, and no expression is longer than the longest rule.
"""
from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungline.llm import common

#: Hexadecimal digits of a digest that expressions and rules meet on first.
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased, and what follows up to ``?``, ``#`` or the end.

    Both are empty where the URL is null or has no ``://``.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def expressions(host: Column, folder: Column, labels: int) -> Column:
    """Suffixes of ``host`` of at most ``labels`` labels, each with every prefix of ``folder`` that is empty or ends with a slash."""
    parts, steps = F.split(host, r"\."), F.split(folder, "/")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), n - labels + 1), n),
                           lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps) - 1),
                           lambda j: F.when(j == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, F.lit(1), j), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def _ranked(rules: DataFrame) -> DataFrame:
    """Rules with their digest, one per expression: a block goes before an allow."""
    whole = F.concat("rule_host", "rule_path")
    return (rules.select(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("rule_host"),
                         F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
            .groupBy(whole.alias("found"), F.length("rule_host").alias("host_length")).agg(F.max("rule_verdict").alias("found_verdict"))
            .withColumn("rule_digest", F.sha2("found", 256)))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, every row once.

    ``rules (host, path, verdict)``: a rule fits its host and all subdomains if the URL's path starts with the rule's, which is empty or ends with a
    slash. The longest rule that fits wins (host and path together; of equally long ones that with the longer host), among equal rules
    a block; ``rule`` is null and ``verdict`` the default where none fits. Null URLs and URLs without ``://`` have an empty host and path,
    which no rule fits. Columns of ``pages`` by the four names are replaced. Repeated rows stay; an empty table gives no rows; without rules all get the default.
    """
    bad = rules.where("host IS NULL OR host = '' OR path IS NULL OR path NOT RLIKE '^(/([^?#]*/)?)?$' OR verdict NOT IN ('allow', 'block')")
    wrong = bad.first()
    if wrong is not None:
        raise ValueError(f"a rule has a host, a path that is empty or begins and ends with a slash, and a verdict: {wrong}")
    # no expression of more labels or slashes than any rule has can fit one
    labels, slashes = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(1)),
                                F.coalesce(F.max(F.size(F.split("path", "/")) - 1), F.lit(0))).first()
    host, path = host_and_path(F.col(url))
    rows = (pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("__row"), host.alias("__host"), path.alias("__path"))
            .withColumn("__folder", F.when(F.lit(slashes) > 0, F.concat_ws("/", F.slice(F.split("__path", "/"), 1, F.least(
                F.lit(slashes), F.size(F.split("__path", "/")) - 1)), F.when(F.locate("/", F.col("__path")) > 0, F.lit("")))).otherwise("")))
    places = rows.select("__host", "__folder").distinct()
    asked = (places.select("__host", "__folder", F.explode(expressions(F.col("__host"), F.col("__folder"), labels)).alias("asked"))
             .withColumn("digest", F.sha2("asked", 256)))
    known = _ranked(rules)
    short = known.select(F.conv(F.substring("rule_digest", 1, SHORT), 16, 10).cast("long").alias("known_short")).distinct()
    near = asked.withColumn("short", F.conv(F.substring("digest", 1, SHORT), 16, 10).cast("long"))
    near = near.join(short, F.col("short") == F.col("known_short"), "left_semi")
    best = (near.join(known, F.col("digest") == F.col("rule_digest")).groupBy("__host", "__folder")
            .agg(F.max(F.struct(F.length("found").alias("n"), "host_length", "found", "found_verdict")).alias("best"))
            .select(F.col("__host").alias("__h"), F.col("__folder").alias("__f"), "best"))
    # as a table of its own, so that a very frequent host's pages can be split
    best = common.written(best, "places")
    ruled = rows.join(best, (rows["__host"] == best["__h"]) & (rows["__folder"] == best["__f"]), "left")
    made = {"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("best.found"),
            "verdict": F.coalesce("best.found_verdict", F.lit(default))}
    kept = [F.col("__row")[c].alias(c) for c in pages.columns if c not in made]
    return ruled.select(*kept, *[c.alias(n) for n, c in made.items()])
