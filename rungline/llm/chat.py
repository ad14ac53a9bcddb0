r"""Chat formatting with a grammar round trip, in column expressions alone.

A turn is written as ``[INST] text [/INST]`` (user), ``<s> text </s>`` (assistant) or
``[ROLE] role [SAYS] text [/ROLE]`` (any other role). The parser is deterministic: a conversation is cut after each closing control string that
no backslash precedes; a part must be one whole turn whose texts hold no bare control string, and one backslash is
taken off in front of each control string. A turn whose parse is not the source is written again with a backslash
before each control string (and before backslashes that stand in front of one), which always parses back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the template.
CONTROL = r"(?:</?s>|\[/?INST\]|\[/?ROLE\]|\[SAYS\])"
_CLOSING = r"(?<=(?<!\\)(?:</s>|\[/INST\]|\[/ROLE\]))"
_TURN = r"(?s)^(?:\[INST\] (.*) \[/INST\]|<s> (.*) </s>|\[ROLE\] (.*?) \[SAYS\] (.*) \[/ROLE\])$"


# A run of backslashes is read once, from its first one.
def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+{CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{CONTROL})", "$1")


def render(role: Column, text: Column) -> Column:
    return (F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
            .when(role == "assistant", F.concat(F.lit("<s> "), text, F.lit(" </s>")))
            .otherwise(F.concat(F.lit("[ROLE] "), role, F.lit(" [SAYS] "), text, F.lit(" [/ROLE]"))))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text); both are null where the text breaks the grammar."""
    bare = rf"(?<!\\){CONTROL}"

    def turn(part: Column) -> Column:
        other = part.startswith("[ROLE]")
        role = F.when(part.startswith("[INST]"), "user").when(part.startswith("<s>"), "assistant").when(
            other, F.regexp_extract(part, _TURN, 3))
        text = (F.when(part.startswith("[INST]"), F.regexp_extract(part, _TURN, 1))
                .when(part.startswith("<s>"), F.regexp_extract(part, _TURN, 2)).otherwise(F.regexp_extract(part, _TURN, 4)))
        good = part.rlike(_TURN) & ~text.rlike(bare) & ~role.rlike(bare)
        return F.struct(F.when(good, unescape(role)).alias("role"), F.when(good, unescape(text)).alias("text"))

    return F.transform(F.filter(F.split(formatted, _CLOSING), lambda p: p != ""), turn)


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, mask``, one row per conversation of ``rows (conv_id, turn, role, text)``.

    ``mask`` has an entry per turn, in code points of ``formatted``: where the turn begins, and the span under the loss
    (an assistant's text; empty for others). Turns are ordered by turn (null first), then role and text. Null text or role: empty. Rows with a
    null conv_id form one conversation; repeated rows are turns of their own. No rows: no conversations.
    """
    source = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain, safe = render(F.col("role"), F.col("text")), render(F.when(F.col("role").isin("user", "assistant"), F.col("role"))
                                                               .otherwise(escape(F.col("role"))), escape(F.col("text")))
    same = parse(F.col("__plain")).eqNullSafe(F.array(F.struct("role", "text")))
    turns = source.withColumn("__plain", plain).withColumn("__out", F.when(same, F.col("__plain")).otherwise(safe))
    lead = F.when(F.col("role") == "assistant", 4).otherwise(0)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("__out")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = turns.select("conv_id", "__out", F.row_number().over(order).alias("__n"), before.alias("turn_start"),
                         lead.alias("__lead"), F.length("__out").alias("__length"))
    start = F.col("turn_start") + F.col("__lead")
    end = F.when(F.col("__lead") > 0, F.col("turn_start") + F.col("__length") - 5).otherwise(start)
    listed = F.array_sort(F.collect_list(F.struct("__n", "__out", "turn_start", start.alias("start"), end.alias("end"))))
    return spans.groupBy("conv_id").agg(listed.alias("__t")).select(
        "conv_id", F.array_join(F.transform("__t", lambda t: t["__out"]), "").alias("formatted"),
        F.transform("__t", lambda t: F.struct(t["turn_start"], t["start"], t["end"])).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``formatted (conv_id, formatted, mask)`` holds: turns as parsed, text under the mask."""
    parts = F.filter(F.split("formatted", _CLOSING), lambda p: p != "")
    under = F.zip_with(parts, F.col("mask"), lambda p, m: unescape(
        F.substring(p, (m["start"] - m["turn_start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    loss = F.array_join(under, "")
    told = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (formatted.withColumn("__turns", parse(F.col("formatted"))).withColumn("__loss", loss)
            .select("conv_id", F.size("__turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                    F.length("__loss").cast("long").alias("loss_chars"), F.sha2("__loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
