"""Chat formatting: a role machine, a declarative template, loss spans.

DataFrame functions only.  A template names the markers around the turns of
each role, the roles whose text is learned, and the transitions of a
finite-state machine over roles.  The turns of a conversation become one
string and a list of segments (marker or text, with role, span in code points
and loss flag); the machine says whether the turn order is valid and which
turn breaks it first.

Escaping.  Every control string begins with ``[`` or ``<`` and holds neither
again.  In a text each backslash is doubled, then a backslash goes behind the
first character of each control string, so none is left; dropping every
backslash that escapes undoes both.  Texts come back unchanged.

Defined results: null text and null role are empty; turns sort by turn (null
first), ties by role and text, repeated rows are turns of their own; rows with
null conv_id are one conversation; an empty table gives an empty table; other
columns are ignored.  A conversation is one training example and so one row:
it is the one thing that has to fit into a task.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Template:
    """Markers are (open, close); a role without markers is written with
    ``other_open`` + role + ``other_end`` .. ``other_close``."""

    markers: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("[SYS] ", " [/SYS]"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("[OUT] ", "</s>"),
        }
    )
    #: The role between the first two is escaped up to the ``]`` that begins the second.
    other: tuple[str, str, str] = ("[TURN ", "] ", " [/TURN]")
    learned: tuple[str, ...] = ("assistant",)
    #: What no text may hold unescaped.
    controls: tuple[str, ...] = ("[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[TURN ", "[/TURN]", "<s>", "</s>")
    #: state -> role -> next state; anything else is an error, for good.
    transitions: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    #: States in which a conversation may end.
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for c in self.controls:
            if c[0] not in "[<" or re.search(r"[\[<\\]", c[1:]):
                raise ValueError(f"control string {c!r} must begin with [ or < and hold no other")
        if not self.other[1].startswith("]"):
            raise ValueError("the role of an unnamed turn ends with a ]")
        for m in [x[0] for x in self.markers.values()] + [self.other[0]]:
            if not any(m.startswith(c) for c in self.controls):
                raise ValueError(f"the opening {m!r} must begin with a control string")


def _rx(text: str) -> str:
    return re.sub(r"([\[\](){}.*+?^$|\\/<>])", r"\\\1", text) if text else text


def escape(text: Column, template: Template) -> Column:
    rest = "|".join(_rx(c[1:]) for c in template.controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([\[<])(?=(?:{rest}))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _by_role(role: Column, template: Template, known: int, other: Column) -> Column:
    out = None
    for name, pair in template.markers.items():
        out = (F.when if out is None else out.when)(role == name, F.lit(pair[known]))
    return out.otherwise(other) if out is not None else other


def format_conversations(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, formatted, segments (role, kind, start from 0, length, loss),
    valid, first_bad_turn (its number from 0, null if the order is valid up
    to there), end_state."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    role = F.col("role")
    first, end, last = template.other
    named = F.concat(F.lit(first), F.replace(escape(role, template), F.lit("]"), F.lit("\\]")), F.lit(end))
    rows = (
        rows.withColumn("open", _by_role(role, template, 0, named))
        .withColumn("body", escape(F.col("text"), template))
        .withColumn("close", _by_role(role, template, 1, F.lit(last)))
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    length = F.char_length("open") + F.char_length("body") + F.char_length("close")
    rows = rows.withColumn("at", F.row_number().over(order) - 1).withColumn(
        "start", F.coalesce(F.sum(length.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    )
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "open", "body", "close", "start"))).alias("turns")
    )

    def segments(t: Column) -> Column:
        a, b, c = (F.char_length(t[k]).cast("long") for k in ("open", "body", "close"))
        piece = lambda kind, start, n, loss: F.struct(
            t["role"].alias("role"), F.lit(kind).alias("kind"), start.alias("start"), n.alias("length"), loss.alias("loss")
        )
        learned = t["role"].isin(*template.learned)
        return F.array(
            piece("open", t["start"], a, F.lit(False)),
            piece("text", t["start"] + a, b, learned),
            piece("close", t["start"] + a + b, c, F.lit(False)),
        )

    steps = [F.lit(x) for s, moves in template.transitions.items() for r, to in moves.items() for x in (f"{s} {r}", to)]
    table_ = F.create_map(*steps)
    begin = F.struct(F.lit("start").alias("state"), F.lit(None).cast("int").alias("bad"))

    def move(acc: Column, t: Column) -> Column:
        to = F.when(acc["bad"].isNull(), table_[F.concat(acc["state"], F.lit(" "), t["role"])])
        return F.struct(
            F.coalesce(to, F.lit("error")).alias("state"),
            F.when(acc["bad"].isNotNull(), acc["bad"]).when(to.isNull(), t["at"]).alias("bad"),
        )

    run = F.aggregate("turns", begin, move)
    return (
        grouped.withColumn("machine", run)
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: F.concat(t["open"], t["body"], t["close"])), "").alias("formatted"),
            F.flatten(F.transform("turns", segments)).alias("segments"),
            F.col("machine")["state"].isin(*template.final).alias("valid"),
            F.col("machine")["bad"].alias("first_bad_turn"),
            F.col("machine")["state"].alias("end_state"),
        )
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """array of (role, text), read from the formatted string alone."""
    opens = [(r, o, c) for r, (o, c) in template.markers.items()]
    first, end, last = template.other
    heads = "|".join(_rx(o) for _, o, _ in opens) + "|" + _rx(first)
    name = "^" + _rx(first) + r"((?:\\.|[^\\\]])*)"

    def one(t: Column) -> Column:
        out = None
        for role, o, c in opens:
            body = F.substring(t, F.lit(len(o) + 1), F.char_length(t) - len(o) - len(c))
            this = F.struct(F.lit(role).alias("role"), unescape(body).alias("text"))
            out = (F.when if out is None else out.when)(t.startswith(o), this)
        raw = F.regexp_extract(t, "(?s)" + name, 1)
        head = F.char_length(raw) + len(first) + len(end)
        body = F.substring(t, head + 1, F.char_length(t) - head - len(last))
        other = F.struct(unescape(raw).alias("role"), unescape(body).alias("text"))
        return out.otherwise(other) if out is not None else other

    return F.transform(F.split(formatted, f"(?={heads})"), one)


def read_loss(formatted: Column, segments: Column) -> Column:
    """The text under the loss mask, unescaped, one part after the other."""
    part = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), part), "")


def digest(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """The columns of the registered query, read back from the output."""
    out = format_conversations(turns, template)
    out = out.withColumn("read", read_turns(F.col("formatted"), template)).withColumn(
        "learned", read_loss(F.col("formatted"), F.col("segments"))
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return out.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read", line), ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad_turn",
    )


def with_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table and conversation -1, whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        said.alias("text"),
    )
    return turns.unionByName(probe)
