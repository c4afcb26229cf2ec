"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered turn by turn: ``[INST]text[/INST]`` for a user, ``<s>text</s>`` for an
assistant, ``<<SYS>>role`` newline ``text<</SYS>>`` for any other role (its name URL-encoded).
The parser accepts exactly this grammar: a text may hold no control string, and one backslash
behind the first character of a control string is taken off. Rendering is tried as it is; if the
parser does not give back the source, the conversation is rendered with its control strings
escaped, which it does give back.

Nulls: a null text or role is empty; a null conv_id is a conversation; a null turn comes first.
Turns are ordered by turn, then role, then text, so ties and repeated rows have one order and all
are kept. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template, without their first character.
CONTROL_TAILS = [r"s>", r"/s>", r"INST\]", r"/INST\]", r"<SYS>>", r"</SYS>>"]
TAILS = "|".join(CONTROL_TAILS)
CONTROL = rf"[<\[](?:{TAILS})"
ESCAPABLE = rf"([<\[])(\\*)({TAILS})"
ESCAPED = rf"([<\[])\\(\\*)({TAILS})"
TURN = r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render_turn(role: Column, text: Column) -> Column:
    return (
        F.when(role == "user", F.concat(F.lit("[INST]"), text, F.lit("[/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(
            F.concat(F.lit("<<SYS>>"), F.url_encode(role), F.lit("\n"), text, F.lit("<</SYS>>"))
        )
    )


def _parse_turn(turn: Column) -> Column:
    def between(opener: str, closer: str) -> Column:
        return F.substring(turn, F.lit(len(opener) + 1), F.length(turn) - len(opener) - len(closer))

    user, assistant = turn.startswith("[INST]"), turn.startswith("<s>")
    system = between("<<SYS>>", "<</SYS>>")
    head = F.locate("\n", system)
    role = F.when(user, F.lit("user")).when(assistant, F.lit("assistant"))
    role = role.otherwise(F.url_decode(F.substring_index(system, "\n", 1)))
    text = F.when(user, between("[INST]", "[/INST]")).when(assistant, between("<s>", "</s>"))
    text = text.otherwise(F.when(head > 0, F.substring(system, head + 1, F.length(system))))
    return F.struct(role.alias("role"), F.when(~text.rlike(CONTROL), unescape(text)).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation. Null if there is anything but turns, each closed as it
    was opened; text is null in a turn that holds what the grammar forbids."""
    turns = F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), _parse_turn)
    return F.when(F.regexp_replace(formatted, TURN, "") == "", turns)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, escaped (boolean), turns (the source: turn, role, text).

    Turns are gathered in each task before the shuffle; a conversation's are then one value, which
    is rendered, parsed and compared as a whole.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    source = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    raw = F.array_join(F.transform("turns", lambda t: render_turn(t["role"], t["text"])), "")
    safe = F.array_join(F.transform("turns", lambda t: render_turn(t["role"], escape(t["text"]))), "")
    tried = gathered.withColumn("formatted", raw)
    tried = tried.withColumn("escaped", ~parse(F.col("formatted")).eqNullSafe(source))
    return tried.withColumn("formatted", F.when(F.col("escaped"), safe).otherwise(F.col("formatted")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the parser recovers from the column formatted.

    loss_* is about the texts under the loss mask: those of assistant turns.
    """
    parsed = formatted.withColumn("parsed", parse(F.col("formatted")))
    spoken = F.filter("parsed", lambda t: t["role"] == "assistant")
    loss = F.array_join(F.transform(spoken, lambda t: t["text"]), "")
    listed = F.transform(
        "parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return parsed.withColumn("loss", loss).select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped",
    )
