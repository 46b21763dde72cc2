r"""Chat formatting by grammar round trip.

A conversation is rendered as turns ``### Assistant: text</turn>``, each with a line end.  A deterministic parser reads it back: it cuts
at ``</turn>`` + line end, asks for exactly one turn mark, in front, and no further control string, and takes one backslash out of
every mark that holds some.  Each rendered turn is parsed again and compared with its source; where they differ, the text's marks
are escaped, kind by kind, until they are identical.  Escaping puts one more backslash into a mark (``<\/turn>``, ``###\ User: ``),
behind any that are there: what was escaped can be told from what looked so already, and no control string is left.

A turn that parses alone parses within its conversation too: the first ``</turn>`` and line end behind a turn's begin is its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import let
from tickloom.session import written

#: The template.  Roles without a name of their own are written behind ``@``, percent-encoded.
HEAD, COLON, END = "### ", ": ", "</turn>\n"
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
OTHER = "@"
#: Turns of this role are learned from.
LEARNED = "assistant"

_NAME = r"(?:System|User|Assistant|@[A-Za-z0-9.*_%+-]*)"
#: What a text must not hold, as (begin, end) between which backslashes are put.
MARKS = {"end": ("<", "/turn>"), "head": ("###", f" {_NAME}: ")}


def escape(text: Column, kind: str) -> Column:
    """One more backslash in every mark of a kind."""
    begin, end = MARKS[kind]
    return F.regexp_replace(text, F.lit(rf"({begin}\\*)(?={end})"), F.lit(r"$1\\"))


def unescape(text: Column) -> Column:
    """One backslash less in every mark that holds one."""
    for begin, end in MARKS.values():
        text = F.regexp_replace(text, F.lit(rf"({begin}\\*)\\(?={end})"), F.lit("$1"))
    return text


def render_head(role: Column) -> Column:
    name = F.concat(F.lit(OTHER), F.url_encode(role))
    for known, shown in NAMES.items():
        name = F.when(role == known, shown).otherwise(name)
    return F.concat(F.lit(HEAD), name, F.lit(COLON))


def _role(name: Column) -> Column:
    role = F.url_decode(F.when(name.startswith(OTHER), F.substring(name, 2, 1 << 30)).otherwise(""))
    for known, shown in NAMES.items():
        role = F.when(name == shown, known).otherwise(role)
    return role


def parse(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation; null where the grammar does not hold."""

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, rf"\A### ({_NAME}): ", 1)
        body = F.substr(piece, F.char_length(name) + (len(HEAD) + len(COLON) + 1))
        strict = (name != "") & ~body.rlike("|".join(rf"{begin}{end}" for begin, end in MARKS.values()))
        return F.when(strict, F.struct(_role(name).alias("role"), unescape(body).alias("text")))

    def turns(pieces: Column) -> Column:
        found = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)
        return F.when((F.element_at(pieces, -1) == "") & ~F.exists(found, lambda x: x.isNull()), found)

    return let(F.split(formatted, END, -1), turns)


def round_trip(role: Column, text: Column) -> Column:
    """The text as it is rendered: escaped, kind by kind, as long as the parser does not give back the source."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))

    def checked(kind: str):
        return lambda body: F.when(parse(F.concat(render_head(role), body, F.lit(END))).eqNullSafe(source), body).otherwise(escape(body, kind))

    body = text
    for kind in MARKS:
        body = let(body, checked(kind))
    return body


def format_chats(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learned: str = LEARNED,
) -> DataFrame:
    """``id, formatted, mask``: a row per conversation.  ``mask`` holds ``(start, end)`` in code points (end exclusive) of the learned
    role's texts within ``formatted``, in order.

    Turns are in the order of ``turn`` (null first), then role, then text; rows that agree on all of these are turns of their own.
    Null texts and roles count as empty; rows without an id form one conversation.  Only the named columns are read.  An empty
    table gives no rows.
    """
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("body", round_trip(F.col("role"), F.col("text"))).withColumn("head", render_head(F.col("role")))
    upto = Window.partitionBy("id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)  # the turns of one text
    size = F.char_length("head") + F.char_length("body") + len(END)
    placed = rows.withColumn("end", F.sum(size).over(upto))  # ends differ: every turn has marks
    gathered = placed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("end", "role", "head", "body"))).alias("turns"))
    last = F.lit(len(END))
    mask = F.transform(
        F.filter("turns", lambda x: x["role"] == learned),
        lambda x: F.struct((x["end"] - last - F.char_length(x["body"])).alias("start"), (x["end"] - last).alias("end")))
    return gathered.select("id", F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"), mask.alias("mask"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``id, formatted, turns, learned``: the turns as the parser finds them, and each masked text, unescaped."""
    masked = F.transform("mask", lambda m: unescape(F.substr("formatted", (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    return formatted.select("id", "formatted", parse(F.col("formatted")).alias("turns"), masked.alias("learned"))


def digest_chats(turns: DataFrame, **columns: str) -> DataFrame:
    """Formats, writes, reads back and digests: ``id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    read = read_chats(written(format_chats(turns, **columns), "chats"))
    loss = F.array_join("learned", "")
    listed = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))
