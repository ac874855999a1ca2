"""Conversations as one string with turn marks, loss mask and attachments, and back.

A message has typed content parts. Text parts are written escaped, image, audio
and document parts as a placeholder each; the attachments they stand for are
listed in the same order with the tokens they will expand to. Control strings
inside a text get a backslash behind their first character, one more if they
have some already, so the text can be restored exactly and no text can forge a
mark. Everything is DataFrame functions.

Rows of a conversation are ordered by turn (null first), ties by role, text,
order of the parts and attachments. Null roles and texts are empty. A null
conversation id is a conversation. Repeated rows are turns of their own; other
columns are not looked at. A conversation becomes one row, so it has to fit a
string; texts may be as long as that. No messages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, BODY, END = "<|start|>", "<|message|>", "<|end|>"
#: Placeholder and tokens for each unit (image tile, second of audio, page) of the parts that aren't text.
ATTACHMENTS = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 25), "document": ("<|document|>", 512)}
#: What may follow the first character, < or [, of a control string: own marks and those common in chat templates.
_REST = r"(\|(?:start|message|end|image|audio|document)\|>|/?s>|/?INST\]|</?SYS>>)"

PART = "struct<type string, text string, ref string, units long>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, r"$1$2$3")


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*ATTACHMENTS), F.lit(False))


def flatten(parts: Column) -> Column:
    """The parts of a message in order: texts escaped, the others as placeholders. Unknown types count as text."""
    def visit(part: Column) -> Column:
        found = F.when(~_is_attachment(part), F.coalesce(escape(part["text"]), F.lit("")))
        for kind, (mark, _) in ATTACHMENTS.items():
            found = found.when(part["type"] == kind, F.lit(mark))
        return found

    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), visit), "")


def plain(parts: Column) -> Column:
    """The text of a message without its attachments, as it was given."""
    texts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda part: ~_is_attachment(part))
    return F.array_join(F.transform(texts, lambda part: F.coalesce(part["text"], F.lit(""))), "")


def attachments(parts: Column) -> Column:
    """(kind, ref, tokens) of the placeholders of a message, in order."""
    def describe(part: Column) -> Column:
        cost = F.create_map(*[F.lit(x) for kind, (_, n) in ATTACHMENTS.items() for x in (kind, n)])
        tokens = F.coalesce(part["units"], F.lit(1)) * F.get(F.map_values(F.map_filter(cost, lambda k, _: k == part["type"])), F.lit(0))
        return F.struct(part["type"].alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))

    return F.transform(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), _is_attachment), describe)


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask, attachments) of messages (conv_id, turn, role, parts).

    ``loss_mask`` lists the spans (start, length), in code points, that the loss
    counts: the bodies of the assistant's turns.
    """
    role = F.coalesce("role", F.lit(""))
    turns = messages.select(
        "conv_id", "turn", role.alias("role"), plain(F.col("parts")).alias("plain"), flatten(F.col("parts")).alias("body"),
        attachments(F.col("parts")).alias("own"),
    ).withColumn("head", F.concat(F.lit(START), escape(F.col("role")), F.lit(BODY)))
    turns = turns.withColumn("size", F.char_length("head") + F.char_length("body") + len(END))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "plain", "body", "own").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "head", "body", "role", "own"))).alias("turns"),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["role"] == "assistant"),
            lambda t: F.struct((t["at"] + F.char_length(t["head"])).cast("int").alias("start"), F.char_length(t["body"]).alias("length")),
        ).alias("loss_mask"),
        F.flatten(F.transform("turns", lambda t: t["own"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """(role, text) of every turn, read back from a formatted conversation."""
    def turn(text: Column) -> Column:
        fields = F.split(text, r"<\|message\|>|<\|end\|>")
        return F.struct(unescape(F.get(fields, F.lit(0))).alias("role"), unescape(F.get(fields, F.lit(1))).alias("text"))

    return F.transform(F.slice(F.split(formatted, r"<\|start\|>"), 2, 1 << 30), turn)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss_mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def digest_chats(messages: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations, as digests."""
    chats = format_chats(messages)
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumn("turns", turns).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_mask"))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        F.coalesce(F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]), F.lit(0)).alias("attachment_tokens"),
    )
