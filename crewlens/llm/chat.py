"""Chat formatting: typed content parts flattened into one training text per conversation.

A message holds a list of typed parts. Each part is visited by its type: a text part gives its
escaped text, an image, audio or document part gives a numbered placeholder, an attachment record
and the count of tokens it expands to in a model. The template of a turn is

    ### <role>: <content> </turn>\\n

Control strings never occur inside the content: a backslash is doubled, `#` becomes `\\#`, and
`</turn>` and `<|` get a backslash after their `<`. Taking every `\\x` for `x` undoes all of it. A
role is escaped alike, and its `:` is written `\\c`. The loss mask is given as spans of the
formatted text, counted from the start of their turn: the content of each assistant turn.

Only built-in functions are used. Parts are rendered row by row before turns meet, so a shuffle
moves finished pieces, and a conversation meets in one row only because it is one output value.

Defined cases: a null or empty text or role counts as empty; null or unknown parts give nothing;
rows without a conversation id form one conversation with a null id; turns with equal numbers are
ordered by role, then content, null turns come first; repeated rows are repeated turns; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template, and tokens per unit of each attachment type.
TURN_START = "### "
ROLE_END = ": "
TURN_END = " </turn>\n"
ASSISTANT = "assistant"
PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 400

PART_TYPE = (
    "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
)


def text_messages(conversations: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as messages of one text part."""
    part = F.struct(
        F.lit("text").alias("type"), F.col("text").alias("text"),
        F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    ).cast(PART_TYPE)
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def escape(text: Column) -> Column:
    doubled = F.replace(_or_empty(text), F.lit("\\"), F.lit("\\\\"))
    hashes = F.replace(doubled, F.lit("#"), F.lit("\\#"))
    ends = F.replace(hashes, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(ends, F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def unescape_role(role: Column) -> Column:
    """A doubled backslash may stand before a plain c, so both escapes are read in one pass."""
    halves = F.split(role, r"\\\\", -1)
    return unescape(F.array_join(F.transform(
        halves, lambda x: F.replace(x, F.lit("\\c"), F.lit(":"))), "\\\\"))


def _tokens(part: Column) -> Column:
    side = lambda x: F.ceil(F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)) / F.lit(PATCH))
    return (
        F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["type"] == "audio",
              F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document",
              F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)) * DOCUMENT_TOKENS_PER_PAGE)
        .otherwise(0).cast("bigint")
    )


def _visit(part: Column, place: Column) -> Column:
    """The rendered form of one part."""
    return (
        F.when(part["type"] == "text", escape(part["text"]))
        .when(part["type"].isin("image", "audio", "document"),
              F.concat(F.lit("<|"), part["type"], F.lit(":"), (place + 1).cast("string"), F.lit("|>")))
        .otherwise("")
    )


def _attachment(part: Column, place: Column) -> Column:
    return F.when(
        part["type"].isin("image", "audio", "document"),
        F.struct((place + 1).alias("part"), part["type"].alias("type"), part["uri"].alias("uri"),
                 _tokens(part).alias("tokens")),
    )


def format_chat(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (length of each piece, and its loss span if it has one),
    attachments in order with the turn they belong to, expanded_tokens."""
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>"))
    rendered = messages.select(
        "conv_id", "turn", escape_role(F.col("role")).alias("role"),
        F.array_join(F.transform(parts, _visit), "").alias("content"),
        F.filter(F.transform(parts, _attachment), lambda x: x.isNotNull()).alias("attached"),
    )
    turn = F.struct(
        "turn", "role", "content", "attached",
        F.concat(F.lit(TURN_START), F.col("role"), F.lit(ROLE_END), F.col("content"), F.lit(TURN_END)).alias("piece"),
    )
    whole = rendered.groupBy("conv_id").agg(F.collect_list(turn).alias("t"))
    ordered = whole.select("conv_id", F.sort_array("t").alias("t"))
    return ordered.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("t", lambda t: F.struct(
            F.length(t["piece"]).cast("bigint").alias("length"),
            F.when(t["role"] == ASSISTANT, F.struct(
                F.length(F.concat(F.lit(TURN_START), t["role"], F.lit(ROLE_END))).cast("bigint").alias("start"),
                F.length(t["content"]).cast("bigint").alias("length"),
            )).alias("loss"),
        )).alias("turns"),
        F.flatten(F.transform("t", lambda t: F.transform(t["attached"], lambda a: F.struct(
            t["turn"].alias("turn"), a["part"].alias("part"), a["type"].alias("type"),
            a["uri"].alias("uri"), a["tokens"].alias("tokens"))))).alias("attachments"),
    ).select("*", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def read_back(chats: DataFrame) -> DataFrame:
    """What the formatted text and its mask say, without a look at the input: the turns are found by
    the template's marks, the loss text by the mask, and both are unescaped."""
    pieces = F.split("formatted", TURN_END, -1)
    cut = chats.select("conv_id", "formatted", "turns", F.slice(pieces, 1, F.size(pieces) - 1).alias("pieces"))

    def turn(piece: Column) -> Column:
        end = F.locate(ROLE_END, piece)
        role = F.substring(piece, F.lit(len(TURN_START) + 1), end - len(TURN_START) - 1)
        text = F.substring(piece, end + len(ROLE_END), F.length(piece))
        return F.concat(unescape_role(role), F.lit("\n"), unescape(text), F.lit("\n"))

    # The mask of a turn counts from the start of its piece.
    masked = F.transform(
        F.filter(F.arrays_zip(F.col("pieces").alias("piece"), F.col("turns").alias("turn")),
                 lambda z: z["turn"]["loss"].isNotNull()),
        lambda z: unescape(F.substring(z["piece"], (z["turn"]["loss"]["start"] + 1).cast("int"),
                                       z["turn"]["loss"]["length"].cast("int"))),
    )
    found = cut.select(
        "conv_id", F.size("pieces").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("pieces", turn), "").alias("_turns"),
        F.array_join(masked, "").alias("_loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return found.select(
        "conv_id", "n_turns", F.sha2("_turns", 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
