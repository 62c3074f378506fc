"""Conversations with typed content parts as one formatted text each, by built-in expressions only.

A turn's content is an array of parts. The visitor turns every part into leaves: text becomes escaped
text, an image, an audio clip or a document becomes one placeholder in its place, and the parts
inside a document follow its placeholder in order. Each placeholder records an attachment: its
position, reference, and the number of tokens that a model puts there.

A conversation reads ``<s>[INST]role[/INST]content</s>[INST]role[/INST]content</s>…``. Inside roles
and texts the first character of every control string is replaced, and so is the escape character:
a formatted text holds a control string only where the template put it, and ``unescape`` restores
every text.

Turns are formatted where they are read; one shuffle brings a conversation's turns together, for the
running position and the final text alike. A conversation's formatted text is one value, so a
single one of more than 2 GB fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.common import text_of

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {kind: f"<{kind}>" for kind in ("image", "audio", "document")}
ESCAPE = "\\"

_LEAF = "kind string, text string, ref string, width bigint, height bigint, millis bigint, pages bigint"
#: The type of one content part; ``parts`` are those inside a document.
PART = f"{_LEAF}, parts array<struct<{_LEAF}>>"


@dataclass(frozen=True)
class Expansion:
    """Tokens of an attachment: a token per ``patch`` x ``patch`` pixels, per ``millis`` of audio and
    ``page`` tokens for a page; unknown sizes count as one patch, one step, one page."""

    patch: int = 28
    millis: int = 40
    page: int = 256

    def tokens(self, part: Column) -> Column:
        def steps(field: str, size: int) -> Column:
            known = F.coalesce(part[field], F.lit(size))
            return F.call_function("div", known + (size - 1), F.lit(size).cast("bigint"))

        image = steps("width", self.patch) * steps("height", self.patch)
        pages = F.coalesce(part["pages"], F.lit(1)) * self.page
        return (
            F.when(part["kind"] == "image", image)
            .when(part["kind"] == "audio", steps("millis", self.millis))
            .when(part["kind"] == "document", pages)
            .otherwise(F.lit(0))
            .cast("bigint")
        )


def escape(text: Column) -> Column:
    """The text without any control string, reversibly."""
    names = "|".join(("/?s", *PLACEHOLDERS))
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    text = F.regexp_replace(text, f"<(?=(?:{names})>)", r"\\1")
    return F.regexp_replace(text, r"\[(?=/?INST\])", r"\\2")


def unescape(text: Column) -> Column:
    for code, char in (("1", "<"), ("2", "["), ("0", ESCAPE)):
        text = F.replace(text, F.lit(ESCAPE + code), F.lit(char))
    return text


# -- the visitor -------------------------------------------------------------------------------
def _leaf(part: Column, rule: Expansion) -> Column:
    """A part without those inside it: what stands in the text, and what is attached."""
    kind = F.coalesce(part["kind"], F.lit("text"))
    shown = F.when(kind == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for name, placeholder in PLACEHOLDERS.items():
        shown = shown.when(kind == name, F.lit(placeholder))
    unknown = F.raise_error(F.concat(F.lit("no such kind of content part: "), kind))
    return F.struct(
        kind.alias("kind"),
        shown.otherwise(unknown.cast("string")).alias("shown"),
        part["ref"].alias("ref"),
        rule.tokens(part).alias("tokens"),
    )


def visit(parts: Column, rule: Expansion) -> Column:
    """The leaves of an array of parts in reading order; null parts have none."""
    given = F.filter(F.coalesce(parts, F.array()), lambda p: p.isNotNull())

    def one(part: Column) -> Column:
        inside = F.filter(F.coalesce(part["parts"], F.array()), lambda p: p.isNotNull())
        return F.concat(F.array(_leaf(part, rule)), F.transform(inside, lambda p: _leaf(p, rule)))

    return F.flatten(F.transform(given, one))


def text_parts(text: Column) -> Column:
    """A plain text as the one part of a turn."""
    fields = [F.coalesce(text, F.lit("")).alias("text") if f == "text" else
              F.lit("text").alias(f) if f == "kind" else F.lit(None).cast(t).alias(f)
              for f, t in (x.split() for x in _LEAF.split(", "))]
    inner = F.lit(None).cast(f"array<struct<{_LEAF}>>").alias("parts")
    return F.array(F.struct(*fields, inner))


# -- formatting --------------------------------------------------------------------------------
def formatted(
    turns: DataFrame,
    parts_col: str = "parts",
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    learnt: str = "assistant",
    rule: Expansion = Expansion(),
) -> DataFrame:
    """One row per conversation: id, formatted, loss, attachments, n_tokens_attached.

    ``loss`` lists (start, length) of the contents of ``learnt`` turns and ``attachments`` (start,
    kind, ref, tokens), in code points of ``formatted`` and in order. Turns are ordered by number,
    nulls first, ties by role, then formatted turn; rows that repeat are turns of their own. Null
    roles, contents and texts are empty, rows with a null id form one conversation. Other columns
    are ignored; an empty table gives no rows.
    """
    role = text_of(role_col)
    leaves = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        visit(F.col(parts_col), rule).alias("leaves"),
    )
    content = F.array_join(F.transform("leaves", lambda x: x["shown"]), "")
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE))
    # Where a leaf begins inside the content: the lengths of those before it, only if any is attached.
    attached = F.filter(
        F.transform(
            "leaves",
            lambda x, i: F.struct(
                F.aggregate(
                    F.slice("leaves", F.lit(1), i), F.lit(0), lambda n, y: n + F.length(y["shown"])
                ).alias("start"),
                x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens"),
            ),
        ),
        lambda x: x["kind"] != "text",
    )
    has_attachment = F.exists("leaves", lambda x: x["kind"] != "text")
    pieces = leaves.select(
        "id", "turn", "role", head.alias("head"), content.alias("content"),
        F.when(has_attachment, attached).alias("attached"),
    ).select(
        "id", "turn", "role", "attached",
        F.concat("head", "content", F.lit(END)).alias("piece"),
        F.length("head").alias("head_chars"),
        F.length("content").alias("chars"),
    )
    order = Window.partitionBy("id").orderBy("turn", "role", "piece")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(earlier), F.lit(0))
    begin = before + F.col("head_chars") + len(BEGIN)
    placed = pieces.select("id", "attached", "piece", "role", before.alias("at"), begin.alias("begin"), "chars")
    mine = F.when(F.col("role") == learnt, F.struct(F.col("begin").alias("start"), F.col("chars").cast("bigint").alias("length")))
    moved = F.transform(
        "attached",
        lambda x: F.struct(
            (x["start"] + F.col("begin")).alias("start"),
            x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens"),
        ),
    )
    whole = placed.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(mine)).alias("loss"),
        F.sort_array(F.flatten(F.collect_list(moved))).alias("attachments"),
    )
    text = F.concat(F.lit(BEGIN), F.array_join(F.transform("pieces", lambda x: x["piece"]), ""))
    tokens = F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, x: n + x["tokens"])
    return whole.select(
        F.col("id").alias(id_col),
        text.alias("formatted"),
        "loss",
        "attachments",
        tokens.alias("n_tokens_attached"),
    )


# -- reading back ------------------------------------------------------------------------------
def _spoken(content: Column) -> Column:
    """The text of a formatted content: placeholders taken out, escapes undone."""
    return unescape(F.regexp_replace(content, "|".join(PLACEHOLDERS.values()), ""))


def turns_of(text: Column) -> Column:
    """array of (role, text, kinds of placeholders) as a formatted text states them."""
    pieces = F.split(F.substr(text, F.lit(len(BEGIN) + 1)), END)
    real = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last end nothing follows

    def read(piece: Column) -> Column:
        halves = F.split(piece, r"\[/INST\]", 2)
        content = F.get(halves, F.lit(1))
        kinds = F.regexp_extract_all(content, F.lit(f"<({'|'.join(PLACEHOLDERS)})>"), F.lit(1))
        role = F.substr(F.get(halves, F.lit(0)), F.lit(len(OPEN) + 1))
        return F.struct(unescape(role).alias("role"), _spoken(content).alias("text"), kinds.alias("kinds"))

    return F.transform(real, read)


def learnt_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, in order, nothing between."""
    def under(span: Column) -> Column:
        start = (span["start"] + 1).cast("int")
        return _spoken(F.substr(text, start, span["length"].cast("int")))

    return F.array_join(F.transform(loss, under), "")


def chat_digests(turns: DataFrame) -> DataFrame:
    """Formats (conv_id, turn, role, text) and returns what reading the result back gives."""
    parts = turns.select("conv_id", "turn", "role", text_parts(F.col("text").cast("string")).alias("parts"))
    read = formatted(parts).select(
        "conv_id",
        turns_of(F.col("formatted")).alias("turns"),
        learnt_text(F.col("formatted"), F.col("loss")).alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_attachments",
    )


def with_rows(turns: DataFrame, rows: list[tuple]) -> DataFrame:
    """``turns`` with a few stated rows (conv_id, turn, role, text) after them."""
    names = ("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    stated = [F.struct(*(F.lit(x).cast(kinds[n]).alias(n) for n, x in zip(names, row))) for row in rows]
    more = turns.sparkSession.range(1).select(F.inline(F.array(*stated)))
    return reduce(DataFrame.unionByName, [turns.select(*names), more])
