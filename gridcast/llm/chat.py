r"""Chat formatting: typed content parts, one string per conversation, and a loss mask.

A turn's content is a list of typed parts.  A visitor with one case per kind flattens them: text is escaped, an image,
audio or document part becomes a placeholder, and its reference, its order in the conversation and the tokens that it
stands for are recorded.  A conversation is

    <s>[INST]role[/INST]body</s>[INST]role[/INST]body</s>...

Control strings inside texts and roles are broken up by a backslash code: a backslash becomes ``\s``, the ``<`` or
``[`` that opens a control string (or that could open one together with the next part) becomes ``\l`` or ``\b``.
Every backslash then starts a code, so decoding is exact, and no body holds a control string.

The mask is a list of runs (characters, loss): opening, then header, body and end of each turn; bodies of the
assistant bear the loss.  One string holds one conversation, so its rows meet in one task; that is the result's form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
LEARNED = "assistant"
#: Content of a turn: kind (text, image, audio, document), text, reference, and units (tiles, seconds, pages).
PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"


@dataclass(frozen=True)
class Kind:
    """How the visitor treats an attachment: its placeholder and the tokens that one unit stands for."""

    name: str
    per_unit: float

    @property
    def mark(self) -> str:
        return f"<|{self.name}|>"


#: Tokens per image tile, second of audio and page of a document; any other kind counts as a file of one token.
KINDS = (Kind("image", 256.0), Kind("audio", 25.0), Kind("document", 512.0))
FILE = Kind("file", 1.0)


def escaped(text: Column) -> Column:
    """Text without control strings, also at a seam with the next part; null becomes empty."""
    coded = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\s"))
    coded = F.regexp_replace(coded, r"<(?=/?s>|\||/?s?\z)", r"\\l")
    return F.regexp_replace(coded, r"\[(?=/?INST\]|/?(?:I(?:N(?:ST?)?)?)?\z)", r"\\b")


def unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.replace(plain, F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """The content of a turn that is plain text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def _visit(part: Column, text, attachment) -> Column:
    """One part by its kind: ``text(part)``, or ``attachment(part, kind)``; a part without kind is text."""
    chosen = F.when(F.coalesce(part["kind"], F.lit("text")) == "text", text(part))
    for kind in KINDS:
        chosen = chosen.when(part["kind"] == kind.name, attachment(part, kind))
    return chosen.otherwise(attachment(part, FILE))


def flattened(content: Column) -> Column:
    """The body of a turn: escaped texts and placeholders in order; null content is empty."""
    parts = F.coalesce(content, F.array().cast(PARTS))
    return F.array_join(F.transform(parts, lambda p: _visit(p, lambda x: escaped(x["text"]), lambda x, k: F.lit(k.mark))), "")


def _attached(content: Column, turn: Column) -> Column:
    """Structs (kind, ref, turn, tokens) of a turn's attachments, in order."""
    kind = "struct<kind:string,ref:string,turn:bigint,tokens:bigint>"

    def record(part: Column, k: Kind) -> Column:
        tokens = F.ceil(F.coalesce(part["units"], F.lit(1.0)) * k.per_unit).cast("long")
        return F.struct(F.lit(k.name).alias("kind"), part["ref"].alias("ref"), turn.cast("long").alias("turn"), tokens.alias("tokens"))

    parts = F.coalesce(content, F.array().cast(PARTS))
    return F.array_compact(F.transform(parts, lambda p: _visit(p, lambda x: F.lit(None).cast(kind), record)))


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "content") -> DataFrame:
    """(key, formatted, mask, attachments) of every conversation.

    ``content`` holds typed parts (``PARTS``).  Turns come in the order of their number, ties by role and body, nulls
    first; a repeated row is a turn again.  A null role or text is empty; rows with a null key form one conversation.
    ``attachments`` lists (ordinal, kind, ref, turn, tokens); the placeholders stand in the same order.
    An empty table gives an empty one; further columns are not read.
    """
    rows = turns.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        flattened(F.col(content)).alias("body"), _attached(F.col(content), F.col(turn)).alias("attached"))
    whole = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "body", "attached"))).alias("turns"))

    def header(t: Column) -> Column:
        return F.concat(F.lit(HEAD), escaped(t["role"]), F.lit(BODY))

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))

    def runs(t: Column) -> Column:
        return F.array(run(F.char_length(header(t)), F.lit(False)),
                       run(F.char_length(t["body"]), t["role"] == LEARNED), run(F.lit(len(END)), F.lit(False)))

    text = F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: F.concat(header(t), t["body"], F.lit(END))), ""))
    mask = F.concat(F.array(run(F.lit(len(BEGIN)), F.lit(False))), F.flatten(F.transform("turns", runs)))
    attachments = F.transform(F.flatten(F.transform("turns", lambda t: t["attached"])), lambda a, i: F.struct(
        i.alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["turn"].alias("turn"), a["tokens"].alias("tokens")))
    return whole.select(F.col("key").alias(key), text.alias("formatted"), mask.alias("mask"), attachments.alias("attachments"))


def read_back(formatted: Column) -> Column:
    """Array of (role, body) from a formatted conversation; bodies are still escaped."""
    pieces = F.split(F.substring(formatted, len(BEGIN) + len(HEAD) + 1, 2147483647), END)

    def turn(piece: Column, i: Column) -> Column:
        after = F.when(i == 0, piece).otherwise(F.substring(piece, len(HEAD) + 1, 2147483647))
        name = F.substring_index(after, BODY, 1)
        body = F.substr(after, F.char_length(name) + len(BODY) + 1)
        return F.struct(unescaped(name).alias("role"), body.alias("body"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def plain_text(body: Column) -> Column:
    """The text of a body: without placeholders, unescaped."""
    return unescaped(F.regexp_replace(body, r"<\|[a-z]+\|>", ""))


def digest(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """Digests of what ``format_chats`` gave, read back from the formatted string and the mask."""
    turns = chats.select(key, "formatted", "mask", read_back(F.col("formatted")).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), plain_text(t["body"]), F.lit("\n")))

    def learned(t: Column, i: Column) -> Column:
        own = F.get(F.col("mask"), i * 3 + 2)  # after the opening: header, body, end of each turn
        return F.when(own["loss"], plain_text(F.substr(t["body"], F.lit(1), own["chars"]))).otherwise(F.lit(""))

    read = turns.select(key, "formatted", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join(said, "").alias("said"), F.array_join(F.transform("turns", learned), "").alias("loss"))
    return read.select(key, "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def digest_sql(rows: str) -> str:
    """The same digests for DuckDB straight from ``rows``, a query for (conv_id, turn, role, text)."""
    def codes(column: str) -> str:
        return (f"length({column}) - length(replace({column}, '\\', '')) + "
                f"len(regexp_extract_all({column}, '</?s>|<\\||\\[/?INST\\]')) + "
                f"len(regexp_extract_all({column}, '(?:</?s?|\\[/?(?:I(?:N(?:ST?)?)?)?)$'))")
    fixed = len(HEAD) + len(BODY) + len(END)
    return f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({rows})),
sized AS (SELECT *, {fixed} + length(role) + {codes('role')} + length(text) + {codes('text')} AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
  CAST({len(BEGIN)} + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
