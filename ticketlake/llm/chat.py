r"""Chat formatting with a grammar that reads its own output back.

A conversation is rendered as its turns in order, a turn as

    ### role:
    text</turn>

and a line end.  ``parsed`` is the grammar read the other way, without any
choice: a text is cut at every ``</turn>``, a turn begins with ``### `` and holds
it nowhere else, and its role ends at the first colon with a line end.  Whatever
stands between is unescaped: one backslash is taken out of ``<\/turn>``,
``#\## ``, and in a role out of ``:\`` with a line end, longer runs of
backslashes likewise.

Every turn is rendered as it is and read back.  Where the grammar does not give
the same role and text, one kind of control string after the other (``RULES``)
gets a backslash after its first character, and the turn is read again, until
it is identical.  Escaping all kinds always is: no control string is left, and
taking out one backslash undoes putting one in.  A turn that reads back alone
also does within a conversation, because the grammar cuts at ends of turns
only; ``identical`` says that the whole text gave back the turns it was made
from, compared by hash.

All work on a turn happens where its row lies.  Only rendered turns are
shuffled, once; loss positions are running sums in that order.  The result has
one row per conversation, so a conversation must fit into one row.

Defined results: a null text or role counts as empty.  Rows of null ids are one
conversation.  Turns are ordered by ``turn``, null first, equal ones by their
rendered form; repeated rows are turns of their own.  An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.common import col, text_of

BEGIN, SEP, END = "### ", ":\n", "</turn>"
#: control strings as (first character, rest), in the order in which they are escaped; the last concerns roles only
RULES = [("<", "/turn>"), ("#", "## "), (":", "\n")]


def _escaped(value: Column, rule: tuple[str, str]) -> Column:
    first, rest = rule
    return F.regexp_replace(value, rf"{first}(\\*){rest}", rf"{first}\\$1{rest}")


def _unescaped(value: Column, rules: list[tuple[str, str]]) -> Column:
    for first, rest in rules:
        value = F.regexp_replace(value, rf"{first}\\(\\*){rest}", rf"{first}$1{rest}")
    return value


def rendered(role: Column, text: Column) -> Column:
    """One turn, escaped already."""
    return F.concat(F.lit(BEGIN), role, F.lit(SEP), text, F.lit(END + "\n"))


def parsed(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted text; a part that is no turn gives a null element."""
    pieces = F.split(formatted, END, -1)

    def turn(piece: Column, at: Column) -> Column:
        # the line end after an end of turn belongs to that turn
        body = F.when(at > 0, F.when(piece.startswith("\n"), F.substring(piece, 2, 2**31 - 1))).otherwise(piece)
        rest = F.when(body.startswith(BEGIN), F.substring(body, len(BEGIN) + 1, 2**31 - 1))
        role = F.substring_index(rest, SEP, 1)
        text = F.substring(rest, F.length(role) + 1 + len(SEP), F.lit(2**31 - 1))
        made = F.struct(_unescaped(role, RULES).alias("role"), _unescaped(text, RULES[:2]).alias("text"))
        return F.when(rest.contains(SEP) & ~rest.contains(BEGIN), made)

    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
    # what follows the last end of turn is its line end and nothing else
    return F.when(F.element_at(pieces, -1) == "\n", turns)


def _turn_key(role: Column, text: Column) -> Column:
    return F.xxhash64(role, text)


def rendered_turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """id, turn, role, segment (the rendered turn), source (hash of role and text): escaped until it reads back."""
    rows = df.select(
        col(id_col).alias("id"), col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")
    ).withColumns({"own_role": F.col("role"), "own_text": F.col("text")})
    source = F.array(F.struct("role", "text"))
    same = source.eqNullSafe(parsed(rendered(F.col("own_role"), F.col("own_text"))))
    for rule in RULES:
        rows = rows.withColumn("same", same)
        escaped = {"own_role": _escaped(F.col("own_role"), rule)}
        if rule != RULES[-1]:
            escaped["own_text"] = _escaped(F.col("own_text"), rule)
        rows = rows.withColumns({c: F.when(F.col("same"), F.col(c)).otherwise(e) for c, e in escaped.items()})
    return rows.select(
        "id", "turn", "role", rendered(F.col("own_role"), F.col("own_text")).alias("segment"),
        _turn_key(F.col("role"), F.col("text")).alias("source"),
    )


def format_conversations(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans, identical.

    ``loss_spans`` are the places (start, end) of the escaped texts of ``loss_role``
    in ``formatted``, in code points, end exclusive.
    """
    turns = rendered_turns(df, id_col, turn_col, role_col, text_col)
    order = Window.partitionBy("id").orderBy(F.asc_nulls_first("turn"), "segment")
    size = F.length("segment")
    placed = turns.withColumns(
        {"place": F.row_number().over(order), "end": F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))}
    )
    end = F.col("end") - len(END) - 1
    # the first colon with a line end closes the header
    begin = F.col("end") - size + F.locate(SEP, "segment") - 1 + len(SEP)
    span = F.when(F.col("role") == loss_role, F.struct(begin.alias("start"), end.alias("end")))
    listed = F.array_sort(F.collect_list(F.struct("place", "segment", span.alias("span"), "source")))
    joined = placed.groupBy("id").agg(listed.alias("parts"))
    formatted = F.array_join(F.col("parts.segment"), "")
    out = joined.select(
        F.col("id"),
        formatted.alias("formatted"),
        F.filter("parts.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.col("parts.source").alias("sources"),
    )
    read = F.transform(parsed(F.col("formatted")), lambda t: _turn_key(t["role"], t["text"]))
    return out.select(
        F.col("id").alias(id_col), "formatted", "loss_spans", read.eqNullSafe(F.col("sources")).alias("identical")
    )


def unmasked(formatted: Column, spans: Column) -> Column:
    """The texts under a loss mask, unescaped, in order."""
    return F.transform(
        spans,
        lambda s: _unescaped(
            F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), RULES[:2]
        ),
    )


def read_back(formatted: DataFrame, id_col: str = "conv_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, turns (array of role and text) and loss_texts, from the formatted text and its mask alone."""
    return formatted.select(
        col(id_col),
        *keep,
        parsed(F.col("formatted")).alias("turns"),
        unmasked(F.col("formatted"), F.col("loss_spans")).alias("loss_texts"),
    )
