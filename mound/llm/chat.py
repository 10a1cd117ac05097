"""Chat formatting with a grammar round trip (DataFrame functions only).

Grammar of the rendered text of a conversation:

    conversation := turn*
    turn         := "<|im_start|>" content "<|im_sep|>" content "<|im_end|>"
    content      := any text without a control string

The first content is the role, the second the text.  A control string is one
of the three marks or ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``.  In content,
a control string is written with one more ``~`` after its first character
(``<~|im_end|>``), and so is one that already has some; reading takes one away.
That is a bijection between all texts and the texts without control strings.

``format_conversations`` first renders every conversation as it is, reparses
it, and compares the recovered turns with the source.  Only conversations
that do not come back, or whose content holds a control string, are rendered
again with their content escaped, and reparsed and compared again; a
conversation that still differed would have ``round_trip`` false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.llm.columns import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_TAIL = r"(\|im_(?:start|sep|end)\|>|/?s>|/?INST\])"
CONTROL = r"([<\[])" + _TAIL
ESCAPABLE = r"([<\[])(~*)" + _TAIL
ESCAPED = r"([<\[])~(~*)" + _TAIL
_TURN = r"(?s)\G<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPABLE), F.lit("$1~$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def render(turns: Column) -> Column:
    """Turns (array of struct(role, text)) to text, content as it is."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), t["role"], F.lit(SEP), t["text"], F.lit(END))), "")


def parse(formatted: Column) -> Column:
    """Rendered text to turns: array of struct(role, text); null where it does not follow the grammar."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    raw = F.arrays_zip(roles.alias("role"), texts.alias("text"))

    def strict(turns: Column) -> Column:
        clean = F.forall(turns, lambda t: ~t["role"].rlike(CONTROL) & ~t["text"].rlike(CONTROL))
        covered = F.aggregate(turns, F.lit(0), lambda n, t: n + F.length(t["role"]) + F.length(t["text"])
                              + len(START + SEP + END)) == F.length(formatted)
        return F.when(clean & covered, F.transform(turns, lambda t: F.struct(
            unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))))

    return let(raw, strict)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns`` (read back from
    ``formatted``), ``escaped`` and ``round_trip``.

    Rows are ordered by turn (nulls first), then role, then text.  Null roles
    and texts count as empty.  Rows with a null conversation id form one
    conversation.  Repeated rows are repeated turns; other columns are
    ignored; an empty table gives no conversations.
    """
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("source"))
    source = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    plain = grouped.select("conv_id", source.alias("source"))
    first = plain.select("conv_id", "source", render(F.col("source")).alias("plain"))
    kept = first.select("conv_id", "source", "plain", F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False)).alias("same"))
    safe = F.transform("source", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    formatted = F.when(F.col("same"), F.col("plain")).otherwise(render(safe))
    out = kept.select("conv_id", "source", formatted.alias("formatted"), (~F.col("same")).alias("escaped"))
    back = out.select("*", F.coalesce(parse(F.col("formatted")), F.array().cast("array<struct<role:string,text:string>>")).alias("turns"))
    return back.select("conv_id", "formatted", "turns", "escaped", (F.col("turns") == F.col("source")).alias("round_trip"))


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: each assistant text once, in order."""
    spoken = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(spoken, lambda t: t["text"]), "")


def digest(formatted: DataFrame) -> DataFrame:
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss_text(F.col("turns"))).cast("long").alias("loss_chars"),
        F.sha2(loss_text(F.col("turns")), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "escaped", "round_trip")


def oracle_sql() -> str:
    """DuckDB twin: digests of the source turns (the round trip must give them back)."""
    any_control = r"[<\[]~*(\|im_(start|sep|end)\|>|/?s>|/?INST\])"
    marks = len(START + SEP + END)
    esc = lambda c: f"length(regexp_replace({c}, '({any_control})', '\\1~', 'g'))"
    return f"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*)::BIGINT AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum({marks} + {esc('role')} + {esc('text')})::BIGINT AS formatted_chars,
      bool_or(regexp_matches(role, '{any_control}') OR regexp_matches(text, '{any_control}')) AS escaped,
      TRUE AS round_trip
    FROM r GROUP BY conv_id"""
