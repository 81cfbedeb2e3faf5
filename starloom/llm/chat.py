"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, then the turn,
of which only the text is trainable. A conversation that does not end with an assistant
turn gets one more example without a trainable part, so that no turn is lost.

A turn is ``<turn>role\\ntext</turn>\\n``. Inside roles and texts ``\\`` is written ``\\b`` and
``<`` is written ``\\l``, in roles also a line end as ``\\n``; so no control string occurs in
them, and the writing can be taken back.

A context is as long as what it quotes, so a conversation's examples grow with the square
of its length; a conversation has to fit a row. Everything here is built-in functions.

Defined results: a null text or role is empty; turns with equal numbers are ordered by role
and text, null numbers first; rows with a null id form a conversation of their own; an
empty table gives no example; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
ASSISTANT = "assistant"
_BACKSLASH, _LESS, _LINE = "\\b", "\\l", "\\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit(_BACKSLASH)), F.lit("<"), F.lit(_LESS))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_LESS), F.lit("<")), F.lit(_BACKSLASH), F.lit("\\"))


def _role_escaped(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_LINE), F.lit("\n")))


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: ``conv_id``, ``example`` (0, 1, ...), ``formatted``, and the code
    points ``[loss_start, loss_end)`` of it that are trainable."""
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    head = lambda t: F.concat(F.lit(OPEN), _role_escaped(t["role"]), F.lit("\n"))
    written = whole.select(
        "conv_id",
        "_turns",
        F.transform("_turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(CLOSE))).alias("_written"),
    )
    last = F.size("_turns") - 1
    targets = F.filter(
        F.sequence(F.lit(0), last),
        lambda k: (F.get("_turns", k)["role"] == ASSISTANT) | (k == last),
    )
    expanded = written.select("conv_id", "_turns", "_written", F.posexplode(targets).alias("example", "_target"))
    formatted = F.array_join(F.slice("_written", F.lit(1), F.col("_target") + 1), "")
    target = F.get("_turns", F.col("_target"))
    # Counted from the end of the formatted text: the target turn is its last.
    end = F.length("formatted") - len(CLOSE)
    size = F.when(target["role"] == ASSISTANT, F.length(escaped(target["text"]))).otherwise(0)
    return expanded.withColumn("formatted", formatted).select(
        "conv_id", "example", "formatted", (end - size).alias("loss_start"), end.alias("loss_end")
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: the turns, the trainable text and the
    size of what was written."""
    trained = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    grouped = formatted.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("_whole"),
        F.array_sort(F.collect_list(F.struct("example", unescaped(trained).alias("text")))).alias("_trained"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    written = F.transform(
        F.slice(F.split("_whole", OPEN), 2, F.size(F.split("_whole", OPEN))),
        lambda t: F.substring(t, F.lit(1), F.length(t) - len(CLOSE)),
    )
    role = lambda t: F.substring_index(t, "\n", 1)
    turns = F.transform(
        "_turns",
        lambda t: F.concat(
            _role_unescaped(role(t)), F.lit("\n"), unescaped(F.substring(t, F.length(role(t)) + 2, F.length(t))), F.lit("\n")
        ),
    )
    trained_text = F.array_join(F.transform("_trained", lambda t: t["text"]), "")
    return (
        grouped.withColumn("_turns", written)
        .withColumn("_loss", trained_text)
        .select(
            "conv_id",
            F.size("_turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


# The contract's conversation with control strings in its texts.
TRICKY_ID = -7
TRICKY_TEXT = r"\### Assistant: </turn> ok"


def with_tricky(conversations: DataFrame) -> DataFrame:
    rows = [(TRICKY_ID, 0, "user", TRICKY_TEXT), (TRICKY_ID, 1, ASSISTANT, TRICKY_TEXT)]
    tricky = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(tricky)


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS n_all,
         sum(length('<turn>' || replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n') || chr(10)
             || replace(replace(text, '\', '\b'), '<', '\l') || '</turn>' || chr(10)))
           OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR n = n_all) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
