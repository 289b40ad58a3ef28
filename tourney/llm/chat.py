"""Chat formatting in budgeted windows.

Each conversation becomes one or more training windows. Prefix sums of turn tokens cut it into
spans of whole turns, the leading system turn heads every window, and a window repeats a few turns
before its own as history. The loss mask covers each assistant text once: where it is new, not where
it is repeated.

Turns are marked in the ``[INST]`` style. A control string inside a text gets a backslash after its
first character (one more if it has some already), so marks and texts cannot be confused, and
removing one backslash gives the text back.

Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")

_TAILS = "|".join(c[1:].replace("]", r"\]") for c in CONTROL)
_ESCAPE = rf"([<\[])(\\*)({_TAILS})"
_UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"
_TURN = (
    r"(?s)<<SYS>>\n(.*?)\n<</SYS>>\n"
    r"|\[INST\] (.*?) \[/INST\]"
    r"|\[ROLE\](.*?)\n \[/ROLE\]"
    r"|<s> (.*?) </s>"
)

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, r"$1$2$3")


def _role_mark(role: Column) -> Column:
    """A role in one line, reversibly."""
    one_line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(one_line)


def _marked_role(mark: Column) -> Column:
    role = F.replace(unescape(mark), F.lit("%0A"), F.lit("\n"))
    return F.replace(role, F.lit("%25"), F.lit("%"))


def _marks(role: Column) -> tuple[Column, Column]:
    """What stands before and after the text of a turn."""
    other = F.concat(F.lit("[ROLE]"), _role_mark(role), F.lit("\n "))
    before = (
        F.when(role == "system", "<<SYS>>\n")
        .when(role == "user", "[INST] ")
        .when(role == "assistant", "<s> ")
        .otherwise(other)
    )
    after = (
        F.when(role == "system", "\n<</SYS>>\n")
        .when(role == "user", " [/INST]")
        .when(role == "assistant", " </s>")
        .otherwise("\n [/ROLE]")
    )
    return before, after


def estimated_tokens(rendered: Column) -> Column:
    """One token per four characters, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.char_length(rendered) / 4)).cast("bigint")


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``formatted``, ``loss_spans`` and ``turns``.

    ``loss_spans`` are (start, length) in characters of ``formatted``. ``turns`` counts the turns of
    the window, ``repeated`` those at its head that an earlier window has too.

    Turns are ordered by ``turn``, then role and text, nulls first. Null roles and texts count as
    empty; null conversation ids are one conversation. A window stays within ``budget`` tokens
    unless a single turn with its system turn is longer: turns are never cut. Spans follow from
    prefix sums: the new turns of a window start within one stretch of tokens, whose length leaves
    room for the system turn, the history and the longest turn of the conversation.

    The rows of a conversation are sorted in one partition, which spills to disk; no array ever
    holds more than the turns of a window.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    before, after = _marks(role)
    turns = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.char_length(before).alias("head"),
        F.char_length(escape(text)).alias("body"),
        F.concat(before, escape(text), after).alias("rendered"),
    ).withColumn("tokens", estimated_tokens(F.col("rendered")))

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    numbered = turns.withColumn("place", F.row_number().over(order))
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    numbered = numbered.withColumns(
        {
            "own_tokens": F.when(is_system, 0).otherwise(F.col("tokens")),
            "leads": is_system,
        }
    )
    summed = numbered.withColumns(
        {
            "before": F.coalesce(F.sum("own_tokens").over(so_far), F.lit(0)),
            "system": F.max(F.when(F.col("leads"), F.col("rendered"))).over(whole),
            "longest": F.max("own_tokens").over(whole),
        }
    )
    system_tokens = F.when(F.col("system").isNull(), 0).otherwise(
        estimated_tokens(F.col("system"))
    )
    stretch = F.greatest(
        F.lit(1), budget - system_tokens - history_tokens - (F.col("longest") - 1)
    )
    placed = summed.withColumn(
        "window", F.when(F.col("leads"), 0).otherwise(F.floor(F.col("before") / stretch))
    )
    opens = F.col("window") != F.lag("window", 1, -1).over(order)
    placed = placed.withColumn("opens", opens & ~F.col("leads"))

    # A turn is repeated by the windows that open at one of the next turns, as far as it fits.
    targets = [
        F.when(
            F.lead("opens", n).over(order)
            & (F.lead("window", n).over(order) != F.col("window"))
            & (F.lead("before", n).over(order) - F.col("before") <= history_tokens)
            & ~F.col("leads"),
            F.lead("window", n).over(order),
        )
        for n in range(1, history_turns + 1)
    ]
    repeated = F.array_distinct(F.array_compact(F.array(*targets))) if targets else F.array()
    shown = placed.withColumn("again", repeated.cast("array<bigint>")).select(
        "conv_id", "place", "role", "head", "body", "rendered", "system",
        F.explode(F.concat(F.array(F.col("window")), "again")).alias("shown"),
        F.col("window").alias("own"),
    )
    by_window = shown.groupBy("conv_id", F.col("shown").alias("window")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "place", "rendered", "head", "body",
                    (F.col("role") == "assistant").alias("answers"),
                    (F.col("own") != F.col("shown")).alias("repeated"),
                )
            )
        ).alias("shown"),
        F.max("system").alias("system"),
    )
    heads = (F.col("window") > 0) & F.col("system").isNotNull()
    lead_text = F.when(heads, F.col("system")).otherwise("")
    # Offsets: the rendered lengths of the turns before, summed over the turns of one window.
    spans = F.aggregate(
        "shown",
        F.struct(
            F.char_length(lead_text).cast("int").alias("at"),
            F.array().cast("array<struct<start:int,length:int>>").alias("spans"),
        ),
        lambda found, turn: F.struct(
            (found.at + F.char_length(turn.rendered)).cast("int").alias("at"),
            F.when(
                turn.answers & ~turn.repeated,
                F.concat(
                    found.spans,
                    F.array(
                        F.struct(
                            (found.at + turn["head"]).cast("int").alias("start"),
                            turn.body.cast("int").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(found.spans)
            .alias("spans"),
        ),
        lambda found: found.spans,
    )
    texts = F.transform("shown", lambda turn: turn.rendered)
    again = F.size(F.filter("shown", lambda turn: turn.repeated))
    return by_window.select(
        "conv_id",
        F.col("window").cast("bigint").alias("window"),
        F.concat(lead_text, F.array_join(texts, "")).alias("formatted"),
        spans.alias("loss_spans"),
        (F.size("shown") + F.when(heads, 1).otherwise(0)).alias("turns"),
        (again + F.when(heads, 1).otherwise(0)).alias("repeated"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) that a formatted window holds, texts as they were before escaping."""
    found = F.regexp_extract_all(formatted, F.lit(f"({_TURN})"), F.lit(1))

    def turn(mark: Column) -> Column:
        def body(head: str, tail: str) -> Column:
            size = F.char_length(mark) - len(head) - len(tail)
            return unescape(F.substring(mark, F.lit(len(head) + 1), size))

        cut = F.instr(mark, "\n ")
        role = _marked_role(F.substring(mark, F.lit(7), cut - 7))
        rest = F.substring(mark, cut + 2, F.char_length(mark) - cut - 1 - len("\n [/ROLE]"))
        return (
            F.when(mark.startswith("<<SYS>>"), F.struct(
                F.lit("system").alias("role"), body("<<SYS>>\n", "\n<</SYS>>\n").alias("text")))
            .when(mark.startswith("[INST]"), F.struct(
                F.lit("user").alias("role"), body("[INST] ", " [/INST]").alias("text")))
            .when(mark.startswith("<s>"), F.struct(
                F.lit("assistant").alias("role"), body("<s> ", " </s>").alias("text")))
            .otherwise(F.struct(role.alias("role"), unescape(rest).alias("text")))
        )

    return F.transform(found, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, joined with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.length))), ""
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation of what ``format_windows`` wrote.

    A digest needs the whole text in order, so the texts of one conversation meet in one row, of
    Spark's row size at most; repeated turns are dropped before that.
    """
    turns = read_turns(F.col("formatted"))
    fresh = F.slice(turns, F.col("repeated") + 1, F.greatest(F.size(turns), F.lit(1)))
    text = F.array_join(
        F.transform(fresh, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
    )
    per_window = windows.select(
        "conv_id",
        "window",
        (F.col("turns") - F.col("repeated")).cast("bigint").alias("n_turns"),
        text.alias("text"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("chars"),
    )
    grouped = per_window.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "text", "loss"))).alias("windows"),
        F.sum("n_turns").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = grouped.select(
        "conv_id",
        "n_turns",
        "formatted_chars",
        F.array_join(F.transform("windows", lambda w: w.text), "").alias("text"),
        F.array_join(F.transform("windows", lambda w: w.loss), "").alias("loss"),
    )
    return joined.select(
        "conv_id",
        "n_turns",
        F.sha2("text", 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _oracle() -> str:
    """What ``read_back`` returns, computed from the turns without formatting them."""
    escaped = rf"regexp_replace(text, '{_ESCAPE}', '\1\\\2\3', 'g')"
    one_line = "replace(replace(role, '%', '%25'), chr(10), '%0A')"
    role = rf"regexp_replace({one_line}, '{_ESCAPE}', '\1\\\2\3', 'g')"
    system_tokens = "CASE WHEN system IS NULL THEN 0 ELSE greatest(1, ceil(system / 4)) END"
    repeats = " UNION ALL ".join(
        f"""
  SELECT conv_id, place, rendered, lead_{n} AS shown FROM led
  WHERE opens_{n} AND lead_{n} <> win AND before_{n} - before <= {HISTORY_TOKENS} AND NOT leads"""
        for n in range(1, HISTORY_TURNS + 1)
    )
    led = ", ".join(
        f"lead(win, {n}) OVER o AS lead_{n}, lead(opens, {n}) OVER o AS opens_{n}, "
        f"lead(before, {n}) OVER o AS before_{n}"
        for n in range(1, HISTORY_TURNS + 1)
    )
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         length({escaped}) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15
           WHEN 'assistant' THEN 9 ELSE 17 + length({role}) END AS rendered
  FROM said
),
counted AS (
  SELECT *, place = 1 AND role = 'system' AS leads,
         CASE WHEN place = 1 AND role = 'system' THEN 0
              ELSE greatest(1, ceil(rendered / 4)) END AS tokens
  FROM turns
),
summed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         max(rendered) FILTER (leads) OVER w AS system, max(tokens) OVER w AS longest
  FROM counted WINDOW w AS (PARTITION BY conv_id)
),
placed AS (
  SELECT *, CASE WHEN leads THEN 0 ELSE floor(before / greatest(1,
           {BUDGET} - {system_tokens} - {HISTORY_TOKENS} - (longest - 1))) END AS win
  FROM summed
),
opened AS (
  SELECT *, win <> lag(win, 1, -1) OVER (PARTITION BY conv_id ORDER BY place) AND NOT leads AS opens
  FROM placed
),
led AS (
  SELECT *, {led} FROM opened WINDOW o AS (PARTITION BY conv_id ORDER BY place)
),
shown AS (
  SELECT conv_id, place, rendered, win AS shown FROM led
  UNION SELECT conv_id, place, rendered, shown FROM ({repeats})
),
chars AS (
  SELECT conv_id, sum(rendered) AS chars, count(DISTINCT shown) FILTER (shown > 0) AS later
  FROM shown GROUP BY conv_id
)
SELECT t.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY t.place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY t.place) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(any_value(c.chars) + any_value(c.later) * coalesce(any_value(t.system), 0) AS BIGINT)
         AS formatted_chars
FROM led t JOIN chars c ON t.conv_id IS NOT DISTINCT FROM c.conv_id
GROUP BY t.conv_id""".strip()


ORACLE_SQL = _oracle()
