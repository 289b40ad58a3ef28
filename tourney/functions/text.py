"""Column expressions that read replies and write the history a player is shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tourney.schema import COOPERATE, DEFECT

# The wording a text-playing agent is given.
OPENING_CONTEXT = "C'est le premier tour."
LAST_MOVE = "Tour précédent : tu as joué "
LAST_REPLY = ", l'adversaire a joué "
SCORE_SO_FAR = ". Ton score cumulé : "
CONTEXT_END = "."
PROMPT_HEAD = "Tu joues au dilemme du prisonnier itératif.\n"
PROMPT_TAIL = "\nRéponds UNIQUEMENT par COOPERATE ou DEFECT, rien d'autre."


def normalise_choice(
    text: Column, keyword: str = DEFECT, otherwise: str = COOPERATE
) -> Column:
    """``keyword`` if the reply mentions it in any case, else ``otherwise``, also for no reply."""
    return F.when(F.upper(text).contains(F.upper(F.lit(keyword))), keyword).otherwise(otherwise)


def history_context(my_last: Column, their_last: Column, score: Column, opening: Column) -> Column:
    """Last move pair and own score before this round, or the opening sentence."""
    return F.when(opening, OPENING_CONTEXT).otherwise(
        F.concat(
            F.lit(LAST_MOVE),
            F.coalesce(my_last, F.lit("None")),
            F.lit(LAST_REPLY),
            F.coalesce(their_last, F.lit("None")),
            F.lit(SCORE_SO_FAR),
            F.coalesce(score, F.lit(0)).cast("string"),
            F.lit(CONTEXT_END),
        )
    )


def prompt(context: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), context, F.lit(PROMPT_TAIL))
