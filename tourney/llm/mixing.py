"""Mixes a corpus to target weights.

Iterative proportional fitting rakes the token counts of the cells (source, language, topic) until
the three marginals meet their targets. Each document is then drawn with the probability that
brings its cell to its raked share of the token budget. Everything is built-in expressions over a
table of cells, which is far smaller than the documents and is never gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tourney.llm.scratch import materialise


# Raking ends when no value of a margin is further than this from its target, relative to the target.
TOLERANCE = 1e-6
# Rounds between two looks at the margins; the cells are stored at each.
ROUNDS_AT_ONCE = 10
# Targets that the cells cannot meet together never get there: raking also ends when the largest error
# has not fallen to this part of what it was at the look before, or after so many rounds in all (at
# that pace they would not do either). What is left is reported.
STALLED = 0.9
MOST_ROUNDS = 200
# Scaling up the open cells ends when it changes nothing beyond rounding.
SAME_SCALE = 1 + 1e-12
TOKEN = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Margin:
    """Target shares of one column.

    A listed value weighs what ``weights`` says. Any other weighs its share of the tokens to the
    power ``temperature``: 1 keeps natural shares, 0 makes them equal. Weights are scaled to sum to
    one over the values that occur.
    """

    column: str
    temperature: float = 1.0
    weights: Mapping[str, float] = field(default_factory=dict)

    def weight(self, value: Column, share: Column) -> Column:
        found = F.pow(share, F.lit(float(self.temperature)))
        for name, weight in sorted(self.weights.items()):
            found = F.when(value == name, F.lit(float(weight))).otherwise(found)
        return found


MARGINS = (
    Margin("source", temperature=0.5),
    Margin("lang", weights={"en": 0.5, "de": 0.2, "fr": 0.18, "es": 0.12}),
    Margin("topic", temperature=0.7),
)
TOKEN_SHARE = 0.5


def token_count(text: Column) -> Column:
    """Runs of characters between ASCII white space; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def text_topic(text: Column, tokens: Column) -> Column:
    """Topic of a document by its form, as the tables name none."""
    return (
        F.when(F.instr(text, " | ") > 0, "table")
        .when(F.instr(text, "License") > 0, "licensed")
        .when(tokens < 100, "note")
        .when(tokens < 600, "article")
        .otherwise("report")
    )


def _margin_error(margins: tuple[Margin, ...]) -> Column:
    """The largest distance of a cell's margins from their targets, relative to these."""
    errors = [F.lit(0.0)]
    for margin in margins:
        target = F.col(f"_{margin.column}_target")
        reached = F.sum("share").over(Window.partitionBy(margin.column))
        errors.append(F.when(target > 0, F.abs(reached / target - 1)))
    return F.greatest(*errors)


def rake(
    cells: DataFrame,
    margins: tuple[Margin, ...] = MARGINS,
    tolerance: float = TOLERANCE,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """``cells`` (margin columns, ``tokens``) with ``share``, the raked share of all tokens, and
    ``margin_error``, how far the worst of the cell's margins is from its target.

    Each round scales every margin in turn; the last one is met exactly. Rounds go on until all
    margins meet their targets by ``tolerance``. For targets that no weighting of the cells can meet
    they end when the errors fall no more, or after ``most_rounds`` (a multiple of ``ROUNDS_AT_ONCE``),
    and the errors say which are missed. Cells without tokens keep a share of 0. Null values are a
    value of their own.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    start = (F.col("tokens") / F.lit(max(1, total))).cast("double")
    raked = cells.withColumn("share", start)
    for margin in margins:
        by_value = cells.groupBy(margin.column).agg(F.sum("tokens").alias("_tokens"))
        natural = (F.col("_tokens") / F.lit(max(1, total))).cast("double")
        weight = F.when(F.col("_tokens") > 0, margin.weight(F.col(margin.column), natural))
        values = by_value.select(
            F.col(margin.column).alias("_value"),
            F.coalesce(weight, F.lit(0.0)).alias(f"_{margin.column}_target"),
        )
        raked = raked.join(values, F.col(margin.column).eqNullSafe(F.col("_value"))).drop("_value")
    raked = materialise(raked, "cells")
    sums = raked
    for margin in margins:
        target = f"_{margin.column}_target"
        of_margin = raked.select(margin.column, target).distinct().agg(F.sum(target)).first()[0]
        sums = sums.withColumn(target, F.col(target) / F.lit(of_margin or 1.0))
    before = float("inf")
    for _ in range(0, most_rounds, ROUNDS_AT_ONCE):
        for margin in margins * ROUNDS_AT_ONCE:
            reached = F.sum("share").over(Window.partitionBy(margin.column))
            scaled = F.col("share") * F.col(f"_{margin.column}_target") / reached
            sums = sums.withColumn("share", F.when(reached > 0, scaled).otherwise(F.lit(0.0)))
        sums = materialise(sums.withColumn("margin_error", _margin_error(margins)), "raked-cells")
        worst = sums.agg(F.max("margin_error")).first()[0]
        if worst is None or worst <= tolerance or worst > STALLED * before:
            break
        before = worst
    return sums.select(*cells.columns, "share", "margin_error")


def probabilities(cells: DataFrame, raked: DataFrame, token_share: float) -> DataFrame:
    """Raked cells with the ``probability`` of each of their documents.

    A cell that would need more tokens than it has gives all of them, and the others share what it
    lacks in proportion to their raked shares, until no further cell is exhausted, so the expected
    tokens are ``token_share`` of all. Every step but the last exhausts a cell.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    budget = token_share * total
    scale = float(budget)
    while True:
        full = F.lit(scale) * F.col("share") >= F.col("tokens")
        row = raked.agg(
            F.sum(F.when(full, F.col("tokens"))).alias("given"),
            F.sum(F.when(~full, F.col("share"))).alias("open"),
        ).first()
        wider = float((budget - (row.given or 0)) / row.open) if row.open else scale
        if wider <= scale * SAME_SCALE:
            break
        scale = wider
    wanted = F.lit(scale) * F.col("share") / F.col("tokens")
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), wanted)).otherwise(F.lit(1.0))
    return raked.withColumn("probability", probability)


def draw(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) that follows from the key alone."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    margins: tuple[Margin, ...] = MARGINS,
    token_share: float = TOKEN_SHARE,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``probability``, ``margin_error`` and ``sampled``, replacing
    such columns.

    ``margin_error`` is above ``TOLERANCE`` for documents whose source, language or topic misses its
    target, as the cells that exist cannot meet all targets together; exhausted cells come on top.
    Documents without tokens have probability 1: they cost nothing and cannot be weighed. Rows that
    share a key are drawn together; a null key counts as the empty one. The cells join by Spark's
    own choice: broadcast while their stored table is small, shuffled beyond.
    """
    counted = docs.drop("probability", "margin_error", "sampled").withColumn("tokens", token_count(F.col("text")))
    topical = counted.withColumn("topic", text_topic(F.col("text"), F.col("tokens")))
    columns = [m.column for m in margins]
    cells = materialise(
        topical.groupBy(*columns).agg(F.sum("tokens").alias("tokens")), "cell-tokens"
    )
    known = probabilities(cells, rake(cells, margins), token_share)
    facts = ("probability", "margin_error")
    lookup = known.select(*[F.col(c).alias(f"_{c}") for c in columns], *facts)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    joined = topical.join(lookup, same, "left").drop(*[f"_{c}" for c in columns])
    chance = F.when(F.col("tokens") > 0, F.col("probability")).otherwise(F.lit(1.0))
    return joined.withColumn("probability", chance).withColumn(
        "sampled", draw(F.col("doc_id"), seed) < F.col("probability")
    )


def sampled_documents(docs: DataFrame, token_share: float = TOKEN_SHARE) -> DataFrame:
    """The rows of ``docs`` that the draw picks, columns unchanged."""
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "text", "source", "lang")
    return mix(packed, token_share=token_share).where("sampled").select("_row.*")


def mixture(docs: DataFrame) -> DataFrame:
    """The draw of every document, without its text."""
    return mix(docs).select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("probability", 6).alias("probability"),
        F.round("margin_error", 6).alias("margin_error"),
        "sampled",
    )


def _oracle() -> str:
    parts = [
        f"""docs AS (
  SELECT doc_id, source, lang, tokens,
         CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, 'License') THEN 'licensed'
              WHEN tokens < 100 THEN 'note' WHEN tokens < 600 THEN 'article' ELSE 'report' END
           AS topic
  FROM (SELECT *, CAST(coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS BIGINT) AS tokens
        FROM documents)
)""",
        """cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL
)""",
    ]
    targets = []
    for m in MARGINS:
        c = m.column
        listed = " ".join(f"WHEN {c} = '{n}' THEN {w}" for n, w in sorted(m.weights.items()))
        power = f"power(sum(tokens) / (SELECT sum(tokens) FROM cells), {m.temperature})"
        weight = f"CASE {listed} ELSE {power} END" if listed else power
        parts.append(
            f"""{c}_targets AS MATERIALIZED (
  SELECT {c}, w / sum(w) OVER () AS {c}_target
  FROM (SELECT {c}, CASE WHEN sum(tokens) > 0 THEN {weight} ELSE 0 END AS w
        FROM cells GROUP BY {c})
)"""
        )
        targets.append(f"JOIN {c}_targets ON cells.{c} IS NOT DISTINCT FROM {c}_targets.{c}")
    parts.append(
        "r0 AS MATERIALIZED (SELECT cells.*, tokens / (SELECT sum(tokens) FROM cells) AS share, "
        + ", ".join(f"{m.column}_target" for m in MARGINS)
        + " FROM cells "
        + " ".join(targets)
        + ")"
    )
    raked = "r"
    for m in MARGINS:
        reached = f"sum(share) OVER (PARTITION BY {m.column})"
        raked = (
            f"(SELECT * REPLACE (CASE WHEN {reached} > 0 "
            f"THEN share * {m.column}_target / {reached} ELSE 0 END AS share) FROM {raked})"
        )
    error = ", ".join(
        f"CASE WHEN {m.column}_target > 0 THEN "
        f"abs(sum(share) OVER (PARTITION BY {m.column}) / {m.column}_target - 1) END"
        for m in MARGINS
    )
    parts.append(
        f"""r AS (
  SELECT *, CAST(0 AS DOUBLE) AS margin_error, CAST('infinity' AS DOUBLE) AS worst,
         CAST('infinity' AS DOUBLE) AS earlier, 0 AS step
  FROM r0
  UNION ALL
  SELECT * REPLACE (max(margin_error) OVER () AS worst,
                    CASE WHEN (step - 1) % {ROUNDS_AT_ONCE} = 0 THEN worst ELSE earlier END AS earlier)
  FROM (SELECT * REPLACE (greatest(0, {error}) AS margin_error, step + 1 AS step) FROM {raked})
  WHERE step <= {MOST_ROUNDS} AND ((step - 1) % {ROUNDS_AT_ONCE} > 0
         OR (worst > {TOLERANCE} AND worst <= {STALLED} * earlier))
)"""
    )
    parts.append("raked AS MATERIALIZED (SELECT * FROM r WHERE step = (SELECT max(step) FROM r))")
    budget = f"{TOKEN_SHARE} * (SELECT sum(tokens) FROM cells)"
    parts.append(
        f"""s AS (
  SELECT CAST({budget} AS DOUBLE) AS scale
  UNION ALL
  SELECT wider FROM (
    SELECT any_value(scale) AS scale, ({budget}
             - coalesce(sum(tokens) FILTER (scale * share >= tokens), 0))
             / nullif(sum(share) FILTER (scale * share < tokens), 0) AS wider
    FROM raked, s
  ) WHERE wider > scale * {SAME_SCALE!r}
)"""
    )
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + f""",
chances AS (
  SELECT source, lang, topic, margin_error,
         least(1.0, (SELECT max(scale) FROM s) * share / nullif(tokens, 0)) AS chance
  FROM raked
)
SELECT doc_id, d.source, d.lang, d.topic, tokens, round(probability, 6) AS probability,
       round(margin_error, 6) AS margin_error, draw < probability AS sampled
FROM (
  SELECT d.*, margin_error, CASE WHEN tokens > 0 THEN chance ELSE 1.0 END AS probability,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0'), 1, 13) AS BIGINT)
           / CAST(4503599627370496 AS DOUBLE) AS draw
  FROM docs d LEFT JOIN chances c ON d.source IS NOT DISTINCT FROM c.source
    AND d.lang IS NOT DISTINCT FROM c.lang AND d.topic = c.topic
) d"""
    )


ORACLE_SQL = _oracle()
