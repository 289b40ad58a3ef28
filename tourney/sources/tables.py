"""Rounds derived from order tables: each line item is one round between two regions.

Side A is the customer's region, side B the supplier's; the run is the shipping year.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tourney.operators.history import BLOCK_BITS, over_history
from tourney.operators.ordering import POSITION, file_row_columns, place_in_order
from tourney.operators.scoring import add_gains
from tourney.schema import BRONZE, COOPERATE, DEFECT, MATCH
from tourney.plans.build import build, read_gold, register_silver
from tourney.session import scratch_dir, scratch_table
from tourney.sources.bronze import append_bronze, read_bronze, read_rejects
from tourney.sources.files import (
    broadcast_if_small,
    list_folders,
    mark_done,
    remove_table,
    table_exists,
    table_version,
)
from tourney.streaming.ingest import ingest_new_runs

# Order of the rounds of a match. The file row at the end only places exact copies of a line item,
# which would otherwise be one unsplittable key.
ROUND_ORDER = (
    "l_shipdate",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "file_hash",
    "file_row",
)

_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def recorded_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players and moves of every line item, with the columns that order them.

    Each lookup is broadcast only while the table that bounds it is small. Otherwise orders meet
    customers before line items, so that the line items are shuffled once per key, and skewed keys
    of these joins are split at run time.
    """
    nation, region, customer, orders, supplier = (
        _table(spark, sf_dir, name)
        for name in ("nation", "region", "customer", "orders", "supplier")
    )
    regions = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = broadcast_if_small(
        customer.join(regions, F.col("c_nationkey") == F.col("n_nationkey")),
        _path(sf_dir, "customer"),
    )
    buyers = broadcast_if_small(
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", F.col("r_name").alias("player_a")
        ),
        _path(sf_dir, "orders"),
    )
    sellers = broadcast_if_small(
        supplier.join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select(
            "s_suppkey", F.col("r_name").alias("player_b")
        ),
        _path(sf_dir, "supplier"),
    )
    lines = _table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("run_id"),
        F.when(F.col("l_returnflag") == "R", DEFECT).otherwise(COOPERATE).alias("choice_a"),
        F.when(F.col("l_discount") < 0.035, DEFECT).otherwise(COOPERATE).alias("choice_b"),
        *ROUND_ORDER[:-2],
        *[column.alias(name) for name, column in file_row_columns().items()],
    )
    return (
        lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(*MATCH, "choice_a", "choice_b", *ROUND_ORDER)
    )


def moves_in_order(recorded: DataFrame) -> DataFrame:
    """Stored moves in the order of the rounds.

    The range bounds are sampled by running the frame once more than it is read, so the joins behind
    ``recorded`` are stored first.
    """
    return place_in_order(
        recorded, order=(*MATCH, *ROUND_ORDER), keep=(*MATCH, "choice_a", "choice_b")
    )


def number_rounds(moves: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Bronze rounds of stored moves in order: tours from 1 per match, gains, running scores."""
    counted = add_gains(moves).withColumn("rounds", F.lit(1).cast("bigint"))
    numbered = over_history(
        counted,
        so_far={"tour": "rounds", "cumul_a": "gain_a", "cumul_b": "gain_b"},
        order=POSITION,
        block_bits=block_bits,
    )
    return numbered.select(*BRONZE.names)


def build_rounds(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Derive the rounds of ``sf_dir`` and store them as a bronze table."""
    with scratch_table(recorded_moves(spark, sf_dir), "recorded") as recorded:
        with scratch_table(moves_in_order(recorded), "moves") as moves:
            append_bronze(number_rounds(moves), path, "derived")


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """Changes with the names, sizes and times of the input files."""
    versions = [table_version(spark, _path(sf_dir, name)) for name in _TABLES]
    return hashlib.sha256("|".join(versions).encode()).hexdigest()[:24]


def stored_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """Folder of a table derived from the inputs, written on first use and kept for later ones.

    Applications share it through the scratch folder. Once a new version of the inputs is stored,
    the tables of older ones are removed. Two applications may write the same version at a time:
    each writes its own folder and marks it when complete.
    """
    version = input_version(spark, sf_dir)
    of_input = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    home = f"{scratch_dir(spark)}/derived/{of_input}/{name}"
    folders = sorted(list_folders(spark, home))
    for folder in folders:
        if folder.rsplit("/", 1)[-1].startswith(version) and table_exists(spark, f"{folder}/_DONE"):
            return folder
    path = f"{home}/{version}-{uuid.uuid4().hex}"
    write(path)
    mark_done(spark, path)
    for folder in folders:
        if not folder.rsplit("/", 1)[-1].startswith(version):
            remove_table(spark, folder)
    return path


def _stored_bronze(spark: SparkSession, sf_dir: str) -> str:
    return stored_once(spark, sf_dir, "bronze", lambda path: build_rounds(spark, sf_dir, path))


def stored_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table of ``sf_dir``, the stored input of every model."""
    return read_bronze(spark, _stored_bronze(spark, sf_dir))


def stored_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table that ``build`` has written from the rounds of ``sf_dir``."""

    def write(path: str) -> None:
        build(stored_rounds(spark, sf_dir), path, select=("gold",))

    return read_gold(spark, stored_once(spark, sf_dir, "gold", write), name)


def delivered_rounds(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rounds as two deliveries: the second repeats some rounds of the first, one with another
    move."""
    tour = F.col("tour")
    other = F.when(tour == 35, "MAYBE").otherwise(F.col("choice_a"))
    return bronze.where(tour <= 40), bronze.where(tour > 30).withColumn("choice_a", other)


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a bronze table and a warehouse that have picked up both deliveries."""

    def write(path: str) -> None:
        for number, rounds in enumerate(delivered_rounds(stored_rounds(spark, sf_dir))):
            rounds.write.parquet(f"{path}/landing/delivery-{number}.parquet")
            ingest_new_runs(
                spark, f"{path}/landing", f"{path}/bronze", f"{path}/gold", f"{path}/checkpoint"
            ).awaitTermination()

    return stored_once(spark, sf_dir, "ingested", write)


def ingested_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table that two deliveries, picked up one after the other, have brought up to date."""
    return read_gold(spark, f"{_ingested(spark, sf_dir)}/gold", name)


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rounds of each run the second delivery repeated, by reason."""
    rejects = read_rejects(spark, f"{_ingested(spark, sf_dir)}/bronze")
    return rejects.groupBy("run_id", "reason").agg(F.sum("copies").alias("rounds"))


def lasting_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver view in the catalog over the stored rounds, read by name."""
    path = _stored_bronze(spark, sf_dir)
    database = f"tourney_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    register_silver(spark, path, database)
    return spark.table(f"{database}.silver_rounds")


def faulty_rounds(bronze: DataFrame) -> DataFrame:
    """Rounds with faults that follow from the round number: missing and unknown moves, gaps.

    Gains and running scores stay as recorded, so they no longer follow from the moves.
    """
    tour = F.col("tour")
    choice_a = F.when(tour % 11 == 3, F.lit(None)).otherwise(F.col("choice_a"))
    choice_b = F.when(tour % 13 == 5, "MAYBE").otherwise(F.col("choice_b"))
    return bronze.where(tour % 17 != 9).withColumns({"choice_a": choice_a, "choice_b": choice_b})


def rounds_breaking_rules(bronze: DataFrame) -> DataFrame:
    """``faulty_rounds`` with copies, impossible gains, wrong running scores and missing names."""
    tour = F.col("tour")
    wrong = faulty_rounds(bronze).withColumns(
        {
            "gain_a": F.when(tour % 23 == 6, F.lit(7).cast("bigint")).otherwise(F.col("gain_a")),
            "cumul_b": F.when(tour % 29 == 8, F.col("cumul_b") + 1).otherwise(F.col("cumul_b")),
            "player_b": F.when(tour % 31 == 10, F.lit(None)).otherwise(F.col("player_b")),
        }
    )
    copies = F.when(tour % 19 == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return wrong.withColumn("_copy", F.explode(copies)).drop("_copy")
