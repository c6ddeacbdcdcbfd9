"""Joins with the reference dimensions, shared by several views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import root
from ..sources.adapter import PARTY_PLACE, PARTY_SLICES, placed_by_party, placed_by_piece

MAPPING_OUT = ["id", "compte_debut", "compte_fin", "type_classe", "categorie_bi", "sous_categorie", "kpi_tags"]


def with_mapping(df: DataFrame, t, account_col: str = "cg_num", cols: list[str] | None = None) -> DataFrame:
    """Left join the account-root mapping: int(left(cg_num, 2)) = int(compte_debut).

    A root that is not a number matches nothing (try_cast) instead of failing.
    The mapping is a 52-row literal, so broadcasting it is bounded.
    """
    cols = cols or MAPPING_OUT
    m = t.mapping.select(F.col("compte_debut").try_cast("int").alias("__root_int"), *cols)
    keyed = df.withColumn("__root_int", root(account_col, 2).try_cast("int"))
    return keyed.join(F.broadcast(m), "__root_int", "left").drop("__root_int")


def with_calendar(df: DataFrame, t, date_col: str, cols: list[str]) -> DataFrame:
    """Left join the calendar on the day; the calendar has one row per day of a
    fixed range (bounded), so it is broadcast."""
    cal = t.calendar.select(F.col("dt_jour").alias("__day"), *cols)
    return df.join(F.broadcast(cal), df[date_col] == cal["__day"], "left").drop("__day")


def ledger_by_party(t) -> DataFrame:
    """The ledger with the place of every row (``PARTY_PLACE``), dealt out by it where the tables can do so."""
    return t.ledger_by_party if hasattr(t, "ledger_by_party") else placed_by_party(t.f_ecriturec)


def ledger_by_piece(t) -> DataFrame:
    """The ledger with ``PIECE_PLACE``, the same for all entries of a piece; where the tables can do so, it lies by that."""
    return t.ledger_by_piece if hasattr(t, "ledger_by_piece") else placed_by_piece(t.f_ecriturec)


def ledger_of_class(t, prefix: str) -> DataFrame:
    """Entries of the accounts that begin with ``prefix``; tables that are derived need not make all others first."""
    ledger = t.ledger_with(prefix) if hasattr(t, "ledger_with") else t.f_ecriturec
    return ledger.filter(F.col("cg_num").startswith(prefix))


def with_party(placed: DataFrame, parties: DataFrame) -> DataFrame:
    """Left join of ledger rows that have a place with the parties (``ct_num``).  The join is on the
    place, so rows that lie there already are not dealt out again; each party is sent to its slices."""
    party, slice_ = PARTY_PLACE
    sent = parties.withColumnRenamed("ct_num", "__key").withColumn(
        "__at", F.explode(F.array(*[F.lit(i) for i in range(PARTY_SLICES)])))
    met = (F.col(party) == F.col("__key")) & (F.col(slice_) == F.col("__at")) & F.col("ct_num").isNotNull()
    return placed.join(sent, met, "left").drop("__key", "__at")
