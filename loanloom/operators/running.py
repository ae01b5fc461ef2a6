"""Running totals and positions that survive a hot key.

Rows are dealt into ranges of their order and stored so, which fixes each row's piece. A
piece is about as large as any other, whatever key or day its rows belong to; what comes
before a piece is a sum over one row per key and piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Stored = Callable[[DataFrame], DataFrame]


def in_pieces(rows: DataFrame, order: Sequence[Column], stored: Stored) -> DataFrame:
    """Rows by ranges of the order, each sorted, with ``_piece`` and the place in it.

    ``stored`` writes the rows and reads them back: bounds are sampled anew whenever the
    rows are dealt again, so they must be dealt once.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # Piece and place in one number, 33 bits for the place.
    numbered = stored(dealt.withColumn("_number", F.monotonically_increasing_id()))
    place = F.col("_number").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumns(
        {"_piece": F.shiftright("_number", 33), "_place": place}
    ).drop("_number")


def _before(pieces: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """Sum over the earlier pieces of each key, one row per key and piece."""
    earlier = Window.partitionBy(*keys).orderBy("_piece")
    sums = pieces.groupBy(*keys, "_piece").agg(amount.alias("_sum"))
    upto = F.sum("_sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(
        *[F.col(c).alias(f"_o_{c}") for c in (*keys, "_piece")],
        F.coalesce(upto, F.lit(0)).alias("_offset"),
    )


def running_total(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    stored: Stored,
    before: str = "before",
    after: str = "after",
) -> DataFrame:
    """Exclusive and inclusive running totals per key, in ``order``, nulls last.

    The window runs in a key's piece; a key with nearly all rows, even of one day, has
    as many pieces as its rows need. Rows that tie in the whole order share a piece and
    are added in any order.
    """
    if not keys:
        raise ValueError("running_total needs at least one key")
    by = [F.col(c).asc_nulls_last() for c in order]
    pieces = in_pieces(rows, [*[F.col(c).asc_nulls_first() for c in keys], *by], stored)
    fine = [*keys, "_piece"]
    inside = Window.partitionBy(*fine).orderBy("_place")
    local = pieces.withColumn(
        "_local", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    matched = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in fine]
    total = F.col("_offset") + F.col("_local")
    return local.join(_before(pieces, keys, F.sum(value)), matched).select(
        *rows.columns,
        (total - F.col(value)).alias(before),
        total.alias(after),
    )


def with_position(
    rows: DataFrame, order: Sequence[Column], stored: Stored, into: str = "position"
) -> DataFrame:
    """Adds each row's position from 1 in the order of all rows.

    Only the pieces' row counts, one row a piece, meet in one task. Ties take positions
    in turn; name columns that decide them. Partitions stay in the order.
    """
    pieces = in_pieces(rows, order, stored)
    starts = _before(pieces.withColumn("_all", F.lit(0)), ["_all"], F.count("*"))
    place = F.col("_offset") + F.col("_place") + 1
    return pieces.join(
        starts.drop("_o__all"), F.col("_piece") == F.col("_o__piece")
    ).select(*rows.columns, place.alias(into))
