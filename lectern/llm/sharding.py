"""Shards along a Hilbert curve over several columns of metadata, from built-in functions only.

Each dimension is quantised to 2 ** BITS cells: strings by the rank of their value among the distinct
ones, with a cell to each value as long as there are enough, numbers by quarter octaves. Rows are sorted by the index of their cell on the
curve, and the order is cut into runs of equal row counts. Rows that are close in all dimensions
lie in the same run, so a file's least and greatest values prune on any of them.

Defined cases: a null string has a cell of its own, before all others, and a null number counts as 0. Rows in
the same cell are ordered by the columns given as ties, so that a cell that holds a third of all rows is
split. Strings of any length are compared whole. A column of the caller that is called ``hilbert``, ``shard`` or
``slot`` stays under that name with ``_`` behind it. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.numbering import numbered

BITS = 8


def string_cuts(frame: DataFrame, name: str, bits: int = BITS) -> list[str]:
    """The smallest value of each cell: of all distinct values, or of runs of equal numbers of them.

    Distinct values are range-sorted and numbered, as there may be many; fewer than 2 ** bits come back.
    """
    most = (1 << bits) - 1
    values = numbered(frame.select(F.col(name).alias("value")).where("value IS NOT NULL").distinct(), ["value"], "place")
    size = F.greatest(F.lit(most), F.lit(values.count()))
    cell = F.call_function("div", F.col("place") * most, size)
    before = F.call_function("div", (F.col("place") - 1) * most, size)
    first = values.where((F.col("place") == 0) | (cell > before))
    return sorted(row.value for row in first.select("value").collect())


def string_cell(value: Column, cuts: Sequence[str], bits: int = BITS) -> Column:
    """How many cuts are not above the value, by halving; 0 for null."""
    table = F.array(*[F.lit(cut) for cut in cuts]).cast("array<string>")

    def step(at: Column, size: Column) -> Column:
        reached = F.coalesce(F.get(table, at + size - 1) <= value, F.lit(False))
        return F.when(reached, at + size).otherwise(at)

    sizes = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(sizes, F.lit(0), step).cast("long")


def octave_cell(value: Column) -> Column:
    """Quarter octaves, exactly: four times the exponent, plus the two bits below the highest."""
    exponent = F.length(F.bin(value)) - 1
    quarter = F.call_function("shiftright", F.call_function("shiftleft", value, F.lit(2)), exponent).bitwiseAND(3)
    return F.when(value < 1, F.lit(0)).otherwise(exponent * 4 + quarter).cast("long")


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """The place on the curve of the cell with these coordinates, each below 2 ** bits.

    Works on the coordinates' bits from the highest down: each step either inverts the lower
    bits of the first coordinate or swaps them with those of another; a Gray code follows, and
    the bits are interleaved.
    """
    n = len(cells)

    def undo(state: Column, step: Column) -> Column:
        axis = (step % n).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(bits - 1) - F.floor(step / n)).cast("int"))
        first, own = F.get(state, F.lit(0)), F.get(state, axis)
        isset = own.bitwiseAND(bit) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(bit - 1)
        change = F.when(isset, bit - 1).otherwise(swap)

        def one(value: Column, place: Column) -> Column:
            here = F.when(place == 0, value.bitwiseXOR(change))
            return here.when((place == axis) & ~isset, value.bitwiseXOR(swap)).otherwise(value)

        return F.transform(state, one)

    start = F.array(*[c.cast("long") for c in cells])
    turned = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), start, undo)

    def gray(done: Column, value: Column) -> Column:
        last = F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("long"))
        return F.concat(done, F.array(last.bitwiseXOR(value)))

    coded = F.aggregate(turned, F.array().cast("array<bigint>"), gray)

    def interleave(values: Column) -> Column:
        def flips(total: Column, place: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
            return F.when(F.get(values, F.lit(n - 1)).bitwiseAND(bit) != 0, total.bitwiseXOR(bit - 1)).otherwise(total)

        def woven(flip: Column) -> Column:
            def take(index: Column, step: Column) -> Column:
                place = (F.lit(bits - 1) - F.floor(step / n)).cast("int")
                value = F.get(values, (step % n).cast("int")).bitwiseXOR(flip)
                return index * 2 + F.call_function("shiftright", value, place).bitwiseAND(1)

            return F.aggregate(F.sequence(F.lit(0), F.lit(n * bits - 1)), F.lit(0).cast("long"), take)

        return _bound(F.aggregate(F.sequence(F.lit(1), F.lit(bits - 1)), F.lit(0).cast("long"), flips), woven)

    return _bound(coded, interleave)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though a lambda in it uses it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hilbert_shards(
    frame: DataFrame,
    strings: Sequence[str],
    numbers: Sequence[str],
    ties: Sequence[str],
    shards: int,
    bits: int = BITS,
) -> DataFrame:
    """Add ``hilbert``, ``shard`` and ``slot``: runs of equal row counts along the curve.

    Shards differ by one row at most; slots count from 0 within a shard.
    """
    moved = {name: f"{name}_" for name in ("hilbert", "shard", "slot") if name in frame.columns}
    frame = frame.withColumnsRenamed(moved)
    strings, numbers, ties = ([moved.get(name, name) for name in names] for names in (strings, numbers, ties))
    cells = [string_cell(F.col(c), string_cuts(frame, c, bits), bits) for c in strings] + [
        F.least(octave_cell(F.coalesce(F.col(c), F.lit(0)).cast("long")), F.lit((1 << bits) - 1)) for c in numbers
    ]
    placed = numbered(frame.withColumn("hilbert", hilbert_index(cells, bits)), ["hilbert", *ties], "_at")
    total = placed.count()
    shard = F.expr(f"cast(_at * {shards} div {max(total, 1)}L as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("_at") - first).drop("_at")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows along the curve, so that statistics within a file prune too."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
