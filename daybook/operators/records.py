"""Records of CSV files whose quoted fields hold line breaks, put together without reading a file in one task.

Whether a line begins inside a quoted field depends on all lines before it. But
what a line makes of either beginning depends on the line alone: it ends inside
or outside whatever came before, or it keeps the state, or it turns it. So each
block of a file sums up its own lines, a few values per block are passed along,
and every line then knows its beginning.

The states of the blocks are a small table. Written, it is all that a second scan of
the lines needs to put the records together.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.csv_lines import has_open_quote

OPEN_QUOTE = "open quote at the end"
TOO_LONG = "record too long"
#: Bytes of a record of several lines that one task puts together.
RECORD_BYTES = 64 << 20
_BLOCK = ["path", "block_start"]


def _effect(opened: Column, kept_open: Column) -> dict[str, Column]:
    """What is known of a line: the end it forces, or whether it turns the state."""
    return {
        "_forces": F.when(opened == kept_open, opened.cast("int")),
        "_turns": F.when(opened & ~kept_open, 1).otherwise(0),
    }


def _running(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Add `_last` and `_flips`: the last forced end before a row, and the turns since (both without the row itself)."""
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_turned", F.sum("_turns").over(upto))
    forced = F.when(F.col("_forces").isNotNull(), F.struct("_forces", "_turned"))
    return (
        counted.withColumn("_at", F.last(forced, ignorenulls=True).over(before))
        .withColumn("_last", F.col("_at._forces"))
        .withColumn(
            "_flips",
            F.col("_turned") - F.col("_turns") - F.coalesce(F.col("_at._turned"), F.lit(0)),
        )
        .drop("_at", "_turned")
    )


def _state(start: Column) -> Column:
    """State before a row of `_running`, from that before the first row."""
    return (F.coalesce(F.col("_last"), start) + F.col("_flips")) % 2


def _marked(lines: DataFrame) -> DataFrame:
    opened, kept = has_open_quote(F.col("value")), has_open_quote(F.concat(F.lit('"'), "value"))
    return _running(lines.withColumns(_effect(opened, kept)), _BLOCK, ["line_id"])


def block_states(lines: DataFrame) -> DataFrame:
    """Per (path, block_start): the state before it and after it, the record it goes on with, and the file's open record.

    `lines` has path, block_start, line_id and value of all lines, blank ones too.
    """
    marked = _marked(lines)

    # Per block: the end it forces or its turns, and how many records begin under either state.
    begins = {s: F.count_if(_state(F.lit(s)) == 0) for s in (0, 1)}
    last = F.struct("line_id", "_last", "_flips", "_forces", "_turns")
    blocks = (
        marked.groupBy(*_BLOCK)
        .agg(F.max(last).alias("_end"), begins[0].alias("_begins0"), begins[1].alias("_begins1"))
        .withColumn(
            "_forces",
            F.coalesce("_end._forces", (F.col("_end._last") + F.col("_end._flips") + F.col("_end._turns")) % 2),
        )
        .withColumn(
            "_turns",
            F.when(F.col("_forces").isNull(), (F.col("_end._flips") + F.col("_end._turns")) % 2).otherwise(0),
        )
        .drop("_end")
    )
    in_file = Window.partitionBy("path").orderBy("block_start")
    whole_file = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce("_forces", (F.col("_start") + F.col("_turns")) % 2)
    begun = F.when(F.col("_begins") > 0, F.struct("block_start", "_begins"))
    return (
        _running(blocks, ["path"], ["block_start"])
        .withColumn("_start", _state(F.lit(0)))
        .withColumn("_begins", F.when(F.col("_start") == 0, F.col("_begins0")).otherwise(F.col("_begins1")))
        .withColumn(
            "_owner",
            F.last(begun, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)),
        )
        # The record that the file ends in: only the last one can be open.
        .withColumn("_open", F.last(F.when(after == 1, F.coalesce(begun, "_owner"))).over(whole_file))
        .select(*_BLOCK, "_start", "_owner", "_open")
    )


def unfinished_files(states: DataFrame) -> DataFrame:
    """Paths of files that end inside a quote."""
    return states.where("_open IS NOT NULL").select("path").distinct()


def assemble_records(lines: DataFrame, states: DataFrame, limit: int) -> DataFrame:
    """(path, block_start, line_id, value) of whole records.

    `lines` are those that `states` was made of. Lines of a record are joined by
    line feeds; a record is where its first line is. An open quote at the end of
    a file leaves its lines out of the records; they may be most of the file, so
    they are left out before any lines are gathered. So are the lines of a closed
    record of more than `limit` bytes, whose value is null.
    """
    upto = Window.partitionBy(*_BLOCK).orderBy("line_id").rowsBetween(Window.unboundedPreceding, 0)
    numbered = (
        _marked(lines)
        .join(states, _BLOCK)
        .withColumn("_before", _state(F.col("_start")))
        .withColumn("_after", F.coalesce("_forces", (F.col("_before") + F.col("_turns")) % 2))
        .withColumn("_number", F.count_if(F.col("_before") == 0).over(upto))
        .withColumn("_inside", (F.col("_before") == 1) | (F.col("_after") == 1))
        .withColumn(
            "_block", F.when(F.col("_number") > 0, F.col("block_start")).otherwise(F.col("_owner.block_start"))
        )
        .withColumn(
            "_record", F.when(F.col("_number") > 0, F.col("_number")).otherwise(F.col("_owner._begins"))
        )
    )
    single = numbered.where("NOT _inside").select(*_BLOCK, "line_id", "value")
    # The sum over a record holds its lines on disk where they are many; it needs no shuffle of its own.
    in_record = Window.partitionBy("path", "_block", "_record")
    line = F.struct("block_start", "line_id", "value")
    several = (
        numbered.where("_inside")
        .where("_open IS NULL OR _block != _open.block_start OR _record != _open._begins")
        .withColumn("_bytes", F.sum(F.octet_length("value") + 1).over(in_record))
        .groupBy("path", "_block", "_record")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("_bytes") <= limit, line))).alias("_lines"),
            F.min(F.struct("block_start", "line_id")).alias("_first"),
        )
        .select(
            "path",
            F.col("_block").alias("block_start"),
            F.col("_first.line_id").alias("line_id"),
            F.when(F.size("_lines") > 0, F.array_join(F.col("_lines")["value"], "\n")).alias("value"),
        )
    )
    return single.unionByName(several)
