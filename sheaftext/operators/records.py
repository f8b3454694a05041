"""Records that span lines, put together by many tasks.

What a line means may depend on all lines before it: whether a quote is open, whether the line before took it, where a
wide character begins. In all these cases what comes before is one small number, the state, and a line either sets it (to a
``shift``, ``fixed``) or adds to it (modulo ``modulus``). Such steps compose to a step of the same kind, so a block of lines
is one step, a group of blocks is one step, and a file never has to be read in order.

Lines of a split form blocks; each block's step travels up a tree of groups (blocks, then splits, then stretches of
a file) and the state before it comes down; these are written as one small table. A line at state 0 begins a record; other lines belong to
the record before them. Records are put together inside their block; only the first lines of a block that belong to an earlier block travel there.

No window covers a file: a group has about a thousand members at each level. A block has ``2 ** BLOCK_BITS`` lines of one split, so
not more bytes than a split. A record has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaftext.session import scratch_path

LINE = "value"
SOURCE, SPLIT, ROW = "__source", "__split", "__row"
BLOCK = "__block"
KEYS = [SOURCE, SPLIT, BLOCK]
BLOCK_BITS = 12
GROUP_BITS = 10  # blocks of a split that form a group
STRETCH_BITS = 32  # bytes of a file that form a stretch


def place_columns() -> dict[str, Column]:
    """File, offset of the split, and a number that grows by one per line of a split: the line order without a shuffle."""
    return {SOURCE: F.col("_metadata.file_path"), SPLIT: F.col("_metadata.file_block_start"), ROW: F.monotonically_increasing_id()}


def _earlier(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add the step of all earlier rows of the group (pre_fixed, pre_shift) and that step with the row's own (post_...)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    upto, before = window.rowsBetween(Window.unboundedPreceding, 0), window.rowsBetween(Window.unboundedPreceding, -1)
    added = F.when(F.col("fixed"), 0).otherwise(F.col("shift"))
    summed = rows.withColumn("sum", F.sum(added).over(upto))
    based = summed.withColumn("base", F.last(F.when(F.col("fixed"), F.col("shift") - F.col("sum")), ignorenulls=True).over(before))
    pre = F.col("sum") - added + F.coalesce("base", F.lit(0))
    known = based.withColumns({"pre_fixed": F.col("base").isNotNull(), "pre_shift": pre})
    post = {"post_fixed": F.col("fixed") | F.col("pre_fixed"), "post_shift": F.when(F.col("fixed"), F.col("shift")).otherwise(F.col("pre_shift") + F.col("shift"))}
    return known.withColumns(post).drop("sum", "base")


def _total(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One step per group."""
    last = F.max_by(F.struct(F.col("post_fixed").alias("fixed"), F.col("post_shift").alias("shift")), F.struct(*order)).alias("step")
    return rows.groupBy(*keys).agg(last).select(*keys, "step.*")


LEVELS = [([SOURCE, SPLIT, "group"], [BLOCK]), ([SOURCE, "stretch"], [SPLIT, "group"]), ([SOURCE], ["stretch"])]


def _names(level: DataFrame) -> list[str]:
    """The columns that name a member of a level."""
    return [c for c in (SOURCE, SPLIT, BLOCK, "group", "stretch") if c in level.columns and (c != "stretch" or SPLIT not in level.columns)]


def _states(steps: DataFrame, modulus: int) -> DataFrame:
    """(SOURCE, SPLIT, BLOCK, state): the state before each block, from the steps of all blocks."""
    level = steps.withColumn("group", F.shiftright(BLOCK, GROUP_BITS))
    held = []
    for keys, order in LEVELS:
        if "stretch" in keys:
            level = level.withColumn("stretch", F.shiftright(SPLIT, STRETCH_BITS))
        level = _earlier(level, keys, order)
        held.append((level, keys))
        level = _total(level, keys, order)
    state = None
    for level, keys in reversed(held):
        if state is None:
            known, start = level, F.lit(0)
        else:
            known, start = level.join(state.withColumnRenamed("state", "start"), keys), F.col("start")
        before = F.pmod(F.when(F.col("pre_fixed"), F.col("pre_shift")).otherwise(start + F.col("pre_shift")), F.lit(modulus))
        state = known.select(*_names(level), before.alias("state"))
    return state.select(*KEYS, "state")


def _owners(blocks: DataFrame) -> DataFrame:
    """(SOURCE, SPLIT, BLOCK, owner): the last record that began before each block, by (split, row), from ``began`` of all blocks."""
    level = blocks.withColumn("group", F.shiftright(BLOCK, GROUP_BITS))
    held = []
    for keys, order in LEVELS:
        if "stretch" in keys:
            level = level.withColumn("stretch", F.shiftright(SPLIT, STRETCH_BITS))
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("earlier", F.last("began", ignorenulls=True).over(before))
        held.append((level, keys))
        level = level.groupBy(*keys).agg(F.max("began").alias("began"))  # splits and rows grow along a file
    owner = None
    for level, keys in reversed(held):
        known = level if owner is None else level.join(owner, keys)
        found = F.col("earlier") if owner is None else F.coalesce("earlier", "owner")
        owner = known.select(*_names(level), found.alias("owner"))
    return owner.select(*KEYS, "owner")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _blocks(lines: DataFrame, modulus: int) -> DataFrame:
    """What is to be known of each block, written: state before it, its first line that begins a record, and the record that its
    lines before that belong to. Only numbers are read and shuffled here, no text."""
    placed = _earlier(lines.select(*KEYS, ROW, "fixed", "shift"), KEYS, [ROW])
    begins = [F.when(_at(F.lit(s), modulus) == 0, F.col(ROW)) for s in range(modulus)]
    ends = [f(b).alias(f"{name}{s}") for s, b in enumerate(begins) for name, f in (("first", F.min), ("last", F.max))]
    last = F.max_by(F.struct(F.col("post_fixed").alias("fixed"), F.col("post_shift").alias("shift")), ROW).alias("step")
    known = _written(placed.groupBy(*KEYS).agg(last, *ends).select(*KEYS, "step.*", *[f"{n}{s}" for s in range(modulus) for n in ("first", "last")]), "block-steps")
    pick = lambda name: F.element_at(F.array(*[F.col(f"{name}{s}") for s in range(modulus)]), (F.col("state") + 1).cast("int"))
    states = known.join(_states(known.select(*KEYS, "fixed", "shift"), modulus), KEYS).select(*KEYS, "state", pick("first").alias("first"), pick("last").alias("last"))
    began = F.when(F.col("last").isNotNull(), F.struct(F.col(SPLIT).alias("split"), F.col("last").alias("row"))).alias("began")
    states = _written(states, "block-states")
    return _written(states.join(_owners(states.select(*KEYS, began)), KEYS).select(*KEYS, "state", "first", "owner"), "blocks")


def _at(start: Column, modulus: int) -> Column:
    """The state before a line, given the state before its block."""
    return F.pmod(F.when(F.col("pre_fixed"), F.col("pre_shift")).otherwise(start + F.col("pre_shift")), F.lit(modulus))


def join_lines(lines: DataFrame, fixed: Column, shift: Column, glue: str, carry: list[str] | None = None, modulus: int = 2, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Records in the columns of ``lines`` (place columns, value, ``carry``): each with the place and carried columns of its first line.

    ``fixed`` and ``shift`` say what a line does to the state; a file begins at state 0. The lines are written to the shared folder
    with their places, as another scan of the files may cut them elsewhere; numbers of blocks and records are then made from that.
    """
    carry = carry or []
    here = _written(lines.select(SOURCE, SPLIT, F.shiftright(ROW, block_bits).alias(BLOCK), ROW, LINE, *carry, fixed.alias("fixed"), shift.cast("bigint").alias("shift")), "placed-lines")
    blocks = _blocks(here, modulus)
    joined = lambda *order: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, LINE))), lambda p: p[LINE]), glue)
    known = _earlier(here, KEYS, [ROW]).join(blocks.select(*KEYS, "state", F.col("first").alias("opening")), KEYS).where(F.col(ROW) >= F.col("opening"))
    so_far = Window.partitionBy(*KEYS).orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    first = F.last(F.when(_at(F.col("state"), modulus) == 0, F.col(ROW)), ignorenulls=True).over(so_far)
    numbered = known.select(*KEYS, ROW, LINE, *carry, first.alias("first"))
    whole = numbered.groupBy(*KEYS, "first").agg(joined(ROW).alias(LINE), *[F.min_by(c, ROW).alias(c) for c in carry])
    # the lines of a block before its first record, for the record of an earlier block: no sorting, no window
    heads = here.select(*KEYS, ROW, LINE).join(blocks.where("owner is not null and state <> 0").select(*KEYS, "first", "owner"), KEYS).where(F.col("first").isNull() | (F.col(ROW) < F.col("first")))
    rests = heads.groupBy(SOURCE, F.col("owner.split").alias(SPLIT), F.col("owner.row").alias("first")).agg(joined(SPLIT, ROW).alias("rest"))
    value = F.when(F.col("rest").isNotNull(), F.concat(LINE, F.lit(glue), "rest")).otherwise(F.col(LINE))
    return whole.join(rests, [SOURCE, SPLIT, "first"], "left").select(SOURCE, SPLIT, F.col("first").alias(ROW), value.alias(LINE), *carry)
