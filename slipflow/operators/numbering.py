"""Exact ``row_number()`` inside groups that may be huge or few (departments, one hot contract).

A plain ``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row of a group to
one task: with 25 departments that is at most 25 busy tasks, and a contract holding a third of
all documents puts a third of the data into one task. ``number_rows`` gives the same numbers
while splitting every group over many tasks:

1. Range-partition the rows on ``(group, order)`` with ``repartitionByRange``. The bounds come
   from a sample of the full composite key, so a hot group is cut into many consecutive
   *slices* of about ``ROWS_PER_SLICE`` rows. The rows are first written as a table in the shared
   checkpoint folder, so the sample, and so every slice, is the same in every job and in every
   retried task.
2. Number rows inside slices. With few groups (at most ``FEW_GROUPS``: the hot groups, or one
   global group) each range partition is sorted within itself and
   ``monotonically_increasing_id`` gives every row its slice and position, with no second
   shuffle. With many groups a window over ``(group, slice)`` does it; a window partition then
   holds at most one slice, never a whole hot group.
3. Add the rows of the same group in earlier slices: a running sum over per-(group, slice)
   counts (partial aggregation). That table has at most ``groups + slices`` rows (few groups)
   or, keeping only groups that began in an earlier slice, at most one row per slice; either
   way a proven bound, so it is broadcast to the final step.

``strategy="auto"`` (the default) first looks for *hot* groups, those with more rows than a task
should take (``single_task_rows``, at least ``MIN_SINGLE_TASK_ROWS`` or the fair share of one task,
whichever is larger). ``heavy_groups`` finds them without grouping the rows: a mergeable sketch of
frequent items, one per task and merged, names at most twice as many candidates as there can be hot
groups, and a second narrow pass counts exactly these. The hot groups are written as a table of at
most ``rows / bound`` key hashes; the input is parted by joins with that table (anti for the cold
rows, semi for the hot ones), below its own joins where the caller says how (``rebuild``). No key is
collected or inlined. Groups that are not hot go through the plain one-window plan (each provably fits a task, and
the window reuses an upstream shuffle on the same keys); only the rows of hot groups take the split
plan. Contracts at scale are typically all small (plain plan, no extra shuffle), departments are all
hot (split plan), and one hot contract sends only its own rows to the split plan.

``order_by`` must make the order total (end it with a unique key) so the numbering is
deterministic.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE = "_slice"
# A window task may hold a whole group of up to this many rows (sorted, spillable).
MIN_SINGLE_TASK_ROWS = 1_000_000
# Target rows per slice of the split plan: the slice count grows with the data, so no window
# task holds more than about this many rows whatever the scale.
ROWS_PER_SLICE = 1_000_000
# The single-shuffle split plan broadcasts one row per (group, slice); it is used when the
# number of groups is proven to be at most this.
FEW_GROUPS = 200_000


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet under the shared checkpoint folder and read it back (cuts
    lineage and fixes nondeterministic values such as slice ids; survives executor loss). Columns
    of ``partition_by`` must never be empty: a folder name keeps no difference between '' and NULL."""
    folder = ensure_checkpoint_dir(df.sparkSession)
    path = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # read back with the written schema: partition columns keep their types (no inference)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plain(df: DataFrame, partition_by, order_by, out_col, start) -> DataFrame:
    w = Window.orderBy(*order_by) if not partition_by else \
        Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(out_col, (F.row_number().over(w) + F.lit(start - 1)).cast("long"))


def number_rows(df: DataFrame, partition_by: list[str], order_by: list[Column],
                out_col: str = "row_num", start: int = 1, *, strategy: str = "auto",
                num_slices: int | None = None, single_task_rows: int | None = None,
                stage_input: bool = False, max_rows: int | None = None,
                measured=None, rebuild=None) -> DataFrame:
    """Add ``out_col`` = ``row_number() - 1 + start`` over ``partition_by`` ordered by ``order_by``.

    ``strategy``: ``"auto"`` (see module doc), ``"split"`` (always the skew-proof plan) or
    ``"window"`` (always one plain window, no measurement; for comparisons).

    When no group is hot the plain window runs on the input itself, so it reuses an upstream shuffle
    on the same keys (the contract join for the ranking): no extra shuffle and no write. The plain
    window is deterministic whatever the row order, so only rows taking the split plan are staged:
    they are sliced and written under the checkpoint folder in one job (``_sliced``).
    ``stage_input=True`` writes the whole input first instead (for inputs whose upstream is too
    costly to run three times).

    ``max_rows`` is a proven upper bound on the input's row count (from source statistics, see
    ``priority.registry_row_bound``). When it is within one task, no group can be hot and the
    plain window is used without measuring.

    ``measured`` is a function without arguments giving (rows, weights) to look for hot groups in,
    instead of the input (``priority.contract_sizes``): rows with the group columns, and a table of
    group columns and ``_weight`` with the groups each of whose rows stands for several rows of the
    input (None: no group). It is called only when sizes are needed.

    ``rebuild`` is a function (part, hot) giving the input anew with ``part``, a restriction of rows
    that have the group columns, applied where its builder likes, so that it stands below the
    builder's joins; ``hot`` tells which part is asked for. Without it the input itself is parted.

    The split plan uses ``num_slices`` slices, by default the larger of the shuffle partition
    count and ``rows / ROWS_PER_SLICE``.
    """
    if strategy == "window":
        return _plain(df, partition_by, order_by, out_col, start)
    if strategy not in ("auto", "split"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "auto" and max_rows is not None and max_rows <= (single_task_rows or MIN_SINGLE_TASK_ROWS):
        return _plain(df, partition_by, order_by, out_col, start)

    base = write_stage(df, "numbering") if stage_input else df
    rows, weights = measured() if measured and partition_by else (base, None)
    total = rows.count()
    n = num_slices or max(_shuffle_partitions(df), -(-total // ROWS_PER_SLICE))
    bound = single_task_rows or max(MIN_SINGLE_TASK_ROWS, total // max(n, 1))
    if strategy == "split":
        groups = min(FEW_GROUPS + 1, base.select(*partition_by).distinct().limit(FEW_GROUPS + 1).count()) \
            if partition_by else 1
        return _split_for(groups)(base, partition_by, order_by, out_col, start, n)
    if weights is None and total <= bound:
        return _plain(base, partition_by, order_by, out_col, start)
    if not partition_by:  # one group holding every row: it is the hot group
        return _split_few_groups(base, partition_by, order_by, out_col, start, n)
    hot, groups, in_hot = heavy_groups(rows, partition_by, bound, total, weights)
    if not groups:
        return _plain(base, partition_by, order_by, out_col, start)
    if num_slices is None:  # the weights may make more rows than were counted
        n = max(n, -(-in_hot // ROWS_PER_SLICE))
    split = _split_for(groups)
    if measured is None and in_hot == total:  # every group is hot: no second branch
        return split(base, partition_by, order_by, out_col, start, n)
    # At most rows / bound hashes (see module doc), so they are broadcast. A hash shared with a cold
    # group only moves that group to the (equally exact) split plan; a group never straddles both.
    is_hot = group_hash(partition_by) == F.col("_hot")
    hashes = F.broadcast(hot.select(F.col("_hash").alias("_hot")))

    def part(how: str) -> DataFrame:
        def taken(rows: DataFrame) -> DataFrame:
            return rows.join(hashes, is_hot, how)
        return rebuild(taken, how == "left_semi") if rebuild else taken(base)

    cold_rows, hot_rows = part("left_anti"), part("left_semi")
    return _plain(cold_rows, partition_by, order_by, out_col, start).unionByName(
        split(hot_rows, partition_by, order_by, out_col, start, n))


def _split_for(groups: int):
    return _split_few_groups if groups <= FEW_GROUPS else _split


def group_hash(partition_by: list[str]) -> Column:
    """64-bit hash of a group's columns, NULLs included."""
    return F.xxhash64(*[F.col(c) for c in partition_by])


# Most items a sketch of frequent items may track (Spark's own limit).
MOST_TRACKED = 1_000_000


def heavy_groups(rows: DataFrame, partition_by: list[str], bound: int, total: int,
                 weights: DataFrame | None = None) -> tuple[DataFrame, int, int]:
    """(table of ``_hash`` and ``_rows`` of the groups with more than ``bound`` of the ``total`` rows,
    their number, their rows).

    A sketch of frequent items that tracks m of them errs by at most 3.5 * total / m, and reports
    every item above twice its error; with m = 7 * total / bound that is every group above the bound.
    It reports fewer than 2 * total / bound others as large, which the exact count then tells apart.
    Beyond ``MOST_TRACKED`` items the bound rises with the rows, to 7 millionths of them.

    ``weights`` (the group columns, ``_weight``) makes every row of a group count so often. Its
    groups are candidates too, whatever their rows, so none is missed and a heavy weight of one group
    makes no other one hot.
    """
    tracked = max(16, -(-7 * total // max(bound, 1)))
    if tracked > MOST_TRACKED:
        tracked, bound = MOST_TRACKED, max(bound, -(-7 * total // MOST_TRACKED))
    most = min(tracked, 2 * (total // max(bound, 1)) + 2)
    hashed = rows.select(group_hash(partition_by).alias("_hash"))
    named = hashed.agg(F.expr(f"approx_top_k(_hash, {most}, {tracked})").alias("top")) \
        .select(F.explode("top").alias("x")).select(F.col("x.item").alias("_hash"))
    if weights is not None:
        weighed = weights.select(group_hash(partition_by).alias("_hash"), F.col("_weight"))
        named = named.unionByName(weighed.select("_hash")).distinct()
    candidates = write_stage(named, "hot-candidates")
    sized = hashed.join(candidates, "_hash").groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    if weights is not None:
        sized = sized.join(weighed.groupBy("_hash").agg(F.sum("_weight").alias("_weight")), "_hash", "left") \
            .select("_hash", (F.col("_rows") * F.coalesce("_weight", F.lit(1))).alias("_rows"))
    hot = write_stage(sized.where(F.col("_rows") > F.lit(bound)), "hot-groups")
    found = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    return hot, int(found[0]), int(found[1])


def _sliced(rows: DataFrame, partition_by, order_by, n, positions: bool) -> DataFrame:
    """Range-partition ``rows`` on (group, order) into ``n`` slices, tag every row with its slice
    (and, with ``positions``, its position inside the sorted slice), and write the result as a
    table under the checkpoint folder. The range sample and the tags are computed once, in one
    job; every later branch reads the same files, so retries and re-reads see the same slices."""
    keys = [F.col(c).asc_nulls_first() for c in partition_by] + list(order_by)
    ranged = rows.repartitionByRange(n, *keys)
    if positions:
        # sorted inside the partition: monotonically_increasing_id = slice << 33 | position
        ranged = ranged.sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
        ranged = ranged.withColumns({SLICE: F.shiftright(F.col("_mid"), 33),
                                     "_pos": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_mid")
    else:
        ranged = ranged.withColumn(SLICE, F.spark_partition_id())
    return write_stage(ranged, "slices")


def _split(rows: DataFrame, partition_by, order_by, out_col, start, n) -> DataFrame:
    sliced = _sliced(rows, partition_by, order_by, n, positions=False)

    local_w = Window.partitionBy(*partition_by, SLICE).orderBy(*order_by)
    local = sliced.withColumn("_local", F.row_number().over(local_w))

    counts = sliced.groupBy(*partition_by, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    before_w = (Window.partitionBy(*partition_by).orderBy(SLICE) if partition_by
                else Window.orderBy(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_before", F.sum("_n").over(before_w))
               .where(F.col("_before") > 0)
               .select(*[F.col(c).alias(f"_o_{c}") for c in partition_by],
                       F.col(SLICE).alias("_o_slice"), "_before"))
    # At most one row per slice (see module doc): bounded by ``n``.
    cond = [local[SLICE] == offsets["_o_slice"]]
    cond += [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in partition_by]
    joined = local.join(F.broadcast(offsets), reduce(lambda a, b: a & b, cond), "left")
    return joined.select(
        *[local[c] for c in rows.columns],
        (F.col("_local") + F.coalesce(F.col("_before"), F.lit(0)) + F.lit(start - 1))
        .cast("long").alias(out_col),
    )


def _split_few_groups(rows: DataFrame, partition_by, order_by, out_col, start, n) -> DataFrame:
    """The split plan for inputs with few groups (the hot groups, or one global group), with a
    single full shuffle: the range exchange.

    Each range partition is one slice, sorted within itself, so every row gets its slice and its
    position in the slice in the same job (``_sliced``), with no second shuffle. A row's number
    is its position minus the first position of its group in the slice, plus the group's rows in
    earlier slices; those two come from an aggregation per (group, slice) with at most
    ``groups + slices`` rows, a bounded table that is broadcast.
    """
    sliced = _sliced(rows, partition_by, order_by, n, positions=True)
    stats = sliced.groupBy(*partition_by, SLICE).agg(F.min("_pos").alias("_first"),
                                                     F.count(F.lit(1)).alias("_n"))
    before_w = (Window.partitionBy(*partition_by).orderBy(SLICE) if partition_by
                else Window.orderBy(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(*[F.col(c).alias(f"_o_{c}") for c in partition_by],
                         F.col(SLICE).alias("_o_slice"), "_first",
                         F.coalesce(F.sum("_n").over(before_w), F.lit(0)).alias("_before"))
    cond = [sliced[SLICE] == stats["_o_slice"]]
    cond += [sliced[c].eqNullSafe(stats[f"_o_{c}"]) for c in partition_by]
    joined = sliced.join(F.broadcast(stats), reduce(lambda a, b: a & b, cond), "inner")
    return joined.select(
        *[sliced[c] for c in rows.columns],
        (F.col("_pos") - F.col("_first") + F.col("_before") + F.lit(start)).cast("long").alias(out_col),
    )
