"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.session import durable

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of a block.
BLOCK = 256
#: Documents of a run within a source, and slots of a run of the schedule, on average.
RUN = 4096
SLOTS = 1 << 16
#: Cells of the unit interval by which points meet the sources' shares.
CELLS = 1 << 12
#: Points are whole multiples of 2**-40; the step is the golden ratio, made odd.
UNIT = 1 << 40
STEP = round(UNIT * (5**0.5 - 1) / 2) | 1


def sized(docs: DataFrame, text_col: str) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float, repeats: int, weights: tuple[float, ...]) -> DataFrame:
    """``source, source_no, n_docs, source_size, target`` by source from ``source, size``.

    Sources in order of code point, null last, have the weights in turn. They
    share ``share`` times all words; what a source cannot take, as it stops at
    ``repeats`` times its size, is reshared by weight. Sources by the ratio of
    that limit to their weight are full up to some point and below it after, so
    running sums over the sources give the level that is right.
    """
    found = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.col("source_no") % len(weights)).cast("int")
    weighed = found.withColumn("source_no", F.row_number().over(order).cast("long") - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    )
    limit = (F.col("source_size") * repeats).cast("double")
    by_ratio = Window.orderBy(limit / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        limit.alias("limit"),
        (F.sum("source_size").over(everything) * share).alias("goal"),
        F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("filled"),
        F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    )
    # The level of a source if all before it are full; a source is full when its limit lies below.
    level = (F.col("goal") - F.col("filled")) / F.col("open")
    full = F.col("limit") <= level * F.col("weight")
    judged = levels.withColumn("level", level).withColumn("full", full)
    first_open = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("full") | first_open.isNull(), F.col("limit")).otherwise(first_open * F.col("weight"))
    return judged.withColumn("target", target).select("source", "source_no", "n_docs", "source_size", "target")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    repeats: int = 2,
    weights: tuple[float, ...] = WEIGHTS,
    block: int = BLOCK,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' part in the mix, the pieces of blocks, and the schedule of blocks.

    Documents of a source are shuffled by a hash and lie end to end; every
    ``block`` words are a block, the last of a source is shorter. The schedule
    maps golden-ratio points through the sources' cumulative shares; the slot
    of rank ``r`` of a source holds its block ``r`` modulo its number of blocks,
    so every block comes once before any comes twice. A source has exactly the
    slots that its target asks for: points beyond are left out, and slots that
    the points fall short of, a few per source, close the schedule.

    Returns
    * documents: ``id_col, size, source_size long, target double, taken long``,
      a row for each row of ``docs``; ``taken`` counts the words that the mix
      takes of it, repeats included, never above ``repeats`` times its size;
    * pieces: ``source_no, block, id, first_word, words``;
    * schedule: ``slot, source_no, block, words``, in order of ``slot``.

    A null text has size zero, a null source is a source of its own. Documents
    without words, repeated ids and repeated rows keep their row; equal rows
    are told apart by their place in the shuffled order only. Other columns are
    not looked at. No rows or no words at all: empty pieces and schedule.
    """
    base = durable(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            sized(docs, text_col).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col)).alias("mixed"),
        )
    )
    sources = durable(targets(base, share, repeats, weights))
    placed = durable(_placed(base, sources))
    quota = F.floor(F.col("target")).cast("long")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    rest = quota - F.floor(quota / F.col("source_size")) * F.col("source_size")
    plan = sources.where("source_size > 0").select(
        "source_no",
        "source_size",
        quota.alias("quota"),
        blocks.alias("blocks"),
        (F.floor(quota / F.col("source_size")) * blocks + F.ceil(rest / block)).cast("long").alias("slots"),
    )
    schedule = durable(_schedule(plan, block))
    pieces = _pieces(placed, block)
    taken = _taken(schedule, pieces)
    row = ["source_no", "run", "place"]
    result = (
        placed.join(sources.select("source_no", "source_size", "target"), "source_no")
        .join(taken, row, "left")
        .select(
            F.col("id").alias(id_col),
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
    return result, pieces.select("source_no", "block", "id", "first_word", "words"), schedule.select(
        "slot", "source_no", "block", "words"
    )


def _placed(base: DataFrame, sources: DataFrame) -> DataFrame:
    """Where each document begins among the words of its source.

    Runs of a source, as many as its documents ask for, are summed one by one
    and then among each other, so no task holds a whole source.
    """
    unit = F.col("mixed").bitwiseAND(F.lit((1 << 40) - 1))
    numbered = base.join(
        sources.select(F.col("source").alias("of"), "source_no", "n_docs"), F.col("source").eqNullSafe(F.col("of"))
    )
    run = F.floor(unit * F.ceil(F.col("n_docs") / RUN) / F.lit(float(1 << 40))).cast("long")
    runs = numbered.select("id", "size", "mixed", "source_no", unit.alias("unit"), run.alias("run"))
    within = Window.partitionBy("source_no", "run").orderBy("unit", "mixed", "id", "size")
    sums = Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        runs.groupBy("source_no", "run")
        .agg(F.sum("size").alias("total"))
        .select("source_no", "run", F.coalesce(F.sum("total").over(sums), F.lit(0)).alias("before"))
    )
    own = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = runs.select("source_no", "run", F.row_number().over(within).alias("place"), "id", "size", own.alias("own"))
    return local.join(before, ["source_no", "run"]).select(
        "source_no", "run", "place", "id", "size", (F.col("before") + F.col("own")).alias("start")
    )


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """The parts of documents that blocks are made of; ``at`` is a part's place in its block."""
    end = F.col("start") + F.col("size")
    spread = placed.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    )
    first = F.greatest(F.col("start"), F.col("block") * block)
    last = F.least(end, (F.col("block") + 1) * block)
    return spread.select(
        "source_no",
        "run",
        "place",
        "id",
        "block",
        (first - F.col("block") * block).alias("at"),
        (first - F.col("start")).alias("first_word"),
        (last - first).alias("words"),
    )


def _schedule(plan: DataFrame, block: int) -> DataFrame:
    """A slot for every block that a source's quota asks for, in the order of the mix."""
    spark = plan.sparkSession
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    ordered = Window.orderBy("source_no")  # one row per source
    edges = plan.select("*", F.sum("slots").over(ordered).alias("upto")).select(
        "*",
        F.floor((F.col("upto") - F.col("slots")) * (UNIT / max(total, 1))).alias("low"),
        F.when(F.col("upto") == total, F.lit(UNIT)).otherwise(F.floor(F.col("upto") * (UNIT / max(total, 1)))).alias("high"),
    )
    width = UNIT // CELLS
    cells = edges.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    ).where("slots > 0 AND high > low")
    # slot * STEP modulo UNIT in two steps that stay within a long.
    chunk, rest = F.floor(F.col("id") / SLOTS).cast("long"), F.col("id") % SLOTS
    leap = STEP * SLOTS % UNIT
    point = ((chunk * F.lit(leap)) % UNIT + (rest * F.lit(STEP)) % UNIT) % UNIT
    parts = max(1, min(total // SLOTS + 1, 1 << 17))
    points = spark.range(0, total, 1, parts).select(
        F.col("id").alias("slot"), chunk.alias("chunk"), point.alias("point")
    )
    drawn = points.withColumn("cell", F.floor(F.col("point") / width)).join(
        cells.select("cell", "low", "high", "source_no"), "cell"
    ).where("point >= low AND point < high")
    drawn = drawn.select("slot", "chunk", "source_no")
    # Ranks: within a run of the schedule, and runs before it.
    run = Window.partitionBy("chunk", "source_no").orderBy("slot")
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = drawn.withColumn("own", F.row_number().over(run) - 1).join(before, ["source_no", "chunk"])
    ranked = ranked.select("slot", "source_no", (F.col("before") + F.col("own")).alias("rank"))
    drawn_of = counts.groupBy("source_no").agg(F.sum("n").alias("drawn"))
    short = plan.join(drawn_of, "source_no", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    short = short.where("drawn < slots")
    left = F.sum(F.col("slots") - F.col("drawn")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    closing = short.select("*", F.coalesce(left, F.lit(0)).alias("left")).select(
        "source_no", "drawn", "left", F.explode(F.sequence(F.col("drawn"), F.col("slots") - 1)).alias("rank")
    ).select((total + F.col("left") + F.col("rank") - F.col("drawn")).alias("slot"), "source_no", "rank")
    every = ranked.union(closing).join(plan, "source_no").where("rank < slots")
    at = F.col("rank") % F.col("blocks")
    done = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + at * block
    whole = F.least(F.lit(block).cast("long"), F.col("source_size") - at * block)
    return every.select(
        "slot", "source_no", at.alias("block"), F.least(whole, F.col("quota") - done).cast("long").alias("words")
    )


def _taken(schedule: DataFrame, pieces: DataFrame) -> DataFrame:
    """Words taken of each document, over all uses of its blocks."""
    used = F.greatest(F.lit(0), F.least(F.col("words"), F.col("slot_words") - F.col("at")))
    uses = schedule.select("source_no", "block", F.col("words").alias("slot_words"))
    return (
        pieces.join(uses, ["source_no", "block"])
        .groupBy("source_no", "run", "place")
        .agg(F.sum(used).alias("taken"))
    )
