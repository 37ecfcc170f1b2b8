"""Mixing sources to target weights by exact block quotas, split among shards by hypergeometric draws.

DataFrame operations only. Documents fall by a hash of their key into one of 65,536
cells of their source, and every decision is made on the sums of cells, so planning
costs the same whatever the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import col, discard, free_name, n_words, store
from ledgermill.operators.prefix import BEFORE, RANGE, before_ranges, dense_ids, in_ranges, running_total

CELLS = 1 << 16
WEIGHTS = (5, 2, 1)  # of sources in code-point order, repeating
SEND = 200_000  # rows of a plan table that are broadcast; a larger one is joined by shuffle


def hashed(*parts: Column | str | int) -> Column:
    """16 hash bits of the parts as text, the same in any SQL engine that has md5."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int")


def who(key: str, text: str) -> Column:
    """What tells documents apart: the key, or a digest of the text where that is null."""
    return F.coalesce(col(key).cast("string"), F.md5(col(text).cast("binary")), F.lit(""))


def cell(key: str, text: str, seed: int) -> Column:
    """A document's cell in its source."""
    return hashed(seed, who(key, text))


def turn_of(seed: int, turn: Column, document: Column) -> Column:
    """The place of a copy in its shard's local shuffle: 60 hash bits."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit("shuffle"), turn, document)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], ceiling: float) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of the whole by weight, none above ``ceiling`` times its size.

    The excess of sources at their ceiling goes to the others by weight. Sorted by the
    level at which a source reaches its ceiling, those are a prefix. Sources are ranked
    and summed up by ranges, so there may be as many as there are hosts.
    """
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    named = dense_ids(sources, "source", "rank").withColumnRenamed("source", "named")
    ranked = sources.join(named, F.col("source") == F.col("named"), "left").drop("named")
    last = ranked.filter("source IS NOT NULL").count()  # null comes after all names
    turn = F.coalesce("rank", F.lit(last)) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    most = (F.col("source_size") * ceiling).cast("double")
    ranked = ranked.withColumns({"weight": weight, "most": most})
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    summed = running_total(running_total(ranked, order, "most", "most_upto"), order, "weight", "weight_upto")
    all_weight = float(ranked.agg(F.sum("weight")).first()[0] or 0)
    before = F.col("most_upto") - F.col("most")
    level = (F.lit(total) - before) / (F.lit(all_weight) - F.col("weight_upto") + F.col("weight"))
    summed = summed.withColumn("capped", F.col("most") / F.col("weight") <= level)
    found = summed.agg(F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("spare"), F.sum(F.when(F.col("capped"), F.col("most"))).alias("full"))
    spare, full = found.first() or (None, None)
    shared = F.col("weight") * F.lit(total - (full or 0.0)) / F.lit(spare)
    return summed.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(shared).alias("target"))


@dataclass
class Mix:
    """A plan: ``sources`` (source, source_size, target, blocks) and ``drawn`` (source, block, copies).

    ``copies`` holds (pass, shard, upto) of each time the block is drawn; a block that the
    target cuts through is drawn up to a cell only.
    """

    sources: DataFrame
    drawn: DataFrame
    seed: int

    def place(self, docs: DataFrame, at: str, source: str, out: str) -> DataFrame:
        """Add ``out``, an array of (pass, shard), to every row; ``at`` is the column with its cell."""
        s, block, copies = (free_name(docs, n) for n in ("mix_source", "mix_block", "mix_copies"))
        blocks = free_name(docs, "mix_blocks")
        of_source = self.sources.select(F.col("source").alias(s), F.col("blocks").alias(blocks))
        placed = docs.join(small(of_source), col(source).eqNullSafe(F.col(s)), "left")
        placed = placed.withColumn(block, block_of(F.col(at), F.col(blocks))).drop(s)
        drawn = self.drawn.select(F.col("source").alias(s), F.col("block").alias("of_" + block), F.col("copies").alias(copies))
        placed = placed.join(small(drawn), col(source).eqNullSafe(F.col(s)) & (F.col(block) == F.col("of_" + block)), "left")
        taken = F.filter(F.coalesce(F.col(copies), F.array()), lambda c: F.col(at) < c["upto"])
        return placed.withColumn(out, F.transform(taken, lambda c: F.struct(c["pass"], c["shard"]))).drop(
            s, block, "of_" + block, copies, blocks
        )


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint for a stored plan table, if it is small."""
    return F.broadcast(df) if df.limit(SEND + 1).count() <= SEND else df


def block_of(at: Column, blocks: Column) -> Column:
    return F.floor(at.cast("long") * blocks / F.lit(CELLS)).cast("int")


def plan(
    sized: DataFrame, shards: int, seed: int, blocks: int = 2048, weights: tuple[float, ...] = WEIGHTS, ceiling: int = 3
) -> Mix:
    """Decide what to draw from ``sized`` (source, cell, size), for ``shards`` output shards.

    A source is cut into blocks of consecutive cells, about ``blocks`` in all and at least
    one each, so blocks hold about equally many words. A source's quota is as many whole
    passes over its blocks as fit its target, then blocks in a permuted order; the block
    that the target falls into is cut between two cells, at the nearer one. Equal seeds
    give equal plans on any cluster.
    """
    cells = store(sized.groupBy("source", "cell").agg(F.sum("size").alias("size")), "mix_cells")
    sources = targets(cells.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ceiling)
    everything = cells.agg(F.sum("size")).first()[0] or 0
    share = F.col("source_size") / F.nullif(F.lit(everything).cast("long"), F.lit(0).cast("long"))
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(ceiling), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    sources = store(
        sources.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(CELLS), F.coalesce(F.round(share * blocks), F.lit(1)))).cast("int"))
        .withColumn("passes", passes.cast("int"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix_sources",
    )
    named = cells.withColumnRenamed("source", "s")
    at = named.join(small(sources), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    at = at.withColumn("block", block_of(F.col("cell"), F.col("blocks")))
    # Blocks in permuted order, and the cells of the last, partly drawn one.
    turn = [hashed(seed, "turn", F.coalesce("source", F.lit("\0")), F.col("block")), F.col("block")]
    per_block = at.groupBy("source", "block", "passes", "rest").agg(F.sum("size").alias("size"))
    before = F.sum("size").over(Window.partitionBy("source").orderBy(*turn)) - F.col("size")
    per_block = store(per_block.withColumn("left", F.col("rest") - before), "mix_blocks")
    whole = (F.col("left") >= F.col("size")) & (F.col("size") > 0)
    parted = per_block.filter("left > 0 AND left < size").select(F.col("source").alias("s"), F.col("block").alias("b"), "left")
    inside = at.join(small(parted), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("cell"))
    inside = inside.withColumn("before", run - F.col("size")).filter(F.col("before") + F.col("size") / 2 <= F.col("left"))
    cut = inside.groupBy("source", "block").agg((F.max("cell") + 1).alias("upto"))
    times = F.col("passes") + F.when(whole, 1).otherwise(0)
    full = per_block.select("source", "block", times.alias("times"), F.explode(F.sequence(F.lit(0), F.lit(ceiling))).alias("pass"))
    full = full.filter("pass < times").select("source", "block", "pass", F.lit(CELLS).alias("upto"))
    part = per_block.select(F.col("source").alias("s"), F.col("block").alias("b"), "passes").join(
        cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    )
    balls = full.unionByName(part.select("source", "block", F.col("passes").alias("pass"), "upto"))
    drawn = split(balls, shards, seed).groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "upto"))).alias("copies")
    )
    mix = Mix(sources, store(drawn, "mix_drawn"), seed)
    discard(cells, per_block)
    return mix


def split(balls: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal drawn blocks to shards down a binary tree; every node's left part is a multivariate hypergeometric draw.

    A node's blocks lie in an urn, in random order; the left child gets its exact share of
    them from the top, which draws its quota of each source at once. The urns of a level
    are ordered by ranges: places are counted inside each range and from range to range,
    so no task holds an urn.
    """
    state = balls.withColumns({"low": F.lit(0), "high": F.lit(shards)})
    for level in range(max(1, shards - 1).bit_length()):
        order = hashed(seed, "urn", level, F.coalesce("source", F.lit("\0")), F.col("block"), F.col("pass"))
        by = [F.col(c) for c in ("low", "order", "source", "block", "pass")]
        ranged = in_ranges(state.withColumn("order", order), by)
        held = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_total"))
        inside = F.row_number().over(Window.partitionBy(RANGE).orderBy(*by))
        # Where each urn begins, from one row a node of the level: at most as many as shards.
        urns, begins, at = ranged.groupBy("low").count().collect(), {}, 0
        for low, n in sorted((r["low"], r["count"]) for r in urns):
            begins[low] = (at, n)
            at += n
        begin = F.element_at(F.create_map(*[F.lit(x) for low, (at, _) in begins.items() for x in (low, at)]), F.col("low")) if begins else F.lit(0)
        size = F.element_at(F.create_map(*[F.lit(x) for low, (_, n) in begins.items() for x in (low, n)]), F.col("low")) if begins else F.lit(0)
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        mine = F.floor(size * (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low")))
        state = (
            ranged.withColumn("place", inside)
            .join(before_ranges(held, "_total"), RANGE)
            .withColumn("middle", middle)
            .withColumn("left", F.col("place") + F.col(BEFORE) - begin <= mine)
            .withColumns(
                {
                    "low": F.when(F.col("left"), F.col("low")).otherwise(F.col("middle")),
                    "high": F.when(F.col("left"), F.greatest("middle", F.col("low") + 1)).otherwise(F.col("high")),
                }
            )
            .select(*state.columns)
        )
    return state.withColumnRenamed("low", "shard").drop("high")


def sizes(docs: DataFrame, *, key: str, source: str, text: str, seed: int) -> DataFrame:
    """(key, source, cell, size, digest) of every row, stored: the one pass over the texts. ``digest`` stands in for a null key."""
    slim = docs.select(
        col(key).alias("key"),
        col(source).cast("string").alias("source"),
        cell(key, text, seed).alias("cell"),
        n_words(col(text)).alias("size"),
        F.when(col(key).isNull(), who(key, text)).alias("digest"),
    )
    return store(slim, "mix_sizes")


def mix_report(
    docs: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = 8, seed: int = 1
) -> DataFrame:
    """What the mix takes of every document: (key, size, source_size, target, taken, shards, turns).

    ``size`` counts words (null text: 0), ``taken`` the words drawn, repeats counted;
    ``shards`` lists where the copies go, pass by pass, and ``turns`` where each stands in
    its shard's local shuffle. Defined as in ``mix_sources``.
    """
    slim = sizes(docs, key=key, source=source, text=text, seed=seed)
    mix = plan(slim, shards, seed)
    placed = mix.place(slim, "cell", "source", "copies")
    of_source = mix.sources.select(F.col("source").alias("s"), "source_size", "target")
    placed = placed.join(small(of_source), F.col("source").eqNullSafe(F.col("s")))
    return placed.select(
        F.col("key").alias(key),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("copies")).cast("long").alias("taken"),
        F.col("copies.shard").alias("shards"),
        F.transform("copies", lambda c: turn_of(seed, c["pass"], F.coalesce(F.col("key").cast("string"), F.col("digest")))).alias("turns"),
    )


def mix_sources(
    docs: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = 8, seed: int = 1
) -> DataFrame:
    """``docs`` as the mix: a row for every copy drawn, with its ``shard``, ``pass`` and ``turn``.

    Sources, in code-point order with null last, weigh 5, 2, 1, repeating. Together they
    give as many words as there are; no source gives more than three times its own, and
    what that leaves goes to the others by weight. A document comes at most three times.
    Ordering a shard by ``turn`` is its local shuffle, done by ``in_shards``. Documents without words weigh
    nothing and are drawn with their block; a source without any words is not drawn.
    Repeated rows share a cell and are drawn alike. Texts of any length count as a whole.
    Empty input gives no rows. Columns that have the result names already are replaced.
    """
    docs = docs.drop("shard", "pass", "turn")
    slim = sizes(docs, key=key, source=source, text=text, seed=seed)
    mix = plan(slim, shards, seed)
    at, copies = free_name(docs, "mix_cell"), free_name(docs, "mix_drawn")
    placed = mix.place(docs.withColumn(at, cell(key, text, seed)), at, source, copies)
    copy = free_name(placed, "mix_copy")
    turn = turn_of(seed, F.col(copy)["pass"], who(key, text))
    return placed.withColumn(copy, F.explode(copies)).select(
        *[col(c) for c in docs.columns], F.col(copy)["shard"].alias("shard"), F.col(copy)["pass"].alias("pass"), turn.alias("turn")
    )


def in_shards(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix_sources`` as they are to be written: shard after shard, each in its shuffled order.

    The range exchange cuts large shards into several files that follow one another.
    """
    order = ["shard", "turn"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)
