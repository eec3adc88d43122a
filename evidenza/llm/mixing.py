"""Mixing sources to target weights, in DataFrame functions only.

Each source's documents are laid end to end and cut into blocks of
``BLOCK_WORDS`` words.  A source's share of the output is its quota of slots, one block each; the
output is cut into shards of ``SHARD_SLOTS`` slots.  The number of slots that each source has in
each shard is drawn multinomially under the condition that all shards together meet the
quotas: a keyed permutation deals all slots to places, and a shard's counts are what it is
dealt.  (Free draws would miss small targets and run over the limit of three uses.)  A
source's slots are numbered through its shards, by those counts.  Slot k of a source takes the
block at its pseudorandom index: every pass over the source is one permutation of its
blocks, and the last pass is a part of one, whose last block is cut so that the source gives
its target to the word.  Blocks and documents meet in an equi-join on (source, block).

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating; a
target stops at ``REPEATS`` times its source's words and the rest is shared again
by weight.  A document's words all lie in one block each, so none is used more
than ``REPEATS`` times.

Bounds: targets are settled by windows over one narrow row per source, in one task, since
each depends on all others; documents are laid out in groups of about ``GROUP_DOCS``, and
slots are numbered in groups of ``GROUP_SHARDS`` shards.

Defined cases: a null or empty text has size 0 and takes nothing; a null source
is a source; rows that repeat a doc_id are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.llm.storage import written

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
SEED = 7
ROUNDS = 24
#: Documents laid out by one window; a source may have any number of such groups.
GROUP_DOCS = 1_000
#: Shards whose counts of one source are added up by one window.
GROUP_SHARDS = 4_096
#: Slots that one row of the plan expands to.
RANGE_SLOTS = 8192


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def shuffled(index: Column, size: Column, *key, inverse: bool = False) -> Column:
    """Image of ``index`` under a keyed permutation of 0 .. size-1.

    Swap-or-not rounds: each round pairs x with K - x and swaps by one hashed bit
    of the pair, so it is one-to-one for every size, and undone by the same rounds backwards.
    """

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), size) - x, size)
        # the bit depends on the pair only, so both of its members swap or neither
        bit = F.xxhash64(r, F.greatest(x, mirror), *key).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirror).otherwise(x)

    first, last = (ROUNDS, 1) if inverse else (1, ROUNDS)
    rounds = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))
    return F.aggregate(rounds, index.cast("bigint"), step)


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources at their limit are those with the least limit per weight; the first
    one, in that order, whose limit exceeds its share of what is left ends them.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    picks = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weight = F.element_at(picks, ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    limit = (F.col("source_size") * REPEATS).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("limit", limit)
    near = W.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = near.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    rows = rows.withColumn("rate", (
        F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(near.rowsBetween(0, W.unboundedFollowing)))
    free = F.col("limit") >= F.col("rate") * F.col("weight")
    level = F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"), F.col("rate")))).over(everything)["rate"]
    capped = F.coalesce(F.least(F.col("limit"), level * F.col("weight")), F.col("limit"))
    return rows.select("source", "source_size", capped.alias("target"))


def layout(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, start)``: the word offset of each document in its source."""
    # the hash of the text tells rows apart that share a doc_id, or have none
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"))
    rows = written(rows, "sizes")
    groups = -(-rows.count() // GROUP_DOCS) or 1
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size", "text_key"), F.lit(groups)))
    local = W.partitionBy("source", "part").orderBy("doc_id", "size", "text_key").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("source", "part").agg(F.sum("size").alias("words")).select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")
    )
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(local), F.lit(0)))
    return placed.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "source", "size", (F.col("start") + F.col("base")).alias("start")
    )


def quotas(goals: DataFrame) -> DataFrame:
    """Blocks of each source, the slots it gets, the words of its last slot, and its first place of all.

    A source has ``passes`` whole passes and ``rest`` words of one more.  Its short last block may
    come early in that pass; then a slot more is needed.
    """
    size = F.col("source_size")
    blocks = F.ceil(size / BLOCK_WORDS)
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint")
    rows = goals.select("source", "source_size", "target", blocks.alias("blocks"), passes.alias("passes"))
    rest = F.least(F.round(F.col("target") - F.col("passes") * size).cast("bigint"), size)
    full = rest == size
    rows = rows.withColumns({
        "passes": F.least(F.col("passes") + full.cast("bigint"), F.lit(REPEATS).cast("bigint")),
        "rest": F.when(full | (F.col("passes") >= REPEATS), 0).otherwise(rest),
        "tail": size - (F.col("blocks") - 1) * BLOCK_WORDS,
    })
    turned = shuffled(F.col("blocks") - 1, F.col("blocks"), F.col("source"), F.col("passes"), inverse=True)
    rows = rows.withColumn("place", F.when(F.col("blocks") > 0, turned))  # of the short block in the last pass
    whole = F.ceil(F.col("rest") / BLOCK_WORDS)
    early = F.col("place") < whole
    some = F.when(early, F.ceil((F.col("rest") - F.col("tail")) / BLOCK_WORDS) + 1).otherwise(whole)
    rows = rows.withColumn("some", F.when(F.col("rest") == 0, 0).otherwise(F.greatest(some, F.lit(1))))
    ahead = (F.col("some") - 1) * BLOCK_WORDS - F.when(F.col("place") < F.col("some") - 1, BLOCK_WORDS - F.col("tail")).otherwise(0)
    rows = rows.withColumns({
        "slots": (F.col("passes") * F.col("blocks") + F.col("some")).cast("bigint"),
        "cut": F.when(F.col("some") > 0, F.col("rest") - ahead),
    })
    order = W.orderBy(F.col("source").asc_nulls_last())
    return rows.withColumn(
        "first", F.coalesce(F.sum("slots").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("deck", F.sum("slots").over(W.partitionBy())).drop("passes", "rest", "tail", "place", "some")


def _ranges(plan: DataFrame, first: Column, count: str, *keys: str) -> DataFrame:
    """Rows with ``low`` and ``high`` (exclusive) of at most ``RANGE_SLOTS``: few short rows that expand to many."""
    # a fixed number of partitions, or the ranges would be merged into one
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = plan.where(F.col(count) > 0).withColumn(
        "r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / RANGE_SLOTS)))
    )
    low = first + F.col("r") * RANGE_SLOTS
    return cut.withColumns(
        {"low": low, "high": F.least(low + RANGE_SLOTS, first + F.col(count))}
    ).repartition(tasks, *keys, "r")


def draw(plan: DataFrame) -> DataFrame:
    """``(source, shard, n)``: how many slots of each shard a source is given."""
    cut = _ranges(plan, F.lit(0).cast("bigint"), "slots", "source")
    slots = cut.select("source", "first", "deck", F.explode(F.sequence("low", F.col("high") - 1)).alias("k"))
    place = shuffled(F.col("first") + F.col("k"), F.col("deck"))
    return slots.select("source", F.floor(place / SHARD_SLOTS).alias("shard")).groupBy("source", "shard").agg(F.count("*").alias("n"))


def numbered(counts: DataFrame) -> DataFrame:
    """``(source, shard, n, k)`` with the number k of a source's first slot in the shard."""
    group = F.floor(F.col("shard") / GROUP_SHARDS)
    rows = counts.withColumn("group", group)
    before = W.partitionBy("source").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("source", "group").agg(F.sum("n").alias("all")).select(
        F.col("source").alias("s"), F.col("group").alias("g"), F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base")
    )
    local = W.partitionBy("source", "group").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("here", F.coalesce(F.sum("n").over(local), F.lit(0)))
    return placed.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("group") == F.col("g"))).select(
        "source", "shard", "n", (F.col("base") + F.col("here")).alias("k")
    )


def deal(plan: DataFrame) -> DataFrame:
    """``(source, block, shard, cut)``: one row per slot of the output; ``cut`` is null, or the words that it takes
    of its block."""
    shares = numbered(written(draw(plan), "draws")).withColumnRenamed("source", "s")
    met = shares.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "shard", "k", "n", "blocks", "slots", F.col("cut").alias("last")
    )
    slots = _ranges(met, F.col("k"), "n", "source", "shard").select(
        "source", "shard", "blocks", "slots", "last", F.explode(F.sequence("low", F.col("high") - 1)).alias("k")
    )
    turn = F.floor(F.col("k") / F.col("blocks"))
    block = shuffled(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("source"), turn)
    return slots.select("source", block.alias("block"), "shard", F.when(F.col("k") == F.col("slots") - 1, F.col("last")).alias("cut"))


def pieces(rows: DataFrame) -> DataFrame:
    """The part of a document in each block: ``from_word`` and ``words`` beside its row."""
    first = F.floor(F.col("start") / BLOCK_WORDS)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS)
    cut = rows.where("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("block") * BLOCK_WORDS, F.col("start"))
    high = F.least((F.col("block") + 1) * BLOCK_WORDS, F.col("start") + F.col("size"))
    return cut.select("*", (low - F.col("start")).alias("from_word"), (high - low).alias("words"))


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Layout of the documents, targets of the sources, and the slots of the output."""
    rows = written(layout(docs), "layout")
    goals = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    return rows, goals, deal(written(quotas(goals), "quotas"))


def _in_cut(cut: str) -> Column:
    """Words of a piece that lie in the first ``cut`` words of its block."""
    offset = (F.col("start") + F.col("from_word")) % BLOCK_WORDS
    return F.greatest(F.least(F.col("words"), F.col(cut) - offset), F.lit(0))


def mixed_pieces(docs: DataFrame) -> DataFrame:
    """The mix itself: ``(shard, source, block, doc_id, from_word, words)``."""
    rows, _, slots = mix(docs)
    slots = slots.toDF("s", "b", "shard", "cut").hint("merge")
    met = pieces(rows).join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    met = met.withColumn("words", F.when(F.col("cut").isNull(), F.col("words")).otherwise(_in_cut("cut"))).where("words > 0")
    return met.select("shard", "source", "block", "doc_id", "from_word", "words")


def mixed_words(docs: DataFrame) -> DataFrame:
    """A row per document: size, source_size, target, taken, first output shard."""
    rows, goals, slots = mix(docs)
    uses = slots.groupBy("source", "block").agg(
        F.count_if(F.col("cut").isNull()).alias("uses"), F.max("cut").alias("cut"),
        F.min(F.when(F.col("cut").isNull(), F.col("shard"))).alias("shard"), F.min(F.when(F.col("cut").isNotNull(), F.col("shard"))).alias("cut_shard"),
    )
    # sizes are estimated from the few rows of the plan, so a broadcast must be ruled out
    uses = uses.toDF("s", "b", "uses", "cut", "shard", "cut_shard").hint("merge")
    met = pieces(rows).join(uses, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    part = F.when(F.col("cut").isNotNull(), _in_cut("cut")).otherwise(0)  # least() skips nulls
    met = met.withColumns({
        "got": F.coalesce(F.col("words") * F.col("uses"), F.lit(0)) + part,
        "in_shard": F.least("shard", F.when(part > 0, F.col("cut_shard"))),
    })
    # a source has one document with words at each offset
    taken = met.groupBy("source", "start", "doc_id", "size").agg(
        F.sum("got").cast("bigint").alias("taken"), F.min("in_shard").alias("first_shard"),
    )
    empty = rows.where("size = 0").withColumns(
        {"taken": F.lit(0).cast("bigint"), "first_shard": F.lit(None).cast("bigint")}
    )
    goals = goals.toDF("g", "source_size", "target")
    return taken.unionByName(empty).join(goals, F.col("source").eqNullSafe(F.col("g"))).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "first_shard"
    )
