"""Source divergence audit: how the word use of each source departs from that of its language.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased.  A language keeps
the terms that occur in at least ``MIN_DOCS`` of its documents; every (lang, source)
group and every language gives each kept term a smoothed share in billionths, all in
whole numbers.  Two rankings come out of it:

* ``pair``: for each group the other sources of its language by the sum of the absolute
  differences of all shares.  Terms fall into blocks and sources into tiles; a cell of
  (block, two tiles) is one dense matrix of bounded size, and cells are summed.
* ``term``: for each group the terms that it uses more than its language does.  The
  difference never falls with a higher group count or a lower count in the language, and
  ties go to the earlier term in UTF-8.  A term that ``TOP`` others dominate in these three
  cannot be among the first ``TOP``, so every partition of a group keeps its skyband
  (terms dominated by fewer than ``TOP`` others), skybands are merged, and what is left is
  ranked exactly.

Counting: each task sums its own texts before anything is shuffled, and gives up its
sums after ``FLUSH_BYTES`` of text.  A group of any size is cut into partitions of about
``PART_TERMS`` terms by the hash of the term; narrow tables meet hot groups by salted joins.

Defined cases: null text, lang and source are read as ''; each row is a document, also if
rows share a doc_id; a group without kept terms still is a group; a language without kept
terms has pairs of value 0 and no term rows; a language with one source has no pairs; an
empty table has no rows.  Columns besides text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.llm.storage import written
from evidenza.operators.spread import join_spread

MIN_DOCS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
#: Text that a task sums up before it hands its counts on.
FLUSH_BYTES = 16 << 20
#: Terms of a group that one skyband is taken of.
PART_TERMS = 16_384
#: A cell holds this many terms of at most twice this many sources.
BLOCK_TERMS = 512
TILE_SOURCES = 64
#: A longer text is cut, between terms, into pieces of about this size.
PIECE_BYTES = 4 << 20
ROWS_OUT = 20_000

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
BAND = "lang string, source string, term string, g bigint, l bigint, value bigint"
SUMS = "lang string, source string, item string, value bigint"

_TERM_BYTES = bytes(c if c >= 0x80 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    plain = text.lower().translate(_TERM_BYTES)  # bytes lower-case A-Z alone
    start = 0
    while start < len(plain):
        stop = start + PIECE_BYTES
        if stop < len(plain):
            gap = plain.find(b" ", stop)
            stop = len(plain) if gap < 0 else gap
        yield plain[start:stop].split()
        start = stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, tuple[Counter, Counter]] = {}
    groups: Counter = Counter()
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(*key, None, 0, n) for key, n in groups.items()]
        for key, (n, docs) in held.items():
            for term, count in n.items():
                rows.append((*key, term, count, docs[term]))
                if len(rows) >= ROWS_OUT:
                    yield out(rows)
                    rows = []
        if rows:
            yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        lang, source, term, n, docs = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
             pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            ["lang", "source", "term", "n", "docs"],
        )

    for batch in batches:
        keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for key, text in zip(keys, batch.column("text").cast(pa.binary()), strict=True):
            groups[key] += 1
            raw = text.as_py()
            n, docs = held.setdefault(key, (Counter(), Counter()))
            seen: set[bytes] = set()
            for words in terms(raw):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(raw)
            if size >= FLUSH_BYTES:
                yield from flush()
                held, groups, size = {}, Counter(), 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents; term is null for the group itself."""
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = rows.mapInArrow(_count, COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> F.Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * kept)), exactly."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {SMOOTHING} AS DECIMAL(20, 0)))"
        f" DIV CAST({total} + {SMOOTHING} * {kept} AS DECIMAL(20, 0))"
    )


def skyband(g: np.ndarray, l: np.ndarray, names: list[str], k: int = TOP, block: int = 256) -> np.ndarray:
    """Positions of the terms that fewer than ``k`` others dominate, best first.

    In the order (g down, l up, name up) whatever dominates a term comes before it.  Counting
    only kept terms is enough: of the dominators of a term, the first k in this order are kept.
    """
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort((rank, l, -g))
    l, rank = l[order], rank[order]
    kept = np.empty(0, np.int64)
    for start in range(0, len(order), block):
        here = np.arange(start, min(start + block, len(order)))
        before = (l[kept] <= l[here][:, None]) & (rank[kept] < rank[here][:, None])
        among = (l[here] <= l[here][:, None]) & (rank[here] < rank[here][:, None]) & (here < here[:, None])
        kept = np.r_[kept, here[before.sum(axis=1) + among.sum(axis=1) < k]]
    return order[kept]


def _grouped(keys: int, work):
    """Calls ``work`` on the rows of each group of the leading ``keys`` columns; input is sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i) for i in range(keys)]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                code = c.dictionary_encode().indices.to_numpy()
                change[1:] |= code[1:] != code[:-1]
            starts = np.r_[0, np.flatnonzero(change)]
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                key = tuple(c[a].as_py() for c in columns)
                if key != at and held:
                    yield work(at, pa.Table.from_batches(held))
                    held = []
                at = key
                held.append(batch.slice(a, b - a))
        if held:
            yield work(at, pa.Table.from_batches(held))

    return run


def _band(k: int):
    def work(key: tuple, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.select(["lang", "source", "term", "g", "l", "value"])
        keep = skyband(rows["g"].to_numpy(), rows["l"].to_numpy(), rows["term"].to_pylist(), k)
        return rows.take(pa.array(keep)).combine_chunks().to_batches()[0]

    return _grouped(3, work)


def _skybands(rows: DataFrame, sizes: DataFrame, k: int, part_terms: int) -> DataFrame:
    """The skybands of the partitions of each group; ``sizes`` has ``(lang, source, n_terms)``."""
    met = join_spread(rows, sizes, ["lang", "source"], ["term"])
    part = F.pmod(F.xxhash64("term"), F.ceil(F.col("n_terms") / part_terms))
    met = met.select("lang", "source", part.alias("part"), "term", "g", "l", "value")
    keys = ["lang", "source", "part"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_band(k), BAND)


def top_terms(rows: DataFrame, k: int = TOP, part_terms: int = PART_TERMS) -> DataFrame:
    """``(lang, source, item, value, rank)`` of the first ``k`` terms of each group.

    ``rows`` is ``(lang, source, term, g, l, value)``: counts in the group and in the language.
    """

    def sizes(of: DataFrame) -> DataFrame:
        return of.groupBy("lang", "source").agg(F.count("*").alias("n_terms"))

    rows = written(rows, "eligible")
    bands = written(_skybands(rows, sizes(rows), k, part_terms), "skybands")
    merged = _skybands(bands, sizes(bands), k, part_terms)
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _cell_sums(key: tuple, rows: pa.Table) -> pa.RecordBatch:
    """Sums of |p - q| over the terms of a cell, for its pairs of sources."""
    lang, _, a, b = key
    own = rows.filter(pc.is_null(rows["term"])).sort_by("idx")
    idx, base = own["idx"].to_numpy(), own["p"].to_numpy()
    names, tiles = own["source"].to_pylist(), own["tile"].to_numpy()
    cells = rows.filter(pc.is_valid(rows["term"]))
    codes = cells["term"].combine_chunks().dictionary_encode()
    at = codes.indices.to_numpy()
    table = np.repeat(base[:, None], len(codes.dictionary), axis=1)
    table[np.searchsorted(idx, cells["idx"].to_numpy()), at] = cells["p"].to_numpy()
    # terms of the block that no source of these tiles uses
    absent = own["block_terms"][0].as_py() - len(codes.dictionary)
    out: tuple[list, list, list] = ([], [], [])
    for i in range(len(names)):
        if tiles[i] != a:
            continue
        others = np.flatnonzero(tiles == b) if a != b else np.arange(i + 1, len(names))
        sums = np.abs(table[others] - table[i]).sum(axis=1) + absent * np.abs(base[others] - base[i])
        for j, value in zip(others.tolist(), sums.tolist(), strict=True):
            for x, y in ((i, j), (j, i)):
                out[0].append(names[x])
                out[1].append(names[y])
                out[2].append(value)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
         pa.array(out[2], pa.int64())],
        ["lang", "source", "item", "value"],
    )


def source_pairs(
    groups: DataFrame, kept: DataFrame, shares: DataFrame, block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES
) -> DataFrame:
    """``(lang, source, item, value, rank)``: all other sources of each group.

    ``groups`` is ``(lang, source, n, v, z)`` with the share z of a term that does not
    occur, ``kept`` has ``(lang, term)``, and ``shares`` ``(lang, source, term, p)`` of those that occur.
    """
    lang = W.partitionBy("lang")
    placed = groups.select(
        "lang", "source", "z", F.greatest(F.ceil(F.col("v") / block_terms), F.lit(1)).alias("blocks"),
        (F.row_number().over(lang.orderBy("source")) - 1).cast("bigint").alias("idx"), F.count("*").over(lang).alias("sources"),
    ).select(
        "lang", "source", "z", "blocks", "idx", F.floor(F.col("idx") / tile_sources).alias("tile"),
        F.ceil(F.col("sources") / tile_sources).alias("tiles"),
    )
    placed = written(placed, "sources")

    def tiled(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        return rows.select(
            "lang", "block", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"),
            "source", "idx", "tile", "term", "p", "block_terms",
        )

    def spread(count: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    in_block = join_spread(kept, placed.select("lang", "blocks").distinct(), ["lang"], ["term"]).groupBy(
        "lang", block.alias("block")
    ).agg(F.count("*").alias("block_terms"))
    empty = placed.select("*", spread("blocks").alias("block")).join(in_block, ["lang", "block"], "left").select(
        "*", F.lit(None).cast("string").alias("term"), F.col("z").alias("p")
    ).na.fill(0, ["block_terms"])
    full = join_spread(shares, placed, ["lang", "source"], ["term"]).withColumns(
        {"block": block, "block_terms": F.lit(None).cast("bigint")}
    )
    keys = ["lang", "block", "a", "b"]
    cells = tiled(empty).unionByName(tiled(full))
    sums = cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_grouped(4, _cell_sums), SUMS)
    total = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return total.withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, k: int = TOP, part_terms: int = PART_TERMS,
    block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (lang, source) of ``docs``."""
    counts = written(term_counts(docs), "counts")
    found = counts.where("term IS NOT NULL")
    kept = written(
        found.groupBy("lang", "term").agg(F.sum("n").alias("l"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs).select("lang", "term", "l"),
        "kept",
    )
    used = written(found.select("lang", "source", "term", F.col("n").alias("g")).join(kept, ["lang", "term"]), "used")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("l").alias("nl"))
    sums = used.groupBy("lang", "source").agg(F.sum("g").alias("n"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").join(
        langs, "lang", "left"
    ).na.fill(0, ["n", "v", "nl"])
    # a language without kept terms has no share to give
    groups = written(groups.withColumn("z", F.when(F.col("v") > 0, share("0", "n", "v")).otherwise(F.lit(0))), "groups")
    shares = written(
        join_spread(used, groups, ["lang", "source"], ["term"]).select(
            "lang", "source", "term", "g", "l", share("g", "n", "v").alias("p"), share("l", "nl", "v").alias("q")
        ),
        "shares",
    )
    over = shares.where("g > 0 AND p > q").select("lang", "source", "term", "g", "l", (F.col("p") - F.col("q")).alias("value"))
    pairs = source_pairs(groups, kept, shares.select("lang", "source", "term", "p"), block_terms, tile_sources)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        top_terms(over, k, part_terms).withColumn("part", F.lit("term")).select(*columns)
    )
