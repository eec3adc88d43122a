"""Sections -> chunks -> best evidence per (country, question) -> reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidenza.functions.encoders import encode_column, encode_rows
from evidenza.functions.sentences import chunks, sentences
from evidenza.functions.text import fixed
from evidenza.operators.spread import join_spread

# Up to this size the questions are shipped to every task; beyond it tiles of
# questions meet tiles of candidates.  A batch of candidates is scored against
# QUESTION_BLOCK questions at a time.
MAX_QUESTION_BYTES = 64 << 20
QUESTION_BLOCK = 512
# Parts that the candidates of one tile of questions are scored in.
CANDIDATE_TILES = 64

# Rows of one record batch that leaves a scoring task; each carries its text.
ROWS_OUT = 1024

# Scores closer than this many decimals are ties, which the first chunk wins.
SCORE_DECIMALS = 9

# Fixed wording of the evidence report.
NO_CHUNKS = "\n*No text chunks could be generated.*\n\n---\n"
NO_VECTORS = "\n*Failed to generate embeddings.*\n\n---\n"
FAILED_QUESTION = "\n*Failed to process question.*\n\n---\n"


# --- chunks -----------------------------------------------------------------


def chunk_rows(
    sections: DataFrame,
    key: Sequence[str],
    text: str = "text_content",
    size: int = 3,
    overlap: int = 1,
    splitter: Callable[[Column], Column] = sentences,
) -> DataFrame:
    """``(*key, chunk_idx, chunk)``: overlapping sentence windows of each section."""
    windows = chunks(splitter(F.col(text)), size, overlap)
    return sections.select(*key, F.posexplode(windows).alias("chunk_idx", "chunk"))


def located_sections(
    sections: DataFrame, countries: DataFrame, key: Sequence[str] = ("section_url", "section_title")
) -> DataFrame:
    """Sections with the url to cite: their own, else their country's."""
    home = countries.select(F.col("doc_id").alias("country_doc_id"), "country_url")
    return join_spread(sections, home, ["country_doc_id"], key).withColumn(
        "source_url", F.coalesce(F.col("section_url"), F.col("country_url"))
    )


def chunk_lineage(
    sections: DataFrame,
    countries: DataFrame,
    key: Sequence[str] = ("section_url", "section_title"),
    **chunking,
) -> DataFrame:
    """Chunk rows that carry country, title and url (section's, else country's).

    The join happens on whole sections, before they multiply into chunks.
    """
    return chunk_rows(located_sections(sections, countries, key), ["country_doc_id", *key, "source_url"], **chunking)


def evidence_chunks(winners: DataFrame, sections: DataFrame, key: Sequence[str], **chunking) -> DataFrame:
    """``winners`` with the text of each winning chunk in ``chunk``.

    ``winners`` hold ``key``, ``chunk_idx`` and ``chunk_key`` (the hash of the text).  Only
    sections that hold a winner are split again, so texts of other chunks are never moved.
    """

    def same(other: DataFrame, names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"w.{n}").eqNullSafe(other[n]) for n in names])

    won = winners.select(*key).distinct().alias("w")
    few = sections.join(won, same(sections, key), "left_semi")
    place = [*key, "chunk_idx", "chunk_key"]
    texts = chunk_rows(few, key, **chunking).withColumn("chunk_key", F.xxhash64("chunk")).dropDuplicates(place)
    met = winners.alias("w").join(texts, same(texts, place))
    return met.select("w.*", texts["chunk"])


# --- scoring ----------------------------------------------------------------


def _shipped_questions(questions: DataFrame, max_bytes: int) -> tuple[list, np.ndarray] | None:
    """Ids and unit vectors of the questions, None if they take more than ``max_bytes``."""
    ids, vectors, size = [], [], 0
    for row in questions.filter(F.col("embedding").isNotNull()).toLocalIterator():
        size += 8 * len(row.embedding) + 64
        if size > max_bytes:
            return None
        ids.append(row.question_id)
        vectors.append(row.embedding)
    return ids, _unit_rows(np.array(vectors, dtype=np.float64)) if vectors else np.zeros((0, 0))


def best_evidence(
    candidates: DataFrame,
    questions: DataFrame,
    group: str = "country",
    order: Sequence[str] = ("chunk_idx",),
    carry: Sequence[str] = (),
    vector: str | None = "embedding",
    text: str | None = None,
    encoder_factory: Callable[[], object] | None = None,
    k: int = 1,
    question_block: int = QUESTION_BLOCK,
    max_question_bytes: int = MAX_QUESTION_BYTES,
    question_tiles: int | None = None,
    candidate_tiles: int = CANDIDATE_TILES,
) -> DataFrame:
    """The ``k`` most similar candidates of every (group, question).

    ``questions`` holds ``question_id`` and ``embedding``.  Candidates bring a
    ``vector`` column, or a ``text`` column with an ``encoder_factory`` that is
    run in the same pass so that chunk vectors never leave the task.  ``carry`` is for
    narrow columns; :func:`evidence_chunks` brings the texts of the winners.

    Each Arrow batch is scored with one matrix product and only its own winners
    leave the task: candidate-question pairs are never rows, and a group that
    holds most of the candidates is reduced in parallel before the shuffle.
    Ties go to the lowest ``order``.  Every candidate is encoded once, however
    many questions there are: a batch is scored against ``question_block`` of them
    at a time, and its winners leave the task block by block.

    Questions that take up to ``max_question_bytes`` are read by the driver and shipped.  More
    of them, or a given number of ``question_tiles``, are joined instead: both
    sides are dealt into tiles by hash, every tile of questions meets every one of the
    ``candidate_tiles``, and a task holds one tile of questions while its candidates
    stream by.  Then nothing runs while the plan is built.
    """
    source = text if encoder_factory else vector
    kept_columns = list(dict.fromkeys([group, *order, *carry]))
    inputs = candidates.select(*kept_columns, F.col(source).alias("_source"))
    kept_fields = [inputs.schema[c] for c in kept_columns]
    out_schema = T.StructType(
        kept_fields
        + [
            T.StructField("question_id", questions.schema["question_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    window = Window.partitionBy(group, "question_id").orderBy(
        F.col("score").desc(), *[F.col(c) for c in order]
    )
    asked = questions.select("question_id", "embedding")
    scorer = _Scorer(group, list(order), kept_columns, k, out_schema, question_block)
    shipped = _shipped_questions(asked, max_question_bytes) if question_tiles is None else None
    if shipped is not None:
        held = candidates.sparkSession.sparkContext.broadcast(shipped)
        scored = inputs.mapInArrow(_shipped_scorer(scorer, held, encoder_factory), out_schema)
    else:
        if question_tiles is None:
            row = asked.agg(F.count("*"), F.max(F.size("embedding"))).first()
            question_tiles = -(-row[0] * (8 * row[1] + 64) // max_question_bytes)
        if encoder_factory:
            inputs = inputs.withColumn("_source", encode_column(F.col("_source"), encoder_factory))
        cells = _tiled_rows(inputs, asked, order, question_tiles, candidate_tiles)
        scored = cells.mapInArrow(_tiled_scorer(scorer), out_schema)
    winners = scored.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= k)
    return winners.withColumnRenamed("_rn", "rank")


def _tiled_rows(
    inputs: DataFrame, questions: DataFrame, order: Sequence[str], question_tiles: int, candidate_tiles: int
) -> DataFrame:
    """Both sides in cells of (question tile, candidate tile), the questions of a cell first."""

    def parts(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def tile(names: Sequence[str], count: int) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(count)).cast("int")

    left = inputs.filter(F.col("_source").isNotNull()).select(
        "*", tile(order, candidate_tiles).alias("_c"), parts(question_tiles).alias("_q")
    )
    right = questions.filter(F.col("embedding").isNotNull()).select(
        F.col("question_id").alias("_question"), F.col("embedding").alias("_source"),
        tile(["question_id"], question_tiles).alias("_q"), parts(candidate_tiles).alias("_c"),
    )
    vector = "array<double>"
    left = left.withColumns({
        "_source": F.col("_source").cast(vector), "_kind": F.lit(1),
        "_question": F.lit(None).cast(questions.schema["question_id"].dataType),
    })
    right = right.withColumns({"_source": F.col("_source").cast(vector), "_kind": F.lit(0)})
    rows = left.unionByName(right, allowMissingColumns=True).repartition("_q", "_c")
    return rows.sortWithinPartitions("_q", "_c", "_kind")


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


class _Scorer:
    """Winners of one batch of candidates against a set of questions."""

    def __init__(self, group: str, order: list[str], kept: list[str], k: int, out_schema: T.StructType, block: int):
        self.group, self.order, self.kept, self.k, self.block = group, order, kept, k, block
        self.out_schema = out_schema

    def best_rows(self, batch: pa.RecordBatch, rows: np.ndarray, scores: np.ndarray) -> list[np.ndarray]:
        """Row, question number and score of the ``k`` best rows per group and question."""
        keys = batch.column(self.group).take(pa.array(rows)).dictionary_encode(null_encoding="encode")
        columns = {"_group": keys.indices}
        columns |= {c: batch.column(c).take(pa.array(rows)) for c in self.order}
        ranked = pc.sort_indices(pa.table(columns), [(c, "ascending") for c in columns]).to_numpy()
        codes = keys.indices.to_numpy(zero_copy_only=False)[ranked]
        rows, scores = rows[ranked], scores[ranked]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        sizes = np.diff(np.r_[starts, len(codes)])
        group_of = np.repeat(np.arange(len(starts)), sizes)
        places = np.arange(len(codes))[:, None]
        questions = np.arange(scores.shape[1])
        found = []
        for turn in range(self.k):
            best = np.maximum.reduceat(scores, starts, axis=0)
            first = np.where(scores == best[group_of], places, len(codes))
            first = np.minimum.reduceat(first, starts, axis=0)
            left = sizes > turn
            asked = np.broadcast_to(questions, first.shape)
            found.append((rows[first[left]].ravel(), asked[left].ravel(), best[left].ravel()))
            scores[first[left], asked[left]] = -np.inf
        return [np.concatenate(part) for part in zip(*found, strict=True)]

    def winners(
        self, batch: pa.RecordBatch, rows: np.ndarray, vectors: np.ndarray, ids: list, matrix: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        """``vectors`` are those of ``rows`` of the batch, ``matrix`` the unit vectors of the questions."""
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.out_schema)
        units = _unit_rows(vectors)
        for start in range(0, len(ids), self.block):
            scores = np.round(units @ matrix[start : start + self.block].T, SCORE_DECIMALS) + 0.0
            taken, asked, values = self.best_rows(batch, rows, scores)
            for a in range(0, len(taken), ROWS_OUT):
                part = slice(a, a + ROWS_OUT)
                picked = batch.select(self.kept).take(pa.array(taken[part]))
                names = pa.array(ids).take(pa.array(asked[part] + start))
                columns = [*picked.columns, names, pa.array(values[part])]
                columns = [c.cast(f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _vectors(source: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers that have a vector, and those vectors as a matrix."""
    rows = np.flatnonzero(source.is_valid().to_numpy(zero_copy_only=False))
    values = source.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows, values.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))


def _shipped_scorer(scorer: _Scorer, shipped, encoder_factory: Callable[[], object] | None):
    def encoded(source: pa.Array, encoder) -> tuple[np.ndarray, np.ndarray]:
        found = encode_rows(encoder, source.to_pylist())
        rows = np.array([i for i, v in enumerate(found) if v is not None], dtype=np.int64)
        return rows, np.array([found[i] for i in rows], dtype=np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shipped.value
        encoder = encoder_factory() if encoder_factory else None
        for batch in batches:
            if batch.num_rows == 0 or not ids:
                continue
            source = batch.column("_source")
            rows, vectors = encoded(source, encoder) if encoder is not None else _vectors(source)
            if len(rows):
                yield from scorer.winners(batch, rows, vectors, ids, matrix)

    return score


def _tiled_scorer(scorer: _Scorer):
    """Holds the questions of one cell and scores its candidates as they stream by."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, held, matrix = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("_q", "_c", "_kind")]
            change = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            for a, b in zip(np.r_[0, change].tolist(), np.r_[change, batch.num_rows].tolist(), strict=True):
                part = batch.slice(a, b - a)
                at = (marks[0][a], marks[1][a])
                if at != cell:
                    cell, ids, held, matrix = at, [], [], None
                rows, vectors = _vectors(part.column("_source"))
                if marks[2][a] == 0:
                    ids.extend(part.column("_question").to_pylist())
                    held.append(vectors)
                elif ids:
                    if matrix is None:
                        matrix = _unit_rows(np.concatenate(held))
                    yield from scorer.winners(part, rows, vectors, ids, matrix)

    return score


# --- reports ----------------------------------------------------------------


def evidence_text(chunk: Column) -> Column:
    """Chunk as one Markdown line: backticks escaped, line breaks as blanks."""
    return F.replace(
        F.replace(chunk, F.lit("`"), F.lit("\\`")), F.lit("\n"), F.lit(" ")
    )


def evidence_block(score: Column, chunk: Column, url: Column) -> Column:
    """Answer line, quoted evidence and source link of one question."""
    found = F.concat(
        F.lit("**Answer/Evidence (Similarity: "),
        fixed(score, 4),
        F.lit("):**\n> "),
        evidence_text(chunk),
        F.lit("\n\n**Source URL:** ["),
        url,
        F.lit("]("),
        url,
        F.lit(")\n\n---\n"),
    )
    return F.when(score.isNotNull(), found).otherwise(F.lit(FAILED_QUESTION))


def question_block(number: Column, question: Column, body: Column) -> Column:
    return F.concat(
        F.lit("### Question "), number.cast("string"), F.lit(": "), question, F.lit("\n\n"), body
    )


def country_reports(
    countries: DataFrame,
    evidence: DataFrame,
    questions: DataFrame,
    chunked: DataFrame | None = None,
    country: str = "country",
    name: str = "country_name",
) -> DataFrame:
    """``(country, report)``: header, then one block per question in order.

    ``evidence`` holds country, question_id, score, chunk and source_url with
    one row per (country, question), so what is gathered per country is bounded
    by the number of questions.  A country without evidence gets a notice, which
    tells missing chunks from failed vectors when ``chunked`` is given.
    """
    asked = questions.select(
        "question_id", "question", F.col("question_id").alias("_place")
    )
    blocks = (
        evidence.join(asked, "question_id")
        .select(
            country,
            "_place",
            question_block(
                F.col("_place") + 1,
                F.col("question"),
                evidence_block(F.col("score"), F.col("chunk"), F.col("source_url")),
            ).alias("_block"),
        )
        .groupBy(country)
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_block"))).alias("_blocks"))
    )
    full = countries.join(blocks, country, "left")
    notice = F.lit(NO_CHUNKS)
    if chunked is not None:
        have_chunks = chunked.select(country).distinct().withColumn("_chunked", F.lit(True))
        full = full.join(have_chunks, country, "left")
        notice = F.when(F.col("_chunked"), F.lit(NO_VECTORS)).otherwise(notice)
    body = F.coalesce(F.array_join(F.col("_blocks._block"), ""), notice)
    return full.select(
        country,
        F.concat(F.lit("## Country: "), F.col(name), F.lit("\n\n---\n"), body).alias("report"),
    )
