"""Language identification of words with a linear-chain conditional random field.

A word is described by hashed byte n-grams of its lower-case form between
boundary marks (those at a mark are its affixes), and by the lexicons, one per
language, that hold it.  Labels are the languages met in training; transitions
between labels are learned.  Forward-backward gives each word's distribution over
languages in its context, so code-switched text gets a language per word; a
document's language is the one with the largest expected share of letters, and
that share is its score.  Its certainty is how sure the model is of its words, whatever their
languages: the mean, over letters, of the likeliest language's probability.

Training uses a sample of at most about ``sample_docs`` documents per language,
by hash of the id, and ``sample_words`` consecutive words of each, from a place that
another hash of the id picks.  Their pieces are strung together in random order, so that the chain sees switches.  The model is a
few MB whatever the corpus.  Prediction reads whole texts, in slices of bounded
size: forward-backward runs over pieces of ``CHUNK`` words at once, whose
transfer matrices carry the exact messages from piece to piece.

Defined cases: a null text, or one without a letter, is ``und`` with score and
certainty 0 and no spans; rows with a null lang are not learned from; if nothing can be learned
from, every text is ``und``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import text_udf

UNKNOWN = "und"
SAMPLE_DOCS = 400
SAMPLE_WORDS = 120
LEXICON_WORDS = 2000
FEATURES = 1 << 16
GRAM_SIZES = (1, 2, 3, 4)
CHUNK = 32
#: Text whose words, features and messages are held at once.
SLICE_BYTES = 512 << 10
STEPS = 60
#: Runs of letters only, as in training; numerals such as a half are none.
WORD = regex.compile(r"\p{L}+")
FOUND = (
    "struct<lang: string, score: double, certainty: double, spans: array<struct<first_word: int, n_words: int, lang: string>>>"
)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (FEATURES, labels)
    lexicon: np.ndarray  # sorted word hashes
    member: np.ndarray  # (lexicon, labels): in which languages' lexicons a word is
    lexical: np.ndarray  # (labels, labels): weight of a lexicon for a label
    transitions: np.ndarray  # (labels, labels)


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of distinct words, the word each belongs to, and whole-word hashes."""
    marked = pc.cast(pc.binary_join_element_wise("\x02", pc.utf8_lower(words), "\x03", ""), pa.binary())
    sizes = pc.binary_length(marked).to_numpy().astype(np.int64)
    codes = np.frombuffer(b"".join(marked.to_pylist()), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # bytes to the word's end
    grams, owners = [], []
    for size in GRAM_SIZES:
        at = np.flatnonzero(left >= size)
        h = np.full(len(at), size, np.uint64)
        for i in range(size):
            h = (h * np.uint64(0x100000001B3)) ^ codes[at + i]
        h ^= h >> np.uint64(31)
        grams.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64) % FEATURES)
        owners.append(word[at])
    powers = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ** (left.astype(np.uint64) % np.uint64(64))
    powers ^= powers >> np.uint64(29)
    whole = np.add.reduceat(powers * np.uint64(0xBF58476D1CE4E5B9), np.cumsum(sizes) - sizes)
    return np.concatenate(grams), np.concatenate(owners), whole


def membership(model_lexicon: np.ndarray, member: np.ndarray, whole: np.ndarray) -> np.ndarray:
    if not len(model_lexicon):
        return np.zeros((len(whole), member.shape[1]))
    at = np.minimum(np.searchsorted(model_lexicon, whole), len(model_lexicon) - 1)
    return member[at] * (model_lexicon[at] == whole)[:, None]


def emissions(model: Model, words: pa.Array) -> np.ndarray:
    """(words, labels) logits of distinct words."""
    grams, owner, whole = word_features(words)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(words)))
    summed = np.add.reduceat(model.weights[grams[order]], starts, axis=0)
    return summed + membership(model.lexicon, model.member, whole) @ model.lexical


def posteriors(
    logits: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, with_pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Label distribution of every word of sequences of ``sizes`` words laid end to end,
    and, if asked for, the expected number of transitions between labels.

    Sequences are cut into chunks; the product of a chunk's matrices takes the
    forward message across it (and the backward one), so the result is exact.
    """
    n_labels = logits.shape[1]
    move = np.exp(transitions).astype(np.float32)
    sizes = sizes[sizes > 0]
    chunks = -(-sizes // CHUNK)
    owner = np.repeat(np.arange(len(sizes)), chunks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = np.repeat(np.cumsum(sizes) - sizes, chunks) + nth * CHUNK
    length = np.minimum(CHUNK, np.repeat(sizes, chunks) - nth * CHUNK)
    real = np.arange(CHUNK) < length[:, None]
    head = (nth == 0)[:, None]  # no transition leads to a first word
    emit = np.exp(logits - logits.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-20)
    emit = emit[np.where(real, first[:, None] + np.arange(CHUNK), 0)]
    product = np.broadcast_to(np.eye(n_labels, dtype=np.float32), (len(owner), n_labels, n_labels)).copy()
    for k in range(CHUNK):
        moved = product @ move
        if k == 0:
            moved[head[:, 0]] = 1
        after = moved * emit[:, k, None, :]
        after /= after.max(axis=(1, 2), keepdims=True)
        product = np.where(real[:, k, None, None], after, product)
    # messages at chunk edges, the k-th chunk of all sequences at once
    enter = np.ones((len(owner), n_labels), np.float32)
    leave = np.ones((len(owner), n_labels), np.float32)
    rank = np.argsort(nth, kind="stable")
    edges = np.searchsorted(nth[rank], np.arange(nth.max() + 2))
    for k in range(1, nth.max() + 1):
        rows = rank[edges[k] : edges[k + 1]]
        message = np.einsum("ci,cij->cj", enter[rows - 1], product[rows - 1])
        enter[rows] = message / message.sum(axis=1, keepdims=True)
    for k in range(nth.max(), 0, -1):
        rows = rank[edges[k] : edges[k + 1]]
        message = np.einsum("cij,cj->ci", product[rows], leave[rows])
        leave[rows - 1] = message / message.sum(axis=1, keepdims=True)
    forward = np.empty_like(emit)
    message = enter
    for k in range(CHUNK):
        moved = message @ move
        if k == 0:
            moved[head[:, 0]] = 1
        after = moved * emit[:, k]
        message = np.where(real[:, k, None], after / after.sum(axis=1, keepdims=True), message)
        forward[:, k] = message
    pairs = np.zeros((n_labels, n_labels)) if with_pairs else None
    message = leave
    for k in range(CHUNK - 1, -1, -1):
        ahead = message * emit[:, k]
        if with_pairs:
            rows = real[:, k] & ~head[:, 0] if k == 0 else real[:, k]
            before = (enter if k == 0 else forward[:, k - 1])[rows]
            joint = before[:, :, None] * move * ahead[rows][:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        forward[:, k] *= message
        after = ahead @ move.T
        message = np.where(real[:, k, None], after / after.sum(axis=1, keepdims=True), message)
    found = forward[real]
    return found / found.sum(axis=1, keepdims=True), pairs


def training_sample(
    docs: DataFrame, text: str, lang: str, key: str, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS
) -> list[tuple[str, list[str]]]:
    """(language, words) pieces: about ``sample_docs`` documents of each language, chosen by hash."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return []
    cell = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20))
    wanted = F.lit(False)
    for name, count in sizes.items():
        share = math.ceil(min(1.0, sample_docs / count) * (1 << 20))
        wanted = wanted | ((F.col(lang) == name) & (cell < share))
    words = F.regexp_extract_all(F.col(text), F.lit(r"(\p{L}+)"), F.lit(1))
    most = 2 * sample_docs * len(sizes)
    found = rows.where(wanted).select(cell.alias("c"), F.xxhash64(F.lit("start"), F.col(key)).alias("h"), F.col(lang).alias("l"), words.alias("w"))
    start = F.pmod("h", F.greatest(F.size("w") - sample_words, F.lit(0)) + 1).cast("int") + 1
    found = found.select("c", "l", F.slice("w", start, F.lit(sample_words)).alias("w")).orderBy("c", "l", "w")
    return [(r.l, r.w) for r in found.limit(most).collect() if r.w]


def train(pieces: list[tuple[str, list[str]]], steps: int = STEPS, seed: int = 11) -> Model:
    """Maximum likelihood by full-batch Adam over code-switched sequences made of the pieces."""
    labels = sorted({lang for lang, _ in pieces})
    n = len(labels)
    rng = np.random.default_rng(seed)
    spans = []
    for lang, words in pieces:
        while words:
            size = int(rng.integers(3, 40))
            spans.append((labels.index(lang), words[:size]))
            words = words[size:]
    rng.shuffle(spans)
    truth = np.concatenate([np.full(len(w), k) for k, w in spans])
    tokens = pa.array([x for _, w in spans for x in w]).dictionary_encode()
    types, token = tokens.dictionary, tokens.indices.to_numpy()
    # sequences of a few spans each
    lengths = np.array([len(w) for _, w in spans])
    group = np.cumsum(rng.random(len(lengths)) < 0.4)
    sizes = np.bincount(group, lengths).astype(np.int64)
    grams, owner, whole = word_features(types)
    counts = np.zeros((len(types), n))
    np.add.at(counts, (token, truth), 1)
    known = np.zeros((len(types), n), bool)
    for k in range(n):
        top = np.argsort(-counts[:, k], kind="stable")[:LEXICON_WORDS]
        known[top[counts[top, k] >= 2], k] = True
    listed = np.flatnonzero(known.any(axis=1))
    listed = listed[np.argsort(whole[listed])]
    model = Model(
        labels, np.zeros((FEATURES, n)), whole[listed], known[listed].astype(float), np.zeros((n, n)), np.zeros((n, n))
    )
    member = membership(model.lexicon, model.member, whole)
    inside = np.ones(len(token), bool)
    inside[np.cumsum(sizes[sizes > 0]) - sizes[sizes > 0]] = False
    pairs = np.zeros((n, n))
    np.add.at(pairs, (truth[:-1][inside[1:]], truth[1:][inside[1:]]), 1)
    # the chain's own maximum: smoothed relative frequencies of switches between spans
    model.transitions = np.log((pairs + 1) / (pairs + 1).sum(axis=1, keepdims=True))
    order = np.argsort(owner, kind="stable")
    sorted_grams = grams[order]
    starts = np.searchsorted(owner[order], np.arange(len(types)))
    params = [model.weights, model.lexical, model.transitions]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        per_type = np.add.reduceat(model.weights[sorted_grams], starts, axis=0) + member @ model.lexical
        logits = per_type[token]
        found, expected = posteriors(logits, sizes, model.transitions, with_pairs=True)
        error = found.copy()
        error[np.arange(len(truth)), truth] -= 1
        by_type = np.stack([np.bincount(token, error[:, k], len(types)) for k in range(n)], axis=1)
        d_weights = np.stack([np.bincount(grams, by_type[owner, k], FEATURES) for k in range(n)], axis=1)
        grads = [d_weights + 1e-3 * model.weights, member.T @ by_type, expected - pairs]
        for i, (p, g) in enumerate(zip(params, grads, strict=True)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            p -= 0.1 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def label_texts(model: Model, texts: list[str | None]) -> list[dict]:
    """Language, score, certainty and word spans of each text."""
    words = [WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(w) for w in words])
    if not sizes.sum():
        return [{"lang": UNKNOWN, "score": 0.0, "certainty": 0.0, "spans": []} for _ in texts]
    tokens = pa.array([x for w in words for x in w], pa.string()).dictionary_encode()
    logits = emissions(model, tokens.dictionary)
    letters = pc.utf8_length(tokens.dictionary).to_numpy()
    token = tokens.indices.to_numpy()
    found, _ = posteriors(logits[token], sizes, model.transitions)
    full = np.flatnonzero(sizes)
    starts = np.cumsum(sizes[full]) - sizes[full]
    weight = letters[token][:, None].astype(np.float64)
    share = np.add.reduceat(found * weight, starts, axis=0) / np.add.reduceat(weight, starts, axis=0)
    sure = np.add.reduceat(found.max(axis=1) * weight[:, 0], starts) / np.add.reduceat(weight[:, 0], starts)
    best = found.argmax(axis=1)
    new = np.zeros(len(best), bool)
    new[1:] = best[1:] != best[:-1]
    new[starts] = True
    edges = np.flatnonzero(new)
    run = np.diff(np.r_[edges, len(best)])
    owner = np.searchsorted(starts, edges, side="right") - 1
    spans: list[list] = [[] for _ in texts]
    for d, a, k, label in zip(owner.tolist(), edges.tolist(), run.tolist(), best[edges].tolist(), strict=True):
        spans[full[d]].append({"first_word": a - int(starts[d]), "n_words": k, "lang": model.labels[label]})
    top = share.argmax(axis=1)
    result = [{"lang": UNKNOWN, "score": 0.0, "certainty": 0.0, "spans": []} for _ in texts]
    for d, k in zip(full.tolist(), range(len(full)), strict=True):
        score = min(1.0, float(share[k, top[k]]))
        result[d] = {
            "lang": model.labels[top[k]], "score": score, "certainty": min(1.0, float(sure[k])), "spans": spans[d],
        }
    return result


def language_column(text: Column, spark, model: Model | None) -> Column:
    """Struct of lang, score, certainty and spans (runs of words of one language)."""
    shipped = spark.sparkContext.broadcast(model)
    kind = pa.struct([
        ("lang", pa.string()), ("score", pa.float64()), ("certainty", pa.float64()),
        ("spans", pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]))),
    ])

    def work(texts: pa.Array) -> pa.Array:
        if shipped.value is None:
            return pa.array([{"lang": UNKNOWN, "score": 0.0, "certainty": 0.0, "spans": []}] * len(texts), kind)
        return pa.array(label_texts(shipped.value, texts.to_pylist()), kind)

    return text_udf(work, FOUND, SLICE_BYTES)(text)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", **bounds) -> Model | None:
    """Model learned from the labelled rows of ``docs``; None if there are none."""
    pieces = training_sample(docs, text, lang, key, **bounds)
    return train(pieces) if pieces else None
