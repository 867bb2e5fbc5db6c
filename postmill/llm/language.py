"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language. A text's words are
scored by the forward algorithm: the probability of a word is the sum over all its segmentations
into pieces of the product of their probabilities, and a text's is the product over its words. The
language of the largest posterior is the prediction, its posterior the score. Single bytes are
pieces too, so every word has a segmentation.

Piece probabilities are counts of the vocabulary's own segmentation over a bounded sample of
training texts (``SAMPLE`` a language, chosen by hash), smoothed with the counts of all languages.
Runs without white space are words, however long; those of more than ``LONGEST`` bytes are scored one
by one with a window of forward values. Texts are lower-cased. The vocabulary is read on the driver.

A null text, and one without a letter, is ``und`` with score 0; so is every text where there is
nothing to learn from. Of languages with equal posteriors the smaller name is predicted. Equal texts get
equal predictions. An empty table gives no rows. Columns beside the named ones play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .lm import remainder
from .words import BASE, BYTE_VALUES, NOT_SPACE, mixed, named, slices, words

HELD_OUT = (4, 2)
SAMPLE = 1500
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST = 48
SLICE = 8 << 20
SCALE = 100.0  # keeps products of probabilities in range; taken out again by length
BACKGROUND = 500.0
SPACE_MARK = "▁"


class Pieces(NamedTuple):
    """A hash table of the prefixes of all pieces: ``keys`` at their places, and the piece or -1 of each; piece lengths in bytes."""

    keys: np.ndarray
    piece: np.ndarray
    lengths: np.ndarray

    @property
    def longest(self) -> int:
        return int(self.lengths.max())

    @property
    def size(self) -> int:
        return len(self.lengths)


def _place(key: np.ndarray, size: int) -> np.ndarray:
    return (mixed(key) & np.uint64(size - 1)).astype(np.int64)


def pieces_of(path: str) -> tuple[Pieces, dict[int, int]]:
    """The lower-case pieces of the vocabulary without inner spaces, and their numbers by vocabulary id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts: dict[bytes, int] = {bytes([b]): b for b in range(256)}
    numbers: dict[int, int] = {}
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            numbers[k] = int(piece[3:5], 16)
        elif not (model.is_control(k) or model.is_unknown(k)) and piece == piece.lower() and SPACE_MARK not in piece[1:]:
            numbers[k] = texts.setdefault(piece.encode(), len(texts))
    prefixes: dict[int, int] = {}
    base = int(BASE)
    for text, number in texts.items():
        h = 0
        for i, byte in enumerate(text):
            h = (h * base + int(BYTE_VALUES[byte])) & 0xFFFFFFFFFFFFFFFF
            prefixes.setdefault(h, -1)
            if i == len(text) - 1:
                prefixes[h] = number
    size = 1 << (2 * len(prefixes)).bit_length()
    keys, piece = np.zeros(size, np.uint64), np.full(size, -2, np.int32)
    for h, number in prefixes.items():
        at = int(_place(np.array([h], np.uint64), size)[0])
        while piece[at] != -2:
            at = (at + 1) % size
        keys[at], piece[at] = h, number
    return Pieces(keys, piece, np.array([len(t) for t in texts], dtype=np.int64)), numbers


def _look_up(table: Pieces, key: np.ndarray) -> np.ndarray:
    """The piece of each key, -1 for a mere prefix, -2 for neither."""
    at = _place(key, len(table.keys))
    found = np.where((table.keys[at] == key) | (table.piece[at] == -2), table.piece[at], -3)
    open_ = np.flatnonzero(found == -3)
    while len(open_):
        at[open_] = (at[open_] + 1) % len(table.keys)
        here, value = table.keys[at[open_]] == key[open_], table.piece[at[open_]]
        done = here | (value == -2)
        found[open_[done]] = value[done]
        open_ = open_[~done]
    return found


def word_scores(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: Pieces, weights: np.ndarray) -> np.ndarray:
    """log P of each word (with a space mark before it) in each language; ``weights`` are scaled."""
    n, languages = len(start), weights.shape[1]
    length = end - start
    # The words laid out in rows, each with the mark in front.
    width = int(length.max(initial=0)) + 3
    mark = np.frombuffer(SPACE_MARK.encode(), np.uint8)
    rows = np.zeros((n, width + 1), np.uint8)
    rows[:, :3] = mark
    column = np.arange(width - 3)
    inside = column < length[:, None]
    rows[:, 3:width][inside] = data[(start[:, None] + column)[inside]]
    full = length + 3
    word, begin = np.nonzero(np.arange(width) < full[:, None])
    key = np.zeros(len(word), np.uint64)
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(table.longest):
        stop = begin + step
        alive = stop < full[word]
        word, begin, key, stop = word[alive], begin[alive], key[alive], stop[alive]
        if not len(word):
            break
        key = key * BASE + BYTE_VALUES[rows[word, stop]]
        piece = _look_up(table, key)
        hit = piece >= 0
        edges.append((stop[hit] + 1, word[hit], begin[hit], piece[hit]))
        alive = piece > -2
        word, begin, key = word[alive], begin[alive], key[alive]
    stop, word, begin, piece = (np.concatenate(x) for x in zip(*edges, strict=True)) if edges else (np.zeros(0, np.int64),) * 4
    order = np.argsort(stop * n + word, kind="stable")
    stop, word, begin, piece = stop[order], word[order], begin[order], piece[order]
    forward = np.zeros((width + 1, n, languages))
    forward[0] = 1.0
    cut = np.searchsorted(stop, np.arange(width + 2))
    for j in range(1, width + 1):
        a, b = cut[j], cut[j + 1]
        if a == b:
            continue
        own = word[a:b]
        part = forward[begin[a:b], own] * weights[piece[a:b]]
        firsts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        forward[j, own[firsts]] = np.add.reduceat(part, firsts, axis=0)
    total = forward[full, np.arange(n)]
    return np.log(np.maximum(total, 1e-300)) - (full * np.log(SCALE))[:, None]


BLOCK = 1 << 16


def long_word_score(run: np.ndarray, table: Pieces, weights: np.ndarray) -> np.ndarray:
    """The same for one word of any length, given as bytes, in memory that does not grow with it."""
    text = np.concatenate((np.frombuffer(SPACE_MARK.encode(), np.uint8), run))
    longest, n = table.longest, len(text)
    # forward[i] is complete when all places before i have been pushed on; it begins at the block.
    forward, log_scale = np.zeros((BLOCK + longest + 1, weights.shape[1])), np.zeros(weights.shape[1])
    forward[0] = 1.0
    for block in range(0, n, BLOCK):
        held = min(BLOCK, n - block)
        place, key, found = np.arange(held), np.zeros(held, np.uint64), []
        for step in range(longest):
            alive = block + place + step < n
            place, key = place[alive], key[alive]
            if not len(place):
                break
            key = key * BASE + BYTE_VALUES[text[block + place + step]]
            piece = _look_up(table, key)
            hit = piece >= 0
            found.append((place[hit], place[hit] + step + 1, piece[hit]))
            place, key = place[piece > -2], key[piece > -2]
        begin, stop, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(begin, kind="stable")
        stop, chance, cut = stop[order], weights[piece[order]], np.searchsorted(begin[order], np.arange(held + 1))
        for i in range(held):
            if i % 16 == 0:
                window = forward[i : i + longest + 1]
                top = window.max(axis=0)
                window /= top
                log_scale += np.log(top)
            forward[stop[cut[i] : cut[i + 1]]] += forward[i] * chance[cut[i] : cut[i + 1]]
        if block + held == n:
            return np.log(forward[held]) + log_scale - n * np.log(SCALE)
        forward[: longest + 1] = forward[held : held + longest + 1]
        forward[longest + 1 :] = 0.0
    return log_scale


def text_scores(texts: pa.Array, table: Pieces, weights: np.ndarray) -> np.ndarray:
    """log P of each text in each language; each distinct word of the slice is scored once."""
    w = words(texts, NOT_SPACE)
    start, end, doc = w.start, w.end, w.doc()
    total = np.zeros((len(w.first) - 1, weights.shape[1]))
    _, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    scores = np.zeros((len(first), weights.shape[1]))
    length = end[first] - start[first]
    for i in np.flatnonzero(length > LONGEST):
        scores[i] = long_word_score(w.data[start[first[i]] : end[first[i]]], table, weights)
    # Words of about one length together, so that the rows are full.
    order = np.argsort(length, kind="stable")
    order = order[: np.count_nonzero(length <= LONGEST)]
    at = 0
    while at < len(order):
        widest = length[order[min(at + 50_000, len(order)) - 1]]
        stop = min(len(order), at + max(1000, min(50_000, 600_000 // (int(widest) + 4))))
        own = order[at:stop]
        scores[own] = word_scores(w.data, start[first[own]], end[first[own]], table, weights)
        at = stop
    for k in range(weights.shape[1]):
        total[:, k] = np.bincount(doc, weights=scores[inverse, k], minlength=len(total))
    return total


def _counted(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        proto, ids, own = vocabulary.value
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            for part in slices(batch, "text"):
                langs = named(part, "lang").to_pylist()
                encoded = model.encode([t.lower() for t in named(part, "text").to_pylist()], num_threads=1)
                for lang in sorted(set(langs)):
                    pieces = np.concatenate([np.array(e, dtype=np.int64) for e, x in zip(encoded, langs, strict=True) if x == lang])
                    at = np.minimum(np.searchsorted(ids, pieces), len(ids) - 1)
                    found, times = np.unique(own[at[ids[at] == pieces]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(times, pa.int64())], names=["lang", "piece", "times"]
                    )

    return count


def learned(docs: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE) -> tuple[Pieces, list[str], np.ndarray, np.ndarray]:
    """Pieces, languages, scaled probabilities (piece x language), and log priors."""
    spark = docs.sparkSession
    table, numbers = pieces_of(path)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    counts = known.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("n"))
    sizes = {row.l: row.n for row in counts.collect()}
    langs = sorted(sizes)
    if not langs:
        return table, [], np.zeros((table.size, 0)), np.zeros(0)
    picked = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) * F.col("n") < F.lit(sample * 1_000_000)
    texts = known.join(F.broadcast(counts), F.col("lang") == F.col("l")).where(picked).select("lang", "text")
    ids = np.array(sorted(numbers), dtype=np.int64)
    # The vocabulary file travels as bytes, so executors need no copy of it.
    vocabulary = spark.sparkContext.broadcast((Path(path).read_bytes(), ids, np.array([numbers[k] for k in ids], dtype=np.int64)))
    rows = texts.mapInArrow(_counted(vocabulary), "lang string, piece int, times long").groupBy("lang", "piece").agg(F.sum("times").alias("times")).collect()
    seen = np.zeros((table.size, len(langs)))
    for row in rows:
        seen[row.piece, langs.index(row.lang)] += row.times
    every = seen.sum(1) + 0.1
    every /= every.sum()
    chance = (seen + BACKGROUND * every[:, None]) / (seen.sum(0) + BACKGROUND)
    prior = np.array([sizes[x] for x in langs], dtype=float)
    return table, langs, chance * (SCALE**table.lengths)[:, None], np.log(prior / prior.sum())


def lettered(texts: pa.Array) -> np.ndarray:
    """Which texts have a letter."""
    found = pc.match_substring_regex(pc.fill_null(texts, ""), r"\pL").to_numpy(zero_copy_only=False)
    return np.asarray(found, dtype=bool)


def _predicted(model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, langs, weights, prior = model.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = named(part, "text")
                has = lettered(texts) & bool(langs)
                lower = pc.utf8_lower(pc.fill_null(texts, ""))
                score = np.zeros(part.num_rows)
                name = np.array(["und"] * part.num_rows, dtype=object)
                if langs:
                    total = text_scores(lower, table, weights) + prior
                    best = total.argmax(1)
                    chance = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                    score[has], name[has] = chance[has], np.array(langs, dtype=object)[best[has]]
                yield pa.RecordBatch.from_arrays(
                    [named(part, "doc_id"), pa.array(name.tolist(), pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"]
                )

    return predict


def identified(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(learned(docs.select("doc_id", "text", "lang"), path))
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_predicted(model), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op3(docs: DataFrame) -> DataFrame:
    return identified(docs).select("doc_id", (remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "lang_pred", "score")
