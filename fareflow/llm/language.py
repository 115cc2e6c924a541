"""Language spans in mixed text: script ranges narrow the candidates, Viterbi labels the words.

Learning counts letter trigrams (each letter with its neighbours in the word) per language and
letters per language and script, over all documents given to learn from; both tables have a fixed
number of cells per language. A word's score for a language is the sum of its letters' log
probabilities; languages that do not use the word's script are no candidates. The best path pays
``SWITCH`` for every change of language. A document's language is the one with most letters.

Rows: a null text, or one without letters, is ``und`` with score 0; without anything to learn
from every document is; very long texts are labelled whole; repeated rows are handled one by one; ties go to the smaller name; empty
input gives empty output. Columns besides ``doc_id``, ``text`` and (to learn) ``lang`` are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.texts import pieces

CELLS = 1 << 16
SMOOTH = 0.05
SWITCH = 12.0
#: A language uses a script if this share of its letters is in it.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"
#: First code points of script ranges: Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic, Indic and
#: South-East Asian, Georgian, Hangul letters, Ethiopic and others, Latin and Greek additions,
#: Japanese, Han, Yi and others, Hangul, compatibility and beyond.
SCRIPTS = np.array([
    0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x3040, 0x3400, 0xA000, 0xAC00, 0xD800,
])
TOP = 0x110000


@cache
def letter_codes() -> np.ndarray:
    """Per code point its lower-case letter, or 0 if it is no letter."""
    codes = np.zeros(TOP, dtype=np.uint32)
    for c in range(TOP):
        char = chr(c)
        if char.isalpha():
            low = char.lower()
            codes[c] = ord(low) if len(low) == 1 else c
    return codes


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters one after the other, 0 between words, and the texts' starts."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return letter_codes()[points], starts


def trigram_cells(letters: np.ndarray) -> np.ndarray:
    """A table cell for every letter with its two neighbours."""
    x = letters.astype(np.uint64)
    left, right = np.r_[np.uint64(0), x[:-1]], np.r_[x[1:], np.uint64(0)]
    mixed = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (left * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (right * np.uint64(0x165667B19E3779F9))
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


def script_of(letters: np.ndarray) -> np.ndarray:
    return np.searchsorted(SCRIPTS, letters, side="right") - 1


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # cells x languages, log probabilities
    uses: np.ndarray  # scripts x languages


def learn(docs: DataFrame) -> LanguageModel:
    """Count over all rows of (text, lang).

    A task adds its counts up per language; at most ``CELLS`` and the scripts come to the driver
    per language, whatever the size of the corpus.
    """
    scripts = len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in pieces(batches):
            names = np.array(part.column("lang").to_pylist(), dtype=object)
            texts = part.column("text").to_pylist()
            for name in sorted(set(names)):
                letters, _ = letters_of([t for t, n in zip(texts, names) if n == name])
                at = np.flatnonzero(letters)
                mine = totals.setdefault(name, np.zeros(CELLS + scripts, dtype=np.int64))
                mine[:CELLS] += np.bincount(trigram_cells(letters)[at], minlength=CELLS)
                mine[CELLS:] += np.bincount(script_of(letters[at]), minlength=scripts)
        for name, mine in totals.items():
            cells = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells)), pa.array(cells.astype(np.int32)), pa.array(mine[cells])],
                names=["lang", "cell", "n"],
            )

    known = docs.select("text", "lang").filter("text is not null and lang is not null")
    counted = known.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    names = table.column("lang").to_numpy()
    languages = sorted(set(names))
    place = {n: k for k, n in enumerate(languages)}
    counts = np.zeros((CELLS + scripts, len(languages)))
    counts[table.column("cell").to_numpy(), [place[n] for n in names]] = table.column("n").to_numpy()
    cells, by_script = counts[:CELLS], counts[CELLS:]
    scores = np.log((cells + SMOOTH) / (cells.sum(axis=0) + SMOOTH * CELLS))
    uses = by_script >= SCRIPT_SHARE * np.maximum(by_script.sum(axis=0), 1)
    uses[~uses.any(axis=1)] = True  # a script no language uses narrows nothing
    return LanguageModel(languages, scores.astype(np.float32), uses)


def best_paths(scores: np.ndarray, starts: np.ndarray, ends: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language per word, for many documents at once: word k of all documents in turn.

    ``scores`` has a row per word; document d has the words from ``starts[d]`` to ``ends[d]``.
    """
    path = np.zeros(len(scores), dtype=np.int64)
    came = np.zeros(scores.shape, dtype=np.int16)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    alive = int(np.searchsorted(-lengths, 0, side="left"))
    best = scores[starts[:alive]].astype(np.float64)
    last = best.copy()
    own = np.arange(scores.shape[1])
    step = 1
    while alive:
        still = int(np.searchsorted(-lengths[:alive], -step, side="left"))
        last[still:alive] = best[still:alive]
        alive = still
        if not alive:
            break
        now = best[:alive]
        top = now.argmax(axis=1)
        jump = now[np.arange(alive), top] - switch
        stay = now >= jump[:, None]
        at = starts[:alive] + step
        came[at] = np.where(stay, own, top[:, None])
        best[:alive] = np.where(stay, now, jump[:, None]) + scores[at]
        step += 1
    alive = int(np.searchsorted(-lengths, 0, side="left"))
    state = last[:alive].argmax(axis=1) if alive else np.zeros(0, dtype=np.int64)
    # backward: documents join when their last word is reached
    for step in range(int(lengths[0]) - 1 if alive else -1, -1, -1):
        n = int(np.searchsorted(-lengths[:alive], -step, side="left"))
        at = starts[:n] + step
        path[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return path


def sure_paths(scores: np.ndarray, of: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best path of every document, searched in stretches between words that are sure.

    A word whose language leads all others by more than two changes has that language on every best
    path: another one there could be replaced at the cost of two changes at most. So the paths
    before and after it are independent, and a very long text is many short searches side by side.
    """
    if scores.shape[1] < 2:
        return np.zeros(len(scores), dtype=np.int64)
    two = np.partition(scores, -2, axis=1)[:, -2:]
    sure = two[:, 1] - two[:, 0] > 2 * switch
    at = np.flatnonzero(sure)
    pinned = scores.copy()
    best = scores[at].argmax(axis=1)
    pinned[at] = -1e9
    pinned[at, best] = scores[at, best]
    starts = np.union1d(of[:-1][of[:-1] < of[1:]], at)
    doc_end = of[1:][np.searchsorted(of, starts, side="right") - 1]
    after = np.r_[starts[1:], len(scores)]
    # a stretch ends with the sure word that the next one begins with
    return best_paths(pinned, starts, np.where(after < doc_end, after + 1, doc_end), switch)


def label(texts: list[str], model: LanguageModel, switch: float = SWITCH):
    """Per text: spans (start, end, language number) in code points, and letters per language."""
    letters, starts = letters_of(texts)
    inside = letters > 0
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    n = len(model.languages)
    letter_total = np.zeros((len(texts), n), dtype=np.int64)
    if not len(begin) or not n:
        return begin, end, np.zeros(len(begin), dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64), letter_total
    at = np.flatnonzero(inside)
    words = np.cumsum(np.r_[0, end - begin])[:-1]
    scores = np.add.reduceat(model.scores[trigram_cells(letters)[at]], words, axis=0)
    scores[~model.uses[script_of(letters[begin])]] = -1e9
    of = np.searchsorted(begin, starts)
    path = sure_paths(scores, of, switch)
    doc = np.repeat(np.arange(len(texts)), np.diff(of))
    letter_total += np.bincount(doc * n + path, weights=end - begin, minlength=letter_total.size).astype(np.int64).reshape(-1, n)
    return begin, end, path, of, letter_total


def predict(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score (its share of the letters) and n_spans of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in pieces(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            _, _, path, of, totals = label(texts, model, switch)
            letters = totals.sum(axis=1)
            top = totals.argmax(axis=1) if len(model.languages) else letters
            names = [model.languages[k] if n else UNKNOWN for k, n in zip(top, letters)]
            share = totals.max(axis=1, initial=0) / np.maximum(letters, 1)
            change = np.r_[0, np.cumsum(path[1:] != path[:-1])] if len(path) else np.zeros(0, dtype=np.int64)
            spans = [int(change[b - 1] - change[a]) + 1 if b > a else 0 for a, b in zip(of[:-1], of[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(share), pa.array(spans, pa.int32())],
                names=["doc_id", "lang_pred", "score", "n_spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(predicted, "doc_id long, lang_pred string, score double, n_spans int")


def language_spans(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """One row per span: doc_id, start, end (code points, of its first and last word), lang."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in pieces(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            begin, end, path, of, _ = label(texts, model, switch)
            doc = np.repeat(np.arange(len(texts)), np.diff(of))
            first = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])]) if len(path) else np.zeros(0, int)
            last = np.r_[first[1:], len(path)] - 1 if len(first) else first
            base = np.cumsum([0, *(len(t) + 1 for t in texts)])[doc[first]]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(doc[first])).cast(pa.int64()),
                    pa.array((begin[first] - base).astype(np.int32)),
                    pa.array((end[last] - base).astype(np.int32)),
                    pa.array([model.languages[k] for k in path[first]], pa.string()),
                ],
                names=["doc_id", "start", "end", "lang"],
            )

    return docs.select("doc_id", "text").mapInArrow(found, "doc_id long, start int, end int, lang string")


def held_out(doc_id):
    """Whether a document is kept out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
