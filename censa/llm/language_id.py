"""Language identification of mixed texts by word scores and a Viterbi path.

*Script ranges* narrow the candidates of a word: it is scored only for the languages that
use its script (at least SHARE of their letters); where no language uses it, all languages are equal.
A *word score* is the log-likelihood of the word's runs of one to ORDER letters (with its
ends) under each language, against the mean over the candidates.  *Viterbi* then finds the
best sequence of languages over all words of a text, where each change costs PENALTY, and
so labels spans.  The share of a text's letters that each span gives a language, by the span's
whole evidence, makes the text's language and score.

The path is exact for texts of any length: words are cut into rows of equal length that are followed
side by side, rows that began from wrong values are followed again, and the path is read back.
A task holds one block of BLOCK_BYTES of text (or one longer text) in arrays.

Counts are taken over all texts that may be learned from, in the tasks that read them;
at most the LANGUAGES most frequent languages are told apart, so the model is bounded.

A null text or one without letters is ``und`` with score 0, as is every text when nothing could be
learned.  Repeated rows get equal results, equal languages go by name.  An empty table gives no
rows.  Other columns play no part in a prediction.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.llm.arrays import blocks, sums

UNKNOWN = "und"
ORDER = 4
#: Hashed runs of letters; one row of counts for each.
ROWS = 1 << 16
#: Words are cut to pieces of this many letters, so unspaced writing has words too.
LETTERS = 24
SHARE = 0.01
#: Cost of a change of language, in natural log-likelihood of one word's average run.
PENALTY = 6.0
#: What overlapping runs of letters count for, against independent ones.
WEIGHT = 0.5
#: Occurrences added to every run of letters.
PRIOR = 0.5
LANGUAGES = 64
BLOCK_BYTES = 1 << 20
#: A score no path takes where there is another.
NEVER = -1e6

#: First and last code points of scripts (Unicode blocks); letters outside stand for a script of their own.
SCRIPTS = [
    ("Latin", 0x0041, 0x024F), ("Latin", 0x1E00, 0x1EFF), ("Latin", 0x2C60, 0x2C7F), ("Latin", 0xA720, 0xA7FF), ("Latin", 0xFF21, 0xFF5A),
    ("Greek", 0x0370, 0x03FF), ("Greek", 0x1F00, 0x1FFF), ("Cyrillic", 0x0400, 0x052F), ("Cyrillic", 0x1C80, 0x1C8F), ("Cyrillic", 0x2DE0, 0x2DFF),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x06FF), ("Arabic", 0x0750, 0x077F), ("Arabic", 0x08A0, 0x08FF),
    ("Arabic", 0xFB50, 0xFDFF), ("Arabic", 0xFE70, 0xFEFF), ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF), ("Oriya", 0x0B00, 0x0B7F), ("Tamil", 0x0B80, 0x0BFF), ("Telugu", 0x0C00, 0x0C7F), ("Kannada", 0x0C80, 0x0CFF),
    ("Malayalam", 0x0D00, 0x0D7F), ("Sinhala", 0x0D80, 0x0DFF), ("Thai", 0x0E00, 0x0E7F), ("Lao", 0x0E80, 0x0EFF), ("Tibetan", 0x0F00, 0x0FFF),
    ("Myanmar", 0x1000, 0x109F), ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Hangul", 0xAC00, 0xD7AF), ("Ethiopic", 0x1200, 0x139F),
    ("Khmer", 0x1780, 0x17FF), ("Mongolian", 0x1800, 0x18AF), ("Kana", 0x3040, 0x30FF), ("Kana", 0x31F0, 0x31FF), ("Han", 0x3400, 0x4DBF),
    ("Han", 0x4E00, 0x9FFF), ("Han", 0xF900, 0xFAFF), ("Han", 0x20000, 0x323AF),
]
NAMES = ["Other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
NOTHING, MARK = 0, 255


def held_out(doc_id: Column) -> Column:
    """Rows whose language is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its script (from 1; 0: no letter, MARK: goes with the letter before) and its lower case."""
    kind = np.zeros(sys.maxunicode + 1, np.uint8)
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(point))
        if category[0] == "L":
            kind[point] = 1
            if category in ("Lu", "Lt") and len(small := chr(point).lower()) == 1:
                lower[point] = ord(small)
        elif category[0] == "M":
            kind[point] = MARK
    for name, first, last in SCRIPTS:
        part = kind[first : last + 1]
        part[part == 1] = NAMES.index(name) + 1
    return kind, lower


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts in UTF-8: lower-case code points, each word's start, end, text and script, and the texts' places."""
    kind, lower = _letters()
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    script = kind[points]
    marks = np.flatnonzero(script == MARK)
    if len(marks):  # each takes the script of the nearest character before that is no mark
        border = np.zeros(len(script), bool)
        border[places[:-1][places[:-1] < len(script)]] = True
        script = script.copy()
        script[marks[border[marks]]] = NOTHING
        solid = np.maximum.accumulate(np.where(script == MARK, 0, np.arange(len(script))))
        script = script[solid]
    starts, ends, text = [], [], []
    cut = np.concatenate([[0], np.flatnonzero(script[1:] != script[:-1]) + 1, places[1:-1], [len(script)]]) if len(script) else np.zeros(1, np.int64)
    cut = np.unique(cut)
    starts, ends = cut[:-1], cut[1:]
    letter = script[starts] != NOTHING if len(starts) else np.zeros(0, bool)
    starts, ends = starts[letter], ends[letter]
    pieces = -(-(ends - starts) // LETTERS)
    if (pieces > 1).any():
        last = np.repeat(ends, pieces)
        starts = np.repeat(starts, pieces) + LETTERS * (np.arange(len(last)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        ends = np.minimum(starts + LETTERS, last)
    text = np.searchsorted(places, starts, "right") - 1
    return lower[points], starts, ends, text, script[starts] if len(starts) else np.zeros(0, np.uint8), places


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One example of each distinct word, and for every word the place of its example."""
    sizes = ends - starts
    power = np.cumprod(np.full(LETTERS, 0x9E3779B97F4A7C15, np.uint64))
    key = sizes.astype(np.uint64)
    for k in range(int(sizes.max()) if len(sizes) else 0):
        own = np.flatnonzero(sizes > k)
        key[own] += _mixed(points[starts[own] + k].astype(np.uint64) + np.uint64(1)) * power[k]
    _, first, place = np.unique(key, return_index=True, return_inverse=True)
    return first, place


def letter_runs(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the count table for all runs of 1 to ORDER signs (ends included) of each word, and how many a word has."""
    sizes = ends - starts + 2
    stops = np.cumsum(sizes)
    at = np.arange(stops[-1] if len(stops) else 0) - np.repeat(stops - sizes, sizes)  # place within the word with its ends
    last = np.repeat(sizes, sizes) - 1
    signs = np.zeros(len(at), np.uint64)
    inner = (at > 0) & (at < last)
    signs[inner] = points[(np.repeat(starts, sizes) + at - 1)[inner]].astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rows, owners = [], []
    key = np.zeros(len(at), np.uint64)
    for n in range(ORDER):
        key = _mixed(key[: len(at) - n] * np.uint64(0x9E3779B97F4A7C15) + signs[n:] + np.uint64(n << 40))
        fits = at[: len(at) - n] + n <= last[: len(at) - n]
        if n == 0:
            fits = fits & inner
        rows.append((key[fits] % np.uint64(ROWS)).astype(np.int64))
        owners.append(owner[: len(at) - n][fits])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(sizes))


def learned(documents: DataFrame) -> dict:
    """The model from ``text`` and ``lang`` of all rows that are not held out.

    Counts are made by the tasks; what comes to the driver is a row for each language and table row.
    """
    rows = documents.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id").cast("long")))
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    frequent = rows.groupBy("lang").agg(F.count("text").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    names = sorted(r["lang"] for r in frequent.collect())
    if not names:
        return {"names": []}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: k for k, name in enumerate(names)}
        counts = np.zeros((len(names), ROWS + 256), np.int64)  # the last 256: letters by script
        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            points, starts, ends, text, script, _ = words(data, offsets)
            lang = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()])
            told = lang[text] >= 0
            starts, ends, lang, script = starts[told], ends[told], lang[text[told]], script[told]
            if not len(starts):
                continue
            np.add.at(counts, (lang, ROWS + script.astype(np.int64)), ends - starts)
            first, place = distinct(points, starts, ends)
            found, n = letter_runs(points, starts[first], ends[first])
            for k in np.unique(lang).tolist():
                often = np.bincount(place[lang == k], minlength=len(first))
                counts[k, :ROWS] += np.bincount(found, np.repeat(often, n), ROWS).astype(np.int64)
        at, row = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(row), pa.array(counts[at, row])], ["lang", "row", "n"])

    counts = np.zeros((len(names), ROWS + 256))
    for r in rows.mapInArrow(run, "lang long, row long, n long").groupBy("lang", "row").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[r.column("lang").to_numpy(), r.column("row").to_numpy()] = r.column("n").to_numpy()
    letters = counts[:, ROWS:]
    known = letters.sum(axis=1) > 0
    if not known.any():
        return {"names": []}
    letters, seen = letters[known], counts[known, :ROWS] + PRIOR
    return {
        "names": [x for x, k in zip(names, known, strict=True) if k],
        "table": np.log(seen / seen.sum(axis=1, keepdims=True)).T.astype(np.float32).copy(),
        "scripts": (letters >= SHARE * letters.sum(axis=1, keepdims=True)).T.copy(),
    }


def word_scores(model: dict, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, script: np.ndarray) -> np.ndarray:
    """For each word its score by language."""
    if not len(starts):
        return np.zeros((0, len(model["names"])), np.float32)
    first, place = distinct(points, starts, ends)
    rows, n = letter_runs(points, starts[first], ends[first])
    total = WEIGHT * np.add.reduceat(model["table"][rows], np.cumsum(n) - n, axis=0)
    able = model["scripts"][script[first].astype(np.int64)]
    some = able.any(axis=1, keepdims=True)
    mean = np.where(able, total, 0).sum(axis=1, keepdims=True) / np.maximum(able.sum(axis=1, keepdims=True), 1)
    scores = np.where(able, total - mean, np.where(some, np.float32(NEVER), np.float32(0)))
    return scores.astype(np.float32)[place]


def path(scores: np.ndarray, new: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word, where a change costs ``penalty`` and is free at a word that is ``new``."""
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    # Rows of equal length are followed side by side; the rest is filled up with words that say nothing.
    length = max(1, int(np.sqrt(n)))
    rows = -(-n // length)
    given = np.zeros((rows * length, k))
    given[:n] = scores
    fresh = np.zeros(rows * length, bool)
    fresh[:n] = new
    given, fresh = given.reshape(rows, length, k), fresh.reshape(rows, length)
    cost = np.where(fresh, 0.0, penalty)
    own = np.arange(k)
    came = np.empty((length, rows, k), np.int16)  # the language before each word, for every language of the word
    # A row begins with what the row before it leaves.  That is first guessed, and rows whose guess
    # was wrong are followed again; evidence soon makes the guess forgotten.
    entry, left = np.zeros((rows, k)), np.zeros((rows, k))
    todo = np.arange(rows)
    while len(todo):
        value = entry[todo]  # the largest is 0
        for t in range(length):
            best, least = value.argmax(axis=1), -cost[todo, t][:, None]
            stay = (value >= least) & ~fresh[todo, t][:, None]
            came[t, todo] = np.where(stay, own, best[:, None])
            value = np.where(stay, value, least) + given[todo, t]
            value = value - value.max(axis=1, keepdims=True)
        left[todo] = value
        todo = 1 + np.flatnonzero((left[:-1] != entry[1:]).any(axis=1))
        entry[todo] = left[todo - 1]
    # Backwards: for each language a row may end in, the languages on the way.
    labels = np.empty((length, rows, k), np.int16)
    now = np.broadcast_to(own.astype(np.int16), (rows, k))
    for t in range(length - 1, -1, -1):
        labels[t] = now
        now = np.take_along_axis(came[t], now.astype(np.int64), axis=1)
    end = np.empty(rows, np.int64)
    end[-1] = left[-1].argmax()
    for r in range(rows - 1, 0, -1):
        end[r - 1] = now[r, end[r]]
    return labels[:, np.arange(rows), end].T.reshape(-1)[:n].astype(np.int64)


def spans(model: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of one language: text, language, start and end in the text; and the share of each text's letters by language."""
    points, starts, ends, text, script, places = words(data, offsets)
    scores = word_scores(model, points, starts, ends, script)
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    # Words that say nothing go with the word before them (the first of a text with the next).
    telling = np.flatnonzero(scores.any(axis=1))
    start_of = np.ones(len(telling), bool)
    start_of[1:] = text[telling[1:]] != text[telling[:-1]]
    found = path(scores[telling], start_of)
    label = np.zeros(len(text), np.int64)
    if len(telling):
        near = np.searchsorted(telling, np.arange(len(text)), "right") - 1
        wrong = (near < 0) | (text[telling[np.maximum(near, 0)]] != text)
        near = np.minimum(np.where(wrong, near + 1, near), len(telling) - 1)
        label = np.where(text[telling[near]] == text, found[near], 0)
    head = new.copy()
    head[1:] |= label[1:] != label[:-1]
    first = np.flatnonzero(head)
    n_texts, k = len(offsets) - 1, len(model["names"])
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros((n_texts, k))
    evidence = np.add.reduceat(scores.astype(np.float64), first, axis=0)
    belief = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    belief /= belief.sum(axis=1, keepdims=True)
    letters = np.add.reduceat((ends - starts).astype(np.float64), first)
    owner = text[first]
    share = sums(belief * letters[:, None], owner, n_texts)
    share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    stop = np.append(first[1:], len(starts)) - 1
    return owner, label[first], starts[first] - places[owner], ends[stop] - places[owner], share


SPANS = "array<struct<start: int, end: int, lang: string>>"


def identified(documents: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``spans`` (code points of the text) of every row."""
    held = documents.sparkSession.sparkContext.broadcast(model)  # LANGUAGES x ROWS numbers at most
    struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = [*model["names"], UNKNOWN]
        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            if model["names"]:
                owner, label, start, end, share = spans(model, data, offsets)
                best = share.argmax(axis=1)  # names are sorted, so the first of equals
                score = share[np.arange(len(best)), best]
                best = np.where(score > 0, best, len(names) - 1)
            else:
                owner = label = start = end = np.zeros(0, np.int64)
                best, score = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
            each = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(names).take(pa.array(label))], fields=list(struct))
            bounds = np.searchsorted(owner, np.arange(len(offsets)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names).take(pa.array(best)), pa.array(np.minimum(score, 1.0)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each)],
                ["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    doc_id = F.col("doc_id").cast("long")
    rows = documents.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, held_out boolean, lang_pred string, score double, spans {SPANS}")
