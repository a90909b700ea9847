"""Toxicity by a convolutional text classifier, trained here in numpy.

Each word is hashed as a whole and by its first letters into two embedding tables, so a
word shares both of its rows with an unlike one hardly ever, and one that the sample
does not hold still has the row of its stem.  Filters of one, two and three words run over the whole
text, each keeps its largest value (max pooling), and a logistic unit joins them.  The
first embedding coordinate starts from the word's smoothed log-odds in the sample, all
else from small random numbers.  Scores are calibrated to probabilities; thresholds are then
set for each language.

The model learns from a bounded sample of the labelled rows (``MOST`` rows, ``CHARS`` characters).  Calibration and
thresholds look at every labelled row that is not held out, each by the logit of a model
that was not fitted on it: rows outside the sample by the model itself, rows of the sample
by one fitted on the other folds.  Scoring reads every whole text and nothing else.  Null and empty texts get the score of a text
without words.  Rows of unknown language, or one with few labels, take ``THRESHOLD``.
With labels of one kind only, or none, every score is their smoothed mean.  Repeated
rows get equal scores; labels given twice for a document count once, toxic if any is, and a
document given twice is learned from once, by the row of the least text hash.
An empty table of documents gives no rows; texts of any length are read whole, and further columns
play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.llm.chunks import ChunkTable, flat
from censa.llm.shared import kept, steps

ROWS = 1 << 17
STEM = 5
WIDTH = 8
FILTERS = {1: 8, 2: 4, 3: 4}
PAD = 3
#: Labelled documents the model is fitted on, toxic and clean ones, at most.
MOST = {1: 1200, 0: 2800}
#: Characters of the documents the model is fitted on at most, toxic and clean ones (one document of each kind at least).
CHARS = {1: 20_000_000, 0: 40_000_000}
EPOCHS, BATCH, RATE, DECAY = 16, 32, 0.05, 1e-4
THRESHOLD = 0.7
#: Parts of the sample; each gets its logits from a model fitted on the others.
FOLDS = 5
#: Labelled toxic rows a language needs for a threshold of its own, of all that are not held out.
LEAST = 20
#: Bins of logits, for one unit.
BINS = 50
SEED = 11

WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _row(text: str) -> int:
    return xxhash.xxh32_intdigest(text) % (ROWS - 1) + 1


@lru_cache(maxsize=1)
def word_table() -> ChunkTable:
    """Chunks to the two table rows (word, stem) of each of their words; row 0 is padding."""

    def rows(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for chunk in chunks:
            words = WORD.findall(chunk.lower())
            out.append([_row(w) << 32 | _row(w[:STEM] + "*") for w in words])
        return flat(out, np.int64)

    return ChunkTable(rows, np.int64, 750_000)


def padded(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with padding after each, as two columns of table rows, and the texts' starts."""
    sizes = np.diff(bounds) + PAD
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)) * PAD, sizes - PAD)
    out = np.zeros((int(sizes.sum()), 2), np.int64)
    out[place, 0], out[place, 1] = codes >> 32, codes & 0xFFFFFFFF
    return out, starts


class Model:
    """Embedding tables, filters and the joining unit."""

    def __init__(self, tables: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.tables = tables  # 2 x ROWS x WIDTH
        #: For each width: word place x embedding x filter.
        self.filters = {w: rng.normal(0, 0.1, (w, 2 * WIDTH, f)) for w, f in FILTERS.items()}
        self.filters[1][0, [0, WIDTH], 0] = 1.0  # one filter starts as the log-odds
        self.bias = {w: np.zeros(f) for w, f in FILTERS.items()}
        self.join = np.concatenate([np.full(f, 0.1) for f in FILTERS.values()])
        self.base = 0.0

    def forward(self, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pooled values, the place of each, and the logit of every text."""
        vectors = np.concatenate([self.tables[0][rows[:, 0]], self.tables[1][rows[:, 1]]], axis=1)
        pooled, places = [], []
        for w, taps in self.filters.items():
            values = vectors @ taps[0]
            for k in range(1, w):
                values[:-k] += vectors[k:] @ taps[k]
            values = np.maximum(values + self.bias[w], 0)
            # Only places from which the filter stays within the text and its own padding.
            ends = np.append(starts[1:], len(rows)) - (w - 1)
            at = np.stack([s + values[s:e].argmax(axis=0) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
            places.append(at)
            pooled.append(np.take_along_axis(values, at, axis=0))
        pooled_all = np.concatenate(pooled, axis=1)
        return pooled_all, np.concatenate(places, axis=1), pooled_all @ self.join + self.base

    def fit(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """Logistic loss by Adagrad; the gradient of a filter runs through its largest value only."""
        rng = np.random.default_rng(SEED)
        self.base = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
        sums = {"t": np.full(self.tables.shape, 0.01), "j": np.full(self.join.shape, 0.01), "b": 0.01}
        sums |= {("f", w): np.full(t.shape, 0.01) for w, t in self.filters.items()} | {("o", w): np.full(b.shape, 0.01) for w, b in self.bias.items()}

        def moved(key, value, grad):
            sums[key] = sums[key] + grad * grad
            return value - RATE * grad / np.sqrt(sums[key])

        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for low in range(0, len(order), BATCH):
                batch = order[low : low + BATCH]
                rows, starts = padded(np.concatenate([texts[i] for i in batch]), np.concatenate([[0], np.cumsum([len(texts[i]) for i in batch])]))
                pooled, places, logits = self.forward(rows, starts)
                wrong = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[batch]) / len(batch)
                back = wrong[:, None] * self.join * (pooled > 0)
                touched: list[np.ndarray] = []
                grads: list[np.ndarray] = []
                column = 0
                for w, taps in self.filters.items():
                    grad = np.zeros_like(taps)
                    own = slice(column, column + taps.shape[2])
                    for k in range(w):
                        at = np.minimum(places[:, own] + k, len(rows) - 1)  # texts x filters
                        vectors = np.concatenate([self.tables[0][rows[at, 0]], self.tables[1][rows[at, 1]]], axis=2)
                        grad[k] = np.einsum("nf,nfd->df", back[:, own], vectors)
                        touched.append(at.ravel())
                        grads.append((back[:, own, None] * taps[k].T).reshape(-1, 2 * WIDTH))
                    self.filters[w] = moved(("f", w), taps, grad + DECAY * taps)
                    self.bias[w] = moved(("o", w), self.bias[w], back[:, own].sum(axis=0))
                    column += taps.shape[2]
                self.join = moved("j", self.join, wrong @ pooled + DECAY * self.join)
                self.base = float(moved("b", self.base, wrong.sum()))
                at, grad = np.concatenate(touched), np.concatenate(grads)
                for t in (0, 1):
                    which, place = np.unique(rows[at, t], return_inverse=True)
                    total = np.zeros((len(which), WIDTH))
                    np.add.at(total, place, grad[:, t * WIDTH : (t + 1) * WIDTH])
                    total[which == 0] = 0
                    sums["t"][t, which] += total * total
                    self.tables[t, which] -= RATE * total / np.sqrt(sums["t"][t, which])

    def tapped(self) -> dict:
        """What scoring needs: for each table row its share in every filter, as one gather."""
        shares = {(w, k, t): (self.tables[t] @ taps[k][t * WIDTH : (t + 1) * WIDTH]).astype(np.float32) for w, taps in self.filters.items() for k in range(w) for t in (0, 1)}
        return {"shares": shares, "bias": self.bias, "join": self.join, "base": self.base}


def calibrated(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> dict[str, float]:
    """Slope and shift that make the logits log-odds, by Newton steps with a prior on both."""
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _probability(x @ at)
        grad = x.T @ (counts * (p - labels)) + 0.1 * (at - [1.0, 0.0])
        at = at - np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), grad)
    return {"slope": max(float(at[0]), 0.0), "shift": float(at[1])}


def _probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.round(np.clip(logits, -30, 30) * BINS).astype(np.int32)


def scores(model: dict, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The score of each text, 0 to 1."""
    if "constant" in model:
        return np.full(len(bounds) - 1, model["constant"])
    return _probability(model["slope"] * _logits(model, codes, bounds) + model["shift"])


def _logits(model: dict, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    rows, starts = padded(codes, bounds)
    pooled = []
    for w, bias in model["bias"].items():
        values = model["shares"][w, 0, 0][rows[:, 0]]
        values += model["shares"][w, 0, 1][rows[:, 1]]
        for k in range(1, w):
            values[:-k] += model["shares"][w, k, 0][rows[k:, 0]]
            values[:-k] += model["shares"][w, k, 1][rows[k:, 1]]
            values[np.append(starts[1:], len(rows)) - k] = -np.inf  # the filter would run into the next text
        pooled.append(np.maximum(np.maximum.reduceat(values, starts, axis=0) + bias, 0))
    return np.concatenate(pooled, axis=1) @ model["join"] + model["base"]


def trained(documents: DataFrame, labels: DataFrame) -> dict:
    """The model and its thresholds by language, from labelled rows that are not held out."""
    told = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    told = told.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    counts = {r["toxic"]: r["n"] for r in told.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = {k: counts.get(k, 0) for k in (0, 1)}
    if not all(seen.values()):
        return {"constant": (seen[1] + 0.5) / (sum(seen.values()) + 1), "thresholds": {}}
    order = F.xxhash64("doc_id")
    sample = told.filter("toxic = 1").orderBy(order, "doc_id").limit(MOST[1]).unionByName(told.filter("toxic = 0").orderBy(order, "doc_id").limit(MOST[0]))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            codes, bounds = word_table().rows(texts)
            own = [codes[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "lang", "toxic")), pa.array(own, pa.binary())], ["doc_id", "lang", "toxic", "codes"])

    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    text = text.withColumn("hash", F.xxhash64("text"))
    # The sample has at most sum(MOST) rows of two numbers; repeated documents become one before they are shuffled.
    single = text.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("hash", "lang", "text")).alias("row"))
    single = kept(single.select("doc_id", "row.lang", "toxic", "row.text"), "toxicity-sample")
    fits = _within(single.select("doc_id", "toxic", F.length("text").alias("n")).collect())
    wanted = documents.sparkSession.createDataFrame([(doc,) for doc in fits], "doc_id long")
    found = single.join(F.broadcast(wanted), "doc_id", "left_semi").mapInArrow(coded, "doc_id long, lang string, toxic int, codes binary").collect()
    found = sorted(found, key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"])), r["codes"]))
    if len({r["toxic"] for r in found}) < 2:
        return {"constant": (seen[1] + 0.5) / (sum(seen.values()) + 1), "thresholds": {}}
    texts = [np.frombuffer(r["codes"], np.int64) for r in found]
    toxic = np.array([r["toxic"] for r in found], float)
    fold = np.zeros(len(found), int)
    for k in (0, 1):
        fold[toxic == k] = np.arange((toxic == k).sum()) % FOLDS
    context = documents.sparkSession.sparkContext
    held = context.broadcast((texts, toxic, fold))

    def fitted(k: int) -> tuple[dict, list[np.ndarray], list[np.ndarray]] | list[float]:
        """The logits of fold ``k`` by a model of the others; after the last fold the model of the whole sample.

        Only table rows of the sample's words are handed back; all others are as they were before the fit.
        """
        texts, toxic, fold = held.value
        rest = np.flatnonzero(fold != k).tolist()
        model = Model(_log_odds([texts[i] for i in rest], toxic[rest]))
        model.fit([texts[i] for i in rest], toxic[rest])
        if k == FOLDS:
            words = np.concatenate(texts)
            used = [np.unique(words >> 32), np.unique(words & 0xFFFFFFFF)]
            learned = [model.tables[t][used[t]] for t in (0, 1)]
            model.tables = None
            return vars(model), used, learned
        return [float(model.forward(*padded(texts[i], np.array([0, len(texts[i])])))[2][0]) for i in np.flatnonzero(fold == k).tolist()]

    *parts, (learned, used, values) = context.parallelize(range(FOLDS + 1), FOLDS + 1).map(fitted).collect()
    held.destroy()
    model = Model(_log_odds([], np.zeros(0)))
    vars(model).update(learned | {"tables": model.tables})
    for t in (0, 1):
        model.tables[t, used[t]] = values[t]
    out = model.tapped()
    bins = np.zeros(len(found), np.int32)
    for k, part in enumerate(parts):
        bins[fold == k] = _bins(np.array(part))
    counted = [(r["lang"], r["toxic"], b, 1) for r, b in zip(found, bins.tolist(), strict=True)]
    if len(found) < sum(seen.values()):
        used = documents.sparkSession.createDataFrame([(r["doc_id"],) for r in found], "doc_id long")
        held = context.broadcast(out)
        counted += [tuple(r) for r in _rest(text, told, used, held).collect()]
        held.destroy()
    langs, label, x, counts = (list(c) for c in zip(*counted, strict=True))
    label, x, counts = np.array(label, float), np.array(x) / BINS, np.array(counts, float)
    out |= calibrated(x, label, counts)
    out["thresholds"] = _thresholds(_probability(out["slope"] * x + out["shift"]), label, counts, langs)
    return out


def _within(sizes: list) -> list[int]:
    """Documents of the sample, in the order of a hash, that together stay within CHARS."""
    out = []
    for kind, most in CHARS.items():
        total = 0
        for row in sorted((r for r in sizes if r["toxic"] == kind), key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"])), r["doc_id"])):
            if total and total + (row["n"] or 0) > most:
                continue
            total += max(row["n"] or 0, 1)
            out.append(row["doc_id"])
    return out


def _rest(text: DataFrame, told: DataFrame, used: DataFrame, held: Broadcast) -> DataFrame:
    """``lang``, ``toxic``, ``bin`` and number of the labelled documents outside the sample.

    Texts are scored where they are read; only numbers are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            own = _bins(_logits(held.value, *word_table().rows(texts)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "lang", "hash")), pa.array(own)], ["doc_id", "lang", "hash", "bin"])

    rows = text.filter(~held_out(F.col("doc_id"))).mapInArrow(run, "doc_id long, lang string, hash long, bin int")
    single = rows.groupBy("doc_id").agg(F.min(F.struct("hash", "lang", "bin")).alias("row"))
    # As many rows as the sample, of one number.
    rest = told.join(F.broadcast(used), "doc_id", "left_anti")
    return single.join(rest, "doc_id").groupBy("row.lang", "toxic", "row.bin").agg(F.count(F.lit(1)).alias("n"))


def _log_odds(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Tables whose first coordinate holds each row's smoothed log-odds, shrunk where it was seen in few texts."""
    tables = np.random.default_rng(SEED).normal(0, 0.05, (2, ROWS, WIDTH))
    for t in (0, 1):
        seen = np.zeros((2, ROWS))
        for codes, label in zip(texts, toxic.astype(int).tolist(), strict=True):
            seen[label, np.unique(codes >> 32 if t == 0 else codes & 0xFFFFFFFF)] += 1
        odds = np.log((seen[1] + 0.3) / (toxic.sum() + 1)) - np.log((seen[0] + 0.3) / (len(toxic) - toxic.sum() + 1))
        both = seen.sum(axis=0)
        tables[t, :, 0] = np.maximum(odds * both / (both + 2), 0) / 2
    tables[:, 0] = 0
    return tables


def _thresholds(score: np.ndarray, toxic: np.ndarray, counts: np.ndarray, langs: list[str | None]) -> dict[str, float]:
    """For each language with LEAST toxic rows the threshold of the best F1, nearest to THRESHOLD."""
    out = {}
    names = np.array([x or "" for x in langs])
    for lang in sorted(set(names) - {""}):
        own = names == lang
        if (counts[own] * toxic[own]).sum() < LEAST:
            continue
        best = (-1.0, 0.0, THRESHOLD)
        for threshold in np.arange(0.3, 0.96, 0.05).round(2).tolist():
            hit = counts[own] * (score[own] >= threshold)
            f1 = 2 * (hit * toxic[own]).sum() / (hit.sum() + (counts[own] * toxic[own]).sum())
            best = max(best, (round(float(f1), 4), -abs(threshold - THRESHOLD), threshold))
        out[lang] = best[2]
    return out


def scored(documents: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, and ``rejected`` by the threshold of the row's language."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            found = scores(held.value, *word_table().rows(texts))
            limits = np.array([held.value["thresholds"].get(x, THRESHOLD) for x in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32)), pa.array(limits), pa.array(found >= limits)],
                ["doc_id", "held_out", "score", "predicted", "language_threshold", "rejected"],
            )

    doc_id = F.col("doc_id").cast("long")
    rows = documents.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, language_threshold double, rejected boolean")


def accepted(documents: DataFrame, model: dict) -> DataFrame:
    """The rows that are not rejected, with their columns."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            found = scores(held.value, *word_table().rows(texts))
            limits = np.array([held.value["thresholds"].get(x, THRESHOLD) for x in batch.column("lang").to_pylist()])
            yield batch.filter(pa.array(found < limits))

    return documents.mapInArrow(run, documents.schema)
