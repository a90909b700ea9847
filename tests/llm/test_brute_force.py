"""Classifier, packing and pipeline against plain Python."""

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from conftest import rows  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from censa.llm import exact_dedup, near_dedup, packing, toxicity
from censa.llm.queries import TOKENIZER
from censa.llm.shared import kept, release
from censa.session import shared_folder

from llm_texts import package, prose  # noqa: F401
from test_documents import brute_similarity, labelled


def some_model(seed, n_rows=50):
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 1, (2, toxicity.ROWS, toxicity.WIDTH))
    tables[:, 0] = 0
    model = toxicity.Model(tables)
    model.bias = {w: rng.normal(0, 0.3, f) for w, f in toxicity.FILTERS.items()}
    model.join = rng.normal(0, 1, sum(toxicity.FILTERS.values()))
    model.base = 0.3
    texts = [rng.integers(1, n_rows, (rng.integers(0, 9), 2)) for _ in range(12)]
    return model, texts, [(t[:, 0] << 32 | t[:, 1]).astype(np.int64) for t in texts]


def naive_logit(model, text):
    """One text, filter by filter and place by place; PAD words of nothing follow it."""
    words = [np.concatenate([model.tables[0][a], model.tables[1][b]]) for a, b in text.tolist()] + [np.zeros(2 * toxicity.WIDTH)] * toxicity.PAD
    pooled = []
    for w, taps in model.filters.items():
        for f in range(taps.shape[2]):
            best = 0.0
            for at in range(len(words)):
                value = model.bias[w][f]
                for k in range(w):
                    if at + k < len(words):
                        value += sum(words[at + k][d] * taps[k, d, f] for d in range(2 * toxicity.WIDTH))
                best = max(best, value)
            pooled.append(best)
    return sum(p * j for p, j in zip(pooled, model.join.tolist(), strict=True)) + model.base


def test_convolution_is_that_of_plain_loops():
    model, texts, codes = some_model(1)
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    want = [naive_logit(model, t) for t in texts]
    flat = np.concatenate(codes)
    assert model.forward(*toxicity.padded(flat, bounds))[2] == pytest.approx(want, abs=1e-9)
    scored = toxicity.scores(model.tapped() | {"slope": 1.5, "shift": -0.2}, flat, bounds)
    assert scored == pytest.approx([1 / (1 + np.exp(-(1.5 * x - 0.2))) for x in want], abs=1e-5)


def test_a_fitting_step_follows_the_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    model, texts, codes = some_model(2)
    labels = np.array([k % 2 for k in range(len(texts))], float)
    model.base = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))  # as the fit sets it

    def loss():
        out = 0.0
        for text, label in zip(texts, labels, strict=True):
            logit = naive_logit(model, text)
            out += np.log1p(np.exp(-logit if label else logit)) / len(texts)
        return out + toxicity.DECAY / 2 * (sum((t**2).sum() for t in model.filters.values()) + (model.join**2).sum())

    def slope(array, at):
        step, was = 1e-6, array[at]
        array[at] = was + step
        up = loss()
        array[at] = was - step
        down = loss()
        array[at] = was
        return (up - down) / (2 * step)

    rng = np.random.default_rng(5)
    used = sorted({int(a) for t in texts for a in t[:, 0]})
    places = [("join", model.join, (int(i),)) for i in rng.integers(0, len(model.join), 4)]
    for w, taps in model.filters.items():
        places += [(("f", w), taps, tuple(int(rng.integers(0, n)) for n in taps.shape)) for _ in range(4)]
        places += [(("o", w), model.bias[w], (int(rng.integers(0, len(model.bias[w]))),))]
    places += [("t", model.tables, (0, int(rng.choice(used)), int(rng.integers(0, toxicity.WIDTH)))) for _ in range(6)]
    want = [slope(array, at) for _, array, at in places]
    before = [array[at] for _, array, at in places]
    model.fit(codes, labels)
    now = {"join": model.join, "t": model.tables} | {("f", w): t for w, t in model.filters.items()} | {("o", w): b for w, b in model.bias.items()}
    for (name, _, at), grad, was in zip(places, want, before, strict=True):
        # One Adagrad step whose sum of squares began at 0.01.
        assert now[name][at] == pytest.approx(was - toxicity.RATE * grad / np.sqrt(0.01 + grad * grad), abs=1e-6), name


def plain_packing(pieces, capacity):
    """Bins of single pieces: the longest that fit, then two unpacked ones for the smallest as long as that is tighter."""
    left, bins = sorted(pieces, reverse=True), 0
    while left:
        free, items, gap = list(left), [], capacity
        for length in left:
            if length <= gap:
                items.append(length)
                free.remove(length)
                gap -= length
        while gap and len(free) > 1:
            smallest = min(items)
            room = gap + smallest
            pairs = [(a + b, a, b) for i, a in enumerate(free) for b in free[i + 1 :] if a + b <= room]
            if not pairs or max(pairs)[0] <= smallest:
                break
            total, a, b = max(pairs, key=lambda p: (p[0], -max(p[1:])))
            items.remove(smallest)
            free.append(smallest)
            for x in (a, b):
                items.append(x)
                free.remove(x)
            gap = room - total
        left = sorted(free, reverse=True)
        bins += 1
    return bins


def test_patterns_use_as_many_bins_as_plain_packing():
    rng = random.Random(11)
    for _ in range(60):
        capacity = rng.choice([10, 32, 100])
        pieces = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.4:
            pieces += [rng.randint(1, capacity // 2)] * rng.randint(1, 30)
        slots = packing.plan({n: pieces.count(n) for n in set(pieces)}, capacity)
        used = int((slots["bin"] + (slots["high"] - slots["low"]) // slots["uses"]).max()) if pieces else 0
        assert used == plain_packing(pieces, capacity)
        assert used >= -(-sum(pieces) // capacity)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, toxic, equal and nearly equal documents, some of them odd, and labels for a part."""
    rng = random.Random(21)
    data, labels = [], []

    def add(text, lang="en"):
        data.append((len(data), text, lang, "s", len(text or "")))
        return len(data) - 1

    def toxic(words):
        words = list(words)
        for _ in range(rng.randint(2, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(["vilewort", "nastyling", "grimthing"]) + rng.choice(["", ",", "!"]))
        return " ".join(words)

    for k in range(700):
        words = prose(rng.randint(20, 150), 5000 + k).split()
        bad = rng.random() < 0.25
        doc = add(toxic(words) if bad else " ".join(words), rng.choice(["en", "xx", None]))
        if k < 600:
            labels.append((doc, int(bad)))
    clean = [d for d, bad in labels if not bad][:60]
    for doc in clean[:20]:  # exact copies but for white space
        add(data[doc][1].replace(" ", " \t\n", 3))
    near = {}
    for doc in clean[20:45]:  # a changed word in the middle of a long text, and a copy of that
        words = data[doc][1].split() + prose(200, doc).split()
        first = add(" ".join(words))
        words[rng.randrange(len(words))] = "changed"
        near[first] = add(" ".join(words))
    for text in (None, "", "  ", "one two", prose(9000, 77), "x" * 30_000):
        add(text)
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), data, dict(labels), near


def test_pipeline_is_that_of_plain_python(spark, corpus):
    folder, data, labels, near = corpus
    found = corpus_pipeline.run(spark, folder).collect()
    # Stage 1: each text scored for itself by the model that the labels give.
    documents, told = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.trained(documents, told)
    left = []
    for doc, text, lang, *_ in data:
        score = toxicity.scores(model, *toxicity.word_table().rows([text or ""]))[0]
        if score < model["thresholds"].get(lang, toxicity.THRESHOLD):
            left.append((doc, text or ""))
    gone = {d for d, *_ in data} - {d for d, _ in left}
    bad = {d for d, t, *_ in data if t and re.search("vilewort|nastyling|grimthing", t)}
    assert len(bad - gone) <= 0.03 * len(bad) and len(gone - bad) <= 0.01 * len(data)
    # Stage 2: equal texts, the smallest number stays.
    first = {}
    for doc, text in left:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc)
    left = [(doc, text) for doc, text in left if doc in set(first.values())]
    # Stage 3: classes of all pairs.
    above = {doc: doc for doc, _ in left}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    runs = {doc: labelled(text) for doc, text in left}
    sets = {doc: set(r) for doc, r in runs.items()}
    for i, (a, _) in enumerate(left):
        for b, _ in left[:i]:
            low, high = sorted((len(runs[a]), len(runs[b])))
            common = len(sets[a] & sets[b])
            if low >= 0.8 * high and common >= 0.8 * (low + high - common) and brute_similarity(runs[a], runs[b]) >= 0.8:
                low, high = sorted((root(a), root(b)))
                above[high] = low
    assert sum(root(b) == root(a) for a, b in near.items() if a in above and b in above) == len([a for a, b in near.items() if a in above and b in above]) > 15
    left = [(doc, text) for doc, text in left if root(doc) == doc]
    # Stage 4: the pieces of each document, in sequences without gaps.
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    want = set()
    for doc, text in left:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            piece = ids[start : start + 4096]
            want.add((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found} == want and len(found) == len(want)
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in places.values():
        assert [o for o, _ in sorted(items)] == [sum(n for _, n in sorted(items)[:k]) for k in range(len(items))]
        assert sum(n for _, n in items) <= 4096
    assert len(places) == plain_packing([n for *_, n, _ in want], 4096)


def test_stages_take_what_the_one_before_kept(spark, corpus):
    """Each stage on its own input, with the columns of documents."""
    folder, data, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "packing"]
    for (name, stage), brute in zip(corpus_pipeline.STAGES[1:3], (exact_dedup.groups, near_dedup.classes), strict=True):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in brute(docs).filter("kept").collect())


def test_kept_tables_lie_in_one_folder_that_can_go(spark):
    first = kept(spark.range(3), "one")
    assert first.count() == 3
    folder = Path(shared_folder(spark)) / f"kept-{spark.sparkContext.applicationId}"
    assert list(folder.glob("one-*"))
    release(spark)
    assert not folder.exists()
    release(spark)
    assert kept(spark.range(2), "two").count() == 2
