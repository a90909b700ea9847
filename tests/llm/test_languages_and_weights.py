"""Language spans, token alignment and importance resampling against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from censa.llm import alignment, language_id, resampling
from censa.llm.arrays import blocks
from censa.llm.queries import TOKENIZERS
from censa.llm.tokens import _byte_letters

from llm_texts import messy, nothing, package, prose  # noqa: F401

SYLLABLES = {
    "en": "the er tion ing and st wh ly ea sh".split(), "de": "ein sch ung keit ver zu der lich ä ü".split(),
    "el": "το και ναι σου την ος ει μα".split(), "xx": "kwa zul mbe ngo ila thu".split(),
}


def told(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    data = [(k, told(lang, 5 + k % 60, k), lang if k % 9 else None, "s") for k in range(600) for lang in [list(SYLLABLES)[k % 4]]]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(4)


def worth(scores, new, penalty, labels):
    return sum(scores[t, x] for t, x in enumerate(labels)) - penalty * sum(labels[t] != labels[t - 1] and not new[t] for t in range(1, len(labels)))


def test_path_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for k, n in ((2, 9), (3, 7), (4, 5)):
        for _ in range(15):
            scores, new = rng.normal(0, 2, (n, k)), rng.random(n) < 0.2
            new[0] = True
            best = max(worth(scores, new, 3.0, x) for x in itertools.product(range(k), repeat=n))
            assert worth(scores, new, 3.0, language_id.path(scores, new, 3.0)) == pytest.approx(best)
    for n in (1, 150, 3000):  # against plain steps from word to word
        scores, new = rng.normal(0, 1, (n, 5)), rng.random(n) < 0.01
        new[0] = True
        value = np.zeros(5)
        for t in range(n):
            value = (np.full(5, value.max()) if new[t] else np.maximum(value, value.max() - 4.0)) + scores[t]
        assert worth(scores, new, 4.0, language_id.path(scores, new, 4.0)) == pytest.approx(value.max())
    assert len(language_id.path(np.zeros((0, 3)), np.zeros(0, bool))) == 0


def test_words_and_runs_of_letters():
    texts = ["Ab1cd", "", None, "áb ́x", "日本ab", "x" * 50, "Ωmega-É"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (_, data, offsets), = blocks(iter([batch]), 1 << 20)
    points, starts, ends, text, script, places = language_id.words(data, offsets)
    found = [(int(t), "".join(map(chr, points[a:b])), language_id.NAMES[s - 1]) for t, a, b, s in zip(text, starts, ends, script, strict=True)]
    assert found == [
        (0, "ab", "Latin"), (0, "cd", "Latin"), (3, "áb", "Latin"), (3, "x", "Latin"), (4, "日本", "Han"), (4, "ab", "Latin"),
        (5, "x" * 24, "Latin"), (5, "x" * 24, "Latin"), (5, "xx", "Latin"), (6, "ω", "Greek"), (6, "mega", "Latin"), (6, "é", "Latin"),
    ]
    first, place = language_id.distinct(points, starts, ends)
    spelled = [w for _, w, _ in found]
    assert [spelled[first[p]] for p in place] == spelled and len(first) == len(set(spelled))
    rows, n = language_id.letter_runs(points, starts, ends)
    assert n.tolist() == [sum(max(0, len(w) + 2 - k) for k in range(1, 4)) + len(w) for w in spelled]
    # Equal runs have equal rows wherever they stand.
    bounds = np.cumsum(n)
    assert rows[bounds[6] - n[6] : bounds[6]].tolist() == rows[bounds[7] - n[7] : bounds[7]].tolist()
    assert [t[a:b] for t, a, b in [(texts[4], int(starts[4] - places[4]), int(ends[4] - places[4]))]] == ["日本"]


def test_languages_on_rows_held_out(spark, tongues):
    model = language_id.learned(tongues)
    assert model["names"] == sorted(SYLLABLES)
    found = language_id.identified(tongues, model).join(tongues, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    apart = [r for r in found if r["held_out"]]
    assert len(apart) > 100 and all(r["lang_pred"] == list(SYLLABLES)[r["doc_id"] % 4] for r in apart)
    assert all(0 < r["score"] <= 1 for r in found)
    # Neither number, language nor source is part of a prediction, and no row held out is learned from.
    other = tongues.selectExpr("doc_id + 3000 AS doc_id", "text", "'zz' AS lang", "'q' AS source")
    again = {r["doc_id"] - 3000: (r["lang_pred"], r["score"]) for r in language_id.identified(other, model).collect()}
    assert again == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    changed = language_id.learned(tongues.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'zz' ELSE lang END AS lang"))
    assert changed["names"] == model["names"] and (changed["table"] == model["table"]).all()


def test_spans_of_mixed_texts(spark, tongues):
    model = language_id.learned(tongues)
    parts = [("en", 30), ("de", 25), ("el", 3), ("xx", 40)]
    texts = [told(lang, n, 900 + n) for lang, n in parts]
    whole = "!! " + " ".join(texts) + " 12"
    frame = spark.createDataFrame([(1, whole), (2, "12 — !"), (3, None), (4, ""), (5, "да нет"), (6, whole * 200)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in language_id.identified(frame, model).collect()}
    spans = found[1]["spans"]
    assert [s["lang"] for s in spans] == [lang for lang, _ in parts] and found[1]["lang_pred"] == "xx"
    for s, text in zip(spans, texts, strict=True):
        here = whole[s["start"] : s["end"]]
        assert abs(len(here) - len(text)) < 25 and (here in whole) and here.strip() == here
    assert [found[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and [found[k]["score"] for k in (2, 3, 4)] == [0] * 3
    assert found[5]["lang_pred"] in model["names"] and found[5]["score"] == pytest.approx(0.25)  # a script of no language
    assert found[6]["lang_pred"] == "xx" and len(found[6]["spans"]) >= 700


def test_languages_of_messy_rows_and_without_any(spark, tongues, messy, nothing):
    model = language_id.learned(tongues)
    assert language_id.identified(messy, model).count() == messy.count() and language_id.identified(nothing, model).count() == 0
    assert {r["score"] for r in language_id.identified(messy.filter("doc_id = 2"), model).collect()} == {language_id.identified(messy.filter("doc_id = 1"), model).first()["score"]}
    for none in (nothing, tongues.selectExpr("doc_id", "text", "cast(null AS string) AS lang"), tongues.selectExpr("doc_id", "'' AS text", "lang")):
        assert {r["lang_pred"] for r in language_id.identified(messy, language_id.learned(none)).collect()} == {"und"}


def test_pieces_of_a_merge_give_all_overlaps():
    rng = np.random.default_rng(0)
    for _ in range(80):
        n = int(rng.integers(1, 200))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(1, n + 1)), n)) for _ in range(2))
        start = lambda e: [0, *e[:-1].tolist()]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(start(a)[i], start(b)[j]) < min(a[i], b[j])]
        for work in (None, 1, 3, 1000):
            over_a, over_b, link_a, link_b = alignment.links(a, b, work)
            assert list(zip(over_a.tolist(), over_b.tolist(), strict=True)) == want
            assert a[link_a].tolist() == b[link_b].tolist() == np.intersect1d(a, b).tolist()
        diagonals = np.arange(0, len(a) + len(b))
        merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
        assert alignment.merge_path(a, b, diagonals).tolist() == [sum(side == 0 for _, side in merged[:d]) for d in diagonals.tolist()]


def brute_alignment(pair, text):
    if not text:
        return None
    byte = {v: k for k, v in _byte_letters().items()}
    ids_a, ids_b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    a = [bytes(byte[c] for c in pair.a.id_to_token(i)) for i in ids_a]
    b = [bytes([int(pair.b.id_to_piece(i)[3:5], 16)]) if pair.b.is_byte(i) else pair.b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(a) != (" " + text).encode() or b"".join(b) != (" " + text).encode():
        return None
    ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (a, b))
    groups, linked, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        n, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, ids_a[i:n])) + "|" + ",".join(map(str, ids_b[j:m])))
        linked.append((ids_a[n - 1], ids_b[m - 1]))
        i, j = n, m
    return len(a), len(b), groups, linked


@pytest.mark.parametrize(("part", "most"), [(1 << 23, 1 << 18), (500, 7)])
def test_alignment_is_that_of_plain_loops(spark, messy, nothing, monkeypatch, part, most):
    monkeypatch.setattr(alignment, "PART_BYTES", part)
    monkeypatch.setattr(alignment, "LINKS", most)
    texts = [r["text"] for r in messy.collect() if r["doc_id"] not in (9, 10)]
    texts += ["a▁b", "\x00é<|endoftext|> <s></s> <0x41>", "日本 ＡＢ😀　x", " ", "\n\n  x\ty ", "ﬁ é", "a"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    pair = alignment.tokenizers(*TOKENIZERS)
    want = [brute_alignment(pair, t) for t in texts]
    counts = Counter(p for w in want if w for p in w[3])
    most_of = {}
    for (_, b), n in counts.items():
        most_of[b] = max(n, most_of.get(b, 0))
    found = {r["doc_id"]: r for r in alignment.alignments(frame, *TOKENIZERS).collect()}
    assert len(found) == len(texts) and want.count(None) == 3
    for k, w in enumerate(want):
        r = found[k]
        got = tuple(r[n] for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
        if w is None:
            assert got == (0, 0, 0, 0, 0, 0, "")
        else:
            a, b, groups, linked = w
            best = sum(counts[p] == most_of[p[1]] for p in linked)
            assert got == (a, b, len(groups), len(linked), best, sum(counts[p] for p in linked), hashlib.sha256(";".join(groups).encode()).hexdigest())
    if part == 500:
        assert alignment.alignments(messy, *TOKENIZERS).count() == messy.count()
        assert alignment.alignments(nothing, *TOKENIZERS).count() == 0


def brute_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute_draw(documents, target, percent):
    s, t = (Counter(f for x in texts for f in brute_features(x)[1]) for texts in ([x for _, x in documents], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in documents:
        words, own = brute_features(text)
        gains = [math.floor(1000 * math.log((t[f] + 1) * (all_s + 10_000) / ((s[f] + 1) * (all_t + 10_000)))) for f in own]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_features_and_exact_weights(monkeypatch):
    texts = ["É 日本語x" + "y" * 100 + " " + "z" * 70 + " a " + "q" * 64 + " b" + "w" * 65, "", None, "a", "A b;a B", prose(500, 3), "x" * 1000 + " x", "a " * 700]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    gains = np.random.default_rng(1).integers(-9000, 9000, 10_000)
    for size in (1 << 20, 100):
        at = 0
        for part, data, offsets in blocks(iter([batch]), size):
            text, bucket, n_words = resampling.features(data, offsets)
            sums = resampling.gain_sums(text, bucket, part.num_rows, resampling.gain_planes(gains))
            for k in range(part.num_rows):
                words, own = brute_features(texts[at + k])
                assert sorted(bucket[text == k].tolist()) == sorted(own) and n_words[k] == len(words)
                assert sums[k] == sum(int(gains[f]) for f in own)
            at += part.num_rows
        assert at == len(texts)


def test_drawn_documents_are_those_of_plain_loops(spark, messy, nothing):
    rng = random.Random(8)
    rows = [(k, prose(rng.choice([3, 19, 20, 21, 60]), k % 70)) for k in range(300)]
    rows += [(5, rows[5][1])] * 40 + [(None, prose(30, 500))] * 3 + [(r["doc_id"], r["text"]) for r in messy.collect()]
    target = [prose(40, 3), None, "", "One two"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (25, 0, 100):
        found = resampling.resampled(frame, wanted, percent).select("doc_id", "n_features", "weight", "score", "rank").collect()
        got, want = sorted(map(tuple, found), key=str), brute_draw(rows, target, percent)
        # Rows of one number and one score may change places; ranks are those of the same rows.
        assert got == want
    assert resampling.resampled(messy, nothing).count() == messy.count()
    assert resampling.resampled(nothing, wanted).count() == 0
