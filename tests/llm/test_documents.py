import hashlib
import heapq
import random
import re
import textwrap
import zlib
from urllib.parse import urldefrag, urljoin

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from censa.llm import exact_dedup, fingerprints, license_scan, near_dedup, sharding, toxicity, url_filter
from censa.llm.components import components

from llm_texts import messy, nothing, package, prose  # noqa: F401


def test_shards_are_even_and_keep_groups(spark, messy, nothing):
    found = sharding.sharded(messy, 3).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in found) == sorted((len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in messy.collect())
    by_text = {}
    for r in found:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    for shard in {r["shard"] for r in found}:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))
    assert sharding.sharded(nothing, 3).count() == 0


def test_schedule_is_that_of_a_heap():
    rng = random.Random(2)
    for shards in (1, 3, 24):
        classes = [(k, n, n * k) for k in sorted({rng.randint(1, 5000) for _ in range(60)}) for n in [rng.choice([1, 2, 500])]]
        runs = sharding.schedule(classes, shards)
        loads = dict.fromkeys(range(shards), 0)
        for kind, n, _ in classes:
            own = sorted((first, shard) for k, first, shard in runs if k == kind)
            for (first, shard), stop in zip(own, [f for f, _ in own[1:]] + [n], strict=True):
                loads[shard] += (stop - first) * kind
        heap = [0] * shards
        for kind, n, _ in reversed(classes):
            for _ in range(n):
                heapq.heapreplace(heap, heap[0] + kind)
        assert sorted(loads.values()) == sorted(heap)


def test_exact_groups(spark, messy, nothing):
    found = exact_dedup.groups(messy).collect()
    text = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in messy.collect():
        groups.setdefault(hashlib.sha256(text(r["text"]).encode()).hexdigest(), []).append(r["doc_id"])
    assert len(found) == messy.count()
    for sha, ids in groups.items():
        own = [r for r in found if r["text_sha256"] == sha]
        assert sorted(str(r["doc_id"]) for r in own) == sorted(map(str, ids))
        least = min((i for i in ids if i is not None), default=None)
        assert all(r["keep_id"] == least and r["group_size"] == len(ids) for r in own)
        assert [r["doc_id"] for r in own if r["kept"]] == [least]
    left = exact_dedup.deduplicated(messy)
    assert left.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r["doc_id"]) for r in found if r["kept"])
    assert exact_dedup.groups(nothing).count() == exact_dedup.deduplicated(nothing).count() == 0


def test_a_filter_that_is_not_broadcast(spark, monkeypatch):
    many = spark.range(30_000).selectExpr("id AS doc_id", "cast(if(id < 1000, 7, id % 29000) AS string) AS text", "id % 5 AS sha")
    want = {r["text_sha256"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.groups(many).collect()}
    kept_ids = sorted(r["doc_id"] for r in exact_dedup.deduplicated(many).collect())
    monkeypatch.setattr(exact_dedup, "MAX_BLOCKS", 1)
    assert {r["text_sha256"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.groups(many).collect()} == want
    left = exact_dedup.deduplicated(many)
    assert left.columns == many.columns and sorted(r["doc_id"] for r in left.collect()) == kept_ids
    assert len(want) == len(kept_ids) == 29_000
    singles = spark.range(100_000).selectExpr("cast(id AS string) AS sha")
    asked = exact_dedup.maybe_repeated(singles, 100_000)
    assert asked.filter("maybe").count() < 5_000
    for frame in (asked, left, exact_dedup.groups(many)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastExchange" not in asked._jdf.queryExecution().executedPlan().toString()


def test_of_copies_with_one_id_the_same_row_stays(spark):
    data = [(1, "a  b", "x"), (1, "a b", "y"), (1, "a b", "z"), (None, "a b", "w"), (2, "c", "x")]
    found = {tuple(exact_dedup.deduplicated(spark.createDataFrame(data, "doc_id long, text string, more string").repartition(n)).orderBy("doc_id").collect()) for n in (1, 3, 7)}
    assert len(found) == 1 and [r["doc_id"] for r in found.pop()] == [1, 2]


def test_single_texts_pass_without_a_shuffle(spark):
    many = spark.range(20_000).selectExpr("cast(id AS string) AS sha")
    assert exact_dedup.maybe_repeated(many, 20_000).filter("maybe").count() < 800


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(80)] + [(7, 7), (None, 3)]
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            above[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in components(frame).collect()} == {x: root(x) for x in above}
    assert components(frame.limit(0)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("bad.org", "/", "block")], "host string, path string, action string")
    link = '<LINK href="{}" rel="canonical">'
    pages = [
        (1, "http://A.Example.NET/en/x?q#f", ""), (2, "http://example.net/de/", None), (3, "http://myexample.com/", link.format("http://x.bad.org/p")),
        (4, "http://other.com/a/b", '<meta http-equiv="refresh" content="0; URL=../c">'), (5, None, "x"), (6, "no scheme", ""), (7, "http://net", ""),
        (8, "http://chain.com/1", link.format("/2")), (9, "http://chain.com/2#top", link.format("//bad.org/")), (10, "http://mixed.com/", link.format("http://example.net/en/")),
        (11, "http://mixed.com/#a", link.format("http://bad.org/z")), (12, "http://bad.org/z", ""), (12, "http://bad.org/z", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judged(frame, rules).collect()}
    assert found[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[2] == ("example.net", "/de/", "net/", "block")
    assert found[3] == ("myexample.com", "/", None, "block")
    assert found[4][3] == found[6][3] == found[5][3] == "allow" and found[5][:2] == found[6][:2] == ("", "")
    assert found[7] == ("net", "", None, "allow")
    assert found[8][3] == found[9][3] == "block"
    assert found[10][2:] == (None, "allow") and found[11][2:] == (None, "allow")
    assert url_filter.judged(frame, rules).count() == len(pages) and url_filter.judged(frame.limit(0), rules).count() == 0
    redirects = spark.createDataFrame([("no scheme", "http://x.bad.org/p")], "a string, b string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judged(frame, rules, redirects).collect()}[6] == "block"


def test_url_aliases_of_other_case_and_with_character_references(spark):
    rules = spark.createDataFrame([("bad.org", "/", "block")], "host string, path string, action string")
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "https://example.com/x?a=1&b=2", ""), (2, "https://www.bad.org/q", link.format("HTTPS://Example.COM/x?a=1&amp;b=2")),
        (3, "https://example.com/X?a=1&b=2", ""), (4, "http://Other.com/y?a&copy=1#z", ""), (5, "http://bad.org/r", link.format("http://other.com/y?a&copy=1")),
        (6, "http://third.com/?a&b", ""), (7, "http://bad.org/s", '<meta http-equiv="refresh" content="0; url=http://third.com/?a&#x26;b">'),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judged(frame, rules).collect()}
    assert {k for k, v in found.items() if v == "allow"} == {3}


def test_links_resolve_as_in_a_brute_force(spark):
    rng = random.Random(5)
    bases = ["http://a.org/b/c/d;p?q=1#f", "https://A.org", "http://a.org/", "http://a.org/x/../y/./z", "http://u:p@a.org:80/b/?k=/..", "http://a.org?q", "no scheme"]
    parts = ["..", ".", "g", "h.i", "", "/", "?y=1", "#s", "//n.org", "http://o.org/../k", "mailto:x@y", "go?u=https://q.org/r", "../q", "?a=1", "a%20b", "\u00e9"]
    links = parts + ["/".join(rng.choice([p for p in parts if ":" not in p and "//" not in p and p[:1] not in "?#"]) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    # The library joins paths without their doubled slashes, so links with one are left out.
    pairs = [(base, link) for base in bases[:-1] for link in links if "//" not in link.replace("://", "").lstrip("/") and not link.startswith("///")]
    frame = spark.createDataFrame(pairs, "base string, link string")
    found = frame.select("base", "link", url_filter.resolved(F.col("link"), F.col("base")).alias("got")).collect()
    for r in found:
        want = urldefrag(urljoin(r["base"], r["link"]))[0]
        same = lambda u: re.sub(r"^(\w+://[^/?#]*)(?=[?]|$)", r"\1/", u)  # noqa: E731  an empty path is the root
        assert same(r["got"]) == same(want), (r["base"], r["link"])


def test_links_in_pages(spark):
    rules = spark.createDataFrame([("bad.org", "/", "block")], "host string, path string, action string")
    to = lambda href, rel='"canonical"': f"<link data-rel=x rel={rel} href='{href}'>"
    pages = [
        (1, "http://a.com/1", to("http://bad.org/", '"alternate  Canonical"')), (2, "http://a.com/2", f"<!-- {to('http://bad.org/')} -->"),
        (3, "http://a.com/3", to("http://bad.org/", "canonical")), (4, "http://a.com/4", to("http://bad.org/", '"canonicals"')),
        (5, "http://a.com/5", '<link data-rel="canonical" href="http://bad.org/">'), (6, "http://a.com/6", "<!-- open " + to("http://bad.org/")),
        (7, "http://a.com/d/7", to("/go?u=https://q.org/r")), (8, "http://bad.org/8", to("http://a.com/go?u=https://q.org/r")),
        (9, "http://a.com/d/e/9?x", to("../q")), (10, "http://bad.org/10", to("http://a.com/d/q")),
        (11, "http://a.com/11", to("?a=1")), (12, "http://bad.org/12", to("http://a.com/11?a=1")),
        (13, "http://a.com/13", "x" * 300_000 + to("http://bad.org/") + "y" * 300_000), (14, "http://a.com/14", '<meta content="0.5, URL=http://bad.org/" http-equiv=refresh>'),
        (15, "http://a.com/15", '<meta http-equiv="refresh" content="0.5, URL=http://bad.org/">'),
    ]
    clash = ["host", "path", "rule", "action", "component", "node", "spread", "link", "a", "b"]
    frame = spark.createDataFrame([(*p, *["z"] * len(clash)) for p in pages], "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in clash))
    found = {r["page_id"]: r["verdict"] for r in url_filter.judged(frame, rules).collect()}
    assert {k for k, v in found.items() if v == "allow"} == {2, 4, 5, 6}


def labelled(text):
    words, seen, out = text.lower().split(), {}, []
    for k in range(max(1, len(words) - 4)):
        run = tuple(words[k : k + 5])
        seen[run] = seen.get(run, 0) + 1
        out.append((run, seen[run]))
    return out


def brute_similarity(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1] / (len(a) + len(b) - row[-1])


def near_texts():
    rng = random.Random(9)
    texts = [prose(rng.choice([4, 8, 40, 150]), k) for k in range(25)]
    for k in range(25):
        words = texts[k].split()
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["new"], [words[at], "more"]])
        texts.append(" ".join(words).upper())
    return [*texts, "", None, " \n", "one", texts[0], " ".join(["again and again"] * 60), " ".join(["again and again"] * 58)]


def test_alignment_is_the_longest_common_subsequence():
    texts = [t or "" for t in near_texts()]
    words, bounds = near_dedup.word_table().rows(texts)
    hashes, stops = near_dedup.kmers(words, bounds)
    hashes = near_dedup.labelled(hashes, stops)
    own = [hashes[stops[k] : stops[k + 1]] for k in range(len(texts))]
    for i in range(len(texts)):
        for j in range(i):
            want, got = brute_similarity(labelled(texts[i]), labelled(texts[j])), near_dedup.similarity(own[i], own[j])
            assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


@pytest.mark.parametrize("block", [256, 3])
def test_near_classes_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts()
    runs = [labelled(t or "") for t in texts]
    above = list(range(len(texts)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if brute_similarity(runs[i], runs[j]) >= 0.8:
                low, high = sorted((root(i), root(j)))
                above[high] = low
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in near_dedup.classes(frame).collect()}
    assert {k: r["class_id"] for k, r in found.items()} == {k: root(k) for k in range(len(texts))}
    assert all(r["kept"] == (k == root(k)) for k, r in found.items())
    assert sorted(r["doc_id"] for r in near_dedup.deduplicated(frame).collect()) == sorted({root(k) for k in range(len(texts))})


def test_near_dedup_of_messy_rows(spark, messy, nothing):
    left = near_dedup.deduplicated(messy)
    assert left.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [1, 4, 5, 7, 9, 10, 11, 12, 13]))
    assert near_dedup.classes(messy).count() == messy.count()
    assert near_dedup.deduplicated(nothing).count() == near_dedup.classes(nothing).count() == 0


def test_large_bucket_keeps_links_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = prose(400, 77).split()
    texts = []
    for k in range(40):  # a chain: neighbours are alike, the ends are not
        words = list(base)
        for c in range(k + 1):
            words[c * 10] = f"w{c}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["class_id"] for r in near_dedup.classes(frame).collect()} == {0}


def shingled(text):
    words = re.split(r"\s+", text.strip(" "))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def test_fingerprints_estimate_common_shingles(spark, messy, nothing):
    texts = [prose(300, k) for k in range(40)] + [prose(12, 50), "", "", "a b"]
    frame = spark.createDataFrame([(3 * k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in fingerprints.compared(frame).collect()}
    errors = []
    for k, text in enumerate(texts):
        after = texts[k - 1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = found[3 * k]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 256
        for got, a, b in ((r["near_edited"], text, edited), (r["near_next"], text, after)):
            a, b = shingled(a), shingled(b)
            errors.append(abs(got - len(a & b) / len(a | b)))
            assert 0 <= got <= 1
    assert np.mean(errors) < 0.03 and max(errors) < 0.25
    assert found[3 * 41]["fingerprint"] == found[3 * 42]["fingerprint"] and found[3 * 42]["near_next"] == 1
    own = fingerprints.compared(messy)
    assert own.count() == messy.count() and fingerprints.compared(nothing).count() == 0
    assert "Python" not in own._jdf.queryExecution().executedPlan().toString()


def test_next_rows_across_many_borders(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BORDER_ROWS", 3)
    rng = random.Random(1)
    ids = rng.sample(range(10**6), 700)
    frame = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(frame, ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert found == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1], strict=True)}
    one = fingerprints.with_next(frame.filter(frame.doc_id == ids[0]), ["text"]).collect()
    assert [r["next_text"] for r in one] == [f"t{ids[0]}"]


def test_licences(spark, messy, nothing):
    texts = {
        1: "Some text. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License!",
        2: license_scan.SENTENCES["mit-grant"] + " " + license_scan.SENTENCES["mit-notice"] + "\nALL RIGHTS RESERVED",
        3: "the mit license is short. all rights",
        4: None,
        5: license_scan.SENTENCES["apache-copy"] + "\n" + license_scan.SENTENCES["bsd-redistribution"],
        6: " ".join(license_scan.SENTENCES[k] for k in ("apache-2-header", "apache-compliance", "apache-copy", "apache-as-is")),
    }
    scanner = license_scan.Scanner(license_scan.SENTENCES, license_scan.RULES)
    for name, text in license_scan.SENTENCES.items():
        assert scanner.identifiers(f"Before it. {text}\nAfter it") == [name]
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scanned(frame).collect()}
    assert found[1]["licences"] == ["Apache-2.0", "MIT"]
    assert found[2]["licences"] == ["MIT", "all-rights-reserved"]
    assert found[3]["licences"] == found[4]["licences"] == []
    assert found[5]["licences"] == ["BSD-2-Clause"] and found[5]["unmatched"] == ["apache-copy"]
    assert found[6]["licences"] == ["Apache-2.0"] and found[6]["unmatched"] == []
    assert license_scan.scanned(messy).count() == messy.count() and license_scan.scanned(nothing).count() == 0


def test_wrapped_and_commented_licences():
    known = license_scan.SENTENCES
    notices = {
        "MIT": ["Copyright (c) 2020 A. Person", ("mit-grant",), ("mit-notice",), 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.'],
        "BSD-3-Clause": [("bsd-redistribution",), "1. Redistributions of source code must retain the notice.", "3. " + known["bsd-names"]],
        "GPL-3.0-or-later": [("gpl-free",), known["gpl-hope"] + " without even the implied warranty of FITNESS.", "You should have received a copy."],
        "Apache-2.0": [("apache-2-header", "apache-compliance"), ("apache-copy",), "http://www.apache.org/licenses/LICENSE-2.0", ("apache-as-is",)],
    }
    scanner = license_scan.Scanner(known, license_scan.RULES)
    for licence, paragraphs in notices.items():
        paragraphs = [p if isinstance(p, str) else " ".join(known[k] for k in p) for p in paragraphs]
        stream = " ".join(license_scan.normal(p) for p in paragraphs)
        places = {n: stream.find(license_scan.normal(t)) for n, t in known.items()}
        want = sorted((n for n, k in places.items() if k >= 0 and (n, licence) != ("apache-2", "Apache-2.0")), key=places.get)
        assert len(want) >= 2
        for width in (24, 60, 72, 80):
            for mark in ("", "# ", "// ", " * ", "dnl ", "REM ", "> "):
                for gap, end in (("", "\n"), (mark.rstrip(), "\n"), (mark, "\r\n")):
                    wrapped = f"{end}{gap}{end}".join(end.join(mark + x for x in textwrap.wrap(p, width, break_long_words=False)) for p in paragraphs)
                    got = scanner.identifiers("Some words before it\n" + wrapped + "\nint main()")
                    assert got == want, (licence, width, mark)
                    assert scanner.licences(got) == ([licence], [])
    assert scanner.identifiers("All rights. Reserved seats only\nThis work is\nnot in the public domain.") == []


def test_licences_in_quotes_marks_tags_and_by_name():
    scanner = license_scan.Scanner(license_scan.SENTENCES, license_scan.RULES)
    known = license_scan.SENTENCES
    forms = {
        "(Released under the MIT License.) Enjoy.": ["MIT"], "**All rights reserved.** Next": ["all-rights-reserved"],
        "<p>Released under the MIT License.</p>": ["MIT"], '"All rights reserved." he said': ["all-rights-reserved"],
        "SPDX-License-Identifier: Apache-2.0": ["Apache-2.0"], "// SPDX-License-Identifier: (MIT OR GPL-2.0+)\nint x;": ["MIT OR GPL-2.0+"],
        "x <b>y</b> <i>All rights reserved.</i><br/>z": ["all-rights-reserved"], "if a < b and c > d: pass": [],
        "SPDX-License-Identifier: MIT\nAll rights reserved.\n# SPDX-License-Identifier: BSD-3-Clause": ["MIT", "all-rights-reserved", "BSD-3-Clause"],
    }
    for text, want in forms.items():
        found, rest = scanner.licences(scanner.identifiers(text))
        assert (found, rest) == (want, []), text
    whole = "\n\n".join(textwrap.fill(known[k], 75) for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
    assert scanner.licences(scanner.identifiers("MIT License\n\nCopyright (c) 2020 A. Person\n\n" + whole)) == (["MIT"], [])
    for licence, wanted in license_scan.RULES:
        text = "\n".join(f" * {x}" for k in wanted for x in textwrap.wrap(known[k], 70))
        assert scanner.licences(scanner.identifiers(text))[0][0] == licence, (licence, wanted)


@pytest.fixture(scope="module")
def told(spark):
    rng = random.Random(6)
    data, labels = [], []
    for k in range(900):
        words = prose(rng.randint(5, 200), 1000 + k).split()
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilewort", "nastyling", "grimthing"]) + rng.choice(["", ",", "!"]))
        data.append((k, " ".join(words), rng.choice(["en", "xx", None]), "s"))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_rows_held_out(spark, told):
    documents, labels = told
    model = toxicity.trained(documents, labels)
    found = toxicity.scored(documents, model).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    apart = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == r["toxic"] for r in apart) / len(apart)
    assert right > 0.95 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    left = toxicity.accepted(documents, model)
    assert left.columns == documents.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in found if not r["rejected"]}
    # Neither labels, language, source nor number are part of a score.
    other = documents.selectExpr("doc_id + 3000 AS doc_id", "text", "'zz' AS lang", "'q' AS source")
    again = {r["doc_id"] - 3000: r["score"] for r in toxicity.scored(other, model).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"]) for r in found)


def test_thresholds_look_at_all_labelled_rows(spark, told, monkeypatch):
    documents, labels = told
    # A language with few more toxic rows than it needs, over all rows that may be learned from.
    few = [r["doc_id"] for r in labels.filter("toxic = 1").filter(~toxicity.held_out(labels["doc_id"])).orderBy("doc_id").limit(toxicity.LEAST + 4).collect()]
    named = documents.withColumn("lang", F.when(F.col("doc_id").isin(few), "es").when(F.col("doc_id") % 2 == 0, "en"))
    seen = []
    thresholds = toxicity._thresholds
    monkeypatch.setattr(toxicity, "_thresholds", lambda score, toxic, counts, langs: seen.append((toxic, counts, langs)) or thresholds(score, toxic, counts, langs))
    rare = {r["doc_id"] for r in labels.filter("toxic = 1").collect()} - set(few)
    want = [tuple(r) for r in named.join(labels, "doc_id").filter(~toxicity.held_out(F.col("doc_id"))).select("lang", "toxic").collect()]
    # All rows in the sample, and most of them outside, by number or by length.
    for most, chars in ((toxicity.MOST, toxicity.CHARS), ({1: 40, 0: 150}, toxicity.CHARS), (toxicity.MOST, {1: 30_000, 0: 60_000})):
        monkeypatch.setattr(toxicity, "MOST", most)
        monkeypatch.setattr(toxicity, "CHARS", chars)
        model = toxicity.trained(named.unionByName(named.filter(F.col("doc_id").isin(list(rare)[:5]))) if most[1] == 40 else named, labels)
        assert set(model["thresholds"]) == {"en", "es"}
        toxic, counts, langs = seen.pop()
        found = [(lang, int(t)) for lang, t, n in zip(langs, toxic, counts, strict=True) for _ in range(int(n))]
        assert sorted(map(str, found)) == sorted(map(str, want))
    assert not seen


def test_the_fit_is_bounded_in_characters():
    rows_ = [{"doc_id": k, "toxic": k % 2, "n": None if k == 4 else 10 ** (k % 9)} for k in range(400)]
    for chars in ({1: 1000, 0: 500}, {1: 10**8, 0: 10**9}):
        toxicity_chars, toxicity.CHARS = toxicity.CHARS, chars
        try:
            taken = toxicity._within(rows_)
        finally:
            toxicity.CHARS = toxicity_chars
        for kind, most in chars.items():
            own = [r for r in rows_ if r["toxic"] == kind and r["doc_id"] in taken]
            assert own and (sum(r["n"] or 0 for r in own) <= most or len(own) == 1)


def test_a_repeated_document_is_learned_from_once(spark, told, monkeypatch):
    documents, labels = told
    hot = labels.filter(~toxicity.held_out(labels["doc_id"])).first()["doc_id"]
    copies = documents.filter(F.col("doc_id") == hot).crossJoin(spark.range(300)).selectExpr("doc_id", "concat(text, ' ', id) AS text", "lang", "source")
    counts = []
    monkeypatch.setattr(toxicity, "_thresholds", lambda score, toxic, count, langs: counts.append(count.sum()) or {})
    models = [toxicity.trained(frame, labels) for frame in (documents.unionByName(copies), copies.repartition(5).unionByName(documents))]
    assert counts == [labels.filter(~toxicity.held_out(labels["doc_id"])).count()] * 2
    assert [m["slope"] for m in models] == [models[0]["slope"]] * 2


def test_toxicity_without_labels_and_of_messy_rows(spark, told, messy, nothing):
    documents, labels = told
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.selectExpr("doc_id", "cast(null AS int) AS toxic")):
        model = toxicity.trained(documents, few)
        assert toxicity.scored(documents, model).filter("score > 0.6 OR score < 0").count() == 0
    model = toxicity.trained(documents, labels)
    assert toxicity.scored(messy, model).count() == messy.count()
    assert toxicity.accepted(messy, model).columns == messy.columns
    assert toxicity.scored(nothing, model).count() == toxicity.accepted(nothing, model).count() == 0


def test_pipeline_stages_follow_their_operators(spark, tmp_path, told):
    documents, labels = told
    more = documents.unionByName(documents.filter("doc_id < 40").selectExpr("doc_id + 5000 AS doc_id", "concat(text, ' ') AS text", "lang", "source"))
    more.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}
            break
        assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert rows(corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "ids_crc32")) == rows(out.select("doc_id", "piece", "ids_crc32"))
