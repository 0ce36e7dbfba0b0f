"""The operators against brute force and on odd input: nulls, empty and long texts, repeats, empty tables, clashing names."""

import collections
import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import bpe, common, components, fingerprints, html_text, jaccard, language, licenses, mixing, passages, quality, sharding, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t", None, None), (4, "one two", "de", "b"), (5, "one two", "de", "b"), (6, "word " * 30000, "en", "a"), (7, "日本語 ééé ß 🙂́", "fr", None),
    (8, "x" * 50000, "en", "a"), (8, "x" * 50000, "en", "a"), (None, "no key at all here then", "en", "c"), (9, "\x00\x1c a b", "es", "c"),
]
# columns that clash with names the operators use
SCHEMA = "doc_id long, text string, lang string, source string, id long, size string, `words.x` string, shard string, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 5, "s", "w", "t", "k") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("doc_id = -1")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return common.documents(spark, sf)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# --- sharding ---------------------------------------------------------------------------------------------------------


def test_sharding(docs, texts):
    rows = sharding.assign(docs, "doc_id", "text", [1.0] * 40).collect()
    assert len(rows) == len(texts)
    slots = collections.defaultdict(list)
    for r in rows:
        t = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 16, zlib.crc32(t))
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, "doc_id", "text", [1.0] * 41).collect()}
    assert grown == {r["doc_id"]: r["grown_shard"] for r in rows}


def test_sharding_of_equal_rows(spark, monkeypatch):
    """Most rows are equal: slots stay gapless and in the order of hashes, whether equal rows are dealt or not."""
    rows = [(7, "same")] * 300 + [(8, "also")] * 90 + [(k, f"t{k}") for k in range(200)] + [(None, None)] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    shown = lambda: sorted((r["shard"], r["slot"], repr(r["doc_id"]), r["text_crc32"]) for r in sharding.assign(df, "doc_id", "text", [1.0] * 3).collect())
    want = shown()
    monkeypatch.setattr(sharding, "ROWS_PER_RUN", 20)
    assert shown() == want
    slots = collections.defaultdict(list)
    for shard, slot, *_ in want:
        slots[shard].append(slot)
    assert all(s == list(range(len(s))) for s in slots.values())


def test_sharding_weights(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = collections.Counter(r["shard"] for r in sharding.assign(df, "doc_id", "text", [1.0, 3.0]).collect())
    assert 0.70 < n[1] / 4000 < 0.80
    with pytest.raises(ValueError):
        sharding.assign(df, "doc_id", "text", [1.0, 0.0])


def test_sharding_odd(odd, none):
    rows = sharding.assign(odd, "doc_id", "text", [1.0] * 3).collect()
    assert len(rows) == len(ODD)
    assert sorted(r["size"] for r in rows if r["doc_id"] in (1, 2)) == [16, 16]
    assert sharding.assign(none, "doc_id", "text", [1.0] * 3).count() == 0


# --- quality ----------------------------------------------------------------------------------------------------------


def repeat_words(words):
    n = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({j for i in range(len(words) - 4) if n[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)})


def test_quality_measures(docs, odd, texts):
    for frame, by in ((docs, texts), (odd.filter("doc_id is not null"), {r[0]: r[1] for r in ODD})):
        judged, q = quality.judge(frame)
        for r in judged.select("doc_id", q).collect():
            t = by[r["doc_id"]] or ""
            w = WORD.findall(t)
            lines = [x for x in t.split("\n") if WORD.search(x)]
            m = r[q]
            assert m["n_words"] == len(w) and m["word_chars"] == sum(map(len, w))
            assert m["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
            assert m["n_dup_lines"] == len(lines) - len(set(lines))
            assert m["n_repeat_words"] == repeat_words(w)
            assert m["base_failed"] == (len(w) < 10 or 100 * repeat_words(w) > 20 * len(w))
            assert not (m["kept"] and m["base_failed"])


def test_quality_keeps_clean(spark, docs, sf):
    kept = {r["doc_id"] for r in quality.keep_good(docs).select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    base, q = quality.judge(docs)
    failed = {r["doc_id"] for r in base.filter(F.col(q)["base_failed"]).select("doc_id").collect()}
    assert all(d in kept or d in failed for d, good in labels.items() if good == 1)
    assert not [d for d, good in labels.items() if good == 0 and d in kept]


def test_quality_odd(odd, none):
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(none).count() == 0


# --- BPE --------------------------------------------------------------------------------------------------------------


def test_bpe_tree_equals_library():
    tokenizer = bpe.load(bpe.vocabulary())
    rng = random.Random(5)
    bits = ["a", "e", "th", "'ll", "'s", "'", ".", "!!", "9", "ß", "é", "é", "日本", "<|endoftext|>", "<", "|", "Ω", "ing", "tion", "☃", "́", " ", " ", "\n", "\u2003"]
    for leaf in (20, 50, 100):
        codec = bpe.Codec(bpe.vocabulary(), leaf)
        made = ["".join(rng.choice(bits if k % 3 else "abcdeht ") for _ in range(rng.randint(0, 700))) for k in range(50)]
        ids, decoded = codec.batch([*(s.encode() for s in made), None])
        for s, i, d in zip([*made, ""], ids.to_pylist(), decoded.to_pylist(), strict=True):
            want = tokenizer.encode(s, add_special_tokens=False).ids
            assert i == want and d == tokenizer.decode(want, skip_special_tokens=False)
            assert bpe.encode_long(codec, s) == want


def test_bpe_joins_matter(monkeypatch):
    """Without the joins the halves of a text have other tokens than the text."""
    tokenizer, text = bpe.load(bpe.vocabulary()), "internationalisation of neighbourhoods " * 40
    want = tokenizer.encode(text, add_special_tokens=False).ids
    codec = bpe.Codec(bpe.vocabulary(), 64)
    assert bpe.encode_long(codec, text) == want
    monkeypatch.setattr(bpe.Codec, "join", lambda self, data, pairs: [bpe.Side(a.start, b.end, [*a.blocks, *b.blocks]) for a, b in pairs])
    assert bpe.encode_long(codec, text) != want


def test_bpe_keeps_white_space():
    name = "byte_bpe_50k.json"
    tokenizer, codec = bpe.load(bpe.vocabulary(name)), bpe.Codec(bpe.vocabulary(name), 40)
    for text in ("a  b\n\nc " * 50, "été " * 60, "x" * 500, ""):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        ids, decoded = codec.batch([text.encode()])
        assert ids[0].as_py() == want and decoded[0].as_py() == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_long_texts_in_several_tasks(spark):
    tokenizer = bpe.load(bpe.vocabulary())
    rows = [(1, "internationalisation " * 300), (2, "x" * 5000), (3, "short"), (4, None), (2, "x" * 5000), (None, "Straße, éa " * 400)]
    work, ids, decoded = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), spread=1000)
    got = sorted((repr(r["doc_id"]), r["text"] or "", r[ids], r[decoded]) for r in work.collect())
    want = [(repr(d), t or "", tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in rows]
    assert got == sorted((*w, tokenizer.decode(w[2], skip_special_tokens=False)) for w in want)


def test_bpe_round_trip(spark, docs, odd, none, texts):
    tokenizer = bpe.load(bpe.vocabulary())

    def want(t):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    for r in bpe.digests(docs, ["doc_id"]).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want(texts[r["doc_id"]])
    by = {r[0]: r[1] for r in ODD}
    rows = bpe.digests(odd, ["doc_id", "words.x"]).collect()
    assert len(rows) == len(ODD) and all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want(by[r["doc_id"]]) for r in rows)
    assert bpe.digests(none, ["doc_id"]).count() == 0


# --- fingerprints -----------------------------------------------------------------------------------------------------


def own_canonical(t):
    """Folding written apart from the operator's."""
    once = unicodedata.normalize("NFKC", t)
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", once.casefold())).strip()


def edited_rows(rows):
    """Brute force of compare_edited over (key, text) rows: (key, n_chars, sha256 of the edited text, like edited, like next), sorted."""
    def xxh(t):
        import xxhash

        h = xxhash.xxh64_intdigest(t.encode(), seed=42)
        return h - 2**64 if h >= 2**63 else h

    order = sorted({(-(2**64) if k is None else k, xxh(t or ""), t or "") for k, t in rows})
    after = {order[i][::2]: order[(i + 1) % len(order)][2] for i in range(len(order))}
    out = []
    for k, t in rows:
        t, nxt = t or "", after[-(2**64) if k is None else k, t or ""]
        q = len(t) // 4
        new = t[: len(t) - q] + nxt[:q]
        out.append((repr(k), len(t), hashlib.sha256(new.encode()).hexdigest(), float(own_canonical(t) == own_canonical(new)), float(own_canonical(t) == own_canonical(nxt))))
    return sorted(out)


def test_fingerprints(docs, texts, none):
    rows = fingerprints.compare_edited(docs).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows) == edited_rows(list(texts.items()))
    one = {}
    for r in rows:  # one fingerprint for each canonical text, and the other way around
        assert one.setdefault(r["fingerprint"], own_canonical(texts[r["doc_id"]] or "")) == own_canonical(texts[r["doc_id"]] or "")
        assert (r["fingerprint"] == r["edited_fingerprint"]) == bool(r["near_edited"])
    assert len(set(one.values())) == len(one)
    assert fingerprints.compare_edited(none).count() == 0


def test_fingerprints_of_shared_keys(spark):
    """Most rows have one key, or none; rows repeat; texts are empty, null and long."""
    rng = random.Random(4)
    some = [None, "", "a", "Ab  c", "x" * 3000, *("".join(rng.choice("abcÄé ") for _ in range(rng.randint(1, 40))) for _ in range(60))]
    rows = [(7 if k % 3 else None, t) for k, t in enumerate(some)] + [(7, "again")] * 5 + [(k, "z" * k) for k in range(8)]
    got = fingerprints.compare_edited(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int")).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got) == edited_rows(rows)


def test_places():
    bounds = np.array([3, 5, 5, 5, 9])
    keys, hashes = [None, 3, 4, *[5] * 5, 6, 9, 10], [0, 0, 0, -(2**63), -(2**62), 0, 2**62, 2**63 - 1, 0, 0, 0]
    got = fingerprints.places(keys, hashes, bounds)
    assert got == sorted(got) and got[0] == 0 and len(set(got[3:8])) == 3 and got[-1] == 5


def test_fingerprint_folding(spark, odd):
    df = spark.createDataFrame([(1, "Straße  X"), (2, "STRASSE x "), (3, "ﬁn"), (4, "fin"), (5, "other")], "doc_id long, text string")
    f = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(df).collect()}
    assert f[1] == f[2] and f[3] == f[4] and len(set(f.values())) == 3
    assert fingerprints.compare_edited(odd).count() == len(ODD)


def test_fingerprint_collision(spark):
    df = spark.createDataFrame([("b", "x"), ("b", "X "), ("c", "x"), ("c", "y")], "bucket string, text string")
    assert [r["bucket"] for r in fingerprints.collisions(df, "bucket", "text").collect()] == ["c"]


# --- licences, language, pages ----------------------------------------------------------------------------------------


def test_licenses(spark, docs, texts, none):
    found = {(r["doc_id"], r["paragraph_text"]): r for r in licenses.scan(docs).collect()}
    lines = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "All rights reserved.": "unknown"}
    for d, t in texts.items():
        for k, line in enumerate((t or "").split("\n")):
            if line in lines:
                r = found.pop((d, line))
                assert r["family"] == lines[line] and r["paragraph"] <= k and r["probability"] > 0.5
    assert len(found) <= 2 + len(texts) // 500  # nothing else is a licence
    long = "word " * 50000 + "\nLicensed under GPL-3.0\n" + "word " * 50000
    rows = [(1, None), (2, ""), (3, "Licensed under the Frobnicate Licence."), (4, "plain words"), (5, "prefix licensed under the mit license"), (5, "prefix licensed under the mit license"), (None, "License: MIT"), (6, long)]
    odd = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, family string, `t.k` string")
    got = sorted((repr(r["doc_id"]), r["paragraph"], r["family"]) for r in licenses.scan(odd).collect())
    assert got == sorted([("3", 0, "unknown"), ("5", 0, "mit"), ("5", 0, "mit"), ("None", 0, "mit"), ("6", 1, "gpl-3.0")])
    assert licenses.scan(none).count() == 0


def test_license_paragraphs():
    model = licenses.train()
    header = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    got = model.find(f"words before\n{header}\nwords after it\nReleased under the MIT License.\nLicensed under Apache-2.0")
    assert [(k, t, f) for k, t, f, *_ in got] == [(1, header, "gpl-3.0"), (6, "Released under the MIT License.", "mit"), (7, "Licensed under Apache-2.0", "apache-2.0")]
    for text, family in (("Licensed under GPL-3.0", "gpl-3.0"), ("License: MIT", "mit"), ("Released under GPLv3.", "gpl-3.0"), ("Released under MIT.", "mit"), ("Distributed under Apache 2.0.", "apache-2.0"), ("GPL-3.0-only", "gpl-3.0"), ("Licensed under the Eclipse Public License 2.0", "unknown")):
        ((_, _, got, chance, _),) = model.find(text)
        assert got == family and chance > 0.5
    for text in ("Er kam mit der Bahn", "The Public may visit in general", "a gnu and a house of commons", "", None):
        assert model.find(text) == []


def test_license_held_out():
    """Names, sentences and notices that didn't train."""
    model = licenses.train()
    _, held = licenses.examples(random.Random(7))
    labels = model.label([licenses.tokens(t) for t, _ in held])
    assert sum(got[0] == f for got, (_, f) in zip(labels, held, strict=True)) / len(held) > 0.95


def test_license_scores():
    """Probabilities and similarity against plain sums over dictionaries."""
    model = licenses.train()
    weights = {g: dict(zip(model.families, model.weights[i], strict=True)) for g, i in model.vocabulary.items()}
    for text in ("Licensed under the Apache License, Version 2.0.", "Released under a strange licence by the vendor", "nothing here", "permission is hereby granted, free of charge"):
        words = re.findall(r"[^\W\d_]+|\d+", text.lower())
        known = {g for g in {*words, *map(" ".join, zip(words, words[1:]))} if g in weights}
        z = {f: (model.bias[k] + sum(weights[g][f] for g in known) / max(1, len(known)) ** 0.5) / model.temperature for k, f in enumerate(model.families)}
        total = sum(np.exp(v) for v in z.values())
        assert model.probabilities([words])[0] == pytest.approx([np.exp(z[f]) / total for f in model.families])
        best = max(z, key=z.get)
        ((family, chance, _),) = model.label([words])
        assert family in (best, "unknown") and (family != best or chance == pytest.approx(np.exp(z[best]) / total))


def test_language(docs, odd, none):
    model = language.train(language.sample(docs, "doc_id", "text", "lang"))
    work, pred, score = language.identify(docs, model)
    rows = work.filter(language.remainder(F.col("doc_id")) == 1).select("lang", pred, score).collect()
    assert rows and sum(r["lang"] == r[pred] for r in rows) / len(rows) > 0.95
    assert all(0 <= r[score] <= 1 for r in rows)
    work, pred, score = language.identify(odd, model)
    got = {r["doc_id"]: r[pred] for r in work.collect()}
    assert len(work.columns) == len(odd.columns) + 2 and got[1] == got[2] == got[3] == "und" and got[6] != "und"
    assert language.identify(none, model)[0].count() == 0
    untrained = language.identify(odd, language.train([]))
    assert {r[untrained[1]] for r in untrained[0].collect()} == {"und"}


def brute_language(rows, texts, landmarks, ridge):
    """Kernel ridge over Nystroem features written out with sets: scores of each language for each text."""
    def grams(t):
        kept = re.sub(r"\s+", " ", "".join(c if c.isalpha() else " " for c in (t or "").lower())).strip()
        if not kept:
            return frozenset()
        padded = f" {kept} "
        return frozenset(padded[k : k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1))

    languages = sorted({g for g, _ in rows})
    marks = [grams(t) for lang in languages for t in [t for g, t in rows if g == lang][:landmarks]]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    matrix = lambda xs: np.array([[kernel(x, m) for m in marks] for x in xs])
    values, vectors = np.linalg.eigh(matrix(marks))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = matrix([grams(t) for _, t in rows]) @ root
    y = np.array([[1.0 if g == lang else -1.0 for lang in languages] for g, _ in rows])
    centred = phi - phi.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + ridge * np.eye(phi.shape[1]), centred.T @ (y - y.mean(axis=0)))
    return languages, (matrix([grams(t) for t in texts]) @ root - phi.mean(axis=0)) @ w + y.mean(axis=0)


def test_language_against_kernels():
    rng = random.Random(6)
    parts = {"aa": "the of and tion ing er st".split(), "bb": "der die und ung keit sch en".split(), "cc": "le la que tion eau oi en".split()}
    say = lambda lang, n: " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(lang, say(lang, 20)) for _ in range(25) for lang in parts]
    texts = [say(lang, rng.randint(2, 30)) for lang in parts for _ in range(10)]
    model = language.train(rows, landmarks=8)
    languages, want = brute_language(rows, texts, 8, language.RIDGE)
    names, scores = model.predict(texts)
    assert names == [languages[k] for k in want.argmax(axis=1)]
    assert scores == pytest.approx(np.clip((want.max(axis=1) + 1) / 2, 0, 1).tolist(), abs=2e-3)


def test_language_odd(spark, docs):
    model = language.train(language.sample(docs, "doc_id", "text", "lang"))
    long = "the of and that with for " * 60000
    rows = [(1, "the house of the man and the dog", "x"), (1, "the house of the man and the dog", "x"), (None, "the house of the man and the dog", "y"), (2, long, None), (3, "12 !!", "z"), (4, None, "z")]
    work, pred, score = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang_pred string"), model)
    assert work.columns[:3] == ["doc_id", "text", "lang_pred"] and pred != "lang_pred"
    got = sorted((repr(r["doc_id"]), r["lang_pred"], r[pred]) for r in work.collect())
    assert got == sorted([("1", "x", "en"), ("1", "x", "en"), ("None", "y", "en"), ("2", None, "en"), ("3", "z", "und"), ("4", "z", "und")])


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="ad">Buy this now please</div><article><h1>Head &amp; line</h1><p><b>First   part<br><p>Second &eacute; part<p>x</article>
    <div id="comments"><p>I disagree with all of this at great length, dear author, and so on</p></div><aside>side</aside><footer>&copy; me</footer></body></html>"""
    assert html_text.extract(page) == "Head & line\nFirst part\nSecond é part\nx"
    plain = "<body><div id=menu><a>a</a> <a>b</a></div><div id=main><p>" + "</p><p>".join(["A sentence of some length is here."] * 4) + "</p></div><div class=footer>f</div></body>"
    assert html_text.extract(plain) == "\n".join(["A sentence of some length is here."] * 4)
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<nav>x</nav>") == ""
    assert html_text.extract("just text") == "just text"


def test_html_pages(spark, sf):
    import html

    for r in html_text.query(spark, sf).join(common.pages(spark, sf), ["page_id", "url"]).collect():
        body = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


S = "A sentence of some length stands here, with words in it."
PAGES = {
    "a title outside the text": (f"<body><div id=page><h1>Title</h1><div class=text><p>{S}</p><p>{S}</p></div></div>", f"Title\n{S}\n{S}"),
    "names that only look like others": (f"<article><div class='entry-header'><h1>T</h1></div><p>{S}<p class='side-effects'>{S}<section class='related-work'><p>{S}</section></article>", f"T\n{S}\n{S}\n{S}"),
    "links between": (f"<body><div><p>{S}</p></div><div><a href=a>a</a><a href=b>b</a><a href=c>c</a> link farm</div><div><p>{S}</p></div>", f"{S}\n{S}"),
    "a form around all": (f"<body><form id=aspnet><div><a>m</a><a>n</a></div><div><h2>T</h2><p>{S}</p><p>{S}</p></div></form>", f"T\n{S}\n{S}"),
    "a wrapper that says what it has not": (f"<body><div class='post no-comments has-sidebar'><h1>T</h1><p>{S}</p><p>{S}</p></div><div class=comments><p>{S * 4}</p></div></body>", f"T\n{S}\n{S}"),
    "cells of a table": (f"<table><tr><td><a>x</a><br><a>y</a><br><a>z</a></td><td><p>{S * 3}</p></td></tr><tr><td></td><td><p>{S}</p><p>Short.</p></td></tr></table>", f"{S * 3}\n{S}\nShort."),
    "no names at all": (f"<body><div><a href=1>Home</a><a href=2>News</a><a href=3>Sport</a></div><div><h1>Title</h1><p>{S}<p>{S}<p>Short.<p>{S}</div></body>", f"Title\n{S}\n{S}\nShort.\n{S}"),
    "short blocks without names or links": (f"<body><div>Log in</div><div>Help</div><div>Feed</div><div>Shop</div><div><p>{S * 4}<p>{S * 3}<p>{S * 4}</div><div>Terms</div><div>About</div></body>", f"{S * 4}\n{S * 3}\n{S * 4}"),
    "longer comments than text": (f"<article><h1>T</h1><p>{S}</p><p>{S}</p><div class=comment-list><p>{S * 9}</p><p>{S * 9}</p></div></article>", f"T\n{S}\n{S}"),
    "sections": (f"<body><nav><a>a</a><a>b</a></nav><main><section><h2>One</h2><p>{S * 5}</p></section><section><h2>Two</h2><p>Short.</p></section></main><footer>{S}</footer></body>", f"One\n{S * 5}\nTwo\nShort."),
    "a page's header and an article's": (f"<body><header><h1>Site</h1><p>tagline</p></header><div class=post><header><h1>T</h1></header><p>{S}</p></div></body>", f"T\n{S}"),
}


@pytest.mark.parametrize("name", PAGES)
def test_html_regions(name):
    page, want = PAGES[name]
    assert html_text.extract(page) == want


def test_html_clusters_decide(monkeypatch, spark, sf):
    """Without the threshold no page keeps its text; without ratios the page of short blocks loses its own."""
    found = [r["html"] for r in common.pages(spark, sf).collect()]
    right = [html_text.extract(h) for h in found]
    with monkeypatch.context() as m:
        m.setattr(html_text, "threshold", lambda values: -1.0)
        assert all(html_text.extract(h) != t for h, t in zip(found, right, strict=True))
    page, want = PAGES["short blocks without names or links"]
    with monkeypatch.context() as m:
        m.setattr(html_text, "ratios", lambda lines: [5.0] * len(lines))
        assert html_text.extract(page) != want


def test_html_ratios_and_clusters():
    """Ratios, smoothing and threshold against plain computations."""
    parser = html_text.Lines()
    parser.feed("<div><p>abc <a href=x>de</a> f</p><p>" + "x" * 20 + "</p></div>")
    parser.close()
    assert [(x.text, x.outside, x.links, x.tags) for x in parser.lines] == [("abc de f", 4, 1, 4), ("x" * 20, 20, 0, 2)]  # <p>, <a>, </a>, </p>
    assert html_text.ratios(parser.lines) == pytest.approx([np.log1p(1), np.log1p(10)])
    rng = random.Random(8)
    for n in (1, 2, 5, 40):
        v = [rng.random() * 6 for _ in range(n)]
        w = np.exp(-np.subtract.outer(np.arange(n), np.arange(n)) ** 2 / (2 * html_text.SIGMA**2)) * (abs(np.subtract.outer(np.arange(n), np.arange(n))) <= 3)
        assert html_text.smooth(v) == pytest.approx((w @ v / w.sum(axis=1)).tolist())
        # two means on a line: no value is nearer to the other cluster's mean
        t = html_text.threshold(v)
        low, high = [x for x in v if x <= t], [x for x in v if x > t]
        assert t == html_text.FLOOR or t == pytest.approx((np.mean(low) + np.mean(high)) / 2)


def test_html_tables(spark):
    long = "<article>" + f"<p>{S}</p>" * 20000 + "</article>"
    deep = "<div>" * 3000 + S + "</i>" * 3000 + "<b>" * 3000 + "<p>" * 3000
    rows = [(1, "u", None, "t"), (2, "u", "", "t"), (3, None, f"<p>{S}</p>", None), (3, None, f"<p>{S}</p>", None), (None, "u", long, "t"), (4, "u", "<nav><a>x</a></nav>", "t"), (5, "u", deep, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    work, name = html_text.main_text(df)
    assert work.columns[:4] == df.columns and name not in df.columns
    got = sorted((repr(r["page_id"]), r[name]) for r in work.collect())
    assert got == sorted([("1", ""), ("2", ""), ("3", S), ("3", S), ("None", "\n".join([S] * 20000)), ("4", ""), ("5", S)])
    assert html_text.main_text(df.filter("page_id = -1"))[0].count() == 0


# --- mixing -----------------------------------------------------------------------------------------------------------


def test_mixing(docs):
    rows = {r["doc_id"]: r for r in mixing.query(docs.sparkSession, docs.inputFiles()[0].rsplit("/", 1)[0]).collect()}
    per = collections.defaultdict(lambda: [0, 0.0, 0])
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    for d, r in rows.items():
        assert 0 <= r["taken"] <= 3 * r["size"]
        p = per[sources[d]]
        p[0], p[1], p[2] = r["source_size"], r["target"], p[2] + r["taken"]
    total = sum(p[0] for p in per.values())
    assert abs(sum(p[1] for p in per.values()) - total) < 1e-6 * total
    biggest = max(r["size"] for r in rows.values())
    assert all(abs(p[2] - p[1]) <= biggest for p in per.values())
    again = mixing.query(docs.sparkSession, docs.inputFiles()[0].rsplit("/", 1)[0]).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {d: r["taken"] for d, r in rows.items()}


def test_mixing_tree():
    quotas = np.array([1000, 10, 0, 333])
    split = mixing.split_quotas(quotas, 7)
    assert (split.sum(axis=0) == quotas).all() and np.ptp(split.sum(axis=1)) <= 1
    assert (mixing.split_quotas(quotas, 7) == split).all()


def test_mixing_blocks_and_quotas(docs):
    """Brute force of the deal: draw d of a source is block d of its permuted passes, and lies in the shard of the tree's quotas."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    held = collections.defaultdict(list)
    for r in docs.collect():
        held[r["source"]].append((md5(f"{mixing.SEED}:{r['doc_id']}"), len(WORD.findall(r["text"] or "")), r["doc_id"]))
    names = sorted(held, key=lambda x: (x is None, x or ""))
    goals = mixing.targets([mixing.Source(x, sum(n for _, n, _ in held[x]), len(held[x])) for x in names])
    ranks, blocks, quotas = {}, [], []
    for x, goal in zip(names, goals, strict=True):
        cuts, size = -(-len(held[x]) // mixing.BLOCK_ROWS), sum(n for _, n, _ in held[x])
        block = lambda h: int(h[:8], 16) * cuts // 2**32  # noqa: B023, E731
        words = collections.Counter()
        for h, n, _ in held[x]:
            words[block(h)] += n
        order = sorted(words, key=lambda k: md5(f"{mixing.SEED + 1}:{x}:{k}"))
        ranks |= {d: order.index(block(h)) for h, _, d in held[x]}
        whole = min(3, int(goal // size))
        before = [sum(words[k] for k in order[:j]) for j in range(len(order))]
        blocks.append(len(order))
        quotas.append(whole * len(order) + sum(n < goal - whole * size for n in before))
    upto = np.cumsum(mixing.split_quotas(np.array(quotas), 5), axis=0)
    mixed, name = mixing.mix(docs, shards=5)
    for r in mixed.select("doc_id", "source", name["draws"]).collect():
        k = names.index(r["source"])
        for d in r[name["draws"]]:
            draw = d["copy"] * blocks[k] + ranks[r["doc_id"]]
            assert draw < quotas[k] and d["shard"] == int((upto[:, k] <= draw).sum())


def test_mixing_shuffles(docs):
    mixed, name = mixing.mix(docs)
    order = {(r["doc_id"], r["d"]["shard"]): r["d"]["shuffle"] for r in mixed.select("doc_id", F.explode(name["draws"]).alias("d")).collect()}
    parts = mixing.mixture(docs).select("doc_id", F.spark_partition_id().alias("p")).collect()
    assert len({r["p"] for r in parts}) > 1 and len(parts) == sum(r[0] for r in mixed.select(F.size(name["draws"])).collect()) and order


def test_mixing_targets():
    s = lambda name, size: mixing.Source(name, size, 1)
    assert mixing.targets([s("a", 100), s("b", 100), s("c", 100)]) == pytest.approx([187.5, 75, 37.5])
    got = mixing.targets([s("a", 10), s("b", 1000)])
    assert got == pytest.approx([30, 980])
    assert mixing.targets([]) == [] and mixing.targets([s(None, 0)]) == [0]


def test_mixing_odd(odd, none):
    mixed, name = mixing.mix(odd)
    assert mixed.count() == len(ODD)
    out = mixing.mixture(odd)
    assert out.columns == odd.columns and out.count() > 0
    assert mixing.mixture(none).count() == 0


def test_mixing_shards(docs):
    mixed, name = mixing.mix(docs, shards=4)
    n = collections.Counter(r["s"] for r in mixed.select(F.explode(F.col(name["draws"])["shard"]).alias("s")).collect())
    assert set(n) <= {0, 1, 2, 3} and len(n) == 4


# --- near duplicates --------------------------------------------------------------------------------------------------


def shingle_set(t):
    w = WORD.findall(t or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_links(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    inverted = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            inverted[g].append(i)
    links, parent = collections.Counter(), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in inverted[g] if j > i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in sets}


def near_copies():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts, base = {}, [word() for _ in range(200)]
    for i in range(70):
        copy = base[:]
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(200)] = word()
        texts[i] = " ".join(copy)
    texts |= {100 + i: " ".join(word() for _ in range(rng.randint(0, 60))) for i in range(30)}
    return texts | {200: None, 201: "", 202: "a b", 203: "a b", 204: texts[0]}


@pytest.mark.parametrize("small,chunk,hot", [(32, 512, 100_000), (1, 3, 2), (2, 7, 5)])
def test_jaccard(spark, docs, texts, monkeypatch, small, chunk, hot):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    made = near_copies()
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    for df, by in ((frame, made),) + (((docs, texts),) if small == 32 else ()):
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.classes(df).collect()}
        assert got == brute_links(by)


def test_jaccard_odd(odd, none):
    rows = jaccard.classes(odd).collect()
    assert len(rows) == len(ODD)
    assert jaccard.classes(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8, 9]


def test_one_of_each_tells_rows_apart(spark):
    rng = random.Random(5)
    some = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(120))
    a, b, c, d, e = (some() for _ in range(5))
    near = " ".join([*a.split()[:-1], "other"])
    rows = [(None, a), (None, b), (None, b), (None, c), (4, near), (4, d), (5, d), (5, e), (5, e), (6, None), (6, "")]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, a), (None, b), (None, c), (4, d), (5, e), (6, None), (6, "")]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))


def test_bands():
    bands, rows = jaccard.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


def test_jaccard_is_exact_in_integers():
    x = np.arange(50, dtype=np.uint64)
    at_bound = np.concatenate([x[:40], x[-10:] + np.uint64(1000)])
    assert not jaccard.alike(x.tobytes(), at_bound.tobytes(), 0.8) and jaccard.alike(x.tobytes(), x[:40].tobytes(), 0.8) and not jaccard.alike(x.tobytes(), x[:39].tobytes(), 0.8)
    assert jaccard.enough(8 * 10**12, 9 * 10**12, 9 * 10**12, 0.8) and not jaccard.enough(8 * 10**12 - 1, 9 * 10**12, 9 * 10**12, 0.8)


def test_looked_up(spark, monkeypatch):
    rows = spark.createDataFrame([(k % 7 if k % 2 else 0, k) for k in range(60)], "k long, v long")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("most"))
    want = sorted(map(tuple, rows.join(table.drop("n"), "k").collect()))
    for hot in (1000, 20, 0):
        monkeypatch.setattr(common, "HOT_ROWS", hot)
        got = common.looked_up(rows, table, ["k"], "n", 60)
        assert got.columns == ["k", "v", "most"] and sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("hot", [100_000, 1])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (100, 102), (None, 3), (4, None)]
    got = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes():
    long = ("ab " * 900_000).encode()
    h, starts, ends = shingles.word_hashes(np.frombuffer(long, dtype=np.uint8))
    assert len(h) == 900_000 and len(set(h.tolist())) == 1
    a, b = shingles.many([b"x yy  z", None, b"\n yy z x"])[::2]
    assert a[1] == b[0] and a[0] == b[2] and len(shingles.many([None])[0]) == 0


# --- passages ---------------------------------------------------------------------------------------------------------


def test_compact_windows():
    rng = np.random.default_rng(3)
    for k in range(120):
        n, t = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        x = rng.integers(0, 1000 if k % 2 else 12, n).astype(np.uint64)
        found = list(zip(*passages.compact_windows(x, t), strict=True))
        for i in range(n):
            for j in range(i + t - 1, n):
                least = x[i : j + 1].min()
                assert any(x[c] == least and low <= i <= c <= j <= high for c, low, high in found)


def covered(rows):
    out = collections.defaultdict(set)
    for r in rows:
        out[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    return out


def test_passages(docs, texts):
    first, want = {}, collections.defaultdict(set)
    for i in sorted(texts):
        w = WORD.findall(texts[i] or "")
        windows = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for k, h in enumerate(windows):
            if first.setdefault(h, i) != i:
                want[i].update(range(k, k + 50))
    rows = passages.repeats(docs).collect()
    got = covered(rows)
    assert all(want[i] <= got[i] for i in list(want))
    for r in rows:  # what is reported is alike, words put in or left out included: some stretch of the other is, in order
        a, b = WORD.findall(texts[r["doc_id"]]), WORD.findall(texts[r["of_doc_id"]])
        x = shingles_of(a[r["first_word"] : r["first_word"] + r["n_words"]])
        best = max(lcs(x, y) / (len(x) + len(y) - lcs(x, y)) for extra in range(-17, 18) if (y := shingles_of(b[r["of_first_word"] : r["of_first_word"] + r["n_words"] + extra])))
        assert len(x) >= 46 and best >= 0.8 and r["of_doc_id"] < r["doc_id"]


def shingles_of(words):
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]


def lcs(x, y):
    """Length of the longest common subsequence, by bit vectors."""
    at = collections.defaultdict(int)
    for k, v in enumerate(x):
        at[v] |= 1 << k
    row, full = (1 << len(x)) - 1, (1 << len(x)) - 1
    for v in y:
        hit = row & at[v]
        row = ((row + hit) | (row - hit)) & full
    return len(x) - row.bit_count()


def test_without_repeats(spark, none, odd):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, own = [word() for _ in range(60)], lambda n: [word() for _ in range(n)]
    a, b = own(30), own(40)
    rows = [(1, " ".join([*a, *passage])), (2, " ".join([*b[:10], *passage, *b[10:]])), (3, " ".join(own(80))), (4, " ".join(passage[:40])), (5, None)]
    frame = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in passages.without_repeats(frame).collect()}
    assert got[2]["text"] == " ".join(b) and got[2]["n_chars"] == len(got[2]["text"])
    assert [got[d]["text"] for d in (1, 3, 4, 5)] == [dict(rows)[d] for d in (1, 3, 4, 5)]
    kept = passages.without_repeats(odd)
    assert kept.columns == odd.columns and sorted(map(repr, kept.select("doc_id", "text").collect())) == sorted(map(repr, odd.select("doc_id", "text").collect()))
    assert passages.repeats(odd).count() == 0
    assert passages.repeats(none).count() == 0


def made_words(seed):
    rng = random.Random(seed)
    return lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def test_passages_tell_rows_apart(spark):
    own = made_words(3)
    a, b, passage = own(120), own(120), own(60)
    two = [*b[:50], *passage, *b[50:]]
    rows = [(1, " ".join([*a, *passage])), (2, " ".join([*a, *passage])), (2, " ".join(two)), (2, " ".join(own(90))), (None, " ".join(own(80))), (None, " ".join(own(80)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["text"] for r in passages.without_repeats(frame).collect())
    assert got == sorted([rows[0][1], "", " ".join(b), *(t for _, t in rows[3:])])


def brute_alike(a, b):
    """Whether two lists of words are alike as sets of shingles."""
    x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return len(x & y) >= 0.8 * len(x | y)


def test_passages_with_words_put_in_or_left_out(spark):
    own = made_words(9)
    rows, want = [], {}
    for n in range(24):
        passage = own(60 + 10 * (n % 3))
        other = passage[:]
        at = len(other) // 2
        if n % 4 == 0:
            other.insert(at, "inserted")
        elif n % 4 == 1:
            del other[at]
        elif n % 4 == 2:
            other[at] = "replaced"
        else:
            other[at:at] = ["two", "more"]
        assert brute_alike(passage, other)
        before = own(5 + n)
        rows += [(n, " ".join([*own(40), *passage, *own(30)])), (100 + n, " ".join([*before, *other, *own(20)]))]
        want[100 + n] = (len(before), len(other), n)
    got = {r["doc_id"]: (r["first_word"], r["n_words"], r["of_doc_id"]) for r in passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got.get(i) == w for i, w in want.items()) >= 0.75 * len(want)


def test_alike_stretches():
    rng = np.random.default_rng(4)
    new = lambda n: rng.integers(0, 2**32, n).astype(np.uint32)
    a = new(100)
    for b, want in ((a, [(0, 99, 0, 1.0)]), (np.concatenate([new(7), a[:50], new(5), a[54:]]), [(0, 99, 7, 96 / 105)]), (np.concatenate([a[:50], new(40), a[50:]]), [(0, 49, 0, 1.0), (50, 99, 90, 1.0)]), (new(100), [])):
        assert passages.alike_stretches(a, b, 46, 0.8) == want
    twice = np.concatenate([a, new(30), a[20:80]])
    assert passages.alike_stretches(twice, a, 46, 0.8, (0, 110)) == [(0, 99, 0, 1.0), (130, 189, 20, 1.0)]
    same = np.zeros(3000, dtype=np.uint32)
    assert passages.alike_stretches(same, same, 46, 0.8) == [(0, 2999, 0, 1.0)]


def test_passages_inside_one_of_another_text(spark):
    own = made_words(12)
    inner = own(70)
    outer = [*own(30), *inner, *own(30)]
    near = outer[:]
    near[15] = near[115] = "other"
    rows = [(1, " ".join([*own(40), *inner, *own(40)])), (2, " ".join([*own(60), *outer])), (3, " ".join([*own(20), *near, *own(20)]))]
    got = {(r["doc_id"], r["of_doc_id"], r["first_word"], r["n_words"]) for r in passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, 1, 90, 70), (3, 1, 50, 70), (3, 2, 20, 130)}


def test_passages_whose_shingles_an_earlier_text_holds(spark):
    own = made_words(21)
    rows, want = [], {}
    for n in range(6):
        passage = own(60)
        near = passage[:]
        if n % 2:
            near[30] = "other"
        # all shingles of the passage are in smaller texts, though no 50 words in a row; some groups are small and some large
        for k in range(1 if n < 3 else 30):
            rows.append((100 * n + k, " ".join([*own(30), *passage[:45], *own(50), *passage[15:], *own(30)])))
        rows += [(100 * n + 50, " ".join([*own(40), *passage, *own(40)])), (100 * n + 51, " ".join([*own(20), *near, *own(60)]))]
        want[100 * n + 51] = (20, 60, 100 * n + 50)
    got = {(r["doc_id"], r["of_doc_id"]): (r["first_word"], r["n_words"], r["of_doc_id"]) for r in passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got.get((i, w[2])) for i, w in want.items()} == want


def test_passages_of_common_windows(spark, monkeypatch):
    """With almost all windows common, and few texts to a batch, the same passages are found."""
    own = made_words(31)
    passage, rows, want = own(60), [], {}
    for n in range(40):
        near = passage[:]
        if n % 5 == 1:
            near[30] = "other"
        elif n % 5 == 2:
            near.insert(20, "inserted")
        elif n % 5 == 3:
            near = passage[:55]
        before = own(5 + n % 7)
        rows.append((n, " ".join([*before, *near, *own(30)])))
        want[n] = set(range(len(before), len(before) + len(near)))
    rows += [(100 + n, " ".join(own(120))) for n in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    usual = covered(passages.repeats(frame).collect())
    monkeypatch.setattr(passages, "ROWS", 7)
    monkeypatch.setattr(passages, "common", lambda docs, least, hashes: np.sort(np.array([r["value"] for r in passages.windows(docs, least, hashes, np.zeros(0, dtype=np.uint64)).select("value").distinct().collect()], dtype=np.int64).view(np.uint64)))
    spread = covered(passages.repeats(frame).collect())
    for got in (usual, spread):
        assert set(got) <= set(range(1, 40))
        assert sum(len(got[n] & want[n]) >= 0.9 * len(want[n]) for n in range(1, 40)) >= 38
        exact = [n for n in range(1, 40) if n % 5 in (0, 4) or n % 5 == 3]
        assert all(want[n] <= got[n] for n in exact)


def test_common_windows_are_told(spark, monkeypatch):
    own = made_words(5)
    passage = own(60)
    frame = spark.createDataFrame([(n, 0, " ".join([*own(20), *(passage if n % 2 else own(60)), *own(20)])) for n in range(200)], "id long, part long, text string")
    monkeypatch.setattr(passages, "HOT_ROWS", 0)
    monkeypatch.setattr(passages, "HOT_SHARES", (0.2, 0.2))
    hot = passages.common(frame, 46, 3)
    values = [r["n"] for r in passages.windows(frame, 46, 3, np.zeros(0, dtype=np.uint64)).groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(hot) == sum(n > 40 for n in values) > 0 and (np.diff(hot.astype(float)) > 0).all()


def crowded(own, rng, passages=6, others=30):
    """(rows, words of each late text that only one in the middle of a crowd holds too): the crowd has the passage with so many edits that no stretch is alike."""
    rows, want = [], {}
    for n in range(passages):
        passage = own(100)
        texts = []
        for k in range(2 * others + 2):
            new = passage[:]
            edits = [30 if k == others else 70] if k in (others, 2 * others + 1) else range(rng.randrange(12), 100, 14)
            for at in edits:
                new[at] = own(1)[0]
            texts.append([*own(20), *new, *own(20)])
        rows += [(1000 * n + k, " ".join(t)) for k, t in enumerate(texts)]
        want[1000 * n + 2 * others + 1] = (1000 * n + others, set(range(20, 120)))
    return rows, want


@pytest.mark.parametrize("common_values", [False, True])
def test_passages_of_one_text_in_a_crowd(spark, monkeypatch, common_values):
    """Large groups of windows lose no partner, neither when they are met in one task nor when their value is common."""
    rows, want = crowded(made_words(61), random.Random(62))
    monkeypatch.setattr(passages, "ROWS", 40)
    monkeypatch.setattr(passages, "ASKED", 7, raising=False)
    monkeypatch.setattr(passages, "SHOWN", 11, raising=False)
    if common_values:
        monkeypatch.setattr(passages, "HOT_ROWS", 0)
        monkeypatch.setattr(passages, "HOT_SHARES", (0.0, 0.0))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {(r["doc_id"], r["of_doc_id"]): set(range(r["first_word"], r["first_word"] + r["n_words"])) for r in passages.repeats(frame).collect()}
    assert sum(len(got.get((i, of), set()) & w) >= 0.9 * len(w) for i, (of, w) in want.items()) == len(want)


def test_rows_of_one_word_in_a_crowd(spark):
    """A word many times over doesn't make all texts with it pairs; stretches beyond it, and parted ones of that word alone, are found."""
    own = made_words(63)
    shared = own(80)
    edited = shared[:]
    edited[40] = "other"
    low = lambda w: min(shingles.mixed(passages.shingle_hashes(shingles.many([" ".join([w] * 5).encode()])[0]) ^ seed)[0] for seed in passages._seeds(3))
    word = min(own(3000), key=low)  # the minimum of all windows that hold five of it
    row = {k: [word] * 30 for k in range(40)}
    row[9], row[29] = ([*[word] * 44, own(1)[0], *[word] * 44] for _ in range(2))
    after = {k: own(60) for k in range(40)}
    after[12], after[32] = [*shared, *own(20)], [*edited, *own(20)]
    docs = spark.createDataFrame([(k, 0, " ".join([*own(20 + k % 7), *row[k], *after[k]])) for k in range(40)], "id long, part long, text string").repartition(2)
    pairs, group = passages.candidates(docs, 46, 3)
    assert group.count() > 500 and group.select("id").distinct().count() == 40
    found = passages.verified(docs, pairs, 46, 0.8)
    asked = passages.rest(group, found, 46)
    assert asked.select("id", "of").distinct().count() <= 10  # of 780
    both = found.union(passages.verified(docs, asked, 46, 0.8, between=True)).collect()
    assert {(r["id"], r["of"]) for r in both} == {(29, 9), (32, 12)}
    assert len(covered([{"doc_id": r["id"], **r.asDict()} for r in both])[32]) >= 80
    a = np.arange(60, dtype=np.uint32)
    assert passages.alike_stretches(a, a, 46, 0.8, (0,), exact=False) == []
    b = np.where(a == 30, 99, a).astype(np.uint32)
    assert passages.alike_stretches(a, b, 46, 0.8, (0,), exact=False) == [(0, 59, 0, 59 / 61)]


def test_pairs_left_out_are_held_by_others():
    rng = np.random.default_rng(5)
    least, out = 6, 0
    for _ in range(30):
        texts = [np.concatenate([rng.integers(0, 9, 12), np.tile(rng.integers(0, 3, 2), 9), rng.integers(0, 9, 12)]).astype(np.uint64) for _ in range(4)]
        rows = [(n, *w) for n, x in enumerate(texts) for w in zip(*passages.compact_windows(x, least), strict=True) if x[w[0]] == x.min()]
        ids, c, l, r = (np.array([r[k] for r in rows] * 2) for k in range(4))
        asked = np.arange(len(ids)) < len(rows)
        near = rng.integers(0, 3, (len(rows), 4)).astype(np.uint16)
        near = np.concatenate([near, near])
        one, other = np.flatnonzero(asked), np.flatnonzero(~asked)
        none = np.full(len(ids), -1)
        before = passages.follows(np.zeros(len(ids), dtype=int), asked, ids, none, c, r)
        kinds = []
        for b in (before, none):
            pairs = [p for p in passages.alike_around(one, other, ids, near, c, b)]
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            kinds.append({(ids[i], ids[j], c[i] - c[j], *(x[n] for x in places)) for i, j, n, places in ((i[n], j[n], n, passages.around(c, l, r, i, j, least)) for n in range(len(i)))})
        out += len(kinds[1] - kinds[0])
        for p in kinds[1]:
            assert any(p[:3] == q[:3] and q[3] <= p[3] and q[4] >= p[4] and q[5] <= p[5] and q[6] >= p[6] and q[7] >= p[7] for q in kinds[0])
    assert out > 100


def test_stretches_of_overlapping_passages(spark):
    own = made_words(71)
    a, b = own(60), own(60)
    rows = [(1, " ".join([*own(20), *a])), (2, " ".join([*b, *own(20)])), (3, " ".join([*own(10), *a[:59], *a[59:], *b, *own(30), *a]))]
    rows += [(4, rows[2][1])]
    got = sorted(tuple(r) for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 10, 60, 1, 20, 1.0, 1), (3, 70, 60, 2, 0, 1.0, 1), (3, 160, 60, 1, 20, 1.0, 1), (4, 0, 220, 3, 0, 1.0, 1)]


def test_intervals_are_merged_as_chained(spark):
    rng = np.random.default_rng(8)
    n = 400
    pair = [rng.integers(0, 3, n), np.zeros(n, dtype=np.int64), rng.integers(0, 2, n), np.zeros(n, dtype=np.int64)]
    s, t = rng.integers(0, 900, n), rng.integers(0, 900, n)
    t = np.where(rng.random(n) < 0.5, s + rng.integers(0, 9, n), t)
    e, u = s + rng.integers(46, 90, n), t + rng.integers(46, 90, n)
    schema = "id long, part long, of long, of_part long, diagonal int, s int, e int, t int, u int"
    rows = lambda columns: list(zip(*(c.tolist() for c in columns), strict=True))
    *places, row = passages.merged(pair, s - t, s, e, t, u)
    ones = lambda data: sorted((*r[:8], *sorted(r[8])) for r in passages.chained(spark.createDataFrame(data, schema)).collect())
    assert len(row) < n
    assert ones(rows([*pair, s - t, s, e, t, u])) == ones(rows([*(p[row] for p in pair), *places]))


def edited(words, own, rng, kind):
    """Words with as many edits of a kind as keep the sets of shingles alike at 0.8."""
    last = words
    while True:
        new = last[:]
        at = rng.randrange(2, len(new) - 2)
        if kind == "replaced":
            new[at] = own(1)[0]
        elif kind == "inserted":
            new.insert(at, own(1)[0])
        else:
            del new[at]
        if not brute_alike(words, new):
            return last
        last = new


def test_passages_recall_at_the_bound(spark):
    rng, own = random.Random(41), made_words(43)
    rows, want = [], {}
    for n in range(120):
        passage = own(rng.randint(58, 200))
        other = edited(passage, own, rng, ("replaced", "inserted", "deleted")[n % 3])
        before = own(rng.randint(5, 40))
        rows += [(n, " ".join([*own(40), *passage, *own(30)])), (1000 + n, " ".join([*before, *other, *own(20)]))]
        want[1000 + n] = set(range(len(before), len(before) + len(other)))
    got = covered(passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert set(got) <= set(want)
    for kind in range(3):
        ids = [i for i in want if i % 3 == (1000 + kind) % 3]
        assert sum(len(got[i] & want[i]) >= 0.5 * len(want[i]) for i in ids) >= 0.9 * len(ids)
    assert sum(len(got[i] & want[i]) for i in want) >= 0.9 * sum(map(len, want.values()))
