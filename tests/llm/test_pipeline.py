"""The pipeline against a brute-force version, its stages on odd tables, and the SQL-expressible queries against DuckDB."""

import collections
import gc
import hashlib
import random
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import corpus_pipeline
from granary.llm import bpe, mixing, quality, registry
from test_operators import ODD, SCHEMA, WORD, brute_links
from test_oracle import compare


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf, name):
    compare(spark, sf, registry.queries()[name](spark, sf), registry.oracle_sql()[name])


def made_documents():
    """Prose with copies, near copies, texts too short, and passages that documents share."""
    rng = random.Random(17)
    common = "the of and to in is that for it as was with be by on not he his but at are this have from".split()
    word = lambda: (rng.choice(common) if rng.random() < 0.45 else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 8)))) + ("." if rng.random() < 0.08 else "")
    prose = lambda n: [word() for _ in range(n)]
    texts = [prose(rng.randint(60, 200)) for _ in range(60)]
    for k in range(8):  # exact and near copies
        texts.append(texts[k][:])
        near = texts[k][:]
        near[3] = "changed"
        texts.append(near)
    for n in (52, 80, 130):  # shared passages
        passage = prose(n)
        for _ in range(4):
            texts.append([*prose(rng.randint(70, 150)), *passage, *prose(rng.randint(70, 150))])
    texts += [prose(5), ["same", "again"] * 40]
    rng.shuffle(texts)
    shown = [" ".join(t) + "." for t in texts]
    return [(3 * k + 1, t, "en", f"s{k % 5}" if k % 11 else None, len(t)) for k, t in enumerate(shown)] + [(1000, None, "en", "s1", None), (1001, "", None, "s2", 0)]


def duck(rows, sql):
    con = duckdb.connect()
    con.register("documents", pa.table({n: [r[k] for r in rows] for k, n in enumerate(("doc_id", "text", "lang", "source", "n_chars"))}))
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return [dict(zip(names, r, strict=True)) for r in found.fetchall()]


def brute_run(rows):
    kept = {r["doc_id"] for r in duck(rows, quality.SQL) if r["kept"]}
    rows = [r for r in rows if r[0] in kept]
    classes = brute_links({r[0]: r[1] for r in rows})
    rows = [r for r in rows if classes[r[0]][0] == r[0]]
    seen, cut = {}, []
    for d, t, lang, source, _ in sorted(rows):
        spans = [m.span() for m in WORD.finditer(t)]
        words = [t[a:b] for a, b in spans]
        gone = set()
        for k in range(len(words) - 49):
            if seen.setdefault(tuple(words[k : k + 50]), d) != d:
                gone.update(range(k, k + 50))
        ends = [a for a, _ in spans[1:]] + [len(t)]
        left = t[: spans[0][0]] + "".join(t[spans[k][0] : ends[k]] for k in range(len(words)) if k not in gone)
        cut.append((d, left, lang, source, len(left)))
    copies = {r["doc_id"]: len(r["shards"].split(",")) if r["shards"] else 0 for r in duck(cut, mixing.SQL)}
    tokenizer = bpe.load(bpe.vocabulary())
    out = []
    for d, t, _, source, _ in cut:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        row = (d, source, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        out += [row] * copies[d]
    return out, (len(rows), sum(a[1] != b[1] for a, b in zip(sorted(rows), cut, strict=True)))


def test_run_equals_brute_force(spark, tmp_path):
    rows = made_documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want, (documents, cut) = brute_run(rows)
    assert documents >= 60 and cut >= 8  # copies are gone, shared passages are cut
    got = [(r["doc_id"], r["source"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert collections.Counter(got) == collections.Counter(want)


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append((name, docs.count()))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    counts = [n for _, n in seen]
    assert counts[1] <= counts[0] and counts[2] == counts[1] and counts[4] == counts[3] > 0


def test_encoded_gives_heap_back(spark, sf):
    """What earlier stages grew a JVM's heap by is free before tokenizers are loaded."""
    jvm = spark.sparkContext._jvm
    blocks = [spark.sparkContext._gateway.new_array(jvm.byte, 200 << 20) for _ in range(4)]
    grown = jvm.java.lang.Runtime.getRuntime().totalMemory()
    blocks.clear()
    gc.collect()
    time.sleep(1)  # for the gateway to drop them
    corpus_pipeline.encoded(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert grown >= 800 << 20 and jvm.java.lang.Runtime.getRuntime().totalMemory() < grown - (400 << 20)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, sf, name, stage):
    odd = spark.createDataFrame([(*r, 5, "s", "w", "t", "k") for r in ODD], SCHEMA)
    rows = {"quality_rules": 0, "near_duplicates": 9, "repeated_passages": len(ODD)}
    for df, want in ((odd, rows.get(name)), (odd.filter("doc_id = -1"), 0)):
        out = stage(spark, df, sf)
        n = out.count()
        assert name == "encoded" or out.columns == df.columns
        assert want is None or n == want
        assert name != "encoded" or n == df.count()
