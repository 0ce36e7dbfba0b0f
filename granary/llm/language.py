"""Language identification with string kernels: blended-spectrum presence kernels, Nyström landmarks, kernel ridge.

A text is the set of its character n-grams of orders 1 to 3 (lower case; what isn't a letter is one boundary character).
The kernel of two texts is the number of n-grams they share over the root of the product of their sizes. A bounded sample
of labelled texts gives landmarks and training rows; one-versus-rest ridge regression on the Nyström features gives weights
per landmark, and as the kernel is linear in the presence vector these fold into one matrix, n-grams by languages. Scoring
is a batched product of presence vectors with that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import by_bytes
from .common import col, documents, extended, fresh, map_arrow

#: Bounds of the sample: labelled rows of a language that train, and those among them that are landmarks.
TRAIN_ROWS = 240
LANDMARKS = 60
#: Code points of a text that train at most, so that the sample is bounded; predictions read whole texts.
TRAIN_CHARS = 200_000
#: Languages that are learnt at most, those with most labelled rows; all have 60 landmarks each in one matrix.
MOST_LANGUAGES = 200
RIDGE = 1e-2
#: Presence tables of up to so many n-grams are direct; larger alphabets use sorted search.
DIRECT = 1 << 22
BATCH = 64
UNKNOWN = "und"


class Alphabet:
    """Classes of code points: 0 is no letter, the last one a letter that the sample doesn't have."""

    def __init__(self, letters: str):
        self.letters = "".join(sorted(set(letters)))
        self.size = len(self.letters) + 2
        self.table = None

    def __getstate__(self) -> dict:
        return {"letters": self.letters, "size": self.size, "table": None}

    def classes(self, text: str) -> np.ndarray:
        if self.table is None:
            table = np.zeros(0x110000, dtype=np.int32)
            table[[i for i in range(0x110000) if chr(i).isalpha()]] = self.size - 1
            for k, c in enumerate(self.letters):
                table[ord(c)] = k + 1
            self.table = table
        c = self.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        if not c.any():
            return c[:0]
        c = np.concatenate([[0], c, [0]]).astype(np.int64)
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
        return c[keep]

    def grams(self, text: str) -> list[np.ndarray]:
        """Codes of the n-grams of each order, with repeats; codes of different orders don't meet."""
        c, n = self.classes(text), self.size
        if not len(c):
            return []
        two = c[:-1] * n + c[1:]
        three = two[:-1] * n + c[2:]
        return [c, two + n, three + n + n * n]

    def total(self) -> int:
        return self.size + self.size**2 + self.size**3


class Presence:
    """Presence vectors over a sorted vocabulary of n-gram codes."""

    def __init__(self, alphabet: Alphabet, vocabulary: np.ndarray):
        self.alphabet, self.vocabulary = alphabet, vocabulary
        self.seen = None

    def __getstate__(self) -> dict:
        return {"alphabet": self.alphabet, "vocabulary": self.vocabulary, "seen": None}

    def row(self, text: str, into: np.ndarray) -> int:
        """Fills in the vector; returns the number of different n-grams of the text, 0 if it has no letter."""
        grams = self.alphabet.grams(text)
        if not grams:
            into[:] = 0
            return 0
        if self.alphabet.total() <= DIRECT:
            if self.seen is None:
                self.seen = np.zeros(self.alphabet.total(), dtype=np.uint8)
            for g in grams:
                self.seen[g] = 1
            into[:] = self.seen[self.vocabulary]
            size = int(np.count_nonzero(self.seen))
            self.seen[:] = 0
            return size
        codes = np.unique(np.concatenate(grams))
        at = np.searchsorted(self.vocabulary, codes)
        ok = (at < len(self.vocabulary)) & (self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == codes)
        into[:] = 0
        into[at[ok]] = 1
        return len(codes)

    def kernel(self, texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts x columns of weights: presence / root of size times weights, sizes)."""
        out, sizes = np.zeros((len(texts), weights.shape[1]), dtype=np.float32), np.zeros(len(texts), dtype=np.int64)
        x = np.zeros((min(BATCH, max(1, len(texts))), len(self.vocabulary)), dtype=np.float32)
        for start in range(0, len(texts), BATCH):
            part = texts[start : start + BATCH]
            for k, t in enumerate(part):
                sizes[start + k] = self.row(t, x[k])
            out[start : start + len(part)] = x[: len(part)] @ weights
        return out / np.sqrt(np.maximum(sizes, 1))[:, None], sizes


class Model(NamedTuple):
    languages: list[str]
    presence: Presence | None
    weights: np.ndarray | None
    bias: np.ndarray | None

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        out, sizes = self.presence.kernel([t or "" for t in texts], self.weights)
        out = out + self.bias
        best = out.argmax(axis=1)
        score = np.clip((out[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, sizes, strict=True)], [float(v) if s else 0.0 for v, s in zip(score, sizes, strict=True)]


def train(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """rows: (language, text), in an order that is random with regard to content. Texts without a letter teach nothing."""
    rows = [(lang, text) for lang, text in rows if text and any(c.isalpha() for c in text)]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], None, None, None)
    marks: list[str] = []
    for lang in languages:
        marks += [t for g, t in rows if g == lang][:landmarks]
    alphabet = Alphabet("".join({c for t in marks for c in set(t.lower()) if c.isalpha()}))
    vocabulary = np.unique(np.concatenate([np.unique(np.concatenate(alphabet.grams(t))) for t in marks]))
    presence = Presence(alphabet, vocabulary)
    z = np.zeros((len(marks), len(vocabulary)), dtype=np.float32)
    for k, t in enumerate(marks):
        size = presence.row(t, z[k])
        z[k] /= np.sqrt(size)
    kmm = (z @ z.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kmm)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    knm, _ = presence.kernel([t for _, t in rows], np.ascontiguousarray(z.T))
    phi = knm.astype(np.float64) @ root
    y = np.where(np.array([lang for lang, _ in rows])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean_phi, mean_y = phi.mean(axis=0), y.mean(axis=0)
    centred = phi - mean_phi
    w = np.linalg.solve(centred.T @ centred + ridge * np.eye(phi.shape[1]), centred.T @ (y - mean_y))
    folded = z.T.astype(np.float64) @ (root @ w)
    return Model(languages, presence, folded.astype(np.float32), (mean_y - mean_phi @ w).astype(np.float32))


def remainder(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3


def sample(df: DataFrame, key: str, text: str, lang: str, rows: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """Up to `rows` labelled texts of each language, picked by a hash of the key, and so the same in every run.

    Counting first keeps the pick cheap: only about twice the wanted rows of a language leave the scan.
    """
    from pyspark.sql import Window

    there = df.filter(col(lang).isNotNull() & col(text).isNotNull() & (remainder(col(key)) != 1)).select(col(lang).alias("lang"), col(text).alias("text"), F.xxhash64(col(key).cast("string")).alias("h"))
    counts = there.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    # a hash below this share of its range: wanted rows and a margin
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, (2 * rows + 50) / r["count"])))])
    near = there.filter(F.col("lang").isin(*[r["lang"] for r in counts])).filter(F.pmod(F.col("h"), F.lit(1_000_000)) <= share[F.col("lang")] * 1_000_000)
    order = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    picked = near.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rows)
    return [(r["lang"], r["text"]) for r in picked.orderBy("k", "lang").select("lang", F.left("text", F.lit(TRAIN_CHARS)).alias("text")).collect()]


def identify(df: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str, str]:
    """df with two new columns, whose names are returned: language and score (0 to 1, from the winning regression).

    Null texts and texts without a letter get 'und' and 0. Whole texts count. Rows are independent; other columns pass
    through whatever their names; an empty table gives an empty table. Without training rows all is 'und'.
    """
    pred, score = fresh(df, "lang_pred", "score")
    place = df.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            texts = whole.column(place).to_pylist()
            for first, n in by_bytes([len(t or "") for t in texts]):
                names, scores = model.predict(texts[first : first + n])
                yield extended(whole.slice(first, n), pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64()))

    return map_arrow(df, run, [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]), pred, score


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(sample(docs, "doc_id", "text", "lang"))
    work, pred, score = identify(docs.select("doc_id", "text"), model)
    return work.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), F.col(pred).alias("lang_pred"), F.col(score).alias("score"))
