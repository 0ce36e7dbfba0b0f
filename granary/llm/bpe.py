"""BPE encoding and decoding with a given vocabulary, exact to the tokenizers library, by tree concatenation.

A text is halved, whatever its white space, down to leaves. The leaves of a batch are encoded together; where the vocabulary
drops white space, a leaf is a row of words and the words that a task has met are remembered. Then neighbours are joined, level
by level. Around a join the tokens are wrong, so a window of text around it is encoded again and grown until its first
tokens agree exactly with those of the left side and its last ones with those of the right side; from there on both sides
stand, since a BPE encoding is right if every adjacent pair of it is. The upper halves of very long texts go to several tasks,
and their joins to one task a text.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, documents, extended, fresh, held, map_arrow, trimmed

#: Bytes of a leaf of the tree; longer texts are halved.
LEAF = 2_048
#: Bytes up to which a text is encoded by one task; the halves of a longer one are dealt to several.
SPREAD = 1 << 20
#: Tokens of each side in the first window around a join.
FIRST_WINDOW = 16
#: Bytes around a join in which agreement doesn't count: contractions and special tokens are shorter.
MARGIN = 32
#: Bytes of words and pre-tokens that a worker remembers before it forgets them all (a batch may add up to twice its own).
REMEMBERED = 4 << 20
#: Bytes of text that are encoded at a time (one text at least).
SLICE_BYTES = 1 << 20


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The library's tokenizer of that file, without truncation and padding; one thread, as a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def runs_from(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the same of the next."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def cuts(data: bytes, start: int, end: int, leaf: int) -> list[int]:
    """Where halving cuts data[start:end] until no piece is longer than leaf; never inside a character or before one that combines."""
    if end - start <= leaf:
        return []
    mid = (start + end) // 2
    while mid < end and not _free(data, mid):
        mid += 1
    if mid >= end:
        return []
    return [*cuts(data, start, mid, leaf), mid, *cuts(data, mid, end, leaf)]


def _free(data: bytes, at: int) -> bool:
    """Whether the text may be cut at that byte."""
    if data[at] < 128:
        return True
    if data[at] & 0xC0 == 0x80:
        return False
    before = data[max(0, at - 4) : at].decode(errors="ignore")[-1:]
    after = data[at : at + 4].decode(errors="ignore")[:1]
    return not unicodedata.combining(after) and unicodedata.normalize("NFC", before + after) == before + after


#: Punctuation that ends a run of letters and is a pre-token of its own; none of it is part of a contraction or special token.
TAIL = ".,;:!?&%$#*"
#: Pre-tokens that the library encodes as one text.
TOGETHER = 2_000


def pre_tokens(words):
    """(heads, tails) of an Arrow array of words: a run of letters and the punctuation after it apart, any other word whole.

    ASCII letters come in lower case, as the normaliser makes them, so that The, the. and the share one encoding.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    stem = pc.utf8_rtrim(words, characters=TAIL)
    letters = pc.and_(pc.utf8_is_alpha(stem), pc.greater(pc.binary_length(stem), 0))
    heads = pc.if_else(letters, pc.if_else(pc.string_is_ascii(stem), pc.ascii_lower(stem), stem), words)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset + 1 : words.offset + 1 + len(words)].astype(np.int64)
    size = np.where(letters.to_numpy(zero_copy_only=False), (pc.binary_length(words).to_numpy() - pc.binary_length(stem).to_numpy()).astype(np.int64), 0)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[runs_from(ends - size, size)]
    tails = pa.Array.from_buffers(pa.utf8(), len(words), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(data)])
    return heads, tails


def numbered(known: dict, keys: list) -> tuple[np.ndarray, list]:
    """(the number of each of different keys, those that are new), which get the next numbers."""
    get = known.get
    numbers = np.array([get(k, -1) for k in keys], dtype=np.int64)
    fresh = np.flatnonzero(numbers < 0)
    new = [keys[i] for i in fresh.tolist()]
    numbers[fresh] = np.arange(len(known), len(known) + len(new))
    known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
    return numbers, new


class Growing:
    """An array of rows that columns are added to."""

    def __init__(self, rows: int):
        self.data, self.n = np.zeros((rows, 1024), dtype=np.int64), 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + more.shape[1]
        if need > self.data.shape[1]:
            self.data = np.concatenate([self.data[:, : self.n], np.zeros((len(self.data), 2 * need - self.n), dtype=np.int64)], axis=1)
        self.data[:, self.n : need] = more
        self.n = need


#: Token ids, and the first byte and the byte after the last of what they stand for: an array of three rows.
Tokens = np.ndarray
NONE = np.zeros((3, 0), dtype=np.int64)


class Side:
    """The tokens of a part of a text, in blocks, so that a join only touches those next to it."""

    def __init__(self, start: int, end: int, blocks: list[Tokens]):
        self.start, self.end, self.blocks = start, end, blocks
        self.n = sum(b.shape[1] for b in blocks)

    def last(self, n: int) -> Tokens:
        out: list[Tokens] = []
        for b in reversed(self.blocks):
            if n <= 0:
                break
            out.append(b[:, max(0, b.shape[1] - n) :])
            n -= b.shape[1]
        return np.concatenate(out[::-1], axis=1) if out else NONE

    def first(self, n: int) -> Tokens:
        out: list[Tokens] = []
        for b in self.blocks:
            if n <= 0:
                break
            out.append(b[:, :n])
            n -= b.shape[1]
        return np.concatenate(out, axis=1) if out else NONE

    def without(self, first: int, last: int) -> list[Tokens]:
        """The blocks without so many first and last tokens."""
        out = []
        at = 0
        for b in self.blocks:
            low, high = max(0, first - at), min(b.shape[1], self.n - last - at)
            at += b.shape[1]
            if high > low:
                out.append(b[:, low:high])
        return out


def _agree(window: list[tuple], side: list[tuple], low: int, high: int) -> tuple[int, int] | None:
    """Positions in window and side of the first token that both have, with ends within low and high.

    Tokens that share their characters with a neighbour (parts of one character) don't count.
    """
    of = {t: k for k, t in enumerate(side)}
    for k, t in enumerate(window):
        if low <= t[1] < t[2] <= high and t in of and all(window[j][1:] != t[1:] for j in (k - 1, k + 1) if 0 <= j < len(window)):
            return k, of[t]
    return None


class Codec:
    """Encodes and decodes texts (as UTF-8), remembering words."""

    def __init__(self, path: str, leaf: int = LEAF):
        self.tokenizer, self.leaf = load(path), leaf
        encode = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        #: Without a decoder the library joins tokens by a space, so decoded texts can be put together from a table.
        self.plain = self.tokenizer.decoder is None
        #: Whether white space and letter case are dropped; if not, a leaf is one word.
        self.splits = self.plain and encode("Ab c") == encode("ab") + encode("c") == encode("ab\n  c")
        if self.plain:
            names = {i: t.encode() + b" " for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
            size = np.array([len(names.get(i, b"")) for i in range(max(names) + 1)], dtype=np.int64)
            self.name_bytes = np.frombuffer(b"".join(names[i] for i in sorted(names)), dtype=np.uint8)
            self.name_size, self.name_start = size, np.cumsum(size) - size
            #: Bytes that a token stands for: a character of its name each, without the mark of a word's end; and whether it has that.
            end = self.tokenizer.model.end_of_word_suffix or "\0"
            spelt = [names.get(i, b"").decode().rstrip(" ") for i in range(len(size))]
            self.name_covers = np.array([len(t.removesuffix(end)) for t in spelt], dtype=np.int64)
            self.name_ends = np.array([t.endswith(end) for t in spelt], dtype=bool)
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.pieces: dict[str, int] = {}
        self.held = 0
        #: Of each word: its first and second pre-token (or -1), and where the second begins.
        self.words = Growing(3)
        #: Of each pre-token: where its tokens begin, and their number.
        self.places = Growing(2)
        self.tokens = Growing(3)

    # --- leaves ---

    def located(self, texts: list[bytes], shift: list[int]) -> list[Tokens]:
        """The library's tokens of each text, as bytes from shift on."""
        if not texts:
            return []
        found = self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
        ids = [e.ids for e in found]
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        out = np.empty((3, counts.sum()), dtype=np.int64)
        out[0] = [i for row in ids for i in row]
        offsets = np.array([x for e in found for x in e.offsets], dtype=np.int64).reshape(-1, 2).T
        # characters to bytes: the starts of all characters, one text after the other, and where each text's begin
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        begin = np.cumsum(size) - size
        chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        first = np.searchsorted(chars, begin)
        out[1:] = chars[offsets + np.repeat(first, counts)] + np.repeat(np.array(shift, dtype=np.int64) - begin, counts)
        return np.split(out, np.cumsum(counts)[:-1], axis=1)

    def learn(self, words) -> np.ndarray:
        """The number of each of different words (an Arrow array); those not met yet are encoded, together."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.held > REMEMBERED:
            self.forget()
        index, pieces = self.index, self.pieces
        listed = words.cast(pa.binary()).to_pylist()
        numbers, new = numbered(index, listed)
        if new:
            heads, tails = pre_tokens(pa.array(new, type=pa.binary()).cast(pa.utf8()))
            size = pc.binary_length(heads).to_numpy().astype(np.int64)
            second = np.flatnonzero(pc.binary_length(tails).to_numpy())
            met = pa.concat_arrays([heads, tails.take(pa.array(second))]).dictionary_encode()
            number, asked = numbered(pieces, met.dictionary.to_pylist())
            number = number[met.indices.to_numpy()]
            made = np.stack([number[: len(new)], np.full(len(new), -1, dtype=np.int64), size])
            made[1, second] = number[len(new) :]
            self.words.add(made)
            if asked:
                found, counts, starts = self.pretokens(asked)
                self.places.add(np.stack([self.tokens.n + starts, counts]))
                self.tokens.add(found)
            self.held += sum(map(len, new)) + sum(map(len, asked))
        return numbers

    def pretokens(self, asked: list[str]) -> tuple[Tokens, np.ndarray, np.ndarray]:
        """(tokens, number of each, where each's begin) of parts of words, as bytes from their own start on.

        Runs of letters or of TAIL that the normaliser leaves alone are one pre-token each, so many are encoded as one text and
        told apart by the marks of words' ends; their tokens follow one another byte by byte, and stand for whole characters.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        array = pa.array(asked, type=pa.utf8())
        single = pc.or_(pc.utf8_is_alpha(array), pc.equal(pc.utf8_rtrim(array, characters=TAIL), "")).to_numpy(zero_copy_only=False)
        ascii_ = pc.string_is_ascii(array).to_numpy(zero_copy_only=False)
        single &= np.array([a or (t.lower() == t and unicodedata.is_normalized("NFC", t)) for a, t in zip(ascii_.tolist(), asked, strict=True)], dtype=bool)
        counts, starts = np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=np.int64)
        out = NONE
        which = np.flatnonzero(single)
        if len(which):
            texts = array.take(pa.array(which)).to_pylist()
            rows = self.tokenizer.encode_batch_fast([" ".join(texts[k : k + TOGETHER]) for k in range(0, len(texts), TOGETHER)], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=np.int64) for e in rows])
            ends = np.flatnonzero(self.name_ends[ids]) + 1
            size = self.name_covers[ids]
            upto = np.concatenate([[0], np.cumsum(size)])
            bytes_ = pc.binary_length(pa.array(texts)).to_numpy().astype(np.int64)
            if len(ends) == len(which) and ends[-1] == len(ids) and (np.diff(upto[ends], prepend=0) == bytes_).all():
                counts[which] = np.diff(ends, prepend=0)
                starts[which] = ends - counts[which]
                own = np.repeat(np.cumsum(bytes_) - bytes_, counts[which])
                chars = np.frombuffer("".join(texts).encode() + b"\0", dtype=np.uint8)
                chars = np.flatnonzero((chars & 0xC0) != 0x80)
                out = np.stack([ids, chars[np.searchsorted(chars, upto[:-1], side="right") - 1] - own, chars[np.searchsorted(chars, upto[1:])] - own])
            else:
                single[:] = False
        which = np.flatnonzero(~single)
        if len(which):
            found = self.located([asked[k].encode() for k in which.tolist()], [0] * len(which))
            counts[which] = [t.shape[1] for t in found]
            starts[which] = out.shape[1] + np.cumsum(counts[which]) - counts[which]
            out = np.concatenate([out, *found], axis=1)
        return out, counts, starts

    def leaves(self, data: bytes, bounds: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """(tokens of all leaves, where each leaf's end) of the leaves data[bounds[k]:bounds[k + 1]]."""
        import pyarrow as pa
        import pyarrow.compute as pc

        size = np.diff(bounds)
        if self.splits:
            space = np.isin(np.frombuffer(data, dtype=np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
            first = ~space
            first[1:] &= space[:-1]
            edge = bounds[:-1][size > 0]
            first[edge] = ~space[edge]
            starts = np.flatnonzero(first)
            rows = pa.Array.from_buffers(pa.utf8(), len(size), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])
            words = pc.ascii_split_whitespace(rows).flatten()
            words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
            number = self.learn(words.dictionary)
            both = self.words.data[:, number[words.indices.to_numpy()]]
            piece = both[:2].T.ravel()
            begin = np.stack([starts, starts + both[2]], axis=1).ravel()[piece >= 0]
            place, counts = self.places.data[:, piece[piece >= 0]]
            tokens = self.tokens.data[:, runs_from(place, counts)]
            tokens[1:] += np.repeat(begin, counts)
            return tokens, np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begin, bounds[1:])]
        found = self.located([data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], bounds[:-1].tolist())
        return (np.concatenate(found, axis=1) if found else NONE), np.cumsum([t.shape[1] for t in found])

    # --- joins ---

    def join(self, data: bytes, pairs: list[tuple[Side, Side]]) -> list[Side]:
        """The tokens of neighbouring parts of texts as one part each; their windows are encoded together."""
        out: list[Side | None] = [None] * len(pairs)
        todo, size = list(range(len(pairs))), FIRST_WINDOW
        while todo:
            tails = [pairs[k][0].last(size) for k in todo]
            heads = [pairs[k][1].first(size) for k in todo]
            spans = []
            for k, tail, head in zip(todo, tails, heads, strict=True):
                left, right = pairs[k]
                spans.append((left.start if size >= left.n else int(tail[1, 0]), right.end if size >= right.n else int(head[2, -1])))
            windows = self.located([data[a:b] for a, b in spans], [a for a, _ in spans])
            again = []
            for k, tail, head, (a, b), window in zip(todo, tails, heads, spans, windows, strict=True):
                left, right = pairs[k]
                cut = left.end
                listed = list(zip(*window.tolist(), strict=True))
                all_left, all_right = size >= left.n, size >= right.n
                first = (0, 0) if all_left else _agree(listed, list(zip(*tail.tolist(), strict=True)), a, cut - MARGIN)
                back = (0, 0) if all_right else _agree(listed[::-1], list(zip(*head.tolist(), strict=True)), cut + MARGIN, b)
                if first is None or back is None or (not all_left and not all_right and first[0] >= window.shape[1] - 1 - back[0]):
                    again.append(k)
                    continue
                middle = window[:, first[0] : window.shape[1] if all_right else window.shape[1] - 1 - back[0]]
                blocks = [] if all_left else left.without(0, tail.shape[1] - first[1])
                out[k] = Side(left.start, right.end, [*blocks, middle, *([] if all_right else right.without(back[1], 0))])
            todo, size = again, 2 * size
        return out  # type: ignore[return-value]

    def joined(self, data: bytes, rows: list[list[Side]]) -> list[Side]:
        """One part from the neighbouring parts of each text, in a tree; the joins of a level are made together."""
        rows = [r[:] for r in rows]
        while any(len(r) > 1 for r in rows):
            made = iter(self.join(data, [(r[k], r[k + 1]) for r in rows for k in range(0, len(r) - 1, 2)]))
            rows = [[next(made) if k + 1 < len(r) else r[k] for k in range(0, len(r), 2)] for r in rows]
        return [r[0] for r in rows]

    def encoded(self, data: bytes, ends: list[int]) -> list[Side]:
        """The tokens of each of the texts that stand one after the other in data and end there."""
        at = [0, *ends]
        inner = [cuts(data, a, b, self.leaf) if b - a > self.leaf else [] for a, b in zip(at, at[1:])]
        bounds = np.array([0, *(x for c, e in zip(inner, ends, strict=True) for x in (*c, e))], dtype=np.int64)
        tokens, upto = self.leaves(data, bounds)
        edges, sides, k = [0, *upto.tolist()], [], 0
        for c in inner:
            sides.append([Side(int(bounds[j]), int(bounds[j + 1]), [tokens[:, edges[j] : edges[j + 1]]]) for j in range(k, k + len(c) + 1)])
            k += len(c) + 1
        return self.joined(data, sides)

    # --- results ---

    def decoded(self, ids: np.ndarray, counts: np.ndarray):
        """The decoded texts of rows of so many ids each, as an Arrow array."""
        import pyarrow as pa

        if not self.plain:
            cut = np.cumsum(counts)[:-1]
            return pa.array([self.tokenizer.decode(x.tolist(), skip_special_tokens=False) for x in np.split(ids, cut)] if len(counts) else [], type=pa.string())
        size = self.name_size[ids]
        data = self.name_bytes[runs_from(self.name_start[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
        full = counts > 0
        keep = np.ones(len(data), dtype=bool)
        keep[ends[full] - 1] = False
        ends = ends - np.cumsum(full)
        return pa.Array.from_buffers(pa.utf8(), len(counts), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(data[keep])])

    def batch(self, texts: list[bytes | None]) -> tuple:
        """(token ids, decoded texts) as Arrow arrays."""
        import pyarrow as pa

        whole = [t or b"" for t in texts]
        sides = self.encoded(b"".join(whole), np.cumsum([len(t) for t in whole]).tolist())
        return self.arrays([[b[0] for b in s.blocks] for s in sides], pa)

    def arrays(self, rows: list[list[np.ndarray]], pa) -> tuple:
        counts = np.array([sum(len(b) for b in r) for r in rows], dtype=np.int64)
        flat = [b for r in rows for b in r]
        ids = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))), self.decoded(ids, counts)


def encode_long(codec: Codec, text: str) -> list[int]:
    """Token ids of a text by the tree; equal to the library's encode(text, add_special_tokens=False).ids."""
    return codec.batch([text.encode()])[0].flatten().to_pylist()


def by_bytes(sizes: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of rows that hold at most so many bytes together, or are one row."""
    first = held = 0
    for k, n in enumerate(sizes):
        if k > first and held + n > most:
            yield first, k - first
            first, held = k, 0
        held += n
    if len(sizes) > first:
        yield first, len(sizes) - first


def encode(df: DataFrame, text: str = "text", path: str | None = None, spread: int = SPREAD) -> tuple[DataFrame, str, str]:
    """df with the token ids (array of int) and the decoded text of a column, and the names of these two new columns.

    Null and empty texts have no tokens and decode to ''. Texts are encoded whole, whatever their length: one task holds a few
    texts of up to spread bytes; a longer one is halved into pieces that several tasks encode, each different one once, and
    one task joins. Rows are independent, so repeated rows get equal results; other columns pass through whatever their names;
    an empty table gives an empty table.
    """
    path = path or vocabulary()
    ids, decoded = fresh(df, "ids", "decoded")
    added = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    place = df.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = held(path, lambda: Codec(path))
        for whole in batches:
            texts = whole.column(place).cast(pa.binary()).to_pylist()
            for first, n in by_bytes([len(t or b"") for t in texts]):
                yield extended(whole.slice(first, n), *codec.batch(texts[first : first + n]))

    size = F.octet_length(col(text))
    long = df.filter(size > spread)
    if long.isEmpty():
        return map_arrow(df, run, added, keeps=path), ids, decoded
    short = map_arrow(df.filter(size.isNull() | (size <= spread)), run, added, keeps=path)
    (h,) = fresh(df, "hash")
    long = long.withColumn(h, F.sha2(col(text), 256))
    done = _spread(long.select(col(h).alias("h"), col(text).alias("text")).dropDuplicates(["h"]), path, spread).toDF(h, ids, decoded)
    return short.unionByName(long.join(done, h).select(*[col(c) for c in short.columns])), ids, decoded


def _spread(texts: DataFrame, path: str, spread: int) -> DataFrame:
    """h, ids, decoded of texts (h, text): pieces are encoded by many tasks, those of a text joined by one."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                at = [0, *cuts(t, 0, len(t), spread // 4), len(t)]
                for a, b in zip(at, at[1:]):
                    yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([a], type=pa.int64()), pa.array([t[a:b]], type=pa.binary())], names=["h", "at", "piece"])

    def encoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = Codec(path)
        for batch in batches:
            for k, piece in enumerate(batch.column(2).to_pylist()):
                (side,) = codec.encoded(piece, [len(piece)])
                tokens = np.concatenate([*side.blocks, NONE], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, pa.array([tokens.tobytes()], type=pa.binary())], names=["h", "at", "piece", "tokens"])

    def joined(pieces):
        import pandas as pd
        import pyarrow as pa

        codec = Codec(path)
        pieces = pieces.sort_values("at")
        sides = [Side(at, at + len(p), [np.frombuffer(t, dtype=np.int64).reshape(3, -1) + np.array([[0], [at], [at]])]) for at, p, t in zip(pieces["at"], pieces["piece"], pieces["tokens"], strict=True)]
        (side,) = codec.joined(b"".join(pieces["piece"]), [sides])
        ids, decoded = codec.arrays([[b[0] for b in side.blocks]], pa)
        return pd.DataFrame({"h": [pieces["h"].iloc[0]], "ids": [ids[0].values.to_numpy()], "decoded": [decoded[0].as_py()]})

    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = texts.mapInArrow(trimmed(cut), "h string, at long, piece binary").repartition(tasks, "h", "at")
    return pieces.mapInArrow(trimmed(encoded), "h string, at long, piece binary, tokens binary").groupBy("h").applyInPandas(joined, "h string, ids array<int>, decoded string")


def digests(df: DataFrame, key: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """key columns, n_tokens, and SHA-256 of the ids and of the decoded text."""
    work, ids, decoded = encode(df.select(*[col(k) for k in key], col(text)), text, path)
    return work.select(
        *[col(k) for k in key], F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
