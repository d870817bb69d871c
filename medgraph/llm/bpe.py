"""BPE encoding and decoding with a public vocabulary file, by a pair occurrence index.

The distinct words of a slice of documents are laid out as one row of symbols.  An index maps
each mergeable pair to all its positions; the active ranks are applied in ascending order, and
each merge moves the positions of the pairs it breaks and makes to other lists of the index.
Words already seen and their pieces are kept in bounded per-worker memories, so that the index only
takes new pieces.

Null text is the empty text; empty text has no ids and decodes to ''.  Repeated rows give the
same result twice.  Columns other than the id and text are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import doc_id_of, keyed, released, table

#: Fixed value: the split pattern of the vocabulary file; white space never belongs to a piece.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
PIECES = regex.compile(PATTERN)
#: The pieces of words, and the line ends between words.
PIECES_AND_ENDS = regex.compile(PATTERN + r"|\n")
VOCABULARY = "word_bpe_49k.json"
SPACES = regex.compile(r"\p{White_Space}+")
#: str.split() also splits at these four; the vocabulary's white space does not hold them.
ODD_SPACE = regex.compile("[\x1c-\x1f]").search
#: Words, and as many pieces of words, in each of the two generations that a worker remembers.
REMEMBERED = 200_000
SLICE_CHARS = 4 << 20


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {}, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Splitter:
    """Words of texts and pieces of words; all that it keeps of the vocabulary file are the special tokens."""

    def __init__(self, path: str):
        self.read(json.load(open(path, encoding="utf-8")))

    def read(self, spec: dict) -> None:
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def words(self, text: str) -> list[str]:
        """The white-space separated words of a text: no piece or special token spans two of them."""
        return text.split() if not ODD_SPACE(text) else SPACES.split(text)

    def pieces(self, word: str) -> list[str]:
        """Special tokens and normalised pieces of a word, in order."""
        if self.specials is None or "<|" not in word or not self.specials.search(word):
            return PIECES.findall(self.normal(word))
        out, at = [], 0
        for m in self.specials.finditer(word):
            out += PIECES.findall(self.normal(word[at : m.start()]))
            out.append(m[0])
            at = m.end()
        return out + PIECES.findall(self.normal(word[at:]))

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def split_words(self, words: list[str]) -> list[list[str]]:
        """Special tokens and normalised pieces of each word, all at once; a word with a special token or a capital sigma on its own."""
        alone = {w for w in words if "<|" in w or "Σ" in w}
        out: list[list[str]] = []
        some: list[str] = []
        for p in PIECES_AND_ENDS.findall(self.normal("\n".join([*(w for w in words if w not in alone), ""]))):
            if p == "\n":
                out.append(some)
                some = []
            else:
                some.append(p)
        if not alone:
            return out
        rest = iter(out)
        return [self.pieces(w) if w in alone else next(rest) for w in words]


class PairIndexBPE(Splitter):
    """A vocabulary and its merges; encode_words() works on many words at once."""

    def read(self, spec: dict) -> None:
        super().read(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.tokens.update({i: t for t, i in self.special.items()})
        #: The symbol of each byte inside a word, then at its end (-2: none), the merges by both symbols in one number, and the ranks by both bytes.
        letters = byte_letters()
        self.symbols = np.array([self.vocab.get(c + e, -2) for e in ("", self.suffix) for c in letters], np.int64)
        self.by_pair = {a << 32 | b: m for (a, b), m in self.merges.items()}
        known = {int(x): i for i, x in enumerate(self.symbols) if x >= 0}
        same = np.array([known.get(int(x), -1) for x in self.symbols])
        self.first_rank = np.full((513, 513), -1, np.int64)  # 512: the end of a word
        for (a, b), (rank, _) in self.merges.items():
            if a in known and b in known:
                self.first_rank[np.ix_(np.flatnonzero(same == known[a]), np.flatnonzero(same == known[b]))] = rank

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by one occurrence index over all of them."""
        if not words:
            return []
        raw = [w.encode("utf-8") for w in words]
        data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1
        data[ends] = 512  # no pair spans two words
        last = ends[np.diff(ends, prepend=-1) > 1] - 1
        data[last] += 256
        row = np.append(self.symbols, -1)[data]
        data, row = data[row != -2], row[row != -2]
        ranks = self.first_rank[data[:-1], data[1:]]
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        active, starts = np.unique(ranks[places], return_index=True)
        where: dict[int, list[int]] = {r: p.tolist() for r, p in zip(active.tolist(), np.split(places, starts[1:]), strict=len(active) > 0)}
        sym: list[int] = row.tolist()
        pair_of = {r: (sym[p[0]], sym[p[0] + 1]) for r, p in where.items()}
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        active = list(where)
        heapify(active)
        merge_of = self.by_pair.get
        while active:
            rank = heappop(active)
            a, b = pair_of[rank]
            made = self.by_pair[a << 32 | b][1]
            places = where.pop(rank)
            if a == b:
                places.sort()  # aaa is merged from the left
            for i in places:
                j = nxt[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue  # an earlier merge took one of the two
                k = nxt[j]
                sym[i], sym[j] = made, -2
                nxt[i] = k
                prv[k] = i  # the end of its word follows every symbol
                if (s := sym[k]) >= 0 and (m := merge_of(made << 32 | s)) is not None:
                    r = m[0]
                    if r in where:
                        where[r].append(i)
                    else:
                        heappush(active, r)
                        pair_of[r], where[r] = (made, s), [i]
                if (h := prv[i]) >= 0 and (s := sym[h]) >= 0 and (m := merge_of(s << 32 | made)) is not None:
                    r = m[0]
                    if r in where:
                        where[r].append(h)
                    else:
                        heappush(active, r)
                        pair_of[r], where[r] = (s, made), [h]
        row = np.array(sym, np.int64)
        row = row[row != -2]
        ends, flat = np.flatnonzero(row == -1).tolist(), row.tolist()
        return [flat[i:j] for i, j in zip([0, *(e + 1 for e in ends[:-1])], ends, strict=True)]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of special tokens and of normalised pieces, these by one index."""
        plain = iter(self.encode_words([p for p in pieces if p not in self.special]))
        return [[self.special[p]] if p in self.special else next(plain) for p in pieces]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space: the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


@contextmanager
def uncollected() -> Iterator[None]:
    """What is made meanwhile holds no cycles: the collector need not walk what is remembered again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Remembered:
    """Bounded memory of a worker: word -> entry(ids), filled by encode(words).

    Two generations: once the newer one holds `most` words it becomes the older one, and what of
    that is met again moves on, so frequent words stay.
    """

    def __init__(self, encode, entry, most: int = REMEMBERED):
        self.encode, self.entry, self.most, self.seen, self.old = encode, entry, most, {}, {}

    def clear(self) -> None:
        self.seen, self.old = {}, {}

    @uncollected()
    def learn(self, split: list[list[str]]) -> dict:
        """Makes sure that every word of these texts is remembered."""
        if len(self.seen) > self.most:
            self.old, self.seen = self.seen, {}
        missing = set().union(*split) - self.seen.keys()
        again = missing & self.old.keys()
        self.seen.update(zip(again, map(self.old.__getitem__, again), strict=True))
        new = list(missing - again)
        self.seen.update(zip(new, map(self.entry, self.encode(new)), strict=True))
        return self.seen


_loaded: dict[tuple[str, str], tuple[PairIndexBPE, Remembered]] = {}


def loaded(path: str, use: str, entry, joined) -> tuple[PairIndexBPE, Remembered]:
    """One model for each file and use in a worker; what is remembered differs by use: entry(model, ids) of a piece, joined(entries) of a word of no or several pieces."""
    if (path, use) not in _loaded:
        model = PairIndexBPE(path)
        pieces = Remembered(model.encode_pieces, lambda ids: entry(model, ids))

        def encode(words: list[str]) -> list:
            split = model.split_words(words)
            known = pieces.learn(split)
            return [known[s[0]] if len(s) == 1 else joined([known[p] for p in s]) for s in split]

        _loaded[path, use] = model, Remembered(encode, lambda e: e)
    return _loaded[path, use]


def text_slices(texts: Iterable[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    first, size, some = 0, 0, []
    for i, t in enumerate(texts):
        if some and size + len(t) > most:
            yield first, some
            first, size, some = i, 0, []
        some.append(t)
        size += len(t)
    if some:
        yield first, some


def encode(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string: the general form."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memory = loaded(path, "ids", lambda model, ids: ids, lambda parts: [i for x in parts for i in x])
        for b in batches:
            for first, some in text_slices(t.as_py() for t in b.column(1)):
                split = [model.words(t) for t in some]
                known = memory.learn(split)
                ids = [[i for w in s for i in known[w]] for s in split]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(some)), pa.array(ids, pa.list_(pa.int32())), pa.array([model.decode(x) for x in ids], pa.string())],
                    ["_ord", "ids", "decoded"],
                )

    out = keyed(df, id_col, text_col).select("_ord", "_text").mapInArrow(run, "_ord long, ids array<int>, decoded string")
    return out.select(doc_id_of().alias("doc_id"), "ids", "decoded")


def digests(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 without carrying the ids: per word, the decimal ids and the decoded text are remembered and joined."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        some = [e for e in parts if e[0]]
        return sum(e[0] for e in some), " ".join([e[1] for e in some]), " ".join([e[2] for e in some])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = lambda model, ids: (len(ids), " ".join(map(str, ids)), model.decode(ids))
        model, memory = loaded(path, "digests", entry, joined)
        for b in batches:
            for first, some in text_slices(t.as_py() for t in b.column(1)):
                split = [model.words(t) for t in some]
                known = memory.learn(split)
                n, ids, text = [], [], []
                for s in split:
                    got = [e for e in map(known.__getitem__, s) if e[0]]
                    n.append(sum(e[0] for e in got))
                    ids.append(hashlib.sha256(" ".join([e[1] for e in got]).encode()).hexdigest())
                    text.append(hashlib.sha256(" ".join([e[2] for e in got]).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(some)), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)], ["_ord", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = keyed(df, id_col, text_col).select("_ord", "_text").mapInArrow(run, "_ord long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.select(doc_id_of().alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op10_bpe_encode_decode(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"))
