"""Toxicity by compression distance: zstandard dictionaries trained on toxic and on ordinary text.

Fitting.  A bounded sample of labelled rows (MAX_TOXIC and MAX_ORDINARY documents, none longer
than MAX_SAMPLE_BYTES, taken by hash of the id) is brought to one task, which returns the model
alone, so that the driver holds no text.  Byte grams that toxic texts hold, once or several
times, and ordinary ones hardly choose the windows on which the toxic dictionary is trained; the
ordinary dictionary is trained on all windows of the ordinary sample.
A window is one word with the spaces around it.  Each window gets a cell: its own length and its
compressed lengths under either dictionary.  Every cell is calibrated, for each number of TIMES,
to the log ratio of toxic to ordinary sample documents that hold such windows at least so often.

Scoring.  From its cells, each with the best ratio up to the number of its windows, a document's
three largest ratios, the root of its summed ratios above a threshold and the log of its length
enter a logistic model, weighted to the label counts of the whole table.
Every word of every text is compressed (lengths of words already met are remembered in a worker).

Null and empty texts are scored as texts without windows.  Labels that are null are unlabelled.
A document labelled more than once counts as toxic if any label says so.  Without a toxic or an
ordinary row to learn from, every score is 0.  Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import pickle
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import text_slices
from .common import doc_id_of, keyed, released, table

MAX_TOXIC = 1500
MAX_ORDINARY = 4500
MAX_SAMPLE_BYTES = 40_000
#: Bytes of a mark, and how often a text has to hold it.
GRAM, MARK_TIMES = 7, (1, 3)
#: Numbers of windows of one cell in a document that are calibrated each for themselves.
TIMES = (1, 2, 3, 5)
#: Window bytes told apart in a cell.
MAX_WINDOW = 64
TOXIC_DICT, ORDINARY_DICT = 8192, 65536
LEVEL = 3
#: Share of the ids, by checksum, on which nothing is learnt.
HELD_OUT = 5
#: Words remembered in a task, beyond which the memory starts anew; characters taken at once.
REMEMBERED, SLICE_CHARS = 250_000, 1 << 20
FLOOR, STRONG = 0.5, 1.5


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def windows(text: str) -> list[str]:
    return text.lower().split()


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, min_match=3)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=params)


def _raw(word: str) -> bytes:
    return b" " + word.encode("utf-8") + b" "


@dataclass
class Model:
    """Two dictionaries, best log ratios by cell and number of windows, and the logistic weights."""

    toxic: bytes
    ordinary: bytes
    ratios: dict[tuple[int, int, int], list[float]]
    weights: list[float]
    memo: dict | None = None

    def cells(self, words: list[str]) -> list[tuple[int, int, int]]:
        if not hasattr(self, "_c"):
            self._c = _compressor(self.ordinary), _compressor(self.toxic)
        a, b = self._c
        raw = [_raw(w) for w in words]
        return [(min(len(w), MAX_WINDOW), len(a.compress(w)), len(b.compress(w))) for w in raw]

    def known(self, split: list[list[str]]) -> dict:
        """word -> cell, or None where no ratio is above FLOOR, for every word of these texts."""
        if self.memo is None or len(self.memo) > REMEMBERED:
            self.memo = {}
        new = list(set().union(*split) - self.memo.keys())
        for w, cell in zip(new, self.cells(new), strict=True):
            self.memo[w] = cell if self.ratios.get(cell, [0.0])[-1] > FLOOR else None
        return self.memo

    def features(self, split: list[list[str]]) -> np.ndarray:
        known, out = self.known(split), []
        for s in split:
            held = Counter(map(known.__getitem__, s))
            held.pop(None, None)
            found = [r for c, n in held.items() if (r := self.ratios[c][bisect_right(TIMES, n) - 1]) > FLOOR]
            out.append(features(found, len(s)))
        return np.array(out)

    def score(self, split: list[list[str]]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.features(split) @ np.array(self.weights[:-1]) + self.weights[-1])))

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "ratios": self.ratios, "weights": self.weights, "memo": None}


def features(found: list[float], words: int) -> list[float]:
    top = sorted(set(found), reverse=True)[:3]
    top += [0.0] * (3 - len(top))
    return [*top, math.sqrt(sum(r - STRONG for r in found if r > STRONG)), math.log1p(words)]


def _grams(raw: bytes) -> set[bytes]:
    """The grams of a window, or the whole of a shorter one."""
    return {raw[i : i + GRAM] for i in range(max(1, len(raw) - GRAM + 1))}


def _marks(words: list[str]) -> Iterator[tuple[bytes, int]]:
    """(gram, times) of what a text holds at least so often."""
    held: Counter = Counter()
    for w, n in Counter(words).items():
        for g in _grams(_raw(w)):
            held[g] += n
    return ((g, k) for g, n in held.items() for k in MARK_TIMES if n >= k)


def fit_rows(toxic: list[str], ordinary: list[str], share: float) -> Model | None:
    """The model from sample texts; share: of the labelled rows that are toxic."""
    tox, ordy = [windows(t) for t in toxic], [windows(t) for t in ordinary]
    if not tox or not ordy or not any(tox) or not any(ordy):
        return None

    least = max(2, round(0.008 * len(tox)))
    a, b = Counter(), Counter()
    for d in tox:
        a.update(_marks(d))
    a = {m: n for m, n in a.items() if n >= least}
    for d in ordy:
        b.update(m for m in _marks(d) if m in a)
    marks = {g for (g, k), n in a.items() if math.log((n + 0.5) / len(tox)) - math.log((b[g, k] + 0.5) / len(ordy)) > 3.5}
    chosen = [_raw(w) for d in tox for w in d if any(g in marks for g in _grams(_raw(w)))]
    plain = [b" " + " ".join(d[i : i + 4]).encode("utf-8") + b" " for d in ordy for i in range(0, len(d), 4)]

    def trained(size: int, samples: list[bytes]) -> bytes:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few samples to train on: their bytes serve
            return (b"".join(samples) or b" " * 8)[:size].ljust(8)

    model = Model(trained(TOXIC_DICT, chosen), trained(ORDINARY_DICT, plain), {}, [])
    memo: dict[str, tuple[int, int, int]] = {}
    a, b = Counter(), Counter()
    for counts, docs in ((a, tox), (b, ordy)):
        for d in docs:
            new = [w for w in set(d) if w not in memo]
            memo.update(zip(new, model.cells(new), strict=True))
            counts.update((c, k) for c, n in Counter(memo[w] for w in d).items() for k in TIMES if n >= k)
    ratio = lambda c, k: math.log((a[c, k] + 0.5) / len(tox)) - math.log((b[c, k] + 0.5) / len(ordy))
    model.ratios = {c: np.maximum.accumulate([ratio(c, k) if a[c, k] or b[c, k] else 0.0 for k in TIMES]).tolist() for c in {c for c, _ in a.keys() | b.keys()}}
    x = model.features([*tox, *ordy])
    y = np.array([1.0] * len(tox) + [0.0] * len(ordy))
    weight = np.where(y == 1, share / len(tox), (1 - share) / len(ordy)) * len(y)
    mean, dev = x.mean(0), np.maximum(x.std(0), 0.05)
    z = np.c_[(x - mean) / dev, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w += np.linalg.solve(hess, z.T @ (weight * (y - p)) - 0.1 * w)
    model.weights = [*(w[:-1] / dev).tolist(), float(w[-1] - (w[:-1] * mean / dev).sum())]
    model.memo = None
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> Model | None:
    """Learns from labelled rows outside the held-out share."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("_ord"), (F.col(label_col) == 1).alias("_toxic"))
        .where(F.col("_toxic").isNotNull() & F.col("_ord").isNotNull() & ~held_out("_ord"))
        .groupBy("_ord").agg(F.max("_toxic").alias("_toxic"))
    )
    counts = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    if not counts.get(True) or not counts.get(False):
        return None
    texts = keyed(docs, id_col, text_col).where(F.octet_length("_text") <= MAX_SAMPLE_BYTES)
    # twice the bound of ids is drawn by hash, so that this side stays small at any size and is broadcast
    drawn = {k: F.broadcast(known.where(F.col("_toxic") == k).orderBy(F.xxhash64("_ord"), "_ord").limit(2 * most).select("_ord")) for k, most in ((True, max_toxic), (False, max_ordinary))}
    joined = {k: texts.join(ids, "_ord").select("_text", F.xxhash64("_ord", "_th").alias("_h")) for k, ids in drawn.items()}
    sample = {k: joined[k].orderBy("_h").limit(most).select(F.lit(k).alias("_toxic"), "_h", "_text") for k, most in ((True, max_toxic), (False, max_ordinary))}
    share = counts[True] / (counts[True] + counts[False])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[bool, list[tuple[int, str]]] = {True: [], False: []}
        for b in batches:
            for toxic, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                got[toxic].append((h, text.as_py()))
        toxic, ordinary = ([text for _, text in sorted(got[k])] for k in (True, False))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_rows(toxic, ordinary, share))], pa.binary())], ["_model"])

    made = sample[True].unionByName(sample[False]).coalesce(1).mapInArrow(run, "_model binary").collect()
    return pickle.loads(made[0]["_model"]) if made else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, score for every row."""
    rows = keyed(docs, id_col, text_col)
    if model is None:
        return rows.select("_ord", "_th", F.lit(0.0).alias("score"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, some in text_slices((t.as_py() for t in b.column(2)), SLICE_CHARS):
                got = model.score([windows(t) for t in some])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(some)), b.column(1).slice(first, len(some)), pa.array(got)], ["_ord", "_th", "score"])

    return rows.mapInArrow(run, "_ord long, _th long, score double")


def classify(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels, **columns), **{k: v for k, v in columns.items() if k in ("id_col", "text_col")})
    out = scored.withColumn("doc_id", doc_id_of())
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are scored as toxic; columns unchanged.  Scored in place: no join, each row carries its own columns."""
    model = fit(docs, labels)
    if model is None:
        return docs
    names, at = docs.columns, docs.columns.index("text")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (t.as_py() or "" for t in b.column(at))
            keep = [s < 0.5 for _, some in text_slices(texts, SLICE_CHARS) for s in model.score([windows(t) for t in some])]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema).select(*names)


def op5_toxicity_compression(spark, sf_dir: str) -> DataFrame:
    """Every document scored by a model of the labelled rows outside the held-out fifth.  Null text scores as empty; repeated rows get equal scores."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
