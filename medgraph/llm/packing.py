"""Best-fit packing of tokenised documents into sequences, under several capacities at once.

Every piece has three demands: tokens, one document, and its attention cost (length squared).
A bin is a sequence with a residual of each.  Pieces are dealt to groups of a bounded token
count; inside a group they are placed in descending order, each into the open bin that still
holds it under every capacity and that scores best, by the weighted dot product of demand and
residual or by the norm of what would be left.  A bin is opened only when none holds the piece.

Null text is the empty text: one piece, the closing id.  Repeated rows are packed twice.  Ties
go to the bin opened first, pieces of equal size are taken by document id and piece.  Columns
other than the id and text are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PIECES_AND_ENDS, VOCABULARY, Remembered, Splitter, byte_letters
from .common import doc_id_of, keyed, materialize, released, table

SEQUENCE_TOKENS = 2048
#: Tokens of one packing group: some two thousand sequences, of which at most about one stays part empty.
GROUP_TOKENS = 4 << 20

#: Pieces in each of the two generations that a task remembers; bytes whose words are told apart at once, and what a row counts beside its text.
PIECES, SLICE_BYTES, ROW_BYTES = 100_000, 4 << 20, 64
#: Runs of ids that are put together at once.
RUNS = 1 << 16
#: A word that is one piece: letters that normalise alone, to one letter each.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

_loaded: dict[str, tuple[Splitter, Remembered]] = {}


def _library(path: str) -> tuple[Splitter, Remembered]:
    """Pieces of words to packed little-endian ids, by the tokenizers library, remembered in the worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        model, tokenize, suffix = Splitter(path), tok.model.tokenize, tok.model.end_of_word_suffix
        letters = np.array([ord(c) for c in byte_letters()], "<u2")
        letters[ord("\n")] = ord("\n")  # in no piece: it stands between them
        closing = np.array([bool(suffix) and tok.id_to_token(i).endswith(suffix) for i in range(tok.get_vocab_size(False))])
        fixed = {t: i.to_bytes(4, "little") for t, i in model.special.items()} | {"\n": b""}

        def piece_ids(pieces: list[str]) -> list[bytes]:
            """The library's model on pieces: its normaliser and splitter are slow on single words."""
            plain = [p for p in pieces if p not in fixed]
            spelled = letters[np.frombuffer("\n".join(plain).encode("utf-8"), np.uint8)].tobytes().decode("utf-16-le").split("\n") if plain else []
            ids = np.array([t.id for p in spelled for t in tokenize(p)], "<u4")
            ends = (np.flatnonzero(closing[ids]) + 1).tolist()
            if len(ends) == len(plain):  # a piece has one closing token, its last
                raw = ids.tobytes()
                rows = [raw[4 * i : 4 * j] for i, j in zip([0, *ends[:-1]], ends, strict=len(ends) > 0)]
            else:
                rows = [np.array([t.id for t in tokenize(p)], "<u4").tobytes() for p in spelled]
            if len(plain) == len(pieces):
                return rows
            rest = iter(rows)
            return [fixed[p] if p in fixed else next(rest) for p in pieces]

        _loaded[path] = model, Remembered(piece_ids, lambda raw: raw, PIECES)
    model, memory = _loaded[path]
    memory.clear()  # the memory is a task's: a reused worker would keep it for the stages after
    return model, memory


def byte_slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Consecutive rows, of several batches if these are small, until they hold `most` bytes."""
    held, size = [], 0
    for b in batches:
        upto, at = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False) + np.int64(ROW_BYTES)), 0
        while at < len(upto):
            before = int(upto[at - 1]) if at else 0
            end = min(len(upto), int(np.searchsorted(upto, before + most - size)) + 1)
            held.append(b.slice(at, end - at))
            size += int(upto[end - 1]) - before
            at = end
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def runs_of(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of `flat` with these starts and lengths, one after another."""
    out, at = np.empty(int(count.sum()), flat.dtype), 0
    for i in range(0, len(start), RUNS):
        n = count[i : i + RUNS]
        upto = np.cumsum(n)
        m = int(upto[-1])
        out[at : at + m] = flat[np.arange(m) + np.repeat(start[i : i + RUNS] - upto + n, n)]
        at += m
    return out


def lines(words: pa.Array) -> str:
    """The words, each followed by a line end."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py() + "\n" if len(words) else ""


def token_ids(texts: pa.Array, end_id: int, model: Splitter, memory: Remembered) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one array, each text's followed by end_id, and where each text ends.

    Distinct words are split, their distinct pieces get ids; words and texts are put together from
    runs of ids.  No piece or special token spans white space.
    """
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary
    # most words are one piece; a word with a special token or a capital sigma is split on its own
    plain = pc.match_substring_regex(distinct, LETTERS)
    alone = pc.or_(pc.match_substring(distinct, "<|"), pc.match_substring(distinct, "Σ"))
    rest = pc.invert(pc.or_(plain, alone))
    split = model.normal(lines(distinct.filter(plain))).split("\n")[:-1]
    n_plain = len(split)
    split += PIECES_AND_ENDS.findall(model.normal(lines(distinct.filter(rest))))
    for w in distinct.filter(alone).to_pylist():
        split += [*model.pieces(w), "\n"]
    spelled = pa.array(split, pa.string()).dictionary_encode()
    del split
    names = spelled.dictionary.to_pylist()
    known = memory.learn([names])
    raw = list(map(known.__getitem__, names))
    count = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    which = spelled.indices.to_numpy()
    n = count[which]
    closes = which == (names.index("\n") if "\n" in names else -1)
    closes[:n_plain] = True
    upto = np.cumsum(n)[closes]
    flat = runs_of(np.frombuffer(b"".join(raw), "<u4"), (np.cumsum(count) - count)[which], n)

    order = np.concatenate([np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (plain, rest, alone)])
    size = np.diff(upto, prepend=0)
    count, start = np.ones(len(order) + 1, np.int64), np.full(len(order) + 1, len(flat))  # the last one: the end
    count[order], start[order] = size, upto - size
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    which = np.insert(coded.indices.to_numpy(), ends, len(order))
    n = count[which]
    ids = runs_of(np.append(flat, np.array([end_id], "<u4")), start[which], n)
    return ids, np.cumsum(n)[ends + np.arange(len(ends))]


def pieces(df: DataFrame, max_tokens: int = SEQUENCE_TOKENS, end_id: int = 0, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece: _ord, _row (tells repeated rows apart), piece, start, length, ids_crc32.  Smaller slices take less memory and more time."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    names = ["_ord", "_row", "piece", "start", "length", "ids_crc32"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memory = _library(path)
        row = 0
        for some in byte_slices(batches, slice_bytes):
            ids, ends = token_ids(some.column(1).combine_chunks(), end_id, model, memory)
            size = np.diff(ends, prepend=0)
            parts = -(-size // max_tokens)
            doc = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * max_tokens
            length = np.minimum(size[doc] - start, max_tokens)
            at = (ends - size)[doc] + start
            crc = [zlib.crc32(ids[i : i + n]) for i, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [some.column(0).to_numpy()[doc], row + doc, piece, start, length, crc]
            row += len(size)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        _library(path)

    return keyed(df, id_col, text_col).select("_ord", "_text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def best_fit(lengths: np.ndarray, tokens: int, documents: int, cost: int, weights: tuple[float, float, float], score: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the order given."""
    capacity = np.array([tokens, documents, cost], float)
    scale = np.asarray(weights, float) / capacity
    n = len(lengths)
    left = np.empty((3, n))
    bins, offsets, used = np.empty(n, np.int64), np.empty(n, np.int64), 0
    for i, size in enumerate(lengths):
        need = np.array([size, 1.0, float(size) * size])
        open_ = left[:, :used]
        fits = np.flatnonzero((open_[0] >= need[0]) & (open_[1] >= need[1]) & (open_[2] >= need[2]))
        if len(fits):
            rest = open_[:, fits]
            if score == "dot":
                by = ((need * scale)[:, None] * (rest * scale[:, None])).sum(0)
            else:
                by = (((rest - need[:, None]) * scale[:, None]) ** 2).sum(0)
            at = fits[int(by.argmin())]
        else:
            at = used
            left[:, at] = capacity
            used += 1
        bins[i], offsets[i] = at, tokens - int(left[0, at])
        left[:, at] -= need
    return bins, offsets


def pack(
    parts: DataFrame,
    max_tokens: int = SEQUENCE_TOKENS,
    max_documents: int = SEQUENCE_TOKENS,
    max_cost: int = SEQUENCE_TOKENS**2,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    score: str = "residual",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """parts with sequence_id and offset.  `parts` is read twice: pass a written table.

    score: "residual" takes the bin with the smallest weighted norm of what is left after
    placing, "dot" the one with the smallest weighted dot product of demand and residual.
    Raises ValueError for a piece that no empty bin can hold.
    """
    worst = parts.agg(F.sum("length").alias("n"), F.max("length").alias("m")).first()
    if worst["m"] and (worst["m"] > max_tokens or worst["m"] ** 2 > max_cost or max_documents < 1):
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    groups = max(1, -(-(worst["n"] or 0) // group_tokens))

    @released
    def run(group: pa.Table) -> pa.Table:
        length, ords, rows, piece = (group.column(c).to_numpy() for c in ("length", "_ord", "_row", "piece"))
        by = np.lexsort((piece, rows, ords, -length))
        group, length = group.take(pa.array(by)), length[by]
        whole = int((length == max_tokens).sum())  # these come first and fill a sequence each
        bins, offsets = best_fit(length[whole:], max_tokens, max_documents, max_cost, weights, score)
        seq = np.concatenate([np.arange(whole), whole + bins]) + (int(group.column("_group")[0].as_py()) << 32)
        return group.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(np.concatenate([np.zeros(whole, np.int64), offsets])))

    keyed_parts = parts.withColumn("_group", F.pmod(F.xxhash64("_ord", "_row", "piece"), F.lit(groups)))
    schema = ", ".join(f"{c} long" for c in [*keyed_parts.columns, "sequence_id", "offset"])
    return keyed_parts.groupBy("_group").applyInArrow(run, schema).drop("_group")


def pack_documents(df: DataFrame, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    token_options = {k: options.pop(k) for k in ("vocabulary", "id_col", "text_col", "end_id", "slice_bytes") if k in options}
    parts = materialize(pieces(df, options.get("max_tokens", SEQUENCE_TOKENS), **token_options))
    return pack(parts, **options).select(doc_id_of().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place.  Null text is empty: one piece, the end id alone; repeated rows are packed each."""
    return pack_documents(table(spark, sf_dir, "documents"))
