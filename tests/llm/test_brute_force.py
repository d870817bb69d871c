"""Further brute force: line chunks by a chunker of the test's own, the wrap of neighbours, suffixes at the production length, recall above the sample."""

import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import tokenizers
from pyspark.sql import functions as F

from medgraph.llm import ann, bpe, fingerprint, licenses, lines, packing, substrings, suffixes


def own_chunks(rows):
    """(first, lines) by the definition: a chunk ends, from two lines on, where the hash of the last two lines has an even 18th bit, or after sixteen."""
    h = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little") for x in rows]
    ends = [((h[i - 1] * 0x9E3779B97F4A7C15 if i else 0) + h[i]) % 2**64 // 2**17 % 2 == 0 for i in range(len(rows))]
    out, begin = [], 0
    for i, end in enumerate(ends):
        if i + 1 - begin >= 2 and (end or i + 1 - begin == 16):
            out.append((begin, i + 1 - begin))
            begin = i + 1
    return out + [(begin, len(rows) - begin)] * (begin < len(rows))


def test_line_chunks_by_definition(spark):
    rng = random.Random(9)
    usual = [f"line {i}" for i in range(30)] + ["", " "]
    passage = [f"passage {i}" for i in range(12)]
    texts = []
    for i in range(80):
        t = [rng.choice(usual) if rng.random() < 0.5 else f"own {i} {k}" for k in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(t))
            t[at:at] = passage
        texts.append((i, "\n".join(t)))
    texts += [(90, None), (91, ""), (92, "\n" * 50), (93, texts[0][1])]
    first, want = {}, {}
    for i, t in texts:
        rows = t.encode().split(b"\n") if t else []
        assert own_chunks(rows) == lines.chunks(rows)
        gone = []
        for at, n in own_chunks(rows):
            body = b"\n".join(rows[at : at + n])
            if n >= 2 and body.strip() and first.setdefault(body, (i, at)) != (i, at):
                gone += range(at, at + n)
        want[i] = (len(rows), len(gone))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert {r._ord: (r.n_lines, r.n_removed) for r in lines.dedup(df).collect()} == want
    assert sum(n for _, n in want.values()) > 100


def test_neighbours_wrap(spark):
    """Every document with the next smaller id, the last with the first; likeness from the packed bits themselves."""
    rng = random.Random(2)
    texts = {i * 3: " ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(rng.randint(6, 60))) for i in range(40)}
    texts |= {7: None, 8: "", 500: "é가 " * 9}
    ids = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fingerprint.compare_with_next(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)).collect()}

    def like(a, b):
        same = sum(x == y for x, y in zip(a, b)) / len(a)
        return min(1.0, max(0.0, (same - 1 / 16) / (15 / 16)))

    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, x, r = texts[i] or "", texts[after] or "", got[i]
        edited = t[: len(t) - len(t) // 2] + x[: len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if t.split() and x.split():
            assert abs(r.near_next - like(r.fingerprint, got[after].fingerprint)) < 1e-9
        if t.split() and edited.split():
            assert abs(r.near_edited - like(r.fingerprint, r.edited_fingerprint)) < 1e-9


def test_suffixes_at_production_length(spark):
    """400 bytes: passages of 399, 400 and 700, overlapping, twice in one text, and a run of one byte."""
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghij klmn é") for _ in range(n))
    p399, p400, p700 = text(1200).encode()[:399].decode(errors="ignore"), "x" + text(450), text(700)
    docs = [text(rng.randint(0, 900)) for _ in range(12)]
    docs += [text(200) + p399 + text(50), p399 + "!", text(30) + p400, p400 + text(10), p700 + text(5) + p700[100:650], "q" * 1500, p700[:500] + "é", "", docs[0]]
    raw = [d.encode() for d in docs]
    count = Counter(d[j : j + 400] for d in raw for j in range(len(d) - 399))
    want = {}
    for i, d in enumerate(raw):
        gone = np.zeros(len(d), bool)
        for j in range(len(d) - 399):
            if count[d[j : j + 400]] > 1:
                gone[j : j + 400] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        want[i] = (len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    got = suffixes.dedup(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)).collect()
    assert {r._ord: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_recall_above_the_sample(spark, tmp_path):
    """20,000 vectors without clusters, more than the index is fitted on; clashing columns."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20_000, 24)).astype(np.float32)
    assert len(x) > ann.SAMPLE
    df = spark.createDataFrame([(i, v, "c", "c", 1.0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, _id string, _v string, score double")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in ann.op1_adaptive_dimension_scan(spark, str(tmp_path)).where(F.col("query_id") % 400 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    d = x.astype(np.float64)
    hits = 0
    for q, found in got.items():
        score = d @ d[q]
        score[q] = -np.inf
        hits += len(found & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert len(got) == 50 and hits / (20 * len(got)) >= 0.9


def test_licence_scan_with_clashing_columns(spark):
    rows = [(1, "Released under the MIT License.", "src/LICENSE", "x", "y", 0.5), (2, "code", "src/a/b.c", "x", "y", 0.5), (3, None, None, "x", "y", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string, license string, _dir string, cosine double")
    got = {r._ord: (r.license, r.origin) for r in licenses.scan(df, F.col("path")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: (None, None)}


def test_pieces_of_new_words_are_remembered(monkeypatch):
    """Ids of odd words against the tokenizers library, with memories that overflow; a piece that a worker knows is not encoded again."""
    path = public_tokenizers.path(bpe.VOCABULARY)
    lib = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(3)
    made = lambda: "".join(rng.choice("aaabe'sS.,!1²é가\0ΣİŁ😀́") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", "<|endoftext|>", "<|"])
    words = [made() for _ in range(3000)] + ["", "a" * 40, "Σ", "<|endoftext|>"]
    model = bpe.PairIndexBPE(path)
    took: list[str] = []
    index = model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda ws: took.extend(ws) or index(ws))
    monkeypatch.setattr(bpe, "PairIndexBPE", lambda _: model)
    monkeypatch.setattr(bpe, "_loaded", {})
    _, memory = bpe.loaded(path, "ids", lambda model, ids: ids, lambda parts: [i for x in parts for i in x])
    for some in (words, words[:50], ["ab!", "ab?", "x"], ["?ab", "!x", "ab"]):
        took.clear()
        known = memory.learn([some])
        assert [known[w] for w in some] == [lib.encode(w, add_special_tokens=False).ids for w in some]
    assert not {"ab", "?", "!", "x"} & set(took)
    memory.most = 100
    for at in range(0, len(words), 60):
        some = words[at : at + 60]
        known = memory.learn([some])
        assert [known[w] for w in some] == [lib.encode(w, add_special_tokens=False).ids for w in some]


def odd_texts(n=400):
    """Texts of odd words and white space, some long, with control characters, special tokens and letters that normalise to others."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aaabÀÿßµ'sS.,!1²é가\0\x01\x1c\x7fΣİŁ😀\u0301\u1e9b") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", "", "<|endoftext|>", "<|"])
    usual = [word() for _ in range(500)] + ["ab", "Éa", "a" * 40, "Σ", "<|startoftext|>"]
    space = [" ", " ", "\n", "\r\n", "\t ", "\x0b", "\x1d", "\x85", "\xa0", "\u2028", "\u3000"]
    return ["".join(rng.choice(usual) + rng.choice(space) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(n)] + ["", " ", "\n\x01", "x" * 9000, "1" * 5000]


def test_packed_ids_are_the_librarys(spark):
    """Through Spark, and by slices that hold parts of batches or several, with a memory that overflows; only distinct pieces are looked up."""
    texts = odd_texts()
    path = public_tokenizers.path(bpe.VOCABULARY)
    lib = tokenizers.Tokenizer.from_file(path)
    want = [[*lib.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    parts = {(i, k): (at, len(x[at : at + 2048]), zlib.crc32(np.array(x[at : at + 2048], "<u4").tobytes())) for i, x in enumerate(want) for k, at in enumerate(range(0, len(x), 2048))}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packing.pack_documents(df).collect()} == parts
    batches = pa.table({"i": pa.array(range(len(texts)), pa.int64()), "t": pa.array(texts, pa.string())}).to_batches(max_chunksize=30)
    for most, held in ((1, 100), (3000, 100), (1 << 20, 100_000)):
        model, memory = packing._library(path)
        memory.most, before = held, memory.most
        looked_up, learn = [], memory.learn
        memory.learn = lambda some, learn=learn, looked_up=looked_up: looked_up.extend(p for s in some for p in s) or learn(some)
        got, order = [], []
        for some in packing.byte_slices(iter(batches), most):
            ids, ends = packing.token_ids(some.column(1).combine_chunks(), 0, model, memory)
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
            order += some.column(0).to_pylist()
        memory.most = before
        del memory.learn
        assert got == want and order == list(range(len(texts)))
    assert len(looked_up) == len(set(looked_up))


def test_small_batches_lower_the_sessions_setting_only(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, want in (("10000", "1000"), ("0", "1000"), ("-1", "1000"), ("64", "64")):
            spark.conf.set(key, given)
            corpus_pipeline.pack_sequences(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "")
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


def shuffled(spark, make):
    """(rows, bytes that the stages of making them write to shuffles)."""
    sc = spark.sparkContext

    def stages():
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {x.stageId(): x.shuffleWriteBytes() for x in (found.apply(i) for i in range(found.size()))}

    before = max(stages(), default=-1)
    rows = make().collect()
    return rows, sum(n for i, n in stages().items() if i > before)


def test_only_repeated_windows_are_shuffled(spark):
    """Texts of which a few words repeat: what is sent is less than the texts, for few buckets and many, and the texts are shuffled once."""
    rng = random.Random(8)
    passages = [" ".join(f"{rng.getrandbits(30):x}" for _ in range(n)) for n in (12, 13, 14, 40)]
    docs = [" ".join(f"{rng.getrandbits(30):x}" for _ in range(200)) for _ in range(400)]
    for i in range(0, 400, 9):
        docs[i] += "\t" + passages[i % 4] + " " + docs[(i * 7) % 400][:300]
    size = sum(map(len, docs))
    first, starts = {}, {}
    for i, d in enumerate(docs):
        w = d.split()
        starts[i] = [tuple(w[j : j + 13]) for j in range(len(w) - 12)]
        for g in starts[i]:
            first.setdefault(g, i)
    want = {(i, j) for i, gs in starts.items() for j, g in enumerate(gs) if first[g] < i}
    df = spark.createDataFrame([(i, d, len(d)) for i, d in enumerate(docs)], "doc_id long, text string, n_chars long").repartition(2).localCheckpoint()
    sent = []
    for bucket_bytes in (size, size // 400):
        rows, n = shuffled(spark, lambda b=bucket_bytes: substrings.repeated_windows(df, bucket_bytes=b))
        assert {(r._ord, r._at + k) for r in rows for k in range(r._n)} == want and len(want) > 500
        sent.append(n)
    assert max(sent) < 1.3 * size and sent[1] < 1.3 * sent[0]
    rows, n = shuffled(spark, lambda: substrings.strip_repeats(df))
    assert len(rows) == 400 and n < 1.3 * size


def test_bytes_of_repeated_chunks_only(spark):
    """Chunks that do not repeat leave their bytes where they are: the texts are shuffled twice, compressed."""
    rng = random.Random(9)
    line = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(70))
    block = "\n".join(line() for _ in range(12))
    docs = ["\n".join([line() for _ in range(25)] + ([block] if i % 40 == 0 else [])) for i in range(400)]
    df = spark.createDataFrame([(i, d, len(d)) for i, d in enumerate(docs)], "doc_id long, text string, n_chars long").repartition(2).localCheckpoint()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows, n = shuffled(spark, lambda: lines.strip_repeats(df))
        found = lines.repeated_chunks(df).collect()
    finally:
        spark.conf.set(key, before)
    left = {r.doc_id: r.text for r in rows}
    assert len(left) == 400 and left[0] == docs[0] and all(len(left[i]) < len(docs[i]) for i in range(40, 400, 40))
    assert all(left[i] == d for i, d in enumerate(docs) if i % 40) and {r._ord for r in found} == set(range(40, 400, 40))
    assert n < 1.6 * sum(map(len, docs))
