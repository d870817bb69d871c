"""Sinks that count once, the page stream that resumes, and the reader that splits one JSON object."""

import json
import random

import pytest
from pyspark.sql import functions as F

from medgraph.sources import commits, objects, sinks
from medgraph.streaming import pages


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_once(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i long, d string")
    assert rows(commits.read(spark, at, "i long, d string")) == []
    assert commits.append_once(df, at, "b1") and not commits.append_once(df, at, "b1")
    assert rows(commits.read(spark, at, "i long, d string")) == [(1, "a"), (2, "b")]

    # a writer that dies after its data and before its commit has written nothing
    real = commits._commit
    monkeypatch.setattr(commits, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        commits.append_once(df, at, "b2")
    monkeypatch.setattr(commits, "_commit", real)
    assert len(rows(commits.read(spark, at, "i long, d string"))) == 2
    assert commits.append_once(df, at, "b2") and len(rows(commits.read(spark, at, "i long, d string"))) == 4

    # two attempts that both looked before either committed: one counts
    monkeypatch.setattr(commits, "_exists", lambda spark, path: not path.endswith("/b3"))
    assert commits.append_once(df, at, "b3") and not commits.append_once(df, at, "b3")
    monkeypatch.undo()
    assert len(rows(commits.read(spark, at, "i long, d string"))) == 6
    assert commits.sweep(spark, at) == 2 and len(rows(commits.read(spark, at, "i long, d string"))) == 6
    with pytest.raises(ValueError):
        commits.append_once(df, at, "../x")


def test_sinks_with_batches(spark, tmp_path):
    df = spark.createDataFrame([(1, "drop"), (2, "active")], "i long, decision string")
    for sink, fmt, options in ((sinks.by_decision, "parquet", {}), (sinks.audit_log, "json", {}), (sinks.append, "csv", {"header": True})):
        at = f"{tmp_path}/{fmt}"
        for batch in ("1", "1", "2", "1"):  # retries write nothing twice
            sink(df, at, batch=batch)
        assert rows(commits.read(spark, at, "i long, decision string", fmt, **options)) == [(1, "drop"), (1, "drop"), (2, "active"), (2, "active")]
    assert commits.read(spark, f"{tmp_path}/parquet", "i long, decision string").where("decision = 'drop'").count() == 2
    for _ in range(2):
        sinks.rewrite_distinct(df.union(df), f"{tmp_path}/first", ["i"], [F.col("decision")], batch="v1")
    assert rows(commits.read(spark, f"{tmp_path}/first", "i long, decision string")) == [(1, "drop"), (2, "active")]


def test_pages_killed_and_resumed(spark, tmp_path, monkeypatch):
    """25 pages, records that repeat over pages; killed before and after a commit, then resumed, then more pages land."""
    src, target, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    (tmp_path / "in").mkdir()
    rng = random.Random(1)
    want = {}

    def land(numbers):
        for n in numbers:
            lines = [{"cert": f"c{rng.randint(0, 150)}", "page": n, "at": i} for i in range(10)]
            for x in lines:
                want.setdefault(x["cert"], (x["cert"], n, x["at"]))
            name = f"page-{n:03d}.jsonl" if n % 2 else f"page-{n}.jsonl"
            (tmp_path / "in" / name).write_text("\n".join([*map(json.dumps, lines), '{"cert": null}', "no json"]))

    land(range(1, 26))
    schema = "cert string, page long, at long"
    real, calls = commits.append_once, []

    def failing(df, path, batch, *a, **k):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("killed before the commit")
        done = real(df, path, batch, *a, **k)
        if len(calls) == 4:
            raise RuntimeError("killed after the commit, before the stream knew")
        return done

    monkeypatch.setattr(commits, "append_once", failing)
    for _ in range(2):
        q = pages.ingest_pages(spark, src, schema, target, check, "cert", pages=4)
        with pytest.raises(Exception, match="killed"):
            q.processAllAvailable()
        q.stop()
    monkeypatch.setattr(commits, "append_once", real)
    for more in ([], range(26, 31)):
        land(more)
        q = pages.ingest_pages(spark, src, schema, target, check, "cert", pages=4)
        q.processAllAvailable()
        q.stop()
        assert rows(commits.read(spark, target, schema)) == sorted(want.values())
    assert calls[1] == calls[2] == "page-8" and calls[3] == "page-12"
    assert len(commits.batches(spark, target)) == 9  # seven of the first 25 pages, two of the five after


@pytest.mark.parametrize("size", ["64", "1k"])
def test_object_in_pieces(spark, tmp_path, size):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice(["a", "{", "}", "[", "]", '"', "\\", ",", ":", "가", "\n", " "]) for _ in range(rng.randint(0, 12)))

    def value(depth=0):
        k = rng.random()
        if depth > 2 or k < 0.5:
            return text() if k < 0.4 else rng.choice([1, -2.5, None, True])
        return [value(depth + 1) for _ in range(rng.randint(0, 3))] if k < 0.75 else {text(): value(depth + 1) for _ in range(rng.randint(0, 3))}

    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for k, many in enumerate((0, 1, 300)):
            whole = {f"k{i}{text()}": value() for i in range(many)}
            (tmp_path / f"{k}.json").write_text("\n " * (k % 2) + json.dumps(whole, ensure_ascii=bool(k % 2), indent=[None, 2][k // 2]) + "\n")
            found = objects.entries(spark, f"{tmp_path}/{k}.json").collect()
            got = {}
            for r in found:
                got.update(json.loads("{" + r.entry + "}"))
            assert got == whole and len(found) == many
        master = {f"약{i}": {"records": [{"code": f"c{i}", "n": j} for j in range(i % 3)], "is_normalized": i % 2 == 0} for i in range(80)}
        (tmp_path / "m.json").write_text(json.dumps(master, ensure_ascii=False))
        got = objects.keyed_objects(spark, f"{tmp_path}/m.json", "code: string, n: int").collect()
        assert sorted((r.key, r.is_normalized, r.code, r.n) for r in got) == sorted((k, v["is_normalized"], x["code"], x["n"]) for k, v in master.items() for x in v["records"])
        assert objects._parts(spark, f"{tmp_path}/m.json").rdd.getNumPartitions() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
