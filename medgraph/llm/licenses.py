"""License scan: sparse TF-IDF cosine of blocks to license texts, headers and notices, then inheritance from the nearest directory.

Blocks are the whole text and every run of consecutive lines that is one line or has at most
twice the words of the template it is compared with, so a notice may be wrapped and stand anywhere.
Words are runs of letters, digits and . + - in lower case, without dots and dashes at their ends;
so comment signs at the start of a line are no words, and dnl and rem there are taken off.  The
weight of a word in a block is its count times ln((1 + N) / (1 + df)) + 1 over all N rows, where
df is the number of rows that hold it.  A block carries a template's license if their cosine is
at least `threshold`; the best block decides, ties go to the first block (whole text before
lines) and the license that comes first by name.  "All rights reserved" stands above the grant in
many license files, so it counts only where a text carries no other license.

A file is a licence file if its name says so or its whole text carries a license; a header or
notice in a file licenses that file alone.  A licence file's directory has its license (the best
cosine, then the smallest path).  A file without a license of its own takes the one of its nearest ancestor
directory that has one.

Only texts that can reach the threshold are scored: a block's cosine is at most the norm of the
template's words that the text holds, over the template's norm.  The frequencies of all words are
a table; those of template words and of words in at least one row of COMMON are on the driver,
the scored texts are joined with the rest.  Null and empty texts carry no license but can
inherit; a null path is in no directory and inherits nothing.  Repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MAX_LONG, doc_id_of, keyed, materialize, table

#: Notices of common licenses, as published with them, by SPDX-like name.
TEMPLATES = {
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_LATER = "as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
_GNU = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} General Public License {2} This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} General Public License for more details."
_ALONG = " You should have received a copy of the GNU {} General Public License along with this {}. If not, see <https://www.gnu.org/licenses/>."


def _gnu(what: str, kind: str, version: str) -> tuple[str, str]:
    """The standard header of a GNU license, with and without its last paragraph."""
    short = _GNU.format(what, kind, _LATER.format(version))
    return short, short + _ALONG.format(kind, what)


#: The standard file headers of common licenses.
HEADERS = {
    "AGPL-3.0": _gnu("program", "Affero", "3"),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "GPL-2.0": _gnu("program", "", "2"),
    "GPL-3.0": _gnu("program", "", "3"),
    "LGPL-2.1": _gnu("library", "Lesser", "2.1"),
    "LGPL-3.0": _gnu("library", "Lesser", "3"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
}


def all_templates() -> dict[str, tuple[str, ...]]:
    """Notices, headers and the full texts in license_texts, by license."""
    out: dict[str, tuple[str, ...]] = {k: (v,) for k, v in TEMPLATES.items()}
    for k, v in HEADERS.items():
        out[k] = (*out.get(k, ()), *v)
    for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        out[f.stem] = (*out.get(f.stem, ()), f.read_text(encoding="utf-8"))
    return out


#: A reservation of rights is no license where one is granted.
RESERVED = "All-Rights-Reserved"
#: A word is common if at least one row of so many holds it.
COMMON = 200
#: Names of licence files.
LICENSE_FILES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"
THRESHOLD = 0.8


_WORD = re.compile(r"[^\W_][\w.+-]*")


def words(text: str) -> list[str]:
    """Words of a text in order, lower-cased, without dots and dashes at their ends."""
    return [w.rstrip(".-") for w in _WORD.findall(text.lower())]


_PREFIX = re.compile(r"^\s*(?:dnl|rem)\b", re.I)


def line_words(text: str) -> list[list[str]]:
    """Words of every line, without comment prefixes."""
    return [words(_PREFIX.sub("", x)) for x in text.split("\n")]


def idf(rows: int, holding: int) -> float:
    return math.log((1 + rows) / (1 + holding)) + 1


class Scorer:
    """Templates with the word weights of a table."""

    def __init__(self, templates: dict[str, str | tuple[str, ...]], rows: int, holding: dict[str, int], threshold: float):
        self.threshold, self.rows = threshold, rows
        self.forms = [(name, Counter(words(x))) for name, v in sorted(templates.items()) for x in ((v,) if isinstance(v, str) else v)]
        vocabulary = {w for _, c in self.forms for w in c}
        self.known = {w: idf(rows, n) for w, n in holding.items()} | {w: idf(rows, holding.get(w, 0)) for w in vocabulary}
        self.norms = [math.sqrt(sum((k * self.known[w]) ** 2 for w, k in c.items())) for _, c in self.forms]
        self.mass: dict[str, list[tuple[int, float]]] = {}
        for i, (_, c) in enumerate(self.forms):
            for w, k in c.items():
                self.mass.setdefault(w, []).append((i, (k * self.known[w]) ** 2))

    def reachable(self, held: set[str]) -> list[int]:
        """Templates that a text of these words can reach."""
        got: dict[int, float] = {}
        for w in held & self.mass.keys():
            for i, m in self.mass[w]:
                got[i] = got.get(i, 0.0) + m
        return [i for i in sorted(got) if got[i] >= (self.threshold * self.norms[i]) ** 2 - 1e-9]

    def _starts(self, split: list[list[str]], form: int) -> Iterator[tuple[int, int]]:
        """(first line, end of the longest run) where the run holds enough of the template's words."""
        count, limit = self.forms[form][1], 2 * sum(self.forms[form][1].values())
        inside: Counter = Counter()
        mass, size, end = 0.0, 0, 0
        least = (self.threshold * self.norms[form]) ** 2 - 1e-6
        for at, line in enumerate(split):
            while end < len(split) and (end <= at or size + len(split[end]) <= limit):
                for w in split[end]:
                    if w in count:
                        mass += (count[w] * self.known[w]) ** 2 if not inside[w] else 0.0
                        inside[w] += 1
                size += len(split[end])
                end += 1
            if mass >= least and any(w in count for w in line):
                yield at, end
            for w in line:
                if w in count:
                    inside[w] -= 1
                    mass -= (count[w] * self.known[w]) ** 2 if not inside[w] else 0.0
            size -= len(line)

    def text(self, text: str, rare: dict[str, int]) -> tuple | None:
        """(block, license, cosine, license and cosine of the whole text) of a text, or None; rare: rows that hold its words outside `known`.

        The square of a run's norm is a sum over its words of weight squared times (1 + twice the
        earlier places of the word in the run), so one cumulative sum from a start line gives all of its runs, for
        all templates; products with a template are differences of sums over the text.
        """
        split = line_words(text)
        weight = {w: self.known[w] if w in self.known else idf(self.rows, rare.get(w, 0)) for s in split for w in s}
        number = {w: i for i, w in enumerate(weight)}
        flat = [w for s in split for w in s]
        which = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        square = np.fromiter(weight.values(), np.float64, len(weight)) ** 2
        first = np.cumsum([0, *map(len, split)])  # where each line begins
        whole = Counter(flat)
        total = math.sqrt(sum((k * weight[w]) ** 2 for w, k in whole.items()))
        order = np.argsort(which, kind="stable")
        begins = np.searchsorted(which[order], np.arange(len(weight)))
        rank = np.empty(len(flat), np.int64)
        rank[order] = np.arange(len(flat)) - begins[which[order]]
        each = square[which]
        best = whole_text = None

        def offer(cosine: float, block: int, name: str) -> None:
            nonlocal best, whole_text
            cosine = round(float(cosine), 9)
            if cosine < self.threshold:
                return
            got = (name != RESERVED, cosine, -block, name)
            best = got if best is None or got[:3] > best[:3] else best
            if block == 0:
                whole_text = got if whole_text is None or got[:3] > whole_text[:3] else whole_text

        runs: dict[int, list[tuple[int, int]]] = {}
        shared: dict[int, np.ndarray] = {}
        for form in self.reachable(set(whole)):
            name, count = self.forms[form]
            offer(sum(k * whole[w] * weight[w] ** 2 for w, k in count.items() if w in whole) / (total * self.norms[form]), 0, name)
            times = np.fromiter((count.get(w, 0) for w in weight), np.float64, len(weight))
            shared[form] = np.concatenate([[0.0], np.cumsum((times * square)[which])])
            for at, end in self._starts(split, form):
                runs.setdefault(at, []).append((form, end))
        before, upto = np.zeros(len(weight), np.int64), 0  # places of each word before the start line
        for at in sorted(runs):
            a = int(first[at])
            np.add.at(before, which[upto:a], 1)
            upto = a
            b = int(first[max(end for _, end in runs[at])])
            norm = np.sqrt(np.cumsum(each[a:b] * (1 + 2 * (rank[a:b] - before[which[a:b]]))))
            for form, end in runs[at]:
                ends = first[at + 1 : end + 1]
                ends = ends[ends > a]
                if len(ends):
                    offer(((shared[form][ends] - shared[form][a]) / norm[ends - a - 1]).max() / self.norms[form], at + 1, self.forms[form][0])
        return best and (-best[2], best[3], best[1], whole_text and whole_text[3], whole_text and whole_text[1])


def row_counts(rows: DataFrame) -> DataFrame:
    """w, n: the rows that hold each word, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                got: Counter = Counter()
                for text in b.column(0).slice(at, 2000).to_pylist():
                    got.update({w for s in line_words(text) for w in s})
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], ["w", "n"])

    return rows.select("_text").mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def notices(df: DataFrame, templates: dict[str, str | tuple[str, ...]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, _th, block (0: whole text, then the first line of a run from 1), license, cosine of every text that carries a license, and what its whole text carries (whole_license, whole_cosine)."""
    templates = templates or all_templates()
    rows = keyed(df, id_col, text_col)
    counts = materialize(row_counts(rows))
    vocabulary = {w for v in templates.values() for x in ((v,) if isinstance(v, str) else v) for w in words(x)}
    total = rows.count()
    held = counts.where(F.col("w").isin(sorted(vocabulary)) | (F.col("n") >= max(16, total // COMMON)))
    scorer = Scorer(templates, total, {r["w"]: r["n"] for r in held.collect()}, threshold)
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [bool(shared.value.reachable({w for s in line_words(t) for w in s})) for t in b.column(2).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    scored = materialize(rows.mapInArrow(reaching, "_ord long, _th long, _text string").dropDuplicates(["_ord", "_th"]))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(o, t, w) for o, t, text in zip(*(c.to_pylist() for c in b.columns), strict=True) for w in {w for s in line_words(text) for w in s} - shared.value.known.keys()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.string()], strict=True)], ["_ord", "_th", "w"])

    rare = scored.mapInArrow(others, "_ord long, _th long, w string").join(counts, "w").groupBy("_ord", "_th").agg(F.collect_list(F.struct("w", "n")).alias("_rare"))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.float64()]
    names = ["_ord", "_th", "block", "license", "cosine", "whole_license", "whole_cosine"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(o, t, *got) for o, t, text, r in zip(*(c.to_pylist() for c in b.columns), strict=True) if (got := shared.value.text(text, {x["w"]: x["n"] for x in r or ()}))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    both = scored.join(rare, ["_ord", "_th"], "left").select("_ord", "_th", "_text", "_rare")
    return both.mapInArrow(run, "_ord long, _th long, block int, license string, cosine double, whole_license string, whole_cosine double")


def scan(df: DataFrame, path: Column, templates: dict[str, str | tuple[str, ...]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ord, path, license, cosine, origin ("own", "inherited" or null), license_path, distance (directories up)."""
    found = materialize(notices(df, templates, threshold, id_col, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    files = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)).alias("_ord"), F.xxhash64(text).alias("_th"), path.alias("path")).join(found, ["_ord", "_th"], "left")
    parts = F.split("path", "/")
    files = files.withColumn("_dir", F.when(F.col("path").isNotNull(), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))).withColumn("_name", F.element_at(parts, -1))
    files = materialize(files)
    named = F.col("_name").rlike(LICENSE_FILES)
    giving = files.where(F.col("_dir").isNotNull()).withColumn("_l", F.when(named, F.col("license")).otherwise(F.col("whole_license"))).withColumn("_c", F.when(named, F.col("cosine")).otherwise(F.col("whole_cosine"))).where("_l is not null")
    by_dir = giving.groupBy("_dir").agg(F.min(F.struct((-F.col("_c")).alias("c"), "path", F.col("_l").alias("l"))).alias("_g"))

    # every directory meets its ancestors once; files join the directories' answers
    dirs = files.where("_dir is not null").select("_dir").distinct()
    pieces = F.split("_dir", "/")
    up = dirs.select("_dir", F.explode(F.sequence(F.lit(0), F.size(pieces))).alias("up")).withColumn("_above", F.array_join(F.slice(pieces, 1, F.size(pieces) - F.col("up")), "/"))
    near = up.join(by_dir.withColumnRenamed("_dir", "_above"), "_above").groupBy("_dir").agg(F.min(F.struct("up", "_g")).alias("_n"))
    joined = files.join(near, "_dir", "left")
    own = F.col("license").isNotNull()
    given = F.col("_n").isNotNull()
    return joined.select(
        "_ord", "path",
        F.when(own, F.col("license")).otherwise(F.col("_n._g.l")).alias("license"),
        F.when(own, F.col("cosine")).otherwise(-F.col("_n._g.c")).alias("cosine"),
        F.when(own, "own").when(given, "inherited").alias("origin"),
        F.when(own, F.col("path")).otherwise(F.col("_n._g.path")).alias("license_path"),
        F.when(own, 0).otherwise(F.col("_n.up") + 1).cast("int").alias("distance"),
    )


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """documents as a tree of files: source / language / hundred of the id / id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return scan(docs, path).select(doc_id_of().alias("doc_id"), "path", "license", F.round("cosine", 6).alias("cosine"), "origin", "license_path", "distance")
