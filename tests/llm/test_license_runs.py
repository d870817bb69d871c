"""Licence runs: the best cosine over all runs of lines, against one computed for every run on its own."""

import math
import random
import time
from collections import Counter

from medgraph.llm import licenses as L


def best_run(scorer, text, rare):
    """The best of (license granted, cosine, earliest block) over the whole text and all runs."""
    split = L.line_words(text)
    weight = lambda w: scorer.known.get(w) or L.idf(scorer.rows, rare.get(w, 0))
    found = []
    for name, count in scorer.forms:
        norm = math.sqrt(sum((k * weight(w)) ** 2 for w, k in count.items()))
        limit = 2 * sum(count.values())

        def cosine(lines):
            c = Counter(w for x in lines for w in x)
            size = math.sqrt(sum((k * weight(w)) ** 2 for w, k in c.items()))
            return round(sum(k * count[w] * weight(w) ** 2 for w, k in c.items()) / size / norm, 9) if size else 0.0  # noqa: B023

        found.append((cosine(split), 0, name))
        for a in range(len(split)):
            for b in range(a + 1, len(split) + 1):
                if b > a + 1 and sum(map(len, split[a:b])) > limit:
                    break
                found.append((cosine(split[a:b]), a + 1, name))
    found = [(n != L.RESERVED, c, -b, n) for c, b, n in found if c >= scorer.threshold]
    return max(found, key=lambda x: x[:3], default=None)


def test_runs_against_all_runs():
    rng = random.Random(6)
    words = "the license of free software you may copy without any warranty granted all rights reserved use it as is".split()
    templates = {"A": ("free software license", "you may copy it without any warranty use it as is the the"), "B": " ".join(rng.choice(words) for _ in range(25)), L.RESERVED: "all rights reserved"}
    hits = 0
    for trial in range(120):
        scorer = L.Scorer(templates, 50, {w: rng.randint(1, 50) for w in words[:9]}, 0.7)
        lines = []
        for _ in range(rng.randint(0, 9)):
            kind = rng.random()
            lines.append("" if kind < 0.15 else " ".join(rng.choice([*words, "odd", "xyz"]) for _ in range(rng.randint(1, 8))))
            if kind > 0.7:
                t = rng.choice([x for v in templates.values() for x in ((v,) if isinstance(v, str) else v)]).split()
                cut = rng.randint(0, len(t))
                lines += [" ".join(t[:cut]), "# " + " ".join(t[cut:])]
        text = "\n".join(lines)
        rare = {"odd": 3, "xyz": 1}
        got, want = scorer.text(text, rare), best_run(scorer, text, rare)
        assert (got is None) == (want is None)
        if want:
            hits += 1
            assert abs(got[2] - want[1]) < 1e-8 and (got[1] == L.RESERVED) == (not want[0])
            assert got[0] == -want[2] or abs(got[2] - want[1]) < 1e-8
    assert hits > 40


def test_long_licence_texts_take_linear_time():
    scorer = L.Scorer(L.all_templates(), 1000, {}, 0.8)
    text = L.all_templates()["GPL-2.0"][-1]
    for many, most in ((1, 1.0), (8, 10.0)):  # a fraction of this on an idle machine; minutes with a scan of every run
        began = time.time()
        assert scorer.text("\n".join([text] * many), {})[1:3] == ("GPL-2.0", 1.0)
        assert time.time() - began < most
