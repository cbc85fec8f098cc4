"""License passages: wrapped over lines, inside a line, and whole license files."""

import random
import textwrap

from barline.llm import licenses

from . import brute

MIT = licenses.TEMPLATES["MIT"][2]


def test_wrapped_inner_and_full_notices(spark):
    head = "Copyright (c) 2024 Jane Doe\n\n"
    warranty = "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.\n"
    code = "\n".join(f"def f{k}(x): return x + {k}" for k in range(300))
    docs = [
        (1, code + "\n" + "\n".join("# " + x for x in textwrap.wrap(MIT, 78)) + "\n" + code), (2, "MIT License\n\n" + head + "\n".join(textwrap.wrap(MIT, 78)) + warranty),
        (3, "Copyright 2024 Jane Doe. Released under the MIT License."), (4, code), (5, "MIT"), (None, "x Released under the MIT License. y z a b c d e f g h i j k"),
    ]
    bodies = {name: t[-1] for name, t in licenses.TEMPLATES.items() if len(t[-1]) > 700}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "BSD-3-Clause", "MIT", "ISC", "Unlicense", "CC0-1.0", "CC-BY-SA-4.0"} <= set(bodies) | {"ISC"}
    names = sorted(bodies)
    docs += [(100 + k, "our words first\n" + code + "\n" + bodies[n] + "\n" + code) for k, n in enumerate(names)]
    got = {r.doc_id: r for r in licenses.license_scan(brute.frame(spark, docs)).collect()}
    assert [got[i].license for i in (1, 2, 3, 4, 5, None)] == ["MIT", "MIT", "MIT", None, None, "MIT"]
    assert (got[1].unit, got[1].line, got[1].passage_dice) == ("passage", 300, 1.0) and got[3].passage_at == 4 and got[3].passage_words == 5
    assert [got[100 + k].passage_license for k in range(len(names))] == names and got[4].passage_license is None


def test_best_window_is_what_trying_all_gives():
    rnd = random.Random(7)
    t = licenses.Templates.of({"A": ("a b c d e f",), "B": ("a b a c a d e f g",)})
    which = t.short.nonzero()[0] if t.short.any() else licenses.np.arange(2)
    for _ in range(300):
        words = [rnd.choice("abcdefgx") for _ in range(rnd.randint(2, 24))]
        data = licenses.np.frombuffer(" ".join(words).encode(), licenses.np.uint8)
        keys, _, _ = licenses._bigrams(data, licenses.np.array([0, len(data)]))
        want = None
        for name, text in (("A", "a b c d e f"), ("B", "a b a c a d e f g")):
            w = text.split()
            mine = set(zip(w, w[1:]))
            for i in range(len(words)):
                for j in range(i + 2, len(words) + 1):
                    some = set(zip(words[i:j], words[i + 1 : j]))
                    rank = (-2 * len(some & mine) / (len(some) + len(mine)), i, j - i, name)
                    if rank[0] <= -licenses.LEAST and (want is None or rank < want):
                        want = rank
        got = t.passage(keys, licenses.LEAST, which)
        assert (want is None) == (got is None)
        assert got is None or abs(got[0] + want[0]) < 1e-12
        likely = t.likely(keys, licenses.np.array([0, len(keys)]), licenses.LEAST)
        assert want is None or (likely and ("A", "B").index(got[3]) in likely[0][1])
