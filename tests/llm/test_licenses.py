"""Licence passages against a scan without pruning."""
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from salesmart.llm import licenses as lc
from salesmart.llm.queries import QUERIES


def brute_best(text, templates=lc.TEMPLATES):
    """Best Dice of any template on any run of words, without bounds or segments."""
    w = lc.words_of(text)
    best = 0.0
    for _, _, t in templates:
        x = lc.words_of(t)
        g = Counter(zip(x, x[1:]))
        for s in range(len(w)):
            for e in range(s + 2, min(len(w), s + 3 * len(x)) + 1):
                best = max(best, lc.dice(Counter(zip(w[s:e], w[s + 1:e])), g))
    return best


def test_notices_in_running_text():
    sc = lc.Scanner()
    filler = "Of the in with that\nand on the License. "
    for name, _, t in lc.TEMPLATES:
        got = sc.scan(filler * 3 + "\n" + t + "\n" + filler * 3)
        assert [m[0] for m in got] == [name] and got[0][2] > 0.9
        wrapped = t.replace(" ", "\n", 3).upper()
        assert name in [m[0] for m in sc.scan(filler + "\n" + wrapped + "\n" + filler)]


def test_offsets_point_at_the_passage():
    text = "Ein Satz É.\nReleased under the MIT License.\nNoch ein Satz. Licensed under CC BY-NC 4.0. Ende."
    assert [text[a:b] for *_, a, b in lc.Scanner().scan(text)] == ["Released under the MIT License", "Licensed under CC BY-NC 4.0"]


def test_pruned_scan_finds_what_the_full_one_finds():
    rnd = random.Random(2)
    small = [t for t in lc.TEMPLATES if len(t[2]) < 60]
    sc = lc.Scanner(small)
    for _ in range(60):
        t = rnd.choice(small)[2].split()
        if rnd.random() < 0.6:
            t[rnd.randrange(len(t))] = rnd.choice(["the", "zz", "GNU"])
        text = " ".join(t)
        best = brute_best(text, small)
        got = max((m[2] for m in sc.scan(text)), default=0.0)
        whole = max(lc.dice(Counter(zip(w, w[1:])), Counter(zip(x, x[1:]))) for w in [lc.words_of(text)] for x in [lc.words_of(s[2]) for s in small])
        assert got <= best + 1e-12 and (got >= whole - 1e-12 if whole >= 0.8 else True)


def test_notices_inside_running_sentences():
    sc = lc.Scanner()
    found = lambda text: [(m[0], text[m[3]:m[4]]) for m in sc.scan(text)]
    assert found("This project is released under the MIT License.") == [("MIT", "released under the MIT License")]
    assert found("As said, this text is licensed under CC BY 4.0 and free") == [("CC-BY-4.0", "licensed under CC BY 4.0")]
    twice = "code released under the MIT License, text licensed under CC BY-NC 4.0 except where noted, all released under the MIT License"
    assert [m[0] for m in sc.scan(twice)] == ["MIT", "CC-BY-NC-4.0", "MIT"]


def test_scan_reaches_the_best_run_anywhere():
    rnd = random.Random(5)
    # without the notices that name no version: they lie inside longer relatives, which a run may give way to
    small = [t for t in lc.TEMPLATES if len(t[2]) < 90 and (re.search(r"\d", t[0]) or t[0] == "MIT")]
    sc = lc.Scanner(small)
    reached = 0
    for _ in range(60):
        t = rnd.choice(small)[2].strip(".").split()
        for _ in range(rnd.randrange(3)):
            t.insert(rnd.randrange(len(t)), rnd.choice(["the", "zz", "GNU", "License"]))
        around = [[rnd.choice(["of", "under", "the", "License", "this", "work", "is"]) for _ in range(rnd.randrange(1, 9))] for _ in "ab"]
        text = " ".join([*around[0], *t, *around[1]])
        best = brute_best(text, small)
        got = max((m[2] for m in sc.scan(text)), default=0.0)
        assert abs(got - best) < 1e-12 if best >= lc.THRESHOLD else got == 0
        reached += best >= lc.THRESHOLD
    assert reached > 30


GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published "
       "by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in "
       "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
       "PURPOSE. See the GNU {0}General Public License for more details.")


def test_near_relatives_keep_their_licence():
    sc = lc.Scanner()
    names = lambda text: [m[0] for m in sc.scan(text)]
    for kind, version, name in [("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Affero ", "3", "AGPL-3.0"), ("Lesser ", "3", "LGPL-3.0"),
                                ("Lesser ", "2.1", "LGPL-2.1")]:
        assert names("x " + GNU.format(kind, version) + " y") == [name]
    two = next(t for n, _, t in lc.TEMPLATES if n == "BSD-2-Clause")
    three = " Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    assert names(two) == ["BSD-2-Clause"]
    assert names(two + three.format("the Example Foundation")) == ["BSD-3-Clause"]
    assert names("code under the terms of the Artistic License 2.0; texts licensed under CC0 1.0") == ["Artistic-2.0", "CC0-1.0"]
    assert names("(c) 2020 X. All rights reserved.") == ["All rights reserved"]
    assert names("Licensed under CC BY-NC 3.0") == ["CC-BY-NC-3.0"]
    assert names("This work is licensed under the GNU Free Documentation License") == ["GFDL"]
    for name, _, t in lc.TEMPLATES:
        assert names("we say that " + t.strip(".") + " and go on") == [name]


def test_query_and_edges(spark):
    rows = QUERIES["op9_licenses"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs)
    sc = lc.Scanner()
    assert all(r.n_matches == len(sc.scan(docs[r.doc_id])) for r in rows)
    plain = {d for d, t in docs.items() if "Released under the MIT License.\n" in (t or "") + "\n"}
    assert plain <= {r.doc_id for r in rows if "MIT" in r.licenses} and plain
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Released under the MIT License. " * 3000, "x")], "doc_id long, text string, licenses string")
    out = lc.scan(df)
    assert out.columns == df.columns
    assert [len(r.licenses) for r in out.orderBy("doc_id").collect()] == [0, 0, 3000]
    assert lc.scan(df.limit(0)).select(F.size("licenses")).count() == 0
