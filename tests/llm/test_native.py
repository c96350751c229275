"""URL filter, license scan, mixing and decontamination on edge cases and given tables."""

import random
import re

import pytest

from pyspark.sql import functions as F

from sievelake.llm import decontamination, licenses, mixing, queries, url_filter

PAGES = "page_id long, url string, verdict string, key string, rule_host string, block string"


def judged(spark, urls, rules=None, schema="host string, path string, verdict string"):
    pages = spark.createDataFrame([(i, u, "v", "k", "r", "b") for i, u in enumerate(urls)], PAGES)
    listed = spark.createDataFrame(queries.URL_RULES if rules is None else rules, schema)
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(url_filter.judge(pages, listed).collect(), key=lambda r: r.page_id)]


def test_urls(spark):
    long = "x" * 200_000
    assert judged(
        spark,
        ["http://a.example.org/es/1?q", "https://EXAMPLE.org/en/15", "https://example.org/en/2", "http://notexample.org/es/",
         "http://x.com/de/", "x.com/de/", None, "", "http://x.com", "a://b://c.com/fr/x", "http://org/", f"http://y.com/de/{long}",
         "http://y.com/DE/", "http://y.com?/de/", "http://.com/fr/", "://com/fr/#"],
    ) == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/15", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"), ("x.com", "/de/", "com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("x.com", "", None, "allow"), ("b:", "//c.com/fr/x", None, "allow"),
        ("org", "/", "org/", "allow"), ("y.com", f"/de/{long}", "com/de/", "block"), ("y.com", "/DE/", None, "allow"),
        ("y.com", "", None, "allow"), (".com", "/fr/", "com/fr/", "allow"), ("com", "/fr/", "com/fr/", "allow"),
    ]


def test_many_rules_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 2)
    rng = random.Random(2)
    rules = [(f"h{rng.randrange(40)}.net", "/" + "ab"[rng.randrange(2)] * rng.randrange(1, 6), rng.choice(["allow", "block"])) for _ in range(150)]
    best = {}
    for h, p, v in rules:
        best[h, p] = max(v, best.get((h, p), v))
    urls = [f"http://{rng.choice(['', 'x.', 'y.x.'])}h{rng.randrange(50)}.net/{'ab'[rng.randrange(2)] * rng.randrange(7)}" for _ in range(300)]
    found = judged(spark, urls, [*rules, (None, "/", "block"), ("h1.net", None, "block")])
    for host, path, rule, verdict in found:
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in best.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rule, verdict) == (max(fits)[2:] if fits else (None, "allow"))


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/de/"], []) == [("a.com", "/de/", None, "allow")]
    assert judged(spark, []) == []


def test_false_hits_are_removed_by_the_exact_join(spark):
    # One block with every bit set lets all candidates through.
    rules = [(f"r{i}.net", "/", "block") for i in range(200)]
    assert judged(spark, ["http://q.net/"], rules)[0][2] is None


def scanned(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, licenses string, ids string")
    return [(r.n_sentences, r.licenses) for r in sorted(licenses.scan(docs, **more).collect(), key=lambda r: r.doc_id)]


def test_licenses(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,'
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included"
        ' in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR'
        " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    halves = mit.split(" The above")
    assert scanned(
        spark,
        [None, "", "a\nReleased under the MIT License.\nb", "released under the mit license", "x Released under the MIT License",
         mit, "The above" + halves[1] + " " + halves[0], "Licensed under the Apache License, Version 2.0. All rights reserved.",
         "lorem " * 50_000 + ". Licensed under CC BY-NC 4.0!", "All rights reserved. All rights reserved."],
    ) == [
        (0, ""), (0, ""), (1, "MIT"), (1, "MIT"), (0, ""), (3, "MIT"), (3, ""),
        (2, "Apache-2.0,LicenseRef-all-rights-reserved"), (1, "CC-BY-NC-4.0"), (2, "LicenseRef-all-rights-reserved"),
    ]
    assert scanned(spark, []) == []


APACHE = """Copyright 2020 A. Author

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"""
BSD = """1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details."""


@pytest.mark.parametrize("layout", ["as is", "commented", "windows", "one line"])
def test_standard_notices(spark, layout):
    def laid(text):
        if layout == "commented":
            return "\n".join(f" * {line}".rstrip() for line in text.split("\n"))
        return text.replace("\n", "\r\n") if layout == "windows" else " ".join(text.split()) if layout == "one line" else text

    # On one line the author's name and the notice are one sentence, so it starts without it.
    apache = APACHE.split("\n\n", 1)[1] if layout == "one line" else APACHE
    mit = MIT.split("\n\n", 1)[1] if layout == "one line" else MIT
    ecl = apache.replace("Apache", "Educational Community").replace("www.apache.org", "opensource.org")
    found = scanned(spark, [laid(t) for t in (apache, apache.replace("http:", "https:"), mit, BSD, GPL, ecl)])
    assert [r[0] for r in found[:5]] == [4, 4, 3, 3, 2]
    assert [r[1] for r in found] == ["Apache-2.0", "Apache-2.0", "MIT", "BSD-2-Clause,BSD-3-Clause", "GPL-3.0-or-later", ""]


def test_sentences_end_at_paragraphs_and_full_stops(spark):
    texts = ["All\nrights\nreserved", "All\n\nrights reserved", "All. Rights reserved", "All\r\nrights: reserved;", "x all\nrights reserved", "all rights\nreserved x"]
    assert [r[0] for r in scanned(spark, texts)] == [1, 0, 0, 1, 0, 0]


def test_every_rule_can_match(spark):
    texts = [". ".join(licenses.SENTENCES[i] for i in ids) for _, ids in licenses.RULES]
    assert all(name in found[1].split(",") for (name, _), found in zip(licenses.RULES, scanned(spark, texts), strict=True))


def test_rules_are_ordered_and_in_a_row(spark):
    known, rules = {"a": "one", "b": "two", "c": "three"}, [("AB", ["a", "b"]), ("ABC", ["a", "b", "c"])]
    texts = ["One. Two.", "One. Other words. Two! Three", "Two. One.", "One. Three. Two."]
    assert scanned(spark, texts, known=known, rules=rules) == [(2, "AB"), (3, "AB,ABC"), (2, ""), (3, "")]
    with pytest.raises(ValueError):
        scanned(spark, [""], known={"x": "Not normal."})


def mixed(spark, rows):
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, source string, text string, size string, target string")
    return mixing.mix(docs).collect()


def test_mix_reaches_targets(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "c", None, "d", "é"]), "w " * rng.randrange(60)) for i in range(3000)]
    found = mixed(spark, rows)
    assert len(found) == 3000
    words = {}
    for i, s, t in rows:
        words[s] = words.get(s, 0) + len(t.split())
    taken, goal, by_id = {}, {}, {r[0]: r[1] for r in rows}
    for r in found:
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.source_size == words[by_id[r.doc_id]]
        taken[by_id[r.doc_id]] = taken.get(by_id[r.doc_id], 0) + r.taken
        goal[by_id[r.doc_id]] = r.target
    total = sum(words.values())
    assert abs(sum(goal.values()) - 1.5 * total) < 1e-6 * total
    assert 1.5 * total - 60 <= sum(taken.values()) <= 1.5 * total
    for s, n in taken.items():
        assert abs(n - goal[s]) <= 120 and goal[s] <= 2 * words[s] + 1e-6
    again = mixed(spark, rows[::-1])
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_mix_edges(spark):
    assert mixed(spark, []) == []
    assert [tuple(r) for r in mixed(spark, [(1, "a", None), (2, None, " \n")])] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)] or {
        tuple(r) for r in mixed(spark, [(1, "a", None), (2, None, " \n")])
    } == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}
    found = {r.doc_id: r for r in mixed(spark, [(None, "a", "x y"), (7, "b", None), (7, "b", "z"), (8, None, "v " * 40_000)])}
    assert found[8].size == 40_000 and set(found) == {None, 7, 8}


def test_taken_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, "w " * 5, "s", "en") for i in range(8)] + [(0, "w " * 5, "s", "en")], "doc_id long, text string, source string, size string")
    found = mixing.taken_documents(docs)
    assert found.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert all(r.taken > 0 for r in found.collect())


def plain_contamination(docs, items, n=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).update([str(item)] if item is not None else [])
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found |= grams[tuple(w[i : i + size])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("anchors", [100_000, 3])
def test_contamination_equals_brute_force(spark, monkeypatch, anchors):
    monkeypatch.setattr(decontamination, "ANCHORS_AT_ONCE", anchors)
    rng = random.Random(6)

    def some(k):
        return [rng.choice(["a", "b", "Ça", "d9", "eé", "ff"]) for _ in range(k)]

    items = [(i, " ".join(some(rng.choice([3, 9, 10, 11, 14, 30])))) for i in range(12)]
    items += [(50, "Lone!"), (51, ""), (52, None), (None, "a b"), (None, "nobody knows whose"), (1, items[1][1]), (53, "x-Y z, u; v. w/ a b c d e f g h")]
    docs = [(i, " ".join(some(rng.randrange(60)))) for i in range(40)]
    docs += [(100 + i, " ".join(some(5) + items[i][1].split() + some(5))) for i in range(12)]
    docs += [(200, None), (201, ""), (202, "LONE"), (205, "nobody knows whose this is"), (203, "x y z u v w a b c d e"), (204, "q " * 30_000 + items[3][1]), (3, docs[3][1]), (3, "lone lone"), (None, "lone")]
    schema = "text string, items string, w string, anchor string"
    d = spark.createDataFrame([(i, t, "", "", "") for i, t in docs], "doc_id long, " + schema)
    b = spark.createDataFrame([(i, t, "", "", "") for i, t in items], "item_id long, " + schema)
    found = decontamination.contamination(d, b).collect()
    expected = plain_contamination(docs, items)
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in found) == sorted(map(str, expected))
    clean = decontamination.clean(d, b)
    assert clean.columns == d.columns
    kept = [(i, t) for (i, t), e in zip(docs, expected, strict=True) if not e[2]]
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(map(str, kept))


def test_a_benchmark_of_many_anchors_is_scanned_in_turns(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ANCHORS_AT_ONCE", 15_000)
    items = spark.range(60_000).select(F.col("id").alias("item_id"), F.concat(F.lit("anchor"), F.col("id").cast("string"), F.lit(" is one")).alias("text"))
    docs = spark.createDataFrame([(i, f"here anchor{7919 * i} is one and anchor{i} is") for i in range(5)] + [(9, "anchor70000 is one")], "doc_id long, text string")
    found = {r.doc_id: (r.n_hit, r["items"]) for r in decontamination.contamination(docs, items).collect()}
    assert found == {9: (0, [])} | {i: (3, [str(7919 * i)]) for i in range(5)}


def test_contamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[2:4] for r in decontamination.contamination(d, b).collect()] == [(2, 0)]
    assert decontamination.contamination(d.limit(0), b).collect() == []
    assert decontamination.clean(d, b).count() == 1


def test_native_operators_run_no_python(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("op1_url_filter", "op3_license_scan", "op8_source_mix", "op9_decontamination"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
