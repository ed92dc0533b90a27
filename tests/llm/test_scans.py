"""Scans, scores and filters against brute force, round trips and held-out labels."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import licenses, quality_rules, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def letters(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(" + "|".join(map(letters, ("password", "passwd", "secret", "token", "api"))) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN = re.compile(ASSIGN.pattern.replace("[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]"))
BASE = (("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))


def plain_spans(text):
    found = [
        (m.start(), n, m.end(), kind)
        for n, (kind, pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def signed(body):
    return body + secrets.checksum(body.encode()).decode()


def test_secrets(spark, corpus, edge, none):
    good = "ghp_" + signed("a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5")
    tricky = [
        f"é password='{'x' * 12}' PassWord: abc token==abcdefghijkl secret = \"AKIA{'B' * 14}\" apikey:{'0f' * 10}",
        f"ü {good} {good[:-1]}{'A' if good[-1] != 'A' else 'B'} npm_{good[4:]}",
        "paſſword=abcdefghijklmnop toKen=abcdefghijklmnop AKIAAKIA" + "A" * 20 + " " + "abcdef0123456789" * 5000,
        "password=short password = password=longenoughvalue",
    ]
    more = spark.createDataFrame([(1000 + n, t) for n, t in enumerate(tricky)], "doc_id long, text string")
    for df in (corpus, edge, more):
        texts = Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
        want = Counter()
        for (doc_id, text), n in texts.items():
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(text))
            want[(doc_id, hashlib.sha256(joined.encode()).hexdigest())] += n
        got = secrets.find_secrets(df).collect()
        assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    found = {r.doc_id: r for r in secrets.find_secrets(more).collect()}
    checked = [s for s in found[1001].spans if s.kind == "checked"]
    assert [tricky[1][s.start : s.end] for s in checked] == [good, "npm_" + good[4:]]
    assert secrets.find_secrets(none).count() == 0


def test_licenses(spark, corpus, texts, edge, none):
    notices = {
        "under the GNU General Public License, version 3.": "GPL-3.0-only", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "All rights reserved.": "All-Rights-Reserved",
    }
    got = {r.doc_id: set(r.licenses) for r in licenses.scan_licenses(corpus).collect()}
    assert got == {i: {name for notice, name in notices.items() if notice in (t or "")} for i, t in texts.items()}
    parts = [licenses.SENTENCES[k][0] for k in ("mit_grant", "mit_condition", "as_is")]
    wrapped = ".\n".join(p.replace(" of ", " of\n") for p in parts)
    rows = [(1, "Copyright. All rights reserved.\n\n" + wrapped), (2, ". ".join(reversed(parts))), (3, parts[0] + ". All rights reserved. " + parts[1])]
    own = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert own[1].licenses == ["MIT", "All-Rights-Reserved"] and own[1].n_sentences == 4
    assert own[2].licenses == []
    assert own[3].licenses == ["MIT", "All-Rights-Reserved"]
    known = {w for own in licenses.SENTENCES.values() for w in own}
    assert all(re.search(licenses.HINT, s) for s in known)
    assert licenses.scan_licenses(edge).count() == edge.count() and licenses.scan_licenses(none).count() == 0


GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_canonical_headers(spark):
    headers = [
        (GPL % (";", ";", 2), "GPL-2.0-or-later", 5), (GPL % (":", ",", 3), "GPL-3.0-or-later", 4),
        (GPL.split("\n\n")[0] % (";", ";", 3), "GPL-3.0-or-later", 3), (GPL.split("\n\n")[0] % (":", ",", 2), "GPL-2.0-or-later", 2),
        (MPL, "MPL-2.0", 1), (APACHE, "Apache-2.0", 4),
    ]
    rows, want = [], {}
    for text, name, n in headers:
        lines = text.split("\n")
        unwrapped = "\n\n".join(" ".join(part.split()) for part in text.split("\n\n"))
        commented = ["\n".join(f"{mark} {line}".rstrip() for line in lines) for mark in ("#", "//", " *")]
        for shape in (text, unwrapped, *commented, f"/* {commented[2][3:]}\n */\nint x;"):
            want[len(rows)] = ([name], n)
            rows.append((len(rows), shape))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.licenses, r.n_sentences) for r in got} == want


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY %s "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
ENDORSE = """3. Neither the name of the University of Somewhere, Department of Things nor the
   names of its contributors may be used to endorse or promote products derived
   from this software without specific prior written permission.
"""
LIBRARY = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version %s of the License, or (at your option) any later version."""
AFFERO = GPL.split("\n\n")[0].replace("GNU General", "GNU Affero General")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_more_licences(spark):
    cases = [
        (BSD % (ENDORSE, "THE REGENTS AND CONTRIBUTORS"), ["BSD-3-Clause"]), (BSD % ("", "Some Body, Inc."), ["BSD-2-Clause"]),
        (LIBRARY % "2.1", ["LGPL-2.1-or-later"]), (LIBRARY % "3", ["LGPL-3.0-or-later"]), (AFFERO % (":", ",", 3), ["AGPL-3.0-or-later"]),
        (ISC, ["ISC"]), ("Licensed under the GNU GPL v3.0.", ["GPL-3.0-only"]), ("Licensed under the GNU AGPL v3.0", ["AGPL-3.0-only"]),
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", ["Apache-2.0"]), ("/* SPDX-License-Identifier: LGPL-2.1-or-later */", ["LGPL-2.1-or-later"]),
        ("x = 1\n# SPDX-License-Identifier: MIT\n", ["MIT"]),
        ("Released under the MIT License" + " \t" * 9000 + ".", ["MIT"]), ("/*" + "*" * 5000 + "\nAll rights reserved.", ["All-Rights-Reserved"]),
    ]
    df = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(df).collect()}
    assert got == {n: want for n, (_, want) in enumerate(cases)}


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[n : n + 5]) for n in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for n, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(n, n + 5))
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(covered), failed


def test_quality(spark, corpus, texts, edge, none):
    rows = {r.doc_id: r for r in quality_rules.quality(corpus).collect()}
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {i: tuple(r[c] for c in counts) for i, r in rows.items()} == {i: plain_counts(t) for i, t in texts.items()}
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()
    assert all(rows[r.doc_id].kept for r in labels if r.quality == 1 and not rows[r.doc_id].base_failed)
    assert any(not rows[r.doc_id].kept for r in labels if r.quality == 0)
    got = quality_rules.quality(edge).collect()
    assert Counter((r.doc_id, *(r[c] for c in counts)) for r in got) == Counter(
        (r.doc_id, *plain_counts(r.text)) for r in edge.collect()
    )
    assert quality_rules.quality(none).count() == 0


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.quality(docs).join(labels, "doc_id").filter("not base_failed").collect()
    held = [r for r in judged if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    bad, good = ([r.kept for r in held if r.quality == q] for q in (0, 1))
    assert len(bad) > 50 and bad.count(False) > 0.85 * len(bad)
    assert len(good) > 500 and good.count(False) < 0.005 * len(good)


def test_distances():
    counts, reference = np.array([[1.0, 1, 0], [0, 0, 4], [2, 2, 0], [0, 0, 0]]), np.array([5.0, 5, 0])
    assert np.allclose(quality_rules.distances(counts, reference), [0, 1, 0, 1])


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in scored)
    toxic = sorted(r.score for r in scored if r.toxic)
    clean = [r.score for r in scored if not r.toxic]
    above = sum(np.searchsorted(toxic, c, side="left") + np.searchsorted(toxic, c, side="right") for c in clean)
    assert 1 - above / (2 * len(toxic) * len(clean)) > 0.9
    assert sum(s >= 0.3 for s in toxic) > 0.8 * len(toxic)
    assert sum(s >= 0.3 for s in clean) < 0.15 * len(clean)


def test_disguised_words_are_restored(spark, edge, none):
    words = "the stupid idiot is worthless and pathetic loser scum with a good day to all of you and nice weather".split()
    docs = spark.createDataFrame([(n, " ".join(words[n % 7 :] + words)) for n in range(50)], "doc_id long, text string")
    model = toxicity.character_model(toxicity.trigrams(docs))
    for token, word in {"1d10t": "idiot", "i.d.i.o.t": "idiot", "stuuupid": "stupid", "$cum": "scum", "w0rthle55": "worthless"}.items():
        assert toxicity.disguised(token) and word in toxicity.readings(token, model)
    scorer = toxicity.Scorer({"idiot$": {0: 0.9}}, model, "one")
    assert scorer.text("you i d i o t !") == scorer.text("an 1d10t.") == scorer.text("IDIOOOT") == 0.9
    assert scorer.text("") == scorer.text("a fine day") == 0.0
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (1, 0), (999, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(edge, labels.limit(0)).filter("score > 0").count() == 0
    got = toxicity.toxicity(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    stay = toxicity.without_toxic(edge, labels.limit(0))
    assert stay.columns == edge.columns and stay.count() == edge.count()
    assert toxicity.toxicity(none, labels).count() == 0


def exhaustive(token, model, borders):
    """All readings of a short token, by going through every choice."""
    found = {"": (0.0, 0, 0)}
    last = ""
    for at, symbol in enumerate(token):
        options = [(r, toxicity.READ) for r in toxicity.READINGS.get(symbol, "")]
        if symbol in toxicity.INSIDE:
            options.append(("", 0.0))
        elif symbol.isalpha() and symbol not in toxicity.READINGS:
            options.append((symbol, toxicity.KEPT if symbol == last else 0.0))
        elif symbol not in toxicity.READINGS or at in (0, len(token) - 1) or symbol in (last, token[at + 1]):
            options.append(("", toxicity.PASSED))
        if symbol == last:
            options.append(("", toxicity.DROPPED))
        last, step = symbol, {}
        starts = dict(found)
        if borders and at:
            for s, (p, a, b) in found.items():
                if b:
                    starts[s + " "] = (p + toxicity.BORDER + float(model[a, b, 0]), 0, 0)
        for s, (p, a, b) in starts.items():
            for letter, cost in options:
                c = toxicity.LETTERS.find(letter) + 1 or toxicity.SIZE - 1
                now = (p + cost + float(model[a, b, c]), b, c) if letter else (p + cost, a, b)
                if now[0] < step.get(s + letter, (np.inf,))[0]:
                    step[s + letter] = now
        found = step
    ends = sorted((p + float(model[a, b, 0]), s) for s, (p, a, b) in found.items())
    return [s for _, s in ends[: toxicity.READINGS_KEPT]]


def test_readings_are_those_of_an_exhaustive_search(spark):
    words = "the stupid idiot is worthless and pathetic loser scum with a good day to all".split()
    docs = spark.createDataFrame([(n, " ".join(words[n % 7 :] + words)) for n in range(50)], "doc_id long, text string")
    model = toxicity.character_model(toxicity.trigrams(docs))
    for token in ("1d10t", "5*up!d", "s++up1dd", "aa.b-b", "10$3r", "$(um", "**", "@@a", "id", "w0r+h"):
        assert toxicity.readings(token, model) == exhaustive(token, model, False), token
    for run in ("youidiot", "astup1d", "y0uscum", "1d10t"):
        assert toxicity.readings(run, model, borders=True) == exhaustive(run, model, True), run


def test_long_and_spaced_disguises(spark):
    words = "the stupid idiot is worthless and pathetic loser scum with a good day you are".split()
    docs = spark.createDataFrame([(n, " ".join(words[n % 7 :] + words)) for n in range(50)], "doc_id long, text string")
    scorer = toxicity.Scorer({f"{w}$": {0: 0.9} for w in ("idiot", "stupid")}, toxicity.character_model(toxicity.trigrams(docs)), "two")
    for text in ("you are a s t u p i d", "y o u i d i o t", "$ t u p i d", "such a s.t.u.p.i.d thing", "i" * 45 + "diot",
                 "i" * 300 + "diot", "the.good.day." * 9 + "1d10t." + "and.all." * 9, "g o o d " * 60 + "i d i o t"):
        assert scorer.text(text) == 0.9, text
    for text in ("a b c d e f g", "the good day " * 40, "x" * 5000, "1 2 3 4 5 6", "A | B | C"):
        assert scorer.text(text) == 0.0, text


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    again = docs.unionByName(docs.filter("doc_id % 7 = 0").withColumn("text", docs.text.substr(1, 300)))
    found = [
        sorted((r.doc_id, r.score) for r in toxicity.toxicity(dealt, labels).collect())
        for dealt in (again.repartition(3), again.repartition(7, "lang", "n_chars"), again.orderBy(again.text.desc()).coalesce(1))
    ]
    assert found[0] == found[1] == found[2]


def test_cut_and_calibration():
    assert toxicity.best_cut([(0.9, 5, 0), (0.4, 0, 3), (0.0, 1, 90)]) == 0.65
    assert toxicity.best_cut([(0.0, 0, 4)]) == 0.5
    assert toxicity.calibrated(0.65, 0.65, 0.3) == 0.3 and toxicity.calibrated(1.0, 0.65, 0.3) == 1.0
