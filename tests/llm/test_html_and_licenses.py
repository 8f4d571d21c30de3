import time

import numpy as np
import pytest

from odflow.llm import html_extract as H
from odflow.llm import licenses as L
from odflow.llm.html_blocks import blocks


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T &lt; x</title><style>p{}</style><script>var a="</p><p>no";</script></head>
    <body class="home"><!-- c <p>no</p> --><nav id=Main-Menu><ul><li><a href="/a">One</a><li><a href='/b'>Two</a></ul></nav>
    <article><h1>Head &amp; tail</h1><p>a <b>bo</b>ld\n word &copy &eacute;&#233;<br>next<p>last &amp;lt; x</article>text<p>cut &am"""
    got = [(b.text, b.path[-1], b.link_chars) for b in blocks(page)]
    assert got == [("One", "a", 3), ("Two", "a", 3), ("Head & tail", "h1", 0), ("a bold word © éé", "p", 0), ("next", "p", 0),
                   ("last &lt; x", "p", 0), ("text", "body home", 0), ("cut &am", "p", 0)]
    assert blocks(page)[0].path == ("html", "body home", "nav main menu", "ul", "li", "a")
    for cut in ("", "<", "a<b", "<p", "<!--", "<script>x", "</", "&", "<p class='x", "plain"):
        blocks(cut)
    assert [b.text for b in blocks("x<!-- open")] == ["x"] and [b.text for b in blocks("1 < 2 <p>3")] == ["1 < 2", "3"]


@pytest.mark.parametrize("tag, names", [
    ("<p class=x title=today's>", "p x"), ("<p title=5\"x class='a b'>", "p a b"), ("<p a'b class=x>", "p x"), ("<p class = x id=\"y > z\">", "p x y z"),
    ("<p class=>", "p"), ("<p =class class=x/>", "p x"), ("<p/class=x>", "p x"), ("<p title='it\"s' class=x>", "p x"), ("<p title=\"a'b\"class=x>", "p x")])
def test_attributes_as_the_standard_reads_them(tag, names):
    got = blocks(f"{tag}One sentence that's here.</p><p>Two \"quoted\".</p>")
    assert [(b.text, b.path) for b in got] == [("One sentence that's here.", (names,)), ('Two "quoted".', ("p",))]


def test_deep_pages_take_linear_time():
    t0 = time.perf_counter()
    page = blocks("<div>x " * 100_000 + "</b>" * 100_000)
    assert len(page) == 100_000 and len(blocks("<p><b>" * 50_000 + "x")) == 1
    rows = H.Extractor(H.Labeller())._vectors(page)
    assert rows.shape[0] == 100_000 and time.perf_counter() - t0 < 30


def test_path_vectors_equal_those_of_the_fit():
    page = blocks('<html><body class=home>top<div id=main><p>a<ul><li>b<li class=x>c</ul></div><nav><a>d</a></nav>')
    loose = blocks("no element<p>one</p>")
    model = H.Labeller()
    extractor = H.Extractor(model)
    for blocks_ in (page, loose, page):
        assert np.allclose(extractor._vectors(blocks_), model.vectors(H.Page.of(blocks_)), atol=1e-5)


def test_gradients_by_differences():
    rng, pages, labels = np.random.default_rng(0), [], []
    while len(pages) < 3:
        raw, truth = H.made_page(rng, "alpha beta gamma delta".split())
        if [b.text for b in blocks(raw)] == [t for t, _ in truth if t]:
            pages.append(H.Page.of(blocks(raw)))
            labels.append(np.array([y for t, y in truth if t], np.float32))
    model = H.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grads = model.gradients(pages, labels)
    for k, v in model.p.items():
        at = np.unravel_index(np.abs(grads[k]).argmax(), v.shape)
        v[at] += 1e-3
        up = model.gradients(pages, labels)[0]
        v[at] -= 2e-3
        down = model.gradients(pages, labels)[0]
        v[at] += 1e-3
        assert np.isclose(grads[k][at], (up - down) / 2e-3, rtol=2e-2, atol=1e-5), k


def test_extraction(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    body = ("<html><body><header><div>Site name</div></header><div class='cookie-notice'>We use cookies.</div><nav><a href=#>Home</a></nav>"
            "<main><h1>The long title of it</h1><p>First paragraph with several plain words in it, and more of them.</p><div class='ad'>Buy now</div>"
            "<p>Second paragraph, which also has quite a number of words.</p></main><form><p>Your email</p></form>"
            "<section class='comments'><p>Great article, thanks!</p></section><footer>All rights reserved.</footer></body></html>")
    extra = spark.createDataFrame([(9001, "u", body), (9002, "u", None), (9003, None, ""), (9004, "u", "<script>only()</script>"), (9001, "u", body)],
                                  "page_id long, url string, html string")
    got = H.extract_main_text(pages.select("page_id", "url", "html").unionByName(extra))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r.page_id: r for r in got.collect()}
    assert rows[9001].text == ("The long title of it First paragraph with several plain words in it, and more of them. "
                               "Second paragraph, which also has quite a number of words.")
    assert [rows[i].text for i in (9002, 9003, 9004)] == ["", "", ""]
    assert all(r.n_chars == len(r.text) for r in rows.values())
    right = 0
    for p in pages.collect():  # these pages put their text in <article>
        want = " ".join(b.text for b in blocks(p.html) if "article" in b.path)
        right += rows[p.page_id].text == want
    assert right >= 0.98 * pages.count()
    assert H.extract_main_text(extra.limit(0)).count() == 0


def test_unseen_made_pages():
    rng = np.random.default_rng(123)
    model = H.train([], made=500, epochs=6)
    hit = n = 0
    extractor = H.Extractor(model)
    for _ in range(100):
        raw, truth = H.made_page(rng, "some other words for these pages here".split())
        page, y = blocks(raw), [v for t, v in truth if t]
        if len(page) == len(y):
            x, live = H._pad([extractor._vectors(page)])
            hit += int(((model.margins(x, live)[:, 0] > 0) == (np.array(y) > 0)).sum())
            n += len(y)
    assert hit / n > 0.95


MIT = "\n\n".join(["MIT License\n\nCopyright (c) 2020 X",
                   *(s.capitalize() + "." for k in ("mit-1", "mit-2", "mit-3") for s in L.SENTENCES[k])])


def test_rules():
    found = L.sentence_ids(MIT)
    assert L.match_rules(found) == (["MIT", "MIT"], [])
    assert L.match_rules(L.sentence_ids(MIT.replace("The above", "No above"))) == (["MIT"], ["mit-1", "mit-3"])
    swapped = [(0, "mit-2"), (1, "mit-1"), (2, "mit-3")]
    assert L.match_rules(swapped) == ([], ["mit-2", "mit-1", "mit-3"])
    assert L.match_rules([(0, "bsd-1"), (1, "bsd-2"), (2, "bsd-3"), (3, "bsd-4")])[0] == ["BSD-3-Clause"]
    assert L.match_rules([(0, "bsd-1"), (1, "bsd-2"), (2, "bsd-3"), (9, "bsd-4")]) == (["BSD-2-Clause"], ["bsd-4"])
    assert all(s == L.normalise(s) and L._QUICK.search(s) for s in L._KNOWN)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


@pytest.mark.parametrize("notice, licence, n", [(APACHE, "Apache-2.0", 4), (GPL2, "GPL-2.0", 3), (GPL3, "GPL-3.0", 3), (MPL, "MPL-2.0", 2),
                                                ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0", 1), ("SPDX-License-Identifier: MIT", "MIT", 1)])
def test_standard_notices(notice, licence, n):
    words = notice.split()
    narrow = "\n".join(" ".join(words[i:i + 4]) for i in range(0, len(words), 4))
    for text in (notice, " ".join(words), narrow, "".join(f" * {x}\n" for x in notice.split("\n")), notice.replace("\n", "\r\n"), notice.replace("\n", "\n\n"),
                 f"Copyright 2020 A. Person\n{notice}\n\nSome other text."):
        found = L.sentence_ids(text)
        assert (L.match_rules(found), len(found)) == (([licence], []), n), text


def test_short_sentences_end_with_their_sentence():
    assert L.sentence_ids("MIT\n\nLicense") == L.sentence_ids("We met at MIT. License plates") == []
    assert L.match_rules(L.sentence_ids(GPL3.replace("WARRANTY; without", "WARRANTY; with")))[0] == []


def test_scan(spark):
    rows = [(1, "x y.\nLicensed under CC BY-NC 4.0.\nAll rights reserved. Released under the MIT License."), (2, None), (3, ""),
            (4, "no licence here, software"), (5, "This work is licensed under the GNU General Public License, version 3."), (5, "MIT License"), (None, "All rights reserved.")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, licenses string")
    out = L.scan_licenses(df)
    got = sorted(((str(r.doc_id), r.licenses, r.n_sentences) for r in out.collect()), key=str)
    assert got == sorted([("1", ["CC-BY-NC-4.0", "All-Rights-Reserved", "MIT"], 3), ("2", [], 0), ("3", [], 0), ("4", [], 0),
                          ("5", ["GPL-3.0"], 1), ("5", ["MIT"], 1), ("None", ["All-Rights-Reserved"], 1)], key=str)
    assert L.scan_licenses(df.limit(0)).count() == 0
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: sum(s in r.text for s in ("Licensed under CC BY-NC 4.0.", "All rights reserved.", "Released under the MIT License.",
                                                "Licensed under the Apache License, Version 2.0.",
                                                "This work is licensed under the GNU General Public License, version 3.")) for r in texts.collect()}
    assert {r.doc_id: len(set(r.licenses)) for r in L.scan_licenses(texts).collect()} == want


def test_sentence_on_many_lines_under_a_heading():
    words = MIT.split("\n\n")[2].split()
    for width in (1, 2, 3, 5):
        lines = "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))
        assert L.sentence_ids(lines) and [x[1] for x in L.sentence_ids("A heading\n" + lines)] == [x[1] for x in L.sentence_ids(lines)]


@pytest.mark.parametrize("text, licences", [
    ("This project is licensed under the MIT License.", ["MIT"]), ("The code is licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", ["GPL-2.0"]),
    ("/* SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0) AND bsd-3-clause */", ["GPL-2.0", "BSD-3-Clause"]),
    ("It is distributed under the terms of the\nGNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("Text is available under CC BY-NC-SA 4.0 for all.", ["CC-BY-NC-SA-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", ["CC-BY-NC-SA-4.0"]),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies.", ["ISC"]),
    ("This is not licensed under the MIT License.", []), ("He was licensed under the old rules. The MIT License plates", []), ("SPDX-License-Identifier:", []),
    ("Unlike the MIT license, this one is long.", []), ("0spdx0 licensed", [])])
def test_statements_inside_sentences(text, licences):
    narrow = text if "SPDX" in text or not licences else text.replace(" ", "\n * ")  # a lone line "MIT License" is a heading, not a mention
    for form in (text, narrow, f"Some words first. {text}" if "SPDX" not in text else f"x\n{text}"):
        assert L.match_rules(L.sentence_ids(form))[0] == licences, form


def test_bsd_with_any_holder():
    parts = [x for k in ("bsd-1", "bsd-2", "bsd-3") for x in L.SENTENCES[k]]
    for holder, others in (("the University", "its contributors"), ("Example Software Ltd", "other contributors to this work"), ("the copyright holder", "its contributors")):
        last = L.SENTENCES["bsd-4"][0].replace(L.SLOT, holder, 1).replace(L.SLOT, others, 1)
        notice = ":\n* ".join([*parts, last])
        assert L.match_rules(L.sentence_ids(notice)) == (["BSD-3-Clause"], [])
        noted = ".\n* ".join([*parts, L.SENTENCES["bsd-notice"][0], last])
        assert L.match_rules(L.sentence_ids(noted)) == (["BSD-4-Clause"], [])


def test_lookup_by_brute_force():
    """Made texts of known sentences and other words: the found ones are those of a scan that tries every sentence at every word."""
    rng = np.random.default_rng(5)
    known = [k for k in L._KNOWN if L.SLOT not in k and k in L._ANYWHERE and len(k.split()) >= L.SHORT_WORDS]
    for _ in range(60):
        parts = [str(rng.choice(known)) if rng.random() < 0.5 else " ".join(rng.choice(["the", "license", "permission", "is", "software", "to"], rng.integers(1, 9)))
                 for _ in range(12)]
        words, at, want = " ".join(parts).split(), 0, []
        while at < len(words):
            fits = [k for k in L._KNOWN if k in L._ANYWHERE and words[at:at + len(k.split())] == k.split()]
            if fits:
                best = max(fits, key=lambda k: len(k.split()))
                want.append(L._KNOWN[best])
                at += len(best.split())
            else:
                at += 1
        text = "".join(w + str(rng.choice([" ", "\n", ", "], p=[0.7, 0.15, 0.15])) for w in words)
        assert [x for _, x in L.sentence_ids(text)] == want
