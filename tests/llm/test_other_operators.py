"""The operators outside the pipeline against plain versions, with awkward rows."""

import re

import numpy as np
import pytest

from tabwright.llm import boost, html_text, licenses, linear, pii, topk, toxicity
from tests.llm import brute
from tests.llm.test_pipeline_operators import DOCS, prose, table


# personal data

def plain_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def test_base_spans_of_random_texts():
    draw = np.random.default_rng(4)
    pieces = ["@", "a.b", "x@y.z", ".", "..", "1.2.3.4", "999.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "-", " ", "+", "(", ")", "12", "é", "mail@", "7",
              "+49 (30) 1234-5678", "%_", "\n", "1.2.3.4.5.6.7.8", "00.00.00.00", "5500-0000-0000-0004"]
    for _ in range(3_000):
        text = "".join(pieces[i] for i in draw.integers(0, len(pieces), draw.integers(1, 14)))
        assert pii.base_spans(text) == plain_pii(text), text


def pii_rows(n=400):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(n):
        extra = [f"mail u{i}@mail{i % 7}.example.com now", f"host 10.{i % 256}.3.{i % 200} up", "card 4111 1111 1111 1111 ok",
                 f"call +1 (415) 555-{1000 + i} today", f"order {draw.integers(10 ** 9, 10 ** 12)} sent", f"version 1.{i}.700.2 out",
                 "konto DE89 3704 0044 0532 0130 00 x"][i % 7]
        rows.append((i, f"{prose(i, 12)} {extra} {prose(i + 1, 5)}", "en", "s", 0))
    return rows


def test_pii(spark):
    rows = [*pii_rows(), (1000, None, None, None, None), (1001, "", "", "", 0), (None, "a@b.co", "", "", 0), (1, "x " * 30_000 + "a@b.cd", "", "", 0)]
    docs = table(spark, rows).repartition(4)
    got = pii.pii_report(docs).collect()
    expected = sorted((str(r[0]), brute.digest(brute.shown(plain_pii(r[1])))) for r in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == expected
    for r in got:
        if r.doc_id is not None and r.doc_id > 1:
            text = next(x[1] for x in rows if x[0] == r.doc_id)
            spans = plain_pii(text)
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
            assert {*filter(None, brute.shown(spans).split(","))} <= {*filter(None, r.spans.split(","))}
    more = [s for r in got for s in r.spans.split(",") if s and s.split(":")[0] not in pii.KINDS]
    assert sum(s.startswith("account:") for s in more) >= 50 and sum(not s.startswith("account:") for s in more) <= 4


def test_pii_in_wider_forms(spark):
    planted = ["u7 (at) mail3 (dot) example (dot) com", "ann.b[at]web[dot]org", "(415) 555-2671", "0415 555 2672", "415.555.2673", "0049 415 555 2674"]
    rows = pii_rows(800) + [(2_000 + i, f"{prose(i, 12)} {'call' if i > 1 else 'mail'} {p} today {prose(i + 1, 5)}", "en", "s", 0)
                            for i, p in enumerate(planted)]
    got = {r.doc_id: r.spans for r in pii.pii_report(table(spark, rows).repartition(3)).collect()}
    for i, text, *_ in rows[-len(planted):]:
        a = text.index(planted[i - 2_000])
        assert f"{a}:{a + len(planted[i - 2_000])}" in [s.split(":", 1)[1] for s in got[i].split(",") if s], text
    # bare numbers and versions stay
    assert sum(any(s.split(":")[0] not in pii.KINDS for s in got[i].split(",") if s) for i, *_ in rows[:800] if i % 7 in (4, 5)) <= 4


def test_rare_kinds_are_found_at_any_density(spark):
    account = "konto DE89 3704 0044 0532 0130 00 x"
    rows = [(i, f"{prose(i % 50, 6)} {account if i % 500 == 0 else f'order {10 ** 9 + i} sent'} {prose(i % 7, 3)}", "en", "s", 0) for i in range(60_000)]
    docs = table(spark, rows).repartition(8)
    judge = pii.fit_judge(docs)
    found, name = pii.find_pii(docs.where("doc_id % 500 = 0"), judge)
    assert sum(any(s.kind == "account" for s in r[name]) for r in found.collect()) >= 115
    found, name = pii.find_pii(docs.where("doc_id < 2000 AND doc_id % 500 > 0"), judge)
    assert sum(len(r[name]) for r in found.collect()) == 0


def test_pii_of_nothing(spark):
    assert pii.pii_report(table(spark, [])).count() == 0
    out = pii.pii_report(table(spark, [(1, "no data", "", "", 0)]).selectExpr("*", "1 AS pii", "2 AS spans"))
    assert out.first().spans == ""


def test_boosted_trees_on_held_out_rows():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4_000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = boost.fit_boosted(x[:2_000], y[:2_000])
    boost.calibrate(model, x[2_000:3_000], y[2_000:3_000])
    p = model.probability(x[3_000:])
    assert ((p > 0.5) == y[3_000:]).mean() > 0.95
    assert abs(p.mean() - y[3_000:].mean()) < 0.05


def test_logistic_gradient_is_zero():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, 4)) * 20
    y = (x[:, 0] > 0).astype(float)
    w = linear.fit_logistic(x, y)
    p = linear.predict(x, w)
    assert np.abs(x.T @ (p - y) + w[:-1]).max() < 1e-3 and abs((p - y).sum()) < 1e-3


# top k

def plain_topk(rows, k=5, every=50):
    clean = []
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((key, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    asked = {(key, tuple(v)) for key, v in clean if key % every == 0}
    out = []
    for key, q in asked:
        found = sorted((-sum(a * b for a, b in zip(q, v)), other) for other, v in clean if other != key and len(v) == len(q))
        out += [(key, rank + 1, other, -s) for rank, (s, other) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("settings", [topk.TopK(), topk.TopK(block=16, pivots=5, shelf=2, queries=1)])
def test_topk(spark, settings):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.1 * draw.normal(size=8)]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(50, rows[7][1]), (100, rows[100][1]), (5000, None), (5050, [1.0, None]), (5100, [float("nan"), 1.0]), (5150, [float("inf"), 0.0]),
             (None, rows[1][1]), (5200, [1.0, 2.0]), (5201, [1.0, 2.0]), (5250, []), (-50, rows[9][1])]
    got = topk.search(table(spark, rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS cell").repartition(5), settings)
    assert sorted(map(tuple, got.collect())) == plain_topk(rows)


def test_topk_beyond_doubles(spark):
    rows = [(50, [1e7, 3.0]), (1, [1e7, 1.0]), (2, [1e7, 2.0]), (3, [-1e7, 1.0])]
    got = topk.search(table(spark, rows, "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, got.collect())) == plain_topk(rows)


def test_topk_of_nothing(spark):
    for rows in ([], [(1, [1.0])], [(50, [1.0])]):
        assert topk.search(table(spark, rows, "vec_id long, embedding array<float>")).count() == 0


# licences

def plain_phrases(text):
    words = brute.ALNUM.findall((text or "").translate(brute.LOWER))
    places = sorted((i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if tuple(words[i: i + len(phrase)]) == phrase)
    return len(words), places


LICENSED = [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}), ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("under the GNU General\n * Public License, version 3.", {"gpl", "gpl-3.0"}), ("Released under the MIT License.", {"mit"}),
    ("All rights reserved.", {"reserved"}), ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}), ("mit dem Haus", set()),
    ("accept classical laccby", set()), ("see https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}), (None, set()), ("", set()),
    ("cc by cc by general public license", {"cc-by", "gpl"}), ("all éall rights reserved xall rights reserved", {"reserved"}),
    ("a CC.BY, b", {"cc-by"}), ("x " * 40_000 + "All Rights Reserved", {"reserved"}),
]


def test_licenses(spark):
    assert len(licenses.signatures()) > 250
    docs = table(spark, [(i, t, "", "", 0) for i, (t, _) in enumerate(LICENSED)] + [(5, LICENSED[5][0], "", "", 0)])
    got = licenses.license_report(docs).collect()
    assert len(got) == len(LICENSED) + 1
    for r in got:
        text, labels = LICENSED[r.doc_id]
        n, places = plain_phrases(text)
        if r.doc_id != 12:
            assert set(filter(None, r.labels.split(","))) == labels, text
        assert (r.n_words, r.n_base) == (n, len(places)) and r.base_labels == ",".join(sorted({x for _, x in places}))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert licenses.license_report(table(spark, [])).count() == 0
    wide, names = licenses.scan(docs.selectExpr("*", "1 AS n_words", "2 AS labels", "3 AS score"))
    assert wide.where("n_words = 1 AND labels = 2 AND score = 3").count() == len(LICENSED) + 1 and len(set(names)) == 6


def test_phrases_of_random_words():
    draw = np.random.default_rng(9)
    words = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "x", "CC", "By", "é", "ccx", "-", "9"]
    for _ in range(2_000):
        text = " ".join(words[i] for i in draw.integers(0, len(words), 12))
        assert licenses.phrase_places(text.encode().lower()) == plain_phrases(text)


def test_suppression_by_priority_and_containment():
    rule = lambda p: licenses.Signature(f"r{p}", "", "", p, 1.0)
    draw = np.random.default_rng(3)
    for _ in range(300):
        found = [(rule(int(p)), int(a), int(a + n)) for p, a, n in zip(draw.integers(0, 9, 12), draw.integers(0, 30, 12), draw.integers(1, 15, 12))]
        kept = []
        for d in sorted(found, key=lambda d: (d[0].priority, d[1], -d[2])):
            if not any(k[1] <= d[1] and d[2] <= k[2] for k in kept):
                kept.append(d)
        assert licenses.suppressed(found) == kept


# pages

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<ul><li>a<li>b<ul><li>c</ul></ul>d", "- a\n- b\n  - c\n\nd"),
    ("<ol start=3><li>x</li><li>y</ol>", "3. x\n4. y"), ("<table><tr><td>a<td>bb<tr><th>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide     z\na     b  c"),
    ("<script>var a = '</p>';</script>x<style>p{}</style>", "x"), ("<title>t</title><h1>h</h1>x", "h\n\nx"),
    ("a<br>b<br><br>c", "a\nb\n\nc"), ("<pre>x\n  y\n\nz</pre>", "x\n  y\n\nz"), ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
    ("a &amp; b &lt;c&gt; &copy;&nbsp;d", "a & b <c> ©\xa0d"), ("x <b>y</b>  z\n\n w", "x y z w"), ("<div>a</div><div>b</div>", "a\nb"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<a href='x>y'>in</a> out", "in out"), ("<!-- no --><p>a<!-- <p> -->b</p>", "ab"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("</p></div>x</li>", "x"), ("<b>bold<p>para</b>more", "bold\n\npara\n\nmore"), ("<img alt=pic src=x> y", "pic y"),
    ("<td>loose</td><td>cells</td>", "loose\ncells"), ("<p>é<wbr>è", "éè"), ("<unclosed", "<unclosed"),
    ("<table><caption>cap</caption><tr><td><table><tr><td>in</table><td>out</table>", "cap\nin  out"),
])
def test_rendering(page, text):
    got = html_text.render(page)
    assert got == text or (text == "bold\n\npara\n\nmore" and got.split() == text.split())


@pytest.mark.parametrize("page, text", [
    ("<div hidden>a<br>secret</div>x", "x"), ("<div hidden>a<img alt=pic>secret</div>x", "x"), ("<video><source src=x>no support</video>x", "x"),
    ("<pre hidden>a<br>b</pre><p>x   y</p>", "x y"), ("<ol start=4><li>a<ul hidden><li>b<br>c</ul><li>d</ol>", "4. a\n5. d"),
    ("<table><tr><td>a<table hidden><tr><td>b<br>c<img alt=d></table><td>e</table>", "a  e"), ("<div style='display:none'>a<input>b<hr>c</div>x", "x"),
])
def test_void_elements_in_hidden_ones(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("a<svg><title>no</title><defs><text>no</text></defs><g><text x=1>Sales &amp; tax</text><text>2020<title>no</title></text></g>no</svg>b", "a Sales & tax 2020 b"),
    ("<svg><text><tspan x=0>one</tspan><tspan x=0>two</tspan><tspan dy=1>s</tspan></text><text display=none>no</text></svg>", "one twos"),
    ("<svg><style/><title/><path d='M0'/><text><![CDATA[p < q > r]]></text></svg>z", "p < q > r z"), ("<svg><text>l</text><p>out</p>", "l\n\nout"),
    ("<p>x<svg><foreignObject><div>in <b>box</b></div></foreignObject><desc>no</desc></svg>y", "x\nin box\ny"), ("<svg><path d='M0'></svg>x", "x"),
    ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>.", "so x= 1 2 ."),
    ("<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation>no</annotation></semantics></math>", "E=m"),
    ("a<textarea>\nb  c\n  &lt;d></textarea>e", "a\nb  c\n  <d>\ne"), ("<div hidden><textarea>no</textarea><select><option>no</select></div>x", "x"),
    ("size <select><option>S<option selected>M<option>L</select> now", "size M now"), ("<select><option disabled>pick<option>S<option>L</select>", "S"),
    ("<select><optgroup label=no><option label=short>long</option></optgroup></select>", "short"), ("<select>no<option disabled>a</select>", "a"),
    ("a<select multiple><optgroup label=g><option>b<option>c</select>d", "a\ng\nb\nc\nd"), ("<table><tr><td><select><option>a<td>b</table>", "a  b"),
    ("<select/><option>a</select>b", "a b"), ("<datalist><option>no</datalist>x", "x"), ("<textarea>", ""), ("<select><option>a", "a"),
])
def test_text_of_drawings_formulas_and_forms(page, text):
    assert html_text.render(page) == text


def test_all_visible_words_stay(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_text.html_report(pages).collect()}
    from html import unescape
    for r in pages.collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r.html)
        words = re.sub(r"[ \t\n\r\f]+", " ", unescape(re.sub(r"<(?=[a-zA-Z/!])[^>]*>", " ", body))).split()
        marks = re.compile(r"^(-|\d+\.)$")
        assert [w for w in got[r.page_id].split() if not marks.match(w)] == [w for w in words if not marks.match(w)]


def test_deep_and_long_pages(spark):
    assert html_text.render("<div>" * 20_000 + "x") == "x"
    assert html_text.render("<table><tr><td>" * 500 + "x") == "x"
    assert html_text.render("<a '" * 5_000) == ("<a '" * 5_000)
    rows = [(1, "u", "<p>" + "w " * 100_000), (1, "u", None), (None, None, "x")]
    out, name = html_text.extract(table(spark, rows, "page_id long, url string, html string").selectExpr("*", "1 AS text"))
    assert out.count() == 3 and name != "text" and "text" in out.columns
    assert html_text.html_report(table(spark, [], "page_id long, url string, html string")).count() == 0


# toxicity

def toxic_rows(n=900):
    rows, marks = [], []
    words = ["idiot", "clown", "scum", "trash"]
    for i in range(n):
        text = prose(2_000 + i, 25)
        if i % 6 == 0:
            text += f" you {words[i // 6 % 4]} {words[i // 12 % 4]}"
        rows.append((i, text, "en", "s", 0))
        marks.append((i, 1, int(i % 6 == 0)))
    return rows, marks


def test_toxicity(spark):
    rows, marks = toxic_rows()
    labels = table(spark, marks[:600], "doc_id long, quality int, toxic int")
    extra = [(2_000, None, None, None, None), (2_001, "", "", "", 0), (None, "an IDIOT and a clown", "", "", 0), (899, rows[899][1], "", "", 0),
             (2_002, prose(5, 30_000), "en", "s", 0)]
    docs = table(spark, rows + extra)
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r[c] <= 1 for r in got for c in ("p_insult", "p_contempt", "p_toxic"))
    wrong = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.toxic != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 3
    assert not any(r.toxic for r in got if r.doc_id in (2_000, 2_001, 2_002)) and all(r.toxic for r in got if r.doc_id is None)
    kinds = {r.doc_id: (r.p_insult, r.p_contempt) for r in got}
    assert kinds[0][0] > 0.5 > kinds[1][0] and kinds[36][1] > 0.5 > kinds[1][1]


def test_the_chain_feeds_earlier_probabilities(spark):
    rows, marks = toxic_rows(300)
    settings = toxicity.Toxicity()
    chain = toxicity.fit_chain(table(spark, rows), table(spark, marks, "doc_id long, quality int, toxic int"), settings)
    width = len(chain.vocabulary) + 2
    assert [len(w) for w in chain.models] == [width + 1, width + 2, width + 3] and chain.models[2][-3] > 0
    assert {b"idiot", b"clown", b"scum", b"trash"} <= set(chain.vocabulary)


def test_toxicity_without_labels(spark):
    docs = table(spark, toxic_rows(12)[0]).selectExpr("*", "1 AS toxic", "2 AS p_toxic")
    labels = table(spark, [(1, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_report(docs, labels).where("toxic").count() == 0
    assert toxicity.toxicity_report(table(spark, [], DOCS), labels).count() == 0
    chain = toxicity.fit_chain(docs, labels)
    assert toxicity.score(docs, chain)[1][-1] != "toxic"
