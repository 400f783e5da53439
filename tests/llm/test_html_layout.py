"""Layout of tables and lists, and the tree builder against one that walks its whole stack."""

import random
import time

import pytest

from tabwright.llm import html_text
from tabwright.llm.html_text import Layout, aligned, render


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td><h2>Title</h2><p>First</p><p>para.</p><td>side<br>bar</table>", "Title  side\n       bar\nFirst\n\npara."),
    ("<table><tr><td><ul><li>one<li>two</ul><td><pre>a\n b</pre></table>", "- one  a\n- two   b"),
    ("<table><tr><td><table><tr><td>a<td>b<tr><td>c<td>d</table><td>x</table>", "a  b  x\nc  d"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"), ("<table><tr><td>A<td rowspan=0>B<tr><td>C<td>D<tr><td>E<td>F</table>", "A  B\nC     D\nE     F"),
    ("<table><tr><td colspan=2 rowspan=2>AA<td>x<tr><td>y<tr><td>1<td>2<td>3</table>", "AA    x\n      y\n1   2  3"),
    ("<details>no<summary>S</summary>no<p>no</p></details>x", "S\nx"), ("<details open><summary>S</summary><p>yes</details>x", "S\n\nyes\n\nx"),
    ("<details><summary>S</summary><br><img alt=no><ul><li>no</ul></details>x", "S\nx"), ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>", "ab"),
    ("<ol><li>x<li value=5>y<li>z</ol>", "1. x\n5. y\n6. z"), ("<ol><li value=-2>x<li value=no>y</ol>", "-2. x\n-1. y"), ("a <progress>50 %</progress><meter>no</meter>b", "a b"),
    ("<table><tr><td><tr><td>a</table>", "a"), ("<table><tr><td rowspan=3><tr><td>a</table>", "  a"),
])
def test_layout(page, text):
    got = render(page)
    # the width of a column of several lines is that of its longest
    assert [x.split() for x in got.split("\n")] == [x.split() for x in text.split("\n")]
    assert "rowspan" not in page or got == text or "colspan" in page


def plain_grid(rows):
    """Cells at their places by marking every place that is covered."""
    used, out = set(), {}
    for r, row in enumerate(rows):
        c = 0
        for lines, wide, down in row:
            while (r, c) in used:
                c += 1
            out[r, c] = lines
            used |= {(r + i, c + j) for i in range(min(down, len(rows) - r)) for j in range(wide)}
            c += wide
    return out


def test_random_tables_keep_their_columns():
    draw = random.Random(5)
    for _ in range(300):
        rows = [[([f"{r}.{c}." + "x" * draw.randint(0, 6) for _ in range(draw.randint(0, 3))], draw.choice([1, 1, 2, 3]), draw.choice([1, 1, 2, 4]))
                 for c in range(draw.randint(0, 5))] for r in range(draw.randint(1, 6))]
        grid = plain_grid(rows)
        widths = {}
        for (_, c), lines in grid.items():
            widths[c] = max([widths.get(c, 0), *map(len, lines)])
        starts, at = {}, 0
        for c in range(max(widths, default=-1) + 1):
            starts[c] = at
            at += widths.get(c, 0) + 2
        want = []
        for r in range(len(rows)):
            mine = {c: lines for (q, c), lines in grid.items() if q == r}
            for i in range(max([0, *map(len, mine.values())])):
                line = ""
                for c in sorted(mine):
                    if i < len(mine[c]):
                        line = line.ljust(starts[c]) + mine[c][i]
                want.append(line)
        assert aligned(rows) == want


def test_widest_and_padding():
    rows = [[(["a" * 100], 1, 1), (["b"], 1, 1)], [(["c"], 1, 1), (["d"], 1, 1)]]
    assert aligned(rows)[1] == "c" + " " * 101 + "d" and aligned(rows, Layout(widest=10))[1] == "c" + " " * 11 + "d"
    assert aligned(rows, Layout(padding=50))[1] == "c" + " " * 61 + "d"
    assert len(render("<table>" + f"<tr><td>{'w' * 200_000}<td>x" + "<tr><td>a<td>b" * 20_000 + "</table>")) < 3_000_000


def test_columns_are_as_wide_in_long_tables():
    rows = [[(["a" * 100], 1, 1), (["b"], 1, 1)]] + [[(["c"], 1, 1), (["d"], 1, 1)]] * 45_000
    assert aligned(rows)[:2] == aligned(rows[:2]) and aligned(rows)[-1] == "c" + " " * 101 + "d"


def plain_events(tags):
    """Names that open and close, by walks over the whole stack."""
    stack, out = [], []

    def close(to):
        while len(stack) > to:
            out.append(("close", stack.pop()))

    def nearest(names, stop):
        found = -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in names:
                found = i
            elif stack[i] in stop:
                break
        return found

    for end, name in tags:
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] == name:
                    close(i)
                    break
                if stack[i] in html_text.SCOPE and name not in html_text.REACHING:
                    break
            continue
        if name in html_text.ENDS_P and (i := nearest({"p"}, html_text.SCOPE)) >= 0:
            close(i)
        if name in html_text.IMPLIED and (i := nearest(*html_text.IMPLIED[name])) >= 0:
            close(i)
        out.append(("open", name))
        stack.append(name)
    close(0)
    return out


def test_random_tags_build_the_same_tree():
    draw = random.Random(9)
    names = "p div ul ol li table tr td th tbody thead dl dt dd b i span button section h1 caption".split()
    for _ in range(3_000):
        tags = [(draw.random() < 0.4, draw.choice(names)) for _ in range(draw.randint(1, 40))]
        page = "".join(f"</{n}>" if end else f"<{n}>" for end, n in tags)
        assert [e[:2] for e in html_text.events(page)] == plain_events(tags), page


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</b>" * 100_000, "<head>" + "<div>" * 100_000 + "</nothing>" * 100_000, "<p><b>" * 80_000, "<li><b>" * 80_000,
                                  "<svg>" + "<g>" * 100_000 + "</b>" * 100_000, "<table>" + "<b>" * 80_000 + "</td>" * 100_000])
def test_malformed_pages_take_linear_time(page):
    start = time.perf_counter()
    for _ in html_text.events(page):
        pass
    assert time.perf_counter() - start < 6
