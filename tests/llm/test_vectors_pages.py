import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartloom.llm import html_main, knn


def brute(rows, k, every):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in whole if i % every == 0}):
        query = next(v for j, v in whole if j == i)
        scored = sorted((-sum(a * b for a, b in zip(query, v, strict=False)), j) for j, v in whole if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return out


def test_top_k(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(i % 4, 1, 6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 420)] + [(1000, [0.25, 1.0]), (1001, None), (1002, [None] * 6), (1003, [float("nan")] * 6), (None, [1.0] * 6), (1005, [])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, v string")
    got = knn.top_k(frame, F.col("vec_id") % 20 == 0, knn.Join(pivots=12, chunk=30, block=4))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 20)
    few = frame.filter("vec_id in (0, 1, 1001)")
    assert [tuple(r)[:3] for r in knn.top_k(few, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1)]
    assert knn.top_k(frame.filter("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_are_exact(spark):
    rows = [(i, [1.0e6 + i, -2.0e6, 1.0]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in knn.top_k(frame, F.col("vec_id") % 5 == 0).collect()) == brute(rows, 5, 5)


def test_main_text(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>More</a></li></ul></nav>"
        '<div class="ad">Buy this now.</div><article><h1>Head &amp; line</h1><p><b>First  part\n of it, two.<br><p>Second <i>p</i>art &lt;b&gt;, with words.</p>'
        '<script>var x="</p>";</script></article><footer>&copy; me</footer></body>'
    )
    frame = spark.createDataFrame(
        [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<p", "x"), (1, "u", page, "x")], "page_id bigint, url string, html string, text string"
    )
    rows = [tuple(r) for r in html_main.extract(frame).collect()]
    text = "Head & line First part of it, two. Second part <b>, with words."
    assert rows[0] == rows[4] == (1, "u", text, len(text))
    assert rows[1] == (2, None, "", 0) and rows[2] == (3, "u", "", 0) and rows[3][0] is None
    assert html_main.extract(frame.filter("page_id > 9")).count() == 0


def test_held_out_layouts():
    forest, draw, right = html_main.model(), random.Random(77), 0
    for _ in range(60):
        page = html_main.parse(html_main.sample_page(draw))
        wanted = np.array(["data-main" in a for a in page.attributes])
        for i in range(len(wanted) - 1, 0, -1):
            wanted[page.parents[i]] |= wanted[i]
        kept = html_main.decode(forest.logits(html_main.features(page)), page.parents)
        right += html_main.kept_text(page, kept) == html_main.kept_text(page, wanted)
        assert all(kept[page.parents[i]] for i in range(1, len(kept)) if kept[i])
    assert right >= 57


def test_decoding_keeps_ancestors():
    assert html_main.decode(np.array([5.0, -1.0, 4.0, -6.0, 1.0]), [-1, 0, 1, 0, 3]).tolist() == [True, True, True, False, False]


@given(st.text(alphabet="<>\"'a ", max_size=25))
@settings(max_examples=300, deadline=None)
def test_tags_end_like_a_plain_pattern(text):
    plain, ends = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""), html_main._TagEnds(text)
    for at in range(len(text)):
        found = plain.match(text, at)
        assert ends.tag(at) == (found.end() - 1 if found else -1)


@given(st.lists(st.tuples(st.booleans(), st.sampled_from("div p li td tr b i span".split())), max_size=30))
@settings(max_examples=300, deadline=None)
def test_open_elements_like_a_plain_walk(steps):
    plain, stack = ["#root"], html_main._Open()
    stack.push(0, "#root")
    for ends, tag in steps:
        inline = tag in html_main.INLINE
        if ends:
            stack.end_tag(tag)
        elif not inline:
            stack.start_block(tag)
        group = html_main.SAME.get(tag)
        for depth in range(len(plain) - 1, 0, -1) if ends or not inline else ():
            name = plain[depth]
            if name == tag if ends else name == "p" or (group and html_main.SAME.get(name) == group):
                del plain[depth:]
                break
            if name not in html_main.INLINE and (inline or not ends):
                break
        if not ends:
            stack.push(0, tag)
            plain.append(tag)
        assert stack.names == plain


@pytest.mark.parametrize("page", ["<a " * 1_700_000, "<!" * 2_500_000, "<a \"<a '" * 600_000 + ">", "<div>" * 200_000 + "</section></em>" * 250_000, "<b>" * 200_000 + "<hr></i>" * 500_000])
def test_broken_pages_of_megabytes_end(page):
    parsed = html_main.parse(page)
    assert sum(len(text) for _, text in parsed.pieces) + sum(len(t) + len(a) + 2 for t, a in zip(parsed.tags[1:], parsed.attributes[1:])) <= len(page)
