"""Layout of generated trees against a renderer of its own, deep pages, spans, lists and inherited visibility."""

from __future__ import annotations

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerweave.llm.html_text import html_to_text


@pytest.mark.parametrize("tag", ["div", "b", "blockquote", "section"])
@pytest.mark.parametrize("deep", [201, 1000])
def test_depth_changes_nothing(tag, deep):
    inner = "<p>seen</p><script>var secret=1</script><p style='display:none'>hidden</p><ul><li>a<li>b</ul>"
    pad = "  " * deep if tag == "blockquote" else ""
    assert html_to_text(f"<{tag}>" * deep + inner) == "\n".join((pad + x).rstrip() if x else "" for x in ("seen", "", "- a", "- b"))


def test_very_deep_pages():
    inner = "<p>seen</p><script>no()</script><p hidden>no</p><ul><li>a</ul>"
    start = time.time()
    assert html_to_text("<div>" * 100_000 + inner) == "seen\n\n- a"
    assert html_to_text("<pre>" + "<span>" * 100_000 + "x") == "x"
    assert html_to_text("<ul><li>" * 1500 + "x").strip(" -") == "x"
    assert html_to_text("<table><tr><td>" * 1500 + "x") == "x"
    assert html_to_text("<title>" + "t" * 10 + "</title>" + "<i>" * 50_000 + "y") == "y"
    assert time.time() - start < 60


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td>x<td rowspan=3>tall<td>y<tr><td>1<td>2<tr><td>3<td>4</table>", "x  tall  y\n1        2\n3        4"),
        ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide     z\na     b  c"),
        ("<table><tr><td colspan=150>w<td>z<tr><td>a<td>b</table>", "w     z\na  b"),
        ("<table><tr><td colspan=1000000000>w<td>z</table>", "w  z"),
        ("<table><tr><td rowspan=0>r<td>1<tr><td>2<tr><td>3</table>", "r  1\n   2\n   3"),
        ("<table><tbody><tr><td rowspan=9>r<td>1<tbody><tr><td>a<td>b</table>", "r  1\na  b"),
        ("<table><tr><td rowspan=2 colspan=2>q<td>1<tr><td>2<tr><td>x<td>y<td>z</table>", "q     1\n      2\nx  y  z"),
        ("<ol start=5><li>a<li value=9>b<li>c</ol>", "5. a\n9. b\n10. c"),
        ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
        ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"),
        ("<ol type=I start=4><li>x<li type=i>y</ol>", "IV. x\nv. y"),
        ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes</p>no</div>", "yes"),
        ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
        ("<p style='visibility:hidden'>no <img alt=no> <select><option>no</select></p>ok", "ok"),
        ("<p style='visibility:hidden'>no <b>no <i style='visibility:visible'>yes</i></b>", "yes"),
        ("<p style='visibility:hidden; visibility:visible'>yes", "yes"),
    ],
)
def test_spans_lists_and_visibility(html, text):
    assert html_to_text(html) == text


# --- generated trees: (kind, children or text) ---------------------------------------------------------------------------
leaf = st.sampled_from(["ab", "c", "dé"])
trees = st.recursive(
    st.tuples(st.just("p"), leaf),
    lambda inner: st.one_of(
        st.tuples(st.sampled_from(["div", "section", "quote", "gone", "veil", "show"]), st.lists(inner, max_size=3)),
        st.tuples(st.sampled_from(["ul", "ol"]), st.lists(leaf, min_size=1, max_size=3)),
        st.tuples(st.just("table"), st.lists(st.lists(leaf, min_size=1, max_size=3), min_size=1, max_size=3)),
    ),
    max_leaves=12,
)
OPEN = {"quote": "<blockquote>", "gone": "<div style='display:none'>", "veil": "<div style='visibility:hidden'>", "show": "<div style='visibility:visible'>"}


def markup(t):
    kind, inner = t
    if kind == "p":
        return f"<p>{inner}</p>"
    if kind in ("ul", "ol"):
        return f"<{kind}>{''.join(f'<li>{x}' for x in inner)}</{kind}>"
    if kind == "table":
        return f"<table>{''.join('<tr>' + ''.join(f'<td>{x}' for x in row) for row in inner)}</table>"
    end = "blockquote" if kind == "quote" else "section" if kind == "section" else "div"
    return OPEN.get(kind, f"<{kind}>") + "".join(map(markup, inner)) + f"</{end}>"


def paragraphs(t, veiled=False):
    """Groups of lines, each a block with a margin; so blocks are parted by one blank line."""
    kind, inner = t
    if kind in ("p", "ul", "ol", "table"):
        if veiled:
            return []
        if kind == "p":
            return [[inner]]
        if kind == "table":
            sizes = [max((len(row[k]) for row in inner if k < len(row)), default=0) for k in range(max(map(len, inner)))]
            return [["  ".join(x.ljust(n) for x, n in zip(row + [""] * (len(sizes) - len(row)), sizes, strict=True)).rstrip() for row in inner]]
        return [[(f"{k + 1}. " if kind == "ol" else "- ") + x for k, x in enumerate(inner)]]
    if kind == "gone":
        return []
    veiled = True if kind == "veil" else False if kind == "show" else veiled
    out = [b for x in inner for b in paragraphs(x, veiled)]
    if kind == "quote":
        out = [["  " + line for line in b] for b in out]
    return out


@given(st.lists(trees, max_size=4))
@settings(max_examples=400, deadline=None)
def test_generated_trees_equal_a_plain_renderer(parts):
    want = "\n\n".join("\n".join(b) for x in parts for b in paragraphs(x))
    assert html_to_text("".join(map(markup, parts))) == want
