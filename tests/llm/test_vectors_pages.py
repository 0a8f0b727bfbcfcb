import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custbehav.llm import html, vectors
from custbehav.llm.components import components
from tests.llm.conftest import prose


def brute(ids, units, threshold=0.9):
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label, np.array([label[row].min() if row.any() else label[i] for i, row in enumerate(near)]))
        if (least == label).all():
            return near.sum(axis=1), np.array(ids)[label]
        label = least


def test_vectors(spark):
    draw = np.random.default_rng(1)
    rows = list(draw.standard_normal((300, 16)))
    for spread, count in ((0.05, 150), (0.16, 60), (0.02, 2), (0.02, 2)):
        centre = draw.standard_normal(16)
        rows += [centre + spread * np.linalg.norm(centre) / 4 * draw.standard_normal(16) for _ in range(count)]
    chain = [np.eye(16)[0] * np.cos(a) + np.eye(16)[1] * np.sin(a) for a in np.arange(0, 3, 0.4)]
    rows += chain + [rows[0]] * 3 + [rows[1] * 2.5]
    values = [[float(x) for x in row] for row in rows]
    units = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    ids = list(range(len(values)))
    n_links, component = brute(ids, units)
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] + [1.0] * 15, [], [1.0, 2.0]]
    frame = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)] + [(1000 + i, v) for i, v in enumerate(odd)], "vec_id long, embedding array<double>"
    )
    found = {r.vec_id: r for r in vectors.near_duplicates(frame.withColumn("node", F.lit(0)).repartition(5)).collect()}
    assert len(found) == len(values) + len(odd)
    assert [found[i].n_links for i in ids] == n_links.tolist()
    assert [found[i].component_id for i in ids] == component.tolist()
    for i in range(len(odd)):
        assert found[1000 + i][1:] == (0, 1000 + i, True)


def test_no_vectors_and_repeated_ids(spark):
    kind = "vec_id long, embedding array<float>"
    assert vectors.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (1, [0.0, 1.0]), (7, None)], kind)
    found = sorted(map(tuple, vectors.near_duplicates(frame).collect()), key=repr)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (1, 0, 1, True), (7, 0, 7, True)], key=repr)


def test_wide_components_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "_BLOCK", 8)
    angles = np.linspace(0, 2.5, 90)
    values = [[float(np.cos(a)), float(np.sin(a)), 0.0] for a in angles]
    n_links, _ = brute(list(range(90)), np.array(values))
    found = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>")).collect()}
    assert [found[i].n_links for i in range(90)] == n_links.tolist() and {r.component_id for r in found.values()} == {0}


def test_links_that_the_windows_miss_are_found(spark):
    """One pass and a window of one: nearly all links of isolated pairs and a ring are left to the blocks."""
    draw = np.random.default_rng(8)
    rows = []
    for _ in range(400):
        centre = draw.standard_normal(12)
        rows += [centre, centre + 0.1 * np.linalg.norm(centre) * draw.standard_normal(12)]
    rows += [np.eye(12)[2] * np.cos(a) + np.eye(12)[3] * np.sin(a) for a in np.arange(0, 6.2, 0.42)] + rows[:3]
    values = [[float(x) for x in row] for row in rows]
    units = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    n_links, component = brute(list(range(len(values))), units)
    frame = spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>").repartition(3)
    found = {r.vec_id: r for r in vectors.near_duplicates(frame, passes=1, window=1).collect()}
    assert [found[i].n_links for i in range(len(values))] == n_links.tolist()
    assert [found[i].component_id for i in range(len(values))] == component.tolist()


def test_blocks_of_bounded_number(spark, monkeypatch):
    """Few large blocks, compared by small tiles: a wide group, a dense one, pairs and loose vectors stay exact."""
    monkeypatch.setattr(vectors, "_BLOCK", 8)
    monkeypatch.setattr(vectors, "_MOST_BLOCKS", 6)
    monkeypatch.setattr(vectors, "_TILE", 7)
    draw = np.random.default_rng(5)
    rows = list(draw.standard_normal((120, 6)))
    rows += [np.eye(6)[0] * np.cos(a) + np.eye(6)[1] * np.sin(a) for a in np.linspace(0, 3, 80)]
    rows += [np.eye(6)[4] + 0.03 * draw.standard_normal(6) for _ in range(90)]
    rows += [-np.eye(6)[4] + 0.14 * draw.standard_normal(6) for _ in range(90)]
    values = [[float(x) for x in row] for row in rows]
    units = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    n_links, component = brute(list(range(len(values))), units)
    frame = spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>").repartition(4)
    for options in ({}, {"passes": 1, "window": 1}):
        found = {r.vec_id: r for r in vectors.near_duplicates(frame, **options).collect()}
        assert [found[i].n_links for i in range(len(values))] == n_links.tolist()
        assert [found[i].component_id for i in range(len(values))] == component.tolist()


def test_the_passes_alone_meet_the_modelled_recall(spark):
    """Pairs at the threshold among spread vectors, found by as many passes as the model asks for."""
    draw = np.random.default_rng(11)
    first, other = draw.standard_normal((2, 3000, 24))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    units = np.concatenate((first, 0.901 * first + np.sqrt(1 - 0.901**2) * other))
    rows = [(i, 24, unit.tobytes()) for i, unit in enumerate(units)]
    classes = spark.createDataFrame(rows, "node long, dim long, vector binary")
    for recall in (0.6, 0.95):
        passes = vectors.modelled_passes(len(rows), 16, 0.9, recall)
        found = {tuple(r) for r in vectors.links(classes, 0.9, passes, 16, 1).collect()}
        assert sum((i, i + 3000) in found for i in range(3000)) >= (recall - 0.05) * 3000
    sizes = [vectors.modelled_passes(n, 16, 0.9, 0.95) for n in (0, 10, 10_000, 10**6, 10**9)]
    assert sizes == sorted(sizes) and sizes[0] == 1 and sizes[-1] < 200


def test_spanning_links():
    draw = np.random.default_rng(2)
    for n, m in ((1, 1), (5, 4), (40, 30), (300, 2000)):
        a, b = draw.integers(0, n, (2, m))
        x, y = vectors.spanning(a, b)

        def parts(u, v):
            label = np.arange(n)
            for _ in range(n):
                low = np.minimum(label[u], label[v])
                np.minimum.at(label, u, low)
                np.minimum.at(label, v, low)
            return label

        assert (parts(a, b) == parts(x, y)).all() and set(zip(x, y)) <= set(zip(a, b))
        assert len(x) == n - len(set(parts(a, b).tolist()))


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame([*chain, *[(b, a) for a, b in star], (5, 5), (3, 4), (None, 9)], "a long, b long")
    found = dict(components(links, "a", "b").collect())
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(links.limit(0), "a", "b").collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this.</div><article><h1>%s &amp; more</h1>
<p><b>%s<br><p>%s</p><aside class="promo">Other offers here.</aside><p>%s</article><section id="comments"><p>%s</p></section>
<form><input><button>Send</button></form><footer>&copy; host</footer></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    rows, texts = [], {}
    for i in range(60):
        parts = [prose(i, 5), prose(i + 100, 40), prose(i + 200, 30), prose(i + 300, 25), prose(i + 400, 20)]
        rows.append((i, f"http://h/{i}", PAGE % tuple(p.replace(" ", "\n  ", 1) for p in parts)))
        texts[i] = f"{parts[0]} & more {parts[1]} {parts[2]} {parts[3]}"
    rows += [(60, None, None), (61, "u", ""), (62, "u", "plain <b>text"), (None, "n", rows[0][2]), rows[1]]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), texts


def test_pages(pages):
    frame, texts = pages
    found = html.main_text(frame.withColumn("text", F.lit("x"))).collect()
    assert len(found) == 65 and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id in (60, 61)] == ["", ""]
    same = [r.text == texts[r.page_id] for r in found if r.page_id in texts]
    assert np.mean(same) >= 0.95, [r.text for r in found if r.page_id in texts and r.text != texts[r.page_id]][:1]


@pytest.mark.parametrize(
    "head", ["<title>T</title>", "<title>T</title><noscript><img src=x></noscript><link rel=a>", "<style>p{}</style><title>T</title>\n", ""]
)
@pytest.mark.parametrize("start", ["<body><p>", "<p>", "<body>", "", "<img src=x>"])
def test_a_head_without_its_end_tag(head, start):
    found = html.blocks(f"<!DOCTYPE html><html><head><meta charset=utf-8>{head}{start}The text.</p><div>More.</div>")
    assert [block[0] for block in found] == ["The text.", "More."]
    hidden = html.blocks(f"<html><head>{head}<template><div>no</div></template></head>{start}The text.")
    assert [block[0] for block in hidden] == ["The text."]


@pytest.mark.parametrize("start, end", [("<main>", "</main>"), ('<div class="content">', "</div>")])
def test_no_page_has_an_article_tag(pages, start, end):
    frame, texts = pages
    other = F.replace(F.replace("html", F.lit("<article>"), F.lit(start)), F.lit("</article>"), F.lit(end))
    found = html.main_text(frame.withColumn("html", other)).collect()
    same = [r.text == texts[r.page_id] for r in found if r.page_id in texts]
    assert np.mean(same) >= 0.9, [r.text for r in found if r.page_id in texts and r.text != texts[r.page_id]][:1]


def test_pages_too_short_or_too_long_to_train_on(spark):
    """Only long pages: one with its text behind 20,000 characters of style, so none of it is in the sample."""
    page = "<html><head><style>" + "p{margin:0}" * 2_000 + "</style></head><body><nav><a href=/>Menu</a></nav><article><p>" + prose(1, 60) + "</p></article></body></html>"
    found = html.main_text(spark.createDataFrame([(1, "u", page), (2, "u", "")], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {1: prose(1, 60), 2: ""}


def test_training_without_labels_fails():
    with pytest.raises(ValueError):
        html.fit([[("words", 0, "p", frozenset(), 0)]])


def test_no_pages(spark):
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_field_on_other_layouts():
    texts = [[prose(1000 * t + k, 6 + 9 * k) for k in range(6)] for t in range(160)]
    others = [line for lines in texts for line in lines]
    made = [html.blocks(html.layout(lines, others, seed), labelled=True) for seed, lines in enumerate(texts * 3)]
    model = html.fit(made[:400], rounds=120)
    right = total = 0
    for page in made[400:]:
        labels = model.decode(page)
        right += sum(label == block[4] for label, block in zip(labels, page))
        total += len(page)
    assert right / total > 0.97


def test_pages_that_would_raise_or_look_labelled(spark):
    """Attributes and declarations of untrusted pages are text, whatever they say."""
    hostile = [
        '<script data-main="scripts/main" src="require.js"></script><div data-main="x"><p>Some words here.</p></div>',
        "<![foo[x]]><p>Some words here.</p>", "<![CDATA[ x > y ]]>", "<![", "<!", "<!-", "<![if IE]>a<![endif]>", "<!DOCTYPE [<!ENTITY a 'b'>]>",
        "<?xml", "<?php echo '>' ?>", "</", "<p", "<a href=", "&#xFFFFFFFF; &#0; &bogus;", "<!ELEMENT br EMPTY>", "<" * 5_000, "</p" * 500,
        "<div>" * 3_000 + "deep", "".join(f'<div class="{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}">' for i in range(300)) + "deep", "\x00<\x00p>",
    ]
    assert html.blocks(hostile[0])[0][4] == 0 and [b[0] for b in html.blocks(hostile[1])] == ["Some words here."]
    draw = random.Random(8)
    pieces = ["<", "<!", "<![", "]]>", ">", "--", "[", "]", "</", "p", " a=", '"', "'", "&#", ";", "<script>", "</script>", "<style>", "<title>", "x"]
    hostile += ["".join(draw.choice(pieces) for _ in range(30)) for _ in range(3_000)]
    for page in hostile:
        html.blocks(page)
    good = "<html><body><nav><a href=/>Menu</a></nav><article><p>" + prose(2, 60) + "</p></article></body></html>"
    rows = [(i, "u", page) for i, page in enumerate([*hostile[:40], good, good, None])]
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 43 and [r.text for r in found if r.page_id in (40, 41)] == [prose(2, 60)] * 2


def test_the_sample_takes_a_repeated_page_once(spark):
    page = "<article><p>" + prose(2, 60) + "</p></article>"
    rows = [(page,)] * 500 + [(f"<article><p>{prose(10 + i, 30)}</p></article>",) for i in range(5)] + [(None,)]
    sample = html.labelled_pages(spark.createDataFrame(rows, "html string").repartition(7), most_pages=6, layouts=0)
    assert sorted(b[0][0] for b in sample) == sorted([prose(2, 60), *(prose(10 + i, 30) for i in range(5))])


def test_the_fit_is_the_maximum():
    """The penalised log-likelihood, by enumeration of all labellings, does not grow in any direction."""
    import itertools

    pages = [
        [(f"{prose(k, n)}", 0, "p", frozenset({f"m{k % 2}"}), y) for k, (n, y) in enumerate(page)]
        for page in ([(3, 0), (9, 1), (4, 0)], [(12, 1), (2, 1)], [(3, 1), (8, 0), (2, 0), (20, 1)], [(5, 0)])
    ]
    model = html.fit(pages, rounds=4_000, decay=0.05)

    def value(weights, transitions):
        total = 0.0
        for page in pages:
            scores = [weights[html.features(b, i, len(page))].sum() for i, b in enumerate(page)]
            path = lambda ys: sum(s for s, y in zip(scores, ys) if y) + sum(transitions[a, b] for a, b in zip(ys, ys[1:]))
            every = [path(ys) for ys in itertools.product((0, 1), repeat=len(page))]
            total += path([b[4] for b in page]) - np.logaddexp.reduce(every)
        return total / len(pages) - 0.025 * ((weights**2).sum() + (transitions**2).sum())

    best, draw = value(model.weights, model.transitions), np.random.default_rng(3)
    for _ in range(20):
        step, turn = 0.01 * draw.standard_normal(len(model.weights)), 0.01 * draw.standard_normal((2, 2))
        assert value(model.weights + step, model.transitions + turn) < best


def test_viterbi_is_the_best_path():
    import itertools

    draw = np.random.default_rng(4)
    page = html.blocks("<div class=a><p>one</p><nav>two</nav><p>three words here</p><footer>four</footer></div>")
    for _ in range(30):
        model = html.Model(draw.standard_normal(1 << 12), draw.standard_normal((2, 2)))
        scores = [model.weights[html.features(b, i, len(page))].sum() for i, b in enumerate(page)]

        def total(labels):
            return sum(s for s, y in zip(scores, labels) if y) + sum(model.transitions[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(page)), key=total)
        assert total(model.decode(page)) == pytest.approx(total(best))
