"""The corpus operators on rows that are hard: nulls, empties, ties, repeats, clashes."""

import collections
import hashlib
import itertools
import json
import math
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedmerge.llm import (
    decontaminate,
    embed_dedup,
    html_extract,
    langid,
    minhash_dedup,
    mixing,
    pii,
    quality,
    sharding,
    toxicity,
)
from feedmerge.llm.common import ByteTables, PowerTable, Scratch, Words, held_out, logistic
from feedmerge.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, pii string, _slot int, _size int"
LONG = "lorem ipsum dolor " * 20_000


def documents(spark, rows):
    """Rows (doc_id, text, lang, source), with columns that clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, 0.5, "x", 3, 4) for r in rows], DOCS)


HARD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, "   \n\t ", "en", "a"),
    (4, "one", "en", None),
    (5, LONG, "en", "b"),
    (6, LONG, "en", "b"),
    (6, LONG, "en", "b"),
    (None, "no id here at all, none", "en", "a"),
    (7, "a b c d e f g", "en", "a"),
    (8, "A B C D E F G", "de", "b"),
    (9, "퟿ é ß 日本語 \U0001f600", None, "é"),
]


# Shared parts


def test_word_hashes_follow_words_and_not_spacing():
    texts = pa.array(["Aa b  C\nd", None, "", "aa B c d", "x aa b", " c d "])
    words = Words(texts, ByteTables.not_space(), PowerTable())
    assert (words.ends - words.starts).tolist() == [4, 0, 0, 4, 3, 2]
    ones, pairs = words.hashes(1), words.hashes(2)
    assert ones[:4].tolist() == ones[4:8].tolist()
    assert pairs[0] == pairs[4] == pairs[9] and pairs[2] == pairs[6] == pairs[11]
    assert len(set(ones.tolist())) == 5


def test_held_out_fold(spark):
    import zlib

    ids = [1, 2, 3, 10, 11, 123456789]
    got = spark.createDataFrame([(i,) for i in ids], "i bigint").select(held_out(F.col("i"))).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    loop = [(200, 200), (201, 202), (202, 201)]
    links = spark.createDataFrame(path + star + loop, "a bigint, b bigint")
    got = {r.id: r.component_id for r in components(links, Scratch(spark, "cc")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 160), 100), 201: 201, 202: 201}
    assert components(links.limit(0), Scratch(spark, "cc")).count() == 0


def test_logistic_separates():
    x = np.column_stack([np.ones(400), np.linspace(-2, 2, 400)])
    w = logistic(x, (x[:, 1] > 0.5).astype(int), 0.375)
    assert w[1] > 3


# 1 toxicity


def test_chain_equals_all_paths():
    rng = np.random.default_rng(3)
    start, move = rng.normal(size=2), rng.normal(size=(2, 2))
    sizes = [1, 5, 3, 8]
    scores = rng.normal(size=sum(sizes)) * 3
    first = np.zeros(len(scores), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    got = toxicity.chain(scores, first, start, move)
    want, at = [], 0
    for n in sizes:
        s, weight = scores[at : at + n], np.zeros((n, 2))
        for path in itertools.product((0, 1), repeat=n):
            total = start[path[0]] + sum(move[a, b] for a, b in itertools.pairwise(path)) + sum(x for x, y in zip(s, path) if y)
            for t, y in enumerate(path):
                weight[t, y] += math.exp(total)
        want += (weight[:, 1] / weight.sum(axis=1)).tolist()
        at += n
    assert np.allclose(got, want)
    long = toxicity.chain(np.tile(scores, 50), np.tile(first, 50), start, move)
    assert np.allclose(long, np.tile(want, 50))


def test_offsets_hold_where_lower_case_is_longer():
    text = "İİ İstanbul zyrkon"
    words = toxicity.TOKEN.findall(toxicity.lowered(text))
    found = toxicity.spans(text, np.array([0.0] * (len(words) - 1) + [0.9]))
    assert [text[s["start"] : s["end"]] for s in found] == ["zyrkon"]


def toxic_corpus(n=240, seed=1):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(300)]
    bad = ["zyrkon", "zyrkish", "vuntle", "qrobble"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(20, 60))
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_finds_held_out_documents_and_their_spans(spark):
    rows, labels = toxic_corpus()
    docs = documents(spark, [*rows, (9001, None, None, None), (9002, "", "en", "s"), (9002, LONG, "en", "s")])
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (77777, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.classify(docs, marks)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    by = {(r.doc_id, i): r for i, r in enumerate(got.orderBy("doc_id").collect())}
    assert len(by) == len(rows) + 3
    wrong = [r for r in by.values() if r.held_out and r.doc_id < 9000 and r.predicted != (r.doc_id % 4 == 0)]
    assert len(wrong) <= 2
    assert {r.score for r in by.values() if r.doc_id == 9001} == {0.0}
    model = toxicity.fit_toxicity(docs, marks)
    scored = toxicity.score_toxicity(docs.where("doc_id = 8"), model).first()
    found = [scored.text[s.start : s.end] for s in scored.toxic_spans]
    assert found and all(any(w in f for w in ("zyrk", "vuntle", "qrobble")) for f in found)
    assert scored.pii == "x"


def test_toxicity_without_labels_is_zero(spark):
    docs = documents(spark, HARD)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), none).count() == 0


# 2 mixing


def nearest(counts, budget):
    best = None
    kinds = sorted(counts)
    for pick in itertools.product(*(range(counts[n] + 1) for n in kinds)):
        total = sum(n * k for n, k in zip(kinds, pick))
        best = min(abs(total - budget), best) if best is not None else abs(total - budget)
    return best


def test_chosen_lengths_are_as_near_as_possible_and_available():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 4))}
        budget = rng.randint(0, sum(n * c for n, c in counts.items()))
        got = mixing.choose_lengths(counts, budget)
        assert all(0 <= got.get(n, 0) <= c for n, c in counts.items())
        total = sum(n * k for n, k in got.items())
        assert abs(total - budget) <= max(counts)
        # equal shares of every length come first; the programme is exact on what is left
        words = sum(n * c for n, c in counts.items())
        share = {n: c * budget // words for n, c in counts.items()}
        rest = {n: c - share[n] for n, c in counts.items()}
        assert abs(total - budget) == nearest(rest, budget - sum(n * k for n, k in share.items()))


def test_chosen_lengths_under_a_small_programme():
    counts = {n: 3 for n in range(50, 400, 7)}
    total = sum(n * c for n, c in counts.items())
    got = mixing.choose_lengths(counts, total // 3, dp_words=300)
    assert abs(sum(n * k for n, k in got.items()) - total // 3) <= 50


def water_fill(sizes, weights, share, most):
    left, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        rate = left / sum(weights[i] for i in open_) if open_ else 0
        over = {i for i in open_ if rate * weights[i] > most * sizes[i]}
        if not over:
            for i in open_:
                target[i] = rate * weights[i]
            return target
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= over


def test_targets_equal_repeated_resharing(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = [rng.choice([0, 1, 5, 100, 1000, 30]) for _ in range(rng.randint(1, 9))]
        rows = [(i == len(sizes) - 1, f"s{i}" if i < len(sizes) - 1 else "", n) for i, n in enumerate(sizes)]
        frame = spark.createDataFrame(rows, "_null boolean, _source string, source_size bigint")
        got = [r.target for r in mixing.targets(frame).orderBy("_null", "_source").collect()]
        weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
        assert np.allclose(got, water_fill(sizes, weights, 1.5, 2))


def test_mixture_of_hard_rows(spark):
    rng = random.Random(5)
    same = "the same words again and again"
    more = [(100 + i, " ".join(rng.choices(string.ascii_lowercase, k=rng.randint(1, 40))), "en", rng.choice(["a", "b", None, "é"])) for i in range(150)]
    copies = [(1000 + i, same, "en", "a") for i in range(700)]
    docs = documents(spark, HARD + more + copies)
    got = mixing.digest(docs).collect()
    assert len(got) == len(HARD) + len(more) + len(copies)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
    truth = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in HARD + more + copies}
    assert all(r.size == truth[r.doc_id] for r in got)
    kept = mixing.mixture(docs)
    assert kept.columns == docs.columns
    for r in kept.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect():
        goal = next(x.target for x in got if x.source_size and (x.doc_id in {d[0] for d in HARD + more + copies if d[3] == r.source}))
        assert abs(r.n - goal) <= 60_000 * (r.source == "b") + 1
    again = mixing.digest(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.digest(docs.limit(0)).count() == 0


# 3 html


PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var x='</p><p>no';</script></head><body>"
    "<header><a href='/'>Home</a></header><nav><ul><li>One<li>Two</ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><div class=\"ad\">Buy &amp; save</div>"
    "<article><header><h1>Big   news</h1></header><p>First <b>bold</b>&nbsp;&amp; more<br>text<p>Second &#233;&hellip;"
    "<ul><li>x</li><li>y</li></ul><form><p>sign up</form><!-- <p>gone</p> --><div class='comments'><p>I agree</p></div>"
    "<p>a &lt; b</p></article><aside>Side</aside><footer>&copy; me</footer></body></html>"
)


def test_html_article():
    assert html_extract.extract(PAGE) == "Big news\nFirst bold & more text\nSecond é…\nx\ny\na < b"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<p>open <p>two", "open\ntwo"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("</b></div><p>x", "x"),
        ("<p>1 < 2 & 3", "1 < 2 & 3"),
        ("<script>never closed <p>x", ""),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<body class='has-sidebar'><main><p>kept</p></main><div id='sidebar'>no</div></body>", "kept"),
        ("<p title='a>b'>t</p>", "t"),
        ("<p><b>bold\n\t x", "bold x"),
    ],
)
def test_html_odd_pages(page, text):
    assert html_extract.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article class='post category-social'><p>kept</p></article>", "kept"),
        ("<article class='sponsored' id='comments'><p>kept</p></article>", "kept"),
        ("<body><h2 id='related-work'>A</h2><h2 id='share-prices'>B</h2><h2 id='cookies'>C</h2><p id='menu'>D</p></body>", "A\nB\nC\nD"),
        ("<body><div class='ad-hoc'>kept</div><div class='share-prices'>too</div><div class='toc'>list</div></body>", "kept\ntoo\nlist"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <object>this</object></p><dialog>said</dialog>", "so x=2 and this\nsaid"),
        ("<div class='ads-wrapper'>no</div><div class='site-footer'>no</div><div id='cookie-notice'>no</div><p>kept", "kept"),
    ],
)
def test_html_names_drop_nothing_else(page, text):
    assert html_extract.extract(page) == text


def test_deep_nesting_is_not_recursive():
    assert html_extract.extract("<div>" * 5000 + "deep") == "deep"
    html_extract.induce(["<div>" * 5000 + f"deep {i}" for i in range(3)])


def test_wrapper_separates_constant_from_varying():
    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(40))
    page = lambda: f"<body><div><div>Site name</div><div>Home and more</div></div><div><div><p>{prose()}</p><p>{prose()}</p></div></div><div>All rights kept</div></body>"
    pages = [page() for _ in range(8)]
    wrapper = html_extract.induce(pages)
    fresh = page()
    text = html_extract.extract(fresh, frozenset(wrapper["constant"]), wrapper["content"])
    assert text == "\n".join(re.findall(r"<p>(.*?)</p>", fresh))


def wrapped(wrapper, page):
    return html_extract.extract(page, frozenset(wrapper["constant"]), frozenset(wrapper["content"]))


def layouts():
    """A host of large pages, of others that are 80 levels deep and of a rare layout, and what they say."""
    rng = random.Random(16)
    prose = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    out = []
    for i in range(23):
        text = prose(50_000 if i < 10 else 60)
        if i < 10:
            page = f"<body><div class='top'><div>Large menu</div></div><div class='post'><p>{text}</p></div><div class='top'><div>Large end</div></div></body>"
        elif i < 20:
            page = f"<body><table>{'<section>' * 80}<div>Deep menu</div><div><p>{text}</p></div>{'</section>' * 80}</table></body>"
        else:
            page = f"<body><section><div>Rare menu</div></section><section class='story'><p>{text}</p></section></body>"
        out.append((page, text))
    return out


def test_wrapper_learns_every_layout_size_and_depth():
    pages = layouts()
    wrapper = html_extract.induce([p for p, _ in pages])
    assert [wrapped(wrapper, p) == t for p, t in pages] == [True] * len(pages)


def test_wrapper_decides_where_pages_have_articles():
    rng = random.Random(17)
    prose = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    texts = [(prose(3), prose(60), prose(60)) for _ in range(8)]
    inside = [f"<body><article><h1>{h}</h1><p>Read it in our app</p><p>{a} <b>The</b></p><p>{b}</p></article></body>" for h, a, b in texts]
    wrapper = html_extract.induce(inside)
    for page, (h, a, b) in zip(inside, texts):
        assert wrapped(wrapper, page) == f"{h}\n{a} The\n{b}"
    # the teasers are articles, the text is not in one
    beside = [f"<body><div class='post'><p>{a}</p><p>{b}</p></div><article>{h}</article></body>" for h, a, b in texts]
    wrapper = html_extract.induce(beside)
    for page, (_, a, b) in zip(beside, texts):
        assert wrapped(wrapper, page) == f"{a}\n{b}"
    copies = ["<body><article><p>same</p></article></body>" + "<!-- -->" * i for i in range(5)]
    assert wrapped(html_extract.induce(copies), copies[0]) == "same"


def test_wrapper_counts_copies_once_over_all_pages(spark):
    pages = [p for p, _ in layouts()[10:]]
    rows = [("http://h/a", p) for p in pages for _ in range(200)] + [("http://h/b", None), ("http://h/c", ""), ("http://i/", pages[0])]
    table = spark.createDataFrame(rows, "url string, html string")
    got = {r._host: json.loads(r.wrapper) for r in html_extract.fit_wrappers(table, Scratch(spark, "html")).collect()}
    assert got == {"h": html_extract.induce(pages), "i": {"constant": [], "content": []}}
    assert len(got["h"]["constant"]) == 2 and len(got["h"]["content"]) == 2


def test_wrapper_of_a_host_of_many_shapes(spark):
    rng = random.Random(18)
    prose = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    name = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, want = [], {}
    for i in range(600):
        text = prose(40)
        extras = "".join(f"<section><div class='{name()}'>{prose(1)}</div></section>" for _ in range(1))
        # every page has class names of its own, so each is a shape
        kind = "<table><section><div>The menu</div></section></table>" if i % 2 else "<dl><div><div>Another menu</div></div></dl>"
        body = f"<div class='story'><div class='a'><div class='b'><div class='c'><p>{text}</p></div></div></div></div>"
        rows.append((i, "http://h/a", f"<body>{kind}{body}{extras}</body>"))
        want[i] = text
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.main_text(table).collect()}
    assert got == want


def test_templates_pass_over_unlike_layouts_exactly():
    rng = random.Random(19)
    tree = lambda d: [rng.choice("abc")] + [tree(d - 1) for _ in range(rng.randint(0, 3) if d else 0)]

    def rows(t, up, out):
        out.append([up, t[0]])
        here = len(out) - 1
        for c in t[1:]:
            rows(c, here, out)
        return out

    shapes = [(json.dumps(rows(["html"] + [tree(2) for _ in range(3)], -1, [])), n) for n in range(1, 60)]
    found = html_extract.templates(shapes)
    assert 1 < len(found) < 59 and sum(n for _, n in found) == sum(n for _, n in shapes)
    for slot, _ in found:
        assert html_extract.flat(html_extract.Slot.of(html_extract.tree(html_extract.flat(slot)))) == html_extract.flat(slot)


def test_simple_tree_matching_equals_plain_recursion():
    rng = random.Random(7)

    def tree(depth):
        kids = "".join(tree(depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
        tag = rng.choice(["div", "section"])
        return f"<{tag}>{kids}</{tag}>"

    def plain(a, b):
        if a.label != b.label:
            return 0
        xs, ys = html_extract.elements(a), html_extract.elements(b)
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs):
            for j, y in enumerate(ys):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + plain(x, y))
        return 1 + m[-1][-1]

    for _ in range(40):
        a, b = html_extract.parse(tree(3)), html_extract.parse(tree(3))
        slot = html_extract.Slot.of(a)
        memo = {"shapes": {}, "pairs": {}, "of_slot": {}, "of_node": {}}
        html_extract._shapes(slot, lambda s: s.children, memo["of_slot"], memo["shapes"])
        html_extract._shapes(b, html_extract.elements, memo["of_node"], memo["shapes"])
        assert html_extract.matching(slot, b, memo) == plain(a, b)


def test_html_pages_of_every_kind(spark):
    rows = [(1, "http://h/a", PAGE, "x"), (2, None, None, "x"), (3, "not a url", "", None), (None, "http://h/b", PAGE, "x"), (1, "http://h/a", PAGE, "x"), (4, "http://H:80/c", "<p>" + LONG, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {(r.page_id, r.url): r for r in html_extract.main_text(pages).collect()}
    assert html_extract.main_text(pages).count() == len(rows)
    assert got[1, "http://h/a"].text.startswith("Big news\n")
    assert got[2, None].text == "" and got[2, None].n_chars == 0
    assert got[4, "http://H:80/c"].n_chars == len(LONG.strip())
    assert html_extract.main_text(pages.limit(0)).count() == 0


# 4 embeddings


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + rng.normal(size=16) * rng.choice([0.0, 0.15, 0.3])).tolist(), int(i % 30 % 3)) for i in range(420)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(300)]
    bad = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, [None] + [1.0] * 15, 1), (2004, rows[0][1], None), (2005, [], 1), (2006, [float("inf")] + [1.0] * 15, 0), (2007, [1.0, 2.0], 1), (None, rows[0][1], 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id bigint, embedding array<double>, label int, size string")
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    near = (v @ v.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in zip(*np.nonzero(near)):
        p, q = root(ids[a]), root(ids[b])
        up[max(p, q)] = min(p, q)
    got = {r.vec_id: r for r in embed_dedup.near_vectors(table).collect()}
    assert len(got) == len(rows) + len(bad)
    want = near.sum(axis=1)
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.999 * want.sum() and all(got[i].n_links <= n for i, n in zip(ids, want.tolist()))
    assert sum(got[i].component_id != root(i) for i in ids) <= 2
    for i in range(2000, 2008):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].kept and got[None].component_id is None
    assert embed_dedup.near_vectors(table.limit(0)).count() == 0


def test_vectors_in_buckets_of_several_blocks(spark):
    rng = np.random.default_rng(5)
    near = rng.normal(size=32) + rng.normal(size=(700, 32)) * 0.2
    far = rng.normal(size=(300, 32))
    v = np.concatenate((near, far)).astype(np.float32)
    table = spark.createDataFrame([(i, x.tolist(), "one") for i, x in enumerate(v)], "vec_id long, embedding array<float>, label string")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embed_dedup.near_vectors(table).collect()}
    assert want.sum() > 10_000 and all(got[i] <= n for i, n in enumerate(want.tolist()))
    assert sum(got.values()) >= 0.999 * want.sum()


def test_sketches_keep_pairs_at_the_threshold():
    p, most = math.acos(0.93) / math.pi, embed_dedup.most_apart()
    chance = [math.comb(embed_dedup.SKETCH, k) * p**k * (1 - p) ** (embed_dedup.SKETCH - k) for k in range(embed_dedup.SKETCH + 1)]
    assert sum(chance[most + 1 :]) <= 1e-6 < sum(chance[most:])


def test_tables_keep_the_miss_probability():
    for bits in (6, 10, 20):
        agree = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - agree) ** embed_dedup.tables_for(bits) <= 1e-4


# 5 decontamination


def brute_hits(text, items, window):
    words = decontaminate.words_of(text)
    hit, ids = [False] * len(words), set()
    for name, item in items:
        w = decontaminate.words_of(item)
        if not w:
            continue
        for x in [w[i : i + window] for i in range(len(w) - window + 1)] if len(w) >= window else [w]:
            for i in range(len(words) - len(x) + 1):
                if words[i : i + len(x)] == x:
                    ids.add(name)
                    hit[i : i + len(x)] = [True] * len(x)
    return hit, ids


def test_automaton_equals_brute_force():
    rng = random.Random(9)
    for _ in range(400):
        letters, window = rng.choice(["ab", "abc", "abé"]), rng.choice([2, 3, 4])
        text = lambda most: rng.choice([" ", ", ", "\n"]).join(rng.choice([c, c.upper()]) for c in rng.choices(letters, k=rng.randint(0, most)))  # noqa: E731, B023
        items = [(str(i), text(9)) for i in range(rng.randint(0, 4))]
        texts = [text(25), rng.choice([None, "", text(25)]), text(60)]
        sizes, found = decontaminate.Matcher(items, window).match(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            hit, ids, _ = found.get(i, (np.zeros(int(sizes[i]), bool), set(), 0))
            assert (list(hit), ids) == brute_hits(t, items, window)


def test_decontamination_in_parts_equals_one_part(spark):
    rng = random.Random(10)
    words = ["".join(rng.choices("abc", k=3)) for _ in range(30)]
    items = [(i if i else None, " ".join(rng.choices(words, k=rng.randint(0, 20)))) for i in range(12)] + [(50, None), (51, "")]
    texts = [" ".join(rng.choices(words, k=30)) + " " + (rng.choice(items)[1] or "") for _ in range(60)]
    docs = documents(spark, HARD + [(100 + i, t, "en", "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, n_words string")
    one = decontaminate.verdict(decontaminate.mark_spans(docs.select("doc_id", "text"), bench))
    many = decontaminate.verdict(decontaminate.mark_spans(docs.select("doc_id", "text"), bench, max_words=40))
    show = lambda df: sorted(str(r) for r in df.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect())
    assert show(one) == show(many)
    for r in one.collect():
        hit, ids = brute_hits(r.text, [(None if i is None else str(i), t) for i, t in items], 13)
        assert (r.n_hit, set(r.item_ids)) == (sum(hit), ids - {None})
    got = decontaminate.digest(docs, bench)
    row = got.where("doc_id = 1").first()
    assert (row.n_words, row.n_hit, row.contaminated, row.items_sha256) == (0, 0, False, hashlib.sha256(b"").hexdigest())
    assert decontaminate.digest(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.digest(docs.limit(0), bench).count() == 0


def test_spans_are_cut_from_contaminated_texts(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = documents(spark, [(1, f"before, {item}! after", "en", "s"), (2, "clean words", "en", "s")])
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: r.clean_text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert got == {1: "before, ! after", 2: "clean words"}


# 6 language


def test_forward_sums_all_segmentations():
    pieces = sorted({b"a", b"b", b"ab", b"ba", b"aba", b" ", b" a"} | {bytes([i]) for i in range(256)})
    seg = langid.Segmenter(pieces)
    rng = np.random.default_rng(11)
    p = rng.random((len(pieces) + 1, 2))
    p[0] = 0
    p /= p.sum(axis=0)
    index = {x: i + 1 for i, x in enumerate(pieces)}

    def brute(word, k):
        if not word:
            return 1.0
        return sum(p[index[word[:n]], k] * brute(word[n:], k) for n in range(1, min(8, len(word)) + 1) if word[:n] in index)

    with np.errstate(divide="ignore"):
        got = langid.word_scores(seg, np.log(p))(["a", "ab", "abab", "baab"])
    for row, word in zip(got, (b" a", b" ab", b" abab", b" baab")):
        assert np.allclose(np.exp(row), [brute(word, k) for k in (0, 1)])


def test_long_words_are_summed_over_all_segmentations(monkeypatch):
    """Against a plain sum in logs, with pieces that reach over every cut a window could make."""
    rng = random.Random(19)
    pieces = sorted({bytes(rng.choices(b"ab", k=n)) for n in (2, 3, 5, 8, 13, 21, 33) for _ in range(12)} | {bytes([i]) for i in range(256)})
    seg = langid.Segmenter(pieces)
    p = np.random.default_rng(3).random((len(pieces) + 1, 2))
    p[0] = 0
    p /= p.sum(axis=0)
    index = {x: i + 1 for i, x in enumerate(pieces)}

    def plain(word, k):
        data, logs = langid.encoded(word), [0.0]
        for i in range(1, len(data) + 1):
            terms = [logs[i - n] + np.log(p[index[data[i - n : i]], k]) for n in range(1, min(33, i) + 1) if data[i - n : i] in index]
            logs.append(np.logaddexp.reduce(terms))
        return logs[-1]

    words = ["".join(rng.choices("ab", k=n)) for n in (1, 40, 62, 63, 64, 65, 64, 200, 200, 3000)]
    for block in (langid.BLOCK, 50, 128):
        monkeypatch.setattr(langid, "BLOCK", block)
        with np.errstate(divide="ignore"):
            got = langid.word_scores(seg, np.log(p))(words)
        assert np.allclose(got, [[plain(w, k) for k in (0, 1)] for w in words], rtol=1e-9)


def test_all_pieces_of_the_vocabulary_take_part():
    pieces = langid.read_vocabulary()
    assert max(map(len, pieces)) > 20 and len(pieces) > 50_000
    long = max((p for p in pieces if p.startswith(b" ") and p[1:].isalpha()), key=len)
    seg = langid.Segmenter(pieces)
    ids = seg.lattice(np.frombuffer(long, np.uint8).reshape(1, -1))
    assert pieces[ids[0, 0, len(long) - 1] - 1] == long


def test_long_words_are_scored_whole():
    seg = langid.Segmenter(langid.read_vocabulary())
    p = np.full((len(seg.lengths), 2), 1e-4)
    p[0] = 0
    score = langid.word_scores(seg, np.log(np.maximum(p, 1e-300)))
    assert np.isfinite(score(["x" * 5000, "y"])).all()
    assert score(["x" * 5000])[0, 0] < score(["x" * 100])[0, 0]


def test_language_of_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()


def test_language_of_hard_rows(spark):
    docs = documents(spark, HARD + [(i, "der die das und nicht" if i % 2 else "the and that with for", "de" if i % 2 else "en", "s") for i in range(20, 60)])
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und"
    assert got[1].score == 0.0
    assert got[21].lang_pred == "de" and got[20].lang_pred == "en"
    none = documents(spark, [(1, "abc", None, "s")])
    assert langid.identify(none).first().lang_pred == "und"
    assert langid.identify(docs.limit(0)).count() == 0


def test_every_language_is_learned(spark):
    rng = random.Random(18)
    words = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for k in range(70)}
    rows = [(i, " ".join(rng.choices(words[f"l{i % 70:03}"], k=12)), f"l{i % 70:03}", "s") for i in range(70 * 6)]
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert [i for i, _, lang, _ in rows if got[i].lang_pred != lang] == []
    assert all(0.5 < r.score <= 1 for r in got.values())
    # one pass over all languages and passes over a few say the same
    again = {r.doc_id: r for r in langid.identify(docs, langid.fit_languages(docs, most=100)).collect()}
    assert all(again[i].lang_pred == r.lang_pred and abs(again[i].score - r.score) < 1e-9 for i, r in got.items())


# 7 sharding


def test_shards_are_even_gapless_and_repeatable(spark):
    docs = documents(spark, HARD + [(100 + i, "same text" if i % 3 else f"t{i}", "en", "s") for i in range(3000)])
    got = sharding.assign_shards(docs).collect()
    assert len(got) == len(HARD) + 3000
    places = collections.defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    sizes = [len(places[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    by = {r.doc_id: r for r in got}
    assert (by[1].size, by[1].text_crc32) == (1, 0)
    import zlib

    assert by[9].text_crc32 == zlib.crc32(HARD[-1][1].encode()) and by[9].size == len(HARD[-1][1].encode()) + 1
    assert sorted(map(str, got)) == sorted(map(str, sharding.assign_shards(docs.repartition(5)).collect()))
    assert sharding.assign_shards(docs.limit(0)).count() == 0
    few = sharding.assign_shards(docs.limit(3)).collect()
    assert len(few) == 3 and len({r.shard for r in few}) == 3


def test_one_more_shard_moves_few(spark, sf):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    old = sharding.assign_shards(docs, 16).select("doc_id", "shard")
    new = sharding.assign_shards(docs, 17).select("doc_id", F.col("shard").alias("grown"))
    moved = old.join(new, "doc_id").where("shard <> grown").count()
    assert moved <= 20_000 * (1 / 17 + 0.06)


def test_overflow_goes_clockwise():
    ring = {0: 0, 10: 1, 20: 2, 30: 0}
    plan = sharding.plan_ranges({5: 7, 15: 1, 25: 1}, ring, 3, 40)
    got = sorted((slot, shard, last - first) for slot, first, last, shard, _ in plan)
    # slot 5 asks shard 1 for seven places and gets three; the others go to 2, then to 0
    assert got == [(5, 0, 2), (5, 1, 3), (5, 2, 2), (15, 2, 1), (25, 0, 1)]


# 8 minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(rows):
    """Rows (id, text); rows with one id are one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            p, q = root(i), root(j)
            up[max(p, q)] = min(p, q)
    return {i: root(i) for i in up}


def families(seed, groups, size, words=60):
    rng = random.Random(seed)
    rows, i = [], 100
    for _ in range(groups):
        base = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(rng.randint(6, words))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = "x" + str(rng.randrange(100))
            rows.append((i, rng.choice([" ", "  ", "\n"]).join(copy), "en", "s"))
            i += 1
    return rows


@pytest.mark.parametrize(("groups", "size"), [(40, 6), (2, 120)])
def test_near_duplicates_equal_brute_force(spark, groups, size):
    rows = HARD + families(groups, groups, size)
    docs = documents(spark, rows)
    want = brute_components([r[:2] for r in rows])
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
    sizes = {i: len(shingles(t)) for i, t, *_ in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)


def test_near_duplicates_of_nothing(spark):
    docs = documents(spark, HARD)
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0
    assert minhash_dedup.near_duplicates(docs.where("doc_id = 1")).first().kept


def test_sequential_rule_keeps_similar_pairs():
    rng = np.random.default_rng(12)
    rule = minhash_dedup.least_matches()
    assert all(m <= n for n, m in rule) and rule[-1][1] > 60
    a = rng.integers(0, 1 << 32, (20_000, 128), dtype=np.uint64).astype(np.uint32)
    other = rng.integers(0, 1 << 32, a.shape, dtype=np.uint64).astype(np.uint32)
    at = lambda s: np.where(rng.random(a.shape) < s, a, other)
    assert minhash_dedup.survives(a, at(0.75), rule).mean() > 0.9999
    assert minhash_dedup.survives(a, at(0.3), rule).mean() < 0.001
    assert minhash_dedup.survives(a, at(0.45), rule).mean() < 0.35


# 9 pii


BASE_RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, rule) in enumerate(BASE_RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub(r"\D", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_pii_equals_the_plain_rules():
    rng = random.Random(13)
    for _ in range(20_000):
        text = "".join(rng.choices("0123456789" * 2 + "+ .-()@ab_%é", k=rng.randint(0, 30)))
        got = [f"{k}:{s}:{e}" for s, e, k, _ in pii.find(text) if k in BASE_RULES]
        assert got == plain_spans(text), text


def test_pii_examples(spark):
    text = "é Mail a.b@c.de, call +1 (407) 555-7710, card 4111 1111 1111 1111, iban DE89 3704 0044 0532 0130 00 at 8.8.8.8 not 8.8.8.999"
    docs = documents(spark, [*HARD, (50, text, "en", "s"), (51, "1-2-3-4-5-6-7-8-9-0-1-2 " * 3, "en", "s")])
    found = pii.find_pii(docs).where("doc_id = 50") if "pii" not in docs.columns else pii.find_pii(docs.drop("pii")).where("doc_id = 50")
    kinds = {s.kind: text[s.start : s.end] for s in found.first().pii}
    assert kinds["iban"] == "DE89 3704 0044 0532 0130 00" and kinds["email"] == "a.b@c.de" and kinds["ip"] == "8.8.8.8"
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    row = got[50]
    want = ",".join(plain_spans(text))
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert set(plain_spans(text)) < set(row.spans.split(","))
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.digest(docs.limit(0)).count() == 0


def test_pii_context_moves_the_score():
    card = "4111111111111111"
    plain = pii.find(f"xx {card} yy")[0][3]
    assert pii.find(f"credit card {card}")[0][3] > plain > pii.find(f"order {card}")[0][3]


# 10 quality


def test_quality_of_held_out_texts(spark, sf):
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out")
    assert got.where("predicted = quality").count() >= 0.9 * got.count()


def test_quality_of_hard_rows(spark):
    docs = documents(spark, HARD)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    rng = random.Random(14)
    rows = [(100 + i, " ".join(rng.choices(["spam!!", "win!!", "###"] if i % 2 else ["calm", "prose", "here", "lies"], k=50)), "en", "s") for i in range(200)]
    labels = spark.createDataFrame([(r[0], int(r[0] % 2 == 0), 0) for r in rows] + [(None, 1, 1), (101, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(documents(spark, HARD + rows), labels).collect()}
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len({r[0] for r in HARD + rows})
    assert sum(got[r[0]].predicted != (r[0] % 2 == 0) for r in rows) <= 4
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_blocks_settle_what_leaders_miss(spark):
    """Copies of one text that are near each other only in part, so buckets stay split."""
    rng = random.Random(15)
    base = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(80)]
    rows = []
    for i in range(260):
        copy = list(base)
        for k in rng.sample(range(80), rng.choice([1, 2, 3, 4])):
            copy[k] = "x" + str(rng.randrange(1000))
        rows.append((i, " ".join(copy), "en", "s"))
    want = brute_components([r[:2] for r in rows])
    got = minhash_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert 1 < len(set(want.values())) < 200


def test_iban_before_upper_case_words():
    iban = "DE89 3704 0044 0532 0130 00"
    for after in ("", " BIC COBADEFFXXX", " 12 EUR", " AND GB82 WEST 1234 5698 7654 32", "."):
        assert [iban] == [f"{iban}{after}"[a:b] for a, b in pii.ibans(iban + after)][:1]
    assert len(list(pii.ibans(f"{iban} AND GB82 WEST 1234 5698 7654 32"))) == 2
