"""Collocations, n-gram scores and vector codes, and rows that once went wrong elsewhere."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from feedmerge.llm import collocations as C
from feedmerge.llm import embed_dedup, html_extract, langid, minhash_dedup, mixing
from feedmerge.llm import ngram_scores as G
from feedmerge.llm import vector_codes as V
from feedmerge.llm.common import aside

DOCS = "doc_id long, text string, lang string, source string"


def low(text):
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


# ----------------------------------------------------------------- collocations


def plain_collocations(rows, top, least, cover):
    counts = collections.defaultdict(collections.Counter)
    totals = collections.Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low(text)):
            w = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = (q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * f[q] >= cover * a for q in inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def babble(seed, n, words=25):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["ÄÖ", "ab"]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda: "".join(w + s for w, s in zip(rng.choice(vocabulary, 120, p=weight / weight.sum()), rng.choice([" ", "  ", ", ", "\n", "\t"], 120, p=[0.8, 0.05, 0.05, 0.05, 0.05])))
    return [(i, text(), ["en", "de", None][i % 3], None) for i in range(n)]


@pytest.mark.parametrize("top,guess,bits,chunk", [(10, 2, 25, 1 << 20), (5, 1, 15, 700)])
def test_collocations_equal_all_phrases(spark, top, guess, bits, chunk):
    rows = [*babble(1, 36), (90, None, "en", None), (91, "", None, None), (92, "Tic tac " * 50, "en", None), (92, "x y z q " * 9, "fr", None), (None, "a.b,c", "en", None)]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "score")
    got = sorted(tuple(r) for r in C.collocations(df, top=top, least=8, guess=guess, filter_bits=bits, chunk=chunk).collect())
    assert got == plain_collocations(rows, top, 8, 80) and len(got) > 10


def test_collocations_of_nothing(spark):
    assert C.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, "a b", "en", None)], DOCS)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, both = 4_500_000_000_000_001, 9_000_000_000_000_003
    df = spark.createDataFrame([(a, both)], "a long, b long")
    assert df.select(C.score_of(df.a * 1000, df.b * 1000)).first()[0] == 2_000_000 * a // both


# ----------------------------------------------------------------- n-gram scores


@pytest.mark.parametrize("top", [3, 1000, 1 << 40])
def test_elias_fano_gets_and_finds(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 63, 64, 65, 700):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        packed = G.EliasFano.build(values)
        assert (packed.get(np.arange(n)) == values).all()
        asked = np.concatenate((values, rng.integers(0, 2 * top, 60).astype(np.uint64)))
        for x, i in zip(asked.tolist(), packed.find(asked).tolist()):
            assert values[i] == x if x in set(values.tolist()) else i == -1


def test_trie_finds_words_in_their_context_only(tmp_path):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(c), int(w)) for c, w in rng.integers(0, 60, (900, 2))})
    kept = pairs[::2]
    context, word = (np.array(x, np.uint64) for x in zip(*kept))
    a = rng.random(len(kept))
    b = rng.random(len(set(context.tolist())))
    G.Trie.build(context, word, a, b).save(tmp_path)
    trie = G.Trie.load(tmp_path)
    got_a, got_b = trie.ask(*(np.array(x, np.uint64) for x in zip(*pairs)))
    want, weight = dict(zip(kept, a)), dict(zip(sorted(set(context.tolist())), b))
    for pair, x, y in zip(pairs, G.of_code(got_a), G.of_code(got_b)):
        assert abs(x - want.get(pair, 0)) <= 3e-4 * x and abs(y - weight.get(pair[0], 1)) <= 3e-4 * y


def plain_scores(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows]
    texts = [[*re.findall(r"[^ \t\n\x0b\x0c\r]+", low(t)), None] for _, t, *_ in rows]
    one, two, three = (collections.Counter() for _ in range(3))
    for h, w in zip(held, texts):
        if not h:
            one.update(w)
            two.update(zip([0, *w], w))
            three.update(zip([0, 0, *w], [0, *w], w))
    ends, total, distinct = sum(not h for h in held), sum(one.values()), len(one)
    of1, of2 = lambda v: ends if v == 0 else one[v], lambda u, v: ends if v == 0 else two[u, v]
    mass2, mass3 = collections.Counter(), collections.Counter()
    for (v, w), c in two.items():
        mass2[v] += (c - G.DISCOUNT) / of1(v)
    for (u, v, w), c in three.items():
        if c >= G.LEAST[3]:
            mass3[u, v] += (c - G.DISCOUNT) / of2(u, v)

    def p(u, v, w):
        p1 = (one[w] + 0.1) / (total + 0.1 * (distinct + 1))
        p2 = (two[v, w] - G.DISCOUNT) / of1(v) if two[v, w] else 0
        p2 += (1 - mass2[v]) * p1
        c = three[u, v, w]
        return p1, ((c - G.DISCOUNT) / of2(u, v) if c >= G.LEAST[3] else 0) + (1 - mass3[u, v]) * p2

    out = []
    for (i, *_), h, w in zip(rows, held, texts):
        ps = [p(*g) for g in zip([0, 0, *w], [0, *w], w)]
        out.append((i, h, len(w), sum(one[x] > 0 for x in w), total, sum(math.log10(x) for x, _ in ps), sum(math.log10(x) for _, x in ps)))
    vocabulary = [*one]
    return out, lambda u, v: sum(p(u, v, w)[1] for w in vocabulary) + p(u, v, ("new",))[1]


@pytest.mark.parametrize("options", [{}, {"shard": 500, "chunk": 2000, "hot_least": 40}])
def test_scores_equal_the_plain_model(spark, options):
    rows = [*babble(2, 60), (None, "Null id", "x", None), (100, None, None, None), (101, "", None, None), (102, "new WORDS only", None, None), (7, "one id twice", None, None), (103, "w0 " * 300, None, None)]
    got = G.score_documents(spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "score"), **options).collect()
    want, total = plain_scores(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-9 * g[2] + 1e-9 and abs(g[6] - w[6]) < 3e-4 * g[2]
    assert abs(total(0, 0) - 1) < 1e-9 and abs(total("w0", "w1") - 1) < 1e-9


def test_scores_without_training_or_rows(spark):
    assert G.score_documents(spark.createDataFrame([], DOCS)).collect() == []
    alone = [(None, "a b", None, None)]
    r = G.score_documents(spark.createDataFrame(alone, DOCS)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and abs(r.base_score) < 1e-9


# ----------------------------------------------------------------- vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, label, [math.floor(int(x) * scale if abs(x) > 2**52 else x * scale) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts) * parts
    size = width // parts
    kept = [(i, label, [*v, *[0] * (width - len(v))]) for i, label, v in kept]
    named = {}
    for i, _, v in kept:
        if i is not None:
            named[i] = min(named.get(i, v), v)
    start = [named[i] for i in sorted(named)] + sorted(v for i, _, v in kept if i is None)
    books = [[v[p * size : (p + 1) * size] for v in start[:entries]] for p in range(parts)]
    part = lambda v, p: v[p * size : (p + 1) * size]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda v: [min((far(part(v, p), c), e) for e, c in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        chosen = [nearest(v) for *_, v in kept]
        for p, e in itertools.product(range(parts), range(len(start[:entries]))):
            mine = [part(v, p) for (*_, v), c in zip(kept, chosen) if c[p][1] == e]
            if mine:
                books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, label, "".join(f"{e:02x}" for _, e in c), min(sum(d for d, _ in c), V.LONG_MAX)) for (i, label, v), c in ((r, nearest(r[2])) for r in kept)]
    sums = collections.Counter()
    for _, label, _, error in out:
        sums[label] += error
    return sorted(((i, code, error, min(sums[label], V.LONG_MAX)) for i, label, code, error in out), key=repr), [y for b in books for c in b for y in c]


SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(seed, n, dim=16, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, dim))
    return [(i, [float(x) for x in centres[i % 6] + rng.normal(0, spread * 0.1, dim)], i % 4 or None) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        vectors(1, 150),
        [(i, [float(i % 3)] * 8, 1) for i in range(40)],
        vectors(2, 5),
        [*vectors(3, 60), (3, [0.5] * 16, 1), (3, [0.5] * 16, 1), (None, [0.1] * 16, None), (None, [0.2] * 16, None), (70, [1.0, None] * 8, 1), (71, [float("nan")] * 16, 1), (72, None, 1), (73, [], 2), (74, [0.3] * 11, 2)],
        [*vectors(4, 30), (40, [1e300] * 16, 1), (41, [-3e12] * 16, 1), (42, [2.5e7] * 16, 2)],
        [(None, [1.0] * 8, 1), (None, [2.0] * 8, 1)],
        [(1, [], 1)],
    ],
)
def test_codes_equal_a_full_search(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = V.digest(df.withColumn("code", df.label).withColumn("error", df.label)).collect()
    want, entries = plain_codes(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == want
    book = V.fit_codes(df)[1]
    assert [int(y) for b in book for y in b.ravel()] == entries
    assert {r.codebooks_sha256 for r in got} == {V.books_digest(book)}


def test_codes_of_nothing(spark):
    assert V.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_balls_compare_ties_and_skip_cores():
    book = np.array([[0, 0], [4, 0], [0, 0], [100, 100]])
    x = np.array([[2, 0], [0, 0], [99, 99], [2, 1]])
    for code in itertools.product(range(4), repeat=4):
        got, d = V.assign(x, np.array(code), book)
        assert got.tolist() == [0, 0, 3, 0] and d.tolist() == [4, 0, 2, 5]


# ----------------------------------------------------------------- rows that went wrong


def test_mixture_of_a_long_text_and_an_empty_one(spark):
    rows = [(1, "w " * 200_000, None, "a"), (2, None, None, "a"), (3, "b c", None, "b")]
    got = {r.doc_id: r for r in mixing.digest(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[2].taken == 0 and got[1].taken in (200_000, 400_000)
    assert mixing.choose_lengths({0: 1, 200_000: 1}, 150_000) in ({0: 0, 200_000: 1}, {0: 0, 200_000: 0})


def test_mixture_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(i, "a b c", None, "s", 7, 8, 9) for i in range(6)], f"{DOCS}, target int, source_size int, _size int")
    out = mixing.mixture(df)
    assert out.columns == df.columns and {tuple(r)[4:] for r in out.collect()} == {(7, 8, 9)}


def test_aside_brings_columns_back(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    hidden, back = aside(df, "b")
    assert back(hidden).collect() == df.collect() and "a" not in hidden.columns


def test_labels_are_compared_whole(spark):
    long = "x" * 80
    rows = [(1, [1.0, 0.0], long + "1"), (2, [1.0, 0.0], long + "2"), (3, [1.0, 0.0], long + "2")]
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (0, 1), 2: (1, 2), 3: (1, 2)}


def test_a_repeated_vector_id_joins_its_classes(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [(2, a, 1), (5, a, 1), (3, b, 1), (5, b, 1), (9, [1.0, 1.0], 1)]
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.vec_id, r.component_id) for r in got} == {(2, 2), (3, 2), (5, 2), (9, 9)}


def test_a_repeated_document_id_joins_its_classes(spark):
    a, b = "one two three four five six", "red blue green white black grey"
    rows = [(2, a, None, None), (5, a, None, None), (3, b, None, None), (5, b, None, None)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(2, 2, True), (3, 2, False), (5, 2, False)}


def test_headings_that_repeat_stay_with_their_text(spark):
    page = "<html><body><nav>Home</nav><article><h1>Dish {i}</h1><h2>Ingredients</h2><p>Take {i} eggs and {j} spoons of flour.</p><h2>Method</h2><p>Stir for {j} minutes, then wait {i} hours.</p><div><h3>Newsletter</h3><p>Subscribe to our letter</p></div></article></body></html>"
    rows = [(i, f"https://a.example/{i}", page.replace("{i}", str(i + 10)).replace("{j}", str(3 * i + 40))) for i in range(6)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        lines = r.text.split("\n")
        assert lines[0] == f"Dish {r.page_id + 10}" and [lines[1], lines[3]] == ["Ingredients", "Method"] and len(lines) == 5


def test_numerals_are_no_letters():
    assert langid.words_of("½ ² Ⅷ ① 12") == [] and langid.words_of("Élan x²y") == ["élan", "x", "y"]
