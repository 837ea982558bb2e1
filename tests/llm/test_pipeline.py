"""The queries against SQL, and the pipeline against a plain version of every stage."""

import collections

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import expected, rows_of
from feedmerge.llm import decontaminate, mixing, toxicity
from feedmerge.llm.queries import QUERIES, SQL
from test_operators import brute_components, brute_hits


def test_all_are_registered():
    registered = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, sf, name):
    df = QUERIES[name](spark, sf)
    got, want = rows_of(df.columns, df.collect()), expected(db, SQL[name])
    assert got == want and got[1]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows over the small tables, written and read again."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return sf, out


def test_stages_return_documents(stages):
    sf, out = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(df.columns == out[0].columns for df in out[1:-1])


def test_toxic_documents_go(spark, stages):
    sf, out = stages
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit_toxicity(out[0], labels)
    tagger = toxicity.Tagger(model)
    rows = out[0].collect()
    p, begin, end = tagger.marginals([toxicity.TOKEN.findall(toxicity.lowered(r.text or "")) for r in rows])
    score = 1 / (1 + np.exp(-(toxicity.evidence_of(p, begin, end) @ model.document)))
    want = {r.doc_id for r, s in zip(rows, score) if s < toxicity.THRESHOLD}
    got = {r.doc_id for r in out[1].collect()}
    assert got == want
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(toxic & got) <= 0.3 * len(toxic) and len(clean - got) <= 0.03 * len(clean)


def test_one_document_of_each_group_stays(stages):
    _, out = stages
    rows = [(r.doc_id, r.text) for r in out[1].collect()]
    want = {i for i, c in brute_components(rows).items() if i == c}
    assert sorted(r.doc_id for r in out[2].collect()) == sorted(want)


def test_contaminated_documents_go(spark, stages):
    sf, out = stages
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = collections.defaultdict(list)
    for name, text in items:
        w = decontaminate.words_of(text)
        for i in range(max(1, len(w) - 12)):
            grams[tuple(w[i : i + 13])].append(name)
    kept = set()
    for r in out[2].collect():
        w = decontaminate.words_of(r.text)
        suspect = any(tuple(w[i : i + 13]) in grams for i in range(len(w)))
        hit = brute_hits(r.text, items, 13)[0] if suspect else []
        if not (sum(hit) and 20 * sum(hit) >= len(w)):
            kept.add(r.doc_id)
    assert {r.doc_id for r in out[3].collect()} == kept


def test_mixture_repeats_rows_as_the_digest_says(stages):
    _, out = stages
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in mixing.digest(out[3]).collect()}
    times = collections.Counter(r.doc_id for r in out[4].collect())
    assert times == collections.Counter({i: n for i, n in taken.items() if n})


def test_shards_hold_the_whole_mixture(stages):
    _, out = stages
    rows = out[5].collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in out[4].collect())
    sizes = collections.Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_run_equals_the_stages(spark, stages):
    sf, out = stages
    got, want = corpus_pipeline.run(spark, sf), out[5]
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())


def test_stages_take_any_table(spark, sf, tmp_path):
    rows = [(None, None, None, None), (None, "a b c", "en", "x"), (1, "", "en", "x"), (2, "one two three four five six", None, None), (2, "one two three four five six", None, None), (3, "one two three four five six", "de", "x"), (4, "word " * 30, "en", "x")]
    clash = "toxicity double, n_words int, hit_spans string, target int, source_size long, kept string"
    docs = spark.createDataFrame([(*r, 0.5, k, "h", k, k, "k") for k, r in enumerate(rows)], f"doc_id long, text string, lang string, source string, {clash}")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name in ("toxicity", "decontamination"):
            assert docs.count() == (7 if name == "toxicity" else 5)
        if k < 4:
            assert docs.columns == names
    assert {r.doc_id for r in docs.collect()} <= {None, 1, 2, 4}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, toxicity double")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).collect() == []
