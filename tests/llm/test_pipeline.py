import os

import duckdb
import pytest

import corpus_pipeline
from glotta.llm import pii, word_bpe
from glotta.llm.oracles import ORACLES
from glotta.llm.queries import QUERIES
from tests.llm import brute
from tests.test_oracle import rows

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    got, want = QUERIES[name](spark, DATA).toPandas(), c.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_registered(spark):
    import __spark_entry__ as e

    names = {n.split("_")[0] for n in e.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 11)} and "pipeline" in e.queries()


def test_stages(spark, tmp_path):
    """Each stage against plain Python on what it was given."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, DATA)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id: r.text for r in docs.collect()})
        assert all(r.n_chars == len(r.text) for r in docs.collect()) or i < 2
    _, clean, single, bare, masked = seen
    toxic = {r.doc_id for r in QUERIES["op2_toxicity"](spark, DATA).where("predicted = 1").collect()}
    assert set(clean) == set(seen[0]) - toxic
    classes = brute.near_duplicates(sorted(clean.items()))
    assert set(single) == {d for d, (_, c) in classes.items() if c == d}
    for d, n, lost, _, kept in brute.substring_dedup(sorted(single.items())):
        assert bare[d] == (kept if lost else single[d])
    assert masked == {d: pii.masked(t) for d, t in bare.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    brute.packing_is_sound(packed, 2048)
    tokenizer = word_bpe._library(word_bpe.default_path())
    assert sum(r.length for r in packed) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in masked.values())
    assert sorted(map(tuple, packed)) == sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect()))


def test_stages_on_few_and_repeated_rows(spark):
    """No rows, null texts and ids, repeated rows, and one id with two texts."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "x y z"), (3, None), (None, "q r s"), (None, None), (4, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts], columns)
    want = [texts[i] for i in (0, 1, 3, 4, 5, 6, 7)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
        out = stage(spark, docs, DATA)
        if name == "packing":
            assert out.count() == len(texts)
        else:
            kept = want if name == "near_dedup" else texts
            assert out.columns == docs.columns
            assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(kept, key=repr), name
