"""Queries on odd texts, and what grows with their input."""

import random
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from glotta.functions import signal as S
from glotta.functions import text as T
from glotta.operators import segments as G
from glotta.plans.queries import ORACLES, QUERIES

from .test_oracle import DATA, rows


def against_sql(spark, tmp_path, name, **tables):
    """A query over these tables against its SQL over them."""
    c = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got, want = QUERIES[name](spark, str(tmp_path)).toPandas(), c.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
    return got


def documents(spark, texts):
    data = [(i, t, "fr", "web", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("first", ["ß", "ŉ", "ᾳ", "ᾀ", "ǰ", "ﬁ", "ΰ", "ǆ", "é", "İ", "Σ", "😀", ".", "\n"])
def test_sentences_begin_as_in_sql(spark, tmp_path, first):
    texts = [first, f"{first}heit. {first}a", f"a.\n{first}b\n\n{first}c", f"ΟΔΟΣ. {first}", f"a.\u00a0b?\u2028c. d!\x0be{first}\nf", "", None]
    against_sql(spark, tmp_path, "capitalize_sentences", documents=documents(spark, texts))


def test_sentences_begin_as_in_python(spark):
    got = spark.createDataFrame([("ß. a.\u00a0b",)], "t string").select(T.capitalize_sentences(F.col("t"))).first()[0]
    assert got == "SS. A.\u00a0B"


@pytest.mark.parametrize("name", ["normalize_text", "normalize_plain"])
def test_normalizing_needs_no_python(spark, name):
    assert "Python" not in QUERIES[name](spark, DATA)._jdf.queryExecution().toString()


def test_composition_as_in_python(spark):
    texts = ["é", "ÅΩ", "각", "q̣̇", "क़", "\U0001d15e", "à́b", "豈", "", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.nfc(F.col("t")).alias("t")).collect()]
    assert got == [t and unicodedata.normalize("NFC", t) for t in texts]


@pytest.mark.parametrize("block", [4, 5, 7, 64])
def test_blocks_fold_as_one(spark, block):
    rng = random.Random(block)
    data = [(i * 3, rng.choice([None, float("nan"), 0.0, 1.0, 5.5, 9.2, 13.7, 20.1, 27.6, 28.0, 40.0, rng.random() * 16]), f"t{i}") for i in range(500)]
    got = {r.group: r for r in G.pack_by_fold(spark.createDataFrame(data, "pos long, d double, t string"), "pos", "d", "t", block=block).collect()}
    group, n, used, members = 0, 0, 0.0, {}
    for _, d, t in data:
        x = (d if d and d == d else 0.0) + 0.4
        if n < 4 and used + x <= 28.0:
            n, used = n + 1, used + x
        elif n < 2 or x > 28.0:
            group, n, used = group + 1, 0, 0.0
            continue
        else:
            group, n, used = group + 1, 1, x
        members.setdefault(group, []).append((d, t))
    lengths = {g: None if any(d is None for d, _ in m) else sum((d for d, _ in m), 0.0) + (len(m) - 1) * 0.4 for g, m in members.items()}
    kept = {g: m for g, m in members.items() if len(m) >= 2 or (lengths[g] is not None and not lengths[g] < 1.5)}
    assert {g: r.texts for g, r in got.items()} == {g: [t for _, t in m] for g, m in kept.items()}
    assert len(kept) > 100


def test_a_fold_moves_no_texts(spark):
    plan = QUERIES["pack_by_duration"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.split("Relation")[0] and "_all" not in plan


def test_labels_of_odd_texts_as_in_sql(spark, tmp_path):
    texts = ["", None, "😀é\u0000\n", "x" * 40, " ", *[chr(300 + i) * (i % 7) for i in range(40)]]
    against_sql(spark, tmp_path, "label_pad_shift", documents=documents(spark, texts))


def test_labels_are_made_in_many_tasks(spark):
    plan = QUERIES["label_pad_shift"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_joined_labels_are_the_arrays_joined(spark):
    rows = spark.createDataFrame([([], 3), ([], 0), ([7], 1), ([7, 8, 9], 0), ([1] * 5, 12)], "ids array<int>, n int")
    joined = S.joined_labels(F.array_join(F.col("ids").cast("array<string>"), ","), F.col("n"), [50258, 50265], 50257, 50257, 50258)
    padded = S.padded_labels(S.labels([50258, 50265], F.col("ids"), 50257, 50257), F.size("ids") + 3 + F.col("n"))
    for r in rows.select(*joined, padded.alias("p"), S.decoder_input(padded, 50258, 50257).alias("d")).collect():
        assert r.labels == ",".join(map(str, r.p)) and r.decoder == ",".join(map(str, r.d))


def test_the_pad_id_is_no_label(spark, tmp_path):
    documents(spark, ["쑑", "a쑑b쑑", "c"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.labels for r in QUERIES["label_pad_shift"](spark, str(tmp_path)).collect()}
    assert got == {0: "50258,50265,50257,-100,-100", 1: "50258,50265,97,98,50257", 2: "50258,50265,99,50257,-100"}


@pytest.mark.parametrize("name", ["dataset_summary", "validate_plain"])
def test_validation_needs_no_python(spark, name):
    assert "Python" not in QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
