import random

import pytest

from glotta.llm import components, minhash_dedup, substring_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, hashes string, _id long"


def frame(spark, docs, parts=3):
    """With extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 7) for d, t in docs], SCHEMA).repartition(parts)


def passages(seed=0, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本"]
    shared = [rnd.choices(vocabulary, k=rnd.randint(8, 40)) for _ in range(6)]
    docs = []
    for d in range(n):
        w = rnd.choices(vocabulary, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            w[at:at] = rnd.choice(shared)
        docs.append((d, rnd.choice([" ", "\n", " \t "]).join(w)))
    docs += [(n, None), (n + 1, ""), (n + 2, docs[3][1]), (n + 3, docs[3][1]), (None, docs[3][1]), (5, docs[4][1]), (n + 4, "a b " * 40)]
    docs.append((n + 5, docs[7][1] + " " + "long" * 5000))
    return docs


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k", [2, 10])
def test_substring(spark, k):
    docs = passages()
    got = rows(substring_dedup.remove_repeats(frame(spark, docs), k, 1 << 17))
    assert got == sorted((r[:4] for r in brute.substring_dedup(docs, k)), key=repr)
    assert sum(g[2] for g in got) > 0


def test_substring_with_a_full_sketch(spark):
    docs = passages(1)
    full = rows(substring_dedup.remove_repeats(frame(spark, docs), 10, 1 << 16))
    assert full == sorted((r[:4] for r in brute.substring_dedup(docs, 10)), key=repr)


def test_substring_keeps_columns(spark):
    docs = passages(2)
    df = frame(spark, docs)
    got = substring_dedup.without_repeats(df, 10, 1 << 16)
    assert got.columns == df.columns
    want = sorted(((d, kept if n else t) for (d, t), (_, _, n, _, kept) in zip(docs, brute.substring_dedup(docs, 10))), key=repr)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == want


def test_substring_empty(spark):
    assert rows(substring_dedup.remove_repeats(frame(spark, []), 50, 1 << 16)) == []


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return words


def copies(seed=0):
    rnd = random.Random(seed)
    docs = []
    for g in range(8):
        base = [f"g{g}v{rnd.randrange(500)}" for _ in range(rnd.randint(20, 150))]
        for _ in range(rnd.randint(1, 25)):
            docs.append(" ".join(edited(rnd, base, rnd.randint(0, 4))))
    docs += [docs[0], docs[0].upper(), "a", "A", "a b", "b a", "", "  ", None, "a a a a", "a a a"]
    rnd.shuffle(docs)
    return [(3 * i + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("block", [4, 512])
def test_minhash(spark, block):
    docs = copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.classes(frame(spark, docs), block=block).collect()}
    assert got == brute.near_duplicates(docs)


def test_minhash_rows(spark):
    docs = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (2, "x y z")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.classes(frame(spark, docs)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 2, 1, False), (2, 1, 2, True)], key=repr)
    assert minhash_dedup.classes(frame(spark, [])).count() == 0
    kept = minhash_dedup.keep_one(frame(spark, docs).withColumnRenamed("hashes", "_one"))
    assert kept.columns == ["doc_id", "text", "_one", "_id"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([docs[0], docs[1], docs[2], docs[4]], key=repr)
    assert minhash_dedup.keep_one(frame(spark, [])).count() == 0


def test_minhash_of_a_hub(spark):
    """Hundreds of near copies of one text, more than a heavy key's rows."""
    base = [f"v{i}" for i in range(80)]
    docs = [(i, " ".join(base + [f"x{i}"])) for i in range(450)] + [(1000 + i, " ".join(base)) for i in range(300)]
    got = {r.doc_id: r.component_id for r in minhash_dedup.classes(frame(spark, docs), block=64).collect()}
    assert got == {d: 0 for d, _ in docs}
    assert [r.doc_id for r in minhash_dedup.keep_one(frame(spark, docs)).collect()] == [0]


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    want = brute.components({x for e in links for x in e}, links)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in links)}


def test_minhash_of_longer_shingles(spark):
    """A copy with 18 words appended shares 96 of 114 five-word shingles, which
    is under 85 % and over 80 %."""
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(118)]
    df = spark.createDataFrame([(1, " ".join(words[:100])), (2, " ".join(words)), (3, " ".join(reversed(words)))], "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash_dedup.keep_one(df).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in minhash_dedup.keep_one(df, 80, 5).collect()) == [1, 3]
    assert minhash_dedup._bounds(85) == (minhash_dedup.BAND, minhash_dedup.LEAST)
    assert minhash_dedup._bounds(80)[0] == 4
