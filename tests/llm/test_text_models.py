import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from glotta.llm import kneser_ney, packing, pii, sentence_pieces, toxicity, word_bpe
from tests.llm import brute

TEXTS = [None, "", " ", "It's THE end... <|endoftext|> naïve 12345 x", "a" * 3000, "日本語 😀\tÉté É", "the cat\nsat " * 700, "don't 'S 's", "same", "same", "\x85nbsp x\x1cy"]


def frame(spark, texts, extra="row_id int, ids string"):
    return spark.createDataFrame([(i, t, 1, "y") for i, t in enumerate(texts)], f"doc_id long, text string, {extra}").repartition(3)


def test_packing(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_bpe.default_path())
    rows = packing.pack(frame(spark, TEXTS), size=64, with_ids=True).collect()
    brute.packing_is_sound(rows, 64)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(by) == len(TEXTS)
    for d, pieces in by.items():
        pieces.sort(key=lambda r: r.start)
        ids = [i for r in pieces for i in r.ids]
        assert ids == library.encode(TEXTS[d] or "", add_special_tokens=False).ids + [1]
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) for r in pieces)
        assert [r.start for r in pieces] == [sum(len(q.ids) for q in pieces[:i]) for i in range(len(pieces))]
        assert all(r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) for r in pieces)
    assert packing.pack(frame(spark, [])).count() == 0


def test_patterns():
    rnd = random.Random(0)
    for size in (1, 7, 100):
        histogram = [0] + [rnd.choice([0, 1, 5, 300]) for _ in range(size)]
        found = packing.patterns(histogram, size)
        placed = collections.Counter()
        for many, pattern in found:
            assert sum(n * k for n, k in pattern) <= size
            for n, k in pattern:
                placed[n] += many * k
        assert placed == collections.Counter({n: c for n, c in enumerate(histogram) if c})


def test_pieces(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_path())
    tokens = sentence_pieces.encoded(frame(spark, TEXTS), how="merges")
    got = {r.doc_id: r.ids for r in tokens.collect()}
    assert got == {i: library.encode(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in sentence_pieces.decoded(tokens).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert all(r.round_trip for r in sentence_pieces.digests(frame(spark, TEXTS)).collect())
    assert sentence_pieces.digests(frame(spark, [])).count() == 0


def test_best_segmentations(spark):
    """The query's model against the library's own Viterbi, which reads the same
    pieces and scores as a unigram model; it adds up whole texts in single
    precision, so texts are short."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(sentence_pieces.default_path(), "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p, score in zip(m.pieces, sentence_pieces.rank_scores(len(m.pieces)), strict=True):
        p.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    rnd = random.Random(12)
    words = "the internationalisation of naïve Straße 12345 don't -- aaaa  日本語 😀 \u0301 Überraschung encyclopédie xyzzyq\t\n".split(" ")
    texts = [None, ""] + words + [rnd.choice([" ", "  ", ""]).join(rnd.choices(words, k=3)) for _ in range(300)]
    texts += ["".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(160, 1200)])) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    tokens = sentence_pieces.encoded(frame(spark, texts))
    got = {r.doc_id: r.ids for r in tokens.collect()}
    assert got == {i: library.encode(t or "") for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in sentence_pieces.decoded(tokens).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_viterbi():
    import itertools

    pieces, scores = ["a", "b", "ab", "abc", "bc", "c", "ca"], [-2.0, -2.1, -3.3, -5.0, -3.0, -1.9, -4.5]
    model = sentence_pieces.Viterbi(pieces, np.array(scores), np.arange(7), -20.0)

    def best(w):
        if not w:
            return 0.0
        found = [scores[i] + best(w[len(p) :]) for i, p in enumerate(pieces) if w.startswith(p)]
        return max(found + [-20.0 + best(w[1:])] * (w[0] not in pieces))

    every = ["".join(w) for w in itertools.product("abcx", repeat=4)]
    flat, count = model(np.array([[ord(c) for c in w] for w in every]))
    for w, ids in zip(every, np.split(flat, np.cumsum(count)[:-1]), strict=True):
        assert math.isclose(sum(scores[i] if i >= 0 else -20.0 for i in ids), best(w), abs_tol=1e-5)
        assert "".join(pieces[i] if i >= 0 else chr(-i - 1) for i in ids) == w
    rnd = random.Random(2)
    long = np.array([[ord(c) for c in rnd.choices("abcx", k=sentence_pieces.LONG + 9)] for _ in range(3)])
    as_long = model(long)
    sentence_pieces.LONG, kept = 10**9, sentence_pieces.LONG
    try:
        assert all((a == b).all() for a, b in zip(model(long), as_long, strict=True))
    finally:
        sentence_pieces.LONG = kept


def naive_pii(text):
    import re

    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"), "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii(spark):
    rnd = random.Random(1)
    bits = ["a.b@c-d.ef.g", "x@y", "@", "+1 (437) 555-0689", "+1234567890123456", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4539578763621486", "4539 5787-6362 1486", "123", " ", "é😀", "a@b.c@d.e", "-", "tel 055 123 4567", "FR7630006000011234567890189", "00000000000000", "_%+@a.b"]
    texts = [None, ""] + ["".join(rnd.choices(bits, k=rnd.randint(1, 9))) for _ in range(300)] + ["x" * 20000 + "@a.b " + "1" * 3000]
    for r in pii.spans(frame(spark, texts)).collect():
        want = naive_pii(texts[r.doc_id] or "")
        found = [tuple([k, int(a), int(b)]) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert [s for s in found if s[0] in pii.BASE] == want
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in pii.BASE)
        import hashlib

        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    assert pii.masked("write a@b.cd, IBAN FR76 3000 6000 0112 3456 7890 189.") == "write [EMAIL], IBAN [IBAN]."
    assert pii.find("1" * 1_000_000) == []  # linear in a run's length
    many = "a@b.cd tel 055 123 4567 " * 20_000
    assert [s.kind for s in pii.find(many)] == ["email", "local_phone"] * 20_000
    assert pii.spans(frame(spark, [])).count() == 0
    df = frame(spark, ["a@b.cd é", None]).withColumnRenamed("row_id", "n_chars")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df).collect()}
    assert got == {0: ("[EMAIL] é", 9), 1: (None, None)}


def test_toxicity(spark):
    rnd = random.Random(3)
    clean = [f"c{a}{b}" .translate(str.maketrans("0123456789", "abcdefghij")) for a in range(40) for b in range(10)]
    docs, labels = [(None, "cab")], [(None, 1), (3, None), (99999, 1)]
    for d in range(900):
        w = rnd.choices(clean, k=rnd.randint(5, 120))
        toxic = d % 8 == 0
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(["Vermin", "vileness,", "rottenen", "rottenly"]))
        docs.append((d, " ".join(w)))
        labels.append((d, int(toxic)))
    docs += [(1000, None), (1001, ""), (1002, docs[9][1]), (1003, docs[9][1])]
    df, lf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, lf).collect()}
    held = [r for d, r in got.items() if r.held_out and d is not None and d < 900]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items() if d is not None)
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in held) / len(held) > 0.97
    assert got[1002].score == got[1003].score and 0 <= got[1000].score == got[1001].score < 0.5
    kept = toxicity.keep_clean(df, lf)
    assert kept.columns == df.columns and kept.count() == sum(not r.predicted for r in got.values())
    for none in (lf.limit(0), lf.where("toxic = 0")):
        assert toxicity.score(df.limit(5), none).select("score").distinct().count() == 1
    assert toxicity.score(df.limit(0), lf).count() == 0


def test_toxicity_as_plain_python(spark):
    """The whole score against its definition: features by slices of words, all
    segments by their sums, from the learned table."""
    from glotta.llm.common import span_hashes

    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(150)]
    nice, bad = ["gentleness", "kindly", "lovely"], ["vileness", "vilest", "foulness"]
    docs = []
    for d in range(1200):
        w = rnd.choices(words, k=rnd.randint(0, 60))
        for x in rnd.choices(bad if d % 6 == 0 else nice, k=3) if d % 6 == 0 or rnd.random() < 0.6 else []:
            w.insert(rnd.randint(0, len(w)), x)
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(w)))
    docs += [(2000, None), (2001, "Vileness! " * 3 + "x " * 40_000 + "foulness"), (2002, "É vileness é")]
    df = spark.createDataFrame([(d, t, 0.5, "q") for d, t in docs], "doc_id long, text string, score double, passages string")
    lf = spark.createDataFrame([(d, int(d % 6 == 0), 1) for d in range(1200)], "doc_id long, toxic int, text int")
    m = toxicity.learn(df, lf)
    known = {int(k): (o, z) for k, o, z in zip(m.table.keys, m.table.odds, m.table.z)}
    assert min(m.table.odds) < 0 < max(m.table.odds)

    def hashed(raw, seed):
        a = np.frombuffer(raw, np.uint8)
        return int(span_hashes(a, np.array([0]), np.array([len(a)]), seed)[0])

    def plain(text):
        tokens = re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode())
        scores = []
        for t in tokens:
            has = [known[h] for h in [hashed(t, 1), *(hashed(t[:k], 2) for k in toxicity.PREFIXES if len(t) >= k)] if h in known]
            scores.append(max(has, key=lambda x: abs(x[1]))[0] if has else -toxicity.DRIFT)
        found, todo = [], [(0, len(scores))]
        while todo:  # the best segment, then those on its sides
            a, b = todo.pop()
            best, low, start, total = (0.0, 0, 0), 0.0, a, 0.0
            for i in range(a, b):
                if total <= low:
                    low, start = total, i
                total += scores[i]
                if total - low > best[0] + 1e-12:
                    best = (total - low, start, i)
            if best[0] > 0:
                found.append(best)
                todo += [(a, best[1]), (best[2] + 1, b)]
        chance = math.log(max(m.size * max(len(tokens), 1), 1e-12))
        beyond = sorted((m.scale * f[0] - chance for f in found), reverse=True) or [-chance]
        z = m.curve[0] + m.curve[1] * min(beyond[0], 60) + m.curve[2] * min(sum(x for x in beyond[1:] if x > 0), 60)
        return 1 / (1 + math.exp(-min(max(z, -35), 35)))

    got = {r.doc_id: r.score for r in toxicity.score(df, lf).collect()}
    for d, t in docs:
        assert math.isclose(got[d], plain(t), abs_tol=1e-6), d
    kept = {r.doc_id for r in toxicity.keep_clean(df, lf).collect()}
    assert kept == {d for d, s in got.items() if s < 0.5}


def test_segments_against_all():
    rnd = random.Random(4)
    for _ in range(200):
        full = [rnd.choice([2.0, 1.0, -0.7, -0.7, -1.5]) for _ in range(rnd.randint(1, 14))]
        n, at = len(full), [i for i, x in enumerate(full) if x > 0]
        found = toxicity.segments(at, [sum(full[:i]) for i in at], [sum(full[: i + 1]) for i in at])
        best = max((sum(full[i : j + 1]) for i in range(n) for j in range(i, n)), default=0)
        assert math.isclose(max((f[0] for f in found), default=0.0), max(best, 0.0), abs_tol=1e-9)
        assert all(math.isclose(f[0], sum(full[f[1] : f[2] + 1]), abs_tol=1e-9) for f in found)


def test_kneser_ney(spark):
    rnd = random.Random(6)
    vocabulary = ["the", "The", "cat", "é", "sat", "on", "a", "mat"] + [f"w{i}" for i in range(30)]
    texts = [None, ""] + [" ".join(rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rnd.randint(0, 40))) for _ in range(150)]
    got = {r.doc_id: r for r in kneser_ney.score(frame(spark, texts), 5).collect()}
    tokens = {d: [*brute.words(t, True), None] for d, t in enumerate(texts)}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    uni, bi = collections.Counter(), collections.Counter()
    for d, w in tokens.items():
        if not held[d]:
            uni.update(w)
            bi.update(zip(["<s>", *w], w))
    n, v = sum(uni.values()), len(uni)
    seen = collections.Counter(w for _, w in bi)
    after = collections.defaultdict(list)
    for (c, _), k in bi.items():
        after[c].append(k)
    d2, d1 = (kneser_ney.discounts(*[sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]) for c in (bi, seen))
    free = sum(d1[min(x, 3)] for x in seen.values()) / len(bi)
    p1 = lambda w: max(seen[w] - d1[min(seen[w], 3)], 0) / len(bi) + free / (v + 1)

    def p2(c, w):
        if c not in after:
            return p1(w)
        return (max(bi[c, w] - d2[min(bi[c, w], 3)], 0) + sum(d2[min(k, 3)] for k in after[c]) * p1(w)) / sum(after[c])

    for c in ("the", "<s>", "w29"):
        key = c.encode() if c != "<s>" else c
        assert math.isclose(sum(p2(key, w) for w in uni) + p2(key, "new"), 1)
    for d, w in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(w), sum(x in uni for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), abs_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p2(c, x)) for c, x in zip(["<s>", *w], w)), abs_tol=1e-9)
    assert kneser_ney.score(frame(spark, []), 3).count() == 0
    # no training rows at all: the uniform probability 1
    only = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(only, "a b")], "doc_id long, text string")
    assert kneser_ney.score(df, 3).first().score == pytest.approx(0)


def test_kneser_ney_wide_counts(spark):
    """Counts of 255 and more are kept apart from the others."""
    texts = ["a b " * 254, "a b " * 255, "c d " * 300, "e f"]
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 != 2][:4]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    model = kneser_ney.train(df, 2)
    reader = kneser_ney.Reader(model)
    import pyarrow as pa

    context, token, _ = kneser_ney._tokens(pa.array(["a b a", "c d", "e f"]))
    g = kneser_ney.gram(context, token)
    got = reader._look(kneser_ney.part_of(context, token, 2), g, ("gram", "count"), __import__("numpy").uint8, 1)[:, 0].tolist()
    # start a, a b, b a, a end; start c, c d, d end; start e, e f, f end
    assert got == [2, 509, 507, 0, 1, 300, 1, 1, 1, 1]


def test_kneser_ney_trigrams(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = [None, ""] + [" ".join(rnd.choices(vocabulary, weights=range(12, 0, -1), k=rnd.randint(0, 40))) for _ in range(120)]
    tokens = {d: [*brute.words(t, True), None] for d, t in enumerate(texts)}
    grams = collections.Counter()
    for d, w in tokens.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            grams.update(zip(["<s>", "<s>", *w], ["<s>", *w], w))
    levels = [grams]
    for _ in range(2):
        levels.insert(0, collections.Counter(g[1:] for g in levels[0]))
    cut = [kneser_ney.discounts(*[sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]) for c in levels]

    after = [collections.defaultdict(list) for _ in levels]
    for c, by in zip(levels, after, strict=True):
        for g, k in c.items():
            by[g[:-1]].append(k)

    def p(g):
        n = len(g) - 1
        c, d, seen = levels[n][g], cut[n], after[n].get(g[:-1])
        less = p(g[1:]) if n else 1 / (len(levels[0]) + 1)
        return less if not seen else (max(c - d[min(c, 3)], 0) + sum(d[min(k, 3)] for k in seen) * less) / sum(seen)

    got = {r.doc_id: r for r in kneser_ney.score(frame(spark, texts), 5, order=3).collect()}
    for d, w in tokens.items():
        assert math.isclose(got[d].score, sum(math.log10(p(g)) for g in zip(["<s>", "<s>", *w], ["<s>", *w], w)), abs_tol=1e-9)
        assert got[d].train_tokens == sum(grams.values())


def test_kneser_ney_missing_part(spark):
    """A part that is gone is an error, not an empty one."""
    import os

    df = frame(spark, ["a b c", "a b d", "b c"])
    model = kneser_ney.train(df, 4, order=3)
    folder = kneser_ney.Folder(model.folder)
    assert sum(len(folder.map(f"gram3-{p}", np.uint64)) for p in range(4)) > 0
    os.remove(f"{folder.path}/gram3-1")
    with pytest.raises(FileNotFoundError):
        folder.map("gram3-1", np.uint64)
    with pytest.raises(Exception, match="gram3-1"):
        [kneser_ney.Reader(model)._map("gram3", p, np.uint64) for p in range(4)]


def test_kneser_ney_of_common_words(spark):
    """Counts and sums far above a byte."""
    texts = ["the cat"] * 300 + ["the dog"] * 3 + [None] * 300 + [f"the w{i} cat" for i in range(400)]
    got = {r.doc_id: r.score for r in kneser_ney.score(frame(spark, texts), 5, 2).collect()}
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d in range(len(texts))]
    bi = collections.Counter()
    for t, h in zip(texts, held, strict=True):
        w = [*(t or "").split(), "</s>"]
        bi.update([] if h else zip(["<s>", *w], w))
    seen = collections.Counter(w for _, w in bi)
    d2, d1 = (kneser_ney.discounts(*[sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]) for c in (bi, seen))
    free = sum(d1[min(x, 3)] for x in seen.values()) / len(bi)

    def p(c, w):
        lower = max(seen[w] - d1[min(seen[w], 3)], 0) / len(bi) + free / (len(seen) + 1)
        after = [k for (a, _), k in bi.items() if a == c]
        return (max(bi[c, w] - d2[min(bi[c, w], 3)], 0) + sum(d2[min(k, 3)] for k in after) * lower) / sum(after)

    assert math.isclose(got[0], sum(math.log10(p(c, w)) for c, w in [("<s>", "the"), ("the", "cat"), ("cat", "</s>")]), abs_tol=1e-9)
    assert math.isclose(got[400], math.log10(p("<s>", "</s>")), abs_tol=1e-9)


def test_kneser_ney_scores_as_by_a_model(spark):
    """Any order, words in many parts, frequent ones in shares, rows without ids."""
    from glotta.llm import kneser_ney_scores

    rnd = random.Random(11)
    vocabulary = ["the", "The", "é"] + [f"w{i}" for i in range(40)]
    texts = [None, "", " the "] + [" ".join(rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rnd.randint(0, 30))) for _ in range(150)]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "the w1 w2 w3", 0), (7, "w1 w1 w1 new", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    frequent, salts = kneser_ney_scores._frequent(df, 10**4, 60)
    assert len(frequent) > 5 and salts == kneser_ney_scores.SALTS
    flat = lambda out: sorted(map(tuple, out.collect()), key=str)
    for order in (2, 3, 4):
        want = flat(kneser_ney.score_by(kneser_ney.train(df.where(~kneser_ney.held_out()), 5, order), df))
        for parts in (1, 60):
            got = flat(kneser_ney.score(df, parts, order))
            assert len(got) == len(rows) and [r[:5] for r in got] == [r[:5] for r in want]
            assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


def test_kneser_ney_scores_keys():
    from glotta.llm import kneser_ney_scores

    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 5, 2000) for _ in range(4)]
    order = np.lexsort(columns[::-1])
    for size in (5, 1 << 40):
        key = kneser_ney_scores._key(columns, [size] * 4)
        assert (np.sort(key) == key[order]).all()
        assert len(np.unique(key)) == len(set(zip(*columns)))


def test_kneser_ney_scores_missing_totals(spark, tmp_path):
    from glotta.llm import kneser_ney_scores

    plan = kneser_ney_scores.Plan(f"file://{tmp_path}", 2, 3, np.zeros(0, np.uint64), 16)
    kneser_ney_scores._save_totals(plan, 0, np.zeros((4, 4), np.int64), np.zeros(9, np.int64), np.zeros((0, 8), np.uint64))
    with pytest.raises(FileNotFoundError):
        kneser_ney_scores.Totals(plan)


def test_kneser_ney_trigrams_in_little_disk(spark, tmp_path, monkeypatch):
    """Shuffle files and the folder take less than 12 bytes a token: 4 times the
    input are 15 where a token takes 3.7, as in the tool's documents."""
    import os

    from glotta.llm import kneser_ney_scores

    monkeypatch.setattr(kneser_ney_scores, "shared_dir", lambda _: f"file://{tmp_path}")
    rnd = random.Random(12)
    weights = [1 / (i + 10) for i in range(60_000)]
    texts = [" ".join(map("w{}".format, rnd.choices(range(60_000), weights, k=1000))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()
    df.count()
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    kept = lambda: sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(tmp_path) for f in names)
    before = written()
    tokens = sum(r.n_tokens for r in kneser_ney.score(df, 16, order=3).collect())
    df.unpersist()
    assert tokens == 400 * 1001
    assert kept() > 0
    assert written() - before + kept() < 12 * tokens
