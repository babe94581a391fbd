import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glotta.llm import permutation_ann, progressive_jpeg, wrapper_induction


def text_frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, b"z") for i, t in enumerate(texts)], "doc_id long, text string, row_id int, media binary").repartition(3)


def test_jpeg_round_trip(spark):
    texts = [None, "", "a", "é" * 288, "x" * 577, "\x00\x7f" * 1000, "same", "same", "日本" * 9000]
    media = progressive_jpeg.store(text_frame(spark, texts))
    got = {r.doc_id: r for r in progressive_jpeg.digests(media).collect()}
    for d, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[6][1:] == got[7][1:] and got[0][1:] == got[1][1:]
    for r in progressive_jpeg.tensors(media).collect():
        assert len(r.rgb) == r.height * r.width * 3
    assert progressive_jpeg.digests(progressive_jpeg.store(text_frame(spark, []))).count() == 0


def test_jpeg_every_byte():
    every = np.tile(np.arange(256, dtype=np.uint8), 9)
    raw = progressive_jpeg.encode(every)
    assert progressive_jpeg.Image(raw).payload() == every.tobytes()
    assert raw[:2] == b"\xff\xd8" and raw[-2:] == b"\xff\xd9"


def test_inverse_transform():
    x = np.random.default_rng(0).normal(size=(8, 8))
    c = lambda u: np.sqrt(1 / 8) if u == 0 else 0.5
    want = [[sum(c(u) * c(v) * x[u, v] * np.cos((2 * i + 1) * u * np.pi / 16) * np.cos((2 * j + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) for j in range(8)] for i in range(8)]
    assert np.allclose(x.ravel()[progressive_jpeg.ZIGZAG] @ progressive_jpeg._BASIS, np.ravel(want), atol=1e-4)


class Writer:
    """Bits for scans as other encoders write them: runs, ends of bands."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> (n - 1 - i) & 1 for i in range(n)]

    def data(self):
        return np.packbits(self.bits + [1] * (-len(self.bits) % 8))


def flat_code():
    """All 256 symbols in 9 bits."""
    return progressive_jpeg.Code(bytes([0] * 8 + [255] + [0] * 7), bytes(range(255)))


def test_sparse_scans():
    """Spectral selection and successive approximation over sparse blocks."""
    rnd = np.random.default_rng(1)
    blocks = np.where(rnd.random((40, 64)) < 0.08, rnd.integers(-30, 31, (40, 64)), 0).astype(np.int16)
    blocks[10:14] = 0
    code, first, last = flat_code(), 1, 63
    w = Writer()
    for b in blocks:  # magnitudes without their lowest bit
        run = 0
        for k in range(first, last + 1):
            v = int(np.sign(b[k]) * (abs(int(b[k])) >> 1))
            if not v:
                run += 1
                continue
            while run > 15:
                w.put(0xF0, 9)
                run -= 16
            size = abs(v).bit_length()
            w.put(run << 4 | size, 9)
            w.put(v if v > 0 else v + (1 << size) - 1, size)
            run = 0
        if run:
            w.put(0, 9)
    got = np.zeros_like(blocks)
    progressive_jpeg._ac_first(progressive_jpeg.Bits(w.data()), code, got, first, last, 1)
    want = (np.sign(blocks) * (np.abs(blocks) >> 1 << 1)).astype(np.int16)
    want[:, 0] = 0
    assert (got == want).all()
    w = Writer()
    for b, old in zip(blocks, want, strict=True):
        k, fresh = first, [k for k in range(first, last + 1) if abs(int(b[k])) == 1]
        for at in fresh:
            run = sum(old[i] == 0 for i in range(k, at))
            while run > 15:
                w.put(0xF0, 9)
                passed = 0
                while True:
                    if old[k]:
                        w.put(abs(int(b[k])) & 1, 1)
                    else:
                        passed += 1
                    k += 1
                    if passed == 16:
                        break
                run -= 16
            w.put(run << 4 | 1, 9)
            w.put(int(b[at] > 0), 1)
            for i in range(k, at):
                if old[i]:
                    w.put(abs(int(b[i])) & 1, 1)
            k = at + 1
        if k <= last:
            w.put(0, 9)
            for i in range(k, last + 1):
                if old[i]:
                    w.put(abs(int(b[i])) & 1, 1)
    progressive_jpeg._ac_refine(progressive_jpeg.Bits(w.data()), code, got, first, last, 0)
    assert (got[:, 1:] == blocks[:, 1:]).all()


#: A 37 x 29 image as a usual encoder writes it: 4:2:0, DC scans that interleave
#: all components, AC scans by band and bit.
USUAL = """
/9j/4AAQSkZJRgABAgAAAQABAAD/2wBDAAYEBQYFBAYGBQYHBwYIChAKCgkJChQODwwQFxQYGBcUFhYaHSUfGhsjHBYWICwgIyYnKSopGR8tMC0oMCUoKSj/2wBDAQcHBwoIChMKChMoGhYaKCgoKC
goKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCgoKCj/wgARCAAdACUDASIAAhEBAxEB/8QAGgAAAgMBAQAAAAAAAAAAAAAAAwQAAQYCBf/EABcBAAMBAAAAAAAAAAAAAAAA
AAMEBQH/2gAMAwEAAhADEAAAATseelHV0p8a3tnXReGDmaCdtC2eT7Vfi8KT/8QAGxABAQACAwEAAAAAAAAAAAAAAQACAwQSMxP/2gAIAQEAAQUCGGGGGG2+lxfcYZw7PxtWnrmMRERf/8QAHhEAAg
ICAgMAAAAAAAAAAAAAAQIAEQMEBRITFBX/2gAIAQMBAT8B4/T9h+t1PmeNS3aBJqu+E2hi7GVxRMCz/8QAGhEAAwEAAwAAAAAAAAAAAAAAAAETAgQRMf/aAAgBAgEBPwGfQsokRT9Fx8kz/8QAGxAA
AAcBAAAAAAAAAAAAAAAAAAECEBESIDL/2gAIAQEABj8C0bJeZHQJVt//xAAfEAABBAAHAAAAAAAAAAAAAAAAARARISAxQWGBseH/2gAIAQEAAT8hwf8AS3divP0UtyNE7CT8GdiNIKRYsWLFH//aAA
wDAQACAAMAAAAQ6Xw3GO//xAAeEQABAwQDAAAAAAAAAAAAAAABABEhMUFRgWFx0f/aAAgBAwEBPxBypA9HuBkZRGQsCaY2oFCcSGsY30jx2DwPFCv/xAAXEQEBAQEAAAAAAAAAAAAAAAABABEQ/9oA
CAECAQE/EEDWQhnCHIdELN//xAAfEAACAQMFAQAAAAAAAAAAAAAAAREhQWEQMVFx8LH/2gAIAQEAAT8Q2K6GYzaieX18WjyvKzkGwLtEpVbsVw+5EXp2ZlNbzk5A8aNoNoNg/9k=
"""
#: What that encoder's own decoder shows at every 7th row and 9th column.
SHOWN = [[[57, 200, 48], [100, 198, 59], [144, 195, 76], [168, 203, 85], [202, 200, 117]], [[66, 174, 52], [97, 180, 74], [164, 162, 88], [202, 162, 101], [201, 182, 126]], [[68, 154, 65], [130, 141, 73], [185, 66, 32], [214, 55, 36], [198, 160, 137]], [[65, 134, 79], [87, 144, 99], [129, 138, 111], [175, 137, 128], [200, 140, 152]], [[69, 113, 96], [102, 114, 112], [131, 119, 129], [165, 120, 143], [200, 118, 164]]]


def test_usual_file():
    import base64

    image = progressive_jpeg.Image(base64.b64decode(USUAL))
    rgb = image.rgb()
    assert rgb.shape == (29, 37, 3) and [p[:2] for p in image.parts.values()] == [(2, 2), (1, 1), (1, 1)]
    got, want = rgb[::7, ::9].astype(float), np.array(SHOWN, float)
    brightness = np.array([0.299, 0.587, 0.114])
    assert np.abs(got @ brightness - want @ brightness).max() < 2
    # the other decoder smooths colours between samples, which moves them little inside an even area
    assert np.abs(got - want)[0, 0].max() < 8 and np.abs(got - want).mean() < 8


def test_restarts():
    """Restart intervals begin anew, in scans of one component and of several."""
    p = progressive_jpeg
    frame = lambda parts: p._segment(0xC2, bytes([8, 0, 16, 0, 32, len(parts)]) + bytes(x for c in parts for x in c))
    head = b"\xff\xd8" + p._segment(0xDB, b"\x00" + b"\x01" * 64) + p._TABLES + p._segment(0xDD, bytes([0, 2]))

    def dc(values):
        bits, last = Writer(), 0
        for v in values:
            d, last = v - last, v
            n = abs(d).bit_length()
            bits.put(n, 4)
            bits.put(d if d > 0 else d + (1 << n) - 1, n) if n else None
        return bits.data().tobytes().replace(b"\xff", b"\xff\x00")

    values = [5, -3, 100, 100, 7, 0, -90, 1]
    parts = [dc(values[i : i + 2]) for i in range(0, 8, 2)]
    data = b"".join(x + bytes([255, 0xD0 + i]) for i, x in enumerate(parts[:-1])) + parts[-1]
    one = p.Image(head + frame([(1, 0x11, 0)]) + p._segment(0xDA, bytes([1, 1, 0, 0, 0, 0])) + data + b"\xff\xff\xd9")
    assert one.parts[1][3][:, 0].tolist() == values
    # two units of four and two times one block each; a restart between them needs an interval of one
    head = head.replace(p._segment(0xDD, bytes([0, 2])), p._segment(0xDD, bytes([0, 1])))
    y, cb, cr = [1, 2, 30, 4, -5, 6, 7, 8], [9, -9], [50, 51]
    shown = []
    for u in range(2):
        bits = Writer()
        for group in (y[4 * u : 4 * u + 4], cb[u : u + 1], cr[u : u + 1]):
            last = 0
            for v in group:
                d, last = v - last, v
                n = abs(d).bit_length()
                bits.put(n, 4)
                bits.put(d if d > 0 else d + (1 << n) - 1, n)
        shown.append(bits.data().tobytes())
    three = p.Image(head + frame([(1, 0x22, 0), (2, 0x11, 0), (3, 0x11, 0)]) + p._segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 0])) + shown[0] + b"\xff\xd0" + shown[1] + b"\xff\xd9")
    assert three.parts[1][3][:, 0].tolist() == [1, 2, -5, 6, 30, 4, 7, 8]
    assert (three.parts[2][3][:, 0].tolist(), three.parts[3][3][:, 0].tolist()) == (cb, cr)


def test_jpeg_of_megabytes(spark):
    text = "größer 123 " * 200_000
    r = progressive_jpeg.digests(progressive_jpeg.store(text_frame(spark, [text]))).first()
    raw = text.encode() + b"\xff" * (-len(text.encode()) % 576)
    assert r.payload_sha256 == hashlib.sha256(raw).hexdigest() and len(r.feature) > 10


VECTORS = "vec_id long, embedding array<float>, block int, part string"


def test_search(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(1500, 16)).astype(np.float32)
    x[300:700] = x[5]  # a third are copies
    rows = [(i, [float(a) for a in v], 0, "p") for i, v in enumerate(x)]
    rows += [(2000, None, 0, "p"), (2100, [0.0] * 16, 0, "p"), (2200, [float("nan")] * 16, 0, "p"), (2300, [float("inf")] * 16, 0, "p"), (None, [1.0] * 16, 0, "p"), (2400, [1.0, 2.0], 0, "p"), (2500, [None] * 16, 0, "p"), (100, rows[100][1], 0, "p")]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = {}
    for r in permutation_ann.search(df, F.col("vec_id") % 100 == 0, block=8000).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = x.astype(np.float64)
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(1500), d))[:10]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        assert all(f[2] == pytest.approx(d[f[1]], abs=1e-12) for f in found)
        hits += len(set(best) & {f[1] for f in found})
    assert hits >= 0.9 * 150 and set(got) == set(range(0, 1500, 100))
    assert [v for _, v, _ in sorted(got[400])] == [5, *range(300, 309)]


def test_search_small(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert permutation_ann.search(empty, F.col("vec_id") % 100 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, ""), (1, [0.0, 1.0], 0, ""), (2, [1.0, 1.0], 0, "")], VECTORS)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in permutation_ann.search(few, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 2**0.5)]


def test_footrule():
    rnd = np.random.default_rng(2)
    x, pivots = rnd.normal(size=(50, 4)), rnd.normal(size=(12, 4))
    index = permutation_ann.Index(x, pivots, 5)
    near = permutation_ann._places(x, pivots, 5)
    place = np.full((50, 12), 5)
    for i, n in enumerate(near):
        place[i, n] = np.arange(5)
    for q in range(5):
        assert (index.footrule(near[q]) == np.abs(place - place[q]).sum(axis=1)).all()


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><!-- x <p>no</p> --><div class="ad">Buy</div>
{body}<aside>s</aside><form><input value="q"><button>Go</button></form><div id="comments"><article class="comment"><p>me too</p></article></div>
<div class="cookie-notice">ok</div><footer>&copy; f</footer></body></html>"""


@pytest.mark.parametrize(
    "body, want",
    [
        ("<article><h1>A &amp; B</h1><p><b>one\n two.<br><p>three</p></article>", "A & B\none two.\nthree"),
        ("<article><p>x<p>y &lt;z&gt; &eacute;&#233;&nbsp;w</article>", "x\ny <z> éé w"),
        ("<article><ul><li>a<li>b</ul>tail<table><tr><td>c<td>d</table></article>", "a\nb\ntail\nc\nd"),
        ("<article>a<script>b</script><span style='display:none'>c</span>d<!-- e -->f</article>", "adf"),
        ("<article><p>1 < 2 & 3</p><div class='share-buttons'>s</div></article>", "1 < 2 & 3"),
        ("<main><p>m</p></main>", "m"),
        ("<div><p>plain text of a page</p><p><a href='x'>only a link</a></p></div>", "plain text of a page"),
        ("<article></article>", ""),
    ],
)
def test_extract(body, want):
    assert wrapper_induction.extract(PAGE.replace("{body}", body)) == want


def test_broken_pages():
    for page in ("", "<", "<p", "</p></div>", "<!-- open", "<a href=\"x>y", "<script>z", "text", "<p>" * 3000 + "x"):
        assert isinstance(wrapper_induction.extract(page), str)
    assert wrapper_induction.extract("text & more") == "text & more"


def test_tree_matching():
    a, b = wrapper_induction.Tree("<div><p>1</p><ul><li>x</ul><p>2</p></div>"), wrapper_induction.Tree("<div><p>1</p><p>new</p><ul><li>x<li>y</ul><p>2</p></div>")
    pairs = {(a.nodes[i].tag, a.text(i), b.text(j)) for i, j in wrapper_induction.match(a, b)}
    assert len(pairs) == 6 and ("li", "x", "x") in pairs and all(a.nodes[i].tag == b.nodes[j].tag for i, j in wrapper_induction.match(a, b))


def test_wrapper(spark):
    """Blocks that a host repeats are template, though nothing marks them."""
    rnd = random.Random(0)
    word = lambda: "".join(rnd.choices("abcdef", k=5))
    pages, want = [], {}
    for i in range(40):
        own = [" ".join(word() for _ in range(rnd.randint(3, 9))) for _ in range(rnd.randint(1, 5))]
        page = "<html><body><div><p>Welcome to this site</p></div><div>" + "".join(f"<p>{x}</p>" for x in own) + "</div><div><p>All rights reserved here</p></div></body></html>"
        pages.append((i, "http://one.example/" + str(i), page, "q"))
        want[i] = "\n".join(own)
    pages += [(100, None, "<p>x y</p>", ""), (101, "nowhere", "<p>z</p>", ""), (102, "http://one.example/n", None, ""), (103, "http://b.example", "", ""), (104, "http://c.example", "<p>solo</p>", "")]
    want |= {100: "x y", 101: "z", 102: "", 103: "", 104: "solo"}
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string").repartition(4)
    got = {r.page_id: (r.text, r.n_chars) for r in wrapper_induction.main_text(df).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}
    names = ("BROADCAST_BYTES", "BROADCAST_ROWS", "SHARE_PAGES", "KEPT")
    kept = [getattr(wrapper_induction, n) for n in names]
    try:
        for n, v in zip(names, (-1, -1, 7, 0), strict=True):
            setattr(wrapper_induction, n, v)
        assert {r.page_id: r.text for r in wrapper_induction.main_text(df).collect()} == want
    finally:
        for n, v in zip(names, kept, strict=True):
            setattr(wrapper_induction, n, v)
    assert wrapper_induction.main_text(df.limit(0)).count() == 0


def test_tree_matching_of_long_lists():
    """Long child lists align as exactly as short ones."""
    rnd = random.Random(7)
    shapes = ["<p>x</p>", "<ul><li>a</ul>", "<ul><li>a<li>b</ul>", "<div><p>x</p></div>", "<table><tr><td>z</table>"]
    kept = wrapper_induction.CELLS
    for n, m in ((3, 4), (1, 9), (20, 31), (40, 40)):
        a, b = (wrapper_induction.Tree("<div>" + "".join(rnd.choices(shapes, k=k)) + "</div>") for k in (n, m))
        short = wrapper_induction.match(a, b)
        wrapper_induction.CELLS = 0
        try:
            long = wrapper_induction.match(a, b)
        finally:
            wrapper_induction.CELLS = kept
        assert len(long) == len(short)
        assert all(a.nodes[i].tag == b.nodes[j].tag for i, j in long)
        assert len({i for i, _ in long}) == len({j for _, j in long}) == len(long)
    one = "".join(f"<p>{i}</p>" for i in range(300))
    a = wrapper_induction.Tree(f"<div>top</div>{one}<div>end</div>")
    b = wrapper_induction.Tree(f"<div>top</div><ul><li>new</ul>{one}<div>end</div>")
    pairs = [(a.text(i), b.text(j)) for i, j in wrapper_induction.match(a, b) if a.text(i)]
    assert ("end", "end") in pairs and all(x == y for x, y in pairs) and len(pairs) == 302


def test_wrapper_with_a_stub(spark):
    """One stub on a host, its shortest page, leaves the host its template."""
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcdef", k=5))
    pages, want = [(900, "http://one.example/stub", "<html><body> </body></html>")], {900: ""}
    for i in range(30):
        own = [" ".join(word() for _ in range(rnd.randint(3, 9))) for _ in range(rnd.randint(1, 5))]
        # the top block is missing on a third of all pages
        top = "<section><p>Welcome to this site</p></section>" if i % 3 else ""
        page = f"<html><body>{top}<div>" + "".join(f"<p>{x}</p>" for x in own) + "</div><table><tr><td>All rights reserved here</td></tr></table></body></html>"
        pages.append((i, f"http://one.example/{i}", page))
        want[i] = "\n".join(own)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in wrapper_induction.main_text(df).collect()} == want


def recall(x, queries, share=permutation_ann.SHARE):
    """Share of the true ten nearest among those reranked, and reranked share."""
    index = permutation_ann.Indexes(x, np.arange(len(x)), permutation_ann.PIVOTS, permutation_ann.PREFIX)
    hits, seen = 0, 0
    for q in queries:
        at, _ = index.nearest(x[q], int(np.ceil(share / 2 * len(x))))
        best = np.argsort(((x - x[q]) ** 2).sum(axis=1))[1:11]
        hits, seen = hits + len(set(best) & set(at)), seen + len(at)
    return hits / 10 / len(queries), seen / len(x) / len(queries)


def test_recall_beside_a_crowd():
    """A fifth of all vectors in one spot crowds nothing out, and is searched."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(10_000, 64))
    x[::5] = x[0] + 0.1 * rnd.normal(size=(2000, 64))
    for queries in (range(1, 200, 5), range(5, 200, 5)):
        found, seen = recall(x, queries)
        assert found >= 0.9 and seen <= 0.105


def test_recall_of_a_full_block():
    """The index by itself prunes, and still finds."""
    x = np.random.default_rng(3).normal(size=(permutation_ann.BLOCK_VALUES // 64, 64))
    found, seen = recall(x, range(1000, 1040))
    assert found >= 0.9 and seen <= 0.105


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test data here")
def test_recall_with_pruning(spark):
    """Over sf0.1, where a tenth of the vectors is reranked, against all pairs."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in permutation_ann.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        hits += len(got[ids[i]] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got)
    assert recall(x, range(0, len(x), 40))[1] <= 0.105


def test_search_of_lengths_and_repeats(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (0, [0.0, 2.0], 0, ""), (1, [0.0, 1.0], 0, ""), (1, [0.0, 3.0], 0, ""), (2, [1.0, 1.0], 0, ""), (3, [1.0, 1.0, 1.0], 0, ""), (100, [1.0, 1.0, 2.0], 0, "")]
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in permutation_ann.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).collect())
    # the least vector of id 0 asks; its other row is no candidate of its own
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.414214), (100, 1, 3, 1.0)]


def test_deep_and_unbalanced_pages():
    """Any depth of tags, and quotes without partners, in linear time."""
    import time

    began = time.monotonic()
    for tag in ("div", "b", "span", "ul"):
        page = f"<{tag}>" * 50_000 + "x"
        assert wrapper_induction.extract(page) == "x"
        a = wrapper_induction.Tree(page)
        assert len(wrapper_induction.match(a, wrapper_induction.Tree(page + "<p>y"))) == len(a.nodes)
    assert wrapper_induction.extract("<span>" * 50_000 + "x" + "</i>" * 50_000) == "x"
    assert wrapper_induction.extract("<li><b>" * 25_000 + "x") == "x"
    for piece in ('<a " ', '<a ">" ', "<a ' >", "<a ", "< ", "<!-- ", "<p a='"):
        assert isinstance(wrapper_induction.extract(piece * (1_000_000 // len(piece))), str)
    assert time.monotonic() - began < 120


@pytest.mark.parametrize(
    "page, want",
    [("<p a='x>y'>z", "z"), ("<p a='x>z", "z"), ('<p a=">" b=\'">\'>z', "z"), ("<p>a<b", "a<b"), ("<p>a <1 b", "a <1 b"), ("<p>x<!-- > --><p>y<!-- z", "x\ny"), ("<?xml a?><P>q</P><!x>", "q"), ("<script>a</b></SCRIPT >t", "t")],
)
def test_tokens(page, want):
    assert wrapper_induction.extract(page) == want


def test_match_as_recursion():
    """Simple tree matching against its definition, on small random trees."""
    rnd = random.Random(11)

    def grow(depth):
        return "".join(f"<{t}>{grow(depth - 1)}</{t}>" for t in rnd.choices(["div", "section", "ul"], k=rnd.randint(0, 3))) if depth else ""

    def best(a, i, b, j):
        if a.nodes[i].tag != b.nodes[j].tag:
            return 0
        x, y = a.below[i], b.below[j]
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for r in range(len(x)):
            for k in range(len(y)):
                table[r + 1][k + 1] = max(table[r][k + 1], table[r + 1][k], table[r][k] + best(a, x[r], b, y[k]))
        return table[-1][-1] + 1

    for _ in range(60):
        a, b = wrapper_induction.Tree(grow(3)), wrapper_induction.Tree(grow(3))
        pairs = wrapper_induction.match(a, b)
        assert len(pairs) == best(a, 0, b, 0)
        assert all(i == 0 or (a.up[i], b.up[j]) in set(pairs) for i, j in pairs)


def test_induced_regions(spark):
    """Hosts with layouts of their own, whose tags and attributes tell nothing:
    the wrapper alone finds the content, with marks and without."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    pages, want = [], {}
    for h in range(6):
        x = [f"x{h}{k}" for k in range(5)]
        fixed = [say(12) for _ in range(4)]
        for i in range(25):
            body = [say(rnd.randint(10, 60)) for _ in range(rnd.randint(2, 9))]
            bar = "".join(f"<div><a href=/{k}>{say(2)}</a></div>" for k in range(rnd.randint(2, 6)))
            page = f"<html><body><div class={x[0]}><p>{fixed[0]}</p></div><div class={x[1]}>{bar}</div>"
            inner = "".join(f"<p>{b}</p>" for b in body[:1]) + f"<div><p>{fixed[1]}</p></div>" + "".join(f"<p>{b}</p>" for b in body[1:])
            page += f"<div class={x[2]}>{inner}</div><div class={x[3]}>{say(3)}</div><div class={x[4]}><p>{fixed[2]}</p><p>{fixed[3]}</p></div></body></html>"
            pages.append((100 * h + i, f"https://host{h}.example/{i}", page))
            want[100 * h + i] = "\n".join(body)
    # copies of one page tell nothing of a template, and stay whole
    pages += [(1000 + i, f"http://same.example/{i}", f"<html><body><div><p>The same words.</p></div><!-- {i} --></body></html>") for i in range(9)]
    want |= {1000 + i: "The same words." for i in range(9)}
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    for marks in (True, False):
        assert {r.page_id: r.text for r in wrapper_induction.main_text(df, marks).collect()} == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data here")
def test_marks_only_break_ties(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    on, off = ({r.page_id: r.text for r in wrapper_induction.main_text(pages, marks).collect()} for marks in (True, False))
    assert len(on) == pages.count() and sum(on[i] == off[i] for i in on) >= 0.99 * len(on)


def test_streamed_wrappers():
    """Each share of a host's pages goes by the wrappers that came before it."""
    schema = pa.schema([("which", pa.int32()), ("host", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("fixed", pa.list_(pa.int32())), ("region", pa.int32())])
    wrapper = lambda which, host, html: (which, host, None, None, html, [], 0)
    page = lambda host, i: (wrapper_induction.ROW, host, i, "u", "<p>x", None, None)
    both = [wrapper(0, "h", "<p>a"), wrapper(1, "h", "<p>b")]
    rows = [*both, page("h", 1), *both, *both, page("h", 2), wrapper(1, "g", "<p>c"), page("g", 3), page("g", 4), wrapper(1, "g", "<p>c"), page("g", 5), page(None, 6)]
    b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    got = {r[2]: [w.page for w in wrappers(r[1])] for some, wrappers in wrapper_induction._streamed([b], None) for r in some}
    assert got == {1: ["<p>a", "<p>b"], 2: ["<p>a", "<p>b"], 3: ["<p>c"], 4: ["<p>c"], 5: ["<p>c"], 6: []}
