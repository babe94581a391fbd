"""SentencePiece encoding and decoding in numpy.

Texts are cut where no piece can reach across: before a space that follows
something else, and around bytes that no longer piece holds.  Distinct segments
of a slice are encoded once, equal lengths together, and gathered back.

*Best segmentation* (``unigram``) by batched Viterbi: hashes of all substrings
that begin a piece grow by one character at a time and probe the sorted piece
keys; then all words of a length advance together from end to end, and
vectorised maxima store backpointers.  A unigram model has scores; of a BPE
model, whose pieces come in the order of their merges, a piece's score is
-ln(rank + 1), as Zipf's law has it.  Equal sums go to the longer last piece, in
single precision within a segment, as in the library's unigram models.

*Merges* (``merges``): a BPE model's own result is defined by merge order, which
no sum of scores gives; equal-length words advance through
:class:`bpe.Merger`, which probes sorted pair keys.  The installed public model
is one; the library returns these ids for it.

Only the identity normalizer is read.  U+2581 in a text is a space to the
library, and so it is here; every other text comes back from its ids exactly.

Edge cases: null or empty text has no ids; characters without a piece become
byte pieces, or the unknown piece where the model has no byte fallback.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Merger, gather
from .common import batch, flat_bytes, mix, plain, ship, span_hashes, text_slices

_SPACE = "▁"
_PAST = 0x110000


#: Longer words advance one end at a time through the pieces found in them.
LONG = 512


class Viterbi:
    """Best segmentations over pieces with scores."""

    def __init__(self, pieces: list[str], scores: np.ndarray, ids: np.ndarray, unknown: float):
        self.longest = max(map(len, pieces), default=1)
        self.unknown = np.float32(unknown)
        found: dict[int, int] = {}
        for k, p in enumerate(pieces):  # each piece's beginnings too: -1 where none is a piece
            h = np.zeros(1, np.uint64)
            for i, c in enumerate(p):
                h = mix(h ^ np.uint64(ord(c) + 1))
                if i + 1 < len(p):
                    found.setdefault(int(h[0]), -1)
            found[int(h[0])] = k
        keys = np.array(list(found), np.uint64)
        order = np.argsort(keys)
        self.keys, self.which = keys[order], np.array(list(found.values()))[order]
        self.scores, self.ids = np.asarray(scores, np.float32), ids

    def _pieces(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per size, which cells of (word, start) begin a piece, and its number."""
        n, length = words.shape
        flat, cell = words.ravel().astype(np.uint64) + np.uint64(1), np.arange(n * length)
        h, out = np.zeros(n * length, np.uint64), []
        for size in range(1, min(self.longest, length) + 1):
            fits = cell % length + size <= length
            cell, h = cell[fits], h[fits]
            h = mix(h ^ flat[cell + size - 1])
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            alive = self.keys[at] == h
            cell, h, k = cell[alive], h[alive], self.which[at[alive]]
            out.append((cell[k >= 0], k[k >= 0]))
            if not len(cell):
                break
        return out

    def __call__(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids (-code point - 1 where unknown) of equal-length words, a row
        of code points each, and the number of each word's."""
        n, length = words.shape
        found = self._pieces(words)
        if length > LONG:
            runs = [self._long(w, found, i * length) for i, w in enumerate(words)]
            return np.array([i for r in runs for i in r], np.int64), np.array([len(r) for r in runs], np.int64)
        lone = np.ones(n * length, bool)
        lone[found[0][0]] = False
        by_start = [self._by_start(cell, k, length) for cell, k in found]
        unknown = self._by_start(np.flatnonzero(lone), None, length)
        best = np.full((length + 1, n), -np.inf, np.float32)
        best[0] = 0
        back, piece = np.zeros((length + 1, n), np.int32), np.zeros((length + 1, n), np.int64)
        for end in range(1, length + 1):
            top = best[end]
            for size in range(min(end, len(found)), 0, -1):
                word, k, edge = by_start[size - 1]
                x = slice(edge[end - size], edge[end - size + 1])
                score = best[end - size, word[x]] + self.scores[k[x]]
                better = score > top[word[x]]
                to = word[x][better]
                top[to], back[end, to], piece[end, to] = score[better], end - size, self.ids[k[x][better]]
            word, _, edge = unknown
            to = word[edge[end - 1] : edge[end]]
            to = to[best[end - 1, to] + self.unknown > top[to]]
            top[to], back[end, to], piece[end, to] = best[end - 1, to] + self.unknown, end - 1, -words[to, end - 1].astype(np.int64) - 1
        # all words walk back from their ends together
        row, end, steps = np.arange(n), np.full(n, length), []
        count = np.zeros(n, np.int64)
        while len(row):
            made = np.zeros(n, np.int64)
            made[row] = piece[end, row]
            steps.append(made)
            count[row] += 1
            end = back[end, row]
            row, end = row[end > 0], end[end > 0]
        last = np.repeat(np.cumsum(count), count) - 1 - np.arange(count.sum())  # steps still to come
        return np.array(steps)[last, np.repeat(np.arange(n), count)] if steps else np.zeros(0, np.int64), count

    @staticmethod
    def _by_start(cell: np.ndarray, k: np.ndarray | None, length: int) -> tuple[np.ndarray, np.ndarray | None, list[int]]:
        """Words and pieces of cells in the order of their starts."""
        start = cell % length
        order = np.argsort(start, kind="stable")
        edge = np.searchsorted(start[order], np.arange(length + 1)).tolist()
        return cell[order] // length, k if k is None else k[order], edge

    def _long(self, word: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], first: int) -> list[int]:
        """As above for one word, a visit for each piece found in it."""
        starts, sizes, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, (cell, k) in enumerate(found, 1):
            x = slice(*np.searchsorted(cell, [first, first + len(word)]))
            starts.append(cell[x] - first)
            sizes.append(np.full(len(starts[-1]), size))
            pieces.append(k[x])
        start, size, k = (np.concatenate(c) for c in (starts, sizes, pieces))
        order = np.lexsort((-size, start + size))
        edge = np.searchsorted((start + size)[order], np.arange(len(word) + 2)).tolist()
        start, k, score = start[order].tolist(), k[order].tolist(), self.scores[k[order]]
        best, back = np.zeros(len(word) + 1, np.float32), [(0, 0)] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            top, choice, single = None, None, False
            for e in range(edge[end], edge[end + 1]):
                s = best[start[e]] + score[e]
                single |= start[e] == end - 1
                if top is None or s > top:
                    top, choice = s, (start[e], int(self.ids[k[e]]))
            if not single:
                s = best[end - 1] + self.unknown
                if top is None or s > top:
                    top, choice = s, (end - 1, -int(word[end - 1]) - 1)
            best[end], back[end] = top, choice
        out, end = [], len(word)
        while end:
            end, made = back[end]
            out.append(made)
        return out[::-1]


class Pieces:
    """A model read from ``path``; ``how`` is "unigram" or "merges"."""

    def __init__(self, path: str, how: str = "unigram"):
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path} rewrites texts; only the identity normalizer is read")
        self.prefix = bool(m.normalizer_spec.add_dummy_prefix)
        self.n = len(m.pieces)
        names = [p.piece.replace(_SPACE, " ") for p in m.pieces]
        usable = {s: i for i, s in enumerate(names) if m.pieces[i].type in (1, 4)}
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == 2)
        self.bytes = np.full(256, -1, np.int32)
        raw = []
        for i, p in enumerate(m.pieces):
            if p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
                raw.append(bytes([int(p.piece[3:5], 16)]))
            else:
                raw.append(" ⁇ ".encode() if p.type == 2 else b"" if p.type == 3 else names[i].encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        # one symbol per code point: its piece, or a number past all pieces
        self.symbol = np.arange(_PAST, dtype=np.int32) + self.n
        for s, i in usable.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        longer = [s for s in usable if len(s) > 1]
        self.lone = np.zeros(256, bool)
        self.lone[:128] = True
        self.lone[[ord(c) for s in longer for c in s if ord(c) < 128]] = False
        if any(" " in s[1:] and s.strip(" ") for s in longer):
            raise ValueError(f"{path} has pieces across words")
        self.merge = self.viterbi = None
        score = np.array([p.score for p in m.pieces])
        if m.trainer_spec.model_type not in (1, 2):
            raise ValueError(f"{path} is neither a BPE nor a unigram model")
        if how == "merges":
            if m.trainer_spec.model_type != 2:
                raise ValueError(f"{path} has no merges")
            as_symbol = lambda s: usable.get(s, self.n + ord(s) if len(s) == 1 else None)
            rank = {i: r for r, i in enumerate(sorted((usable[s] for s in longer), key=lambda i: (-score[i], i)))}
            rules = [(a, b, usable[s]) for s in longer for k in range(1, len(s)) if (a := as_symbol(s[:k])) is not None and (b := as_symbol(s[k:])) is not None]
            left, right, made = (np.array(x) for x in zip(*rules, strict=True))
            made_by_rank = np.array(sorted(rank, key=rank.get), np.int32)
            self.merge = Merger(left, right, made, np.array([rank[i] for i in made.tolist()]), self.n + _PAST)
            self.merge.made = made_by_rank
            return
        ids = np.array(list(usable.values()))
        score = (score if m.trainer_spec.model_type == 1 else rank_scores(len(m.pieces)))[ids]
        self.viterbi = Viterbi(list(usable), score, ids, float(score.min()) - 10)

    def _segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of distinct segments."""
        offs = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
        raw = b"".join(segments)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        offs = starts[offs]
        if self.merge is not None:
            ids, to = self.merge(self.symbol[points], offs)
        else:
            size = np.diff(offs)
            rows, parts, counts = [], [], []
            for length in np.unique(size):
                same = np.flatnonzero(size == length)
                for a in range(0, len(same), max(1, 500_000 // int(length))):
                    some = same[a : a + max(1, 500_000 // int(length))]
                    part, count = self.viterbi(points[offs[some][:, None] + np.arange(length)])
                    rows.append(some)
                    parts.append(np.where(part >= 0, part, self.n - part - 1).astype(np.int32))
                    counts.append(count)
            rows, counts = np.concatenate(rows), np.concatenate(counts)
            place = np.empty(len(size), np.int64)
            place[rows] = np.arange(len(rows))
            ids, to = gather(np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)]), place)
        odd = np.flatnonzero(ids >= self.n)
        if not len(odd):
            return ids, to
        # characters without a piece: bytes, or else the unknown piece
        instead = [self.bytes[list(chr(c).encode())].tolist() if (self.bytes >= 0).all() else [self.unknown] for c in (ids[odd] - self.n).tolist()]
        n = np.ones(len(ids), np.int64)
        n[odd] = [len(x) for x in instead]
        end = np.concatenate([[0], np.cumsum(n)])
        out = np.repeat(ids, n)
        at = np.repeat(end[odd], n[odd]) + np.concatenate([np.arange(k) for k in n[odd]])
        out[at] = [i for x in instead for i in x]
        return out, end[to]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of each text."""
        col = pc.fill_null(col.cast(pa.string()), "")
        col = pc.replace_substring(col, _SPACE, " ")
        if self.prefix:
            col = pc.if_else(pc.equal(pc.binary_length(col), 0), "", pc.binary_join_element_wise(" ", col, ""))
        buf, offs = flat_bytes(col)
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(col) + 1, np.int64)
        start = np.zeros(len(buf), bool)
        space, lone = buf == 32, self.lone[buf] & (buf != 32)
        start[1:] = space[1:] & ~space[:-1] | lone[1:] | lone[:-1]
        start[offs[:-1][offs[:-1] < len(buf)]] = True
        head = np.flatnonzero(start)
        tail = np.append(head[1:], len(buf))
        _, first, which = np.unique(span_hashes(buf, head, tail), return_index=True, return_inverse=True)
        raw = buf.tobytes()
        ids, to = self._segments([raw[a:b] for a, b in zip(head[first].tolist(), tail[first].tolist(), strict=True)])
        ids, flat = gather(ids, to, which)
        return ids, flat[np.searchsorted(head, offs)]

    def decode(self, ids: np.ndarray, to: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids."""
        data, at = gather(self.raw, self.raw_at, ids)
        raw, edge = data.tobytes(), at[to].tolist()
        cut = int(self.prefix)
        return [raw[a + (cut if raw[a : a + 1] == b" " else 0) : b] if b > a else b"" for a, b in zip(edge[:-1], edge[1:], strict=True)]


def rank_scores(n: int) -> np.ndarray:
    """Scores of a BPE model's pieces by their places."""
    return -np.log(np.arange(n) + 1.0)


@functools.lru_cache(maxsize=4)
def load(path: str, how: str = "unigram") -> Pieces:
    return Pieces(path, how)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, path: str | None = None, how: str = "unigram") -> DataFrame:
    """doc_id and ids of every row, by the best sum of scores or by merges."""
    ship(docs.sparkSession)
    path = path or default_path()
    schema = pa.schema([("row_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for b in text_slices(batches, 1, 6 << 20):
            ids, to = load(path, how).encode(b.column(1))
            yield batch(schema, b.column(0), pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(ids, pa.int32())))

    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "row_id long, ids array<int>").withColumnRenamed("row_id", "doc_id")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows of ids."""
    ship(tokens.sparkSession)
    path = path or default_path()
    schema = pa.schema([("row_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for b in batches:
            ids = pc.fill_null(b.column(1), pa.scalar([], b.column(1).type))
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            to = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield batch(schema, b.column(0), [t.decode("utf-8", "replace") for t in load(path).decode(flat, to)])

    return plain(tokens, "doc_id", "ids").mapInArrow(run, "row_id long, text string").withColumnRenamed("row_id", "doc_id")


_OUT = pa.schema([("row_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("n_bytes", pa.int64()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])


def digests(docs: DataFrame, path: str | None = None, how: str = "unigram") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), n_bytes
    and decoded_sha256 of the text decoded again, round_trip: is it the text?"""
    ship(docs.sparkSession)
    path = path or default_path()

    def run(batches):
        pieces = load(path, how)
        for b in text_slices(batches, 1, 6 << 20):
            ids, to = pieces.encode(b.column(1))
            flat, edge = ids.astype("<u4"), to.tolist()
            crc = [zlib.crc32(flat[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
            texts = pieces.decode(ids, to)
            buf, offs = flat_bytes(b.column(1))
            raw, at = buf.tobytes(), offs.tolist()
            same = [t == raw[x:y] for t, x, y in zip(texts, at[:-1], at[1:], strict=True)]
            yield batch(_OUT, b.column(0), np.diff(to), crc, [len(t) for t in texts], [hashlib.sha256(t).hexdigest() for t in texts], same)

    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "row_id long, n_ids long, ids_crc32 long, n_bytes long, decoded_sha256 string, round_trip boolean").withColumnRenamed("row_id", "doc_id")
