"""Kneser-Ney scores of a whole corpus by one exchange of its n-grams.

A slice of texts sends its distinct windows of ``order`` words (three at
least), each to the part of the last word but one, with how often training
texts have it.  All that a window's probability needs then lies in one part:
its count, its contexts' sums, the numbers of words before its shorter n-grams,
and, as each word is the last but one of some window, the words' own counts.
The part answers in the windows' order, so that no keys travel back; the slice,
kept meanwhile as numbers of its words, adds up its documents.  Words travel as
these numbers too; a part looks up their hashes in the slice's list, which is
mapped from the shared folder.  No model is read at random, and work and disk
follow the input.

A word of more than a part's share of all tokens is dealt twice: by the word
before it, for contexts and n-grams of more than its own, and by the word after
it, for its bigrams; its few sums are added up from all parts' totals.  Which
words these are is taken from a sample and changes no result.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, blob, mix, shared_dir, ship, text_bytes, text_slices
from .kneser_ney import _END, _START, PART_BYTES, Folder, _joined, _numbers, _parted, _planes, _tokens, discounts, held_out

#: Text bytes of a slice, whose windows are sent together.
SLICE_BYTES = 12 << 20
#: Text bytes in which frequent words are looked for.
SAMPLE_BYTES = 8 << 20
#: Sub-parts of a frequent word, at least.
SALTS = 16


class Plan(NamedTuple):
    folder: str
    parts: int
    order: int
    frequent: np.ndarray  # sorted hashes
    salts: int

    @property
    def size(self) -> int:
        return max(self.order, 3)


def _squeezed(raw: bytes) -> bytes:
    return blob(np.array([len(raw)], np.uint64)) + pa.compress(raw, codec="zstd", asbytes=True)


def _full(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int(np.frombuffer(raw, np.uint64, 1)[0]), codec="zstd", asbytes=True)


def _lean(n: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes that hold the largest, and before them how many that are."""
    kind = np.min_scalar_type(n.max(initial=0))
    return np.concatenate([np.array([kind.itemsize], np.uint8), _planes(n.astype(kind))])


def _counts(lean: np.ndarray) -> np.ndarray:
    return _numbers(lean[1:], f"u{lean[0]}").astype(np.int64)


def _key(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """A number for each row; they sort as the rows do."""
    key, size = columns[0].astype(np.uint64), sizes[0]
    for c, n in zip(columns[1:], sizes[1:], strict=True):
        if size * n >= 1 << 64:
            have, key = np.unique(key, return_inverse=True)
            key, size = key.astype(np.uint64), len(have)
        key = key * np.uint64(n) + c.astype(np.uint64)
        size *= n
    return key


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys, where each begins in it, and each row's place among the distinct."""
    order = np.argsort(key)
    new = np.zeros(len(key), bool)
    key = key[order]
    new[1:] = key[1:] != key[:-1]
    del key
    place = np.empty(len(order), np.uint32)
    place[order] = np.cumsum(new, dtype=np.uint32)
    new[:1] = True
    return order, np.flatnonzero(new), place


def _runs(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Marks where the first 1, 2, ... columns change in sorted rows."""
    new, out = np.zeros(len(columns[0]), bool), []
    new[:1] = True
    for c in columns:
        new = new.copy()
        new[1:] |= c[1:] != c[:-1]
        out.append(new)
    return out


def _places(runs: list[np.ndarray]) -> list[np.ndarray]:
    return [np.cumsum(new, dtype=np.int32) - np.int32(1) for new in runs]


def _within(outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """How many inner runs each outer one has."""
    return np.diff(np.cumsum(inner)[np.flatnonzero(outer)] - 1, append=np.count_nonzero(inner))


def _expanded(values: np.ndarray, times: list[np.ndarray]) -> np.ndarray:
    for n in times:
        values = np.repeat(values, n)
    return values


# ------------------------------------------------------------------- a slice


class Slice:
    """A slice's distinct windows, in the order in which they are sent.

    ``word`` has the hashes of its words, the frequent ones first, and START.
    ``columns``: the group, the words before the last but one, nearest first,
    and the last word.  A group is a word in the place of the last but one, or
    one of a frequent word's shares: 1 to ``salts`` by the word before, the
    others by the word after it.
    """

    def __init__(self, plan: Plan, word: np.ndarray, token: np.ndarray, first: np.ndarray):
        self.word, self.plan, n, salts = word, plan, len(word), plan.salts
        start = np.flatnonzero(word == _START)[0]
        x = [token]
        for _ in range(plan.size - 1):
            before = np.empty_like(token)
            before[1:], before[first[:-1]] = x[0][:-1], start
            x.insert(0, before)
        *earlier, v, w = x
        often = np.flatnonzero(np.isin(word, plan.frequent))
        base = np.full(n, -1)
        base[often] = n + 2 * salts * np.arange(len(often))
        of_group = np.concatenate([np.arange(n), np.repeat(often, 2 * salts)])
        salt = np.concatenate([np.zeros(n, np.int64), np.tile(np.arange(1, 2 * salts + 1), len(often))])
        part = (mix(word[of_group] + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(plan.parts)).astype(np.int64)
        ranked = np.argsort(part, kind="stable")
        rank = np.empty(len(part), np.int64)
        rank[ranked] = np.arange(len(part))
        self.of_group, self.salt, part = of_group[ranked].astype(np.uint32), salt[ranked], part[ranked]
        own = (mix(word) >> np.uint64(40)) % np.uint64(salts)
        self.twice = np.flatnonzero(base[v] >= 0)
        group, at = v.astype(np.int64), self.twice
        group[at] = base[v[at]] + own[earlier[-1][at]].astype(np.int64)
        after = base[v[at]] + salts + own[w[at]].astype(np.int64)
        columns = [rank[np.concatenate([group, after])].astype(np.uint32), *(np.concatenate([c, c[at]]) for c in (*earlier[::-1], w))]
        del x, earlier, v, w, group, after
        self.order, self.head, self.row = _distinct(_key(columns, [len(part)] + [n] * (plan.size - 1)))
        at = self.order[self.head]
        self.columns = [c[at] for c in columns]
        bounds = np.searchsorted(part[self.columns[0]], np.arange(plan.parts + 1))
        self.parts = [(p, int(a), int(b)) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]

    def counts(self, trained: np.ndarray) -> np.ndarray:
        """Of each window, in training texts."""
        return np.add.reduceat(np.concatenate([trained, trained[self.twice]])[self.order], self.head)

    def block(self, a: int, b: int, count: np.ndarray) -> bytes:
        """Some of the windows, as runs of equal first columns."""
        group, *inner = (c[a:b] for c in self.columns)
        runs = _runs([group, *inner])
        group = group[runs[0]]
        *earlier, last = (c[new] for c, new in zip(inner, runs[1:], strict=True))
        steps = [_planes(np.diff(x, prepend=np.uint32(0))) for x in (self.of_group[group], *earlier)]
        within = [_lean(_within(outer, deeper)) for outer, deeper in zip(runs, runs[1:])]
        return _squeezed(_joined(_lean(self.salt[group]), *steps, _planes(last), *within, _lean(count[a:b])))


def _unpacked(raw: bytes, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """The words' hashes, the groups' salts, the runs' words, their lengths, and counts."""
    salt, *rest = _parted(_full(raw), *[np.uint8] * (1 + 2 * size))
    *steps, last = (_numbers(x, np.uint32) for x in rest[:size])
    *within, count = map(_counts, rest[size:])
    values = [*(np.cumsum(x, dtype=np.uint32) for x in steps), last]
    have, at = np.unique(np.concatenate(values), return_inverse=True)
    return word[have], _counts(salt), np.split(at.astype(np.uint32), np.cumsum([*map(len, values)])[:-1]), within, count


_ASKED = pa.schema([("part", pa.int32()), ("slice", pa.string()), ("windows", pa.binary())])


def _ask(plan: Plan):
    """Keep each slice in the folder and send its windows."""

    def flush(held, number):
        ids, known, out, hashes, lengths = (np.concatenate(c) for c in zip(*held, strict=True))
        first = np.concatenate([[0], np.cumsum(lengths)])
        word, token, n = np.unique(np.append(hashes, _START), return_inverse=True, return_counts=True)
        # frequent words get small numbers, which take fewer bits
        ranked = np.argsort(n, kind="stable")[::-1]
        rank = np.empty(len(word), np.uint32)
        rank[ranked] = np.arange(len(word), dtype=np.uint32)
        word, token = word[ranked], rank[token[:-1]]
        del hashes, n, ranked, rank
        body = _squeezed(_joined(_planes(token), first, ids, known, out))
        # a task that runs again over rows in another order makes other slices, and those that lack answers are an error
        made = hashlib.blake2b(blob(word) + body, digest_size=8).hexdigest()
        name, folder = f"{TaskContext.get().partitionId()}-{number}-{made}", Folder(plan.folder)
        folder.save(f"words-{name}", word)
        folder.save(f"slice-{name}", np.frombuffer(body, np.uint8))
        asked = Slice(plan, word, token, first)
        count = asked.counts(np.repeat(~out, lengths).astype(np.int64))
        rows = [(p, asked.block(a, b, count)) for p, a, b in asked.parts]
        return batch(_ASKED, [p for p, _ in rows], [name] * len(rows), [r for _, r in rows])

    def run(batches):
        held, size, number = [], 0, 0
        for b in text_slices(batches, 1):
            _, token, first = _tokens(b.column(1))
            ids = b.column(0)
            known, out = (x.to_numpy(zero_copy_only=False).astype(bool) for x in (ids.is_valid(), b.column(2)))
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), known, out, token, np.diff(first)))
            size += b.column(1).nbytes
            if size >= SLICE_BYTES:
                yield flush(held, number)
                held, size, number = [], 0, number + 1
        if held:
            yield flush(held, number)

    return run


# -------------------------------------------------------------------- a part


def _four(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _sums(context: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Per context: the sum of its counts, and those of one, two and more."""
    return np.stack([np.bincount(context, x, n).astype(np.int64) for x in (count, count == 1, count == 2, count > 2)])


_ANSWERED = pa.schema([("slice", pa.string()), ("part", pa.int32()), ("answer", pa.binary())])


def _answer(plan: Plan):
    size, top = plan.size, plan.order

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        folder, slices = Folder(plan.folder), [s for s in table.column("slice").to_pylist() if s is not None]
        asked = [_unpacked(raw, folder.map(f"words-{s}", np.uint64), size) for s, raw in zip(slices, filter(None, table.column("windows").to_pylist()), strict=True)]
        if not asked:
            _save_totals(plan, part, np.zeros((top + 1, 4), np.int64), np.zeros(9, np.int64), np.zeros((0, 8), np.uint64))
            return _ANSWERED.empty_table()
        word, of_word = np.unique(np.concatenate([x[0] for x in asked]), return_inverse=True)
        of_word = of_word.astype(np.uint32)
        n, at, columns, salts, shapes = len(word), 0, [], [], []
        for own, salt, values, within, _ in asked:
            mine = of_word[at : at + len(own)]
            at += len(own)
            salts.append(salt)
            shapes.append(within)
            columns.append([_expanded(mine[x], within[i:]) for i, x in enumerate(values)] + [mine[values[0]], _expanded(np.arange(len(salt)), within)])
        sizes = [len(x[4]) for x in asked]
        of_groups = np.concatenate([c[-2] for c in columns])
        salt = np.concatenate(salts)
        order, head, place = _distinct(_key([of_groups, salt], [n, 2 * plan.salts + 1]))
        group_word, group_salt = of_groups[order[head]], salt[order[head]]
        starts = np.cumsum([0, *map(len, salts)])
        group = np.concatenate([place[a + c[-1]] for a, c in zip(starts, columns, strict=False)])
        columns = [group, *(np.concatenate(c) for c in list(zip(*columns, strict=True))[1:size])]
        count = np.concatenate([x[4] for x in asked])
        del asked, of_word, group
        order, head, row = _distinct(_key(columns, [len(group_word)] + [n] * (size - 1)))
        count = np.add.reduceat(count[order], head)
        at = order[head]
        columns = [c[at] for c in columns]
        last = columns[-1]
        del order, head, at
        runs = _runs(columns)
        places = _places(runs)  # places[n - 2]: the context of n-grams
        group, first = places[0], np.flatnonzero(runs[1])
        before = np.bincount(places[1], count) > 0
        n_before = np.bincount(group[first], before, len(group_word)).astype(np.int64)
        own = np.bincount(group, count, len(group_word)).astype(np.int64)
        # levels from the windows down: per window its n-gram's count, per context its sums
        gram, grams, context, group_of, counts, sums = np.arange(len(last)), count, places[size - 2], group, {}, {}
        totals, frequent, after, ends = np.zeros((top + 1, 4), np.int64), group_salt > 0, group_salt > plan.salts, 0
        for level in range(size, 1, -1):
            if level < size:
                order, head, shorter = _distinct(_key([places[level - 2], last], [len(last), n]))
                at = order[head]
                up = np.empty(len(grams), np.uint32)
                up[gram] = shorter
                grams = np.bincount(up, grams if level == top else grams > 0, len(head)).astype(np.int64)
                gram, context, group_of, ends_in = shorter, places[level - 2][at], group[at], last[at]
                del order, head, at, up
            if level > top:
                continue
            counts[level], sums[level] = grams[gram], _sums(context, grams, places[level - 2][-1] + 1)
            valid = ~after if level > 2 else after | ~frequent
            totals[level] = _four(grams[valid[group_of]])
            if level == 2:
                end = np.searchsorted(word, _END)
                if end < n and word[end] == _END:
                    ends = int(((grams > 0) & valid[group_of] & (ends_in == end)).sum())
        known = ~frequent & (own > 0) & (word[group_word] != _START)
        seen = n_before[known]
        starts_here = own[~frequent & (word[group_word] == _START)].sum()
        words = np.array([own[known].sum(), known.sum(), seen.sum(), *_four(seen), ends, starts_here], np.int64)
        shares = np.flatnonzero(frequent)
        shares = np.concatenate([np.stack([word[group_word[shares]], after[shares]]).astype(np.uint64), np.stack([own, n_before])[:, shares].astype(np.uint64), sums[2][:, shares].astype(np.uint64)]).T
        _save_totals(plan, part, totals, words, shares)
        answers, a, g = [], 0, 0
        for size_, within, salt in zip(sizes, shapes, salts, strict=True):
            rows, groups = row[a : a + size_], place[g : g + len(salt)]
            a, g = a + size_, g + len(salt)
            small = [_lean(own[groups]), _lean(n_before[groups])]
            for level in range(2, top + 1):
                # the runs of a context begin where those of all inner columns do
                lengths = _lengths(within, level - 2)
                heads = rows[np.cumsum(lengths) - lengths]
                small += [*map(_lean, sums[level][:, places[level - 2][heads]]), _lean(counts[level][rows])]
            answers.append(_squeezed(_joined(*small)))
        return pa.Table.from_arrays([pa.array(slices, pa.string()), pa.array([part] * len(slices), pa.int32()), pa.array(answers, pa.binary())], schema=_ANSWERED)

    return run


def _lengths(within: list[np.ndarray], depth: int) -> np.ndarray:
    """Rows in each run of the first ``depth`` + 1 columns."""
    rows = np.ones(int(within[-1].sum()), np.int64)
    for n in within[depth:][::-1]:
        rows = np.add.reduceat(rows, np.cumsum(n) - n)
    return rows


def _save_totals(plan: Plan, part: int, totals: np.ndarray, words: np.ndarray, shares: np.ndarray) -> None:
    raw = _joined(totals, words, np.ascontiguousarray(shares))
    Folder(plan.folder).save(f"totals-{part}", np.frombuffer(raw, np.uint8))


# --------------------------------------------------------------------- scores


class Totals:
    """What all parts have counted; a part without totals is an error."""

    def __init__(self, plan: Plan):
        folder = Folder(plan.folder)
        levels, words, shares = np.zeros((plan.order + 1, 4), np.int64), np.zeros(9, np.int64), []
        for p in range(plan.parts):
            a, b, c = _parted(bytes(folder.map(f"totals-{p}", np.uint8)), np.int64, np.int64, np.uint64)
            levels += a.reshape(-1, 4)
            words += b
            shares.append(c.reshape(-1, 8))
        shares = np.concatenate(shares)
        self.frequent, at = np.unique(shares[:, 0], return_inverse=True)
        side, n = shares[:, 1] == 1, len(self.frequent)
        add = lambda rows, column: np.bincount(at[rows], shares[rows, column], n).astype(np.int64)
        self.own, self.before = add(~side, 2), add(~side, 3)
        self.sums = np.stack([add(side, k) for k in range(4, 8)])
        start = self.frequent == _START
        self.ends, self.documents = int(words[7]), int(words[8] + self.own[start].sum())
        seen = np.append(self.before[~start & (self.own > 0)], [self.ends] if self.documents else [])
        self.tokens = int(words[0] + self.own[~start].sum()) + self.documents
        self.words = int(words[1]) + len(seen)
        self.types = int(words[2] + seen.sum())
        by = words[3:7] + _four(seen)
        more = self.words - by[0] - by[1]
        self.unigrams = discounts(*by.tolist())
        self.discounts = {level: discounts(*levels[level].tolist()) for level in range(2, plan.order + 1)}
        self.free = float(np.dot(self.unigrams[1:], (by[0], by[1], more))) / self.types if self.types else 1.0


_HELD: dict[str, Totals] = {}


def _totals(plan: Plan) -> Totals:
    if plan.folder not in _HELD:
        _HELD.clear()
        _HELD[plan.folder] = Totals(plan)
    return _HELD[plan.folder]


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])
_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def _score(plan: Plan):
    top = plan.order

    def run(table: pa.Table) -> pa.Table:
        t, name = _totals(plan), table.column("slice")[0].as_py()
        folder = Folder(plan.folder)
        token, first, *rows = _parted(_full(bytes(folder.map(f"slice-{name}", np.uint8))), np.uint8, np.int64, np.int64, np.bool_, np.bool_)
        word, token = np.asarray(folder.map(f"words-{name}", np.uint64)), _numbers(token, np.uint32)
        asked = Slice(plan, word, token, first)
        by_part = dict(zip(table.column("part").to_pylist(), table.column("answer").to_pylist(), strict=True))
        if sorted(by_part) != [p for p, _, _ in asked.parts]:
            raise ValueError(f"slice {name} lacks answers: it has those of {sorted(by_part)}")
        answers = []
        for p, _, _ in asked.parts:
            answers.append([_counts(x) for x in _parted(_full(by_part.pop(p)), *[np.uint8] * (2 + 5 * (top - 1)))])
        # per group, then for each level four sums per context and a count per window
        own, before, *levels = (np.concatenate(c) for c in zip(*answers, strict=True))
        sums = {level: np.stack(levels[5 * level - 10 : 5 * level - 6]) for level in range(2, top + 1)}
        counts = {level: levels[5 * level - 6] for level in range(2, top + 1)}
        del answers
        runs = _runs(asked.columns)
        places = _places(runs)
        groups = asked.columns[0][runs[0]]
        of_word, frequent = asked.of_group[groups], asked.salt[groups] > 0
        word_own, word_before = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        word_own[of_word[~frequent]], word_before[of_word[~frequent]] = own[~frequent], before[~frequent]
        if frequent.any():
            shared = np.searchsorted(t.frequent, word[of_word[frequent]])
            word_own[of_word[frequent]], word_before[of_word[frequent]] = t.own[shared], t.before[shared]
            sums[2][:, frequent] = t.sums[:, shared]
        end = word == _END
        word_own[end], word_before[end] = t.documents, t.ends
        base = np.log10((word_own + 1) / (t.tokens + t.words + 1))
        lower = np.maximum(word_before - t.unigrams[np.minimum(word_before, 3)], 0) / max(t.types, 1) + t.free / (t.words + 1)
        p, longer = lower[token], asked.row[: len(token)]
        shorter = longer.copy()
        shorter[asked.twice] = asked.row[len(token) :]
        for level in range(2, top + 1):
            row, d, (total, *free) = longer if level > 2 else shorter, t.discounts[level], sums[level]
            context, count = places[level - 2], counts[level]
            back = np.where(total > 0, (np.stack(free, 1) @ d[1:]) / np.maximum(total, 1), 1.0)
            found = np.maximum(count - d[np.minimum(count, 3)], 0) / np.maximum(total, 1)[context]
            p = found[row] + back[context][row] * p
        head, n = first[:-1], np.diff(first)
        score = np.add.reduceat(np.log10(p), head)
        ids = pa.array(rows[0], pa.int64(), mask=~rows[1])
        known = np.add.reduceat(word_own[token] > 0, head, dtype=np.int64)
        return pa.Table.from_batches([batch(_SCORED, ids, rows[2], n, known, np.full(len(n), t.tokens), np.add.reduceat(base[token], head), score, 10 ** np.minimum(-score / n, 300.0))])

    return run


def _frequent(docs: DataFrame, size: int, parts: int) -> tuple[np.ndarray, int]:
    """Words of more than a part's share of the tokens, as a sample has them,
    and in how many shares they are dealt."""
    every = max(1, size // SAMPLE_BYTES)

    def run(batches):
        for b in text_slices(batches, 0):
            context, token, _ = _tokens(b.column(0))
            word, n = np.unique(np.append(token[token != _END], context[context == _START]), return_counts=True)
            most = n * 4 * parts >= len(token)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(word[most], 0).view(np.int64)), pa.array(np.append(n[most], len(token)))], names=["word", "n"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(every)) == 0).select("text")
    rows = {r.word: r.n for r in sample.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = rows.pop(0, 0)
    rows = {w: n for w, n in rows.items() if n * parts > total}
    salts = max(SALTS, min(parts, -(-2 * parts * max(rows.values(), default=0) // max(total, 1))))
    return np.sort(np.array(list(rows), np.int64).view(np.uint64)), salts


def scores(docs: DataFrame, parts: int | None = None, order: int = 2) -> DataFrame:
    """``kneser_ney.score`` of rows (doc_id, text)."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    ship(spark)
    size = text_bytes(docs)
    parts = parts or max(16, size * (order - 1) // PART_BYTES)
    plan = Plan(Folder(shared_dir(spark) + "/kneser-ney").uri, parts, order, *_frequent(docs, size, parts))
    asked = docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(_ask(plan), "part int, slice string, windows binary")
    # every part runs, and so has its totals
    asked = asked.unionAll(spark.range(parts).select(F.col("id").cast("int"), F.lit(None).cast("string"), F.lit(None).cast("binary")))
    answered = asked.groupBy("part").applyInArrow(_answer(plan), "slice string, part int, answer binary")
    return answered.groupBy("slice").applyInArrow(_score(plan), _DDL)
