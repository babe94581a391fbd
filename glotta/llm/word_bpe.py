"""Ids of a lower-casing word-end BPE tokenizer file, batch-wise.

The vocabulary file is read as it is; distinct words are cut by its own
pre-tokenizing pattern and merged together by :class:`bpe.Merger`.  Texts that
hold a special token's string go to the ``tokenizers`` library itself.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import regex

from .bpe import Merger, gather
from .common import Words


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _lower(text: str) -> str:
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>":
            raise ValueError(f"{path} isn't a BPE with word ends")
        vocab, letters = model["vocab"], _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[letters[b] + "</w>"] for b in range(256)], np.int32)
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merge = Merger(
            np.array([vocab[a] for a, _ in rules]), np.array([vocab[b] for _, b in rules]), np.array([vocab[a + b] for a, b in rules]), np.arange(len(rules)), max(vocab.values()) + 1
        )
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.cut = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.path = path

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of each word (a text without ASCII white space)."""
        pieces, count = [], np.zeros(len(words), np.int64)
        find, add = self.cut.findall, pieces.append
        for i, w in enumerate(words):
            if w.isalpha():  # ASCII letters only
                add(w.lower())
                count[i] = 1
                continue
            text = w.decode("utf-8", "replace")
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            found = find(_lower(text))
            for x in found:
                add(x.encode())
            count[i] = len(found)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        offs = np.concatenate([[0], np.cumsum(size)])
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.inner[raw]
        ids[offs[1:] - 1] = self.final[raw[offs[1:] - 1]]
        ids, to = self.merge(ids, offs)
        return ids, to[np.concatenate([[0], np.cumsum(count)])]

    def texts(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of each text; a null has none."""
        w = Words(col)
        n = len(w.first) - 1
        ids, to = np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        if len(w.start):
            _, head, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
            raw = w.buf.tobytes()
            one, offs = self.words([raw[a:b] for a, b in zip(w.start[head].tolist(), w.end[head].tolist(), strict=True)])
            ids, flat = gather(one, offs, which)
            to = flat[w.first]
            if any(s in raw for s in self.special):
                ids, to = self._special(col, raw, w.offs, ids, to)
        return ids, to

    def _special(self, col, raw, offs, ids, to):
        runs = [ids[to[i] : to[i + 1]] for i in range(len(to) - 1)]
        for i in range(len(runs)):
            if any(s in raw[offs[i] : offs[i + 1]] for s in self.special):
                runs[i] = np.array(_library(self.path).encode(col[i].as_py(), add_special_tokens=False).ids, np.int32)
        return np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])


@functools.lru_cache(maxsize=4)
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
