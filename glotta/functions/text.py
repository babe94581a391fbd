"""Text functions as Column expressions.

Character classes are Unicode-aware (``(?U)``), as the rules expect.  Every
function maps null to null and treats the empty string as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .rules import COMMANDS, COMMANDS_V1, GENERAL_ABBREVIATIONS, MEDICAL_ABBREVIATIONS

#: Letters that sentence capitalisation raises.
_RAISED = "a-zàâäéèêëîïôùûüç"
#: Letters whose upper case is several letters, and the one that stands for it:
#: the title-case letter, or the letter itself; a capital ß is newer than both.
_LONG = "".join(chr(i) for i in range(0xFB18) if len(chr(i).upper()) > 1)
_SHORT = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _LONG)
_QUESTION = "(?iu)est-ce|y a-t-il|quel|comment|pourquoi|où|quand|combien"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def bullet_strip(c: Column) -> Column:
    """Without one leading bullet."""
    return F.regexp_replace(strip(c), r"(?U)^[-•*]\s*", "")


def lines(c: Column) -> Column:
    """Stripped lines of a text."""
    return F.transform(F.split(c, r"\r\n|[\n\r\x0B\f\x1C-\x1E\u0085  ]"), strip)


def page_lines(c: Column, least: int = 5) -> Column:
    """Lines without blanks, short ones and page headers ("-- 1 of 9")."""
    header = lambda x: x.startswith("--") & x.contains("of")
    return F.filter(lines(c), lambda x: (F.length(x) >= least) & ~header(x))


def report_sentences(c: Column, longest: int = 200, least: int = 8) -> Column:
    """Lines as they are up to ``longest`` characters, longer ones cut after
    ``. ! ?``; pieces under ``least`` characters go."""
    cut = lambda x: F.transform(F.split(x, r"(?U)(?<=[.!?])\s+"), strip)
    pieces = F.flatten(F.transform(lines(c), lambda x: F.when(F.length(x) <= longest, F.array(x)).otherwise(cut(x))))
    return F.filter(pieces, lambda x: F.length(x) >= least)


def block_sentences(c: Column, longest: int = 200, least: int = 8) -> Column:
    """Blocks between blank lines, unwrapped to one line, then cut as reports."""
    unwrapped = lambda b: F.array_join(F.filter(lines(b), lambda x: x != ""), " ")
    return F.flatten(F.transform(F.split(c, r"(?U)\n\s*\n"), lambda b: report_sentences(unwrapped(b), longest, least)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, even where ``body`` uses
    it twice or in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def replaced(c: Column, rules: Iterable[tuple], flags: str = "") -> Column:
    """``(pattern, replacement)`` pairs, one after the other.  A third member is
    a string without which the pattern can't match; looking for it first spares
    most texts the regular expression."""
    for pattern, to, *gate in rules:
        pattern = flags + pattern
        if gate:
            c = let(c, lambda x: F.when(x.contains(gate[0]), F.regexp_replace(x, pattern, to)).otherwise(x))  # noqa: B023
        else:
            c = F.regexp_replace(c, pattern, to)
    return c


def expand_abbreviations(c: Column, extra: Iterable[tuple[str, str]] = ()) -> Column:
    """Abbreviations spelt out, in table order, then ``extra`` rules."""
    return replaced(c, [*GENERAL_ABBREVIATIONS, *MEDICAL_ABBREVIATIONS, *extra], "(?U)")


def nfc(c: Column) -> Column:
    """Canonical composition, by the library that Spark's collations bring: no
    text leaves the JVM.  Spark takes such a call for one that may change."""
    return let(c, lambda x: F.when(x.isNotNull(), F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False))))


def normalize_text(c: Column, lowercase: bool = True, remove_special: bool = True, expand: bool = True, extra: Iterable[tuple[str, str]] = (), compose: Callable[[Column], Column] | None = nfc) -> Column:
    """Expand, compose, lower, drop what isn't spoken, collapse white space."""
    if expand:
        c = expand_abbreviations(c, extra)
    if compose:
        c = compose(c)
    if lowercase:
        c = F.lower(c)
    if remove_special:
        c = F.regexp_replace(c, r"(?U)[^\w\s\-'.,:;!?]", " ")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_asr_punctuation(c: Column) -> Column:
    """Without punctuation that a recogniser added, digits' separators stay."""
    return strip(replaced(c, [(r"(?<![0-9])[.,!?;](?![0-9])", " "), (r"(?U)[^\S\n]{2,}", " ")]))


def simple_lower(c: Column) -> Column:
    """Lower case letter by letter, as DuckDB has it: whatever follows a sigma,
    and without the dot that İ would leave."""
    return F.lower(F.translate(c, "Σİ", "σi"))


def simple_upper(c: Column) -> Column:
    """Upper case of one letter by one letter, as DuckDB has it."""
    up = F.upper(c)
    return F.when(F.length(up) > 1, F.translate(c, _LONG, _SHORT)).otherwise(up)


def capitalize_sentences(c: Column, upper: Callable[[Column], Column] = F.upper, space: str = r"\p{IsWhite_Space}") -> Column:
    """First letter, letters after ``. ? !`` and white space, and after line
    breaks, raised."""
    c = F.concat(upper(F.substring(c, 1, 1)), F.substring(c, 2, 2**31 - 1))
    head, shape = F.split(c, rf"(?<=[.?!])(?={space})"), rf"(?s)^({space}+)([{_RAISED}]?)(.*)$"
    raise_ = lambda x: F.concat(F.regexp_extract(x, shape, 1), F.upper(F.regexp_extract(x, shape, 2)), F.regexp_extract(x, shape, 3))
    c = F.array_join(F.transform(head, lambda x, i: F.when(i > 0, raise_(x)).otherwise(x)), "")
    first = lambda x: F.substring(x, 1, 1)
    up = lambda x: F.concat(F.upper(first(x)), F.substring(x, 2, 2**31 - 1))
    return F.array_join(F.transform(F.split(c, r"(?<=\n)(?!\n)"), lambda x, i: F.when((i > 0) & first(x).rlike(f"^[{_RAISED}]$"), up(x)).otherwise(x)), "")


def _spaced(c: Column) -> Column:
    return replaced(c, [(r"(?U)\s+([.,;:?!])", "$1"), (r"(?U)([.,;:?!])(?=\S)", "$1 ")])


def verbal_commands(c: Column) -> Column:
    """Dictated punctuation to signs, on text without the recogniser's own."""
    c = _spaced(replaced(F.lower(strip_asr_punctuation(c)), COMMANDS, "(?iu)(?U)"))
    twice = [(r"(?U),\s*,+", ","), (r"(?U)\.\s*\.+", "."), (r"(?U);\s*;+", ";"), (r"(?U):\s*:+", ":"), (r"(?U),\s*\.", "."), (r"(?U)\.\s*,", ".")]
    return capitalize_sentences(strip(replaced(c, [*twice, (" *\n *", "\n"), (r"(?U)[^\S\n]{2,}", " ")])))


def verbal_commands_v1(c: Column) -> Column:
    """The older command set and its cleanup, which may join lines."""
    c = _spaced(replaced(F.lower(c), COMMANDS_V1, "(?iu)(?U)"))
    return capitalize_sentences(strip(replaced(c, [(r"(?U)\s{2,}", " "), (" \n", "\n")])))


def punctuation_ratio(c: Column) -> Column:
    n = F.length(c)
    return (n - F.length(F.translate(c, ".,;:?!", ""))) / F.greatest(n, F.lit(1))


def fix_question_marks(c: Column) -> Column:
    """A line's final ``?`` becomes ``.`` unless the line holds a question word."""
    fix = lambda x: F.when(x.endswith("?") & ~x.rlike(_QUESTION), F.regexp_replace(x, r"\?$", ".")).otherwise(x)
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: fix(strip(x))), "\n")


def dictation(c: Column, auto: bool = True, spell: bool = True, restore: Callable[[Column], Column] | None = None, correct: Callable[[Column], Column] | None = None) -> Column:
    """Commands, then restoration of hardly punctuated text, then correction.

    ``restore`` and ``correct`` are models; without one its step does nothing.
    """
    c = verbal_commands(c)
    if auto and restore:
        c = F.when(punctuation_ratio(c) < 0.02, capitalize_sentences(restore(c))).otherwise(c)
    if spell and correct:
        c = fix_question_marks(correct(c))
    return c


def combine_transcripts(texts: Column) -> Column:
    """Texts without final dots, joined as sentences."""
    bare = F.transform(texts, lambda x: F.regexp_replace(strip(x), r"\.+$", ""))
    return F.concat(F.array_join(F.filter(bare, lambda x: x != ""), ". "), F.lit("."))


def words(c: Column) -> Column:
    """Words between white space; none in a blank text."""
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


#: Distinct words that one character each can stand for, below the surrogates.
CODES = 30_000


def edit_distance(ref: list, hyp: list) -> int:
    """Edit distance between two word lists of any size, in memory linear in
    the longer one."""
    ids: dict = {}
    a, b = (np.array([ids.setdefault(w, len(ids)) for w in x], np.int64) for x in (ref, hyp))
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    k = n if same.all() else int(same.argmin())
    a, b, n = a[k:], b[k:], n - k
    same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1]
    k = n if same.all() else int(same.argmin())
    a, b = a[: len(a) - k], b[: len(b) - k]
    if len(a) > len(b):
        a, b = b, a
    at = np.arange(len(b) + 1)
    row = at
    for i, w in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != w))])
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


@F.pandas_udf(IntegerType())
def _edit_distances(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    return pd.Series([None if r is None or h is None else edit_distance(r, h) for r, h in zip(ref, hyp, strict=True)], dtype="Int32")


def word_edits(ref: Column, hyp: Column) -> Column:
    """Edit distance between two word arrays: each word becomes one character,
    and the character distance is taken.  Arrays of more than ``CODES``
    distinct words are compared as numbers."""

    def edits(codes: Column) -> Column:
        text = lambda a: F.array_join(F.transform(a, lambda w: F.try_element_at(codes, w)), "")
        return F.levenshtein(text(ref), text(hyp))

    code = lambda i: F.decode(F.unhex(F.lpad(F.hex(i + 0x4E00), 4, "0")), "UTF-16BE")
    every = F.array_distinct(F.concat(ref, hyp))
    many = F.size(every) > CODES
    exact = _edit_distances(F.when(many, ref), F.when(many, hyp))
    return F.when(many, exact).otherwise(let(F.map_from_arrays(every, F.transform(every, lambda w, i: code(i))), edits))


def word_error_rate(ref: Column, hyp: Column) -> Column:
    """Edits per reference word; an empty reference gives 0 or 1."""
    r, h = words(F.lower(ref)), words(F.lower(hyp))
    return F.when(F.size(r) == 0, F.when(F.size(h) == 0, 0.0).otherwise(1.0)).otherwise(word_edits(r, h) / F.size(r))


def stem(path: Column) -> Column:
    """File name without folder and last extension; both kinds of slash."""
    name = F.regexp_extract(path, r"([^\\/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def with_wav(name: Column) -> Column:
    return F.when(F.lower(name).endswith(".wav"), name).otherwise(F.concat(name, F.lit(".wav")))
