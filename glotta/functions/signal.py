"""Signal functions on sample arrays, as Column expressions.

Samples are arrays of float or double in [-1, 1] unless a name says PCM.  Empty
arrays give null statistics and come back unchanged from transformations.
Arithmetic is in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def doubles(a: Column) -> Column:
    return a.cast("array<double>")


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def rms(a: Column) -> Column:
    squares = F.transform(doubles(a), lambda x: x * x)
    return F.when(F.size(a) > 0, F.sqrt(total(squares) / F.size(a)))


def peak(a: Column) -> Column:
    return F.array_max(F.transform(doubles(a), F.abs))


def rms_db(a: Column) -> Column:
    """Level in dB of full scale, -100 for silence."""
    r = rms(a)
    return F.when(r < 1e-10, -100.0).otherwise(20 * F.log10(r))


def _scaled(a: Column, level: Column, target: float) -> Column:
    k = F.when(level >= 1e-8, F.lit(target) / level).otherwise(1.0)
    return F.when(F.size(a) > 0, let(k, lambda k: F.transform(doubles(a), lambda x: x * k))).otherwise(doubles(a))


def normalize_rms(a: Column, target_db: float = -20.0) -> Column:
    return _scaled(a, rms(a), 10 ** (target_db / 20))


def normalize_peak(a: Column, headroom_db: float = -1.0) -> Column:
    return _scaled(a, peak(a), 10 ** (headroom_db / 20))


def duration(a: Column, rate: int) -> Column:
    return F.size(a) / F.lit(rate)


def frames(a: Column, length: int, hop: int) -> Column:
    """Whole frames; none if the signal is shorter than one."""
    n = F.floor((F.size(a) - length) / hop).cast("int")
    at = F.when(F.size(a) >= length, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.slice(a, i * hop + 1, length))


def frame_rms(a: Column, length: int, hop: int) -> Column:
    return F.transform(frames(a, length, hop), rms)


def percentile(a: Column, share: float) -> Column:
    """Linear interpolation between the sorted values next to ``share``."""
    s, n = F.sort_array(a), F.size(a)
    at = (n - 1) * F.lit(share)
    low = F.floor(at).cast("int")
    x, y = F.try_element_at(s, low + 1), F.try_element_at(s, F.least(low + 2, n))
    return F.when(n > 0, x + (y - x) * (at - low))


def snr_db(a: Column, length: int, hop: int, share: float = 0.1) -> Column:
    """Signal level over the quietest frames', 60 over silence; null for a
    signal shorter than a frame."""
    floor = percentile(frame_rms(a, length, hop), share)
    return F.when(floor < 1e-10, 60.0).otherwise(20 * F.log10(F.greatest(rms(a), F.lit(1e-10)) / floor))


def clip(a: Column) -> Column:
    return F.transform(doubles(a), lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def fade(a: Column, rate: int, in_ms: float = 10, out_ms: float = 10) -> Column:
    """Linear ramps at both ends, each at most half of the signal."""
    n, half = F.size(a), F.floor(F.size(a) / 2)
    up, down = F.least(F.lit(int(rate * in_ms / 1000)), half), F.least(F.lit(int(rate * out_ms / 1000)), half)

    def ramp(x: Column, i: Column) -> Column:
        first = F.when(i < up, F.when(up > 1, i / (up - 1)).otherwise(0.0)).otherwise(1.0)
        k = i - (n - down)
        last = F.when(k >= 0, F.when(down > 1, 1 - k / (down - 1)).otherwise(1.0)).otherwise(1.0)
        return x * first * last

    return F.transform(doubles(a), ramp)


def silence(rate: int, ms: float) -> Column:
    return F.array_repeat(F.lit(0.0), int(rate * ms / 1000))


def joined(clips: Column, pad: Column) -> Column:
    """Clips end to end with ``pad`` between them."""
    return F.flatten(F.transform(clips, lambda x, i: F.when(i > 0, F.concat(pad, doubles(x))).otherwise(doubles(x))))


def stereo_to_mono_pcm(a: Column) -> Column:
    """Mean of interleaved pairs, rounded down."""
    at = F.when(F.size(a) >= 2, F.sequence(F.lit(0), F.floor(F.size(a) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.floor((F.element_at(a, i * 2 + 1) + F.element_at(a, i * 2 + 2)) / 2).cast("int"))


def resample_pcm(a: Column, rate: int, to: int) -> Column:
    """Linear interpolation, truncated towards zero."""
    ratio = to / rate
    n = F.floor(F.size(a) * F.lit(ratio)).cast("int")

    def at(k: Column) -> Column:
        x = k / F.lit(ratio)
        low = F.floor(x).cast("int")
        part = x - low
        return (F.element_at(a, low + 1) * (1 - part) + F.element_at(a, F.least(low + 2, F.size(a))) * part).cast("int")

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<int>"))


def trim(a: Column, top_db: float = 20, pad: int = 800) -> Column:
    """Cut to the samples over the threshold and ``pad`` around them; the last
    of them is left out, as its index ends the slice."""
    n = F.size(a)

    def cut(loud: Column) -> Column:
        start = F.greatest(F.lit(0), F.coalesce(F.try_element_at(loud, F.lit(1)), F.lit(0)) - pad)
        end = F.least(n, F.coalesce(F.try_element_at(loud, F.lit(-1)), n - 1) + pad)
        return F.slice(a, start + 1, F.greatest(end - start, F.lit(0)))

    over = lambda limit: F.filter(F.transform(doubles(a), lambda x, i: F.when(F.abs(x) > limit, i)), lambda i: i.isNotNull())
    return let(let(peak(a) * (10 ** (-top_db / 20)), over), cut)


def normalize_rms_pcm(a: Column, target: float = 5000) -> Column:
    """To an RMS in sample units, guarded by the peak, truncated and bounded."""
    scale = F.least(F.lit(float(target)) / rms(a), F.lit(32767.0) / peak(a))
    bounded = lambda x: F.greatest(F.lit(-32768), F.least(F.lit(32767), x))
    return F.when(rms(a) > 0, let(scale, lambda k: F.transform(doubles(a), lambda x: bounded((x * k).cast("int")))))


def rescale_index(i: Column, rate: int, to: int) -> Column:
    """A sample index at another rate, rounded down."""
    return F.floor(i * F.lit(rate) / F.lit(to)).cast("long")


def pad_features(a: Column, length: int, fill: float = 0.0) -> Column:
    """Exactly ``length`` frames: cut, or filled up."""
    return F.slice(F.concat(doubles(a), F.array_repeat(F.lit(fill), length)), 1, length)


def labels(prompt: list[int], tokens: Column, pad: int, end: int) -> Column:
    """Prompt, tokens without padding, end."""
    kept = F.filter(tokens, lambda t: (t != pad) & (t >= 0))
    return F.concat(F.array(*[F.lit(p) for p in prompt]).cast("array<int>"), kept, F.array(F.lit(end)).cast("array<int>"))


def padded_labels(ids: Column, length: Column | int, fill: int = -100) -> Column:
    n = F.lit(length) if isinstance(length, int) else length
    return F.concat(ids, F.array_repeat(F.lit(fill), F.greatest(n - F.size(ids), F.lit(0)).cast("int")))


def decoder_input(padded: Column, start: int, pad: int, fill: int = -100) -> Column:
    """Shifted right behind a start token, with padding put back."""
    back = F.transform(padded, lambda t: F.when(t == fill, F.lit(pad)).otherwise(t))
    return F.concat(F.array(F.lit(start)).cast("array<int>"), F.slice(back, 1, F.greatest(F.size(back) - 1, F.lit(0))))


def joined_labels(ids: Column, n: Column, prompt: list[int], end: int, pad: int, start: int, fill: int = -100) -> list[Column]:
    """``padded_labels`` and ``decoder_input`` as comma-separated text, with ``n``
    labels of padding behind prompt, ``ids`` (comma-separated, may be empty) and
    end.  Padding is text repeated, as most of a batch may be padding."""
    said = F.concat_ws(",", *[F.lit(str(p)) for p in prompt], F.nullif(ids, F.lit("")))
    labels = F.concat(said, F.lit(f",{end}"), F.repeat(F.lit(f",{fill}"), n))
    # the shift drops the last of all: the end where nothing is padded, else one pad
    tail = F.when(n > 0, F.concat(F.lit(f",{end}"), F.repeat(F.lit(f",{pad}"), n - 1))).otherwise("")
    return [labels.alias("labels"), F.concat(F.lit(f"{start},"), said, tail).alias("decoder")]
