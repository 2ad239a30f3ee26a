"""Signals as arrays of floats: soundness, loud windows, key, bits and their likeness. Arrow batches in, columns out."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SILENT_AMP, CLIP_AMP = 1e-3, 0.99
SILENT_SHARE, CLIPPED_SHARE, LEAST_SECONDS = 0.90, 0.05, 5
HOP_SECONDS, LEAST_WORDS = 5, 40
# Names of the keys, and the published profiles of major and minor keys.
KEYS = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
MAJOR = [6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88]
MINOR = [6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17]


def share_where(signal: Column, test) -> Column:
    """The part of an array's values that pass ``test``; null for an empty or null array."""
    return F.size(F.filter(signal, test)) / F.nullif(F.size(signal), F.lit(0))


def silent_share(signal: Column) -> Column:
    return share_where(signal, lambda x: F.abs(x) < SILENT_AMP)


def clipped_share(signal: Column) -> Column:
    return share_where(signal, lambda x: F.abs(x) > CLIP_AMP)


def soundness(signal: Column, rate: int, silent_from: float = SILENT_SHARE, clipped_from: float = CLIPPED_SHARE) -> Column:
    """``short``, ``silent``, ``clipped`` or ``ok``, the first that holds; null for a null array."""
    return (
        F.when(signal.isNull(), None).when(F.size(signal) < LEAST_SECONDS * rate, "short")
        .when(silent_share(signal) > silent_from, "silent").when(clipped_share(signal) > clipped_from, "clipped").otherwise("ok")
    )


def loud_windows(signal: Column, rate: int, k: int = 4, seconds: int = 30) -> Column:
    """The ``k`` loudest windows that don't overlap, as (start, end) in seconds, in time order.

    Windows begin every ``HOP_SECONDS``; of equally loud ones the earlier counts. A signal
    of at most one window is one window itself; null gives null.
    """

    def pick(x) -> list[dict]:
        per_second = np.add.reduceat(np.square(np.asarray(x, np.float64)), np.arange(0, max(len(x), 1), rate)) if len(x) else np.zeros(1)
        whole = len(x) // rate
        if whole <= seconds:
            return [{"start": 0, "end": max(whole, 1)}]
        loud = np.convolve(per_second[:whole], np.ones(seconds), "valid")[::HOP_SECONDS]
        taken: list[int] = []
        for i in np.argsort(-loud.round(9), kind="stable"):
            if len(taken) < k and all(abs(int(i) * HOP_SECONDS - t) >= seconds for t in taken):
                taken.append(int(i) * HOP_SECONDS)
        return [{"start": t, "end": t + seconds} for t in sorted(taken)]

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def windows(signals: pd.Series) -> pd.Series:
        return signals.map(pick, na_action="ignore")

    return windows(signal)


def key_of(chroma: Column) -> Column:
    """Name and mode of the key whose profile correlates best with twelve chroma means; null unless there are twelve."""
    turned = np.stack([np.roll(p, i) for i in range(12) for p in (MAJOR, MINOR)])
    turned = (turned - turned.mean(1, keepdims=True)) / turned.std(1, keepdims=True)

    @F.pandas_udf("key string, mode string")
    def key(chromas: pd.Series) -> pd.DataFrame:
        fit = np.array([c is not None and len(c) == 12 for c in chromas], dtype=bool)
        out = pd.DataFrame({"key": [None] * len(chromas), "mode": [None] * len(chromas)}, dtype=object)
        if fit.any():
            c = np.stack([np.asarray(x, dtype=np.float64) for x in chromas[fit]])
            best = np.argmax((c - c.mean(1, keepdims=True)) @ turned.T, axis=1)
            out.loc[fit, "key"] = [KEYS[b // 2] for b in best]
            out.loc[fit, "mode"] = [("major", "minor")[b % 2] for b in best]
        return out

    return key(chroma)


def words_of(bands: Column) -> Column:
    """Words of 32 bits from frames of 33 band energies: the sign of the difference over bands and time."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def words(frames: pd.Series) -> pd.Series:
        def one(f):
            if f is None or len(f) < 2:
                return None if f is None else []
            steps = np.diff(np.diff(np.stack(list(f)).astype(np.float64), axis=1), axis=0)
            return (steps > 0) @ (1 << np.arange(31, -1, -1, dtype=np.int64))

        return frames.map(one)

    return words(bands)


def likeness(a: Column, b: Column, least: int = LEAST_WORDS) -> Column:
    """The greatest share of equal bits as the shorter row of words slides along the longer; 0 below ``least`` words."""
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    n = F.size(short)
    apart = lambda at: F.aggregate(F.zip_with(short, F.slice(long, at, n), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)
    at_best = F.array_min(F.transform(F.sequence(F.lit(1), F.size(long) - n + 1), apart))
    return F.when(n < least, 0.0).otherwise(1.0 - at_best / (n * 32))
