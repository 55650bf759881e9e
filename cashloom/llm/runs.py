"""Periodic runs of words, found with minimizers at several scales, and texts without their repetitions.

A run is a stretch of words with a smallest period q that holds at least ``LEAST_EXPONENT`` periods and
``LEAST_LENGTH`` words, and that no neighbouring word extends with that period. ``periodic_stretches``
finds all of them in one sequence of numbers:

- Periods too short for a minimizer are read off directly: where a word equals the one a lag further on.
- For periods of 2w to 4w, of every w successive fragments of w words the one with the smallest hash is
  the window's minimizer. A window inside a run recurs a period later, so its minimizer has an equal one
  at that distance. Pairs of equal minimizers at distances of that scale are the seeds, and each is
  extended both ways by comparing words, so that hashes decide nothing.
- Fragments that are runs of a period up to w / 3 themselves are no minimizers. They are known from the
  scales before. Without them equal fragments are over w / 3 apart, so that a minimizer has at most
  twelve partners within 4w; and a run of a longer period always has others in each of its periods.

Work grows with the words times the number of scales. Texts are read whole, several together in a
block, each closed by a number of its own that no run can hold.

Defined results: a null or empty text, or one without words, has no runs and an empty collapsed text;
equal texts have equal results, whatever their ids; ids of any kind, null and repeated ones too, are
carried along; an empty table gives an empty one; columns not named in ``keep`` don't matter, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH, LEAST_EXPONENT = 24, 3
#: Words of the smallest fragment; lags below twice as many are scanned directly.
FIRST_SCALE = 4
#: Words of the texts that are searched together; a longer text is a block of its own.
BLOCK_WORDS = 500_000
#: Words compared at first when a seed is extended, and at most at once.
FIRST_STEP, MOST_STEP = 64, 1 << 16

NO_MINIMIZER = np.uint64(0xFFFFFFFFFFFFFFFF)
# Odd multipliers of a 64-bit mixing step.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * MIX_A
    values ^= values >> np.uint64(29)
    values *= MIX_B
    values ^= values >> np.uint64(32)
    return values


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of fragments of twice ``width`` from those of ``width``."""
    return _mixed(hashes[:-width] * MIX_B + (hashes[width:] ^ MIX_A))


def _over_windows(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every ``width`` successive values, a power of two."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def minimizers(hashes: np.ndarray, width: int, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fragments that are least in a window of ``width`` fragments.

    ``periodic`` fragments don't count.
    """
    keys = np.where(periodic, NO_MINIMIZER, hashes)
    if len(keys) < width:
        return np.zeros(0, np.int64), keys[:0]
    least = _over_windows(keys, width, np.minimum)
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    # a fragment is least somewhere if the largest of its windows' minima is its own hash
    chosen = np.flatnonzero((_over_windows(around, width, np.maximum) == keys) & (keys != NO_MINIMIZER))
    return chosen, keys[chosen]


def seeds(positions: np.ndarray, hashes: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal minimizers ``least`` or more and under ``most`` apart: first position, distance."""
    order = np.argsort(hashes, kind="stable")
    at, key = positions[order], hashes[order]
    firsts, distances, step = [], [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (key[step:] == key[:-step]) & (apart < most)
        if not near.any():
            break
        taken = near & (apart >= least)
        firsts.append(at[:-step][taken])
        distances.append(apart[taken])
        step += 1
    none = [np.zeros(0, np.int64)]
    return np.concatenate(firsts or none), np.concatenate(distances or none)


def _equal_until(symbols: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on whose symbol isn't the one ``lag`` further on."""
    end, step = len(symbols) - lag, FIRST_STEP
    while at < end:
        stop = min(at + step, end)
        differs = symbols[at:stop] != symbols[at + lag : stop + lag]
        first = int(differs.argmax())
        if differs[first]:
            return at + first
        at, step = stop, min(2 * step, MOST_STEP)
    return end


def _equal_from(symbols: np.ndarray, at: int, lag: int) -> int:
    """The first place from which on up to ``at`` every symbol is the one ``lag`` further on."""
    step = FIRST_STEP
    while at > 0:
        start = max(0, at - step)
        differs = (symbols[start:at] != symbols[start + lag : at + lag])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return at - first
        at, step = start, min(2 * step, MOST_STEP)
    return 0


def _scanned(symbols: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Start and length of every maximal stretch of period ``lag`` with enough periods."""
    same = np.zeros(len(symbols) - lag + 2, np.int8)
    same[1:-1] = symbols[:-lag] == symbols[lag:]
    edges = np.flatnonzero(np.diff(same))
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + lag
    enough = lengths >= LEAST_EXPONENT * lag
    return zip(starts[enough].tolist(), lengths[enough].tolist())


def periodic_stretches(symbols: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all maximal stretches of ``LEAST_EXPONENT`` periods and more.

    ``longest`` is the length that a stretch can have at most, all of ``symbols`` by default. Two periods
    of one stretch of three or more are multiples of the smallest, which is found first.
    """
    longest = len(symbols) if longest is None else longest
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, 2 * FIRST_SCALE):
        if LEAST_EXPONENT * lag <= longest:
            for stretch in _scanned(symbols, lag):
                found.setdefault(stretch, lag)
    scale = FIRST_SCALE
    hashes = _mixed(symbols.astype(np.uint64) + np.uint64(1))
    for width in (1 << k for k in range(FIRST_SCALE.bit_length() - 1)):
        if width < len(hashes):
            hashes = _joined(hashes, width)
    while 2 * scale * LEAST_EXPONENT <= longest:
        change = np.zeros(len(hashes) + 1, np.int64)
        for (start, length), period in found.items():
            if 3 * period <= scale <= length:
                change[start] += 1
                change[start + length - scale + 1] -= 1
        positions, keys = minimizers(hashes, scale, np.cumsum(change[:-1]) > 0)
        firsts, distances = seeds(positions, keys, 2 * scale, min(4 * scale, longest // LEAST_EXPONENT + 1))
        # a stretch of two distances of equal words goes on by a fragment to one side or the other
        last = len(hashes) - 1
        after, before = np.minimum(firsts + scale, last), np.maximum(firsts - scale, 0)
        goes_on = (hashes[after] == hashes[np.minimum(after + distances, last)]) | (hashes[before] == hashes[before + distances])
        firsts, distances = firsts[goes_on], distances[goes_on]
        order = np.lexsort((firsts, distances))
        lag_now, covered = 0, 0
        for at, lag in zip(firsts[order].tolist(), distances[order].tolist()):
            if lag == lag_now and at < covered:
                continue  # in the stretch that was extended last
            start, covered, lag_now = _equal_from(symbols, at, lag), _equal_until(symbols, at, lag), lag
            if covered - start >= (LEAST_EXPONENT - 1) * lag:
                stretch = (start, covered - start + lag)
                found[stretch] = min(lag, found.get(stretch, lag))
        scale *= 2
        if scale // 2 >= len(hashes):
            break
        hashes = _joined(hashes, scale // 2)
    return sorted((start, length, period) for (start, length), period in found.items())


class _Numbers(dict):
    """A number for each word, in the order in which words come up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _searched(texts: list[list[bytes]]) -> tuple[list[list[dict[str, int]]], list[bytes]]:
    """Runs and collapsed text of each of the texts, given as words."""
    numbers = _Numbers()
    ends = np.cumsum([len(words) + 1 for words in texts])
    symbols = np.empty(int(ends[-1]), np.int64)
    for k, (words, end) in enumerate(zip(texts, ends.tolist())):
        symbols[end - 1 - len(words) : end - 1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        symbols[end - 1] = -1 - k
    runs: list[list[dict[str, int]]] = [[] for _ in texts]
    dropped: dict[int, np.ndarray] = {}
    for start, length, period in periodic_stretches(symbols, max(map(len, texts))):
        if length < LEAST_LENGTH:
            continue
        k = int(np.searchsorted(ends, start, side="right"))
        own = start - (int(ends[k - 1]) if k else 0)
        runs[k].append({"start": own, "length": length, "period": period})
        dropped.setdefault(k, np.zeros(len(texts[k]), bool))[own + period : own + length] = True
    for found in runs:
        found.sort(key=lambda r: (r["start"], r["period"]))
    kept = [
        b" ".join(words if k not in dropped else [w for w, gone in zip(words, dropped[k].tolist()) if not gone])
        for k, words in enumerate(texts)
    ]
    return runs, kept


RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: the ``keep`` columns, n_words, runs (start, length, period) and collapsed.

    Runs are in the order of start and period. ``collapsed`` has the words that no run repeats, joined
    by one space: those that are in no run, and of every run the first period.
    """
    source = docs.select(*keep, F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("run_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]]
    added = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def made(kept: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs, collapsed = _searched(texts)
        sizes = pa.array([len(words) for words in texts], pa.int64())
        columns = [*kept.columns, sizes, pa.array(runs, RUN_TYPE), pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*kept.schema.names, "n_words", "runs", "collapsed"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(batch.schema.names[:-1])
            texts: list[list[bytes]] = []
            first, held = 0, 0
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                texts.append(value.as_py().split())  # of bytes: blank and tab to carriage return only
                held += len(texts[-1])
                if held >= block_words:
                    yield made(kept.slice(first, len(texts)), texts)
                    texts, first, held = [], row + 1, 0
            if texts:
                yield made(kept.slice(first, len(texts)), texts)

    return source.mapInArrow(searched, ", ".join([*fields, added]))
