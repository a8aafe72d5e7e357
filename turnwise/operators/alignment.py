"""Word alignment of many pairs at once, in a band around the diagonal."""

from __future__ import annotations

import numpy as np

# Cells of one step over a group of pairs: bounds memory, not results.
CELLS = 2_000_000
FAR = 1 << 50


def _group(wanted: list[np.ndarray], heard: list[np.ndarray], band: int) -> tuple[np.ndarray, np.ndarray]:
    """Errors and hits of pairs of about equal length, over alignments whose places differ by
    at most ``band``. One number per cell: errors first, hits as tie-break."""
    n, m = np.array([len(w) for w in wanted]), np.array([len(h) for h in heard])
    pairs, longest, width = len(n), int(n.max()), 2 * band + 1
    weight = longest + int(m.max()) + 1
    refs = np.full((pairs, longest), -1, np.int32)
    # Row i sees the words heard at i - band to i + band, a stretch that moves by one.
    gots = np.full((pairs, longest + max(width, band + int(m.max()))), -2, np.int32)
    for p, (w, h) in enumerate(zip(wanted, heard)):
        refs[p, : len(w)] = w
        gots[p, band : band + len(h)] = h
    steps = np.arange(width, dtype=np.int64) * weight
    row = np.where(np.arange(width) < band, FAR, steps - band * weight)[None, :].repeat(pairs, 0)
    last = np.arange(pairs), np.clip(m - n + band, 0, width - 1)
    found = row[last]
    for i in range(longest):
        best = row + np.where(gots[:, i : i + width] == refs[:, i : i + 1], -1, weight)
        np.minimum(best[:, :-1], row[:, 1:] + weight, out=best[:, :-1])
        # An insertion costs the same everywhere, so a running minimum does them all.
        row = np.minimum.accumulate(best - steps, axis=1) + steps
        ends = n == i + 1
        if ends.any():
            found[ends] = row[last][ends]
    errors = -(-found // weight)
    return errors, errors * weight - found


def operations(wanted: list[np.ndarray], heard: list[np.ndarray], errors: list[int | None]) -> np.ndarray:
    """Insertions, deletions, substitutions and hits of every pair of coded word lists, by an
    alignment with the fewest errors and, among those, the most hits.

    ``errors`` has the number of errors where it is known: no such alignment leaves a band of
    that width, so the work grows with length times errors. Where it is not known, the band
    is doubled until the errors fit.
    """
    n, m = np.array([len(w) for w in wanted], np.int64), np.array([len(h) for h in heard], np.int64)
    known = np.array([-1 if e is None else e for e in errors], np.int64)
    band = np.where(known >= 0, known, np.maximum(64, abs(n - m)))
    fewest, hits = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    left = np.arange(len(n))
    while len(left):
        # Pairs of like length and band go together.
        size = lambda x: np.ceil(np.log2(np.maximum(x, 1))).astype(int)
        order = left[np.lexsort((n[left], size(n[left]), size(band[left])))]
        start = 0
        while start < len(order):
            like = (size(band[order]) == size(band[order[start]])) & (size(n[order]) == size(n[order[start]]))
            end = start + int(like[start:].sum())
            widest, longest = int(band[order[start:end]].max()), int(max(n[order[start:end]].max(), m[order[start:end]].max()))
            most = max(1, CELLS // (4 * widest + 2 * longest + 4))
            some = order[start : min(end, start + most)]
            fewest[some], hits[some] = _group([wanted[p] for p in some], [heard[p] for p in some], widest)
            start += len(some)
        left = left[(known[left] < 0) & (fewest[left] > band[left])]
        band[left] *= 2
    substituted = n + m - 2 * hits - fewest
    return np.stack([m - hits - substituted, n - hits - substituted, substituted, hits], axis=1)
