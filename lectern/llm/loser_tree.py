"""Merging front-coded sorted runs with a loser tree that knows common prefixes.

Every head of a run carries the length of its common prefix with the last string given out. Of
two heads, the one that shares more with it is the smaller, without a look at either; only
where both share as much are bytes compared, and only those beyond the shared prefix. What a
loser then shares with its winner is kept for the next match.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Run(NamedTuple):
    """Sorted strings of one width: what each shares with the one before, and the bytes beyond."""

    shared: np.ndarray
    tails: bytes


def front_code(strings: np.ndarray) -> Run:
    """``strings``: sorted rows of bytes, as a matrix."""
    count, width = strings.shape
    shared = np.zeros(count, np.int64)
    if count > 1:
        differ = strings[1:] != strings[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    beyond = np.arange(width) >= shared[:, None]
    return Run(shared, strings[beyond].tobytes())


def merge_runs(runs: list[Run], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order, as places in the runs laid end to end, and what neighbours share in it.

    Equal strings come in the order of their runs.
    """
    total = sum(len(run.shared) for run in runs)
    shared = [run.shared.tolist() for run in runs]
    tails = [run.tails for run in runs]
    sizes = [len(s) for s in shared]
    bases = np.cumsum([0, *sizes]).tolist()
    place, tail_at = [0] * len(runs), [0] * len(runs)
    head: list[bytes | None] = [None] * len(runs)
    common = [0] * len(runs)

    def advance(run: int) -> None:
        at = place[run]
        if at == sizes[run]:
            head[run] = None
            return
        keep, begin = shared[run][at], tail_at[run]
        end = begin + width - keep
        tail = tails[run][begin:end]
        head[run] = head[run][:keep] + tail if keep else tail
        common[run] = keep
        tail_at[run] = end

    def beats(a: int, b: int) -> bool:
        """Whether head a is given out before head b; the loser learns what it shares with the winner."""
        left, right = head[a], head[b]
        if left is None or right is None:
            return right is None
        known, other = common[a], common[b]
        if known != other:
            return known > other
        if left[known:] == right[known:]:
            common[max(a, b)] = width
            return a < b
        apart = int.from_bytes(left[known:]) ^ int.from_bytes(right[known:])
        share = width - (apart.bit_length() + 7) // 8
        if left[share] < right[share]:
            common[b] = share
            return True
        common[a] = share
        return False

    for run in range(len(runs)):
        advance(run)
        common[run] = 0
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    # Missing leaves are exhausted runs.
    missing = leaves - len(runs)
    head += [None] * missing
    common += [0] * missing
    losers = [0] * leaves
    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    champion = winners[1] if leaves > 1 else 0

    order, lengths = [0] * total, [0] * total
    for out in range(total):
        order[out] = bases[champion] + place[champion]
        lengths[out] = common[champion]
        place[champion] += 1
        advance(champion)
        node = (leaves + champion) // 2
        while node:
            rival = losers[node]
            if beats(rival, champion):
                losers[node], champion = champion, rival
            node //= 2
    return np.array(order, np.int64), np.array(lengths, np.int64)
