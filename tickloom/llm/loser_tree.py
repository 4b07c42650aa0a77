"""Front-coded sorted runs and their merge by a loser tree that never compares a known common prefix again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "little") ^ int.from_bytes(b[known:n], "little")
    return n if not x else known + ((x & -x).bit_length() - 1) // 8


def front_code(strings: Iterable[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Of a sorted run: for each string the prefix shared with the one before, all rests in a row, and their lengths."""
    shared, rests, lengths, last = [], [], [], b""
    for s in strings:
        k = common_prefix(last, s)
        shared.append(k)
        rests.append(s[k:])
        lengths.append(len(s) - k)
        last = s
    return np.array(shared, "<u4"), b"".join(rests), np.array(lengths, "<u4")


def front_decoded(shared: np.ndarray, rests: bytes, lengths: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(prefix shared with the string before, string) of a front-coded run."""
    at, last = 0, b""
    for k, n in zip(shared.tolist(), lengths.tolist()):
        last = last[:k] + rests[at : at + n]
        at += n
        yield k, last


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs of (prefix shared with the string before in its run, string).

    Yields (prefix shared with the string yielded before, string, number of the run). Equal strings come in the order of
    their runs. Each player keeps how much it shares with the last winner it met, which is the last string
    yielded once it meets the next player: the one that shares more is smaller, and
    only players that share equally much are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings: list[bytes | None] = [None] * k
    shares = [0] * k
    for r, run in enumerate(runs):
        first = next(run, None)
        if first is not None:
            strings[r] = first[1]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two players, the loser's share being with the winner afterwards."""
        s, t = strings[a], strings[b]
        if s is None or t is None:
            return (b, a) if s is None else (a, b)
        if shares[a] != shares[b]:
            return (a, b) if shares[a] > shares[b] else (b, a)
        n = common_prefix(s, t, shares[a])
        smaller = s[n : n + 1] < t[n : n + 1] or (s[n : n + 1] == t[n : n + 1] and a < b)
        winner, loser = (a, b) if smaller else (b, a)
        shares[loser] = n
        return winner, loser

    losers = [0] * k
    winners = [0] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while strings[best] is not None:
        yield shares[best], strings[best], best
        following = next(runs[best], None)
        if following is None:
            strings[best] = None
        else:
            shares[best], strings[best] = following
        node = (best + k) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2
