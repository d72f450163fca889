"""Context-tree weighting over bytes, in numpy.

Each byte is eight binary decisions; each decision has its own tree over the
bytes before it, the nearest first. A node holds how often the decision went
either way after its context. Krichevsky-Trofimov estimates of all depths are
mixed: ``Pw = (Pe + product of the children's Pw) / 2``, and at the greatest
depth ``Pw = Pe``. A key packs a context and the byte that follows it, nearest
context byte first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

END = 0xFF  # never a byte of UTF-8: closes every text and fills the context before it


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving small arguments up by eight."""
    low = x < 8
    lifted = np.where(low, x + 8, x)
    shift = np.zeros_like(lifted)
    for k in range(8):
        shift += np.where(low, np.log(np.where(low, x + k, 1.0)), 0.0)
    inverse = 1 / lifted
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (lifted - 0.5) * np.log(lifted) - lifted + 0.5 * np.log(2 * np.pi) + series - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    zeros, ones = zeros.astype(float), ones.astype(float)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def key_pieces(bodies: list[bytes], depth: int, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Keys of all bytes and ends, in pieces of bounded size however long a text is."""
    group, size = [], 0
    for body in bodies:
        if len(body) > most:
            stream = np.frombuffer(bytes([END]) * depth + body + bytes([END]), np.uint8)
            for start in range(depth, len(stream), most):
                yield _packed(stream, np.arange(start, min(start + most, len(stream))), depth)
            continue
        group.append(body)
        size += len(body)
        if size > most:
            yield keys_of(group, depth)
            group, size = [], 0
    if group:
        yield keys_of(group, depth)


def _packed(stream: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    keys = stream[at].astype(np.uint64)
    for back in range(1, depth + 1):
        keys |= stream[at - back].astype(np.uint64) << np.uint64(8 * (depth + 1 - back))
    return keys


def keys_of(bodies: list[bytes], depth: int) -> np.ndarray:
    """Keys of all bytes and ends of the texts, one text after the other."""
    stream = np.frombuffer(b"".join(bytes([END]) * depth + body + bytes([END]) for body in bodies), np.uint8)
    sizes = np.array([len(body) + 1 for body in bodies], np.int64)
    at = np.arange(int(sizes.sum())) + np.repeat((np.arange(len(bodies)) + 1) * depth, sizes)
    return _packed(stream, at, depth)


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts summed up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


class Level:
    """The nodes of one depth: sorted keys (context, decision), counts, and weights once known."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        order = np.argsort(nodes, kind="stable")
        nodes, zeros, ones = nodes[order], zeros[order], ones[order]
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, np.int64)
        self.nodes = nodes[first]
        self.zeros, self.ones = (np.add.reduceat(x, first) if len(first) else x for x in (zeros, ones))
        self.log_weighted = self.stop = np.zeros(0)

    def weigh(self, below: np.ndarray | None) -> None:
        """``below``: summed log weights of each node's children; None at the greatest depth."""
        own = log_estimate(self.zeros, self.ones)
        if below is None:
            self.log_weighted, self.stop = own, np.ones(len(own))
        else:
            self.log_weighted = np.logaddexp(own, below) - np.log(2)
            self.stop = np.exp(own - np.log(2) - self.log_weighted)

    def parents(self, above: Level) -> np.ndarray:
        return np.searchsorted(above.nodes, parent_of(self.nodes))

    def up(self) -> Level:
        return Level(parent_of(self.nodes), self.zeros, self.ones)


def parent_of(nodes: np.ndarray) -> np.ndarray:
    """Drops the farthest context byte of (context, decision) keys."""
    return nodes >> np.uint64(16) << np.uint64(8) | nodes & np.uint64(0xFF)


def decisions(keys: np.ndarray, depth: int, most: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Node of one decision of each key at a depth, and which way it went."""
    byte = keys & np.uint64(0xFF)
    context = keys >> np.uint64(8 * (most - depth + 1))
    prefix = np.uint64(1 << bit) | byte >> np.uint64(8 - bit) if bit else np.ones(len(keys), np.uint64)
    return context << np.uint64(8) | prefix, (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)


def grow(keys: np.ndarray, counts: np.ndarray, most: int, least: int) -> dict[int, Level]:
    """Levels ``least`` to ``most`` of the trees of these keys, weighted from below."""
    nodes, zeros, ones = [], [], []
    for bit in range(8):
        node, way = decisions(keys, most, most, bit)
        nodes.append(node)
        ones.append(counts * way)
        zeros.append(counts * (1 - way))
    levels = {most: Level(np.concatenate(nodes), np.concatenate(zeros), np.concatenate(ones))}
    levels[most].weigh(None)
    for depth in range(most - 1, least - 1, -1):
        below = levels[depth + 1]
        levels[depth] = below.up()
        levels[depth].weigh(np.bincount(below.parents(levels[depth]), weights=below.log_weighted, minlength=len(levels[depth].nodes)))
    return levels


def log10_probability(keys: np.ndarray, levels: dict[int, Level], most: int) -> np.ndarray:
    """Predictive log10 probability of each key's byte after its context: the product of its eight mixed decisions.

    A decision never seen at some depth is even from there on.
    """
    out = np.zeros(len(keys))
    for bit in range(8):
        mixed, left = np.zeros(len(keys)), np.ones(len(keys))
        for depth in range(most + 1):
            level = levels[depth]
            node, way = decisions(keys, depth, most, bit)
            at = np.minimum(np.searchsorted(level.nodes, node), max(0, len(level.nodes) - 1))
            seen = level.nodes[at] == node if len(level.nodes) else np.zeros(len(keys), bool)
            if not seen.any():
                break
            at = at[seen]
            zeros, ones, stop = level.zeros[at], level.ones[at], level.stop[at]
            estimate = (np.where(way[seen] == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            mixed[seen] += left[seen] * stop * estimate
            mixed[~seen] += left[~seen] * 0.5
            left[seen] *= 1 - stop
            left[~seen] = 0
        out += np.log10(mixed + left * 0.5)
    return out
