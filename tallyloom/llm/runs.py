"""Periodic run detection: a suffix automaton with link-cut access.

Words are appended to a suffix automaton one by one. Its suffix links form a
tree; each appended word recolours the path from the new state to the root with
the place where these suffixes now end. The path falls into segments that last
ended at one place each, found and recoloured by link-cut access. If the
distance from a segment's last end to the new one is at most the length of its
longest word sequence, that stretch is a square of this period; extended as far
as the period holds, it is a run.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallyloom.llm.common import fields, per_document

RUN = fields(start="long", length="long", period="long")
RUNS = StructType([*fields(n_words="long").fields, StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
_RUN = pa.struct([(name, pa.int64()) for name in RUN.names])


class Automaton:
    """Suffix automaton of a sequence, its suffix-link tree kept as link-cut trees (splay trees, one per path of one colour).

    State 1 is the root, 0 none. Arrays of machine integers hold a state's
    length, suffix link, first transition, splay children and parent, and
    colour; a colour is valid at the top of a splay tree only. Further
    transitions of a state are in ``more``.
    """

    def __init__(self, most: int):
        room = bytes(4 * (2 * most + 2))
        self.length, self.link, self.word, self.target, self.left, self.right, self.parent, self.colour = (array("i", room) for _ in range(8))
        self.word[1] = -1
        self.more: dict[int, dict[int, int]] = {}
        self.size, self.last = 2, 1

    def append(self, word: int) -> int:
        """Adds the state of the whole sequence so far."""
        length, link, first, target, more = self.length, self.link, self.word, self.target, self.more
        new = self.size
        self.size += 1
        p = self.last
        length[new] = length[p] + 1
        first[new] = -1
        q = 0
        while p:
            if first[p] < 0:
                first[p], target[p] = word, new
            elif first[p] == word:
                q = target[p]
                break
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {word: new}
                else:
                    q = others.setdefault(word, new)
                    if q != new:
                        break
                    q = 0
            p = link[p]
        if not p:
            link[new] = 1
        elif length[p] + 1 == length[q]:
            link[new] = q
        else:
            link[new] = self.split(p, q, word)
        self.parent[new] = link[new]
        self.last = new
        return new

    def split(self, p: int, q: int, word: int) -> int:
        """A state between ``q`` and its suffix link, on the same path of the same colour."""
        length, link, first, target, more = self.length, self.link, self.word, self.target, self.more
        new = self.size
        self.size += 1
        length[new], link[new], first[new], target[new] = length[p] + 1, link[q], first[q], target[q]
        if q in more:
            more[new] = dict(more[q])
        while p:
            if first[p] == word:
                if target[p] != q:
                    break
                target[p] = new
            else:
                others = more[p]
                if others[word] != q:
                    break
                others[word] = new
            p = link[p]
        link[q] = new
        self.splay(q)
        above = self.left[q]
        self.left[new] = above
        if above:
            self.parent[above] = new
        self.left[q], self.parent[new] = new, q
        return new

    def splay(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        while True:
            y = parent[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = parent[y]
            if z and (left[z] == y or right[z] == y):
                self.rotate(y if (left[y] == x) == (left[z] == y) else x)
            self.rotate(x)

    def rotate(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        y = parent[x]
        z = parent[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            parent[inner] = y
        parent[y], parent[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        self.colour[x] = self.colour[y]

    def recolour(self, x: int, end: int):
        """Gives the path from the root to ``x`` the colour ``end``; yields (length, old colour) of its segments, deepest first."""
        left, right, parent, colour = self.left, self.right, self.parent, self.colour
        below = 0
        while x:
            y = parent[x]
            if y and (left[y] == x or right[y] == x):
                self.splay(x)
            old = colour[x]
            if old:
                yield self.length[x], old
            if right[x]:
                colour[right[x]] = old
            right[x] = below
            below, x = x, parent[x]
        colour[below] = end


def find_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """All (start, end, period) of stretches of at least two periods that can't be extended, by the smallest period."""
    automaton, found, reached = Automaton(len(words)), [], {}
    n = len(words)
    for end, word in enumerate(words, 1):
        for length, before in automaton.recolour(automaton.append(word), end):
            period = end - before
            if period <= length and end > reached.get(period, 0):
                stop = end
                while stop < n and words[stop] == words[stop - period]:
                    stop += 1
                reached[period] = stop
                found.append((end - period - length, stop, period))
    return found


def stretches(ids: np.ndarray, documents: np.ndarray, least: int, rounds: int = 8) -> list[tuple[int, int]]:
    """Stretches that may hold runs: every word in a run comes at least twice in it, so texts part at words that don't.

    Words that come once in their stretch are taken out, round by round;
    stretches of fewer than ``least`` words go. Whatever is left after the
    last round is left to the automaton.
    """
    at, inside = np.arange(len(ids)), documents.astype(np.int64)
    width = int(ids.max()) + 1 if len(ids) else 1
    for _ in range(rounds):
        if not len(at):
            break
        _, which, times = np.unique(inside * width + ids[at], return_inverse=True, return_counts=True)
        kept = times[which] > 1
        if kept.all():
            break
        at, inside = at[kept], inside[kept]
        inside = np.cumsum(np.append(True, (np.diff(at) != 1) | (np.diff(inside) != 0))[:len(at)]) - 1
        enough = np.bincount(inside, minlength=1)[inside] >= least
        at, inside = at[enough], inside[enough]
    if not len(at):
        return []
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(inside) != 0)) + 1
    return list(zip(at[np.append(0, cuts)].tolist(), (at[np.append(cuts, len(at)) - 1] + 1).tolist()))


def measure(bodies: list[bytes | None], least: int) -> list[pa.Array]:
    texts = [(body or b"").split() for body in bodies]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    found: list[list[dict]] = [[] for _ in texts]
    for a, b in stretches(ids, np.repeat(np.arange(len(texts)), sizes), least):
        document = int(np.searchsorted(starts, a, side="right")) - 1
        # texts without words share their start with the next one: the last of them holds the words
        base = a - int(starts[document])
        _, words = np.unique(ids[a:b], return_inverse=True)
        for start, end, period in find_runs(words.tolist()):
            if end - start >= least:
                found[document].append({"start": base + start, "length": end - start, "period": period})
    collapsed = []
    for words, runs in zip(texts, found):
        runs.sort(key=lambda r: (r["start"], r["period"]))
        if runs:
            dropped = np.zeros(len(words), bool)
            for r in runs:
                dropped[r["start"] + r["period"]:r["start"] + r["length"]] = True
            words = [words[k] for k in np.flatnonzero(~dropped)]
        collapsed.append(b" ".join(words))
    return [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None, least_words: int = 12) -> DataFrame:
    """``row``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``, one row per input row, no shuffle.

    A run is a stretch of consecutive words of smallest period q, at least
    ``least_words`` and twice q long, that neither neighbour extends. The
    collapsed text is the words, joined by a space, without those that some run
    holds after its first q. Null, empty and blank texts have no runs and
    collapse to the empty text; rows that repeat get equal results; an empty
    table gives an empty table; other columns stay inside ``row``. Texts are
    taken whole: the automaton takes about 64 bytes for each word of the
    longest stretch whose words all repeat in it.
    """
    return per_document(docs, lambda bodies: measure(bodies, least_words), RUNS, text, keep)
