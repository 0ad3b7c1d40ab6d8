"""External induced suffix sorting: disk-backed priority queues that carry suffix tuples and common-prefix values.

``suffixes`` yields the suffixes of an integer sequence in descending order,
each with its longest common prefix with the suffix before it.  S* suffixes
are sorted first: their substrings are named, and unless the names are unique
the sequence of names is sorted by recursion.  From their order the L suffixes
are induced in ascending order, and from those the S suffixes in descending
order.  A suffix that leaves a queue pushes its left neighbour with

    (first symbol, rank of the suffix that induced it, position, common prefix
     with the suffix pushed before it for that symbol),

so the common prefix is one more than the smallest value between the two
inducing ranks, read from a monotone stack.  Queues keep a bounded heap and
spill sorted runs to the task's scratch folder; the sequence itself may be a
memory map.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from bisect import bisect_right
from collections.abc import Iterator, Sequence


_LARGEST = 1 << 62


def scratch_folder() -> tempfile.TemporaryDirectory:
    """A folder for one task's runs under the executor's own Spark scratch space; gone when the task ends."""
    return tempfile.TemporaryDirectory(prefix="induced-", dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)


class DiskQueue:
    """A priority queue of tuples that holds at most ``memory`` of them in its heap and the rest in sorted runs on disk."""

    CHUNK = 1024

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.heap, self.heads, self.runs, self.n = folder, memory, [], [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        self.n += 1
        if len(self.heap) > self.memory:
            self._spill()

    def _spill(self) -> None:
        """The larger half goes to a run; what is needed next stays."""
        self.heap.sort()
        keep, out = self.heap[: self.memory // 2], self.heap[self.memory // 2:]
        path = os.path.join(self.folder, f"run-{id(self):x}-{len(self.runs)}")
        with open(path, "wb") as f:
            for i in range(0, len(out), self.CHUNK):
                pickle.dump(out[i:i + self.CHUNK], f, protocol=pickle.HIGHEST_PROTOCOL)
        run = self._read(path)
        self.runs.append(run)
        heapq.heappush(self.heads, (next(run), len(self.runs) - 1))
        self.heap = keep

    @staticmethod
    def _read(path: str) -> Iterator[tuple]:
        with open(path, "rb") as f:
            while True:
                try:
                    yield from pickle.load(f)
                except EOFError:
                    break
        os.remove(path)

    def peek(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0]

    def pop(self) -> tuple:
        self.n -= 1
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, i = self.heads[0]
            following = next(self.runs[i], None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, i))
            return item
        return heapq.heappop(self.heap)

    def __len__(self) -> int:
        return self.n


class _Minima:
    """Smallest of the values appended after a given rank."""

    def __init__(self):
        self.ranks: list[int] = []
        self.values: list[int] = []

    def append(self, rank: int, value: int) -> None:
        while self.values and self.values[-1] >= value:
            self.values.pop()
            self.ranks.pop()
        self.values.append(value)
        self.ranks.append(rank)

    def since(self, rank: int) -> int:
        return self.values[bisect_right(self.ranks, rank)]


def _induce(s: Sequence[int], seeds: Iterator[tuple[int, int]], sign: int, queue: DiskQueue) -> Iterator[tuple[int, bool, int]]:
    """(position, induced, common prefix with the one before) in ascending (``sign`` 1: L from S*) or descending order (-1: S from L).

    ``seeds``: (position, common prefix with the seed before) in that order; the end of the sequence is the seed ``len(s)``."""
    n = len(s)
    symbol = lambda i: s[i] if i < n else -1
    minima, last_push = _Minima(), {}
    prev, prev_induced, rank = None, False, 0
    seed = next(seeds, None)

    def run(i: int) -> int:
        j = i
        while j < n and s[j] == s[i]:
            j += 1
        return j - i

    while seed is not None or len(queue):
        # of one symbol, L suffixes are smaller than S suffixes: in either direction the queue goes first
        if len(queue) and (seed is None or queue.peek()[0] <= sign * symbol(seed[0])):
            _, _, pos, carried = queue.pop()
            induced = True
            same = prev is not None and prev_induced and symbol(prev) == symbol(pos)
            lcp = carried if same else 0
        else:
            pos, seed_lcp = seed
            seed = next(seeds, None)
            induced = False
            if prev is None or symbol(prev) != symbol(pos) or pos == n:
                lcp = 0
            elif prev_induced:
                lcp = min(run(prev), run(pos))      # an L and an S suffix of one symbol differ where its run ends
            else:
                lcp = seed_lcp
        minima.append(rank, lcp)
        yield pos, induced, lcp
        left = pos - 1
        if left >= 0:
            c, here = s[left], symbol(pos)
            # L: larger than what follows, S: smaller; equal symbols have the type of the one that follows
            if (c > here if sign > 0 else c < here) or c == here and induced:
                carried = 1 + minima.since(last_push[c]) if c in last_push else 0
                last_push[c] = rank
                queue.push((sign * c, rank, left, carried))
        prev, prev_induced, rank = pos, induced, rank + 1


def _s_star(s: Sequence[int]) -> list[int]:
    """Positions of S suffixes whose left neighbour is an L suffix, in text order, and the end of the sequence."""
    n = len(s)
    out, is_s = [n], False
    for i in range(n - 2, -1, -1):
        now = s[i] < s[i + 1] or s[i] == s[i + 1] and is_s
        if is_s and not now:
            out.append(i + 1)
        is_s = now
    return out[::-1]


def _sorted_s_star(s: Sequence[int], folder: str, memory: int) -> Iterator[tuple[int, int]]:
    """S* suffixes in ascending order with their common prefixes."""
    n, at = len(s), _s_star(s)
    queue = DiskQueue(folder, memory)
    for j, p in enumerate(at):
        q = at[j + 1] if j + 1 < len(at) else n
        # where one substring begins another, its last symbol is of type S and the other's is not: it is the larger
        queue.push((tuple(s[p:min(q + 1, n)]) + ((-1,) if q == n else (_LARGEST,)), j))
    names, name, before, unique = [0] * len(at), -1, None, True
    while len(queue):
        sub, j = queue.pop()
        if sub != before:
            name, before = name + 1, sub
        else:
            unique = False
        names[j] = name
    if unique:
        order = ((j, 0) for j in sorted(range(len(at)), key=names.__getitem__))
    else:
        upwards = DiskList(folder)
        for j, m in suffixes(names, folder, memory):
            if j < len(names):
                upwards.append((j, m))
        order = _shifted(upwards.backwards())
    prev = None
    for j, m in order:
        p = at[j]
        lcp = 0
        if prev is not None:
            a, b, x = p, at[prev], at[min(j + m, len(at) - 1)] - p if m else 0
            while max(a, b) + x < n and s[a + x] == s[b + x]:
                x += 1
            lcp = x
        yield p, lcp
        prev = j


def _shifted(descending_reversed: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Common prefixes with the next larger suffix, read upwards, as common prefixes with the one before."""
    carry = 0
    for j, with_next in descending_reversed:
        yield j, carry
        carry = with_next


def suffixes(s: Sequence[int], folder: str, memory: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """(position, common prefix with the next larger suffix) of every suffix, largest first; the empty one is last.

    ``s`` holds non-negative integers; ``memory``: tuples a queue keeps in its heap."""
    if not len(s):
        yield 0, 0
        return
    # L suffixes ascending; common prefixes between neighbours in the list of L suffixes alone
    ascending, low = DiskList(folder), None
    for pos, induced, lcp in _induce(s, _sorted_s_star(s, folder, memory), 1, DiskQueue(folder, memory)):
        low = lcp if low is None else min(low, lcp)
        if induced:
            ascending.append((pos, low))
            low = None
    def seeds() -> Iterator[tuple[int, int]]:
        carry = 0
        for pos, lcp in ascending.backwards():
            yield pos, carry
            carry = lcp
        yield len(s), 0
    for pos, _, lcp in _induce(s, seeds(), -1, DiskQueue(folder, memory)):
        yield pos, lcp


class DiskList:
    """An append-only list on disk that is read back to front."""

    CHUNK = 1 << 14

    def __init__(self, folder: str):
        self.path, self.tail, self.starts = os.path.join(folder, f"list-{id(self):x}"), [], []
        self.file = open(self.path, "w+b")

    def append(self, item: tuple) -> None:
        self.tail.append(item)
        if len(self.tail) >= self.CHUNK:
            self.starts.append(self.file.tell())
            pickle.dump(self.tail, self.file, protocol=pickle.HIGHEST_PROTOCOL)
            self.tail = []

    def backwards(self) -> Iterator[tuple]:
        yield from reversed(self.tail)
        for start in reversed(self.starts):
            self.file.seek(start)
            yield from reversed(pickle.load(self.file))
        self.file.close()
        os.remove(self.path)
