"""A priority queue of totals that spills sorted runs, for time-forward processing."""

from __future__ import annotations

import heapq
import struct
import tempfile

RECORD = struct.Struct("<5q")
READ_RECORDS = 4096


def _merged(entries):
    """Sorted entries (key of three numbers, two totals); those of one key become one."""
    last = None
    for e in entries:
        if last is not None and last[:3] == e[:3]:
            last = (*last[:3], last[3] + e[3], last[4] + e[4])
            continue
        if last is not None:
            yield last
        last = e
    if last is not None:
        yield last


class SpillingQueue:
    """Totals sent to keys, taken in the order of the keys.

    At most ``limit`` messages are held; beyond, they are sorted, merged by key and
    written to an unnamed temporary file, which only this task reads and which goes
    with it, as the sorts of a task do.
    """

    def __init__(self, limit: int = 1 << 18):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def push(self, key: tuple[int, int, int], leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (*key, leaves, saved))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        f = tempfile.TemporaryFile()
        for e in _merged(sorted(self.heap)):
            f.write(RECORD.pack(*e))
        f.seek(0)
        self.heap.clear()
        self.spills += 1
        self._advance(self._read(f))

    @staticmethod
    def _read(f):
        with f:
            while part := f.read(RECORD.size * READ_RECORDS):
                yield from RECORD.iter_unpack(part)

    def _advance(self, run) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.runs, (head, self.spills, id(run), run))

    def take(self, key: tuple[int, int, int]) -> tuple[int, int]:
        """Totals sent to ``key``; messages to keys before it are gone."""
        leaves = saved = 0
        while self.heap and self.heap[0][:3] <= key:
            e = heapq.heappop(self.heap)
            if e[:3] == key:
                leaves, saved = leaves + e[3], saved + e[4]
        while self.runs and self.runs[0][0][:3] <= key:
            e, _, _, run = heapq.heappop(self.runs)
            if e[:3] == key:
                leaves, saved = leaves + e[3], saved + e[4]
            self._advance(run)
        return leaves, saved
