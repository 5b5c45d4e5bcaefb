"""A priority queue of messages that spills sorted runs to the task's own scratch file.

Time-forward processing hands values to rows that a task meets later in its order. The queue holds what is under
way: beyond ``limit`` messages the held ones are sorted and written to an anonymous temporary file, which goes with the task;
reading merges the runs. Nothing outside the task ever reads them, so a lost executor costs the task alone.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator

#: (depth key, node, children, leaves, saved), five 64-bit numbers.
RECORD = struct.Struct("<qqqqq")
READ = 4096


class MessageQueue:
    def __init__(self, limit: int = 200_000):
        self.limit, self.held, self.heads = limit, [], []

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.held, message)
        if len(self.held) > self.limit:
            self._spill()

    def _spill(self) -> None:
        out = tempfile.TemporaryFile()
        self.held.sort()
        out.write(b"".join(RECORD.pack(*m) for m in self.held))
        out.seek(0)
        self.held = []
        self._advance(self._read(out), len(self.heads))

    @staticmethod
    def _read(source) -> Iterator[tuple[int, ...]]:
        with source:
            while block := source.read(RECORD.size * READ):
                yield from RECORD.iter_unpack(block)

    def _advance(self, run: Iterator[tuple[int, ...]], number: int) -> None:
        if (message := next(run, None)) is not None:
            heapq.heappush(self.heads, (message, number, run))

    def take(self, key: tuple[int, int]) -> tuple[int, int, int]:
        """Sums of (children, leaves, saved) over all messages for ``key``, which leave the queue."""
        children = leaves = saved = 0
        while self.held and self.held[0][:2] == key:
            m = heapq.heappop(self.held)
            children, leaves, saved = children + m[2], leaves + m[3], saved + m[4]
        while self.heads and self.heads[0][0][:2] == key:
            m, number, run = heapq.heappop(self.heads)
            children, leaves, saved = children + m[2], leaves + m[3], saved + m[4]
            self._advance(run, number)
        return children, leaves, saved

    def __len__(self) -> int:
        return len(self.held) + len(self.heads)
