"""Two-stage suffix sorting of many short strings at once.

A suffix is of type B if it is smaller than its successor, else of type A. Stage one sorts the B suffixes directly, by
eight bytes at a time and only as long as they tie. Stage two induces the A suffixes: the buckets of first bytes are
scanned in order, and each entry puts its predecessor, if that is of type A, at the next place of its own bucket. The
scan takes a whole bucket at a time.
"""

from __future__ import annotations

import numpy as np

#: Zero bytes behind every string, so that eight-byte words never reach the next one.
PAD = 64


class Strings:
    """Strings in one buffer, each followed by PAD zero bytes; a suffix is an offset into the buffer."""

    def __init__(self, strings: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        pad = bytes(PAD)
        self.data = np.frombuffer(pad.join(strings) + pad * bool(strings) + bytes(8), dtype=np.uint8)
        self.starts = np.cumsum(self.sizes + PAD) - self.sizes - PAD
        n = len(self.data) - 8
        self.words = np.ndarray(shape=(n,), dtype=">u8", buffer=self.data, strides=(1,))
        self.owner = np.repeat(np.arange(len(strings), dtype=np.int32), self.sizes + PAD)[:n]
        self.left = (np.repeat(self.starts + self.sizes, self.sizes + PAD)[:n] - np.arange(n)).astype(np.int32)

    def suffix_array(self, depth: int) -> np.ndarray:
        """All suffixes within strings, sorted by their first `depth` bytes at least; a string's end sorts before any byte."""
        data, left = self.data, self.left
        place = np.flatnonzero(left > 0)
        here, following = data[place].astype(np.int16), np.where(left[place] > 1, data[place + 1].astype(np.int16), -1)
        # in a run of one byte the type is that of the run's last position
        decided = here != following
        last = np.flatnonzero(decided)
        run_end = last[np.searchsorted(last, np.arange(len(place)))] if len(place) else last
        smaller = (here < following)[run_end]
        b = self._sorted(place[smaller], depth)
        b_from = np.searchsorted(data[b], np.arange(257))
        waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
        out: list[np.ndarray] = []

        def induce(entries: np.ndarray, byte: int) -> None:
            """Predecessors with a greater byte, in scan order, to their buckets."""
            before = entries - 1
            before = before[(before >= 0)]
            before = before[left[before] > 0]
            keys = data[before]
            greater = keys > byte if byte >= 0 else np.ones(len(keys), dtype=bool)
            before, keys = before[greater], keys[greater]
            order = np.argsort(keys, kind="stable")
            before, keys = before[order], keys[order]
            if len(keys):
                at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
                for a, e in zip(at, [*at[1:], len(keys)], strict=True):
                    waiting[int(keys[a])].append(before[a:e])

        induce(self.starts + self.sizes, -1)
        for byte in range(256):
            mine = list(waiting[byte])
            waiting[byte] = []
            level = np.concatenate(mine) if mine else np.zeros(0, dtype=np.int64)
            while len(level):
                # a run of this byte: its earlier positions follow in scan order
                before = level - 1
                before = before[before >= 0]
                level = before[(left[before] > 0) & (data[before] == byte)]
                if len(level):
                    mine.append(level)
            own = b[b_from[byte] : b_from[byte + 1]]
            bucket = np.concatenate([*mine, own]) if mine else own
            if len(bucket):
                out.append(bucket)
                induce(bucket, byte)
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)

    def _sorted(self, at: np.ndarray, depth: int) -> np.ndarray:
        """The given suffixes by their first `depth` bytes: eight at a time, only what still ties."""
        at = at[np.argsort(self.words[at].astype(np.uint64), kind="stable")]
        first = self.words[at]
        group = np.cumsum(np.concatenate([[False], first[1:] != first[:-1]])) if len(at) else at
        for offset in range(8, depth, 8):
            if not len(at):
                break
            sizes = np.bincount(group)
            tied = np.flatnonzero(sizes[group] > 1)
            if not len(tied):
                break
            rows, keys = at[tied], group[tied]
            reach = np.minimum(rows + offset, len(self.words) - 1)
            word = np.where(self.left[rows] > offset - PAD + 8, self.words[reach], 0).astype(np.uint64)
            order = np.lexsort((word, keys))
            at[tied] = rows[order]
            word, keys = word[order], keys[order]
            split = np.zeros(len(at), dtype=np.int64)
            new = np.concatenate([[False], (word[1:] != word[:-1]) & (keys[1:] == keys[:-1])])
            split[tied] = new
            edge = np.concatenate([[False], group[1:] != group[:-1]])
            group = np.cumsum(split.astype(bool) | edge)
        if (self.left > 0).sum() > np.count_nonzero(self.data):
            # zero bytes of a string look like its end to the words: the shorter suffix goes first
            at = at[np.lexsort((np.minimum(self.left[at], depth), group))] if len(at) else at
        return at

    def common_prefixes(self, suffixes: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each suffix with the one before it (0 for the first)."""
        n = len(suffixes)
        lcp = np.zeros(n, dtype=np.int64)
        if n < 2:
            return lcp
        a, b = suffixes[:-1], suffixes[1:]
        most = np.minimum(self.left[a], self.left[b])
        live = np.arange(n - 1)
        offset = 0
        while len(live):
            differ = self.words[a[live] + offset].astype(np.uint64) ^ self.words[b[live] + offset].astype(np.uint64)
            same = differ == 0
            if not same.all():
                # leading zero bytes of the difference
                bits = differ[~same]
                zeros = np.zeros(len(bits), dtype=np.int64)
                for shift in range(56, -1, -8):
                    zeros += (bits >> np.uint64(shift)) == 0
                lcp[live[~same] + 1] = offset + zeros
            live = live[same]
            offset += 8
            ended = most[live] <= offset
            lcp[live[ended] + 1] = offset
            live = live[~ended]
        lcp[1:] = np.minimum(lcp[1:], most)
        return lcp
