"""N-best segmentation of text over a SentencePiece vocabulary.

The pieces that match at each place of a text form a lattice.  A forward Viterbi pass
gives the best score from the start to each place; these scores are exact
heuristics for an A-star search from the end backwards, which therefore meets the
complete segmentations in order of their scores.  Each open path of the search stands for a
complete one of its own with just that score, so no more paths than segmentations are wanted
stay open, and a path is kept as a chain of links: memory grows with the length of a segment.

No piece goes on past the place where a character is followed by a space, nor
past a line feed, so each path of the lattice of a whole text passes those places:
the lattice falls apart into segments.  Segments are solved once per worker; the N best of a
text are put together from those of its segments.

A piece's score is its log probability under Zipf's law by its rank in the model
file.  Bytes stand for a character only where the vocabulary hasn't got it.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np

from . import _text

_SEGMENT = re.compile(r"\n| *[^ \n]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)
LONG = 40  # bytes; longer segments are solved one by one
CELLS = 3_000_000  # lattice edges solved at once
MEMO = 300_000
MEMO_BYTES = 16 << 20  # of segments
BYTE_PENALTY = 10.0


def segments(text: str) -> list[str]:
    """Segments of a text, a space put before it as the model file asks for."""
    return _SEGMENT.findall(" " + text) if text else []


class PieceLattice:
    """Best and N-best segmentations under the vocabulary of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        by_rank = sorted(pieces, key=lambda i: (-sp.get_score(i), i))
        norm = math.log(sum(1 / (r + 2.7) for r in range(len(by_rank))))
        self.surface = [b""] * sp.get_piece_size()
        self.vocabulary: dict[bytes, tuple[int, float]] = {}
        for rank, i in enumerate(by_rank):
            surface = sp.id_to_piece(i).replace("▁", " ").encode()
            if b" " in surface.lstrip(b" ") or b"\n" in surface:
                continue  # would join segments
            self.surface[i] = surface
            self.vocabulary.setdefault(surface, (i, -math.log(rank + 2.7) - norm))
        self.byte_score = min(s for _, s in self.vocabulary.values()) - BYTE_PENALTY
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        for b, i in enumerate(self.byte_id.tolist()):
            self.surface[i] = bytes([b])
        self.longest = max(map(len, self.vocabulary))
        keys = np.array([self._hash(np.frombuffer(p, np.uint8)) for p in self.vocabulary], np.uint64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ids = np.array([i for i, _ in self.vocabulary.values()], np.int32)[order]
        self._scores = np.array([s for _, s in self.vocabulary.values()])[order]
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[(_text.mix(self._keys) >> np.uint64(44)).astype(np.int64)] = True
        self._index: dict[str, int] = {}
        self._n_best: dict[str, list[tuple[float, bytes]]] = {}
        self._clear()

    @staticmethod
    def _hash(data: np.ndarray) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for b in data.astype(np.uint64) + np.uint64(1):
            h = h * _BASE + b
        return h[0]

    def _clear(self) -> None:
        self._index.clear()
        self._n_best.clear()
        self._held = 0
        self.best_ids: list[bytes] = []
        self.best_scores = np.empty(0)
        self.gaps = np.empty(0)
        self.bytes_used = np.empty(0, np.int64)

    # one segment, place by place

    def edges_to(self, data: bytes, end: int) -> list[tuple[int, int, float]]:
        """(start, id, score) of the pieces that end at byte ``end``."""
        found = []
        for start in range(max(0, end - self.longest), end):
            hit = self.vocabulary.get(data[start:end])
            if hit:
                found.append((start, *hit))
        lead = end - 1
        while data[lead] & 0xC0 == 0x80:
            lead -= 1
        stop = end
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop += 1
        if data[lead:stop] not in self.vocabulary:
            found.append((end - 1, int(self.byte_id[data[end - 1]]), self.byte_score))
        return found

    def forward(self, data: bytes) -> list[float]:
        """Best score from the start to each byte place."""
        best = [0.0] + [-math.inf] * len(data)
        for end in range(1, len(data) + 1):
            best[end] = max((best[s] + x for s, _, x in self.edges_to(data, end)), default=-math.inf)
        return best

    def n_best(self, segment: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best (score, ids) of a segment, best first; equal scores in order of ids from the end."""
        got = self._n_best.get(segment)
        if got is None or len(got) < n:
            data = segment.encode()
            ahead = self.forward(data)
            # open paths (score of the whole, place, score so far, (id, link)) in order of their ids from the end
            front: list[tuple] = [(ahead[-1], len(data), 0.0, None)]
            got = []
            while front and len(got) < n:
                k = max(range(len(front)), key=lambda j: front[j][0])
                _, at, behind, link = front[k]
                if not at:
                    ids = []
                    while link:
                        ids.append(link[0])
                        link = link[1]
                    got.append((behind, np.array(ids, "<u4").tobytes()))
                    del front[k]
                    continue
                edges = sorted((i, start, behind + x) for start, i, x in self.edges_to(data, at) if ahead[start] > -math.inf)
                front[k : k + 1] = [(s + ahead[start], start, s, (i, link)) for i, start, s in edges]
                if len(front) > n - len(got):
                    best = sorted(range(len(front)), key=lambda j: -front[j][0])[: n - len(got)]
                    front = [front[j] for j in sorted(best)]
            self._n_best[segment] = got
        return got

    # many segments of one length at once

    def _solve(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(best score, distance of the second best, ids from the end padded with -1, byte pieces) of equally long segments."""
        n, size = data.shape
        reach = min(size, self.longest)
        score = np.full((reach + 1, size, n), -np.inf)
        ids = np.full((reach + 1, size, n), -1, np.int32)
        symbols = data.T.astype(np.uint64) + np.uint64(1)
        h = np.zeros((size, n), np.uint64)
        for k in range(1, reach + 1):
            h = h[: size - k + 1] * _BASE + symbols[k - 1 :]
            where = np.flatnonzero(self._maybe[(_text.mix(h.ravel()) >> np.uint64(44)).astype(np.int64)])
            wanted = h.ravel()[where]
            at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
            hit = self._keys[at] == wanted
            score[k].reshape(-1)[where[hit]] = self._scores[at[hit]]
            ids[k].reshape(-1)[where[hit]] = self._ids[at[hit]]
        b = data.T
        lead = (b & 0xC0) != 0x80
        width = np.where(b < 0xC0, 1, np.where(b < 0xE0, 2, np.where(b < 0xF0, 3, 4)))
        known = np.zeros((size, n), bool)
        for k in range(1, min(4, reach) + 1):
            known |= lead & (width == k) & (score[k] > -np.inf)
        from_lead = np.maximum.accumulate(np.where(lead, np.arange(size)[:, None], 0), axis=0)
        unknown = ~np.take_along_axis(known, from_lead, 0)
        fallback = unknown & (score[1] == -np.inf)
        score[1][fallback] = self.byte_score
        ids[1][fallback] = self.byte_id[b[fallback]]

        ahead, behind = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        step = np.zeros((size + 1, n), np.int64)
        ahead[0] = behind[size] = 0
        for end in range(1, size + 1):
            for k in range(1, min(end, reach) + 1):
                x = ahead[end - k] + score[k, end - k]
                better = x > ahead[end]
                ahead[end][better] = x[better]
                step[end][better] = k
        for start in range(size - 1, -1, -1):
            for k in range(1, min(size - start, reach) + 1):
                np.maximum(behind[start], behind[start + k] + score[k, start], out=behind[start])
        path = np.full((size, n), -1, np.int32)
        n_bytes = np.zeros(n, np.int64)
        at, col, turn = np.full(n, size), np.arange(n), 0
        live = col
        through = score.copy()
        while len(live):
            k = step[at[live], live]
            start = at[live] - k
            path[turn, live] = ids[k, start, live]
            n_bytes[live] += fallback[start, live] & (k == 1)
            through[k, start, live] = -np.inf  # what is left are edges off the best path
            at[live] = start
            live = live[start > 0]
            turn += 1
        second = np.full(n, -np.inf)
        for k in range(1, reach + 1):
            second = np.maximum(second, (ahead[: size - k + 1] + through[k, : size - k + 1] + behind[k:]).max(0))
        return ahead[size], ahead[size] - second, path[:turn], n_bytes

    def _learn(self, new: list[str], n: int) -> None:
        by_size: dict[int, list[str]] = {}
        scores, gaps, used = [self.best_scores], [self.gaps], [self.bytes_used]
        for s in new:
            data = s.encode()
            self._held += len(data)
            if len(data) > LONG:
                two = self.n_best(s, max(n, 2))
                score, ids = two[0]
                self._index[s] = len(self._index)
                self.best_ids.append(ids)
                scores.append([score])
                gaps.append([score - two[1][0] if len(two) > 1 else np.inf])
                used.append([int(np.isin(np.frombuffer(ids, "<u4"), self.byte_id).sum())])
            else:
                by_size.setdefault(len(data), []).append(s)
        for size, group in by_size.items():
            turn = CELLS // (size * min(size, self.longest)) + 1
            for k in range(0, len(group), turn):
                part = group[k : k + turn]
                best, gap, path, n_bytes = self._solve(np.frombuffer("".join(part).encode(), np.uint8).reshape(-1, size))
                turned = path[::-1].T
                keep = turned >= 0
                flat = turned[keep].astype("<u4").tobytes()
                ends = (np.cumsum(keep.sum(1)) * 4).tolist()
                first = len(self._index)
                self._index.update(zip(part, range(first, first + len(part))))
                self.best_ids += [flat[a:b] for a, b in zip([0, *ends], ends)]
                scores.append(best)
                gaps.append(gap)
                used.append(n_bytes)
        self.best_scores, self.gaps, self.bytes_used = np.concatenate(scores), np.concatenate(gaps), np.concatenate(used).astype(np.int64)

    def encode(self, texts: list[str], n: int) -> list[tuple[list[bytes], list[float], int]]:
        """For each text: ids of its ``n`` best segmentations, their scores, byte pieces of the best one."""
        split = [segments(t) for t in texts]
        if len(self._index) > MEMO or self._held > MEMO_BYTES:
            self._clear()
        flat = [s for part in split for s in part]
        found = list(map(self._index.get, flat))
        if None in found:
            fresh = [k for k, i in enumerate(found) if i is None]
            self._learn(list(dict.fromkeys(flat[k] for k in fresh)), n)
            for k in fresh:
                found[k] = self._index[flat[k]]
        places, end, out = np.array(found, np.int64), 0, []
        for part in split:
            at = places[end : end + len(part)]
            end += len(part)
            best = [self.best_ids[i] for i in at.tolist()]
            total, gaps = float(self.best_scores[at].sum()), self.gaps[at]
            few = np.argsort(gaps, kind="stable")[: n - 1] if len(part) >= n else np.arange(len(part))
            few = [int(k) for k in few if gaps[k] < np.inf] if n > 1 else []
            # a choice elsewhere than in the n - 1 smallest gaps has n - 1 better ones before it
            ways: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
            options = [self.n_best(part[k], n) for k in few]
            for option in options:
                ways = sorted((d + option[0][0] - s, (*w, j)) for d, w in ways for j, (s, _) in enumerate(option))[:n]
            ranked, scores = [], []
            for d, way in ways:
                own = list(best)
                for k, j, option in zip(few, way, options):
                    own[k] = option[j][1]
                ranked.append(b"".join(own))
                scores.append(total - d)
            out.append((ranked, scores, int(self.bytes_used[at].sum())))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation, the space put before it taken away."""
        return b"".join([self.surface[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def piece_lattice(model_file: str) -> PieceLattice:
    """The worker's own lattice; Spark reuses workers, so solved segments serve later tasks too."""
    return PieceLattice(model_file)
