"""N-best SentencePiece segmentation and decoding.

A text's lattice has an edge for every vocabulary piece at every place (and one of
byte pieces for a character that the vocabulary lacks). A forward Viterbi pass gives
each place the best score of any path from the start; run backwards from the end, A*
search takes those scores as its estimate of what is left, which is exact, so the
paths complete in order of their scores.

The lattice falls apart where no piece spans two characters, so a text's N best paths are combined from those
of its units (words with the space before them; longer ones cut where no piece spans). A path among the
text's N best departs from the units' best paths only at the N - 1 units with the cheapest single departures. So the
different units of a run of texts get a forward and a backward Viterbi pass together, as matrices, which give every unit's
best path and the cost of its cheapest departure; and A* runs for the N - 1 units of each text that can matter. Nothing is
remembered beyond a run of texts of about ``CHUNK_CHARS`` characters.

Scores are those of the model file. Its normaliser isn't applied: ids are those of the text as it is, so that
decoding gives the text back; where the library would change the text first, its ids differ.

Defined results: null or empty text has one path, without pieces, of score 0; a text
with fewer than N paths gets those it has; paths of equal score come in a fixed
order; a text of any length is taken whole; repeated rows each get a row; an empty table
gives an empty result; other columns are ignored."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEST = 4
META = "▁"
#: A word with the meta spaces before it (those of the text itself included), or the last ones.
WORD = re.compile(f"{META}*[^{META}]+|{META}+")
#: A character outside the vocabulary scores this much below the lowest piece, per byte.
UNKNOWN = 10.0
#: Characters of the texts that are worked on together (one text alone may be longer).
CHUNK_CHARS = 1 << 22
#: Units up to this length take part in the matrices, which have at most so many cells at a time.
UNIT_CHARS, CELLS = 32, 1 << 21
NO = -np.inf

#: A path: (score, ids); the best first.
Paths = list[tuple[float, tuple[int, ...]]]


def _mixed(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (h ^ codes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str]) -> np.ndarray:
    """Code points of texts of one length, a row each."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(texts), -1)


class PieceTable:
    """Finds pieces by the hashes of their characters; a match is compared character by character."""

    def __init__(self, pieces: list[str], longest: int):
        self.codes = np.zeros((len(pieces) + 1, longest), np.uint32)
        self.keys = np.zeros(len(pieces) + 1, np.uint64)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        for length, at in by_length.items():
            codes = _codes([pieces[i] for i in at])
            self.codes[at, :length] = codes
            h = np.zeros(len(at), np.uint64)
            for k in range(length):
                h = _mixed(h, codes[:, k])
            self.keys[at] = h
        self.levels, left = [], np.arange(len(pieces))
        self.shift = np.uint64(64 - max(4, int(len(pieces)).bit_length() + 2))
        while len(left):
            multiplier = np.uint64(0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1E * len(self.levels) & 0xFFFFFFFFFFFFFFFF | 1)
            table = np.full(1 << (64 - int(self.shift)), len(pieces), np.int32)
            slot = ((self.keys[left] * multiplier) >> self.shift).astype(np.int64)
            table[slot] = left
            self.levels.append((multiplier, table))
            left = left[table[slot] != left]
        self.none = len(pieces)

    def find(self, h: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Number of the piece with the hash ``h`` and the code points in ``windows`` (last axis); ``none`` otherwise."""
        out = np.full(h.shape, self.none, np.int32)
        for multiplier, table in self.levels:
            found = table[(h * multiplier) >> self.shift]
            hit = self.keys[found] == h
            out[hit] = found[hit]
        hit = np.nonzero(out != self.none)
        same = (self.codes[out[hit], :windows.shape[-1]] == windows[hit]).all(axis=-1)
        out[tuple(x[~same] for x in hit)] = self.none
        return out


class Units:
    """Best paths of different units: score, cost of the cheapest departure, and ids from ``start`` in ``ids``."""

    def __init__(self, n: int):
        self.best, self.departure = np.zeros(n), np.full(n, np.inf)
        self.start, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.parts: list[np.ndarray] = []
        self.total = 0

    def put(self, at: np.ndarray, best: np.ndarray, departure: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        self.best[at], self.departure[at], self.size[at] = best, departure, size
        self.start[at] = self.total + np.cumsum(size) - size
        self.parts.append(ids)
        self.total += len(ids)

    def close(self) -> None:
        self.ids = np.concatenate([np.zeros(0, "<u4"), *self.parts]).astype("<u4")


def _gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` one after the other."""
    ends = np.cumsum(size)
    return values[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Lattice:
    """Pieces and scores of a model file."""

    def __init__(self, path: str, n: int = BEST):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.n = n
        self.piece = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(size)
                      if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.bytes_of = [b""] * size
        for text, (i, _) in self.piece.items():
            self.bytes_of[i] = text.replace(META, " ").encode()
        for value, i in self.byte.items():
            self.bytes_of[i] = bytes([value])
        real = [s for _, s in self.piece.values() if s > -1e8]
        self.unknown = min(real, default=0.0) - UNKNOWN
        self.longest = max(map(len, self.piece), default=1)
        self.spanned = {p[k:k + 2] for p in self.piece for k in range(len(p) - 1)}
        self.tied = any(a != META and b == META for a, b in self.spanned)  # a piece across the end of a word
        self.table = PieceTable(list(self.piece), self.longest)
        self.piece_ids = np.array([i for i, _ in self.piece.values()] + [0], "<u4")
        self.piece_scores = np.array([s for _, s in self.piece.values()] + [NO])
        self.id_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.id_size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.id_start = np.cumsum(self.id_size) - self.id_size

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end place the edges (start, score, ids) that reach it."""
        out: list[list] = [[] for _ in range(len(text) + 1)]
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                if found := self.piece.get(text[start:end]):
                    out[end].append((start, found[1], (found[0],)))
            if not out[end] or out[end][-1][0] != end - 1:
                raw = text[end - 1].encode()
                out[end].append((end - 1, self.unknown * len(raw), tuple(self.byte[b] for b in raw)))
        return out

    def search(self, text: str) -> Paths:
        """The N best paths through the lattice of ``text``, by backward A*. An agenda entry stands for all paths that
        take the k-th best edge into a place before the tail already chosen; taking it out gives one entry for the
        next best edge, and one for the place where the edge begins."""
        edges = self.edges(text)
        best = [0.0] + [NO] * len(text)
        for end in range(1, len(text) + 1):
            best[end] = max(best[start] + score for start, score, _ in edges[end])
        if not text:
            return [(0.0, ())]
        ordered: set[int] = set()
        found: Paths = []
        agenda, made = [(-best[-1], 0, len(text), 0, 0.0, None)], 0
        while agenda and len(found) < self.n:
            _, _, at, k, done, tail = heapq.heappop(agenda)
            if at not in ordered:
                edges[at].sort(key=lambda e: -(best[e[0]] + e[1]))
                ordered.add(at)
            if k + 1 < len(edges[at]):
                start, score, _ = edges[at][k + 1]
                made += 1
                heapq.heappush(agenda, (-(best[start] + score + done), made, at, k + 1, done, tail))
            start, score, more = edges[at][k]
            if start:
                made += 1
                heapq.heappush(agenda, (-(best[start] + score + done), made, start, 0, done + score, (more, tail)))
            else:
                ids, node = list(more), tail
                while node is not None:
                    ids += node[0]
                    node = node[1]
                found.append((done + score, tuple(ids)))
        return found

    def viterbi(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of units of one length: best scores, costs of the cheapest departures, and the best paths' ids, concatenated,
        with their numbers."""
        codes = _codes(texts)
        w, n = codes.shape
        most = min(n, self.longest)
        piece = np.full((most + 1, w, n), self.table.none, np.int32)  # by length and start
        score = np.full((most + 1, w, n), NO)
        h = np.zeros((w, n), np.uint64)
        for length in range(1, most + 1):
            m = n - length + 1
            h = _mixed(h[:, :m], codes[:, length - 1:])
            piece[length, :, :m] = self.table.find(h, np.lib.stride_tricks.sliding_window_view(codes, length, axis=1))
            score[length, :, :m] = self.piece_scores[piece[length, :, :m]]
        missing = piece[1] == self.table.none
        n_bytes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        score[1][missing] = self.unknown * n_bytes[missing]
        alpha, back = np.full((w, n + 1), NO), np.zeros((w, n + 1), np.int64)
        beta = np.full((w, n + 1), NO)
        alpha[:, 0] = beta[:, n] = 0.0
        for end in range(1, n + 1):
            for length in range(1, min(end, most) + 1):
                through = alpha[:, end - length] + score[length, :, end - length]
                better = through > alpha[:, end]
                alpha[better, end] = through[better]
                back[better, end] = length
        for start in range(n - 1, -1, -1):
            for length in range(1, min(n - start, most) + 1):
                np.maximum(beta[:, start], beta[:, start + length] + score[length, :, start], out=beta[:, start])
        taken, at, rows = np.zeros((w, n), np.int64), np.full(w, n), np.arange(w)
        while len(rows):
            length = back[rows, at[rows]]
            at[rows] -= length
            taken[rows, at[rows]] = length
            rows = rows[at[rows] > 0]
        other = np.full(w, NO)
        for length in range(1, most + 1):
            m = n - length + 1
            through = alpha[:, :m] + score[length, :, :m] + beta[:, length:]
            through[taken[:, :m] == length] = NO
            np.maximum(other, through.max(axis=1), out=other)
        row, start = np.nonzero(taken)
        length = taken[row, start]
        number = piece[length, row, start]
        known = number != self.table.none
        size = np.where(known, 1, n_bytes[row, start])
        first = np.cumsum(size) - size
        ids = np.zeros(int(size.sum()), "<u4")
        ids[first[known]] = self.piece_ids[number[known]]
        strange = codes[row, start]
        for code in np.unique(strange[~known]):
            where = first[~known & (strange == code)]
            for k, b in enumerate(chr(code).encode()):
                ids[where + k] = self.byte[b]
        return alpha[:, n], alpha[:, n] - other, ids, np.bincount(row, size, minlength=w).astype(np.int64)

    def units(self, texts: list[str]) -> Units:
        """Best paths of different units."""
        out = Units(len(texts))
        by_length: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            by_length.setdefault(len(t), []).append(i)
        for length, at in by_length.items():
            if length > UNIT_CHARS:
                for i in at:
                    paths = self.search(texts[i])
                    cost = paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf
                    out.put(np.array([i]), np.array([paths[0][0]]), np.array([cost]), np.array(paths[0][1], "<u4"),
                            np.array([len(paths[0][1])]))
                continue
            rows = max(1, CELLS // (length * min(length, self.longest)))
            for a in range(0, len(at), rows):
                some = at[a:a + rows]
                out.put(np.array(some), *self.viterbi([texts[i] for i in some]))
        out.close()
        return out

    def split(self, text: str) -> list[str]:
        """Units of a text."""
        out, whole = [], META + text.replace(" ", META)  # a space before the text, spaces as meta spaces
        for word in [whole] if self.tied else WORD.findall(whole):
            if len(word) <= UNIT_CHARS and not self.tied:
                out.append(word)
                continue
            cuts = [0] + [k for k in range(1, len(word)) if word[k - 1:k + 1] not in self.spanned] + [len(word)]
            out += [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def departures(self, text: str, best: tuple[int, ...]) -> Paths:
        """The N best paths of a unit, the one that Viterbi took first."""
        paths = self.search(text)
        others = [p for p in paths if p[1] != best]
        return [(paths[0][0], best), *others[:self.n - 1]]

    def encode(self, texts: list[str]) -> list[tuple[list[float], list[bytes], int, bool]]:
        """Of each text the scores and ids (little-endian uint32) of the N best paths, the pieces of the best, and
        whether it decodes to the text."""
        number: dict[str, int] = {}
        split = [np.array([number.setdefault(u, len(number)) for u in self.split(t)], np.int64) if t else None for t in texts]
        names = list(number)
        units = self.units(names)
        searched: dict[int, Paths] = {}
        return [([0.0], [b""], 0, True) if at is None else self._one(t, at, names, units, searched)
                for t, at in zip(texts, split, strict=True)]

    def _one(self, text: str, at: np.ndarray, names: list[str], units: Units, searched: dict[int, Paths]) -> tuple:
        size, total = units.size[at], float(units.best[at].sum())
        ids = _gathered(units.ids, units.start[at], size)
        raw, end = ids.tobytes(), np.cumsum(size)
        cost = units.departure[at]
        k = min(self.n - 1, len(at))
        bound = np.partition(cost, k - 1)[k - 1] if k else -1.0
        near = np.flatnonzero(cost <= bound)
        near = near[np.argsort(cost[near], kind="stable")][:k]  # of equal ones the first in the text
        near = np.sort(near[np.isfinite(cost[near])])
        options = []
        for p in near:
            u = int(at[p])
            if u not in searched:
                a = units.start[u]
                searched[u] = self.departures(names[u], tuple(units.ids[a:a + units.size[u]].tolist()))
            options.append(searched[u])
        scores, paths = [], []
        for c, chosen in n_best_picks([[o[0][0] - q[0] for q in o[1:]] for o in options], self.n):
            parts, done = [], 0
            for where, pick in sorted(chosen):
                p = near[where]
                parts += [raw[done:4 * (end[p] - size[p])], np.array(options[where][pick][1], "<u4").tobytes()]
                done = 4 * end[p]
            paths.append(b"".join([*parts, raw[done:]]))
            scores.append(total - c)
        return scores, paths, len(ids), self.decode(ids)[1:] == text.encode()

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        return _gathered(self.id_bytes, self.id_start[ids], self.id_size[ids]).tobytes()


def n_best_picks(costs: list[list[float]], n: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """The n cheapest choices of one path per part: (cost, [(part, path)] where it isn't the
    part's best). ``costs``: of each part's other paths, over its best."""
    # a part's own costs rise, so the cheapest departures lie in the parts with the cheapest first ones
    firsts = [own[0] if own else np.inf for own in costs]
    parts = heapq.nsmallest(n - 1, range(len(costs)), key=firsts.__getitem__)
    single = heapq.nsmallest(n - 1, ((c, at, k) for at in parts for k, c in enumerate(costs[at], 1)))
    picks: list[tuple[float, list[tuple[int, int]]]] = [(0.0, [])]
    for c, at, k in single:
        picks += [(cost + c, [*chosen, (at, k)]) for cost, chosen in picks if all(at != a for a, _ in chosen)]
        picks = heapq.nsmallest(n, picks, key=lambda p: p[0])
    return picks


@cache
def lattice(path: str, n: int) -> Lattice:
    """One for each Python worker, kept over its tasks."""
    return Lattice(path, n)


def encode_nbest(docs: DataFrame, model_path: str, n: int = BEST, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, scores, ids, round_trip): the n best segmentations of every whole
    text, ids as little-endian uint32; ``round_trip`` tells whether the best, decoded, is the text."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path, n)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([len(t) + 64 for t in texts])
            begin = 0
            while begin < len(texts):
                done = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, side="right")))
                rows = model.encode(texts[begin:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([r[0] for r in rows], pa.list_(pa.float64())),
                     pa.array([r[1] for r in rows], pa.list_(pa.binary())),
                     pa.array([r[3] for r in rows], pa.bool_())],
                    names=["doc_id", "n_pieces", "scores", "ids", "round_trip"])
                begin = end

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        encode, "doc_id long, n_pieces long, scores array<double>, ids array<binary>, round_trip boolean")


def decode_ids(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from a column of little-endian uint32 ids."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path, BEST)
        for batch in batches:
            texts = [model.decode(np.frombuffer(b or b"", "<u4"))[1:].decode(errors="replace")
                     for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        decode, "doc_id long, text string")
