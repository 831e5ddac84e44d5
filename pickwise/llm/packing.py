"""Documents as token sequences, packed by bounded-space best fit.

``token_pieces`` encodes every document inside the tasks that read it and cuts
only those longer than a sequence. Packing then sees lengths alone. Pieces are
dealt at random to packers of bounded size; each packer takes its pieces one by
one, puts each into the open bin with the least room that still
holds it, and never moves it again. Open bins are found through a bitset keyed by free
space; at most ``open_bins`` are open, and the fullest is closed first. This is the online method; a packer's
pieces are sorted first, longest before shorter, which is a step added to it (it needs fewer sequences).

Defined results: null or empty text is the end token alone; rows with a null or a
repeated identifier are packed as they are, one document each; an empty table
gives an empty result; other columns are ignored."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import written

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 1024
#: One packer gets about this many full sequences, and about this many pieces at most.
SEQUENCES_PER_PACKER = 2048
PIECES_PER_PACKER = 200_000
#: Characters of the texts that are encoded together (one text alone may be longer).
CHUNK_CHARS = 1 << 22
#: A word that is encoded here: printable ASCII and Latin letters beyond it. Others go to the library.
PLAIN = re.compile(r"[\x21-\x7E\xC0-\xFF]{1,64}\Z")
#: The tokenizer file's pattern (a fixed value) over lower-cased plain words.
TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Merges:
    """The merge rules of a tokenizer file, over many words at a time.

    Words of one length are a matrix of symbols. Every round merges in each row the leftmost pair of the lowest
    rank; rows without such a pair are done. So all rows left have one length, a symbol less after each round."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # a byte's printable stand-in, as byte-level tokenizers have it
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        sign = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
        end = model["end_of_word_suffix"] or ""
        self.first = np.array([vocab.get(sign[b], 0) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(sign[b] + end, 0) for b in range(256)], np.int64)
        self.none = len(merges)
        self.keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges] + [-1], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.levels, left = [], np.arange(len(merges))
        while len(left):
            multiplier = np.uint64(0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1E * len(self.levels) & 0xFFFFFFFFFFFFFFFF | 1)
            table = np.full(1 << 18, self.none, np.int64)
            slot = self._slot(self.keys[left], multiplier)
            table[slot] = left
            self.levels.append((multiplier, table))
            left = left[table[slot] != left]

    @staticmethod
    def _slot(keys: np.ndarray, multiplier: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * multiplier) >> np.uint64(46)).view(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``none`` where no rule merges it."""
        keys = a << 32 | b
        out = np.full(keys.shape, self.none)
        for multiplier, table in self.levels:
            found = table[self._slot(keys, multiplier)]
            np.copyto(out, found, where=self.keys[found] == keys)
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of each of the words."""
        out = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for length, at_words in by_length.items():
            group = [words[k] for k in at_words]
            raw = np.frombuffer(b"".join(group), np.uint8).reshape(-1, length)
            symbols = self.first[raw]
            symbols[:, -1] = self.last[raw[:, -1]]
            names, rank = np.array(at_words), self.ranks(symbols[:, :-1], symbols[:, 1:])
            while len(names):
                width = symbols.shape[1]
                at = rank.argmin(axis=1) if width > 1 else np.zeros(len(names), np.int64)
                rows = np.arange(len(names))
                best = rank[rows, at] if width > 1 else np.full(len(names), self.none)
                done = best == self.none
                ids = symbols[done].astype("<u4").tobytes()
                for k, n in enumerate(names[done].tolist()):
                    out[n] = ids[4 * width * k:4 * width * (k + 1)]
                names, symbols, rank, at, best = names[~done], symbols[~done], rank[~done], at[~done], best[~done]
                if not len(names):
                    break
                rows, places = np.arange(len(names)), np.arange(width - 1)
                symbols[rows, at] = self.made[best]
                symbols = np.take_along_axis(symbols, places + (places > at[:, None]), axis=1)
                places = places[:-1]
                rank = np.take_along_axis(rank, places + (places >= at[:, None]), axis=1)
                for moved in (at - 1, at):  # the pairs that the new symbol is part of
                    some = (moved >= 0) & (moved < width - 2)
                    r, p = rows[some], moved[some]
                    rank[r, p] = self.ranks(symbols[r, p], symbols[r, p + 1])
        return out


class WordEncoder:
    """Token ids of texts as little-endian bytes, equal to the tokenizer library's.

    The tokenizer's pattern never lets a token span white space, nor does its
    normalisation look across it, so a text's ids are its words' ids in a row. The different words of some texts are
    encoded once: plain ones are cut by the pattern and merged by ``Merges``; all others (and words with the
    beginning of a special token) go to the library. Nothing is remembered between calls: a table of very many words costs
    more to look up than their ids cost to find again."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Merges(path)

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        tokens: dict[bytes, int] = {}
        parts: list[int | list[int] | None] = []
        for w in words:
            if w.isalpha() and len(w) <= 64:  # ASCII letters only: one token to merge
                parts.append(tokens.setdefault(w.lower(), len(tokens)))
                continue
            text = w.decode()
            plain = PLAIN.match(text) and "<|" not in text
            parts.append([tokens.setdefault(t.encode(), len(tokens)) for t in TOKENS.findall(text.lower())] if plain else None)
        ids = self.merges.encode(list(tokens))
        others = [w.decode() for w, p in zip(words, parts, strict=True) if p is None]
        found = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        return [ids[p] if type(p) is int else np.array(next(found).ids, "<u4").tobytes() if p is None
                else b"".join([ids[k] for k in p]) for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        number: dict[bytes, int] = {}
        split = [[number.setdefault(w, len(number)) for w in t.encode().split()] for t in texts]
        ids = self.words(list(number))
        size = np.array([len(b) // 4 for b in ids], np.int64)
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(ids), "<u4")
        at = np.array([k for words in split for k in words], np.int64)
        taken = size[at]
        ends = np.cumsum(taken)
        places = np.repeat(start[at] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)
        whole = flat[places].tobytes()
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])].tolist()
        return [whole[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])]


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each tokenizer file and Python worker, kept over its tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
    return WordEncoder(path)


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and the end
    id, cut after each ``sequence`` ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        for batch in batches:
            all_texts = [t or "" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([len(t) + 64 for t in all_texts])
            begin = 0
            while begin < len(all_texts):
                done = ends[begin - 1] if begin else 0
                beyond = max(begin + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, side="right")))
                keys, texts = batch.column(0).slice(begin, beyond - begin).to_pylist(), all_texts[begin:beyond]
                begin = beyond
                rows = []
                for key, ids in zip(keys, encoder.encode(texts), strict=True):
                    ids += end
                    for n, b in enumerate(range(0, len(ids), 4 * sequence)):
                        part = ids[b:b + 4 * sequence]
                        rows.append((key, n, n * sequence, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: Iterable[int], sequence: int = SEQUENCE,
             open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the order given."""
    bins, offsets = [], []
    by_room: list[list[int]] = [[] for _ in range(sequence + 1)]
    rooms, n_open, n_bins = 0, 0, 0  # bit r of rooms: some open bin has r free
    for length in lengths:
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            n_open -= 1
        else:
            at, room, n_bins = n_bins, sequence, n_bins + 1
        bins.append(at)
        offsets.append(sequence - room)
        if left := room - length:
            if n_open == open_bins:
                fullest = (rooms & -rooms).bit_length() - 1
                if left <= fullest:
                    continue  # this bin is the fullest itself
                by_room[fullest].pop()
                n_open -= 1
                if not by_room[fullest]:
                    rooms ^= 1 << fullest
            by_room[left].append(at)
            rooms |= 1 << left
            n_open += 1
    return bins, offsets


def pack(pieces: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
         sequences_per_packer: int = SEQUENCES_PER_PACKER, pieces_per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """``pieces`` (``PIECE_SCHEMA``) with (sequence_id, offset)."""
    fixed = written(pieces.withColumn("pos", F.monotonically_increasing_id()), "pieces")
    n, tokens = fixed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    packers = max(1, -(-tokens // (sequence * sequences_per_packer)), -(-n // pieces_per_packer))

    def fill(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "pos"], ascending=[False, True], kind="stable")
        bins, offsets = best_fit(group["length"].tolist(), sequence, open_bins)
        return group.drop(columns=["packer", "pos"]).assign(
            sequence_id=np.array(bins, "int64") + (int(key[0]) << 32), offset=np.array(offsets, "int64"))

    return (fixed.withColumn("packer", F.pmod(F.xxhash64("pos"), F.lit(packers)))
            .groupBy("packer").applyInPandas(fill, PIECE_SCHEMA + ", sequence_id long, offset long"))
