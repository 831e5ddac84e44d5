"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` consecutive words (a shorter item is
one window). A window is contained in a document where the document has the window's
words in a row; then the document's words at that place are hit.

1. A window is a set of placed shingles (``shingle`` words in a row). One pass over the documents
   keeps the places whose shingle is in a bit map of all benchmark shingles (of fixed size, so it
   may pass some too many, never too few), with the words around them.
2. The shingles are ordered by rarity: how often the documents have them. Containment has to be whole,
   so the necessary prefix of a window is its rarest shingle; a window with a shingle that no
   document has is out.
3. Places and prefixes are joined on the shingle. The place fixes where the window would begin, so a
   pair is bounded by position and by the document's length, and then the words of that item-sized
   window are compared one by one.

Words are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z
lower-cased. Shingles meet as 64-bit hashes; these choose candidates alone, results rest on the
words themselves.

Nothing of a document is shuffled but its number of words and the places that the bit map lets pass. A shingle or a
window that very many documents share is split over tasks (``salted_join``). The driver holds the bit map
(4 MB) and at most as many hot keys as there are shuffle partitions.

Defined results: a null, empty or wordless text has no words, is not hit and, as an item, has no
window; repeated document rows are judged each; items with one identifier count as one item, a
null identifier as the item ''; without documents the result is empty, without items nothing is hit (the
digest is that of the empty string); texts of any length are read whole; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.common import salted_join, written

WINDOW = 10
SHINGLE = 5
#: The bit map has 2 ** MAP_BITS bits; each shingle sets two.
MAP_BITS = 25
#: Bytes of a word that its hash reads, beside its length.
HASHED_BYTES = 24
#: Texts are worked on together up to so many bytes.
CHUNK_BYTES = 1 << 21
#: Kept places are stored with their surroundings in pieces of so many word places.
SPOT = 32

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_MIX = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_OF_BYTE = (_LOWER.astype(np.uint64) + np.uint64(1)) * _MIX[1]

ITEM_SCHEMA = "item_id string, words array<string>, h array<long>"
SPOTS = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string())),
                            ("pos", pa.list_(pa.int32())), ("h", pa.list_(pa.int64()))]))
SPOTS_SQL = "array<struct<start: int, words: array<string>, pos: array<int>, h: array<bigint>>>"


class Words:
    """The words of several texts that lie one after the other in ``data``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data = data
        mask = _IS_WORD[data]
        edges = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
        joints = np.unique(bounds[(bounds > 0) & (bounds < len(data))])
        joints = joints[mask[joints] & mask[joints - 1]]  # two texts that meet inside a run
        self.starts = np.sort(np.concatenate([edges[::2], joints]))
        self.ends = np.sort(np.concatenate([edges[1::2], joints]))
        self.first = np.searchsorted(self.starts, bounds)  # of each text, and of one beyond the last
        self.text = np.searchsorted(bounds, self.starts, side="right")

    def hashes(self) -> np.ndarray:
        length = self.ends - self.starts
        h = length.astype(np.uint64) * _MIX[0]
        at = np.arange(len(length))
        for j in range(min(HASHED_BYTES, int(length.max(initial=0)))):
            at = at[length[at] > j]
            h[at] = (h[at] ^ _OF_BYTE[self.data[self.starts[at] + j]]) * _MIX[0]
        return h ^ (h >> np.uint64(29))

    def shingles(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the shingles of ``width`` words that don't leave their text."""
        n = max(0, len(hashes) - width + 1)
        s = np.full(n, width, np.uint64)
        for j in range(width):
            s = (s ^ hashes[j:j + n]) * _MIX[1]
            s ^= s >> np.uint64(32)
        inside = np.flatnonzero(self.text[:n] == self.text[width - 1:width - 1 + n])
        return inside, s[inside]

    def slice(self, begin: int, end: int) -> list[str]:
        return [bytes(_LOWER[self.data[a:b]]).decode() for a, b in zip(self.starts[begin:end], self.ends[begin:end], strict=True)]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first, beyond, words) of runs of texts of about ``CHUNK_BYTES`` together (one text alone may be longer)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + CHUNK_BYTES, side="right")) - 1)
        yield begin, end, Words(data[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin])
        begin = end


def _window_rows(window: int, shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, w in _chunks(batch.column(1)):
                hashes, by_width = w.hashes(), {}
                for i, name in enumerate(batch.column(0).slice(begin, end - begin).to_pylist()):
                    a, b = w.first[i], w.first[i + 1]
                    length = min(window, b - a)
                    if not length:
                        continue
                    width = min(shingle, length)
                    if width not in by_width:
                        by_width[width] = np.zeros(len(hashes), np.int64)
                        at, h = w.shingles(hashes, width)
                        by_width[width][at] = h.view(np.int64)
                    words, h = w.slice(a, b), by_width[width][a:b - width + 1].tolist()
                    for p in range(0, b - a - length + 1, SPOT * SPOT):
                        starts = range(p, min(p + SPOT * SPOT, b - a - length + 1))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(starts), pa.string()),
                             pa.array([words[s:s + length] for s in starts], pa.list_(pa.string())),
                             pa.array([h[s:s + length - width + 1] for s in starts], pa.list_(pa.int64()))],
                            names=["item_id", "words", "h"])
    return rows


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Different windows (wid, words, h: the shingles by place) and their items (wid, item_id)."""
    rows = written(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                                F.col(text_col).alias("text"))
                   .mapInArrow(_window_rows(window, shingle), ITEM_SCHEMA), "item-windows")
    windows = written(rows.groupBy("words").agg(F.first("h").alias("h"))
                      .select(F.monotonically_increasing_id().alias("wid"), "words", "h"), "windows")
    members = salted_join(rows.select("item_id", "words"), windows.select("words", "wid"), "words", ["item_id"])
    return windows, written(members.select("wid", "item_id").distinct(), "window-items")


def bit_map(windows: DataFrame) -> np.ndarray:
    """The bit map of all shingles of the windows; at most 2 ** (MAP_BITS - 6) rows come to the driver."""
    bits = windows.select(F.explode("h").alias("h")).select(F.explode(F.array(
        F.expr(f"shiftrightunsigned(h, {64 - MAP_BITS})"),
        F.expr(f"shiftrightunsigned(h, {64 - 2 * MAP_BITS}) & {2 ** MAP_BITS - 1}"))).alias("b"))
    words = bits.groupBy(F.expr("shiftrightunsigned(b, 6)").alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("word")).toPandas()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[words["slot"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64)
    return out.view(np.uint64)


def _in_map(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes whose two bits are set."""
    def is_set(b: np.ndarray) -> np.ndarray:
        return (bits[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1)

    one = np.flatnonzero(is_set(h >> np.uint64(64 - MAP_BITS)))
    two = (h[one] >> np.uint64(64 - 2 * MAP_BITS)) & np.uint64(2 ** MAP_BITS - 1)
    return one[is_set(two).astype(bool)]


def _spots(w: Words, begin: int, end: int, at: np.ndarray, h: np.ndarray, window: int) -> list[dict]:
    """The kept places of the text with the words ``begin`` to ``end``, by pieces of ``SPOT`` places."""
    piece = (at - begin) // SPOT
    out = []
    for c in np.unique(piece):
        lo, hi = np.searchsorted(piece, [c, c + 1])
        start = max(0, int(c) * SPOT - window)
        stop = min(end - begin, (int(c) + 1) * SPOT + window)
        out.append({"start": start, "words": w.slice(begin + start, begin + stop),
                    "pos": (at[lo:hi] - begin).tolist(), "h": h[lo:hi].view(np.int64).tolist()})
    return out


def kept_places(docs: DataFrame, bits: np.ndarray, widths: list[int], id_col: str, text_col: str,
                window: int) -> DataFrame:
    """(row, doc_id, n_words, spots) of every document row: the places whose shingle is in the bit map."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for begin, end, w in _chunks(batch.column(2)):
                hashes = w.hashes()
                places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for width in widths:
                    at, h = w.shingles(hashes, width)
                    passed = _in_map(bits, h)
                    places.append(at[passed])
                    found.append(h[passed])
                at, h = np.concatenate(places), np.concatenate(found)
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                cut = np.searchsorted(at, w.first)
                spots = [_spots(w, w.first[i], w.first[i + 1], at[cut[i]:cut[i + 1]], h[cut[i]:cut[i + 1]], window)
                         if cut[i] < cut[i + 1] else [] for i in range(end - begin)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin),
                     pa.array(np.diff(w.first), pa.int64()), pa.array(spots, SPOTS)],
                    names=["row", "doc_id", "n_words", "spots"])

    id_type = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(scan, f"row long, doc_id {id_type}, n_words long, spots {SPOTS_SQL}")


def contained_windows(places: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, begin, end, wid): every occurrence of a window, ``end`` exclusive."""
    spot = places.select("row", "n_words", F.explode("spots").alias("s"))
    occurrence = spot.select("row", "n_words", "s.start", "s.words", F.explode(F.arrays_zip("s.pos", "s.h")).alias("o")).select(
        "row", "n_words", "start", "words", F.col("o.pos").alias("pos"), F.col("o.h").alias("h"))
    counts = written(spot.select(F.explode("s.h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")), "shingle-counts")
    rarest = (windows.select("wid", F.posexplode("h").alias("o", "h")).join(counts, "h", "left")
              .groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "o")).alias("r"))
              .where("r.n > 0"))
    prefix = written(windows.select("wid", F.col("words").alias("w")).join(rarest, "wid")
                     .select("wid", "w", F.col("r.h").alias("h"), F.col("r.o").alias("o")), "prefixes")
    wanted = occurrence.select("row", "h", "pos", "n_words", "start", "words")
    pairs = salted_join(wanted, prefix, "h", ["row", "pos"], sizes=counts)
    begin, length = F.col("pos") - F.col("o"), F.size("w")
    return (pairs.where((begin >= 0) & (begin + length <= F.col("n_words"))
                        & (F.slice("words", begin - F.col("start") + 1, length) == F.col("w")))
            .select("row", begin.alias("begin"), (begin + length).alias("end"), "wid"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows, members = item_windows(items, item_id_col, item_text_col, window, shingle)
    widths = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())
    places = written(kept_places(docs, bit_map(windows), widths, id_col, text_col, window), "places")
    found = written(contained_windows(places, windows), "contained")
    earlier = Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("row", "begin").agg(F.max("end").alias("end")).withColumn(
        "seen", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    hit = spans.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("begin", "seen"))).cast("long").alias("n_hit"))
    links = salted_join(written(found.select("row", "wid").distinct(), "links"), members, "wid", ["row"])
    named = links.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    of_items = named.select("row", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("digest"))
    return (places.select("row", "doc_id", "n_words").join(hit, "row", "left").join(of_items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))
