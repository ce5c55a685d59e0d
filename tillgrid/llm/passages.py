"""Substring dedup: passages of words that stand in an earlier document too."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.llm.common import saved, slices

#: Words of a window, and of the part of it that routes it to a shard.
WINDOW, ANCHOR = 13, 4
#: Share of all segments from which on an anchor is hot, so that there are at most
#: its inverse of them, and the part of the documents that is asked for hot ones.
#: A hot anchor also has so many segments in that part.
HOT_SHARE, HOT_ASKED, LEAST_HOT = 1 / 20_000, 1 / 64, 16
#: Segments from which on an anchor is hot at any size of the input, so that no shard key has more.
MOST_TOGETHER = 8_192
#: Words of a shard, and of a piece that is streamed against its index.
SHARD_WORDS, PIECE = 150_000, 2 * WINDOW - ANCHOR


class FmIndex:
    """Index of symbol sequences for backward search, in wavelet-tree form.

    Suffixes are sorted by their first ``depth`` symbols, which is all that
    searches of up to ``depth`` symbols need. The last column of the sorted rows is kept
    as a wavelet matrix: one bit per symbol and level, with counts per 64 bits. The order
    of the suffixes is forgotten but for their positions in 32 bits.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        """``symbols`` are positive; 0 separates sequences and ends the text."""
        n = len(symbols)
        rank, known = symbols.astype(np.int64), 1
        while known < depth:
            step = min(known, depth - known)
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:] + 1
            rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].reshape(-1)
            known += step
        self.rows = np.argsort(rank, kind="stable").astype(np.int32)
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        counts = np.bincount(symbols, minlength=(1 << self.levels) + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        column = symbols[self.rows - 1]
        self.words, self.sums, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (column >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            padded = np.zeros((n // 64 + 1) * 8, np.uint8)
            padded[: len(packed)] = packed
            words = padded.view(np.uint64)
            self.words.append(words)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.int64))
            self.zeros.append(n - int(bit.sum()))
            column = np.concatenate([column[bit == 0], column[bit == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[level][block] + np.bitwise_count(self.words[level][block] & mask)

    def occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the last column before each row."""
        start = np.zeros_like(at)
        for level in range(self.levels):
            bit = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            ones_start, ones_at = self._ones(level, start), self._ones(level, at)
            start = np.where(bit, self.zeros[level] + ones_start, start - ones_start)
            at = np.where(bit, self.zeros[level] + ones_at, at - ones_at)
        return at - start

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with each symbol and then with what the rows from ``low`` to ``high`` begin with."""
        before = self.occurrences(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.before[symbol] + before[: len(symbol)], self.before[symbol] + before[len(symbol):]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the rows that begin with each pattern, a row of symbols."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.rows), np.int64)
        for k in reversed(range(patterns.shape[1])):
            low, high = self.extended(patterns[:, k], low, high)
        return low, high


class Least:
    """Minimum of any range of ``values``, from minima of ranges of 1, 2, 4, ..."""

    def __init__(self, values: np.ndarray):
        minima = [values]
        while 1 << len(minima) <= len(values):
            half = 1 << (len(minima) - 1)
            minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
        self.flat = np.concatenate(minima)
        self.starts = np.cumsum([0, *map(len, minima)])[:-1]

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of the values from each ``low`` up to ``high``, which is greater."""
        step = np.frexp((high - low).astype(float))[1] - 1
        start = self.starts[step]
        return np.minimum(self.flat[start + low], self.flat[start + high - (1 << step)])


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and all words in order."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(full)])
    offsets = lists.offsets.to_numpy()
    counts = ends[offsets[1:] - offsets[0]] - ends[offsets[:-1] - offsets[0]]
    return counts, words.filter(pa.array(full))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _anchors(hot: np.ndarray):
    """Segments of windows with one anchor: (route, doc_id, place).

    The anchor of a window is the smallest hash of its four-word parts, so equal
    windows have equal anchors, and neighbours mostly share theirs. ``route`` is the
    anchor. Segments of hot anchors, in ``hot``, are shared for sure and need not
    meet; they are spread by document. ``place`` is the first word times 2^31 plus
    the number of windows; for hot anchors, -1 less that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            counts, words = _split(batch.column(1))
            ends = np.cumsum(counts)
            coded = words.dictionary_encode()
            hashes = np.fromiter(
                (xxhash.xxh64_intdigest(word) for word in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
            )[coded.indices.to_numpy()]
            if len(hashes) < WINDOW:
                continue
            parts = np.zeros(len(hashes) - ANCHOR + 1, np.uint64)
            for k in range(ANCHOR):
                parts = _mixed(parts * np.uint64(3) + hashes[k: k + len(parts)])
            anchors = _lowest(parts, WINDOW - ANCHOR + 1)
            doc = np.repeat(np.arange(len(counts)), counts)[: len(anchors)]
            position = np.arange(len(anchors))
            whole = position + WINDOW <= ends[doc]
            position, doc, anchors = position[whole], doc[whole], anchors[whole]
            if not len(position):
                continue
            new = np.ones(len(position), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            sizes = np.diff(np.concatenate([first, [len(position)]]))
            start = position[first] - (ends - counts)[doc[first]]
            own, doc = anchors[first], doc[first]
            ids = batch.column(0).to_numpy()[doc]
            sure = np.isin(own.view(np.int64), hot)
            route = np.where(sure, _mixed(own + ids.astype(np.uint64)), own)
            place = start.astype(np.int64) << 31 | sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(ids), pa.array(np.where(sure, -1 - place, place))],
                names=["route", "doc_id", "place"],
            )

    return run


def _window_hash(words: list[bytes], at: int) -> tuple[int, bytes]:
    window = b" ".join(words[at: at + WINDOW])
    return xxhash.xxh64_intdigest(window) - 2**63, window


def _hot_windows(words: list[bytes], found: list[dict] | None) -> Iterator[int]:
    """First words of the windows of hot anchors in ``found``."""
    for place in (-1 - one["place"] for one in found or () if one["place"] < 0):
        yield from range(place >> 31, min((place >> 31) + (place & 0x7FFFFFFF), len(words) - WINDOW + 1))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the segments in ``found`` but those of hot anchors, with their anchor for a shard.

    Gives (shard, doc_id, version, start, segment).
    """
    for batch in (part for whole in batches for part in slices(whole, 2)):
        rows: list[tuple] = []
        for doc_id, version, text, found in zip(*(column.to_pylist() for column in batch.columns[:4])):
            chosen = [one for one in found or () if one["place"] >= 0]
            words = text.encode().split() if chosen else []
            for one in chosen:
                start, n = one["place"] >> 31, one["place"] & 0x7FFFFFFF
                rows.append((one["route"], doc_id, version, start, b" ".join(words[start: start + n + WINDOW - 1])))
            if len(rows) >= 50_000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of hot anchors, each with its own hash for a shard and its smallest document so far.

    Gives (shard, doc_id, version, start, segment), version and start being 0.
    """
    for batch in (part for whole in batches for part in slices(whole, 2)):
        first: dict[tuple[int, bytes], int] = {}
        for doc_id, _, text, found in zip(*(column.to_pylist() for column in batch.columns[:4])):
            if found and any(one["place"] < 0 for one in found):
                words = text.encode().split()
                for at in _hot_windows(words, found):
                    window = _window_hash(words, at)
                    first[window] = min(first.get(window, doc_id), doc_id)
        if first:
            yield _batch([(shard, doc_id, 0, 0, window) for (shard, window), doc_id in first.items()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "doc_id", "version", "start", "segment"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays([*columns[:4], columns[4].cast(pa.string())], names=names)


def earlier_windows(
    index: FmIndex, least: Least, text: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of pieces of ``text`` that a row of the index with a value below ``own`` has.

    Gives (piece, first window, last window), windows by their first place in ``text``. A piece
    goes from ``start`` to ``end`` and has at most ``PIECE`` symbols, to which the index is sorted.

    All pieces are searched abreast. A search goes backward and widens a match as long as it
    occurs in a lower row. From the end of what is open it gives the longest match that
    ends there, and a match of ``WINDOW`` or more settles all windows in it. Where that one is too short, the
    first open window is searched: it fails at a place that no window over it can pass,
    so the next one starts after that.
    """
    lane = np.flatnonzero(end - start >= WINDOW)
    # Open windows are those from ``first`` to ``last``.
    first, last = start[lane], end[lane] - WINDOW
    at, narrow = end[lane] - 1, np.zeros(len(lane), bool)
    low, high = np.zeros(len(lane), np.int64), np.full(len(lane), len(text))
    found = []
    while len(lane):
        new_low, new_high = index.extended(text[at], low, high)
        held = new_low < new_high
        held[held] = least.between(new_low[held], new_high[held]) < own[lane[held]]
        goes_on = held & (at > first)
        # The leftmost place of the match, and with it the windows that are settled.
        reached = np.where(held, at, at + 1)
        whole = ~goes_on & np.where(narrow, held, reached <= last)
        found.append((lane[whole], reached[whole], np.where(narrow, first, last)[whole]))
        ends = ~goes_on
        first = np.where(ends & narrow, np.where(held, first + 1, at + 1), first)
        wide = ends & ~narrow
        last = np.where(wide, np.where(reached <= last, reached - 1, last - 1), last)
        narrow = np.where(ends, np.where(narrow, ~held, reached > last + 1), narrow)
        at = np.where(goes_on, at - 1, np.where(narrow, first, last) + WINDOW - 1)
        low, high = np.where(goes_on, new_low, 0), np.where(goes_on, new_high, len(text))
        stays = first <= last
        if not stays.all():
            lane, first, last, at, narrow, low, high = (x[stays] for x in (lane, first, last, at, narrow, low, high))
    return tuple(np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _matched(segments: pa.Array, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which windows of each row of ``segments`` an earlier document has.

    Gives the number of each row's segment among the different ones, the place of its
    first window, the number of its windows and, by place, a mark for the first document of the
    segment and one for its later ones. The index holds different segments once, for
    their first documents; they are streamed against it for the first and for the second one.
    """
    coded = segments.dictionary_encode()
    which, different = coded.indices.to_numpy(), coded.dictionary
    first = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(first, which, docs)
    later = np.full(len(different), np.iinfo(np.int64).max)
    after = docs > first[which]
    np.minimum.at(later, which[after], docs[after])
    counts, words = _split(different)
    symbols = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    # One separator after each segment.
    text = np.zeros(len(symbols) + len(counts), np.int64)
    text[np.arange(len(symbols)) + owner] = symbols
    begins = np.cumsum(counts + 1) - counts - 1
    index = FmIndex(text, PIECE)
    least = Least(np.repeat(first, counts + 1)[index.rows])
    # Pieces overlap so that each window is in one of them.
    windows = np.maximum(0, counts - WINDOW + 1)
    step = PIECE - WINDOW + 1
    pieces = -(-windows // step)
    of = np.repeat(np.arange(len(counts)), pieces)
    start = begins[of] + step * (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.minimum(start + PIECE, (begins + counts)[of])
    marks = []
    for own, asked in ((first, slice(None)), (later, later[of] != np.iinfo(np.int64).max)):
        _, a, b = earlier_windows(index, least, text, start[asked], end[asked], own[of[asked]])
        change = np.bincount(a, minlength=len(text) + 1) - np.bincount(b + 1, minlength=len(text) + 1)
        marks.append(np.cumsum(change)[:-1] > 0)
    return which, begins, windows, np.stack(marks)


def _by_shard(search):
    """``search`` on rows (shard, doc_id, version, start, segment), sorted by shard.

    Shard keys that follow each other share an index until it has enough words;
    a key is never torn apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while batch.num_rows:
                # About six bytes a word.
                sizes = pc.binary_length(batch["segment"]).to_numpy() // 6 + 2
                keys = batch["shard"].to_numpy()
                full = int(np.searchsorted(np.cumsum(sizes), SHARD_WORDS - size))
                later = np.flatnonzero(keys[full:] != keys[full]) if full < batch.num_rows else ()
                if not len(later):
                    held.append(batch)
                    size += int(sizes.sum())
                    break
                cut = full + int(later[0])
                yield from search(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()).to_batches()
                held, size, batch = [], 0, batch.slice(cut)
        if held:
            yield from search(pa.Table.from_batches(held).combine_chunks()).to_batches()

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """(doc_id, version, runs) of rows with windows that an earlier document has.

    ``runs`` has pairs: the first word of such a window, and how many follow each other.
    """
    docs, starts = table["doc_id"].to_numpy(), table["start"].to_numpy()
    which, begins, windows, marks = _matched(table["segment"].chunk(0), docs)
    first = np.full(len(begins), np.iinfo(np.int64).max)
    np.minimum.at(first, which, docs)
    later = (docs > first[which]).astype(np.int64)
    sizes = windows[which]
    row = np.repeat(np.arange(len(docs)), sizes)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    earlier = marks[later[row], begins[which[row]] + offset]
    row, offset = row[earlier], offset[earlier]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])[: len(row)])
    length = np.diff(np.concatenate([new, [len(row)]]))
    flat = np.stack([starts[row[new]] + offset[new], length], axis=1).reshape(-1)
    full, count = np.unique(row[new], return_counts=True)
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], 2 * np.cumsum(count)]).astype(np.int32)), pa.array(flat.astype(np.int32))
    )
    taken = table.select(["doc_id", "version"]).take(pa.array(full))
    return pa.table({"doc_id": taken["doc_id"], "version": taken["version"], "runs": lists}).combine_chunks()


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that stay, from (text, version, found, repeats).

    ``repeats`` has the runs of repeated windows of a version of the text, and the
    hashes of those windows of hot anchors that no earlier document has.
    """
    for batch in batches:
        words_of, removed_of, kept_of = [], [], []
        for text, version, found, repeats in zip(*(column.to_pylist() for column in batch.columns[:4])):
            words = (text or "").encode().split()
            runs = [at for one in repeats or () if one["version"] == version for at in one["runs"] or ()]
            new = {one["shard"] for one in repeats or () if one["shard"] is not None}
            hot = [at for at in _hot_windows(words, found) if _window_hash(words, at)[0] not in new]
            kept = words
            if runs or hot:
                pairs = np.array([*runs, *[x for at in hot for x in (at, 1)]]).reshape(-1, 2)
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, pairs[:, 0], 1)
                np.add.at(covered, pairs.sum(1) + WINDOW - 1, -1)
                keep = np.cumsum(covered)[: len(words)] == 0
                kept = [word for word, stays in zip(words, keep.tolist()) if stays]
            words_of.append(len(words))
            removed_of.append(len(words) - len(kept))
            kept_of.append(b" ".join(kept))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[4:], pa.array(words_of, pa.int64()), pa.array(removed_of, pa.int64()),
             pa.array(kept_of, pa.binary()).cast(pa.string())],
            names=[*batch.schema.names[4:], "n_words", "n_removed", "kept_text"],
        )


ANCHORS = "route long, doc_id long, place long"
REPEATS = "doc_id long, version int, runs array<int>"
SEGMENTS = "shard long, doc_id long, version int, start int, segment string"


def hot_anchors(texts: DataFrame) -> np.ndarray:
    """Anchors with at least ``HOT_SHARE`` of the segments, as far as a part of the documents shows.

    They only choose the way that segments go, as the sample of a range partitioning
    does; any choice gives the same result. By the share there are at most
    1 / ``HOT_SHARE``, which is what the driver gets and the tasks are given.
    """
    asked = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(round(1 / HOT_ASKED))) == 0)
    counts = saved(asked.mapInArrow(_anchors(np.zeros(0, np.int64)), ANCHORS).groupBy("route").count())
    least = max(LEAST_HOT, HOT_SHARE * (counts.agg(F.sum("count")).first()[0] or 0))
    return np.array([row["route"] for row in counts.where(F.col("count") >= least).collect()], np.int64)


def without_repeats(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs``, ``n_words``, ``n_removed`` and ``kept_text``.

    A word is removed if a window of 13 words over it also starts in a document
    with a smaller ``doc_id``; ``kept_text`` joins the others by one space. Windows
    are judged on what comes in.

    Windows go to shards by their anchor; those whose anchor stands in one
    document only can't repeat and stop there. The rest are gathered by document
    and their words cut out. Each shard has an FM-index of its different segments, each for its first
    document. Segments are streamed against it, and what backward search matches in
    an earlier document over 13 words or more is reported as an interval. Windows of hot
    anchors have keys of their own, and equal ones are
    merged before they move. All but the first document of such a window repeat
    it, so only that one is told; a passage in a third of all documents moves no
    row for each of them.

    Null texts have no words. Rows with a null ``doc_id`` neither lose words nor cost
    others theirs, nor do repeated rows each other.
    """
    names = [f"keep_{i}" for i in range(len(keep))]
    # The text moves once, also where it is kept.
    carried = {alias: docs[name] for name, alias in zip(keep, names) if name != "text"}
    texts = docs.select("doc_id", "text", *[column.alias(alias) for alias, column in carried.items()])
    whole = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    meeting = Window.partitionBy("route")
    found = (
        whole.mapInArrow(_anchors(hot_anchors(whole)), ANCHORS)
        .withColumns({
            "low": F.min("doc_id").over(meeting),
            "high": F.max("doc_id").over(meeting),
            "together": F.count("*").over(meeting),
        })
        .where("place < 0 or low < high")
        .withColumn("place", F.when(F.expr("place >= 0") & (F.col("together") > MOST_TOGETHER), -1 - F.col("place"))
                    .otherwise(F.col("place")))
    )
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("route", "place")).alias("found"))
    # Documents move once: all that follows reads this shuffle again.
    gathered = texts.join(by_doc, "doc_id", "left")
    told = gathered.select("doc_id", F.hash("text").alias("version"), "text", "found", *carried)
    direct = (
        told.mapInArrow(_segments, SEGMENTS)
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_by_shard(_repeats), REPEATS)
        .select("doc_id", F.struct("version", "runs", F.lit(None).cast("long").alias("shard")).alias("one"))
    )
    firsts = (
        told.mapInArrow(_windows, SEGMENTS)
        .groupBy("shard", "segment")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", F.struct(
            F.lit(None).cast("int").alias("version"), F.lit(None).cast("array<int>").alias("runs"), "shard"
        ).alias("one"))
    )
    repeats = direct.union(firsts).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("one").alias("_repeats"))
    joined = told.join(repeats, told["doc_id"] == F.col("_id"), "left")
    schema = T.StructType([
        *[T.StructField(alias, docs.schema[name].dataType) for name, alias in zip(keep, names)],
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ])
    kept = [F.col(alias if alias in carried else "text").alias(alias) for alias in names]
    made = joined.select("text", "version", "found", "_repeats", *kept).mapInArrow(_removal, schema)
    return made.select(
        *[F.col(alias).alias(name) for name, alias in zip(keep, names)], "n_words", "n_removed", "kept_text"
    )
