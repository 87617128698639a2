"""Substring dedup by recompression: equal windows of words get equal symbols, whatever surrounds them.

Every text is parsed in rounds. A round names maximal runs of one symbol (``RUN_ROUNDS``), then
names pairs of a left and a right symbol; a hash of the symbol alone decides its side. Names are
hashes of what they stand for, so they agree across the whole corpus without a name server.
A window of words keeps, per round, the symbols that its own words determine: at its left end a
right symbol is given up (it could pair with a word outside), at its right end a left one. The
last symbols that are left before none remains are its *core*, and core together with the symbols given up
spell the window: two windows are equal exactly if these are (names are 64 bits, the two halves
of a window's key together 128).

Spark rounds: (1) cores are shuffled by name, and a core that occurs once clears its windows;
(2) windows with a shared core are shuffled by their key, and those that are not the first of
their key are repeats. Within a block of texts equal cores and windows travel once, so a passage
that a third of all documents share does not gather in one task.

Defined results: null and empty texts have no windows. Rows that repeat an id are documents of
their own, see ``common.identified``. Extra columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import identified, keep
from .hashing import GOLDEN, U, mix, powers, word_chunks

WINDOW = 20
ROUNDS = 12
RUN_ROUNDS = (0, 5)

# One odd factor per step of the parse.
_ODD = np.random.default_rng(11).integers(1, 2**63, 2 * ROUNDS + 2, dtype=np.uint64) * U(2) + U(1)


class Windows:
    """The windows of a block of texts: where they start, their core's name, place and key."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, size: int, full: bool):
        rows = len(counts)
        ends = np.cumsum(counts)
        word = np.arange(len(hashes)) + np.repeat(np.arange(rows), counts)
        symbols = np.zeros(len(hashes) + rows, U)  # one 0 after each text
        symbols[word] = hashes
        per_row = np.maximum(counts - size + 1, 0)
        self.row = np.repeat(np.arange(rows), per_row)
        self.start = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        at = (ends - counts + np.arange(rows))[self.row] + self.start
        self.core, self.key, self.place = _cores(symbols, at.astype(np.int32), size, full)


def _cores(symbols: np.ndarray, at: np.ndarray, size: int, full: bool):
    core, key = np.zeros(len(at), U), np.zeros(len(at), U)
    place = np.zeros(len(at), np.int64)
    if not len(at):
        return core, key, place
    n = len(symbols)
    # per word boundary: the first symbol kept right of it, the end of those kept left of it
    left = np.arange(n + 1, dtype=np.int32)
    right = left
    gone_left = np.zeros(n + 1 if full else 0, U)
    gone_right = gone_left
    origin = left.astype(np.int64)
    inverse = U(pow(int(GOLDEN), -1, 1 << 64))
    unpower = np.concatenate([np.ones(1, U), np.cumprod(np.full(n, inverse, U))])
    power = powers(n)
    open_, ended = np.arange(len(at)), at + np.int32(size)
    begins_here = np.zeros(n - size + 1, bool)
    begins_here[at] = True
    stages = [(kind, t) for t in range(ROUNDS) for kind in ("run", "pair") if kind == "pair" or t in RUN_ROUNDS]
    for number, (kind, t) in enumerate([*stages, ("end", 0)]):
        m, salt = len(symbols), U(7919 * number + 13)
        if kind == "run":
            begins = np.ones(m, bool)
            begins[1:] = (symbols[1:] != symbols[:-1]) | (symbols[1:] == 0)
            starts = np.flatnonzero(begins).astype(np.int32)
            run = np.cumsum(begins, dtype=np.int32) - np.int32(1)
            stop = np.append(starts[1:], np.int32(m))
            first, last = np.minimum(left, m - 1), np.maximum(right - 1, 0)
            next_left = np.where(left < m, stop[run[first]], np.int32(m))
            next_right = np.where(right > 0, starts[run[last]], np.int32(0))
            drop_left = drop_right = None
        elif kind == "pair":
            # names are scattered already: the top bit of a product is a fresh bit in every round
            side, real = (symbols * _ODD[number]) >> U(63) == 1, symbols != 0
            is_left, is_right = side & real, ~side & real
            first, last = np.minimum(left, m - 1), np.maximum(right - 1, 0)
            drop_left, drop_right = is_right[first] & (left < m), is_left[last] & (right > 0)
            next_left, next_right = left + drop_left, right - drop_right
        if kind == "end":
            empty = begins_here
        else:
            empty = (next_left[: n - size + 1] >= next_right[size:]) & begins_here
        if empty.any():
            done = empty[at[open_]]
            w = open_[done]
            a, b = left[at[w]], right[ended[w]]
            sums = np.concatenate([np.zeros(1, U), np.cumsum(symbols * power[:m])])
            core[w] = mix((sums[b] - sums[a]) * unpower[a])
            place[w] = origin[a] * (size + 1) + (origin[b] - origin[a])
            if full:
                key[w] = mix(mix(gone_left[at[w]]) * GOLDEN + mix(gone_right[ended[w]] + U(1)))
            open_ = open_[~done]
            begins_here[at[w]] = False
        if kind == "end" or not len(open_):
            break
        if full:
            odd = _ODD[number]
            lost_left = gone_left * GOLDEN + (symbols[first] + (next_left - left).astype(U) * GOLDEN) * odd
            lost_right = gone_right * GOLDEN + (symbols[last] + (right - next_right).astype(U) * GOLDEN) * odd
            gone_left = lost_left if drop_left is None else np.where(drop_left, lost_left, gone_left)
            gone_right = lost_right if drop_right is None else np.where(drop_right, lost_right, gone_right)
        if kind == "run":
            length = np.diff(np.append(starts, np.int32(m)))
            symbols, long = symbols[starts], length > 1
            symbols[long] = _name(symbols[long], length[long].astype(U), salt)
            index, kept = np.append(run, np.int32(len(starts))), starts
        else:
            pair = np.zeros(m, bool)
            pair[:-1] = is_left[:-1] & is_right[1:]
            head = np.ones(m, bool)
            head[1:] = ~pair[:-1]
            kept = np.flatnonzero(head)
            paired = pair[kept]
            named = symbols[kept]
            named[paired] = _name(named[paired], symbols[kept[paired] + 1], salt)
            symbols = named
            index = np.append(np.cumsum(head, dtype=np.int32) - np.int32(1), np.int32(len(kept)))
        origin = np.append(origin[kept], n)
        left, right = index[next_left], index[next_right]
    return core, key, place


def _name(a: np.ndarray, b: np.ndarray, salt: np.uint64) -> np.ndarray:
    named = mix(mix(a * GOLDEN + salt) + b)
    named[named == 0] = 1
    return named


def _runs(windows: Windows) -> np.ndarray:
    """Where a new core begins: windows in a row over the same symbols share one."""
    new = np.ones(len(windows.row), bool)
    for change in (windows.place, windows.core, windows.row):
        new[1:] &= change[1:] == change[:-1]
    new[1:] = ~new[1:]
    return new


def _ordinal(new: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The number of each window's core within its text."""
    run = np.cumsum(new) - 1
    first = np.searchsorted(row, row, "left")
    return run - run[first]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == U else values.astype(np.int64))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def shared_cores(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, cores): for texts with cores that occur more than once, the numbers of those cores."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, hashes, counts in word_chunks(batch.column(1)):
                w = Windows(hashes, counts, window, full=False)
                new = _runs(w)
                number, row, core = _ordinal(new, w.row)[new], w.row[new], w.core[new]
                if not len(core):
                    continue
                _, at, inverse, times = np.unique(core, return_index=True, return_inverse=True, return_counts=True)
                again = np.ones(len(core), bool)
                again[at] = False
                # later ones of a block are known to be shared: they need not meet the others
                core[again] = mix(core[again] + np.flatnonzero(again).astype(U) + rid[first + row[again]].astype(U))
                flag = (times[inverse] > 1).astype(np.int64)
                yield _batch(core=_longs(core), rid=_longs(rid[first + row]), tag=_longs(number * 2 + flag))

    cores = docs.select("rid", "text").mapInArrow(emit, "core long, rid long, tag long")
    counted = cores.withColumn("n", F.count("*").over(Window.partitionBy("core")))
    shared = counted.where((F.col("n") > 1) | (F.col("tag") % 2 == 1))
    return shared.groupBy("rid").agg(F.collect_list(F.shiftright("tag", 1).cast("int")).alias("cores"))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, starts): the starts of windows whose words also start earlier, for texts that have any.

    ``docs`` has rid, packed (see ``packed_texts``) and the cores of ``shared_cores``.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            cores = batch.column(2)
            for first, last, hashes, counts in _packed_chunks(batch.column(1)):
                w = Windows(hashes, counts, window, full=True)
                number = _ordinal(_runs(w), w.row)
                listed = cores.slice(first, last - first)
                owner = np.repeat(np.arange(last - first), listed.value_lengths().to_numpy(zero_copy_only=False))
                stride = int(number.max(initial=0)) + 1
                wanted = owner * stride + listed.flatten().to_numpy(zero_copy_only=False)
                take = np.flatnonzero(np.isin(w.row * stride + number, wanted))
                if not len(take):
                    continue
                doc, start, core, key = rid[first + w.row[take]], w.start[take], w.core[take], w.key[take]
                order = np.lexsort((start, doc, key, core))
                same = (core[order][1:] == core[order][:-1]) & (key[order][1:] == key[order][:-1])
                again = np.zeros(len(take), bool)
                again[order[1:][same]] = True
                salt = np.flatnonzero(again).astype(U) + doc[again].astype(U)
                core[again], key[again] = mix(core[again] + salt), mix(key[again] + start[again].astype(U))
                yield _batch(core=_longs(core), key=_longs(key), rid=_longs(doc), tag=_longs(start * 2 + again))

    rows = docs.select("rid", "packed", "cores").mapInArrow(emit, "core long, key long, rid long, tag long")
    place = F.struct("rid", "tag")
    first = rows.withColumn("first", F.min(place).over(Window.partitionBy("core", "key")))
    later = first.where((F.col("tag") % 2 == 1) | (F.col("first") < place))
    return later.groupBy("rid").agg(F.collect_list(F.shiftright("tag", 1).cast("int")).alias("starts"))


def _mark(count: int, starts, window: int) -> np.ndarray:
    """Which words lie in a window of the given starts."""
    change = np.zeros(count + 1, np.int32)
    starts = np.asarray(starts, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:count]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, whole_sha256): each text without the words of repeated windows.

    ``kept`` holds the words left, joined by one space; it is null where nothing goes, and
    ``whole_sha256`` is the digest of all words, joined likewise. A text whose words all stand in a row in
    an earlier document is such a copy, found by the digest of its words; it loses every word if it has a
    window at all, and its windows need not be compared one by one.
    """
    docs = identified(docs)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column(2):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                found.append(hashlib.sha256(b" ".join(words)).digest())
            yield _batch(
                rid=batch.column(0),
                doc_id=batch.column(1),
                n_words=pa.array(counts, pa.int64()),
                digest=pa.array(found, pa.binary()),
            )

    whole = docs.mapInArrow(digests, "rid long, doc_id long, n_words long, digest binary")
    whole = keep(whole, "digests")
    firsts = whole.where(F.col("n_words") >= window).groupBy("digest").agg(F.min("rid").alias("first"), F.count("*").alias("n"))
    copies = whole.join(firsts.where("n > 1"), "digest").where("rid > first").select("rid")
    copies = keep(copies, "copies")
    cores = keep(shared_cores(docs, window), "cores").join(copies, "rid", "left_anti")
    packed = packed_texts(docs)
    starts = keep(repeated_windows(packed.join(cores, "rid"), window), "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for packed_text, starts in zip(batch.column(1), batch.column(2)):
                words = _plain(packed_text.as_py()).split()
                gone = _mark(len(words), starts.values.to_numpy(zero_copy_only=False), window)
                removed.append(int(gone.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]).decode())
            yield _batch(rid=batch.column(0), n_removed=pa.array(removed, pa.int64()), kept=pa.array(kept, pa.string()))

    cut_texts = packed.join(starts, "rid").mapInArrow(cut, "rid long, n_removed long, kept string")
    copied = copies.select("rid", F.lit(True).alias("copy"))
    return (
        whole.join(cut_texts, "rid", "left")
        .join(copied, "rid", "left")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
            F.lower(F.hex("digest")).alias("whole_sha256"),
        )
    )


def _plain(packed: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed)


def packed_texts(docs: DataFrame) -> DataFrame:
    """(rid, packed): texts compressed before they are shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tool = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for batch in batches:
            data = [tool.compress((text.as_py() or "").encode()) for text in batch.column(1)]
            yield _batch(rid=batch.column(0), packed=pa.array(data, pa.binary()))

    return docs.select("rid", "text").mapInArrow(pack, "rid long, packed binary")


def _packed_chunks(column: pa.Array, rows: int = 500) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``word_chunks`` of packed texts, unpacked some rows at a time."""
    for at in range(0, len(column), rows):
        texts = [_plain(x.as_py()) for x in column.slice(at, rows)]
        for first, last, hashes, counts in word_chunks(pa.array(texts, pa.binary()).cast(pa.string())):
            yield at + first, at + last, hashes, counts
