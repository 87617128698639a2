"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often over a corpus.

Each text, with a space in front, is encoded by a byte-level BPE (A) and by a SentencePiece model with byte fallback (B), which adds the space
itself. Where tokens of both end at the same byte the text is cut into groups; an A and a B token whose bytes overlap are linked.

How many documents hold a pair of ids linked is counted by external spills. Each task collects the pair-document
records of its documents up to ``RUN_LINKS`` links, sorts them A id first, and spills the run in one zstd segment per
radix of the A id: the distinct pairs with their document counts, and the documents of each pair with their numbers of links. The segments are
rows of a kept table, so what a lost executor has spilled stays, and a repeated task leaves no second copy. Per
radix a k-way heap merge over the distinct pairs of the runs, ``FAN`` at a time, adds up the counts; all pairs of an A id lie next to each other,
so their maximum is known when the next id begins. The totals of a radix then meet the spilled segments again, and each segment
streams its contributions back to its documents.

A merge holds the distinct pairs of one radix, which the vocabularies bound; answers go back to a run, one for each of its distinct pairs, and
documents pass only through their own run.
A pair that every document holds is one entry per run, however many documents there are.

Both tokenizers split in front of a space that has other characters on both sides, so texts are cut there and the
alignment of such a unit is looked up; a mark at its end is looked up by itself. Whether the vocabularies allow it is tested once, else whole
texts are encoded.

Defined results: null and empty texts, and texts whose tokens do not spell their bytes, have zeros and an empty string. Rows that repeat an id are
documents of their own, each counted. An empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep
from .hashing import text_bytes

#: Links and documents of a run; a text that has more links is a run of its own.
RUN_LINKS = 1 << 22
_DOC_BITS = 22
#: Runs that a merge has open at a time.
FAN = 64
#: Units whose alignment a task remembers, and the longest that it remembers, in characters.
REMEMBERED, LONGEST = 500_000, 64
#: Bytes of text whose units are looked up together.
SLICE_BYTES = 2_000_000

#: Marks that may be looked up by themselves behind a letter.
_MARKS = ",.;:!?"
#: Units that tokenizer A encodes in one text.
TOGETHER = 64

_CUT = re.compile(r" (?<=\S )(?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 is itself, other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Alignments of units of text; ``radices`` deals the pairs out by A id."""

    def __init__(self, a_path: str, b_path: str, radices: int):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte, size_a = byte_alphabet(), self.a.get_vocab_size()
        names = [self.a.id_to_token(k) or "" for k in range(size_a)]
        self.bytes_a = [bytes(byte[c] for c in n) if all(c in byte for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]
        # A ids of one radix follow each other, so runs sorted by pair are sorted by radix
        width = -(-size_a // radices)
        self.place = [k % radices * width + k // radices for k in range(size_a)]
        self.size_b, self.span = len(pieces), width * len(pieces)
        self.names_a, self.names_b = [str(k) for k in range(size_a)], [str(k) for k in range(len(pieces))]
        self.known: dict[str, tuple | None] = {}
        self.cuts = self._allows_cuts(pieces)
        self.marks = self._split_marks(pieces) if self.cuts else {}
        first, gap, second = (self.a.encode(t, add_special_tokens=False).ids for t in (" a", "\n", " b"))
        both = self.a.encode(" a\n b", add_special_tokens=False).ids
        self.gap = gap[0] if self.cuts and len(gap) == 1 and both == first + gap + second else None

    @classmethod
    def of(cls, a_path: str, b_path: str, radices: int) -> Aligner:
        """The aligner of this Python worker, which outlives a task."""
        import sentencepiece

        kept = sentencepiece.__dict__.setdefault("_starweave_aligners", {})
        key = (a_path, b_path, radices)
        if key not in kept:
            kept.clear()
            kept[key] = cls(*key)
        return kept[key]

    def _allows_cuts(self, pieces: list[str]) -> bool:
        """Neither tokenizer ever joins what stands before a space between two other characters with what follows it."""
        setup = json.loads(self.a.to_str())
        splits = setup.get("pre_tokenizer") or {}
        level = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
        joined = any("▁" in p.lstrip("▁") for p in pieces)
        probe = "  a  ﬁ ① é b  "
        same = b"".join(self.bytes_b[k] for k in self.b.encode(probe)) == b" " + probe.encode()
        return bool(level) and setup.get("normalizer") is None and not joined and same

    def units(self, text: str) -> list[str]:
        """The units of ``text``, each without the space in front of it."""
        return _CUT.split(text) if self.cuts else [text]

    def _split_marks(self, pieces: list[str]) -> dict[str, tuple]:
        """The alignment of each mark that B, as A, never joins with a letter before it."""
        joined = {two for p in pieces for one, two in zip(p, p[1:]) if one.isalpha()}
        found, before = {}, self.b.encode("a")
        for mark in set(_MARKS) - joined:
            a, b = self.a.encode(mark, add_special_tokens=False).ids, self.b.encode("a" + mark)
            made = self.align(a, b[len(before) :], mark.encode()) if b[: len(before)] == before else None
            if made is not None:
                found[mark] = made
        return found

    def learn(self, asked: set[str]) -> None:
        """Get to know units; one that ends in a mark behind a letter is put together from both."""
        known, marks = self.known, self.marks
        new = asked.difference(known)
        marked = [u for u in new if u[-1:] in marks and u[-2:-1].isalpha()]
        bare = list(new.difference(marked).union([u[:-1] for u in marked]).difference(known))
        for at in range(0, len(bare), 4096):
            some = bare[at : at + 4096]
            for unit, a, b in zip(some, self._encode_a(some), self.b.encode(some, num_threads=1)):
                known[unit] = self.align(a, b, b" " + unit.encode())
        for unit in marked:
            word, mark = known[unit[:-1]], marks[unit[-1]]
            known[unit] = word and (word[0] + mark[0], word[1] + mark[1], word[2] + mark[2], word[3] + mark[3], f"{word[4]};{mark[4]}")

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        """A's ids of each unit behind a space.

        Units without white space are encoded together with line breaks between them, which become a token of their own
        each; where the count of those is not as it should be, one by one.
        """
        found: dict[str, list[int]] = {}
        if self.gap is not None:
            plain = [u for u in units if u.split(None, 1) == [u]]
            runs = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
            texts = [" " + "\n ".join(run) for run in runs]
            for run, made in zip(runs, self.a.encode_batch_fast(texts, add_special_tokens=False)):
                ids = made.ids
                cuts = [k for k, token in enumerate(ids) if token == self.gap]
                if len(cuts) == len(run) - 1:
                    found.update((u, ids[a + 1 : b]) for u, a, b in zip(run, [-1, *cuts], [*cuts, len(ids)]))
        rest = [u for u in units if u not in found]
        made = self.a.encode_batch_fast([" " + u for u in rest], add_special_tokens=False)
        found.update((u, e.ids) for u, e in zip(rest, made))
        return [found[u] for u in units]

    def align(self, a: list[int], b: list[int], data: bytes) -> tuple | None:
        """(n_a, n_b, n_groups, pairs, groups) of two encodings of ``data``, or None if one does not spell it."""
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[k] for k in a]) != data or b"".join([bytes_b[k] for k in b]) != data:
            return None
        place, size_b = self.place, self.size_b
        names_a, names_b = [self.names_a[k] for k in a], [self.names_b[k] for k in b]
        if len(a) == 1 or len(b) == 1:
            pairs = array("q", [place[k] * size_b + m for k in a for m in b])
            return len(a), len(b), 1, pairs.tobytes(), ",".join(names_a) + "|" + ",".join(names_b)
        pairs, groups = array("q"), []
        i = j = first_a = first_b = 0
        end_a, end_b = len(bytes_a[a[0]]), len(bytes_b[b[0]])
        while True:
            pairs.append(place[a[i]] * size_b + b[j])
            # the token that ends first makes room for the next one of its side
            if end_a < end_b:
                i += 1
                end_a += len(bytes_a[a[i]])
            elif end_b < end_a:
                j += 1
                end_b += len(bytes_b[b[j]])
            else:
                i, j = i + 1, j + 1
                groups.append(",".join(names_a[first_a:i]) + "|" + ",".join(names_b[first_b:j]))
                if i == len(a):
                    return len(a), len(b), len(groups), pairs.tobytes(), ";".join(groups)
                first_a, first_b = i, j
                end_a, end_b = end_a + len(bytes_a[a[i]]), end_b + len(bytes_b[b[j]])

    def forget(self, asked: set[str]) -> None:
        for unit in [u for u in asked if len(u) > LONGEST]:
            del self.known[unit]
        if len(self.known) > REMEMBERED:
            self.known.clear()


_DOC = "doc_id long, local int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_SEGMENT = "radix int, codes binary, holders binary, docs binary, links binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in f"run long, {_DOC}, {_SEGMENT}".split(", ")])


def pack(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.diff(sorted_numbers, prepend=sorted_numbers[:1] * 0).astype("<i8")


def segments(run: int, codes: np.ndarray, docs: np.ndarray, span: int) -> list[dict]:
    """The sorted run of links (``codes``, ``docs``), one row per radix."""
    if not len(codes):
        return []
    keys = codes << _DOC_BITS | docs
    keys.sort()
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    links = np.diff(starts, append=len(keys))
    codes, docs = keys[starts] >> _DOC_BITS, keys[starts] & ((1 << _DOC_BITS) - 1)
    heads = np.flatnonzero(np.diff(codes, prepend=-1))
    holders = np.diff(heads, append=len(codes))
    radix = codes[heads] // span
    out = []
    for k in np.unique(radix).tolist():
        lo, hi = np.searchsorted(radix, [k, k + 1])
        first, last = heads[lo], heads[hi] if hi < len(heads) else len(codes)
        out.append(
            {
                "run": run,
                "radix": k,
                "codes": pack(_steps(codes[heads[lo:hi]])),
                "holders": pack(holders[lo:hi].astype("<u4")),
                "docs": pack(docs[first:last].astype("<u4")),
                "links": pack(links[first:last].astype("<u4")),
            }
        )
    return out


def spilled(docs: DataFrame, a_path: str, b_path: str, radices: int, run_links: int = RUN_LINKS) -> DataFrame:
    """Rows of documents (``radix`` null) and of run segments; both name the run."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner.of(a_path, b_path, radices)
        run = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        total = 0

        def spill() -> pa.RecordBatch:
            docs = np.repeat(np.arange(len(held), dtype=np.int64), [len(x) for x in held])
            rows = segments(run, np.concatenate(held), docs, aligner.span)
            return pa.RecordBatch.from_pylist(rows, _SCHEMA)

        for batch in batches:
            bounds, first = text_bytes(batch.column(1))[1], 0
            while first < batch.num_rows:
                last = int(np.searchsorted(bounds, bounds[first] + SLICE_BYTES, "right")) - 1
                last = min(batch.num_rows, max(last, first + 1))
                ids, texts = (batch.column(k).slice(first, last - first).to_pylist() for k in (0, 1))
                first = last
                split = [aligner.units(text) if text else [] for text in texts]
                asked = set().union(*split)
                aligner.learn(asked)
                rows = []
                for doc, units in zip(ids, split):
                    found = list(map(aligner.known.__getitem__, units))
                    good = bool(found) and None not in found
                    own = np.zeros(0, np.int64)
                    row = {"doc_id": doc, "n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": ""}
                    if good:
                        n_a, n_b, n_groups, pairs, groups = zip(*found)
                        own = np.frombuffer(b"".join(pairs), np.int64)
                        row |= {"n_a": sum(n_a), "n_b": sum(n_b), "n_groups": sum(n_groups)}
                        row["groups_sha256"] = hashlib.sha256(";".join(groups).encode()).hexdigest()
                    if held and (total + len(own) > run_links or len(held) >> _DOC_BITS):
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        yield spill()
                        rows, held, total, run = [], [], 0, run + 1
                    rows.append(row | {"run": run, "local": len(held), "n_links": len(own)})
                    held.append(own)
                    total += len(own)
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                aligner.forget(asked)
        if held:
            yield spill()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(emit, f"run long, {_DOC}, {_SEGMENT}")


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of sorted ``runs`` (codes, counts) and the sums of their counts, by a k-way heap merge."""
    codes, counts = array("q"), array("q")
    last = None
    for code, count in heapq.merge(*(zip(c.tolist(), n.tolist()) for c, n in runs)):
        if code == last:
            counts[-1] += count
        else:
            codes.append(code)
            counts.append(count)
            last = code
    return np.array(codes, np.int64), np.array(counts, np.int64)


def totals(segments: DataFrame, radices: int, size_b: int, fan: int = FAN) -> DataFrame:
    """(radix, codes, counts, best): each pair's number of documents over all runs, and whether no pair of its A id has more."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, waiting = None, None, []

        def closed() -> pa.RecordBatch:
            codes, counts = heap_merged([*([done] if done else []), *waiting])
            heads = np.flatnonzero(np.diff(codes // size_b, prepend=-1))
            most = np.repeat(np.maximum.reduceat(counts, heads), np.diff(heads, append=len(codes)))
            row = [[now], [pack(_steps(codes))], [pack(counts)], [pack((counts == most).astype("u1"))]]
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["radix", "all_codes", "counts", "best"])

        for batch in batches:
            for radix, codes, holders in zip(*(c for c in batch.columns)):
                if now is not None and radix.as_py() != now:
                    yield closed()
                    done, waiting = None, []
                now = radix.as_py()
                waiting.append((np.cumsum(unpack(codes.as_py(), "<i8")), unpack(holders.as_py(), "<u4")))
                if len(waiting) == fan:
                    done, waiting = heap_merged([*([done] if done else []), *waiting]), []
        if now is not None:
            yield closed()

    dealt = segments.select("radix", "codes", "holders").repartition(radices, "radix").sortWithinPartitions("radix")
    return dealt.mapInArrow(emit, "radix int, all_codes binary, counts binary, best binary")


def answers(segments: DataFrame, sums: DataFrame) -> DataFrame:
    """(run, radix, counts, best) of each segment: the totals of its distinct pairs, in their order."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                run, radix, codes, all_codes, counts, best = (c[row].as_py() for c in batch.columns)
                at = np.searchsorted(np.cumsum(unpack(all_codes, "<i8")), np.cumsum(unpack(codes, "<i8")))
                out = {"run": [run], "radix": pa.array([radix], pa.int32())}
                out |= {"counts": [pack(unpack(counts, "<i8")[at])], "best": [pack(unpack(best, "u1")[at])]}
                yield pa.RecordBatch.from_pydict(out)

    met = segments.select("run", "radix", "codes").join(sums, "radix")
    return met.select("run", "radix", "codes", "all_codes", "counts", "best").mapInArrow(emit, "run long, radix int, counts binary, best binary")


def contributions(segments: DataFrame, sums: DataFrame, radices: int) -> DataFrame:
    """(run, local, n_best, count_sum) of the documents of each run: what its segments, all in one task, add up to."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best_sum, count_sum = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def closed() -> pa.RecordBatch:
            local = np.flatnonzero(count_sum)
            out = {"run": np.full(len(local), now, np.int64), "local": local.astype(np.int32)}
            return pa.RecordBatch.from_pydict(out | {"n_best": best_sum[local], "count_sum": count_sum[local]})

        waiting: dict[int, tuple] = {}  # a segment, or its answer, until the other comes, which is the next row
        for batch in batches:
            for row in range(batch.num_rows):
                run, radix, *own = (c[row].as_py() for c in batch.columns)
                if run != now:
                    if now is not None:
                        yield closed()
                    now, best_sum, count_sum = run, np.zeros(0, np.int64), np.zeros(0, np.int64)
                if radix not in waiting:
                    waiting[radix] = own
                    continue
                holders, docs, links, counts, best = (x if x is not None else y for x, y in zip(own, waiting.pop(radix)))
                pair = np.repeat(np.arange(len(holders := unpack(holders, "<u4"))), holders)
                docs, links = unpack(docs, "<u4"), unpack(links, "<u4").astype(np.int64)
                order = np.argsort(docs, kind="stable")
                docs, links, pair = docs[order], links[order], pair[order]
                heads = np.flatnonzero(np.diff(docs.astype(np.int64), prepend=-1))
                more = max(0, int(docs[-1]) + 1 - len(count_sum))
                best_sum, count_sum = (np.append(x, np.zeros(more, np.int64)) for x in (best_sum, count_sum))
                best_sum[docs[heads]] += np.add.reduceat(links * unpack(best, "u1")[pair], heads)
                count_sum[docs[heads]] += np.add.reduceat(links * unpack(counts, "<i8")[pair], heads)
        if now is not None:
            yield closed()

    names = ("holders", "docs", "links", "counts", "best")

    def blank(df: DataFrame) -> DataFrame:
        return df.select("run", "radix", *[F.col(c) if c in df.columns else F.lit(None).cast("binary").alias(c) for c in names])

    both = blank(segments).union(blank(answers(segments, sums)))
    # a fixed number of partitions, so that no run is divided
    both = both.repartition(radices, "run").sortWithinPartitions("run", "radix")
    found = both.mapInArrow(emit, "run long, local int, n_best long, count_sum long")
    return found.groupBy("run", "local").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned(docs: DataFrame, a_path: str, b_path: str, radices: int | None = None, run_links: int = RUN_LINKS, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text)."""
    from sentencepiece import SentencePieceProcessor

    radices = radices or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size_b = SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows = keep(spilled(docs, a_path, b_path, radices, run_links), "runs")
    segments = rows.where("radix is not null").select("run", *[f.split()[0] for f in _SEGMENT.split(", ")])
    sums = keep(totals(segments, radices, size_b, fan), "totals")
    owned = rows.where("radix is null").select("run", *[f.split()[0] for f in _DOC.split(", ")])
    found = owned.join(contributions(segments, sums, radices), ["run", "local"], "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
