"""Token ids as flat binary files with 64-bit document offsets, read back through memory maps.

Documents are range-partitioned by id. Each task writes ``.bin`` (ids as flat little-endian
unsigned integers, 16 bits where the vocabulary allows, else 32), ``.idx`` (n + 1 offsets into it, unsigned 64 bits, in
ids) and ``.ids`` (document ids, signed 64 bits, the least number for null). A file name carries a
random part and only files named by a finished task enter the manifest, so a task that runs twice
leaves a stray file but no wrong one. The manifest has one row per file; the files' places in the whole
are prefix sums over its counts.

A tokenizer with GPT-style pre-splitting never joins text across a space that has other
characters on both sides. Texts are cut there and their units numbered (Arrow's dictionary), the ids of a distinct unit
are looked up, and those of the texts are gathered by number, so that the library encodes each distinct unit about once
per task. Where the tokenizer cuts as GPT-2 does, a new unit of letters, marks and line breaks goes to
the library's model word by word, as its own pre-splitting, which costs more than the model, would hand it over.

Defined results: a null or empty text is the end id alone. Rows that repeat an id are written each, in the order
of their text digests. An empty table makes no files. Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starweave.session import scratch_path

from .common import file_system, keep
from .hashing import text_bytes

END_ID = 2
NULL_ID = -(2**63)
#: Units whose ids a task remembers at a time, and the longest that it remembers, in characters.
REMEMBERED, LONGEST = 1_000_000, 64
#: Marks that are a unit of their own behind a letter.
_MARKS = ",.;:!?"
#: Letters by any edition of Unicode that a library goes by.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SPELLED = re.compile(f"[{_LETTERS}]+[{_MARKS}]?(?:\\n[{_LETTERS}]+[{_MARKS}]?)*").fullmatch
#: How byte-level models spell the bytes from 128 on: the printable ones of Latin-1 as they are, others, with 127, from U+0121 on.
_SHOWN = [*range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: 0x121 + k for k, b in enumerate(b for b in range(0x7F, 0x100) if b not in _SHOWN)}

#: Texts that are encoded together: a unit is looked up once for all of them.
RUN_BYTES = 6_000_000

#: New units that the library encodes in one text.
TOGETHER = 64

_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_CUT = re.compile(r"(?<=\S)(?= \S)")


def _odd(text: str) -> bool:
    """A space of ``text`` stands next to white space."""
    return "  " in text or any(w in text and (f" {w}" in text or f"{w} " in text) for w in _WHITE)


class Encoder:
    """Encodes texts with the tokenizers library, remembering the ids of units."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.model = self.tool.model
        self.known: dict[str, bytes] = {}  # units behind a space
        self.bare: dict[str, bytes] = {}  # words behind a line break
        self.marks = {m: self._ids([m])[0] for m in _MARKS}
        first, gap, second = self._ids(["a", "\n", " b"])
        self.gap = int.from_bytes(gap, "little") if len(gap) == 4 and self._ids(["a\n b"])[0] == first + gap + second else None
        self.line = gap if self.gap is not None and self._cuts_like_gpt2() else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The encoder of this Python worker, which outlives a task."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_starweave_encoders", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _cuts_like_gpt2(self) -> bool:
        """A run of letters, with the space before it, goes to the model as it is, and line breaks and marks by themselves."""
        from tokenizers import models, pre_tokenizers

        tool, cut = self.tool, self.tool.pre_tokenizer
        if not isinstance(cut, pre_tokenizers.ByteLevel) or not cut.use_regex or cut.add_prefix_space:
            return False
        added = [t.content.strip() for t in tool.get_added_tokens_decoder().values()]
        plain = not any(re.fullmatch(f"[{_LETTERS}{_MARKS}\\s]*", content) for content in added)
        return plain and isinstance(self.model, models.BPE) and tool.normalizer is None and tool.post_processor is None

    def _ids(self, units: list[str]) -> list[bytes]:
        found = self.tool.encode_batch_fast(units, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _behind_space(self, units: list[str]) -> list[bytes]:
        """The ids of each unit behind a space. ``units`` hold no white space.

        Units are encoded together with line breaks between them, which become a token of their own
        each; where the count of those is not as it should be, one by one.
        """
        found = []
        runs = [units[at : at + TOGETHER] for at in range(0, len(units), TOGETHER)] if self.gap is not None else [[u] for u in units]
        for run, data in zip(runs, self._ids([" " + "\n ".join(run) for run in runs])):
            cuts = 4 * np.flatnonzero(np.frombuffer(data, np.uint32) == self.gap) if len(run) > 1 else np.zeros(0, int)
            if len(cuts) == len(run) - 1:
                found += [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)])]
            else:
                found += self._ids([" " + u for u in run])
        return found

    def _spell(self, units: list[str]) -> None:
        """Get to know units behind a space that are words with a mark at most, and line breaks between them: word by word by the library's model."""
        known, bare, mark_of, model, line = self.known, self.bare, self.marks.get, self.model.tokenize, self.line

        def ids(word: str, space: str) -> bytes:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LEVEL)
            return array("I", [t.id for t in model(space + spelled)]).tobytes()

        for unit in units:
            first, *more = unit.split("\n") if "\n" in unit else (unit,)
            mark = mark_of(first[-1], b"")
            word = first[:-1] if mark else first
            data = known.get(word)
            if data is None:
                data = ids(word, "\u0120")
                if len(word) <= LONGEST:
                    known[word] = data
            found = data + mark
            for word in more:
                mark = mark_of(word[-1], b"")
                word = word[:-1] if mark else word
                data = bare.get(word)
                if data is None:
                    data = ids(word, "")
                    if len(word) <= LONGEST:
                        bare[word] = data
                found += line + data + mark
            known[unit] = found

    def _learn(self, asked: set[str]) -> None:
        """Get to know units that stand behind a space; a mark behind a letter is split off."""
        known, marks = self.known, self.marks
        new = asked.difference(known)
        if self.line is not None:
            spelled = [u for u in new if _SPELLED(u)]
            self._spell(spelled)
            new.difference_update(spelled)
        marked = [u for u in new if u[-1:] in marks and u[-2:-1].isalpha()]
        bare = list(new.difference(marked).union([u[:-1] for u in marked]).difference(known))
        plain = [u for u in bare if u.split(None, 1) == [u]]
        known.update(zip(plain, self._behind_space(plain)))
        rest = list(set(bare).difference(plain))
        known.update(zip(rest, self._ids([" " + u for u in rest])))
        known.update((u, known[u[:-1]] + marks[u[-1]]) for u in marked)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many there are to the end of each text."""
        units = _units(texts)
        first = units.offsets.to_numpy()[:-1] - units.offsets[0].as_py()
        coded = units.flatten().dictionary_encode()
        names, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        heads = self._ids([names[i] for i in at[first].tolist()])  # they stand behind no space
        at[first] = len(names) + np.arange(len(texts))
        asked = np.bincount(at, minlength=len(names))[: len(names)] > 0
        wanted = [name for name, one in zip(names, asked.tolist()) if one]
        self._learn(set(wanted))
        held = [*map(self.known.__getitem__, wanted), *heads]
        size = np.zeros(len(names) + len(texts), np.int64)
        size[np.append(np.flatnonzero(asked), np.arange(len(names), len(size)))] = [len(data) >> 2 for data in held]
        count = size[at]
        ends = np.cumsum(count)
        place = np.repeat((np.cumsum(size) - size)[at] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        for unit in [u for u in wanted if len(u) > LONGEST]:
            self.known.pop(unit, None)
        if len(self.known) + len(self.bare) > REMEMBERED:
            self.known.clear()
            self.bare.clear()
        return np.frombuffer(b"".join(held), "<u4")[place], ends[np.append(first[1:], len(at)) - 1]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        flat, ends = self.tokens(texts)
        return [part.tobytes() for part in np.split(flat, ends[:-1])]


def _units(texts: list[str]) -> pa.ListArray:
    """The units of each text, one at least; all but the first stand behind a space and are spelled without it."""
    odd = [at for at, text in enumerate(texts) if _odd(text)]
    if not odd:
        return pc.split_pattern(pa.array(texts, pa.string()), " ")
    cut = []
    for at in odd:
        units = [u.removeprefix(" ") for u in _CUT.split(texts[at])]
        cut.append(["", *units] if texts[at].startswith(" ") and units[0] else units)
    even = np.delete(np.arange(len(texts)), odd)
    plain = pc.split_pattern(pa.array([texts[at] for at in even], pa.string()), " ")
    both = pa.concat_arrays([plain, pa.array(cut, plain.type)])
    return both.take(pa.array(np.argsort(np.append(even, odd))))


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows that are encoded together: up to RUN_BYTES of text, or one text that is longer."""
    bounds = text_bytes(texts)[1]
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + RUN_BYTES, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last
        first = last


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> list[Row]:
    """Write the files of ``docs`` (doc_id, text) into ``folder`` and return the manifest.

    Rows of the manifest, one per file in ascending order of id: path, width (bytes per id),
    docs, tokens, and the sums of both before it, first_doc and first_token.
    """
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        system, base = file_system(folder)
        part = TaskContext.get().partitionId()
        path, files = f"{base}/part-{part:06d}-{uuid.uuid4().hex}", []
        encoder, last, number = Encoder.of(tokenizer), 0, 0
        for batch in batches:
            for at, end in _runs(batch.column(1)):
                ids, texts = batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at).to_pylist()
                if not files:
                    system.create_dir(base, recursive=True)
                    files = [system.open_output_stream(f"{path}.{kind}") for kind in ("bin", "idx", "ids")]
                    files[1].write(np.zeros(1, "<u8").tobytes())
                flat, ends = encoder.tokens([text or "" for text in texts])
                files[0].write(np.insert(flat, ends, end_id).astype(f"<u{width}").tobytes())
                offsets = last + ends + np.arange(1, len(texts) + 1)
                last = int(offsets[-1])
                files[1].write(offsets.astype("<u8").tobytes())
                files[2].write(ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                number += len(texts)
        for file in files:
            file.close()
        if files:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "docs": number, "tokens": last}])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", "_digest"]  # equal rows may change places unseen
    rows = rows.withColumn("_digest", F.xxhash64("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = keep(ordered.mapInArrow(emit, "part long, path string, docs long, tokens long"), "manifest")
    rows, first_doc, first_token = [], 0, 0
    for row in sorted(made.collect()):  # one per file
        rows.append(Row(path=row.path, width=width, docs=row.docs, tokens=row.tokens, first_doc=first_doc, first_token=first_token))
        first_doc, first_token = first_doc + row.docs, first_token + row.tokens
    return rows


def read(spark: SparkSession, folder: str, manifest: list[Row]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from memory-mapped files.

    ``start`` counts the ids of all documents before it; the checksum is over 32-bit ids.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], schema)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                width, size = row["width"], row["docs"]
                tokens, idx, ids = (system.open_input_file(f"{row['path']}.{k}") for k in ("bin", "idx", "ids"))
                for at in range(0, size, 5000):
                    n = min(5000, size - at)
                    offset = np.frombuffer(idx.read_at(8 * (n + 1), 8 * at), "<u8").astype(np.int64)
                    doc = np.frombuffer(ids.read_at(8 * n, 8 * at), "<i8")
                    crc = []
                    for a, b in zip(offset[:-1].tolist(), offset[1:].tolist()):
                        own = np.frombuffer(tokens.read_at(width * (b - a), width * a), f"<u{width}")
                        crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(doc, pa.int64(), mask=doc == NULL_ID),
                            "start": pa.array(row["first_token"] + offset[:-1]),
                            "n_tokens": pa.array(np.diff(offset)),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    table = spark.createDataFrame(manifest, "path string, width int, docs long, tokens long, first_doc long, first_token long")
    return table.repartition(len(manifest), "path").mapInArrow(emit, schema)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read(docs.sparkSession, folder, write(docs, tokenizer, folder, end_id))
