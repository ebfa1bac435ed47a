"""Token ids in files of fixed-width bit packing, and back.

A file holds the ids of some documents in ascending ``doc_id`` order, every id in the fewest bits that the vocabulary needs:

* 32 bytes of header: ``SLTK0001``, bits per id and ids per block (4 bytes each), documents and ids (8 bytes each);
* for every document its id, whether it has one, and its number of ids (8 + 1 + 8 bytes, by column);
* the byte offset of every block and of the end (8 bytes each), counted from the first block;
* the blocks, each packed from its first bit on and filled up to a whole byte.

Block offsets let a reader fetch and unpack the blocks around any id without the rest of the file. Files are written below
the shared folder under a name that holds partition and attempt, so a lost task leaves at most a file that no manifest names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotlift.llm.shared import new_folder, written
from spotlift.llm.textkernel import STEP, U, column_bytes, mix, row_slices

_HEAD = np.dtype([("magic", "S8"), ("bits", "<u4"), ("block", "<u4"), ("docs", "<u8"), ("ids", "<u8")])


@dataclass(frozen=True)
class Layout:
    """``tokenizer`` is a file that every executor has; a file is closed after ``file_ids`` ids, at the end of a document."""

    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    end_id: int = 0
    block: int = 1 << 14
    file_ids: int = 1 << 22


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits % 8 == 0:  # the same bytes, without a step for every bit
        return ids.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - bits // 8 :].tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :].ravel()).tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits % 8 == 0:
        whole = np.zeros((count, 4), np.uint8)
        whole[:, 4 - bits // 8 :] = np.frombuffer(data, np.uint8, count * bits // 8).reshape(count, -1)
        return whole.view(">u4").ravel().astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


class PieceEncoder:
    """Ids of whole texts from the library's ids of their pieces, each different piece encoded once.

    Texts are cut between a byte that ends no white space and an ASCII blank, tab or line break, and between an ASCII letter and a point,
    comma or the like; no match of the byte-level split pattern crosses such a place, so a text's ids are those of its pieces in turn.
    Pieces are told apart by 64-bit hashes, kept in sorted arrays. For the same reason new pieces are encoded together, as texts of about ``together`` bytes; the bytes that every id stands
    for tell where a piece's ids end. An added token like ``<|endoftext|>`` gets its own id, as the library gives by default; it holds
    none of the signs that a cut lies before and takes none of its surroundings, so no cut meets it. Pieces that begin or end at the border of
    a text, or begin with a point or the like, could run into their neighbours and are encoded alone.
    """

    #: Bytes of texts that are looked up at a time.
    step = 4 * STEP

    def __init__(self, path: str, most: int = 1 << 21, together: int = 1 << 15):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.together = most, together
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        added = {number: len(token.content.encode()) for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        widths = {number: len(word) for word, number in words.items()} | added  # a byte is one character in the vocabulary
        self.width = np.zeros(1 + max(widths, default=0), np.int64)
        for number, width in widths.items():
            self.width[number] = width
        rng = np.random.default_rng(77)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
        base = 0x9E3779B97F4A7C15
        self.power = np.cumprod(np.concatenate([[U(1)], np.full(2 * self.step, U(base))]), dtype=U)
        self.inverse = np.cumprod(np.concatenate([[U(1)], np.full(2 * self.step, U(pow(base, -1, 2**64)))]), dtype=U)
        self.blank = np.zeros(256, bool)
        self.blank[[0x20, 0x09, 0x0A, 0x0D]] = True
        self.letter, self.mark = np.zeros(256, bool), np.zeros(256, bool)
        self.letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        self.mark[list(b".,;:!?)")] = True
        self.solid = np.zeros(256, bool)
        self.solid[0x21:0x7F] = True
        self._forget()

    def _forget(self) -> None:
        """Names, sorted, with their slots; a slot's ids are ``flat[begin : begin + size]``."""
        self.names, self.slot_of = np.zeros(0, U), np.zeros(0, np.int64)
        self.slots = 0  # handed out
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _ends(self, part: np.ndarray) -> np.ndarray:
        """Where bytes end no white space."""
        ends = self.solid[part]
        tail = part >= 0x80
        if tail.any():
            one, two = np.roll(part, 1), np.roll(part, 2)
            space = (one == 0xC2) & ((part == 0x85) | (part == 0xA0))
            for first, second in ((0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)):
                space |= (two == first) & (one == second)
            ends |= tail & ~space
        return ends

    def _cuts(self, part: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where pieces begin: at every row, and at safe places inside."""
        begins = np.zeros(len(part), bool)
        begins[1:] = self.blank[part[1:]] & ends[:-1] | self.mark[part[1:]] & self.letter[part[:-1]]
        begins[rows[rows < len(part)]] = True
        return np.flatnonzero(begins)

    def _alone(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
        lists = [e.ids for e in found]
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum())), sizes

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``, of pieces that begin and end at safe places."""
        ends = np.cumsum([len(p) for p in pieces])
        cuts = [0, *(np.flatnonzero(np.diff(ends // self.together)) + 1).tolist(), len(pieces)]
        texts = [b"".join(pieces[a:b]).decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        if int(ids.max(initial=0)) < len(self.width):
            reached = np.cumsum(self.width[ids])
            last = np.searchsorted(reached, ends)
            if len(reached) and reached[-1] == ends[-1] and np.array_equal(reached[last], ends):
                return ids, np.diff(last + 1, prepend=0)
        return self._alone(pieces)  # bytes that are no text, or a tokenizer that changes texts

    def _learn(self, part: np.ndarray, solid: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of new pieces."""
        slots = np.zeros(len(starts), np.int64)
        inner = self.blank[part[starts]] & solid[ends - 1]
        for which, encoded in ((inner, self._joined), (~inner, self._alone)):
            if which.any():
                data = part.tobytes()
                pieces = [data[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]
                slots[which] = self._keep(*encoded(pieces))
        return slots

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        count = self.slots
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while count + len(sizes) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[count : count + len(sizes)] = self.used + np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.size[count : count + len(sizes)] = sizes
        self.used += len(ids)
        self.slots += len(sizes)
        return np.arange(count, self.slots)

    def _found(self, part: np.ndarray, solid: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of pieces, known ones by their names."""
        sums = np.concatenate([[U(0)], np.cumsum(self.values[part] * self.power[: len(part)], dtype=U)])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(U))
        names, first, turn = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.names, names)
        slots = np.full(len(names), -1)
        inside = np.flatnonzero(place < len(self.names))
        inside = inside[self.names[place[inside]] == names[inside]]
        slots[inside] = self.slot_of[place[inside]]
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._learn(part, solid, starts[first[new]], ends[first[new]])
            self.names = np.insert(self.names, place[new], names[new])
            self.slot_of = np.insert(self.slot_of, place[new], slots[new])
        return slots[turn]

    def _found_apart(self, part: np.ndarray, solid: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of the pieces of a very long row, told apart by their bytes and not kept by name."""
        whole = part.tobytes()
        numbers: dict[bytes, int] = {}
        turn = np.array([numbers.setdefault(whole[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = np.unique(turn, return_index=True)[1]
        return self._learn(part, solid, starts[first], ends[first])[turn]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows that ``offsets`` bound, one after the other, and the number of each row's."""
        part, rows = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not len(part):
            return np.zeros(0, np.uint32), np.zeros(len(rows) - 1, np.int64)
        if self.slots > self.most:
            self._forget()
        solid = self._ends(part)
        starts = self._cuts(part, solid, rows[:-1])
        ends = np.append(starts[1:], len(part))
        short = len(part) < len(self.power)
        slots = (self._found if short else self._found_apart)(part, solid, starts, ends)
        sizes = self.size[slots]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.begin[slots] - total[:-1], sizes) + np.arange(total[-1])]
        border = total[np.searchsorted(starts, rows)]
        return ids, np.diff(border)


def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python process, with the pieces that earlier tasks have learnt.

    Functions reach workers by value, with a module of their own each time, so it is kept with the library's module.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_spotlift_encoders", {})
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]


def file_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, bits: int, block: int) -> bytes:
    packed = [pack(ids[a : a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in packed])]).astype("<u8")
    head = np.array([(b"SLTK0001", bits, block, len(doc_ids), len(ids))], _HEAD)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([head.tobytes(), named.tobytes(), known.tobytes(), counts.astype("<u8").tobytes(), offsets.tobytes(), *packed])


class TokenFile:
    """Random access to one file: reads its tables once and then only the blocks that are asked for."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.stream = store.open_input_file(name)
        head = np.frombuffer(self.stream.read(_HEAD.itemsize), _HEAD)[0]
        if head["magic"] != b"SLTK0001":
            raise ValueError(f"{path} is no token file")
        self.bits, self.block, docs, self.n_ids = (int(head[k]) for k in ("bits", "block", "docs", "ids"))
        named = np.frombuffer(self.stream.read(8 * docs), "<i8")
        known = np.frombuffer(self.stream.read(docs), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(named, known, strict=True)]
        self.counts = np.frombuffer(self.stream.read(8 * docs), "<u8").astype(np.int64)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(self.stream.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.body = self.stream.tell()

    def ids(self, start: int, count: int) -> np.ndarray:
        if not count:
            return np.zeros(0, np.uint32)
        low, high = start // self.block, (start + count - 1) // self.block
        self.stream.seek(self.body + int(self.offsets[low]))
        data = self.stream.read(int(self.offsets[high + 1] - self.offsets[low]))
        found = []
        for b in range(low, high + 1):
            size = min(self.block, self.n_ids - b * self.block)
            at = self.offsets[b] - self.offsets[low]
            found.append(unpack(data[at : self.offsets[b + 1] - self.offsets[low]], self.bits, size))
        return np.concatenate(found)[start - low * self.block :][:count]

    def close(self) -> None:
        self.stream.close()


def _write(layout: Layout, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(layout.tokenizer)
        bits = max(1, (encoder.tokenizer.get_vocab_size() - 1).bit_length())
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        doc_ids, counts, found, size, turn = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
            name = f"part-{part:06d}-{turn:06d}-{attempt}.sltk"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(file_bytes(doc_ids, np.array(counts, np.int64), ids, bits, layout.block))
            return pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{name}"], "part": [part], "turn": [turn], "n_docs": [len(doc_ids)], "n_ids": [len(ids)]},
                schema=pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("part", "turn", "n_docs", "n_ids")]]),
            )

        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            for low, high in row_slices(offsets, encoder.step):
                ids, sizes = encoder.encode(data, offsets[low : high + 1])
                ends = np.cumsum(sizes)
                # The end id goes behind every document.
                found.append(np.insert(ids, ends, layout.end_id).astype(np.uint32))
                doc_ids += names[low:high]
                counts += (sizes + 1).tolist()
                size += len(found[-1])
                if size >= layout.file_ids:
                    yield closed()
                    doc_ids, counts, found, size, turn = [], [], [], 0, turn + 1
        if doc_ids:
            yield closed()

    return run


def write_tokens(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Writes all documents and gives the manifest: ``path, part, turn, n_docs, n_ids, start``, one row for each file.

    ``start`` counts the ids of all files before, in order. A null text has only the end id; documents without id come first; equal ids are
    ordered by their text's hash.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    if folder.startswith("file:"):
        folder = "file:///" + folder.removeprefix("file:").lstrip("/")
    elif "://" not in folder:
        folder = "file://" + folder
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest = written(
        dealt.mapInArrow(_write(layout, folder), "path string, part long, turn long, n_docs long, n_ids long"),
        "token-manifest",
    )
    before = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)  # one short row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            file = TokenFile(path)
            starts = np.cumsum(file.counts) - file.counts
            low = 0
            while low < len(starts):  # some documents at a time
                high = max(low + 1, int(np.searchsorted(starts + file.counts, starts[low] + (1 << 20), side="right")))
                ids = file.ids(int(starts[low]), int((starts + file.counts)[high - 1] - starts[low])).astype("<u4")
                at = starts[low:high] - starts[low]
                ends = at + file.counts[low:high]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids[low:high], pa.int64()),
                        pa.array(first + starts[low:high]),
                        pa.array(file.counts[low:high]),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True)], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                low = high
            file.close()


def read_back(manifest: DataFrame, files_per_task: int = 4) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files that the manifest names.

    The number of tasks is fixed: by the manifest's own few bytes adaptive execution would read all files in one.
    """
    tasks = min(max(1, -(-manifest.count() // files_per_task)), 1 << 15)
    dealt = manifest.select("path", "start").repartition(tasks, F.col("path"))
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    return read_back(write_tokens(docs, layout))
