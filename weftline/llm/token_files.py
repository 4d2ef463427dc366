"""Token ids in binary files: frequency-ranked, byte-aligned variable-length coding.

Ids are replaced by their rank by frequency over all documents, so that common ids
need one byte. A file is a run of blocks; a block holds whole documents:

    magic ``WTI1``, then four little-endian u64: documents, ids, control bytes, data bytes
    per document: a byte that is 1 if doc_id is null; doc_id as i64; number of ids as u64
    control bytes: two bits an id, four ids a byte from the low bits: data bytes less one
    data bytes: each rank in 1 to 4 little-endian bytes

``ranks.u32`` beside the files holds the id of each rank. Control bytes are apart from data,
so decoding is two lookups in numpy tables: a control byte gives the places of its
data bytes in four 32-bit ranks, and a rank gives its id.

Documents are in ascending id order within and across files (null ids first, ties by
a hash of the text): one range shuffle and a sort per task, so texts of one id, or without
one, spread over files. A task streams its blocks, writes to a
name of its own attempt and moves the file to its final name at the end, so a task that
is lost or run twice leaves one whole file. Until all ids are counted the files are
drafts, with the ids themselves under zstd. What comes to the driver: one count per id of
the vocabulary, and one row per file.

Null texts read as empty; an empty text holds the end id alone. Repeated rows are
separate documents. Very long texts make one larger block. An empty table makes no
file and gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import new_folder, saved, text_of
from weftline.llm.word_ids import WordIds, halves, slices

END_ID = 2
_MAGIC, _DRAFT = b"WTI1", b"WTD1"
_HEAD = struct.Struct("<4sQQQQ")
_DOCUMENT = np.dtype([("is_null", "u1"), ("doc_id", "<i8"), ("n", "<u8")])
_RANKS = "ranks.u32"
#: Bytes of text worked on at once, and parts of words that a worker remembers.
_CHUNK = 8 << 20
_MEMORY = 900_000
#: Punctuation that may be cut from the end of a word of letters only.
_TAIL = ".,!?%&*$#|"

# The places of the data bytes of each control byte in four 32-bit numbers.
_WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1
_PLACES = (np.arange(4) < _WIDTHS[:, :, None]).reshape(256, 16)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of numbers below 2**32."""
    n = len(numbers)
    padded = np.zeros(-(-n // 4) * 4, "<u4")
    padded[:n] = numbers
    codes = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    data = padded.view(np.uint8).reshape(-1, 16)[_PLACES[control]]
    spare = len(padded) - n
    return control.tobytes(), data[: len(data) - spare].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of control and data bytes."""
    out = np.zeros(len(control) * 16, np.uint8)
    places = np.flatnonzero(_PLACES[control].ravel())
    out[places[: len(data)]] = data
    return out.view("<u4")[:n]


#: The normaliser and the cuts of a tokenizer file whose words can be encoded apart.
_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Gives the joined ids of texts and how many each has.
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; tasks of a worker share what it remembers of words."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        whole, bare = Tokenizer.from_file(path), Tokenizer.from_file(path)

        def encode(tokenizer: Tokenizer, texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def joined(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum())), lengths

        if not _cuts_words(path):
            _encoders[path] = lambda texts: joined(encode(whole, texts.to_pylist()))
            return _encoders[path]
        # For words that normalising and cutting leave as they are.
        bare.normalizer = normalizers.Sequence([])
        bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

        def encode_parts(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            plain = [_plain(p) for p in parts]
            found: dict[str, list[int]] = {}
            for flag, tokenizer in ((True, bare), (False, whole)):
                some = [p for p, f in zip(parts, plain, strict=True) if f == flag]
                found.update(zip(some, encode(tokenizer, some), strict=True))
            return joined([found[p] for p in parts])

        # Final punctuation of a plain word, which the cuts never join to it.
        words = WordIds(encode_parts, lambda words: halves(words, _TAIL, _plain), _MEMORY)
        _encoders[path] = lambda texts: words(_words_of(texts))
    return _encoders[path]


def _cuts_words(path: str) -> bool:
    """Whether the file normalises and cuts texts as ``_words_of`` and ``_plain`` take for granted.

    Texts of any other file are encoded whole.
    """
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    cuts = (settings["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    split = {k: cuts[0].get(k) for k in ("type", "pattern", "behavior", "invert")}
    added = settings["added_tokens"]
    return (
        (settings["normalizer"] or {}).get("normalizers") == _NORMALIZER
        and split == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
        and [c.get("type") for c in cuts[1:]] == ["ByteLevel"]
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and settings["model"]["type"] == "BPE" and not settings["model"]["dropout"]
        and all(
            t["content"].startswith("<|") and not any(c.isspace() for c in t["content"])
            and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])
            for t in added
        )
    )


def _plain(part: str) -> bool:
    """Lower-case Latin letters only, each one character, which normalising leaves as they are."""
    return part.isalpha() and part.lower() == part and (
        part.isascii() or max(part) < "\u0250" and unicodedata.is_normalized("NFC", part)
    )


def _words_of(texts: pa.Array) -> pa.ListArray:
    """Cut at white space at which the tokenizer cuts too; what other there is stays.

    A-Z are lower-cased, as the tokenizer does, but for texts that may name a special token, and
    for texts with marks: some join a small letter and not the capital.
    """
    kept = pc.match_substring_regex(texts, r"<\||\p{M}")
    lower = pc.if_else(kept, texts, pc.ascii_lower(texts))
    return pc.split_pattern(pc.replace_substring(lower, "\n", " "), " ")


def _encoded(batches, path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    encode = _encoder(path)
    for batch, texts in slices(batches, size=_CHUNK):
        yield batch, *encode(texts)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    if not urlparse(folder).scheme:
        folder = "file://" + os.path.abspath(folder)
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return pafs.FileSystem.from_uri(folder)


def _header(doc_ids: pa.Array, lengths: np.ndarray) -> bytes:
    documents = np.zeros(len(lengths), _DOCUMENT)
    documents["is_null"] = doc_ids.is_null().to_numpy(zero_copy_only=False)
    documents["doc_id"] = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
    documents["n"] = lengths
    return documents.tobytes()


def _draft_block(doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A block before ranks are known: ids as they are, compressed."""
    raw = pa.compress(ids.astype("<u4").tobytes(), codec="zstd", asbytes=True)
    head = _HEAD.pack(_DRAFT, len(lengths), len(ids), len(raw), 0)
    return b"".join((head, _header(doc_ids, lengths), raw))


def _block(documents: bytes, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    n = len(documents) // _DOCUMENT.itemsize
    head = _HEAD.pack(_MAGIC, n, len(ranks), len(control), len(data))
    return b"".join((head, documents, control, data))


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids followed by the end id."""
    return np.insert(ids, np.cumsum(lengths), end_id), lengths + 1


def _name(part: int) -> str:
    return f"part-{part:06d}.wti"


def _attempt(base: str, part: int) -> str:
    """A name that no other task, and no other attempt of this one, writes to."""
    return f"{base}/.{_name(part)}.{TaskContext.get().taskAttemptId()}"


_DRAFTED = "part long, documents long, id long, n long"


def _drafting(path: str, folder: str, end_id: int) -> Callable:
    """Writes the draft of a partition; returns a row for it and one per id in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, base = _store(folder)
        counts = np.zeros(1 << 16, np.int64)
        documents = 0
        out = None
        for batch, ids, lengths in _encoded(batches, path):
            ids, lengths = _with_end(ids, lengths, end_id)
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            out = out or store.open_output_stream(_attempt(base, part))
            out.write(_draft_block(batch.column("doc_id"), ids, lengths))
            documents += len(lengths)
        if out is not None:
            out.close()
            store.move(_attempt(base, part), f"{base}/{_name(part)}.draft")
            ids = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids) + 1, part, np.int64)),
                    pa.array([documents, *[0] * len(ids)], pa.int64()),
                    pa.array([None, *ids.tolist()], pa.int64()),
                    pa.array([int(counts.sum()), *counts[ids].tolist()], pa.int64()),
                ],
                ["part", "documents", "id", "n"],
            )

    return run


def _ranking(folder: str) -> Callable:
    """Writes the file of each draft and deletes the draft.

    If an earlier attempt got so far, the file is there and whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        table = _rank_table(store, base)
        places = np.zeros(int(table.max(initial=0)) + 1, np.uint32)
        places[table] = np.arange(len(table))
        for batch in batches:
            for part in batch.column("part").to_pylist():
                final, draft = f"{base}/{_name(part)}", f"{base}/{_name(part)}.draft"
                if store.get_file_info(final).type == pafs.FileType.NotFound:
                    with (
                        store.open_input_stream(draft) as stream,
                        store.open_output_stream(_attempt(base, part)) as out,
                    ):
                        for rows, ids in _blocks(stream):
                            out.write(_block(rows.tobytes(), places[ids]))
                    store.move(_attempt(base, part), final)
                if store.get_file_info(draft).type != pafs.FileType.NotFound:
                    store.delete_file(draft)
            yield batch

    return run


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """One small row per file, dealt to as many tasks as there are shuffle partitions."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def write_token_files(
    documents: DataFrame, path: str, folder: str, end_id: int = END_ID, parts: int | None = None
) -> DataFrame:
    """Writes the ids of (doc_id, text) rows; returns (part, name, documents, ids, start).

    ``start`` is the number of ids in the files before. Texts are tokenized once: drafts
    hold the ids in order, ranks come from the counts of all drafts, and each draft is
    then written with ranks.
    """
    spark = documents.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", text_of("text").alias("text"))
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    ordered = rows.withColumn("hash", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(parts, "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    drafted = saved(ordered.drop("hash").mapInArrow(_drafting(path, folder, end_id), _DRAFTED))
    counts = drafted.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ranks = sorted(counts, key=lambda r: (-r["n"], r["id"]))
    with store.open_output_stream(f"{base}/{_RANKS}") as out:
        out.write(np.array([r["id"] for r in ranks], "<u4").tobytes())
    found = drafted.where("id is null").orderBy("part").collect()
    files, start = [], 0
    for r in found:
        files.append((r["part"], _name(r["part"]), r["documents"], r["n"], start))
        start += r["n"]
    table = spark.createDataFrame(
        files, "part long, name string, documents long, ids long, start long"
    )
    _spread(table.select("part"), "part").mapInArrow(_ranking(folder), "part long").count()
    return table


def _rank_table(store: pafs.FileSystem, base: str) -> np.ndarray:
    with store.open_input_stream(f"{base}/{_RANKS}") as stream:
        return np.frombuffer(stream.read(), "<u4")


def _blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents and numbers of each block: ranks, or ids in a draft."""
    while head := stream.read(_HEAD.size):
        magic, documents, ids, control, data = _HEAD.unpack(head)
        rows = np.frombuffer(stream.read(documents * _DOCUMENT.itemsize), _DOCUMENT)
        first = stream.read(control)
        if magic == _DRAFT:
            raw = pa.decompress(first, 4 * ids, codec="zstd", asbytes=True) if ids else b""
            yield rows, np.frombuffer(raw, "<u4")
        elif magic == _MAGIC:
            second = np.frombuffer(stream.read(data), np.uint8)
            yield rows, unpack(np.frombuffer(first, np.uint8), second, ids)
        else:
            raise ValueError("not a block of token ids")


def _reading(folder: str, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        table = _rank_table(store, base)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["start"]
                with store.open_input_stream(f"{base}/{row['name']}") as stream:
                    for documents, numbers in _blocks(stream):
                        lengths = documents["n"].astype(np.int64)
                        yield _documents(documents, table[numbers], lengths, start, with_ids)
                        start += int(lengths.sum())

    return run


def _documents(documents, ids, lengths, start: int, with_ids: bool) -> pa.RecordBatch:
    ends = np.cumsum(lengths)
    raw = ids.astype("<u4").tobytes()
    view = memoryview(raw)
    bounds = zip((4 * (ends - lengths)).tolist(), (4 * ends).tolist(), strict=True)
    columns = {
        "doc_id": pa.array(
            documents["doc_id"].astype(np.int64), mask=documents["is_null"].astype(bool)
        ),
        "start": start + ends - lengths,
        "n_tokens": lengths,
        "ids_crc32": np.array([zlib.crc32(view[a:b]) for a, b in bounds], np.int64),
    }
    if with_ids:
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def read_token_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), and the ids themselves if asked for."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" * with_ids
    spread = _spread(files.select("name", "start"), "name")
    return spread.mapInArrow(_reading(folder, with_ids), schema)


def token_files(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """Encodes, writes and reads back; one row per document."""
    folder = new_folder(spark, "token-files")
    return read_token_files(write_token_files(documents, path, folder), folder)


def file_sizes(folder: str) -> dict[str, int]:
    """Bytes of each file of a folder."""
    store, base = _store(folder)
    found = store.get_file_info(pafs.FileSelector(base))
    return {f.base_name: f.size for f in found}
