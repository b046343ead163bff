"""Corpus encoding with a public byte-level BPE (problem 8).

Global distinct-word shuffle.  Texts are cut into pre-tokens with positions;
every block of documents keeps its own word list, so a word leaves a block once
however often it occurs there (the pre-aggregation that keeps frequent words
from becoming hot keys).  Words are shuffled by content, each distinct word is
encoded once in its partition, the ids return to their blocks, and the
documents are put together again by position.  Decoding joins the token-byte
table.

Defined cases: a null or empty text has the ids ``[]``; repeated rows and
repeated or null ``doc_id`` each keep their own row; strings that look like
special tokens are ordinary text; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# Fixed value: the pre-token pattern published with the byte-level vocabulary.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Tokenizer:
    """Where a public vocabulary lies and how texts are cut before merging."""

    ranks_path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = BYTE_BPE_PATTERN


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


@functools.lru_cache(maxsize=4)
def encoder(tokenizer: Tokenizer):
    import tiktoken

    return tiktoken.Encoding("public", pat_str=tokenizer.pattern, mergeable_ranks=load_ranks(tokenizer.ranks_path), special_tokens={})


def id_width(tokenizer: Tokenizer) -> str:
    """Two bytes carry an id on its way back if the vocabulary allows it."""
    return "<u2" if max(load_ranks(tokenizer.ranks_path).values(), default=0) < 1 << 16 else "<u4"


BLOCK_SCHEMA = "block long, doc_id long, seq array<int>, slot int, word string"
WORD_SCHEMA = "block long, slot int, ids binary"


def _cut_blocks(tokenizer: Tokenizer, block_docs: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(tokenizer.pattern).findall
        base, number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.string()]
        names = ["block", "doc_id", "seq", "slot", "word"]
        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                part = batch.slice(start, block_docs)
                slots: dict[str, int] = {}
                seqs = []
                for text in part.column(1).to_pylist():
                    seqs.append([slots.setdefault(w, len(slots)) for w in find(text)] if text else [])
                n, m, block = part.num_rows, len(slots), base + number
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, types[0]), part.column(0).cast(types[1]), pa.array(seqs, types[2]), pa.nulls(n, types[3]), pa.nulls(n, types[4])], names)
                yield pa.RecordBatch.from_arrays([pa.array([block] * m, types[0]), pa.nulls(m, types[1]), pa.nulls(m, types[2]), pa.array(np.arange(m, dtype=np.int32)), pa.array(list(slots), types[4])], names)

    return cut


def _encode_words(tokenizer: Tokenizer):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, width = encoder(tokenizer).encode_ordinary, id_width(tokenizer)

        # A word comes once from each block that has it; what no longer fits in memory is encoded again.
        @functools.lru_cache(maxsize=500_000)
        def one(word: str) -> bytes:
            return np.array(plain(word), width).tobytes()

        for batch in batches:
            out = list(map(one, batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["block", "slot", "ids"])

    return encode


def _one_chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _reassemble(tokenizer: Tokenizer):
    def reassemble(docs: pa.Table, words: pa.Table) -> pa.Table:
        packed = _one_chunk(words.sort_by("slot").column("ids")).to_pylist()
        width = np.dtype(id_width(tokenizer))
        flat = np.frombuffer(b"".join(packed), width).astype(np.int32)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // width.itemsize
        seqs = _one_chunk(docs.column("seq"))
        values, ends = _gather(flat, np.cumsum(sizes) - sizes, sizes, np.asarray(seqs.flatten().to_numpy(zero_copy_only=False), dtype=np.int64))
        offsets = _offsets(seqs, ends)
        return pa.table({"doc_id": docs.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))})

    return reassemble


def encode_corpus(documents: DataFrame, tokenizer: Tokenizer = Tokenizer(), id_col: str = "doc_id", text_col: str = "text", block_docs: int = 4000) -> DataFrame:
    """``doc_id, ids`` for every row of ``documents``.

    ``block_docs`` bounds a block: its documents and word list are held in one
    task when they are put together.
    """
    cut = materialize(
        documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_cut_blocks(tokenizer, block_docs), BLOCK_SCHEMA)
    )
    docs = cut.filter("slot IS NULL").select("block", "doc_id", "seq")
    words = cut.filter("slot IS NOT NULL").select("block", "slot", "word").repartition("word").mapInArrow(_encode_words(tokenizer), WORD_SCHEMA)
    return docs.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_reassemble(tokenizer), "doc_id long, ids array<int>")


def token_bytes(documents: DataFrame, tokenizer: Tokenizer = Tokenizer()) -> DataFrame:
    """The token-byte table ``id, bytes``: as many rows as the vocabulary has."""
    rows = [(rank, bytearray(token)) for token, rank in load_ranks(tokenizer.ranks_path).items()]
    return documents.sparkSession.createDataFrame(rows, "id int, bytes binary")


def _cut_ids(block_docs: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
        names, id_list = ["block", "doc_id", "seq", "slot", "id"], pa.list_(pa.int32())
        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                part = batch.slice(start, block_docs)
                lists = part.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                known, slots = np.unique(flat, return_inverse=True) if len(flat) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
                lens = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                seqs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(slots.astype(np.int32)))
                n, m, block = part.num_rows, len(known), base + number
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), part.column(0).cast(pa.int64()), seqs, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())], names)
                yield pa.RecordBatch.from_arrays([pa.array([block] * m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, id_list), pa.array(np.arange(m, dtype=np.int32)), pa.array(known.astype(np.int32))], names)

    return cut


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``flat`` one after the other, and where each ends."""
    lens = sizes[which]
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return (flat[np.repeat(starts[which] - (ends - lens), lens) + np.arange(total)] if total else flat[:0]), ends


def _offsets(lists: pa.Array, ends: np.ndarray) -> np.ndarray:
    """Where the items of each list begin and end, given where each element ends."""
    upto = np.cumsum(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64))
    return np.concatenate([[0], np.concatenate([[0], ends])[upto]]).astype(np.int32)


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of UTF-8 bytes; bytes that are none become replacement characters."""
    begins = offsets[:-1][np.diff(offsets) > 0]
    raw = data.tobytes()
    try:
        raw.decode("utf-8")
        sound = not len(begins) or bool(((data[begins] & 0xC0) != 0x80).all())
    except UnicodeDecodeError:
        sound = False
    if sound:
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def _join_bytes(docs: pa.Table, words: pa.Table) -> pa.Table:
    packed = _one_chunk(words.sort_by("slot").column("bytes")).to_pylist()
    sizes = np.fromiter(map(len, packed), np.int64, len(packed))
    seqs = _one_chunk(docs.column("seq"))
    data, ends = _gather(np.frombuffer(b"".join(packed), np.uint8), np.cumsum(sizes) - sizes, sizes, np.asarray(seqs.flatten().to_numpy(zero_copy_only=False), dtype=np.int64))
    return pa.table({"doc_id": docs.column("doc_id"), "text": _texts(data, _offsets(seqs, ends))})


def decode_corpus(encoded: DataFrame, tokenizer: Tokenizer = Tokenizer(), id_col: str = "doc_id", ids_col: str = "ids", block_docs: int = 4000) -> DataFrame:
    """``doc_id, text``: the token bytes of ``ids`` joined and read as UTF-8.

    As in encoding, a block of documents asks for each of its tokens once; the
    asked ids join the token-byte table and the bytes return to their block.
    Empty and null ids give the empty text; an id outside the vocabulary is an
    error.
    """
    cut = materialize(encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(_cut_ids(block_docs), "block long, doc_id long, seq array<int>, slot int, id int"))
    found = cut.filter("slot IS NOT NULL").select("block", "slot", "id").join(token_bytes(encoded, tokenizer), "id", "left")
    checked = found.select(F.col("block").alias("of"), "slot", F.coalesce("bytes", F.raise_error(F.concat(F.lit("no token "), F.col("id").cast("string"))).cast("binary")).alias("bytes"))
    docs = cut.filter("slot IS NULL").select("block", "doc_id", "seq")
    return docs.groupBy("block").cogroup(checked.groupBy("of")).applyInArrow(_join_bytes, "doc_id long, text string")


PIECE_SCHEMA = "doc_id long, place long, part_no int, start_token long, tokens long, loss_tokens long"
_QUESTION = ("Q:", "问：")


def _bears_loss(text: str, lengths: list[int]) -> np.ndarray:
    """Which tokens of a question-and-answer text begin outside its question lines."""
    starts = np.cumsum([0, *lengths[:-1]])
    out, at = np.ones(len(lengths), bool), 0
    for line in text.split("\n"):
        end = at + len(line.encode("utf-8", "replace"))
        if line.startswith(_QUESTION):
            out[(starts >= at) & (starts <= end)] = False
        at = end + 1
    return out


def pieces_of(n: int, loss: np.ndarray | None, tokens: int, loss_tokens: int) -> Iterator[tuple[int, int, int]]:
    """``start, tokens, loss``: the fewest pieces of ``n`` tokens within both limits; one if the whole is."""
    bearing = np.arange(n + 1) if loss is None else np.concatenate([[0], np.cumsum(loss)])
    start = 0
    while start < n:
        end = min(n, start + tokens, int(np.searchsorted(bearing, bearing[start] + loss_tokens, "right")) - 1)
        yield start, end - start, int(bearing[end] - bearing[start])
        start = end


def token_pieces(documents: DataFrame, tokens: int, loss_tokens: int, tokenizer: Tokenizer = Tokenizer(), id_col: str = "doc_id", text_col: str = "text", kind_col: str | None = None) -> DataFrame:
    """``doc_id, place, part_no, start_token, tokens, loss_tokens`` of the pieces of every non-empty text, one unless it exceeds a limit.

    Loss-bearing tokens are counted in each piece: those that begin outside the
    question lines of question-and-answer texts (``kind_col`` is ``faq``); of
    every other text all tokens bear loss.  ``place`` spreads the rows, also
    those without an id or with an equal one.
    """
    kind = F.col(kind_col) if kind_col else F.lit(None).cast("string")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(tokenizer).encode_ordinary
        size = {rank: len(token) for token, rank in load_ranks(tokenizer.ranks_path).items()}
        for batch in batches:
            rows: list[tuple] = []
            for doc, place, text, what in zip(*(c.to_pylist() for c in batch.columns)):
                ids = one(text)
                loss = _bears_loss(text, [size[i] for i in ids]) if what == "faq" else None
                rows += [(doc, place, number, *piece) for number, piece in enumerate(pieces_of(len(ids), loss, tokens, loss_tokens))]
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "place", "part_no", "start_token", "tokens", "loss_tokens"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), kind.alias("kind")).filter(F.length("text") > 0)
    return rows.select("doc_id", F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("place"), "text", "kind").mapInArrow(count, PIECE_SCHEMA)
