"""Token ids as coded binary files: documents in ascending doc_id order, tokenised, coded, read back.

Rows are range-partitioned and sorted by doc_id, so each task holds a stretch of the order. A task tokenises its
documents and writes rows of about SEGMENT ids, each with the ids and lengths of its documents and the coded segments
(see coder.py), as Parquet files in a shared folder: the writer's commit protocol makes that safe against lost
executors. A document's place in the whole is its place in its row plus the ids of all rows before it, which only
needs the rows' counts.

Texts are cut at blanks and line feeds into chunks, each distinct chunk of a block of texts is tokenised once, and the
ids are gathered by chunk number. That holds for tokenizers that drop white space and part words there; whether a
file says so is read from it (_parts_at_blanks), any other is given whole texts.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import coder
from .common import Workspace, text_view

SEGMENT = 4_000_000
END_ID = 1
PIECE = 20 << 20
#: Latin-1 letters and ASCII marks but the apostrophe (contractions) and "<" (special tokens): the tokenizer parts runs of
#: letters from runs of marks there, and lower-cases letter by letter.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ!-&(-/:;=-@\[-`{-~]+")
_RUNS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[^A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Where a word ends in a mark; a blank put there changes no id and leaves fewer distinct chunks.
_WORD_END = r"([a-zÀ-ÖØ-öø-ÿ])([!-&(-/:;=-@\[-`{-~])"
#: The settings of a tokenizer file under which chunks are independent and plain chunks are runs of letters and of marks.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_loaded: dict[str, "_Tokens"] = {}


def _parts_at_blanks(path: str) -> bool:
    """Whether the file's normaliser, splitter, model and special tokens are of the known kind."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    model = own["model"]
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    special = all(t["content"].startswith("<") and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not re.search(r"\s", t["content"]) for t in own["added_tokens"])
    return plain and special and own["normalizer"] == _NORMALIZER and own["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in prints else chr(next(rest)) for b in range(256)}


class _Tokens:
    """Ids of many texts at once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model, self.characters = self.library.model, _byte_characters()
        self.apart = _parts_at_blanks(path)

    def _of_chunk(self, chunk: str) -> list[int]:
        if not _PLAIN.fullmatch(chunk):
            return self.library.encode(chunk, add_special_tokens=False).ids
        out = []
        for run in _RUNS.findall(chunk.lower()):
            out += [t.id for t in self.model.tokenize(run if run.isascii() else run.encode().decode("latin-1").translate(self.characters))]
        return out

    def _of_chunks(self, chunks: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks one after the other, and where each ends; the end id is one more chunk."""
        flat: list[int] = []
        ends = []
        tokenize, characters = self.model.tokenize, self.characters
        for chunk in chunks:
            if chunk.isalpha():  # a lower-cased word of Latin-1 letters goes to the model at once
                if chunk.isascii():
                    flat += [t.id for t in tokenize(chunk)]
                else:
                    try:
                        chunk.encode("latin-1")
                        flat += [t.id for t in tokenize(chunk.lower().encode().decode("latin-1").translate(characters))]
                    except UnicodeEncodeError:
                        flat += self._of_chunk(chunk)
            elif chunk:
                flat += self._of_chunk(chunk)
            ends.append(len(flat))
        return np.array([*flat, end_id], np.uint32), np.array([*ends, len(flat) + 1], np.int32)

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, the end id after each, and the number of each text's ids."""
        if not self.apart:
            got = [[*self.library.encode(t, add_special_tokens=False).ids, end_id] for t in texts.to_pylist()]
            return np.array([i for g in got for i in g], np.uint32), np.array([len(g) for g in got], np.int64)
        lower = not (text_view(texts)[0] == ord("<")).any()  # special tokens are found before lower-casing
        if lower:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _WORD_END, r"\1 \2")
        found = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = found.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not lower:
            words = [w.lower() if w.isascii() and "<" not in w else w for w in words]
        flat, ends = self._of_chunks(words, end_id)
        sizes = np.diff(ends, prepend=np.int32(0))
        offs = found.offsets.to_numpy()[1:] - found.offsets[0].as_py()
        last = offs + np.arange(len(offs))
        chunk = np.empty(len(coded) + len(offs), np.int32)
        inner = np.ones(len(chunk), bool)
        inner[last] = False
        chunk[inner] = coded.indices.to_numpy()
        chunk[last] = len(words)
        del texts, found, coded, words, inner
        size = sizes.take(chunk)
        upto = np.cumsum(size, dtype=np.int64)
        total = int(upto[-1]) if len(upto) else 0
        at = np.repeat((ends.take(chunk) - upto).astype(np.int32 if total < 1 << 30 else np.int64), size)
        at += np.arange(total, dtype=at.dtype)
        return flat.take(at), np.diff(upto[last], prepend=0)


def pieces(column: pa.Array, most: int = PIECE):
    """(first row, row number of each piece, pieces) of a column of texts: runs of rows of at most `most` bytes; a longer text is cut at blanks."""
    raw, offs = text_view(column)
    a, n = 0, len(offs) - 1
    view = pa.py_buffer(raw)
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        own = offs[a : b + 1]
        if own[-1] - own[0] <= most:
            yield a, np.arange(b - a), pa.StringArray.from_buffers(b - a, pa.py_buffer((own - own[0]).astype(np.int32)), view.slice(int(own[0])))
        else:
            start, end = int(own[0]), int(own[-1])
            while start < end:
                stop = min(end, start + most)
                while stop < end:  # on to the next blank, looked for stretch by stretch
                    blanks = np.flatnonzero((raw[stop : stop + most] == 32) | (raw[stop : stop + most] == 10))
                    stop = min(end, stop + (int(blanks[0]) if len(blanks) else most))
                    if len(blanks):
                        break
                yield a, np.zeros(1, np.int64), pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, stop - start], np.int64)), view.slice(start)).cast(pa.string())
                start = stop
        a = b


def _tokenizer(path: str) -> _Tokens:
    if path not in _loaded:
        _loaded[path] = _Tokens(path)
    return _loaded[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Null doc_ids sort first: n_null of a row's documents, its first ones, have none (0 in doc_ids).
_FILE = "part int, seq int, n_ids long, n_null long, doc_ids binary, lengths binary, segments array<binary>"
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary())]


def _coded(ids: np.ndarray) -> list[bytes]:
    """Segments of whole blocks, about SEGMENT ids each."""
    turns = max(1, -(-len(ids) // SEGMENT))
    step = -(-len(ids) // (turns * coder.BLOCK)) * coder.BLOCK
    return [coder.encode(ids[k : k + step]) for k in range(0, len(ids), max(1, step))]


def _encoder(path: str, end_id: int):
    def run(batches):
        tokens, part, seq = _tokenizer(path), TaskContext.get().partitionId(), 0
        docs, sizes, parts, held = [], [], [], 0

        def row():
            nonlocal docs, sizes, parts, held, seq
            segments = _coded(np.concatenate(parts))
            ids = np.array([0 if d is None else d for d in docs], "<i8")
            out = [[part], [seq], [held], [docs.count(None)], [ids.tobytes()], [np.array(sizes, "<i8").tobytes()], [segments]]
            docs, sizes, parts, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, _TYPES, strict=True)], ["part", "seq", "n_ids", "n_null", "doc_ids", "lengths", "segments"])

        for batch in batches:
            names, at = batch.column(0).to_pylist(), -1
            for first, rows, texts in pieces(batch.column(1)):
                got, lengths = tokens.ids(texts, end_id)
                if first == at:  # a long text goes on: its end id so far was none
                    parts[-1], held, sizes[-1] = parts[-1][:-1], held - 1, sizes[-1] - 1
                    sizes[-1] += int(lengths[0])
                else:
                    if held >= SEGMENT:
                        yield row()
                    docs += names[first : first + len(rows)]
                    sizes += lengths.tolist()
                parts.append(got)
                held, at = held + len(got), first
        if docs:
            yield row()

    return run


def write_tokens(docs: DataFrame, where: str, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every row's ids (null text: the end id alone) to the folder, in ascending doc_id order, null ids first; equal ids by text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, 16)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encoder(tokenizer or default_tokenizer(), end_id), _FILE).write.parquet(where)


def _decoded(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            part, seq, _, n_null, docs, sizes, segments = (c[k].as_py() for c in batch.columns)
            raw = b"".join([coder.decode(data).astype("<u4", copy=False).tobytes() for data in segments])
            docs, sizes = np.frombuffer(docs, "<i8"), np.frombuffer(sizes, "<i8")
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), part, np.int32)), pa.array(np.full(len(docs), seq, np.int32)), pa.array(docs, mask=np.arange(len(docs)) < n_null), pa.array(ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, where: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32; raises when a checksum fails."""
    files = spark.read.schema(_FILE).parquet(where)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each segment of SEGMENT ids
    base = files.select("part", "seq", "n_ids").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).drop("n_ids")
    docs = files.mapInArrow(_decoded, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, where: str | None = None, **options) -> DataFrame:
    """Write the token files (to a shared work folder unless named) and read them back, one row per document.

    Null and empty texts have the end id alone; rows without a doc_id come first; rows with equal ids are each written,
    in the order of their texts; texts of any length are tokenised whole, in pieces cut at blanks. Extra columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    where = where or f"{Workspace(spark, 'tokens').root}/ids"
    write_tokens(docs, where, **options)
    return read_tokens(spark, where)
