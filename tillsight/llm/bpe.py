"""Byte-level BPE over a global shuffle of distinct words, and decoding by the token-byte table.

Texts are cut into pre-tokens. A batch of texts numbers its distinct pre-tokens
and writes each text as the sequence of their numbers; the distinct pre-tokens
alone are shuffled by word, where each word of the corpus is encoded once. The
ids go back to the batches that hold the word, which put them in the place of
the numbers. So a frequent word travels once per batch, never once per occurrence.
"""

from __future__ import annotations

import base64
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import remembered, tidy

# The white space of the pattern's own engine; Python's class has four control characters more.
_SPACE = r"\t-\r \x85\xa0  -     　"
_SIGNS = frozenset(",.;:!?")
BATCH_CHARS = 28 << 20
BATCH_TEXTS = 50_000
STEP_CHARS = 3 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def splitter(pattern: str):
    """A compiled pre-token pattern in which white space means the same as in the tiktoken library."""
    inside = pattern.replace(r"[^\s", f"[^{_SPACE}")
    return regex.compile(inside.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))


def to_varint(numbers: np.ndarray, counts: np.ndarray | None = None) -> bytes | list[bytes]:
    """Non-negative numbers below 2^28 as 7-bit groups, lowest first; in parts of ``counts`` numbers, if given."""
    n = numbers.astype(np.uint32)
    width = 1 + (n >= 1 << 7) + (n >= 1 << 14) + (n >= 1 << 21).astype(np.int64)
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(n) else 0, np.uint8)
    starts = ends - width
    for k in range(4):
        has = np.flatnonzero(width > k)
        more = (width[has] > k + 1).astype(np.uint8) << 7
        out[starts[has] + k] = ((n[has] >> (7 * k)) & 127).astype(np.uint8) | more
    data = out.tobytes()
    if counts is None:
        return data
    stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [data[a:b] for a, b in zip(stops, stops[1:], strict=False)]


def from_varint(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    first = np.ones(len(raw), bool)
    first[1:] = raw[:-1] < 128
    starts = np.flatnonzero(first)
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


class PreTokens:
    """Numbers the distinct pre-tokens of a batch of texts, and gives each text as their numbers.

    A space before anything but white space always begins a pre-token, so most
    texts are cut there first and the pattern runs once per distinct cut; texts
    with a space before other white space or at their end go through it whole.
    """

    def __init__(self, pattern: str):
        self.find = splitter(pattern).findall
        self.odd = regex.compile(f" (?:[{_SPACE}]|$)").search
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.cuts: dict[str, int] = {}  # place of a cut in the three arrays
        self.flat, self.begins, self.sizes = array("i"), array("q"), array("i")

    def _place(self, text: str, cut: str = "") -> int:
        """``cut`` is the text without the space before it: letters alone, or with one sign behind, need no pattern."""
        words = self.words
        if cut.isalpha():
            found = (words.setdefault(text, len(words)),)
        elif cut[-1:] in _SIGNS and cut[:-1].isalpha():
            found = (words.setdefault(text[:-1], len(words)), words.setdefault(cut[-1], len(words)))
        else:
            found = [words.setdefault(w, len(words)) for w in self.find(text)]
        self.begins.append(len(self.flat))
        self.flat.extend(found)
        self.sizes.append(len(found))
        return len(self.sizes) - 1

    def add(self, texts: list[str], coded: bool = True) -> list[bytes]:
        """Number the words of some texts of the batch; the code of each text, its numbers, if ``coded``.

        The pattern sees each distinct cut once. Numbers do not depend on ``coded``.
        """
        whole = {k: t for k, t in enumerate(texts) if self.odd(t)}
        split = pc.split_pattern(pa.array(["" if k in whole else t for k, t in enumerate(texts)], pa.large_string()), " ")
        numbered = split.values.dictionary_encode()
        cuts, known = numbered.dictionary.to_pylist(), self.cuts
        for c in cuts:
            if c not in known:
                known[c] = self._place(" " + c, c)
        offsets = split.offsets.to_numpy()
        begin = offsets[:-1]
        # the first cut of a text has no space before it
        heads = numbered.indices.to_numpy()[begin].tolist()
        first = [self._place(whole[k] if k in whole else cuts[h]) for k, h in enumerate(heads)]
        if not coded:
            return []
        place = np.fromiter(map(known.__getitem__, cuts), np.int32, len(cuts))
        order = place[numbered.indices.to_numpy()]
        order[begin] = first
        # what numpy sees of a growing array must not outlive the call
        n = np.frombuffer(self.sizes, np.int32)[order].astype(np.int64)
        ends = np.cumsum(n)
        at = np.repeat(np.frombuffer(self.begins, np.int64)[order] - (ends - n), n)
        at += np.arange(len(at))
        numbers = np.frombuffer(self.flat, np.int32)[at] if len(at) else np.zeros(0, np.int32)
        return to_varint(numbers, np.diff(np.concatenate([[0], ends])[offsets]))


def _numbered(batches, pattern: str, coded: bool):
    """Per batch of texts: its number, the ids, the code of each text, its words by number, and a checksum of these."""
    task, cutter = TaskContext.get(), remembered(f"pre-tokens {pattern}", lambda: PreTokens(pattern))
    cutter.clear()
    base = (task.partitionId() if task else 0) << 33

    def cut(ids, codes, count):
        words = list(cutter.words)
        cutter.clear()
        return base + count, ids, codes, words, zlib.crc32("\0".join(words).encode())

    ids, texts, codes, held, chars, count = [], [], [], 0, 0, 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            t = t.as_py() or ""
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= STEP_CHARS or len(ids) >= BATCH_TEXTS:
                codes += cutter.add(texts, coded)
                chars, texts, held = chars + held, [], 0
            if chars >= BATCH_CHARS or len(ids) >= BATCH_TEXTS:
                yield cut(ids, codes, count)
                ids, codes, chars, count = [], [], 0, count + 1
    if ids:
        codes += cutter.add(texts, coded)
        yield cut(ids, codes, count)


def _table(schema: pa.Schema, *columns):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _same(n, value):
    return pa.array(np.full(n, value))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers). NULL is the empty text, which has no ids.

    ``decoded`` adds the bytes that the ids stand for in the token-byte table, as :func:`decode` does.

    ``df`` is read twice and has to give its rows in the same order within the
    same partitions, as a scan does; a checksum of every batch stops the job
    otherwise. The vocabulary is broadcast: its size is fixed.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    small = np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    code_rows = pa.schema([("batch", pa.int64()), ("sum", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.binary())])
    word_rows = pa.schema([("batch", pa.int64()), ("sum", pa.int64()), ("number", pa.int32()), ("word", pa.string())])
    id_rows = pa.schema([("batch", pa.int64()), ("sum", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])

    @tidy
    def codes(batches):
        for batch, ids, coded, _, check in _numbered(batches, pattern, True):
            for k in range(0, len(ids), 5000):
                part = slice(k, k + 5000)
                n = len(ids[part])
                yield _table(code_rows, _same(n, batch), _same(n, check), ids[part], coded[part])

    @tidy
    def words(batches):
        for batch, _, _, known, check in _numbered(batches, pattern, False):
            for k in range(0, len(known), 50_000):
                part = known[k : k + 50_000]
                yield _table(word_rows, _same(len(part), batch), _same(len(part), check),
                             np.arange(k, k + len(part), dtype=np.int32), part)

    @tidy
    def word_ids(batches):
        """Sorted words: each is encoded where it first appears; ids are handed on packed by batch."""
        one = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})._encode_single_piece
        last, last_ids = None, b""
        held: dict[tuple[int, int], tuple[list, list, list]] = {}
        rows = 0

        def flush():
            for (b, check), (numbers, sizes, ids) in held.items():
                order = np.argsort(numbers)
                steps = np.diff(np.array(numbers, np.int64)[order], prepend=0)
                yield _table(id_rows, [b], [check], [to_varint(steps)], [to_varint(np.array(sizes)[order])], [b"".join([ids[k] for k in order.tolist()])])

        for batch in batches:
            for b, check, number, word in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if word != last:
                    last, last_ids = word, np.array(one(word), small).tobytes()
                numbers, sizes, ids = held.setdefault((b, check), ([], [], []))
                numbers.append(number)
                sizes.append(len(last_ids) // small().nbytes)
                ids.append(last_ids)
                rows += 1
            if rows >= 400_000:
                yield from flush()
                held.clear()
                rows = 0
        yield from flush()

    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())] + [("decoded", pa.binary())] * decoded)
    table = spark.sparkContext.broadcast(token_table(ranks)) if decoded else None

    def reassemble(texts: pa.Table, known: pa.Table) -> pa.Table:
        checks = set(texts.column("sum").to_pylist()) | set(known.column("sum").to_pylist())
        if len(checks) > 1:
            raise RuntimeError("the input changed between its two reads")
        numbers = np.concatenate([np.zeros(0, np.int64), *[np.cumsum(from_varint(n.as_py())) for n in known.column("numbers")]])
        sizes = np.concatenate([np.zeros(0, np.int64), *[from_varint(n.as_py()) for n in known.column("sizes")]])
        ids = np.frombuffer(b"".join(known.column("ids").to_pylist()), small)
        begin, size = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        begin[numbers], size[numbers] = np.cumsum(sizes) - sizes, sizes
        tokens, parts = table.value if table else None, []
        for k in range(0, texts.num_rows, 250):  # small batches, so that what the JVM holds stays small
            part, found, counts = texts.slice(k, 250), [], []
            for coded in part.column("codes"):
                word = from_varint(coded.as_py())
                n = size[word]
                total = int(n.sum())
                at = np.repeat(begin[word] - (np.cumsum(n) - n), n) + np.arange(total)
                found.append(ids[at].astype("<u4").tobytes())
                counts.append(total)
            columns = [part.column("doc_id").combine_chunks(), pa.array(counts, pa.int64()), pa.array(found, pa.binary())]
            if table:
                columns.append(pa.array([token_bytes(tokens, f) for f in found], pa.binary()))
            parts.append(pa.RecordBatch.from_arrays(columns, schema=out))
        return pa.Table.from_batches(parts, out)

    coded = docs.mapInArrow(codes, "batch long, sum long, doc_id long, codes binary")
    distinct = docs.mapInArrow(words, "batch long, sum long, number int, word string")
    ids = distinct.repartition("word").sortWithinPartitions("word").mapInArrow(
        word_ids, "batch long, sum long, numbers binary, sizes binary, ids binary")
    return coded.groupBy("batch").cogroup(ids.groupBy("batch")).applyInArrow(reassemble, "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decoded)


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes of each token by id; its size is that of the vocabulary."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def token_bytes(table: list[bytes], ids: bytes) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Add ``name``: the bytes of the ids in ``ids_col``, looked up in the broadcast token-byte table. NULL stays NULL; an unknown id fails the job."""
    shared = df.sparkSession.sparkContext.broadcast(token_table(ranks))
    kept = [c for c in df.columns if c != name]
    place = kept.index(ids_col)

    def look_up(batches):
        tokens = shared.value
        for batch in batches:
            texts = []
            for value in batch.column(place):
                raw = value.as_py()
                texts.append(None if raw is None else token_bytes(tokens, raw))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*kept, name])

    from pyspark.sql.types import BinaryType, StructField, StructType

    rows = df.select(*kept)
    return rows.mapInArrow(look_up, StructType([*rows.schema.fields, StructField(name, BinaryType())]))
