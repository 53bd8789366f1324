"""Vector bin packing of token pieces into training sequences.

A sequence has three limits: tokens, segments, and tokens that bear loss. An
open sequence takes, of all pieces that fit it, the one with the largest dot
product of the piece's needs and what the sequence has left, each as a share of
its limit. Pieces are packed where they are read, in bounded groups, so no
token is shuffled.
"""

from __future__ import annotations

import unicodedata
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import portions, remembered, tidy


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], np.int64)


def dot_product_bins(needs: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Bin number of each row of ``needs`` (rows x limits). Every row has to fit an empty bin.

    Equal rows are interchangeable and taken in their order, so the work per
    choice is over distinct rows only.
    """
    bins = np.zeros(len(needs), np.int64)
    if not len(needs):
        return bins
    if (needs > limits).any():
        raise ValueError("a piece is larger than a whole sequence")
    kinds, kind_of = np.unique(needs, axis=0, return_inverse=True)
    order = np.argsort(kind_of.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(kind_of.ravel(), minlength=len(kinds)))
    taken = np.concatenate([[0], ends[:-1]])
    share = kinds / limits
    current, left, open_rows = 0, limits.copy(), len(needs)
    alive = np.arange(len(kinds))
    while open_rows:
        fit = alive[(kinds[alive] <= left).all(axis=1)]
        if not len(fit):
            current, left = current + 1, limits.copy()
            continue
        best = fit[np.argmax(share[fit] @ (left / limits))]
        # equal pieces go in together as long as they would be chosen anyway: one at a time keeps it plain
        bins[order[taken[best]]] = current
        left = left - kinds[best]
        taken[best] += 1
        open_rows -= 1
        if taken[best] == ends[best]:
            alive = alive[alive != best]
    return bins


def pack(df: DataFrame, limits: Limits = Limits(), group_rows: int = 20_000) -> DataFrame:
    """Pack rows (``tokens``, ``loss_tokens``) that are to stay whole, such as instruction examples.

    Adds sequence_id, offset (tokens before the row in its sequence) and segment.
    Groups of at most ``group_rows`` rows of a partition are packed together.
    NULL counts as 0; a row beyond a limit fails the job.
    """
    kept = [c for c in df.columns if c not in ("sequence_id", "offset", "segment")]
    rows = df.select(*kept)
    at_tokens, at_loss = kept.index("tokens"), kept.index("loss_tokens")
    most = limits.array()

    @tidy
    def packed(batches):
        base, group, size, used = TaskContext.get().partitionId() << 33, [], 0, 0

        def finish():
            table = pa.Table.from_batches(group).combine_chunks()
            number = lambda k: np.nan_to_num(table.column(k).fill_null(0).to_numpy()).astype(np.int64)
            needs = np.column_stack([number(at_tokens), np.ones(table.num_rows, np.int64), number(at_loss)])
            bins = dot_product_bins(needs, most)
            offset, segment = offsets(bins, needs[:, 0])
            columns = [*table.columns, pa.array(base + used + bins), pa.array(offset), pa.array(segment)]
            return pa.table(columns, names=[*kept, "sequence_id", "offset", "segment"]), int(bins.max()) + 1

        for batch in batches:
            for k in range(0, batch.num_rows, group_rows):
                part = batch.slice(k, min(group_rows, batch.num_rows - k))
                if size and size + part.num_rows > group_rows:
                    table, n = finish()
                    used += n
                    yield from table.to_batches()
                    group, size = [], 0
                group.append(part)
                size += part.num_rows
        if size:
            yield from finish()[0].to_batches()

    from pyspark.sql.types import LongType, StructField, StructType

    more = [StructField(n, LongType()) for n in ("sequence_id", "offset", "segment")]
    return rows.mapInArrow(packed, StructType([*rows.schema.fields, *more]))


def offsets(bins: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens before, and place of, each row in its bin, in the order of the rows."""
    order = np.argsort(bins, kind="stable")
    ordered, size = bins[order], tokens[order]
    first = np.ones(len(bins), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(first)
    run = np.diff(np.append(starts, len(bins)))
    before = np.cumsum(size) - size
    offset, segment = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
    offset[order] = before - np.repeat(before[starts], run) if len(bins) else 0
    segment[order] = np.arange(len(bins)) - np.repeat(starts, run)
    return offset, segment


class ChunkEncoder:
    """Texts to ids (bytes of little-endian unsigned 32-bit numbers), encoding each white-space chunk once.

    Right for tokenizers that compose characters, fold case and white space, and
    then cut words of letters, single digits and runs of other signs, as
    word_bpe_49k.json does: none of these steps looks across white space, and a
    sign behind a whole word is a token run of its own. Only space, tab and
    newline separate chunks here; any other character is left to the tokenizer.
    Texts whose case folding depends on more than the character, or that are not
    composed, go to it whole. A bounded number of chunks is remembered.
    """

    def __init__(self, tokenizer_json: str, most: int = 600_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        # the model behind white space alone, for words that need no folding and no cutting
        self.words = Tokenizer.from_str(tokenizer_json)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.most = most

    def _learn_words(self, words: list[str]) -> None:
        """Encode many words of letters as one text, by the model alone: each of them is folded and one word already."""
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            ids = np.array(self.words.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) != len(part):
                raise RuntimeError("a word has more or less than one closing token")
            self._keep(part, ids.tobytes(), ends)

    def _learn(self, chunks: list[str]) -> None:
        """Encode any chunks as one text; a token belongs to the chunk that its first character lies in."""
        for k in range(0, len(chunks), 20_000):
            part = chunks[k : k + 20_000]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            begins = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            self._keep(part, np.array(found.ids, "<u4").tobytes(), 4 * np.searchsorted(begins, np.cumsum(sizes)))

    def _keep(self, chunks: list[str], ids: bytes, ends: np.ndarray) -> None:
        stops = ends.tolist()
        self.known.update(zip(chunks, [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)], strict=True))

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.most:
            known.clear()
            known[""] = b""
        new = set(chunks).difference(known)
        signed = [c for c in new if c[-1] in ",.;:!?" and c[:-1].isalnum()]
        bodies = (new.difference(signed) | {c[:-1] for c in signed} | {c[-1] for c in signed}).difference(known)
        words = [c for c in bodies if c.isalpha()]
        self._learn_words(words)
        self._learn(list(bodies.difference(words)))
        known.update([(c, known[c[:-1]] + known[c[-1]]) for c in signed])
        return list(map(known.__getitem__, chunks))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Chunks are numbered by Arrow; each distinct one is looked up once, and the texts are put together by number."""
        folded: list[str] = []
        whole: dict[int, bytes] = {}
        for k, text in enumerate(texts):
            low = text.lower()
            if text.isascii() or (len(low) == len(text) and "\u03a3" not in text
                                  and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
                folded.append(low.replace("\n", " ").replace("\t", " "))
            else:
                folded.append("")
                whole[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        split = pc.split_pattern(pa.array(folded, pa.large_string()), " ")
        numbered = split.values.dictionary_encode()
        found = self._ids_of(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), "<u4")
        number = numbered.indices.to_numpy()
        n = sizes[number]
        ends = np.cumsum(n)
        out = ids[np.repeat(begins[number] - (ends - n), n) + np.arange(int(ends[-1]) if len(n) else 0)].tobytes()
        upto = np.concatenate([[0], ends])[split.offsets.to_numpy()] * 4
        return [whole.get(k) or out[a:b] for k, (a, b) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True))]


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "segment long, loss_tokens long, ids binary")


def pack_documents(df: DataFrame, tokenizer_json: str, end_id: int = 1, limits: Limits = Limits(), id_col: str = "doc_id",
                   text_col: str = "text", group_ids: int = 16 << 20, group_rows: int = 20_000) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece, columns ``PIECES``.

    A document is its ids and ``end_id``; NULL is the empty text. Whole
    sequences are cut off first; the rest of each document is one piece, packed
    by the dot-product rule within groups of a partition (bounded by ids and
    rows). What sequences then lack is filled by cutting up the emptiest
    sequences of the group, so that at most one of them stays short unless the
    segment limit binds. Every id but the first of a document bears loss.
    """
    most = limits.array()
    whole = min(limits.tokens, limits.loss_tokens)
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)  # one file of fixed size
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in PIECES.split(", ")])
    tail = np.array([end_id], "<u4").tobytes()

    def pieces_of(group: list[tuple[int | None, bytes]]):
        """Pieces (document, start, length) and their bins."""
        doc, start, length, bins = [], [], [], []
        rest = []
        used = 0
        for d, (_, ids) in enumerate(group):
            n, at = len(ids) // 4, 0
            while n - at >= whole:
                doc.append(d), start.append(at), length.append(whole), bins.append(used)
                used, at = used + 1, at + whole
            if n > at:
                rest.append((d, at, n - at))
        needs = np.array([(n, 1, n - (at == 0)) for _, at, n in rest], np.int64).reshape(-1, 3)
        placed = dot_product_bins(needs, most)
        for (d, at, n), b in filled(rest, placed, most):
            doc.append(d), start.append(at), length.append(n), bins.append(used + b)
        return doc, start, length, np.array(bins, np.int64)

    @tidy
    def packed(batches):
        text = shared.value
        encoder = remembered(f"chunks {hash(text)}", lambda: ChunkEncoder(text))
        base, used = TaskContext.get().partitionId() << 33, 0
        group, held = [], 0

        def finish():
            doc, start, length, bins = pieces_of(group)
            size = np.array(length, np.int64)
            offset, segment = offsets(bins, size)
            cut = [group[d][1][4 * a : 4 * (a + n)] for d, a, n in zip(doc, start, length, strict=True)]
            columns = [
                [group[d][0] for d in doc], start, length, [zlib.crc32(c) for c in cut], [len(group[d][1]) // 4 for d in doc],
                base + used + bins, offset, segment, size - (np.array(start, np.int64) == 0), cut,
            ]
            for k in range(0, len(doc), 4000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 4000], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            return int(bins.max()) + 1

        def encoded():
            for batch in batches:
                for part in portions(batch, 1, 48 << 20):
                    yield from zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True)

        for i, ids in encoded():
            ids += tail
            group.append((i, ids))
            held += len(ids) // 4
            if held >= group_ids or len(group) >= group_rows:
                used += yield from finish()
                group, held = [], 0
        if group:
            yield from finish()

    return docs.mapInArrow(packed, PIECES)


def filled(pieces: list[tuple[int, int, int]], bins: np.ndarray, limits: np.ndarray) -> list[tuple[tuple[int, int, int], int]]:
    """Cut the pieces of the emptiest bins into what the other bins lack; (document, start, length) and bin, bins renumbered.

    Bins are emptied from the emptiest on, while the gaps of the others hold them.
    """
    members: dict[int, list[tuple[int, int, int]]] = {}
    for piece, b in zip(pieces, bins.tolist(), strict=True):
        members.setdefault(b, []).append(piece)

    def left(b):
        held = members[b]
        used = (sum(n for _, _, n in held), len(held), sum(n - (at == 0) for _, at, n in held))
        return [int(m) - u for m, u in zip(limits, used, strict=True)]

    room = {b: left(b) for b in members}
    order = sorted(members, key=lambda b: (-room[b][0], b))
    gaps = sorted(members, key=lambda b: (room[b][0], b))  # the fullest bins are filled first
    rank, g = {b: k for k, b in enumerate(gaps)}, 0
    for b in order:
        if rank[b] <= g:
            break
        todo = members.pop(b)
        out, back = [], []
        for d, at, n in todo:
            while n:
                while g < len(gaps) and (gaps[g] not in members or min(room[gaps[g]][0], room[gaps[g]][1], room[gaps[g]][2]) <= 0):
                    g += 1
                if g == len(gaps) or gaps[g] == b:
                    back.append((d, at, n))
                    break
                target = gaps[g]
                take = min(n, room[target][0], room[target][2])
                out.append(((d, at, take), target))
                room[target][0] -= take
                room[target][1] -= 1
                room[target][2] -= take - (at == 0)
                at, n = at + take, n - take
        for piece, target in out:
            members[target].append(piece)
        if back:
            members[b] = back
            break
    return [(piece, k) for k, b in enumerate(sorted(members)) for piece in members[b]]
