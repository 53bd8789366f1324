"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to six bytes with the counts of what
followed them in the training texts. A symbol is looked up in its longest known
context; what that context has not seen escapes to the next shorter one, in
which the symbols seen in the longer one are excluded. Escapes are estimated by
the share of distinct symbols (method D). Below the empty context all 256 bytes
and the end of text are equally likely.

A text is coded as its words in lower case, each closed by a blank, and an end
symbol. Contexts reach back over the words before (``across``): a portion of the
texts sends each of its distinct events once, with its trained count, and gets
their code lengths back. Without ``across``, contexts reach back to the blank
before the word only, so the code length of a word is the same wherever it
stands: each distinct word of the corpus is coded once. Texts are cut into
portions that number their distinct words, which are counted globally.

The trie is never in one place. Contexts of three bytes and more are dealt by
their last three bytes: a context, its longer ones and its shorter ones down to
three bytes share those, so their counts lie together. Contexts of up to two
bytes are common to all; there are at most 65,793, with 257 counts each.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage
from .bpe import from_varint, to_varint
from .words import groups, mixed, tidy

ORDER = 6
SHARED = 2
END = 256
SYMBOLS = 257
BLANK = 0x20
PORTION_BYTES = 16 << 20
PORTION_TEXTS = 50_000
WORDS = 200_000
BUCKETS = 1024
BLOCK = 1 << 20  # bytes of text whose events are in memory at once
HELD = 2_000_000  # events of blocks that wait for being added up
_BITS = 9  # of a symbol; a context of six bytes and its length stand above it
_CUT = 18  # bits of fraction that a sent code length lacks
_LEAST = 1023 - 50 << 52 - _CUT  # its exponents begin at 2^-50


def words_of(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


# --- events: a context and the symbol behind it ------------------------------------


def events_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Events of all words one after the other, and where each word's begin.

    An event is length of context << 57 | context << 9 | symbol; the last byte of
    the context is its lowest. Each word has an event a byte and one for the
    blank that closes it.
    """
    blob = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    begin = np.cumsum(sizes) - sizes
    depth = np.minimum(np.arange(len(blob) - 1) - np.repeat(begin, sizes) + 1, ORDER)
    context = np.zeros(len(blob) - 1, np.int64)
    for back in range(min(ORDER, len(context))):
        shifted = blob[: len(context) - back] << (8 * back)
        context[back:] |= np.where(depth[back:] > back, shifted, 0)
    return depth << (8 * ORDER + _BITS) | context << _BITS | blob[1:], begin


def events_of_texts(pieces: list[tuple[bytes, int, bool]], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Events of stretches of coded texts one after the other, and where each stretch's begin; contexts do not end at words.

    A stretch is its bytes, how many leading ones are context only, and whether
    its last byte stands for the end of the text.
    """
    sizes = np.fromiter((len(p[0]) for p in pieces), np.int64, len(pieces))
    lead = np.fromiter((p[1] for p in pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    blob = np.frombuffer(b"".join(p[0] for p in pieces), np.uint8).astype(np.int64)
    at = np.arange(len(blob)) - np.repeat(ends - sizes, sizes)
    events = np.zeros(len(blob), np.int64)
    for back in range(min(order, len(blob) - 1)):
        events[back + 1 :] |= blob[: -back - 1] << (8 * back + _BITS)
    near = np.flatnonzero(at < order)  # the bytes before these are in part those of another stretch
    events[near] &= (1 << (8 * at[near] + _BITS)) - 1
    events |= np.minimum(at, order) << (8 * ORDER + _BITS)
    blob[ends[[p[2] for p in pieces]] - 1] = END
    return (events | blob)[at >= np.repeat(lead, sizes)], np.cumsum(sizes - lead) - (sizes - lead)


def _decoded(coded: list[bytes], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, list[int]]]:
    """The numbers of some texts that follow each other, and where each text's begin, and the end."""
    low, size = 0, 0
    for high, codes in enumerate(coded, start=1):
        size += len(codes)
        if size >= most or high == len(coded):
            raw = b"".join(coded[low:high])
            upto = np.append(0, np.cumsum(np.frombuffer(raw, np.uint8) < 128))  # each number ends with such a byte
            yield from_varint(raw), upto[np.append(0, np.cumsum([len(c) for c in coded[low:high]]))].tolist()
            low, size = high, 0


def _texts(closed: pa.Array, coded: list[bytes]) -> Iterator[bytes]:
    """Each text as it is coded: a blank, its words out of ``closed``, which have a blank behind them, and a byte for its end."""
    for codes, begin in _decoded(coded):
        taken = closed.take(pa.array(codes))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(codes) + 1] if len(codes) else np.zeros(1, np.int64)
        data = taken.buffers()[2].to_pybytes() if len(codes) else b""
        for a, b in zip(begin, begin[1:], strict=False):
            yield b" " + data[ends[a] : ends[b]] + b"\0"


def _stretches(words: list[bytes], coded: list[bytes]) -> Iterator[tuple[list[int], list[tuple[bytes, int, bool]]]]:
    """Texts, given as numbers of ``words``, as blocks of stretches for :func:`events_of_texts`, with the place of each one's text."""
    places, pieces, size = [], [], 0
    closed = pa.array([w + b" " for w in words], pa.large_binary())
    for place, own in enumerate(_texts(closed, coded)):
        for low in range(0, len(own), BLOCK):
            piece = own[max(low - ORDER, 0) : low + BLOCK]
            places.append(place)
            pieces.append((piece, ORDER if low else 1, low + BLOCK >= len(own)))
            size += len(piece)
            if size >= BLOCK:
                yield places, pieces
                places, pieces, size = [], [], 0
    if pieces:
        yield places, pieces


def _length(events: np.ndarray) -> np.ndarray:
    return events >> (8 * ORDER + _BITS)


def _at_order(events: np.ndarray, order: int) -> np.ndarray:
    """Context cut to its last ``order`` bytes, and symbol."""
    return events & ((1 << (8 * order + _BITS)) - 1)


def buckets_of(events: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of the last three bytes of the context."""
    return (mixed((_at_order(events, SHARED + 1) >> _BITS).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def turned(events: np.ndarray) -> np.ndarray:
    """Events with the last three bytes of the context first, so that those of a bucket that follow each other are close numbers."""
    context, low = events >> _BITS, (1 << 24) - 1
    return (context & low) << 36 | (context >> 24 & low) << 12 | _length(events) << _BITS | events & ((1 << _BITS) - 1)


def turned_back(numbers: np.ndarray) -> np.ndarray:
    """The events of :func:`turned` numbers."""
    context = numbers >> 36 | (numbers >> 12 & ((1 << 24) - 1)) << 24
    return (numbers >> _BITS & 7) << (8 * ORDER + _BITS) | context << _BITS | numbers & ((1 << _BITS) - 1)


def packed(numbers: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """Numbers below 2^63, the first of which and the steps of which are not negative, in 7-bit groups, lowest first; in parts between ``cuts``."""
    n = numbers.astype(np.uint64)
    width = np.ones(len(n), np.int64)
    for k in range(1, 9):
        more = n >= np.uint64(1 << 7 * k)
        if not more.any():
            break
        width += more
    ends = np.append(0, np.cumsum(width))
    out = np.zeros(int(ends[-1]), np.uint8)
    has = np.arange(len(n))
    for k in range(int(width.max(initial=0))):
        has = has[width[has] > k]
        out[ends[has] + k] = (n[has] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | (width[has] > k + 1).astype(np.uint8) << 7
    data, stops = out.tobytes(), ends[cuts].tolist()
    return [data[a:b] for a, b in zip(stops, stops[1:], strict=False)]


def packed_events(numbers: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """:func:`turned` numbers, ascending between ``cuts``, as what each adds to the one before it."""
    steps = np.diff(numbers, prepend=0)
    steps[cuts[:-1]] = numbers[cuts[:-1]]
    return packed(steps, cuts)


def unpacked_events(data: list[bytes]) -> list[np.ndarray]:
    """The parts of :func:`packed_events`."""
    return [np.cumsum(from_varint(part)) for part in data]


def packed_lengths(log10p: np.ndarray) -> np.ndarray:
    """Code lengths in five bytes, a row each: 6 bits of exponent from 2^-50 on and 34 of fraction, so sums are right to 2^-35 of themselves."""
    bits = (0.0 - log10p).view(np.int64) + (1 << _CUT - 1)
    bits = np.maximum((bits >> _CUT) - _LEAST, 0)
    return bits.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5]


def unpacked_lengths(data: bytes) -> np.ndarray:
    """The logarithms of :func:`packed_lengths`."""
    bits = np.zeros((len(data) // 5, 8), np.uint8)
    bits[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    bits = bits.view("<i8").ravel()
    return np.where(bits > 0, -((bits + _LEAST) << _CUT).view(np.float64), 0.0)


def _by_bucket(events: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Events as :func:`turned` numbers, by bucket and number; their order, and where each bucket's begin, and the end."""
    numbers, own = turned(events), buckets_of(events, buckets)
    order = np.argsort(numbers)
    own = own[order]
    by = np.argsort(own.astype(np.uint16) if buckets <= 1 << 16 else own, kind="stable")  # 16 bits are sorted by radix
    order, own = order[by], own[by]
    return numbers[order], order, np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else np.zeros(0, np.int64)


# --- the trie -----------------------------------------------------------------------


class Level:
    """Contexts of one length: their symbols' counts, totals, distinct symbols, and how often the next shorter
    context was followed by one of these symbols (what its estimate excludes)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, below: Level | None):
        self.order, self.keys, self.counts = order, keys, counts
        context = keys >> _BITS
        new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.contexts = context[new]
        self.total = np.add.reduceat(counts, new) if len(new) else np.zeros(0, np.int64)
        self.distinct = np.diff(np.append(new, len(keys)))
        self.excluded = np.zeros(len(new), np.int64)
        if below is not None and len(new):
            self.excluded = np.add.reduceat(below.count(_at_order(keys, order - 1)), new)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _found(self.keys, self.counts, keys)


def _found(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Value of each key in a sorted table, 0 where it has none."""
    if not len(table):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0)


def levels_of(events: np.ndarray, counts: np.ndarray, orders, below: Level | None = None) -> list[Level]:
    """Levels of the given ascending orders from trained events."""
    out = []
    for order in orders:
        use = (_length(events) >= order) & (counts > 0)
        below = Level(*summed(_at_order(events[use], order), counts[use]), order, below)
        out.append(below)
    return out


def log10_probabilities(events: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Of each event, by ``levels`` of ascending order from 0 on."""
    out = np.zeros(len(events))
    symbol = events & ((1 << _BITS) - 1)
    length = _length(events)
    open_ = np.ones(len(events), bool)
    less, seen = np.zeros(len(events), np.int64), np.zeros(len(events), np.int64)  # what a longer context excludes
    for level in reversed(levels):
        if not len(level.contexts):
            continue
        at = np.flatnonzero(open_ & (length >= level.order))
        key = _at_order(events[at], level.order)
        where = np.minimum(np.searchsorted(level.contexts, key >> _BITS), len(level.contexts) - 1)
        known = level.contexts[where] == key >> _BITS
        at, key, where = at[known], key[known], where[known]
        n, d = level.total[where] - less[at], level.distinct[where] - seen[at]
        c = level.count(key)
        hit = c > 0
        out[at[hit]] += np.log10((2 * c[hit] - 1) / (2 * n[hit]))
        open_[at[hit]] = False
        miss = ~hit & (n > 0)
        out[at[miss]] += np.log10(d[miss] / (2 * n[miss]))
        less[at], seen[at] = level.excluded[where], level.distinct[where]
    rest = np.flatnonzero(open_)
    out[rest] -= np.log10(SYMBOLS - seen[rest])
    return out


# --- Spark --------------------------------------------------------------------------

_PORTION = "portion long, docs array<struct<doc_id:long,held_out:boolean,codes:binary>>, words array<struct<word:binary,times:long>>"


def _portions(df: DataFrame) -> DataFrame:
    """Texts as numbers of words, a row per portion, with the portion's distinct words and how often they are trained."""
    word = pa.struct([("word", pa.binary()), ("times", pa.int64())])
    doc = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("codes", pa.binary())])
    schema = pa.schema([("portion", pa.int64()), ("docs", pa.list_(doc)), ("words", pa.list_(word))])

    @tidy
    def cut(batches):
        count, docs, known, times, size = 0, [], {}, [], 0

        def portion():
            name = TaskContext.get().partitionId() << 32 | count
            found = pa.StructArray.from_arrays([pa.array(list(known), pa.binary()), pa.array(times, pa.int64())], fields=list(word))
            listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (pa.array(docs, doc), found)]
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *listed], schema=schema)

        for batch in batches:
            for i, text, held in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw = words_of(text.as_py())
                codes = np.fromiter([known.setdefault(w, len(known)) for w in raw], np.int64, len(raw))
                times.extend([0] * (len(known) - len(times)))
                if not held.as_py():
                    for c in codes.tolist():
                        times[c] += 1
                docs.append({"doc_id": i.as_py(), "held_out": held.as_py(), "codes": to_varint(codes)})
                size += sum(map(len, raw))
                if size >= PORTION_BYTES or len(docs) >= PORTION_TEXTS:
                    yield portion()
                    count, docs, known, times, size = count + 1, [], {}, [], 0
        if docs:
            yield portion()

    return df.mapInArrow(cut, _PORTION)


def _words_by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and their order by bucket."""
    own = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    return own, np.argsort(own, kind="stable")


def _word_counts(portions: DataFrame, buckets: int) -> DataFrame:
    """portion, bucket, times of the portion's words in the order of :func:`_words_by_bucket` over all portions; trained, kinds: of the bucket, on one of its rows.

    The words of a portion go as one row a bucket, and their counts come back as one.
    """
    sent = pa.schema([("bucket", pa.int64()), ("portion", pa.int64()), ("words", pa.list_(pa.binary())), ("times", pa.binary())])
    back = pa.schema([("portion", pa.int64()), ("bucket", pa.int64()), ("times", pa.binary()), ("trained", pa.int64()), ("kinds", pa.int64())])

    @tidy
    def deal(batches):
        for batch in batches:
            for name, listed in zip(batch.column(0), batch.column(1), strict=True):
                if not len(listed.values):
                    continue
                words, times = (listed.values.field(c) for c in ("word", "times"))
                own, order = _words_by_bucket(words.to_pylist(), buckets)
                cuts = np.append(np.flatnonzero(np.diff(own[order], prepend=-1)), len(order))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[order[cuts[:-1]]]), pa.array(np.full(len(cuts) - 1, name.as_py())), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.take(pa.array(order))),
                     pa.array(packed(times.to_numpy()[order], cuts), pa.binary())], schema=sent)

    @tidy
    def count(batches):
        for table in groups(batches, 1):
            listed = table.column("words").combine_chunks()
            code = listed.flatten().dictionary_encode().indices.to_numpy()
            total = np.zeros(int(code.max()) + 1, np.int64)
            np.add.at(total, code, np.concatenate([from_varint(x) for x in table.column("times").to_pylist()]))
            cuts = np.append(0, np.cumsum(listed.value_lengths().to_numpy()))
            once = np.zeros((2, len(listed)), np.int64)
            once[:, 0] = total.sum(), np.count_nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks() for c in ("portion", "bucket")), pa.array(packed(total[code], cuts), pa.binary()), *map(pa.array, once)], schema=back)

    dealt = portions.select("portion", "words").mapInArrow(deal, "bucket long, portion long, words array<binary>, times binary")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "portion").mapInArrow(count, "portion long, bucket long, times binary, trained long, kinds long")


def _word_batches(words: DataFrame) -> DataFrame:
    """Distinct words in numbered batches: batch, words, times; written once, so that both reads see the same batches."""
    schema = pa.schema([("batch", pa.int64()), ("words", pa.list_(pa.binary())), ("times", pa.binary())])

    @tidy
    def pack(batches):
        count, names, times = 0, [], []

        def packed():
            name = TaskContext.get().partitionId() << 32 | count
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([names], pa.list_(pa.binary())), pa.array([np.array(times, np.int64).tobytes()])], schema=schema)

        for batch in batches:
            names += batch.column(0).to_pylist()
            times += batch.column(1).to_pylist()
            if len(names) >= WORDS:
                yield packed()
                count, names, times = count + 1, [], []
        if names:
            yield packed()

    return words.mapInArrow(pack, "batch long, words array<binary>, times binary")


def _unpacked(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each batch of words: its name, distinct events, their trained counts, and the place of each event of each word."""
    for part in batches:
        for name, words, times in zip(*(part.column(k) for k in range(3)), strict=True):
            listed, n = words.as_py(), np.frombuffer(times.as_py(), np.int64)
            events, begin = events_of(listed)
            each = np.repeat(n, np.diff(np.append(begin, len(events))))
            order = np.argsort(events, kind="stable")
            new = np.concatenate([[True], events[order][1:] != events[order][:-1]])
            place = np.empty(len(events), np.int64)
            place[order] = np.cumsum(new) - 1
            yield name.as_py(), events[order][new], np.add.reduceat(each[order], np.flatnonzero(new)), place


def _portion_events(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, None]]:
    """Of each portion of texts: its name, distinct events and their trained counts."""
    for batch in batches:
        for name, docs, words in zip(*(batch.column(k) for k in range(3)), strict=True):
            held, coded = docs.values.field("held_out").to_numpy(zero_copy_only=False), docs.values.field("codes").to_pylist()
            parts: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            for places, pieces in _stretches(words.values.field("word").to_pylist(), coded):
                events, begin = events_of_texts(pieces)
                trained = np.repeat(~held[places].astype(bool), np.diff(np.append(begin, len(events))))
                for own, weight in ((events[trained], 1), (events[~trained], 0)):
                    own = np.sort(own)
                    new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
                    parts.append((own[new], np.diff(np.append(new, len(own))) * weight))
                    size += len(new)
                if size > HELD and len(parts) > 8:
                    parts, size = [summed(*map(np.concatenate, zip(*parts, strict=True)))], 0
            yield name.as_py(), *summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])), None


def _portion_grams(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, None]]:
    """The trained events of each portion with contexts of up to ``SHARED`` bytes; these fit in 32 bits."""
    for batch in batches:
        for name, docs, words in zip(*(batch.column(k) for k in range(3)), strict=True):
            held, coded = docs.values.field("held_out").to_pylist(), docs.values.field("codes").to_pylist()
            coded = [c for c, out in zip(coded, held, strict=True) if not out]
            for _, pieces in _stretches(words.values.field("word").to_pylist(), coded):
                events = events_of_texts(pieces, SHARED)[0]
                grams = np.sort((_length(events) << (8 * SHARED + _BITS) | _at_order(events, SHARED)).astype(np.int32))
                new = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
                kinds, counts = grams[new].astype(np.int64), np.diff(np.append(new, len(grams)))
                low = kinds & ((1 << (8 * SHARED + _BITS)) - 1)
                yield name.as_py(), (kinds >> (8 * SHARED + _BITS)) << (8 * ORDER + _BITS) | low, counts, None


def _shared_levels(rows: DataFrame, ends: int, unpacked=_unpacked) -> list[Level]:
    """Levels of orders 0 to 2, with ``ends`` ends of text behind a blank; their number of counts is bounded by the alphabet."""
    def count(batches):
        found: dict[int, list] = {k: [] for k in range(SHARED + 1)}
        for _, events, counts, _ in unpacked(batches):
            for order in found:
                use = (_length(events) >= order) & (counts > 0)
                found[order].append(summed(_at_order(events[use], order), counts[use]))
        for order, parts in found.items():
            if parts:
                keys, counts = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), order)), pa.array(keys), pa.array(counts)], names=["level", "event", "n"])

    rows = rows.mapInArrow(count, "level long, event long, n long").groupBy("level", "event").agg(F.sum("n").alias("n")).collect()
    out: list[Level] = []
    for order in range(SHARED + 1):
        keys = [r["event"] for r in rows if r["level"] == order]
        counts = [r["n"] for r in rows if r["level"] == order]
        if ends and order < 2:
            keys.append((BLANK << _BITS | END) if order else END)
            counts.append(ends)
        out.append(Level(*summed(np.array(keys, np.int64), np.array(counts, np.int64)), order, out[-1] if out else None))
    return out


def _dealt(rows: DataFrame, buckets: int, unpacked=_unpacked) -> DataFrame:
    """bucket, batch, events, counts: the distinct events of each batch, by the last three bytes of their contexts."""
    sent = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("events", pa.binary()), ("counts", pa.binary())])

    @tidy
    def deal(batches):
        for name, events, counts, _ in unpacked(batches):
            numbers, order, cuts = _by_bucket(events, buckets)
            own = buckets_of(events[order[cuts[:-1]]], buckets)
            listed = packed_events(numbers, cuts), packed(counts[order], cuts)
            for a in range(0, len(own), 64):
                part = slice(a, a + 64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[part]), pa.array(np.full(len(own[part]), name)), *(pa.array(x[part], pa.binary()) for x in listed)], schema=sent)

    return rows.mapInArrow(deal, "bucket long, batch long, events binary, counts binary")


def _code_lengths(dealt: DataFrame, shared) -> DataFrame:
    """batch, bucket, events, lengths of all dealt events; the counts of a bucket's batches are added up first."""
    back = pa.schema([("batch", pa.int64()), ("bucket", pa.int64()), ("events", pa.binary()), ("lengths", pa.binary())])

    @tidy
    def code(batches):
        low = shared.value
        for table in groups(batches, 1):
            parts = unpacked_events(table.column("events").to_pylist())
            numbers, n = summed(np.concatenate(parts), np.concatenate([from_varint(x) for x in table.column("counts").to_pylist()]))
            events = turned_back(numbers)
            found = packed_lengths(log10_probabilities(events, [*low, *levels_of(events, n, range(SHARED + 1, ORDER + 1), low[-1])]))
            for a in range(0, len(parts), 64):
                own = parts[a : a + 64]
                yield pa.RecordBatch.from_arrays(
                    [*(table.column(c).slice(a, 64).combine_chunks() for c in ("batch", "bucket", "events")),
                     pa.array([found[np.searchsorted(numbers, p)].tobytes() for p in own], pa.binary())], schema=back)

    return dealt.repartition("bucket").sortWithinPartitions("bucket", "batch").mapInArrow(code, "batch long, bucket long, events binary, lengths binary")


def _code_lengths_of(coded: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct events of a batch, ascending, and their code lengths, from its rows of :func:`_code_lengths`."""
    parts = unpacked_events(coded.column("events").to_pylist())
    events = turned_back(np.concatenate([np.zeros(0, np.int64), *parts]))
    order = np.argsort(events)
    return events[order], unpacked_lengths(b"".join(coded.column("lengths").to_pylist()))[order]


def _coded(words: DataFrame, shared, buckets: int) -> DataFrame:
    """word, times, log10p of every word of the batches."""
    done = pa.schema([("word", pa.binary()), ("times", pa.int64()), ("log10p", pa.float64())])

    def gather(own: pa.Table, coded: pa.Table) -> pa.Table:
        out = []
        for part in own.to_batches():
            for row, (_, found, _, place) in enumerate(_unpacked([part])):
                events, value = _code_lengths_of(coded)
                if not np.array_equal(events, found):
                    raise RuntimeError("a batch of words changed")
                listed = part.column("words")[row].as_py()
                sizes = np.fromiter(map(len, listed), np.int64, len(listed)) + 1
                total = np.add.reduceat(value[place], np.cumsum(sizes) - sizes)
                out.append(pa.Table.from_arrays([pa.array(listed, pa.binary()), pa.array(np.frombuffer(part.column("times")[row].as_py(), np.int64)), pa.array(total)], schema=done))
        return pa.concat_tables(out) if out else done.empty_table()

    coded = _code_lengths(_dealt(words, buckets), shared)
    return words.groupBy("batch").cogroup(coded.groupBy("batch")).applyInArrow(gather, "word binary, times long, log10p double")


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, across: bool = False) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all rows that are not ``held_out`` (NULL: learns) and
    scores every row. ``score`` is the log10 probability of the text: of its
    lower-case words in their order and of its end; a symbol's context is what
    stands before it in the text if ``across``, else in its word. ``base_score`` is that of a
    unigram model of words with half a count added; tokens are words and one end.
    A NULL text is empty and has the end only; rows that repeat others count each.
    Without training rows all symbols are equally likely.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.coalesce(held_out, F.lit(False)).alias("held_out"))
    portions = stage(_portions(docs), "portions")
    ends = portions.select(F.size(F.filter("docs", lambda d: ~d["held_out"])).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if across:
        shared = spark.sparkContext.broadcast(_shared_levels(portions, 0, _portion_grams))
        lengths = _code_lengths(_dealt(portions, buckets, _portion_events), shared)
        coded = stage(_word_counts(portions, buckets), "word_counts")
        trained, distinct = coded.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    else:
        spots = portions.select("portion", F.posexplode("words").alias("number", "own")).select("portion", "number", "own.word", "own.times")
        counted = spots.groupBy("word").agg(F.sum("times").alias("times"))
        words = stage(_word_batches(counted), "word_batches")
        levels = _shared_levels(words, ends)
        shared = spark.sparkContext.broadcast(levels)
        coded = stage(_coded(words, shared, buckets), "coded_words")
        end = float(log10_probabilities(np.array([1 << (8 * ORDER + _BITS) | BLANK << _BITS | END]), levels)[0])
        trained, distinct = coded.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count_if(F.col("times") > 0)).first()
    tokens, kinds = trained + ends, distinct + bool(ends)
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def base(times):
        return np.log10((times + 0.5) / (tokens + 0.5 * (kinds + 1)))

    def total(own: pa.Table, known: pa.Table) -> pa.Table:
        if across:
            sent, known = known.filter(pc.is_valid(known.column("lengths"))), known.filter(pc.is_null(known.column("lengths"))).sort_by("bucket")
            words = own.column("words")[0].values.field("word").to_pylist()
            times = np.zeros(len(words), np.int64)
            times[_words_by_bucket(words, buckets)[1]] = from_varint(b"".join(known.column("times").to_pylist()))
        else:
            number = known.column("number").to_numpy()
            times, bits = np.zeros(len(number), np.int64), np.zeros(len(number))
            times[number], bits[number] = known.column("times").to_numpy(), known.column("log10p").to_numpy()
        unigram, rows = base(times), []
        for group in own.column("docs"):
            coded = group.values.field("codes").to_pylist()
            names, held = (group.values.field(c).to_pylist() for c in ("doc_id", "held_out"))
            scores = iter(text_scores(words, coded, sent)) if across else None
            each = (codes[a:b] for codes, begin in _decoded(coded) for a, b in zip(begin, begin[1:], strict=False))
            for name, out_, codes in zip(names, held, each, strict=True):
                rows.append((name, out_, len(codes) + 1, int(np.count_nonzero(times[codes])) + bool(ends), tokens,
                             math.fsum([unigram[codes].sum(), base(ends)]), next(scores) if across else float(bits[codes].sum() + end)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    if across:
        known = coded.select(F.col("portion").alias("home"), "bucket", "times").unionByName(
            lengths.select(F.col("batch").alias("home"), "bucket", "events", "lengths"), allowMissingColumns=True)
    else:
        known = spots.select(F.col("portion").alias("home"), "number", "word").join(coded, "word").select("home", "number", "times", "log10p")
    return portions.select("portion", "docs", *["words"] * across).groupBy("portion").cogroup(known.groupBy("home")).applyInArrow(
        total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def text_scores(words: list[bytes], coded: list[bytes], sent: pa.Table) -> list[float]:
    """Log10 probabilities of the texts of a portion, given as numbers of ``words``, from the code lengths of its events."""
    out = np.zeros(len(coded))
    events, value = _code_lengths_of(sent)
    for places, pieces in _stretches(words, coded):
        own, begin = events_of_texts(pieces)
        order = np.argsort(own)
        ranked = own[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        distinct = ranked[new]
        at = np.minimum(np.searchsorted(events, distinct), max(len(events) - 1, 0))
        if not len(events) or (events[at] != distinct).any():
            raise RuntimeError("a portion of texts changed")
        found = np.empty(len(own))
        found[order] = np.repeat(value[at], np.diff(np.append(np.flatnonzero(new), len(own))))
        np.add.at(out, places, np.add.reduceat(found, begin))
    return out.tolist()
