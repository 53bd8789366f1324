"""Passages that repeat, exactly or nearly, across documents, found by compact windows.

Tokens are five-word shingles. Under one hash function the smallest token of a
stretch splits it in two, and so on: the Cartesian tree of the token hashes. A
node is a compact window (l, c, r): every passage from l..c to c..r has its
MinHash at c. Windows shorter than the shortest passage are cut off, which
leaves about two per that many words. A document that shares the signature of
a window is compared whole with the first document that has it: equal runs of
tokens are chained, so every copy of a passage is found, and the stretches of a
chain are verified by their shingle sets.

Where no passage found covers the place of a signature, the other earlier
documents that have it are gone through, smallest first, until one does. They
meet in blocks with all documents of the same first one, and only those are
compared whole of whose tokens the place has enough around it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import release, stage
from .words import SHINGLE, Hasher, free_names, groups, mixed, portions, remembered, split_words, tidy, word_spans

WORDS = 50
CONTEXT = 4
BLOCK = 2 << 20  # characters of text on either side that meet in one task where the first document has not got the passage
RECALL = 0.998
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def hashes_for(similarity: float, recall: float) -> int:
    """Hash functions after which two passages at the similarity share the MinHash token of one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


HASHES = hashes_for(0.8, RECALL)


def compact_windows(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (l, c, r), r exclusive, of at least ``least`` tokens, of each stretch starts..ends; ties go to the left.

    One level of all Cartesian trees is split at a time.
    """
    n = len(hashes)
    ranked = np.empty(n + 1, np.uint64)
    # the upper bits decide, the position settles ties and tells the place of the smallest
    ranked[:n] = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
    ranked[n] = np.uint64(0xFFFFFFFFFFFFFFFF)
    found = []
    big = ends - starts >= least
    starts, ends = starts[big], ends[big]
    places = starts  # of the stretches in ``ranked``, which shrinks to what is left
    while len(starts):
        size = ends - starts
        total = int(size.sum())
        if 2 * total < len(ranked):
            upto = np.cumsum(size) - size
            ranked = np.append(ranked[np.repeat(places - upto, size) + np.arange(total)], ranked[-1])
            places = upto
        cuts = np.empty(2 * len(starts), np.int64)
        cuts[0::2], cuts[1::2] = places, places + size
        center = (np.minimum.reduceat(ranked, cuts)[0::2] & np.uint64((1 << 24) - 1)).astype(np.int64)
        found.append((starts, center, ends))
        new_starts, new_ends, new_places = np.empty_like(cuts), np.empty_like(cuts), np.empty_like(cuts)
        new_starts[0::2], new_starts[1::2] = starts, center + 1
        new_ends[0::2], new_ends[1::2] = center, ends
        new_places[0::2], new_places[1::2] = places, places + (center + 1 - starts)
        big = new_ends - new_starts >= least
        starts, ends, places = new_starts[big], new_ends[big], new_places[big]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def _doubled(tokens: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """Hash of the run of tokens from each place on, as long as the largest power of two up to ``length``, and that power."""
    size = 1
    while 2 * size <= length and len(tokens) > size:
        tokens = (tokens[:-size] ^ (tokens[size:] >> np.uint64(31)) ^ np.uint64(size)) * _GOLD + tokens[size:]
        size *= 2
    return tokens, size


def _extents(least: int, context: int) -> list[int]:
    """Tokens that a signature stands for, of both kinds."""
    return [min(n, least // 2) + 1 for n in (2 * context, least // 2)]


def _windows(docs: DataFrame, words: int, hashes: int, context: int, batch_tokens: int = 1 << 18) -> DataFrame:
    """key, doc_id, place: the signatures of each document's windows, once at each place.

    ``place`` is twice the first token of the signature's extent, plus its kind.

    A signature is the MinHash token with the 2 x ``context`` tokens on one
    side, so that a short line that thousands of documents share does not bring
    them together; an edit on the other side, or the edge of a window, leaves
    it. So that documents which share a passage are not parted by an earlier one
    that has only a sentence of it, the token stands with half a shortest
    passage on either side too; a window holds one of the two.
    """
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])
    least, stretch = words - SHINGLE + 1, 1 << 23
    seeds = mixed(np.arange(71, 71 + hashes, dtype=np.uint64))
    lengths = _extents(least, context)

    def emit(ids: list[int], parts: list[np.ndarray], offsets: list[int]):
        tokens = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        doc, offset = np.array(ids, np.int64), np.array(offsets, np.int64)
        centers, keys, kinds = [], [], []
        doubled = [_doubled(tokens, length) for length in lengths]
        for seed in seeds:
            left, center, right = compact_windows(mixed(tokens ^ seed), starts, ends, least)
            for kind, ((runs, size), length) in enumerate(zip(doubled, lengths, strict=True)):
                for at in (center[right - center >= length], center[center - left >= length - 1] - length + 1):
                    centers.append(at)
                    keys.append(mixed(runs[at] + mixed(runs[at + length - size])))
                    kinds.append(np.full(len(at), kind, np.int64))
        at, key, kind = np.concatenate(centers), np.concatenate(keys), np.concatenate(kinds)
        owner = np.searchsorted(ends, at, side="right")
        place = 2 * (at - starts[owner] + offset[owner]) + kind
        tag = 2 * at + kind  # each place once
        order = np.argsort(tag)
        first = np.ones(len(order), bool)
        first[1:] = np.diff(tag[order]) != 0
        kept = order[first]
        kept = kept[np.argsort(owner[kept], kind="stable")]
        columns = [key[kept].view(np.int64), doc[owner[kept]], place[kept].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    @tidy
    def windows(batches):
        hasher, held, size = remembered("hashes", Hasher), ([], [], []), 0
        for batch in (part for whole in batches for part in portions(whole)):
            listed = [split_words(t) for t in batch.column(1).to_pylist()]
            for i, tokens in zip(batch.column(0).to_pylist(), hasher.shingles_of(listed), strict=True):
                if i is None or len(tokens) < least:
                    continue
                # places in a batch have 24 bits: a longer text goes in stretches that overlap by a passage
                for at in range(0, max(1, len(tokens) - least + 1), stretch - least + 1):
                    part = tokens[at : at + stretch]
                    if size + len(part) > stretch or size >= batch_tokens:
                        yield from emit(*held)
                        held, size = ([], [], []), 0
                    for column, value in zip(held, (i, part, at), strict=True):
                        column.append(value)
                    size += len(part)
        if size:
            yield from emit(*held)

    return docs.mapInArrow(windows, "key long, doc_id long, place int")


def _folded(tokens: np.ndarray, order: np.ndarray, longest: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, first place and place behind the last, where a stretch that repeats every few tokens stands as one period.

    Passages are compared as sets, so a period counts once; it begins with its
    smallest token, and each of its tokens has the places of the whole stretch.
    Of a period of more than ``longest`` tokens that comes three times or more,
    two stay, so that one period is in them wherever it begins. ``order`` sorts
    the tokens stably.
    """
    n = len(tokens)
    places = np.arange(n)
    before = np.full(n, -1, np.int64)
    again = np.flatnonzero(tokens[order[1:]] == tokens[order[:-1]])
    before[order[again + 1]] = order[again]
    period = np.where(before >= 0, places - before, 0)
    if not period.any():
        return tokens, places, places + 1
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(period)) + 1, [n]])
    long = np.flatnonzero((period[cuts[:-1]] > 0) & (np.diff(cuts) >= period[cuts[:-1]]))
    keep, begin, end, out = np.ones(n, bool), places.copy(), places + 1, tokens
    upto = 0
    for u, v, p in zip(cuts[long].tolist(), cuts[long + 1].tolist(), period[cuts[long]].tolist(), strict=True):
        s = max(u - p, upto)
        left = p if p <= longest else 2 * p
        if v - s < left + p:
            continue
        if out is tokens:
            out = tokens.copy()
        if p <= longest:
            out[s : s + p] = np.roll(tokens[s : s + p], -int(np.argmin(tokens[s : s + p])))
        begin[s : s + left], end[s : s + left] = s, v
        keep[s + left : v] = False
        upto = v
    return out[keep], begin[keep], end[keep]


class Sequence:
    """The tokens of a document, folded and sorted for comparisons."""

    def __init__(self, tokens: np.ndarray):
        self.tokens = tokens
        order = np.argsort(tokens, kind="stable")
        self.folded, self.begin, self.end = _folded(tokens, order)
        self.by = order if self.folded is tokens else np.argsort(self.folded, kind="stable")
        self.ranked = self.folded[self.by]


def _equal_runs(a: Sequence, b: Sequence, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All longest runs of equal folded tokens: place in a, place in b, length, by their place in b; and how many of b are in a.

    None if fewer than ``least`` tokens of b are in a.
    """
    none = (np.zeros(0, np.int64),) * 3 + (0,)
    if not len(a.ranked):
        return none
    low = np.searchsorted(a.ranked, b.folded)
    at = np.flatnonzero(a.ranked[np.minimum(low, len(a.ranked) - 1)] == b.folded)
    if (b.end[at] - b.begin[at]).sum() < least:
        return none
    low = low[at]
    many = np.searchsorted(a.ranked, b.folded[at], "right") - low
    j = np.repeat(at, many)
    i = a.by[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(j))]
    order = np.lexsort((j, i - j))
    i, j = i[order], j[order]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(i - j) != 0) | (np.diff(j) != 1)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(i)))
    order = np.lexsort((i[start], j[start]))
    return i[start][order], j[start][order], length[order], len(at)


def _firsts(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens, ascending, and the first place of each."""
    return np.unique(tokens, return_index=True)


def _similarities(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets of a[:x] and b[:y] for all pairs of ends (x, y), which ascend together; one pass over a and b."""
    (own, i), (other, j) = _firsts(a[: a_ends[-1]]), _firsts(b[: b_ends[-1]])
    both, x, y = np.intersect1d(own, other, assume_unique=True, return_indices=True)
    # a shared token counts from the pair on in which both have it
    since = np.maximum(np.searchsorted(a_ends, i[x], "right"), np.searchsorted(b_ends, j[y], "right"))
    shared = np.cumsum(np.bincount(since, minlength=len(a_ends))[: len(a_ends)])
    size = np.searchsorted(np.sort(i), a_ends) + np.searchsorted(np.sort(j), b_ends)
    return shared / (size - shared)


def _chains(i: np.ndarray, j: np.ndarray, length: np.ndarray, similarity: float, gap: int) -> list[list[int]]:
    """Runs that follow each other in both documents with at most ``gap`` tokens between them, best chains first.

    Each run goes on from the one before it that leaves the most similarity; a
    chain is no passage yet, as not all of its stretches are similar enough.
    """
    n = len(i)
    i_end, j_end = i + length, j + length
    score, link, last = (1 - similarity) * length, np.full(n, -1, np.int64), np.ones(n, bool)
    reach = np.maximum.accumulate(j_end) if n else j_end
    for low in range(0, n, 64):
        r = slice(low, min(low + 64, n))
        q = slice(int(np.searchsorted(reach[:low], j[low] - gap, "left")), r.stop)
        over = np.maximum(np.maximum(i_end[None, q] - i[r, None], j_end[None, q] - j[r, None]), 0)
        apart = (i[r, None] + over - i_end[None, q]) + (j[r, None] + over - j_end[None, q])
        fits = (i[None, q] < i[r, None]) & (j[None, q] < j[r, None]) & (over < length[r, None]) & (apart <= gap)
        loss = np.where(fits, similarity * apart + (1 - similarity) * over, np.inf)
        for k in np.flatnonzero(fits.any(axis=1)).tolist():
            value = score[q] - loss[k]
            best = int(value.argmax())
            link[low + k] = best + q.start
            score[low + k] += max(0.0, float(value[best]))
            last[best + q.start] = False
    chains = []
    for r in sorted(np.flatnonzero(last).tolist(), key=lambda r: (-score[r], r)):
        chain = [r]
        while link[chain[-1]] >= 0:
            chain.append(int(link[chain[-1]]))
        chains.append(chain[::-1])
    return chains


class _Chain:
    """Equal runs that follow each other, without overlap: their places in one (p, q) and two (s, e), ends exclusive."""

    def __init__(self, c: np.ndarray, i: np.ndarray, j: np.ndarray, length: np.ndarray, one: Sequence, two: Sequence, similarity: float):
        over = np.maximum(np.maximum(i[c[:-1]] + length[c[:-1]] - i[c[1:]], j[c[:-1]] + length[c[:-1]] - j[c[1:]]), 0)
        x, y, size = i[c], j[c], length[c].copy()
        x[1:], y[1:], size[1:] = x[1:] + over, y[1:] + over, size[1:] - over
        apart = np.append(0, (x[1:] - x[:-1] - size[:-1]) + (y[1:] - y[:-1] - size[:-1]))
        self.p, self.q, self.s, self.e = one.begin[x], one.end[x + size - 1], two.begin[y], two.end[y + size - 1]
        # a stretch of runs l..r holds the similarity if upto[r] >= down[l]
        self.upto = np.cumsum((1 - similarity) * size - similarity * apart)
        self.down = self.upto - (1 - similarity) * size

    def worth(self, low: int, high: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs of low..high from which a stretch may be a passage, the longest first, and the last run of the longest from each run on."""
        best = np.maximum.accumulate(self.upto[low:high][::-1])[::-1]
        far = low + np.searchsorted(-best, 1e-9 - self.down[low:high], "right") - 1
        from_ = np.arange(low, high)
        wide = self.e[far] - self.s[from_]
        some = np.flatnonzero((far >= from_) & (wide >= least) & (self.q[far] - self.p[from_] >= least))
        some = some[np.argsort(-wide[some], kind="stable")]
        return from_[some], far[some]


def aligned(one: Sequence, two: Sequence, least: int, similarity: float, known: np.ndarray | None = None) -> list[tuple[int, int, int, int, float]]:
    """Passages of two that one has too: start and end in one, start and end in two, similarity; ends exclusive.

    A passage begins and ends with equal tokens. Along each chain of equal runs
    the longest stretch that holds the similarity as a whole is taken, then what
    is left on both sides of it. ``known`` is the end of the farthest known
    passage of two from any place up to each on: if all that is to be found lies
    inside known passages, none is returned.
    """
    i, j, length, many = _equal_runs(one, two, similarity * least)
    if not many:
        return []
    # no passage bears more different tokens than this share of the equal ones
    gap = int(many * (1 - similarity) / similarity + 1e-9)
    a, b = one.tokens, two.tokens
    chains, new = [], known is None
    for chain in _chains(i, j, length, similarity, gap):
        place = slice(int(two.begin[j[chain[0]]]), int(two.end[j[chain[-1]] + length[chain[-1]] - 1]))
        if place.stop - place.start < least:
            continue
        c = _Chain(np.array(chain), i, j, length, one, two, similarity)
        chains.append((place, len(chain), c))
        if not new:
            l, r = c.worth(0, len(chain), least)
            new = bool((known[c.s[l]] < c.e[r]).any())
    if not new:
        return []
    out: list[tuple[int, int, int, int, float]] = []
    covered = np.zeros(len(b), bool)  # a chain whose place in two is in found passages has nothing to add
    for place, runs, c in chains:
        if covered[place].all():
            continue
        p, q, s, e, upto, down = c.p, c.q, c.s, c.e, c.upto, c.down
        todo = [(0, runs)]
        while todo:
            low, high = todo.pop()
            found = None
            for l, r in zip(*(x.tolist() for x in c.worth(low, high, least)), strict=True):
                # all stretches from l on that are long enough and hold the similarity along the chain, longest last
                ends = np.arange(l, r + 1)
                ends = ends[np.minimum(q[ends] - p[l], e[ends] - s[l]) >= least]
                value = _similarities(a[p[l] :], b[s[l] :], q[ends] - p[l], e[ends] - s[l])
                good = np.flatnonzero((value >= similarity) & (upto[ends] >= down[l] - 1e-9))
                if len(good):
                    found = (l, int(ends[good[-1]]), float(value[good[-1]]))
                    break
            if found:
                l, r, value = found
                if not any(o[2] <= s[l] and e[r] <= o[3] for o in out):
                    out.append((int(p[l]), int(q[r]), int(s[l]), int(e[r]), value))
                    covered[s[l] : e[r]] = True
                todo += [(u, v) for u, v in ((low, l), (r + 1, high)) if v > u]
    return out


SPANS = ("doc_id long, start_word long, end_word long, start_char long, end_char long, first_doc_id long, "
         "first_start_word long, first_end_word long, similarity double")


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = 0.8,
                      hashes: int = HASHES, agree: int = 1, context: int = CONTEXT) -> DataFrame:
    """Passages of ``words`` words or more that an earlier document has too, one row each (columns ``SPANS``).

    Earlier means a smaller id. Words are those of :func:`split_words`; two
    passages repeat if their sets of five-word shingles have a Jaccard
    similarity of ``similarity`` or more. Overlapping passages of a document are
    one row, with the passage of the smallest first document. Repeats inside one
    document are none. NULL ids and texts, and texts of fewer words, have no row;
    rows that repeat an id have to repeat the text.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    windows = stage(_windows(docs, words, hashes, context), "windows")
    first = windows.groupBy("key").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    first = stage(first.filter("first_doc_id < last").drop("last"), "first_windows")  # both sides of the join are then plain shuffles, which split a hot signature
    shared = stage(windows.join(first, "key"), "shared_windows")
    release(windows)
    release(first)
    links = shared.filter("doc_id <> first_doc_id")
    links = links.groupBy("doc_id", "first_doc_id", "key").agg(F.count(F.lit(1)).alias("places")) if agree > 1 else links
    pairs = links.groupBy("doc_id", "first_doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= agree).drop("n")
    pairs = stage(pairs, "window_pairs")  # what found them can go before texts are joined
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    least, lengths = words - SHINGLE + 1, _extents(words - SHINGLE + 1, context)
    found = stage(_compared(pairs, texts, least, similarity), "pair_passages")
    # a signature of two rows is done; of more, the places that no passage covers go on
    members = shared.filter("n > 2 AND doc_id <> first_doc_id").drop("n")
    members = stage(_with_open(members, found, lengths), "window_members")
    release(shared)
    more = stage(_gone_on(members, texts, least, similarity, lengths, agree), "later_passages")
    release(members)
    return _merged(found.unionByName(more))


def _with_open(members: DataFrame, found: DataFrame, lengths: list[int]) -> DataFrame:
    """``members`` (key, doc_id, place, first_doc_id) with ``open``: no passage of ``found`` covers the extent."""
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    at, kind = F.floor(F.col("place") / 2), F.col("place") % 2
    end = at + F.when(kind == 1, lengths[1]).otherwise(lengths[0]) + SHINGLE - 1
    inside = F.exists("spans", lambda s: (s["start_word"] <= at) & (s["end_word"] >= end))
    return members.join(spans, "doc_id", "left").withColumn("open", ~F.coalesce(inside, F.lit(False))).drop("spans")


def _bearing(shared: np.ndarray, again: np.ndarray, least: int, similarity: float) -> np.ndarray:
    """End of the farthest stretch from any place up to each on that may be a passage, 0 if there is none.

    Such a stretch begins and ends with shared tokens, and of its tokens at
    least the share ``similarity`` is shared; those that stood before
    (``again``) are not held against it, as passages are sets.
    """
    n = len(shared)
    score = np.concatenate([[0.0], (1 - similarity) * np.cumsum(shared) - similarity * np.cumsum(~(shared | again))])
    best = np.maximum.accumulate(score[::-1])[::-1]
    far = np.searchsorted(-best, 1e-6 - score[:-1], "right") - 1
    last = np.concatenate([[0], np.maximum.accumulate(np.where(shared, np.arange(1, n + 1), 0))])
    return np.maximum.accumulate(np.where(shared & (last[far] - np.arange(n) >= least), last[far], 0))


def _gone_on(members: DataFrame, texts: DataFrame, least: int, similarity: float, lengths: list[int], agree: int) -> DataFrame:
    """The passages (columns ``SPANS``) at open places of ``members`` that an earlier member of the signature has, other than the first.

    All members under the same first document meet once, in pairs of blocks, as
    rows that follow each other: a task holds one pair of blocks. Of the
    passages that a document has there, only those that :func:`merged_spans`
    needs are returned.
    """
    # the smallest member has none before it to go on to, and none asks for those behind the last open one
    asked = members.groupBy("key").agg(F.min("doc_id").alias("least"), F.max(F.expr("IF(open, doc_id, NULL)")).alias("last")).filter("least < last")
    held = members.join(asked, "key").filter("doc_id < last OR open").groupBy("first_doc_id", "doc_id").agg(
        F.collect_set(F.struct("key", F.expr("IF(open AND doc_id > least, place, -1)").alias("place"))).alias("members"))
    sizes = texts.select("doc_id", F.length("text").alias("size")).distinct()
    held = held.join(sizes.hint("merge"), "doc_id")
    many = held.groupBy("first_doc_id").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    dealt = held.drop("size").join(many.filter("n > 1").drop("n"), "first_doc_id").withColumn("block", F.expr("CAST(pmod(xxhash64(doc_id), blocks) AS INT)"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.hint("merge").join(texts, "doc_id").select(
        "first_doc_id", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "doc_id", "block", "members", "text")
    dealt = dealt.repartition("first_doc_id", "low", "high").sortWithinPartitions("first_doc_id", "low", "high")
    names, types = _span_columns()

    @tidy
    def go_on(batches):
        hasher = remembered("hashes", Hasher)
        for table in groups(batches, 3):
            rows = list(later_passages(table, least, similarity, lengths, agree, hasher))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

    return dealt.mapInArrow(go_on, SPANS)


def later_passages(table: pa.Table, least: int, similarity: float, lengths: list[int], agree: int, hasher: Hasher):
    """Rows of ``SPANS`` of one pair of blocks: first_doc_id, low, high, doc_id, block, members (key, place), text.

    ``place`` is that of an open place, else -1.
    """
    within = table.column("low")[0] == table.column("high")[0]
    ids, row = np.unique(table.column("doc_id").to_numpy(), return_index=True)  # a repeated id repeats the text
    texts, block = table.column("text").take(row).to_pylist(), table.column("block").to_numpy()[row]
    lists = table.column("members").take(row).combine_chunks()
    owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    key, place = (lists.flatten().field(c).to_numpy() for c in ("key", "place"))
    hashed = hasher.shingles_of([split_words(t) for t in texts])
    values, first, code = np.unique(np.concatenate(hashed), return_index=True, return_inverse=True)
    ends = np.cumsum([len(h) for h in hashed])
    earliest = np.searchsorted(ends, first, side="right")  # the first document that has a token
    _, key = np.unique(key, return_inverse=True)
    holds = np.unique(key * len(ids) + owner)  # key and document, ascending
    marked, spans = np.zeros(len(values), bool), {}
    like: dict[bytes, int] = {}
    same = [like.setdefault(h.tobytes(), d) for d, h in enumerate(hashed)]  # the first document with the same tokens
    sequences: dict[int, Sequence] = {}
    # the documents that have a token, ascending
    having = np.unique(code * len(ids) + np.repeat(np.arange(len(ids)), [len(h) for h in hashed]))
    since_code = np.searchsorted(having, np.arange(len(values) + 1) * len(ids))
    having %= len(ids)
    asks = np.flatnonzero(place >= 0)
    cuts = np.flatnonzero(np.diff(owner[asks], prepend=-1))
    for low, high in zip(cuts, [*cuts[1:], len(asks)], strict=False):
        ask = asks[low:high]
        k = int(owner[ask[0]])
        own = code[ends[k] - len(hashed[k]) : ends[k]]
        again = np.ones(len(own), bool)
        again[np.unique(own, return_index=True)[1]] = False
        start = place[ask] // 2
        end = start + np.where(place[ask] % 2 == 1, lengths[1], lengths[0])
        fits = _bearing(earliest[own] < k, again, least, similarity)[start] >= end
        ask, start, end = ask[fits], start[fits], end[fits]
        # every open place with every document before that has its signature
        since = np.searchsorted(holds, key[ask] * len(ids))
        many = np.searchsorted(holds, key[ask] * len(ids) + k) - since
        at = np.repeat(np.arange(len(ask)), many)
        other = holds[np.repeat(since - (np.cumsum(many) - many), many) + np.arange(len(at))] % len(ids)
        if not within:
            apart = block[other] != block[k]
            at, other = at[apart], other[apart]
        if not len(at):
            continue
        # passages are sets: of their tokens all but a small share are shared or stood before
        mine = own[~again]
        size = since_code[mine + 1] - since_code[mine]
        both = np.bincount(having[np.repeat(since_code[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())], minlength=len(ids))
        enough = both[other] + np.count_nonzero(again) >= similarity * least
        at, other = at[enough], other[enough]
        if not len(at):
            continue
        order = np.argsort(other, kind="stable")
        at, other = at[order], other[order]
        runs = np.flatnonzero(np.diff(other, prepend=-1))
        covered = np.zeros(len(own), np.int64)  # end of the farthest passage found from any place up to each on
        found: list[tuple] = []
        tried: dict[int, set[int]] = {}  # open places, by the tokens that were looked at for them
        for a, b in zip(runs, np.append(runs[1:], len(at)), strict=True):
            before, mine = int(other[a]), at[a:b]
            if agree > 1 and len(np.unique(key[ask[mine]])) < agree:
                continue
            mine = mine[covered[start[mine]] < end[mine]]
            if not len(mine):
                continue
            # of documents with the same tokens the first says all
            looked = tried.setdefault(same[before], set())
            if looked.issuperset(mine.tolist()):
                continue
            looked.update(mine.tolist())
            theirs = code[ends[before] - len(hashed[before]) : ends[before]]
            marked[theirs] = True
            shared = marked[own]
            marked[theirs] = False
            if not (_bearing(shared, again, least, similarity)[start[mine]] >= end[mine]).any():
                continue
            pair = same[before], same[k]
            for d in pair:
                if d not in sequences:
                    sequences[d] = Sequence(hashed[d])
            passages = aligned(*(sequences[d] for d in pair), least, similarity, covered)
            passages = _rows(int(ids[k]), int(ids[before]), passages, texts[k], spans)
            for _, from_, to, *_ in passages:
                covered[from_] = max(covered[from_], to - SHINGLE + 1)
            covered = np.maximum.accumulate(covered) if passages else covered
            found += passages
        spans.clear()
        for span in needed_spans([f[1:] for f in found]):
            yield int(ids[k]), *span


def _rows(doc: int, origin: int, found: list[tuple], text: str, known: dict[int, np.ndarray]) -> list[tuple]:
    """Rows of ``SPANS``: what :func:`aligned` found of document ``origin`` in ``doc``; ``known`` keeps the words' places of ``doc``."""
    if found and doc not in known:
        known[doc] = word_spans(text)
    spans = known.get(doc)
    return [(doc, s, e + SHINGLE - 1, int(spans[s][0]), int(spans[e + SHINGLE - 2][1]), origin, p, q + SHINGLE - 1, value) for p, q, s, e, value in found]


def _compared(pairs: DataFrame, texts: DataFrame, least: int, similarity: float) -> DataFrame:
    """The passages (columns ``SPANS``) of the first document in the other, for each pair of documents."""
    # pairs are small on small inputs only: the hint keeps one plan for all sizes
    both = pairs.hint("merge").join(texts, "doc_id").join(
        texts.select(F.col("doc_id").alias("first_doc_id"), F.col("text").alias("first_text")), "first_doc_id")
    both = both.select("doc_id", "first_doc_id", "text", "first_text")
    names, types = _span_columns()

    @tidy
    def verify(batches):
        hasher = remembered("hashes", Hasher)
        for batch in (batch.slice(k, 128) for batch in batches for k in range(0, batch.num_rows, 128)):
            rows = []
            docs, origins, texts, first_texts = (c.to_pylist() for c in batch.columns)
            known = dict(zip([*docs, *origins], [*texts, *first_texts], strict=True))
            hashed = hasher.shingles_of([split_words(t) for t in known.values()])
            tokens = {doc: Sequence(h) for doc, h in zip(known, hashed, strict=True)}
            spans: dict[int, np.ndarray] = {}
            for k, (doc, origin) in enumerate(zip(docs, origins, strict=True)):
                rows += _rows(doc, origin, aligned(tokens[origin], tokens[doc], least, similarity), texts[k], spans)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

    return both.mapInArrow(verify, SPANS)


def _span_columns() -> tuple[list[str], list[pa.DataType]]:
    names = [c.split()[0] for c in SPANS.split(", ")]
    return names, [pa.float64() if c.endswith("double") else pa.int64() for c in SPANS.split(", ")]


def _merged(found: DataFrame) -> DataFrame:
    """One row for overlapping passages of a document."""
    names, types = _span_columns()
    per_doc = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct(*names[1:]))).alias("spans"))

    def merge(batches):
        for batch in batches:
            rows = []
            for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(doc, *m) for m in merged_spans([tuple(s.values()) for s in spans])]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

    return stage(per_doc.mapInArrow(merge, SPANS), "passages")


def merged_spans(spans: list[tuple]) -> list[tuple]:
    """Spans (start_word, end_word, start_char, end_char, first document, ...) joined where they overlap or touch."""
    out: list[tuple] = []
    for span in sorted(spans):
        if out and span[0] <= out[-1][1]:
            last = out[-1]
            origin = min(last, span, key=lambda s: (s[4], s[0]))
            out[-1] = (last[0], max(last[1], span[1]), last[2], max(last[3], span[3]), *origin[4:])
        else:
            out.append(span)
    return out


def needed_spans(spans: list[tuple]) -> list[tuple]:
    """The fewest spans that :func:`merged_spans` joins, with any others, as it joins all of ``spans``.

    Of each joined stretch these are the spans that reach farthest, one from
    inside the other, and the one of the smallest first document.
    """
    out: list[tuple] = []
    todo = sorted(set(spans))
    while todo:
        end, size = todo[0][1], 1
        while size < len(todo) and todo[size][0] <= end:
            end, size = max(end, todo[size][1]), size + 1
        run, todo = todo[:size], todo[size:]
        kept, at, reach = {min(run, key=lambda s: (s[4], s))}, 0, run[0][0]
        while reach < end:
            far = run[at]
            while at < size and run[at][0] <= reach:
                far, at = max(far, run[at], key=lambda s: s[1]), at + 1
            kept.add(far)
            reach = far[1]
        out += sorted(kept)
    return out


def without_repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``df``, the repeated passages cut out of ``text_col`` (one space stays where text is on both sides).

    A text that is one repeated passage becomes what stands around its words,
    which may be nothing.
    """
    cut_id, spans = free_names(df, 2)
    cuts = repeated_passages(df, id_col, text_col, **options).groupBy(F.col("doc_id").alias(cut_id)).agg(
        F.array_sort(F.collect_list(F.struct("start_char", "end_char"))).alias(spans))
    joined = df.join(cuts, F.col(id_col).cast("long") == F.col(cut_id), "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col(f"{spans}.end_char"))
    ends = F.concat(F.col(f"{spans}.start_char"), F.array(F.length(text_col).cast("long")))
    kept = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")),
                       lambda s: F.trim(F.substring(F.col(text_col), (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int"))))
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(F.array_join(F.array_remove(kept, ""), " "))
    return joined.withColumn(text_col, text).drop(cut_id, spans)
