"""Words of a text and stable 64-bit hashes of words and shingles, for numpy code inside tasks."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash

_WORD = re.compile(r"\w+")
_SIGNS = {c: " " for c in range(128) if not _WORD.match(chr(c))}
_ASCII = np.array([c not in _SIGNS for c in range(128)])
_BASIC = np.array([chr(c).isalnum() or c == 95 for c in range(1 << 16)])  # what \w matches of the first plane
_GOLD = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = 5


def _inside(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Code of each character and whether a word has it; None if one is outside the first plane."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (code, _BASIC[code]) if code.max(initial=0) < len(_BASIC) else None


def split_words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores; of a text without any, its white-space tokens."""
    text = text or ""
    if text.isascii():
        return text.lower().translate(_SIGNS).split() or text.lower().split()
    known = _inside(text)
    if known:
        code, inside = known
        spaced = np.where(inside, code, np.uint32(10)).tobytes().decode("utf-32-le", "surrogatepass")
        found = spaced.lower().split()
        if found:
            return found
    found = _WORD.findall(text) or text.split()
    return "\n".join(found).lower().split("\n") if found else []


def word_spans(text: str) -> np.ndarray:
    """First and behind-last character of each word of :func:`split_words`."""
    known = _ASCII[np.frombuffer(text.encode(), np.uint8)] if text.isascii() else (_inside(text) or (None, None))[1]
    if known is not None:
        inside = np.zeros(len(text) + 2, bool)
        inside[1:-1] = known
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges):
            return edges.reshape(-1, 2)
    found = [m.span() for m in _WORD.finditer(text)] or [m.span() for m in re.finditer(r"\S+", text)]
    return np.array(found, np.int64).reshape(-1, 2)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_remembered: dict[str, object] = {}


def give_back() -> None:
    """Return freed memory to the system: idle worker processes would else keep what their last task needed."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(task, worth: int = 1 << 20):
    """A function over Arrow batches that gives its memory back at its end, if it read ``worth`` bytes or more."""
    def run(batches):
        read = 0

        def counted():
            nonlocal read
            for batch in batches:
                read += batch.nbytes
                yield batch

        try:
            yield from task(counted())
        finally:
            if read >= worth:
                give_back()

    return run


def remembered(kind: str, make):
    """What this worker process remembers of ``kind``, made if it has none.

    Worker processes outlive tasks, and tasks of one operator share it; what
    another operator left behind is dropped first, so a worker holds one.
    """
    if kind not in _remembered:
        _remembered.clear()
        give_back()
        _remembered[kind] = make()
    return _remembered[kind]


class _Known(dict):
    """Hashes of words, made as they are asked for."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Hasher:
    """Word and shingle hashes; remembers a bounded number of words."""

    def __init__(self, most: int = 200_000):
        self.known = _Known()
        self.most = most

    def words(self, words: list[str]) -> np.ndarray:
        """Hash of each word."""
        if len(self.known) > self.most:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def shingles(self, words: list[str], size: int = SHINGLE) -> np.ndarray:
        """Hash of each run of ``size`` words; fewer words are one shingle, none are none."""
        return self.shingles_of([words], size)[0]

    def shingles_of(self, texts: list[list[str]], size: int = SHINGLE) -> list[np.ndarray]:
        """The shingles of many texts, given as words."""
        h = self.words(list(chain.from_iterable(texts)))
        runs = _runs(h, size)
        out, at = [], 0
        for words in texts:
            n = len(words)
            out.append(runs[at : at + n - size + 1] if n >= size else _runs(h[at : at + n], n))
            at += n
        return out


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    n = len(h) - size + 1
    if n < 1 or not size:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * _GOLD
        out ^= out >> np.uint64(29)
    return mixed(out)


def portions(batch, column: int = 1, most_bytes: int = 4 << 20):
    """Slices of a batch of at most about ``most_bytes`` of text, or one row."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def free_names(df, many: int) -> list[str]:
    """Column names that ``df`` has not got, in any case."""
    taken = {c.lower() for c in df.columns}
    return [n for n in (f"own_{k}" for k in range(many + len(taken))) if n not in taken][:many]


def fresh(df, *names: str) -> list[str]:
    """``names`` for new columns of ``df``, each with as many underscores behind it as no column of that name needs."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def groups(batches, keys: int):
    """Runs of rows with equal leading ``keys`` columns of sorted Arrow batches, as Arrow tables; a run may span batches."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        if held:
            new[0] = any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in range(keys))
        cuts = [0, *np.flatnonzero(new).tolist()] if not new[0] else np.flatnonzero(new).tolist()
        for at, (a, b) in enumerate(zip(cuts, [*cuts[1:], batch.num_rows], strict=True)):
            if held and (at or new[0]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
