"""Edited, doubled, inserted-into and sentence-shared passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tillsight.llm import substring_dedup
from tillsight.llm.words import Hasher

from .conftest import prose

LEAST = substring_dedup.WORDS - 4


def shingles(words):
    return Hasher().shingles(words)


def edited(rng, words, edits):
    """The words with ``edits`` of them changed, neither of the first five nor the last five."""
    words = list(words)
    for at in rng.sample(range(5, len(words) - 5), edits):
        words[at] = f"edit{rng.randrange(10**9)}"
    return words


def jaccard(one, two):
    one, two = set(one.tolist()), set(two.tolist())
    return len(one & two) / len(one | two)


def passages_around(rng, words, other):
    """Two documents with the passages in fresh text, and their token arrays; the places of the second passage."""
    a = [*prose(rng, 40, 10**9, "x").split(), *words, *prose(rng, 30, 10**9, "x").split()]
    b = [*prose(rng, 25, 10**9, "x").split(), *other, *prose(rng, 50, 10**9, "x").split()]
    return substring_dedup.Sequence(shingles(a)), substring_dedup.Sequence(shingles(b)), (25, 25 + len(other) - 4)


def test_edited_passages_are_aligned():
    """Every passage of 50 to 100 words with changed words is found, and found whole, exactly if its Jaccard similarity is 0.8 or more."""
    rng = random.Random(5)
    for _ in range(300):
        words = prose(rng, rng.randrange(50, 101), 10**9, "p").split()
        other = edited(rng, words, rng.randrange(1, 4))
        a, b, place = passages_around(rng, words, other)
        got = [(s, e) for _, _, s, e, _ in substring_dedup.aligned(a, b, LEAST, 0.8)]
        if jaccard(shingles(words), shingles(other)) >= 0.8:
            assert got == [place]
        else:
            assert all(s >= place[0] and e <= place[1] and (s, e) != place for s, e in got)


@pytest.mark.parametrize("inserted", [8, 12, 30])
def test_insertions_are_crossed(inserted):
    """Words put into the middle of the shortest passage that bears them, and of longer ones, do not end it."""
    rng = random.Random(inserted)
    for longer in range(0, 30, 3):
        # n - 4 shared tokens of n + inserted + 4, where n tokens are n + 4 words
        n = 4 * inserted + 40 + longer
        words = prose(rng, n, 10**9, "p").split()
        other = [*words[: n // 2], *prose(rng, inserted, 10**9, "y").split(), *words[n // 2 :]]
        assert jaccard(shingles(words), shingles(other)) >= 0.8
        a, b, place = passages_around(rng, words, other)
        assert [(s, e) for _, _, s, e, _ in substring_dedup.aligned(a, b, LEAST, 0.8)] == [place]


def found(spark, texts):
    """(doc_id, first_doc_id, start_word, end_word) of documents given as words, numbered as listed."""
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((r.doc_id, r.first_doc_id, r.start_word, r.end_word) for r in got.collect())


def test_every_copy_in_a_document_is_found(spark):
    """A later document's second and third copy go too, also where the first document has a sentence of the passage alone before it."""
    rng = random.Random(8)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    texts, want = [], []
    for k in range(20):
        passage = prose(rng, 70, 10**9, "p").split()
        texts += [fresh(10) + passage[20:50] + fresh(40) + passage, fresh(20) + passage + fresh(30) + passage + fresh(10) + passage]
        want += [(2 * k + 1, 2 * k, s, s + 70) for s in (20, 120, 200)]
    assert found(spark, texts) == want


def test_stretches_of_a_period_are_aligned():
    """Two stretches of the same few words are one set, however long, and wherever in the period they begin."""
    rng = random.Random(9)
    for period in (1, 2, 3, 4, 12):
        words = prose(rng, period, 10**9, "p").split()
        long, short = (words * 2000)[:3000], (words * 60)[1:60]
        a, b, place = passages_around(rng, long, short)
        assert [(s, e) for _, _, s, e, _ in substring_dedup.aligned(a, b, LEAST, 0.8)] == [place]
        assert [(s, e) for s, e, *_ in substring_dedup.aligned(b, a, LEAST, 0.8)] == [place]


def test_known_sentences_do_not_hide_a_passage(spark):
    """Two sentences that earlier documents have one by one are found together in the third and later ones."""
    rng = random.Random(10)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    texts, want = [], []
    for k in range(120):
        one, two = (prose(rng, 27 + k % 12, 10**9, "p").split() for _ in range(2))
        texts += [fresh(30) + one + fresh(30), fresh(30) + two + fresh(30), fresh(20) + one + two + fresh(30), fresh(30) + one + two + fresh(20)]
        want.append((4 * k + 3, 4 * k + 2, 30, 30 + len(one + two)))
    assert found(spark, texts) == want


def test_recall_at_the_similarity(spark):
    """At 51 words and a similarity of 0.81 all but the stated share is found; exact stretches of a short period always are."""
    assert substring_dedup.hashes_for(0.8, substring_dedup.RECALL) == substring_dedup.HASHES == 4
    rng = random.Random(12)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    texts, edits, periods = [], set(), set()
    for k in range(400):
        words = prose(rng, 51, 10**9, "p").split()
        texts += [fresh(30) + words + fresh(30), fresh(20) + words[:25] + fresh(1) + words[26:] + fresh(20)]
        edits.add((2 * k + 1, 2 * k, 20, 71))
    for k in range(400, 440):
        words = prose(rng, 1 + k % 4, 10**9, "p").split()
        texts += [fresh(30) + words * 60 + fresh(30), fresh(20) + words * 60 + fresh(20)]
        periods.add((2 * k + 1, 2 * k, 20, 20 + 60 * len(words)))
    got = set(found(spark, texts))
    assert got <= edits | periods and periods <= got and len(got & edits) >= 0.99 * len(edits)


def test_long_texts_that_repeat():
    """A hundred words that come again and again, with a new word between or none, take seconds and little memory."""
    import time

    base = prose(random.Random(13), 100, 10**9, "p").split()
    with_new = lambda tag: [w for k in range(80) for w in [*base, f"{tag}{k}"]]
    start = time.time()
    a, b = (substring_dedup.Sequence(shingles(with_new(t))) for t in ("x", "y"))
    spans = sorted((s, e) for _, _, s, e, _ in substring_dedup.aligned(a, b, LEAST, 0.8))
    assert all(any(s <= 101 * k and e >= 101 * k + 96 for s, e in spans) for k in range(80))
    a, b = substring_dedup.Sequence(shingles(base * 1000)), substring_dedup.Sequence(shingles((base * 1001)[37:100_037]))
    assert [(s, e) for _, _, s, e, _ in substring_dedup.aligned(a, b, LEAST, 0.8)] == [(0, 100_000 - 4)]
    one = substring_dedup.Sequence(shingles([*prose(random.Random(14), 30, 10**9, "x").split(), *base]))
    assert [(s, e) for _, _, s, e, _ in substring_dedup.aligned(one, b, LEAST, 0.8)] == [(0, 100_000 - 4)]
    assert time.time() - start < 20


def test_running_similarities_equal_sets():
    rng = random.Random(15)
    for _ in range(50):
        a, b = (np.array([rng.randrange(30) for _ in range(60)], np.uint64) for _ in range(2))
        ends = sorted(rng.sample(range(1, 61), 8)), sorted(rng.sample(range(1, 61), 8))
        got = substring_dedup._similarities(a, b, *map(np.array, ends))
        assert got == pytest.approx([jaccard(a[:x], b[:y]) for x, y in zip(*ends, strict=True)])


def test_edited_passages_of_known_sentences(spark):
    """Passages of four sentences that earlier documents all have one by one, with two edits: found between the two that have them whole."""
    rng = random.Random(16)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    texts, want = [], set()
    for k in range(60):
        sentences = [prose(rng, 24, 10**9, "p").split() for _ in range(4)]
        passage = [w for s in sentences for w in s]
        at = len(texts)
        texts += [fresh(30) + s + fresh(30) for s in sentences]
        texts += [fresh(20) + passage + fresh(30), fresh(30) + edited(rng, passage, 2) + fresh(20)]
        if jaccard(shingles(texts[-2][20:116]), shingles(texts[-1][30:126])) >= 0.8:
            want.add((at + 5, at + 4))
    got = {(d, f) for d, f, _, _ in found(spark, texts)}
    assert len(want) > 20 and len(got & want) >= 0.98 * len(want)


def test_passages_that_the_first_document_has_in_part(spark):
    """Later documents share a passage of 50 to 80 words of which earlier ones have all but a few words, so that these have every signature."""
    rng = random.Random(17)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    texts, want = [], []
    for k in range(60):
        passage = prose(rng, 50 + k % 31, 10**9, "p").split()
        texts += [fresh(30) + part + fresh(30) for part in (passage[:46], passage[-46:], passage[2:48])]
        at = len(texts)
        texts += [fresh(20) + passage + fresh(30), fresh(30) + passage + fresh(20), fresh(25) + passage + fresh(25)]
        want += [(at + 1, at, 30, 30 + len(passage)), (at + 2, at, 25, 25 + len(passage))]
    got = found(spark, texts)
    whole = {(d, s, e) for d, _, s, e in got}
    assert all((d, s, e) in whole for d, _, s, e in want)
    assert sum(w in got for w in want) >= 0.98 * len(want)


def test_a_common_stretch_joins_no_others(spark):
    """Hundreds of documents with the same 45 words are one class that goes no further; the few that have more of them in common are found."""
    rng = random.Random(18)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    line, tail = prose(rng, 45, 10**9, "p").split(), prose(rng, 20, 10**9, "q").split()
    texts = [fresh(20 + k % 7) + line + (tail if k % 100 == 99 else []) + fresh(30) for k in range(400)]
    assert found(spark, texts) == [(k, 99, 20 + k % 7, 85 + k % 7) for k in (199, 299, 399)]


@pytest.mark.parametrize("seed", range(3))
def test_needed_spans_join_as_all_do(seed):
    """Any part of the spans may be cut to its needed ones; the joined spans stay, with their first documents."""
    rng = random.Random(seed)
    for _ in range(300):
        spans = []
        for _ in range(rng.randrange(1, 30)):
            start = rng.randrange(60)
            end = start + rng.randrange(1, 15)
            spans.append((start, end, 5 * start, 5 * end, rng.randrange(5), rng.randrange(9), rng.randrange(9), 0.9))
        cut = rng.randrange(len(spans) + 1)
        parts = [substring_dedup.needed_spans(spans[:cut]), substring_dedup.needed_spans(spans[cut:])]
        whole = substring_dedup.merged_spans(list(set(spans)))
        assert substring_dedup.merged_spans(list({*parts[0], *parts[1]})) == whole
        assert substring_dedup.needed_spans(substring_dedup.needed_spans(spans)) == substring_dedup.needed_spans(spans)
        assert len(parts[0]) <= 2 * len(spans[:cut])


def test_later_passages_are_few_rows(spark, monkeypatch):
    """A group of which each document has a passage of every other, beside a sentence that none of these covers: rows follow the documents, not their pairs."""
    rng = random.Random(19)
    fresh = lambda n: prose(rng, n, 10**9, "x").split()
    line, passage = prose(rng, 24, 10**9, "p").split(), prose(rng, 80, 10**9, "q").split()
    texts = [fresh(60) + line + fresh(60), *(fresh(60) + line + fresh(9) + passage + fresh(30) for _ in range(60))]
    rows, plans, stage = {}, {}, substring_dedup.stage

    def counted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        staged = stage(df, name)
        rows[name] = staged.count()
        return staged

    monkeypatch.setattr(substring_dedup, "stage", counted)
    got = found(spark, texts)
    assert [(d, f) for d, f, _, _ in got] == [(k, 1) for k in range(2, 61)]
    assert 0 < rows["later_passages"] <= 2 * 60  # the one that reaches farthest and the one of the first document
    assert "collect_list" not in plans["later_passages"]  # texts of a group meet as rows, not as one value


def block_of(texts, asks):
    """One block for the further search: every document has signature 1, the last asks for it at the tokens ``asks``."""
    members = [[{"key": 1, "place": -1}] for _ in texts[:-1]] + [[{"key": 1, "place": 2 * at} for at in asks]]
    n = len(texts)
    return pa.table({
        "first_doc_id": [0] * n, "low": [0] * n, "high": [0] * n, "doc_id": list(range(1, n + 1)), "block": [0] * n,
        "members": pa.array(members, pa.list_(pa.struct([("key", pa.int64()), ("place", pa.int64())]))), "text": texts})


def later(table):
    return list(substring_dedup.later_passages(table, LEAST, 0.8, substring_dedup._extents(LEAST, 4), 1, Hasher()))


def test_copies_are_looked_at_once(monkeypatch):
    """20 equal texts have both halves of a passage, apart: comparing one of them tells that none has the passage."""
    rng = random.Random(4)
    one, two, fresh = (prose(rng, n, 10**9, "w") for n in (30, 30, 100))
    calls, aligned = [], substring_dedup.aligned
    monkeypatch.setattr(substring_dedup, "aligned", lambda *a: calls.append(1) or aligned(*a))
    assert later(block_of([f"{one} {fresh} {two}"] * 20 + [f"{one} {two}"], [0])) == []
    assert len(calls) == 1
    # a text that has it is still found behind them
    rows = later(block_of([f"{one} {fresh} {two}"] * 20 + [f"{fresh} {one} {two}", f"{one} {two}"], [0]))
    assert [(r[0], r[1], r[2], r[5]) for r in rows] == [(22, 0, 60, 21)]


def test_common_lines_bring_no_documents_together(monkeypatch):
    """Texts that share one line of 20 words are told apart by counting, not looked at one by one."""
    rng = random.Random(5)
    line = prose(rng, 20, 10**9, "w")
    looked, bearing = [], substring_dedup._bearing
    monkeypatch.setattr(substring_dedup, "_bearing", lambda *a: looked.append(1) or bearing(*a))
    texts = [f"{prose(rng, 60, 10**9, 'w')} {line} {prose(rng, 60, 10**9, 'w')}" for _ in range(40)]
    passage = prose(rng, 60, 10**9, "w")
    texts[7] += f" {passage}"
    rows = later(block_of([*texts, f"{line} {passage}"], [0, 22]))
    assert [(r[0], r[2], r[5]) for r in rows] == [(41, 80, 8)]
    assert len(looked) <= 2


@pytest.mark.parametrize("seed", range(5))
def test_nothing_is_returned_only_if_all_is_known(seed):
    rng = random.Random(seed)
    words = prose(rng, 400, 10**9, "w").split()
    a, b, _ = passages_around(rng, words, edited(rng, words, 28))
    every = substring_dedup.aligned(a, b, LEAST, 0.8)
    assert every
    known = np.zeros(len(b.tokens), np.int64)
    assert substring_dedup.aligned(a, b, LEAST, 0.8, known) == every
    known[0] = len(known)
    assert substring_dedup.aligned(a, b, LEAST, 0.8, np.maximum.accumulate(known)) == []
    last = max(every, key=lambda p: p[3])
    known[0] = last[3] - 1
    assert substring_dedup.aligned(a, b, LEAST, 0.8, np.maximum.accumulate(known)) == every
