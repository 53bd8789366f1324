"""Lexical search, Merkle manifest and language-model scores against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import SCHEMA, edge_texts, prose

from tillsight.llm import lexical, merkle, ppm, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans(lexical.UPPER, lexical.LOWER)
ITEMS = "item_id long, text string, score long, rank int"


# --- lexical search ------------------------------------------------------------------


def plain_search(docs, items, k=20):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    by_item = defaultdict(Counter)
    for i, t in items:
        by_item[i].update(TERM.findall((t or "").translate(FOLD)))
    for item, wanted in by_item.items():
        found = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * n) // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, q in wanted.items() if t in b)
            if score > 0:
                found.append((-score, -1 if i is None else i, i, score))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_terms_are_the_matches_of_the_pattern():
    text = "Ab_c-9é\x85d\xa0E f\n日本 ŽÀ i̇İ x\x7fy"
    assert [t.decode() for t in lexical.terms(text)] == TERM.findall(text.translate(FOLD))
    assert lexical.terms(None) == lexical.terms(" .\n") == []


@pytest.mark.parametrize("block_terms", [1 << 16, 6])
def test_search_equals_scoring_everything(spark, edge, block_terms):
    items = [(1, "W1 w2 w3 w3 hello w17 naïve"), (2, None), (3, "?!"), (4, "nowhere at all"), (5, "one two one"), (5, "three"), (None, "line here"), (7, prose(random.Random(5), 60))]
    wanted = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    assert rows_of(lexical.search(edge, wanted, block_terms=block_terms)) == plain_search(edge_texts(), items)


def test_search_with_ties_and_small_leaves(spark):
    rng = random.Random(8)
    docs = [(k % 150, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9)))) for k in range(400)]
    items = [(1, "a b c"), (2, "j j j a"), (3, "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows_of(lexical.search(df, spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS), leaf=3))
    assert got == plain_search(docs, items)


def test_search_of_nothing(spark, edge, empty):
    none = spark.createDataFrame([], ITEMS)
    assert lexical.search(edge, none).collect() == []
    assert lexical.search(empty, spark.createDataFrame([(1, "a b", 1, 2)], ITEMS)).collect() == []


def _tree(rng, many, width=60, topics=6):
    """Documents of a few topics, as the tree takes them."""
    rows = []
    for k in range(many):
        base = (k % topics) * (width // topics)
        cols = sorted(rng.sample(range(base, base + width // topics), 5))
        rows.append([(c, rng.randrange(1, 10**6)) for c in cols])
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    cols, vals = (np.array([x[k] for r in rows for x in r], np.int64) for k in (0, 1))
    return lexical.BallTree(starts, cols, vals, width, 8), rows


def test_tree_bounds_hold_and_prune():
    rng = random.Random(4)
    tree, rows = _tree(rng, 600)
    assert sorted(tree.order.tolist()) == list(range(600))
    leaves = sum(c is None for c in tree.children)
    for _ in range(30):
        cols = np.array(sorted(rng.sample(range(60), 4)))
        weights = np.array([rng.randrange(1, 30_000) for _ in cols])
        by_col = dict(zip(cols.tolist(), weights.tolist(), strict=True))
        scores = np.array([sum(by_col.get(c, 0) * v for c, v in r) for r in rows])
        for node, bound in enumerate(tree.bounds(cols, weights)):
            assert scores[tree.order[tree.first[node] : tree.last[node]]].max() <= bound
        best = []
        visited = tree.search(cols, weights, np.arange(600), best, 5)
        assert sorted(best, reverse=True) == sorted(((int(s), -k) for k, s in enumerate(scores) if s > 0), reverse=True)[:5]
        assert visited < leaves


# --- Merkle manifest -----------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_levels(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][a : a + fanout])) for a in range(0, len(levels[-1]), fanout)])
    return levels


def plain_proof(levels, at, fanout):
    """(before, after) of every level below the last."""
    out = []
    for level in levels[:-1]:
        a = at - at % fanout
        out.append(("".join(level[a:at]), "".join(level[at + 1 : a + fanout])))
        at //= fanout
    return out


def plain_manifest(rows, fanout=16):
    """Multiset of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); rows: doc_id, source, lang, n_chars, text."""
    leaf = lambda r: sha("".join(map(plain_field, r)))
    lower = lambda r: (*r[:4], r[4] and r[4].translate(FOLD))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted([r for r in rows if r[1] == s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [plain_levels([leaf(r) for r in g], fanout) for g in groups]
    top = plain_levels([t[-1][0] for t in trees], fanout)
    out = Counter()
    for number, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for at, r in enumerate(group):
            path = plain_proof(tree, at, fanout) + plain_proof(top, number, fanout)
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            own = leaf(lower(r)) if touched else leaf(r)
            for before, after in path:
                own = sha(before + own + after)
            out[(r[0], leaf(r), tree[-1][0], top[-1][0], sha("".join(b + a for b, a in path)), own, own == top[-1][0])] += 1
    return out


def merkle_rows(df, fanout=16):
    from pyspark.sql import functions as F

    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.verified_rows(df, ["doc_id", "source", "lang", "n_chars", "text"], {"text": F.translate("text", lexical.UPPER, lexical.LOWER)}, touched, fanout=fanout)
    return Counter(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


@pytest.mark.parametrize("fanout", [16, 3])
def test_manifest_equals_plain_python(spark, fanout):
    rng = random.Random(2)
    rows = [(i, f"s{min(rng.randrange(9), 3)}", "en", i, f"Text {i}") for i in range(300)]
    rows += [(i, t if i is None or i % 2 else None, None, None, t) for i, t in edge_texts()] + [(5000 + k, f"lone{k:02}", "é", k, None) for k in range(20)]
    df = spark.createDataFrame([(i, t, la, s, n, 1, "k", "x") for i, s, la, n, t in rows], SCHEMA)
    assert merkle_rows(df, fanout) == plain_manifest(rows, fanout)


def test_manifest_of_one_row_and_of_none(spark, empty):
    assert merkle_rows(empty) == Counter()
    one = [(1, "s", "en", 3, "Abc")]
    df = spark.createDataFrame([(i, t, la, s, n, 1, "k", "x") for i, s, la, n, t in one], SCHEMA)
    assert merkle_rows(df) == plain_manifest(one)
    (row,) = merkle_rows(df)
    assert row[1] == row[2] == row[3] and row[4] == sha("")


def test_labels_nest(spark):
    rows = [(i, f"s{i % 3}", "x") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    from pyspark.sql import functions as F

    found = merkle.build(df.withColumn("d", merkle.leaf_digest(["doc_id", "text"])), "source", ["doc_id"], "d", fanout=4).nodes().collect()
    spans = sorted((r.lo, -r.hi) for r in found)
    open_ = []
    for lo, hi in spans:
        while open_ and open_[-1] <= lo:
            open_.pop()
        assert not open_ or -hi <= open_[-1]
        open_.append(-hi)
    assert (0, 100) in {(r.lo, r.hi) for r in found if r.part == "top"}
    assert sorted(r.lo for r in found if r.part == "group" and r.level == 0) == list(range(100))


# --- prediction by partial matching --------------------------------------------------


class PlainModel:
    """Dictionaries of contexts; the walk down from the longest, one symbol at a time."""

    def __init__(self, texts, order=ppm.ORDER):
        self.order, self.counts = order, defaultdict(Counter)
        for text in texts:
            for word in ppm.words_of(text):
                for context, symbol in self.events(word):
                    for k in range(len(context) + 1):
                        self.counts[context[len(context) - k :]][symbol] += 1
            self.counts[b" "][256] += 1
            self.counts[b""][256] += 1

    def events(self, word):
        coded = b" " + word + b" "
        return [(coded[max(0, p - self.order) : p], coded[p]) for p in range(1, len(coded))]

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(len(context), -1, -1):
            seen = self.counts.get(context[len(context) - k :])
            if not seen:
                continue
            open_ = {s: c for s, c in seen.items() if s not in excluded}
            n = sum(open_.values())
            if symbol in open_:
                return p * (2 * open_[symbol] - 1) / (2 * n)
            if n:
                p *= len(open_) / (2 * n)
            excluded |= set(seen)
        return p / (257 - len(excluded))

    def score(self, text):
        events = [e for w in ppm.words_of(text) for e in self.events(w)] + [(b" ", 256)]
        return sum(math.log10(self.probability(*e)) for e in events)


LM_SCHEMA = SCHEMA + ", score double, n_tokens int"


def lm_rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, "k", "x", 0.5, 3) for i, t in rows], LM_SCHEMA).repartition(3, "doc_id")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check_lm(spark, rows, held_out=held, buckets=ppm.BUCKETS):
    from pyspark.sql import functions as F

    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1 if held_out is held else F.lit(True)
    got = ppm.score(lm_rows(spark, rows), flag, buckets=buckets).collect()
    trained = [t for i, t in rows if not held_out(i)]
    model, tokens = PlainModel(trained), Counter()
    for t in trained:
        tokens.update(ppm.words_of(t))
        tokens[None] += 1
    n, v = sum(tokens.values()), len(tokens)
    want = defaultdict(list)
    for i, t in rows:
        own = [*ppm.words_of(t), None]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want[i].append((held_out(i), len(own), sum(tokens[w] > 0 for w in own), n, base, model.score(t)))
    assert len(got) == len(rows)
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    for i, w in want.items():
        for a, b in zip(sorted(found[i]), sorted(w), strict=True):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_scores_equal_a_plain_trie(spark):
    rng = random.Random(6)
    texts = [*edge_texts(), *[(100 + k, prose(rng, 40, 300, "wo")) for k in range(60)], (300, "x" * 5000), (301, "\x00 \xff é\x85é")]
    check_lm(spark, texts, buckets=7)


def test_portions_and_batches_do_not_change_scores(spark, monkeypatch):
    monkeypatch.setattr(ppm, "PORTION_TEXTS", 7)
    monkeypatch.setattr(ppm, "WORDS", 50)
    rng = random.Random(7)
    check_lm(spark, [(k, prose(rng, 30, 200, "v")) for k in range(50)])


def test_scores_without_training_rows_and_without_rows(spark, empty):
    check_lm(spark, [(1, "a b"), (2, None)], held_out=lambda i: True)
    from pyspark.sql import functions as F

    assert ppm.score(empty, F.lit(False)).collect() == []


class PlainTextModel(PlainModel):
    """Contexts that reach back over the words before."""

    def __init__(self, texts, order=ppm.ORDER):
        self.order, self.counts = order, defaultdict(Counter)
        for text in texts:
            for context, symbol in self.events(text):
                for k in range(len(context) + 1):
                    self.counts[context[len(context) - k :]][symbol] += 1

    def events(self, text):
        coded = b" " + b"".join(w + b" " for w in ppm.words_of(text))
        return [(coded[max(0, p - self.order) : p], s) for p, s in enumerate([*coded[1:], 256], start=1)]

    def score(self, text):
        return sum(math.log10(self.probability(*e)) for e in self.events(text))


def test_stretches_of_a_text_have_its_events(monkeypatch):
    from tillsight.llm.bpe import to_varint

    rng = random.Random(11)
    words = [bytes(rng.choices(b"abc\x00\xff", k=rng.randint(1, 9))) for _ in range(30)]
    coded = [to_varint(np.array(rng.choices(range(30), k=n), np.int64)) for n in (0, 1, 40, 3, 0, 90)]

    def events(block):
        monkeypatch.setattr(ppm, "BLOCK", block)
        blocks = [ppm.events_of_texts(pieces)[0] for _, pieces in ppm._stretches(words, coded)]
        return len(blocks), np.concatenate(blocks).tolist()

    one, many = events(1 << 20), events(16)
    assert one[0] == 1 and many[0] > 20 and one[1] == many[1]


def test_contexts_reach_over_words(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ppm, "PORTION_TEXTS", 9)
    rng = random.Random(8)
    texts = [*edge_texts(), *[(100 + k, prose(rng, 40, 300, "wo")) for k in range(40)], (300, "x" * 500), (301, "\x00 \xff é\x85é")]
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = PlainTextModel([t for i, t in texts if not held(i)])
    got, want = defaultdict(list), defaultdict(list)
    inside = {r.doc_id: r for r in ppm.score(lm_rows(spark, texts), flag).collect()}
    for r in ppm.score(lm_rows(spark, texts), flag, buckets=7, across=True).collect():
        got[r.doc_id].append(r.score)
        assert r.doc_id is None or r.doc_id < 100 or r[1:6] == inside[r.doc_id][1:6]
    for i, t in texts:
        want[i].append(model.score(t))
    assert set(got) == set(want)
    for i in want:
        assert sorted(got[i]) == pytest.approx(sorted(want[i]), rel=1e-9)


def test_events_and_code_lengths_are_sent_in_few_bytes():
    from tillsight.llm.bpe import from_varint

    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 9)).astype(np.uint8)) for _ in range(40_000)] + [b"\xff" * 9, b"\x00" * 9]
    events = np.unique(np.concatenate([ppm.events_of_texts([(b" " + b" ".join(words) + b" \0", 1, True)])[0], ppm.events_of(words)[0]]))
    assert (ppm.turned_back(ppm.turned(events)) == events).all()
    numbers, order, cuts = ppm._by_bucket(events, 64)
    listed = ppm.packed_events(numbers, cuts)
    assert len(listed) == 64 and {len(set(ppm.buckets_of(events[order[a:b]], 64).tolist())) for a, b in zip(cuts, cuts[1:], strict=False)} == {1}
    assert (ppm.turned_back(np.concatenate(ppm.unpacked_events(listed))) == events[order]).all()
    assert sum(map(len, listed)) < 5 * len(events)  # 8 bytes each before
    numbers = np.array([0, 1, 127, 128, 1 << 28, (1 << 56) - 1, 1 << 56, (1 << 63) - 1])
    assert [from_varint(x).tolist() for x in ppm.packed(numbers, np.array([0, 3, 3, 8]))] == [[0, 1, 127], [], numbers[3:].tolist()]
    values = np.concatenate([-(10.0 ** rng.uniform(-13, 2.4, 10_000)), [0.0, -0.0, -1.0]])
    sent = ppm.packed_lengths(values)
    assert sent.shape == (len(values), 5) and ppm.unpacked_lengths(sent.tobytes()) == pytest.approx(values, rel=3e-11, abs=0)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abc é", max_size=20), min_size=1, max_size=6), st.text("abcdé", max_size=8))
def test_probabilities_of_a_context_add_up(texts, word):
    words = Counter(w for t in texts for w in ppm.words_of(t))
    listed = sorted(words) or [b"a"]
    events, begin = ppm.events_of(listed)
    counts = np.repeat(np.array([words[w] or 1 for w in listed]), np.diff(np.append(begin, len(events))))
    levels = ppm.levels_of(events, counts, range(ppm.ORDER + 1))
    tail = word.encode()[: ppm.ORDER - 1]
    (context,) = {int(e) >> 9 for e in ppm.events_of([tail + b"?"])[0][len(tail) : len(tail) + 1]}
    total = (10 ** ppm.log10_probabilities((context << 9) + np.arange(257), levels)).sum()
    assert total == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("name", ["op11_lexical", "op12_merkle", "op13_ppm"])
def test_queries_run(spark, sf, name):
    rows = queries.registry()[name](spark, sf)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)
