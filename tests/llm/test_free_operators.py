"""Packing, language ID, Jaccard join, WARC, BPE and passages against plain Python and the libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import edge_texts, prose
from tokenizers import Tokenizer

from tillsight.llm import bpe, jaccard_join, language, packing, queries, substring_dedup, warc
from tillsight.llm.words import Hasher, split_words, word_spans

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


# --- packing -----------------------------------------------------------------------


def word_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_pieces_cover_every_document(edge):
    tokenizer = word_tokenizer()
    got = packing.pack_documents(edge, queries.tokenizer_json()).collect()
    want = Counter()
    for i, t in edge_texts():
        want[(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())] += 1
    by_sequence = defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence[r.sequence_id].append(r)
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
        assert sum(r.length for r in rows) <= 2048 and len(rows) <= 64 and sum(r.loss_tokens for r in rows) <= 2048
    for (i, ids), times in want.items():
        parts = Counter((r.start, r.ids) for r in got if r.doc_id == i and r.doc_tokens == len(ids) // 4 and ids[4 * r.start : 4 * (r.start + r.length)] == r.ids)
        assert sum(len(x) * n for (_, x), n in parts.items()) >= len(ids) * times
    assert sum(r.length for r in got) == sum(len(ids) // 4 * n for (_, ids), n in want.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_chunks_are_tokenized_as_whole_texts(texts):
    encoder = _encoder()
    tokenizer = word_tokenizer_once()
    assert encoder.encode(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


_made = {}


def _encoder():
    return _made.setdefault("encoder", _made.get("encoder") or packing.ChunkEncoder(queries.tokenizer_json()))


def word_tokenizer_once():
    return _made.setdefault("tokenizer", _made.get("tokenizer") or word_tokenizer())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 30)), max_size=60))
def test_bins_keep_all_limits(needs):
    limits = np.array([50, 4, 49])
    rows = np.array([(t, 1, min(t, n, 49)) for t, n in needs], np.int64).reshape(-1, 3)
    bins = packing.dot_product_bins(rows, limits)
    for b in set(bins.tolist()):
        assert (rows[bins == b].sum(axis=0) <= limits).all()
    pieces = [(k, 0, int(t)) for k, (t, _, _) in enumerate(rows) if t]
    placed = packing.filled(pieces, packing.dot_product_bins(np.array([(n, 1, n - 1) for _, _, n in pieces]).reshape(-1, 3), limits), limits) if pieces else []
    total, cut = defaultdict(int), defaultdict(list)
    for (d, at, n), b in placed:
        total[b] += n
        cut[d].append((at, n))
    assert all(v <= 50 for v in total.values())
    for d, _, n in pieces:
        at = 0
        for start, length in sorted(cut[d]):
            assert start == at
            at += length
        assert at == n


def test_examples_stay_whole(spark):
    rows = [(k, 100 + 37 * k % 900, 50 + k % 40) for k in range(500)]
    df = spark.createDataFrame(rows, "id long, tokens long, loss_tokens long")
    got = packing.pack(df, packing.Limits(1024, 6, 300)).collect()
    assert sorted(r.id for r in got) == list(range(500))
    used = defaultdict(lambda: [0, 0, 0])
    for r in got:
        for k, v in enumerate((r.tokens, 1, r.loss_tokens)):
            used[r.sequence_id][k] += v
    assert all(a <= 1024 and b <= 6 and c <= 300 for a, b, c in used.values())
    with pytest.raises(Exception, match="larger than a whole sequence"):
        packing.pack(spark.createDataFrame([(1, 5000, 1)], df.schema), packing.Limits(1024, 6, 300)).collect()


# --- language ----------------------------------------------------------------------


def test_held_out_accuracy(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").withColumn("out", language.held_out())
    model = language.fit(rows.filter("NOT out"))
    got = language.predict(rows, model).collect()
    out = [r for r in got if r.out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert not any(r.rejected for r in got if r.text and len(r.text) > 30)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    strange = spark.createDataFrame([(1, "ж" * 400), (2, None), (3, ""), (4, "12 ?!"), (5, "日本語" * 80)], "doc_id long, text string")
    told = {r.doc_id: r for r in language.predict(strange, model).collect()}
    assert [told[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and all(told[k].score == 0 for k in (2, 3, 4))
    assert all(r.rejected for r in told.values()) and told[1].lang_pred in model.languages


def test_language_edges(edge, empty):
    model = language.fit(edge)
    assert language.predict(edge, model).count() == len(edge_texts())
    assert language.predict(empty, model).count() == 0


def test_language_without_labels(edge, empty):
    """A model of no rows, or of rows without a letter, knows no language."""
    for rows in (empty, edge.filter("doc_id IN (5, 6, 7)")):
        got = language.predict(edge, language.fit(rows)).collect()
        assert {(r.lang_pred, r.score, r.rejected) for r in got} == {("und", 0.0, True)}


def test_language_keeps_columns_of_its_names(edge):
    from pyspark.sql import functions as F

    mine = edge.withColumn("score", F.lit("mine")).withColumn("Rejected", F.lit(3))
    got = language.predict(mine, language.fit(mine))
    assert got.columns == [*mine.columns, "lang_pred", "score_", "rejected_"]
    assert {(r.score, r.Rejected) for r in got.collect()} == {("mine", 3)}


def test_language_equals_a_plain_loop(spark):
    """Predictions and scores against dictionaries of n-grams, the same centroids given."""
    import math

    rng = random.Random(3)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(40)] for lang, letters in {"aa": "abcdé", "bb": "xyzuw", "cc": "abxyñ"}.items()}
    rows = [(k, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(3, 60))), lang) for k, lang in enumerate(list(words) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    grams = language.Grams()
    seen = Counter()
    for _, t, _ in rows:
        seen.update(np.flatnonzero(grams.counts(t)).tolist())
    idf = {c: math.log((1 + len(rows)) / (1 + n)) + 1 for c, n in seen.items()}
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    for k, t, lang in rows:
        counts = grams.counts(t)
        vector = {c: math.log1p(counts[c]) * idf[c] for c in np.flatnonzero(counts).tolist()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [(sum(v * float(center[c]) for c, v in vector.items()) / norm, -o) for center, o in zip(model.centroids, model.owner.tolist(), strict=True)]
        best = max(cosines)
        assert got[k].lang_pred == model.languages[-best[1]] == lang and got[k].score == pytest.approx(best[0], abs=1e-5)


def test_wrong_labels_do_not_set_the_radius(spark):
    rng = random.Random(4)
    rows = [(k, prose(rng, 60, 300, "abc"), "en") for k in range(300)] + [(300, " ".join("zqxj" for _ in range(60)), "en")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), centroids=1)
    strange = spark.createDataFrame([(1, " ".join("qzjx wvk" for _ in range(30)))], "doc_id long, text string")
    assert language.predict(strange, model).first().rejected


# --- Jaccard join ------------------------------------------------------------------


def plain_links(rows):
    hasher, sets = Hasher(), {}
    for i, t in rows:
        sets[i] = (split_words(t), set(hasher.shingles(split_words(t)).tolist()))
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a][1] and sets[b][1]:
                both = len(sets[a][1] & sets[b][1])
                if sets[a][0] == sets[b][0] or both >= 0.8 * len(sets[a][1] | sets[b][1]) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def near_copies(rng, groups=12):
    rows = []
    for _ in range(groups):
        words = prose(rng, rng.randrange(6, 300)).split()
        for _ in range(rng.randrange(1, 12)):
            own = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 60)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(own)))
    return rows


def test_links_equal_brute_force(spark):
    rows = near_copies(random.Random(5)) + [(900 + k, t) for k, t in enumerate(["", None, "one", "one", "!!", "!!"])]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == plain_links(rows)


def test_crowded_buckets_are_split(spark):
    """One large group of near copies, in more rows than a bucket or block holds."""
    rng = random.Random(6)
    words = prose(rng, 100).split()
    rows = [(k, " ".join([*words[:k % 97], f"n{k}", *words[k % 97 + 1:]])) for k in range(700)]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), bucket=16).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == plain_links(rows)


def test_join_edges(edge, empty):
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(edge).collect() if r.doc_id}
    assert got[3].class_id == 1 and got[19].class_id == 1 and got[11].class_id == 10 and got[4].n_links == 0
    assert jaccard_join.jaccard_join(edge).count() == len(edge_texts())
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_whole_buckets_are_compared_around_a_pivot(spark, monkeypatch):
    """Buckets larger than a block, most rows close to the pivot, some far from it but close to each other."""
    monkeypatch.setattr(jaccard_join, "COMPARED", 40)
    rng = random.Random(16)
    words, rows = prose(rng, 120).split(), []
    for k in range(500):
        own = list(words)
        for at in rng.sample(range(120), rng.randrange(0, 14)):
            own[at] = f"n{k}x{at}"
        rows.append((k, " ".join(own)))
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), bucket=16).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == plain_links(rows)


def test_rows_that_repeat_an_id_or_have_none(spark):
    rng = random.Random(17)
    body, other, third = prose(rng, 80), prose(rng, 90), prose(rng, 70)
    rows = [(7, body + " more"), (8, "a short text"), (8, body), (None, other), (None, third), (None, third + " end"), (9, third), (9, third), (3, None), (3, "")]
    got = Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(7, 7, 2, 1): 1, (8, 7, 2, 1): 1, (8, 8, 1, 0): 1, (None, None, 1, 0): 1, (None, 9, 4, 3): 2, (9, 9, 4, 3): 2, (3, 3, 1, 0): 2})
    kept = [(r.doc_id, r.text) for r in jaccard_join.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert Counter(kept) == Counter([(7, body + " more"), (8, "a short text"), (None, other), (9, third), (3, None), (3, "")])


# --- WARC --------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    big, other = "<p>" + "ü\r\n\r\nWARC/1.1\r\n" * 20, "x" * 150
    rows = [(3, "http://a/\r\nb", big), (1, None, big), (2, "u", other), (5, "u", "short"), (6, "u", "short"), (7, "u", None), (9, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"), records_per_file=4)
    digest = lambda html: hashlib.sha256((html or "").encode()).hexdigest()[: warc.DIGEST_CHARS]
    got = {int(r.capture_id.rpartition(":")[2]): r for r in warc.captures(warc.read_warc(spark, str(tmp_path / "w"))).collect()}
    assert sorted(got) == [1, 2, 3, 5, 6, 7, 9]
    for i, _, html in rows:
        r, payload = got[i].response, (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", f"urn:capture:response:{digest(big)}:1") if i in (3, 9) else ("response", None))
        assert r.record_type == "revisit" or bytes(r.payload) == payload
        assert got[i].request.record_id == f"urn:capture:request:{digest(html)}:{i}" and got[i].metadata.record_id == f"urn:capture:metadata:{digest(html)}:{i}"


def test_rows_that_repeat_a_page_id_or_have_none(spark, tmp_path):
    """No payload is lost: of equal ones a row with an id holds it, and every other payload is in a response of its own."""
    a, b = "A" * 150, "B" * 150
    rows = [(1, "u", a), (5, "u", a), (5, "u", b), (None, "u", a), (None, "v", "C" * 200), (None, "w", None)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = warc.captures(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    name = lambda r: r.capture_id.rpartition(":")[2]
    assert Counter((name(r), r.response.record_type) for r in got) == Counter({("1", "response"): 1, ("5", "revisit"): 1, ("5", "response"): 1, ("", "revisit"): 1, ("", "response"): 2})
    assert {bytes(r.response.payload) for r in got if r.response.record_type == "response"} == {a.encode(), b.encode(), b"C" * 200, b""}
    by_name = {r.capture_id: r for r in got}
    for r in got:
        if r.response.record_type == "revisit":
            assert by_name[r.response.refers_to].response.payload_sha256 == r.response.payload_digest


def test_no_pages(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.captures(warc.read_warc(spark, str(tmp_path / "w"))).count() == 0


def test_members_of_gzip_and_cut_off_files():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    assert [b for _, b in warc.parse(warc.unpacked(gzip.compress(record) + gzip.compress(record)))] == [b"hi", b"hi"]
    with pytest.raises(ValueError):
        list(warc.parse(warc.unpacked(record[:-6])))
    with pytest.raises(ValueError):
        list(warc.parse(warc.unpacked(gzip.compress(record * 50)[:-12])))


# --- BPE ---------------------------------------------------------------------------


def test_ids_equal_the_library(edge, empty):
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(bpe.encode(edge, RANKS, public_tokenizers.PATTERN), RANKS).collect())
    want = Counter()
    for i, t in edge_texts():
        ids = ENCODING.encode_ordinary(t or "")
        want[(i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())] += 1
    assert got == want
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN, decoded=True).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\x1c\x85\xa0 'stdlm.,!aZé9٣字"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_pre_tokens_equal_the_library(texts):
    cutter = bpe.PreTokens(public_tokenizers.PATTERN)
    codes = cutter.add(texts)
    words = list(cutter.words)
    for t, c in zip(texts, codes, strict=True):
        found = [words[k] for k in bpe.from_varint(c).tolist()]
        assert "".join(found) == t
        assert [i for w in found for i in ENCODING._encode_single_piece(w)] == ENCODING.encode_ordinary(t)


@given(st.lists(st.integers(0, (1 << 28) - 1)))
def test_varints(numbers):
    assert bpe.from_varint(bpe.to_varint(np.array(numbers, np.int64))).tolist() == numbers


# --- passages ----------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 9))
def test_compact_windows_equal_brute_force(tokens, least):
    hashes = np.array([(t * 2654435761 % 1009) << 30 for t in tokens], np.uint64)
    got = set(zip(*(x.tolist() for x in substring_dedup.compact_windows(hashes, np.array([0]), np.array([len(tokens)]), least)), strict=True))
    want = set()
    for a in range(len(tokens)):
        for b in range(a + least, len(tokens) + 1):
            c = min(range(a, b), key=lambda k: (hashes[k], k))
            left = c
            while left and (hashes[left - 1] > hashes[c]):
                left -= 1
            right = c + 1
            while right < len(tokens) and hashes[right] >= hashes[c]:
                right += 1
            want.add((left, c, right))
    assert got == want


def test_passages(edge, empty):
    got = {(r.doc_id, r.first_doc_id): r for r in substring_dedup.repeated_passages(edge).collect()}
    assert {k for k in got} == {(2, 1), (3, 1), (11, 10), (13, 12), (19, 1)}
    r, text = got[(13, 12)], dict(edge_texts())[13]
    cut = text[r.start_char : r.end_char].split()
    assert 70 <= len(cut) <= 74 and all(w in cut for w in dict(edge_texts())[12].split()[90:160])
    assert r.similarity >= 0.8 and r.end_word - r.start_word == len(cut)
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_passages_are_cut_out(edge):
    got = substring_dedup.without_repeated_passages(edge)
    assert got.columns == edge.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    known = dict(edge_texts())
    assert texts[1] == known[1] and texts[12] == known[12] and texts[4] is None and texts[19] == ""
    assert not set(texts[13].split()) & set(known[12].split()[92:158])
    assert got.count() == len(edge_texts())


def test_planted_passages_are_found(spark):
    """Every passage of 51 words that an earlier document has is found; documents without one have no row."""
    rng = random.Random(11)
    passages = [prose(rng, 51, prefix=f"p{k}x") for k in range(40)]
    rows = [(k, " ".join([prose(rng, 30 + k), passages[k % 40], prose(rng, 20)])) for k in range(160)]
    rows += [(500 + k, prose(rng, 120)) for k in range(60)]
    got = {r.doc_id: r.first_doc_id for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k % 40 for k in range(40, 160)}


def test_words_and_their_places():
    for _, text in edge_texts():
        text = text or ""
        spans = word_spans(text)
        assert [text[a:b].lower() for a, b in spans.tolist()] == split_words(text)


def test_words_of_any_character():
    """As the regular expression has them, in every script and outside the first plane."""
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b " for c in every), "".join(every), "x\U0001f600y Straße \U00010400\U00010401", "ΣΑΣ ΟΔΟΣ İstanbul_1", "— … 　", "—", "", "é"]
    for text in texts:
        found = [(m.start(), m.end()) for m in re.finditer(r"\w+", text)] or [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
        assert [tuple(s) for s in word_spans(text).tolist()] == found
        words = re.findall(r"\w+", text) or text.split()
        assert split_words(text) == ("\n".join(words).lower().split("\n") if words else [])


def test_word_hashes_do_not_depend_on_what_is_remembered():
    words = [f"w{k % 70}" for k in range(500)]
    few, many = Hasher(10), Hasher()
    assert (few.words(words) == many.words(words)).all() and (few.words(words[:3]) == many.words(words[:3])).all()
    assert len(few.known) == 3 and len(many.known) == 70
