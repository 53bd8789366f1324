"""Exact dedup, line dedup, sharding and SimHash against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm.conftest import edge_texts

from tillsight.llm import exact_dedup, line_dedup, queries, sharding, simhash


def normalized(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_duplicates(edge, block):
    rows = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_duplicates(edge, block=block).collect()]
    groups = defaultdict(list)
    for i, t in edge_texts():
        groups[normalized(t)].append(i)
    known = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert Counter(r[0] for r in rows) == Counter(i for i, _ in edge_texts())
    for i, keep, size, kept, sha in rows:
        ids = [x for x in known[sha] if x is not None]
        assert size == len(known[sha]) and keep == (min(ids) if ids else None)
        assert not kept or i == keep
    assert sum(r[3] for r in rows) == len(groups)


def test_equal_blocks_in_other_orders_are_told_apart(spark):
    rows = [(1, "ab" * 40 + "cd" * 40), (2, "cd" * 40 + "ab" * 40), (3, "ab" * 40 + "cd" * 40), (4, "ab" * 40), (5, "ab" * 41)]
    out = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=4)
    assert {r.doc_id: r.keep_id for r in out.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def plain_line_dedup(rows):
    seen, first = {}, []
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0], hashlib.md5(r[1].encode()).hexdigest())):
        lines = t.split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            run = "\n".join(lines[k : k + 3])
            if re.search(r"\S", run):
                if run in seen:
                    gone |= {k, k + 1, k + 2}
                else:
                    seen[run] = (i, k)
        first.append(((i, t), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return dict(first)


def test_line_dedup(edge):
    want = plain_line_dedup(edge_texts())
    out = line_dedup.without_repeated_lines(edge)
    assert set(out.columns) == {*edge.columns, "lines", "removed_lines"}
    got = out.collect()
    assert len(got) == len(edge_texts())
    for r in got:
        if r.doc_id is not None:
            text = next(t for i, t in edge_texts() if i == r.doc_id)
            assert (r.text or "") == want[(r.doc_id, text or "")]
    assert next(r.text for r in got if r.doc_id == 4) is None
    assert next(r.text for r in got if r.doc_id == 15) == "x\ny"


def test_line_dedup_keeps_columns_of_its_names(edge):
    from pyspark.sql import functions as F

    out = line_dedup.without_repeated_lines(edge.withColumn("lines", F.lit("mine")).withColumn("REMOVED_lines", F.lit(9)))
    assert {"lines", "lines_", "REMOVED_lines", "removed_lines_"} <= set(out.columns)
    assert {(r["lines"], r["REMOVED_lines"]) for r in out.collect()} == {("mine", 9)}


def test_a_long_text_that_repeats(spark):
    import time

    text = "\n".join(f"line {k % 4000}" for k in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: (r.lines, r.removed_lines) for r in line_dedup.without_repeated_lines(df).collect()}
    assert got == {1: (100_000, 96_000), 2: (100_000, 100_000)}
    assert time.time() - start < 60


def test_rows_without_an_id_are_spread(spark):
    df = spark.createDataFrame([(None if k % 3 else k, "t" * 40) for k in range(6000)], "doc_id long, text string")
    rows, _ = sharding.shard_by_slots(df, shards=8, slots=512)
    total = Counter()
    for r in rows.collect():
        total[r.shard] += r["size"]
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 0.02 * sum(total.values())


def test_a_stored_map_is_edited(spark, tmp_path):
    path = str(tmp_path / "map")
    one = spark.createDataFrame([(k, "x" * (k % 50)) for k in range(3000)], "doc_id long, text string")
    more = one.unionByName(spark.createDataFrame([(k, "y" * 200) for k in range(3000, 3400)], "doc_id long, text string"))
    first, _ = sharding.shard_by_slots(one, shards=4, slots=128, map_path=path)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    again, versions = sharding.shard_by_slots(more, shards=99, slots=7, map_path=path)
    after = {r.virtual_slot: r.shard for r in again.collect()}
    assert sorted({r.version for r in versions.collect()}) == [0, 1, 2]
    number, stored = sharding.load_map(spark, path)
    assert number == 2 and all(stored[s] == shard for s, shard in after.items()) and len(stored) == 128
    _, old = sharding.load_map(spark, path, 1)
    assert all(old[s] == shard for s, shard in before.items())
    moved = {r.virtual_slot for r in versions.collect() if r.version == 2 and r.moved}
    assert moved == {s for s in old if old[s] != stored[s]} and 0 < len(moved) < 64


def test_shards_are_even_and_gapless(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, versions = sharding.shard_by_slots(docs, shards=5, slots=512)
    got = rows.collect()
    assert len(got) == docs.count()
    total = Counter()
    for shard in {r.shard for r in got}:
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        total[shard] = sum(r["size"] for r in own)
    assert max(total.values()) - min(total.values()) < 0.02 * sum(total.values()) / 5
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r["size"] == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in got)
    # the second version is an edit of the first
    by_version = defaultdict(dict)
    for r in versions.collect():
        by_version[r.version][r.virtual_slot] = (r.shard, r.moved)
    assert all(moved == (by_version[0][slot][0] != shard) for slot, (shard, moved) in by_version[1].items())


def test_shard_edges(edge, empty):
    rows, _ = sharding.shard_by_slots(edge, shards=3, slots=64)
    assert Counter(r.doc_id for r in rows.collect()) == Counter(i for i, _ in edge_texts())
    assert sharding.shard_by_slots(empty, shards=3, slots=64)[0].count() == 0


def test_grown_map_moves_slots_to_the_new_shard_only():
    load = {s: 100 + s % 7 for s in range(256)}
    before = sharding.rebalanced(sharding.first_map(4, 256), load, 4)
    after = sharding.grown(before, load, 4)
    assert all(b == a or b == 4 for a, b in ((before[s], after[s]) for s in before))
    share = sum(load[s] for s, x in after.items() if x == 4) / sum(load.values())
    assert abs(share - 0.2) < 0.02


def test_edited_texts_and_likeness(edge):
    rows = [(i, t or "") for i, t in edge_texts()]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).digest()))
    want = Counter()
    for k, (i, t) in enumerate(order):
        third, following = len(t) // 3, order[(k + 1) % len(order)][1]
        edited = t[: len(t) - third] + following[:third]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    got = simhash.edited_fingerprints(edge).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    same = defaultdict(set)
    for r in got:
        same[next(t or "" for i, t in rows if i == r.doc_id)].add(r.fingerprint)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    assert next(r.fingerprint for r in got if r.doc_id == 5) == 0


def test_near_fingerprints_are_all_found(spark):
    import random

    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for v in base:
        for flips in (1, 2, 3, 4):
            x = v
            for bit in rng.sample(range(64), flips):
                x ^= 1 << bit
            values.add(x)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = {(r.a, r.b, r.distance) for r in simhash.near_fingerprints(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()}
    want = {(a, b, bin((a ^ b) & (1 << 64) - 1).count("1")) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert got == want


def test_fingerprint_votes(spark):
    text = "Alpha beta, alpha beta gamma. Delta"
    df = spark.createDataFrame([(1, text), (2, text), (3, "solo"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in simhash.fingerprints(df, ["doc_id"]).collect()}
    words = re.split(r"[\W_]+", text.lower())
    pairs = list(zip(words, words[1:], strict=False))
    hashes = [r.h for r in spark.createDataFrame(pairs, "a string, b string").selectExpr("xxhash64(b, a) AS h").collect()]
    want = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    assert got[1] & (1 << 64) - 1 == want and got[1] == got[2] and got[4] == 0


def test_empty_tables(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert line_dedup.without_repeated_lines(empty).count() == 0
    assert simhash.edited_fingerprints(empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_equals_sql(spark, sf, name):
    from compare import check, connect

    rows, problem, _ = check(spark, connect(sf), name, queries.registry()[name], queries.oracle()[name], sf)
    assert problem is None and rows > 0
