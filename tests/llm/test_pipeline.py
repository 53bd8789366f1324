"""The pipeline on a small corpus, stage by stage against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm.conftest import SCHEMA, prose
from llm.test_free_operators import plain_links
from llm.test_native_operators import plain_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from tillsight.llm import language, queries
from tillsight.llm.words import split_words


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Two languages, strange texts, repeated lines, near copies and a shared passage, as a table of documents."""
    rng = random.Random(21)
    english, spanish = (["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(3000)] for letters in ("abcdefgh", "ñóprstuvá"))
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(k, text(english, 80), "en") for k in range(60)] + [(100 + k, text(spanish, 80), "es") for k in range(60)]
    rows += [(200 + k, " ".join("".join(rng.choice("kqxzwjy") for _ in range(12)) for _ in range(40)), None) for k in range(5)] + [(210, "12 34 !!", None), (211, None, None), (212, "", "en")]
    lines = [text(english, 9) for _ in range(6)]
    rows += [(300 + k, "\n".join([text(english, 30), *lines, text(english, 30)]), "en") for k in range(4)]
    for k in range(8):
        words = rows[k][1].split()
        words[40] = f"changed{k}"
        rows.append((400 + k, " ".join(words), "en"))
    passage = text(spanish, 70)
    rows += [(500 + k, f"{text(spanish, 40)} {passage} {text(spanish, 30 + k)}", "es") for k in range(3)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, la, "s", len(t or ""), 1, "k", "x") for i, t, la in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder), rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = queries.table(spark, folder, "documents")
    known = {i: t for i, t, _ in rows}
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        df = step(spark, docs, folder)
        before = kept or known
        if name != "packing":
            assert df.columns == docs.columns
            kept = rows_of(df)
            assert df.count() == len(kept)
        if name == "language_id":
            assert set(kept) == {i for i, _, la in rows if la and i != 212} and all(kept[i] == known[i] for i in kept)
        elif name == "line_dedup":
            want = plain_line_dedup(list(before.items()))
            assert kept == {i: want[(i, t)] for i, t in before.items()} and all(kept[i] != known[i] for i in (301, 302, 303))
        elif name == "near_duplicates":
            links = plain_links(list(before.items()))
            assert set(kept) == {i for i, (root, _) in links.items() if root == i} and not {400 + k for k in range(8)} & set(kept)
        elif name == "passages":
            whole = {i for i in kept if kept[i] == before[i]}
            assert set(kept) == set(before) and set(kept) - whole == {501, 502}
            for i in (501, 502):
                assert 40 + 30 + i - 500 - 6 <= len(split_words(kept[i])) <= 40 + 30 + i - 500
        else:
            tokenizer = Tokenizer.from_file(queries.public_tokenizers.path("word_bpe_49k.json"))
            tokenizer.encode_special_tokens = True
            pieces, sequences = defaultdict(list), Counter()
            for r in df.collect():
                assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
                pieces[r.doc_id].append((r.start, bytes(r.ids)))
                sequences[r.sequence_id] += r.length
            for i, t in kept.items():
                ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
                assert b"".join(x for _, x in sorted(pieces[i])) == b"".join(v.to_bytes(4, "little") for v in ids)
            assert set(pieces) == set(kept) and max(sequences.values()) <= 2048
        docs = df if name == "packing" else spark.createDataFrame(df.collect(), docs.schema)


def test_run_equals_its_stages(spark, corpus):
    folder, _ = corpus
    docs = queries.table(spark, folder, "documents")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
    of = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    got, want = of(corpus_pipeline.run(spark, folder)), of(docs)
    assert sum(n * k[2] for k, n in got.items()) == sum(n * k[2] for k, n in want.items())
    assert {k[0] for k in got} == {k[0] for k in want}


def test_nothing_in_nothing_out(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_pass_through(spark, corpus):
    folder, _ = corpus
    from pyspark.sql import functions as F

    docs = queries.table(spark, folder, "documents")
    for name in ("lines", "score", "rejected", "offset", "class_id", "text_hash"):
        docs = docs.withColumn(name, F.lit(f"my {name}"))
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
    assert {tuple(r) for r in docs.select("lines", "score", "rejected", "offset", "class_id", "text_hash").distinct().collect()} == {
        ("my lines", "my score", "my rejected", "my offset", "my class_id", "my text_hash")}


def test_language_model_is_learned_from_its_own_folds(spark, corpus):
    folder, _ = corpus
    docs = queries.table(spark, folder, "documents")
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, language.fit(docs.filter(~language.held_out()))).collect()}
    assert all(got[i] == la for i, _, la in corpus[1] if la and i != 212) and got[211] == got[210] == "und"


@pytest.mark.parametrize("name", ["op1_packing", "op2_language", "op3_jaccard_join", "op5_sharding", "op6_fingerprints", "op8_bpe", "op9_substring_dedup"])
def test_queries_without_sql_run(spark, sf, name):
    rows = queries.registry()[name](spark, sf)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)
