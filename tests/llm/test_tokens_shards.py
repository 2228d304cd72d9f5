import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.packing import closest_multiset, pack_documents
from corpusloom.llm.sharding import pack_vectors, shard_documents
from corpusloom.llm.token_files import read_document, read_token_files, write_token_files
from corpusloom.llm.token_ids import TextIds
from llm.conftest import SYLLABLES, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["It's NAÏVE — 3,000\u00a0km", "x<|endoftext|>y <|startoftext|>", "e\u0301 \u1e9b\u0323 ΑΣ ΣΑΣ", "a\x1cb\x85c\u2028d", "\U0001f600 don't"]


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rows(odd_rows):
    return odd_rows + [(50 + k, t) for k, t in enumerate(ODD)] + [(100 + k, prose(k, 30 + k)) for k in range(60)]


def test_word_by_word_ids_are_the_tokenizers(encode, rows):
    ids = TextIds(PATH)
    assert ids.by_word
    for text, found in zip([t for _, t in rows], ids.batch([t and t.encode() for _, t in rows])):
        assert found.tolist() == encode(text)
    other = TextIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    assert other.batch([b"a  b"])[0].tolist() == other.tokenizer.encode("a  b", add_special_tokens=False).ids


def test_token_files_round_trip(spark, make_docs, encode, rows, tmp_path):
    folder = write_token_files(make_docs(rows), PATH, str(tmp_path / "files"))
    found = read_token_files(spark, folder).collect()
    want = Counter((i, tuple(encode(t) + [1])) for i, t in rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found) == want
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    assert read_document(spark, folder, 103)[0].tolist() == encode(dict(rows)[103]) + [1]
    assert len(read_document(spark, folder, 2)) == 2 and not read_document(spark, folder, 999)


def test_token_files_of_nothing(spark, make_docs, tmp_path):
    folder = write_token_files(make_docs([(1, "x")]).limit(0), PATH, str(tmp_path / "none"))
    assert read_token_files(spark, folder).count() == 0


def test_closest_multiset_like_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        target = rng.randint(1, 70)
        sums = [sum(n * k for n, k in zip(counts, picks)) for picks in product(*[range(c + 1) for c in counts.values()])]
        chosen = closest_multiset(counts, target)
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= target)
        assert all(0 < k <= counts[n] for n, k in chosen.items())


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_keeps_every_id_once(make_docs, encode, rows, capacity):
    pieces = pack_documents(make_docs(rows), PATH, capacity).collect()
    by_sequence = {}
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 > 0
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and at & (at - 1) == 0
    unique = {i: encode(t) + [2] for i, t in rows if i not in (None, 2)}
    for i, ids in unique.items():
        mine = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert sum((np.frombuffer(p["ids"], "<u4").tolist() for p in mine), []) == ids
        assert {p["doc_tokens"] for p in mine} == {len(ids)}
    total = sum(len(encode(t)) + 1 for _, t in rows)
    assert sum(p["length"] for p in pieces) == total
    assert pack_documents(make_docs(rows).limit(0), PATH, capacity).count() == 0


def test_packing_wants_a_power_of_two(make_docs):
    with pytest.raises(ValueError):
        pack_documents(make_docs([(1, "x")]), PATH, 100)


def test_every_letter_and_mixed_words_are_the_tokenizers(encode):
    """Also letters whose lower case is no letter, and marks after letters."""
    letters = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    rng, ids = random.Random(12), TextIds(PATH)
    odd = ["\u0130", "i\u0307", "\u0130stanbul", "D\u0130.", "\u1e9e", "\u212a", "\u00df", "e\u0301", "\ufb01", "\u01c4", ".", "!!", "7"]
    texts = [letter + tail for letter in letters for tail in ("", "a.", "!")]
    texts += [" ".join("".join(rng.choices(odd + SYLLABLES, k=rng.randint(1, 4))) for _ in range(6)) for _ in range(5000)]
    found = [each for at in range(0, len(texts), 500) for each in ids.batch([t.encode() for t in texts[at : at + 500]])]
    for text, each in zip(texts, found):
        assert each.tolist() == encode(text), text


def test_operators_run_on_such_letters(spark, make_docs, encode, tmp_path):
    docs = make_docs([(1, "\u0130stanbul and \u0130zm\u0130r."), (2, "plain")])
    rows = read_token_files(spark, write_token_files(docs, PATH, str(tmp_path / "t"))).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist()[:-1] for r in rows} == {1: encode("\u0130stanbul and \u0130zm\u0130r."), 2: encode("plain")}
    assert pack_documents(docs, PATH).count() >= 2


@pytest.fixture(scope="module")
def nameless(make_docs):
    """6,000 rows, a third of them without an id and of one text."""
    return make_docs([(None, "one text " * 6) if k % 3 == 0 else (k, prose(k, 12)) for k in range(6000)])


def test_rows_without_an_id_are_dealt_out(spark, nameless, tmp_path):
    sizes = shard_documents(nameless, 8).groupBy("shard").agg(F.sum("size").alias("n")).toPandas()["n"]
    assert len(sizes) == 8 and sizes.max() / sizes.min() < 1.02
    folder = write_token_files(nameless, PATH, str(tmp_path / "t"))
    blocks = spark.read.parquet(f"{folder}/blocks").select("shard", F.size("doc_ids").alias("n")).toPandas()
    assert blocks.groupby("shard")["n"].sum().max() < 3000
    found = read_token_files(spark, folder)
    assert found.count() == 6000 and found.where("doc_id is null").count() == 2000


def test_shards_are_balanced_and_groups_whole(spark, make_docs, odd_rows):
    rows = odd_rows + [(1000 + k, prose(k // 2, 20 + k % 90)) for k in range(3000)]
    found = shard_documents(make_docs(rows), 8).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    groups, slots, sizes = {}, {}, Counter()
    for r in found:
        groups.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = [n for n in sizes.values() if n < 150_000]  # one document alone is larger than a shard's share
    assert max(rest) < 1.02 * min(rest)
    assert shard_documents(make_docs(rows).limit(0), 8).count() == 0


def test_a_group_over_a_third_of_the_rows_is_split(make_docs):
    rows = [(k, "the same text again and again" if k % 3 == 0 else prose(k, 6)) for k in range(6000)]
    found = shard_documents(make_docs(rows), 8).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas()
    assert len(found) == 8 and found["b"].max() < 1.02 * found["b"].min()


def test_vectors_are_balanced_in_every_measure():
    rng = np.random.default_rng(4)
    vectors = rng.gamma(0.5, 100, (3000, 3)) * [1, 7, 0.1]
    place = pack_vectors(vectors, 16)
    sums = np.array([vectors[place == s].sum(axis=0) for s in range(16)])
    assert (sums.max(axis=0) < 1.01 * sums.min(axis=0)).all()
