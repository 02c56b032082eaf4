"""The token automaton against the tokenizers library and against plain merging."""

import hashlib
import json
import pickle
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from tokenizers import Tokenizer

from opinionlens.llm import bpe_automaton, queries


@pytest.fixture(scope="module")
def path():
    return queries.model_path(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def codec(path):
    content = bpe_automaton.read_vocabulary(path)
    return bpe_automaton.Codec(content, *bpe_automaton.compile_merges(content), bpe_automaton.disputed_letters())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode(docs, rows, path, library):
    encoded = bpe_automaton.encode(docs, path, digest="kept")
    assert set(encoded.columns) == set(docs.columns)
    expected = [(d, ids_of(library, t)) for d, t, _ in rows]
    digest = lambda ids: hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["kept"]) for r in encoded.collect()) == Counter((d, tuple(i), digest(i)) for d, i in expected)
    decoded = bpe_automaton.decode(encoded, path, decoded="text").select("doc_id", "text").collect()
    assert Counter(map(tuple, decoded)) == Counter((d, t or "") for d, t, _ in rows)


def test_odd_texts(codec, library):
    """Special strings, apostrophes, runs of white space, letters of late Unicode editions, junk."""
    rng = random.Random(5)
    texts = ["<|endoftext|>", "a <|endoftext|><|endoftext|> b", "<|endoftext", "it's I'LL 'tis", "a  \n\n b\t ", "\u0085\x1c᠎ x", "꟱Ᲊ x๑", "\U0001fae9\U000323b0"]
    texts += ["".join(rng.choices(["a", " ", " ", "\n", "\t", ".", "\u00a0", "\x1c"], k=12)) for _ in range(2000)]
    texts += ["".join(rng.choices(["a", " ", " ", "\n", "\t", ".", "\u00a0", "\x1c"], k=12)) for _ in range(2000)]
    texts += ["".join(rng.choices("aab ab\n'é中<|>0 1", k=60)) for _ in range(300)] + ["a" * 999, "ab" * 999]
    kinds = [range(32, 127), range(0x20, 0x3000), range(0x10000, 0x20000)]
    texts += ["".join(chr(rng.choice(rng.choice(kinds))) for _ in range(40)) for _ in range(300)]
    assert [codec.encode(t) for t in texts] == [np.array(ids_of(library, t), "<u4").tobytes() for t in texts]
    ids = [[rng.randrange(50_257) for _ in range(20)] for _ in range(300)]
    assert [codec.decode(i) for i in ids] == [library.decode(i, skip_special_tokens=False) for i in ids]


def test_every_letter_is_cut_as_the_library_does(codec, library):
    cut = library.pre_tokenizer.pre_tokenize_str
    for c in map(chr, [*range(0x3100), *range(0xD7A0, 0xD800), *range(0xF900, 0x11000, 3)]):
        text = f"x{c}1{c}#{c} {c}{c}a"
        assert codec.split(text) == [text[i:j] for _, (i, j) in cut(text)]


def test_small_tables_change_nothing(codec, library, monkeypatch):
    """A task that forgets its transitions and words finds the same encodings."""
    monkeypatch.setattr(bpe_automaton, "MOST_WORDS", 3)
    small = bpe_automaton.Codec(codec.content, codec.vocabulary, codec.automaton, codec.disputed)
    small.encoder.most = 7
    text = "The quick brown foxes jumped; antidisestablishmentarianism, 12345 und Straßenbahnhaltestelle"
    assert small.encode(text) == np.array(ids_of(library, text), "<u4").tobytes()
    assert len(small.encoder.rows) < 20 and len(small.known) <= 3


def _file(merges):
    letters = bpe_automaton.byte_letters()
    names = letters + ["".join(m) for m in merges]
    return json.dumps(
        {
            "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
            "model": {"type": "BPE", "vocab": {n: i for i, n in enumerate(names)}, "merges": [list(m) for m in merges]},
        }
    )


def _merged(word, merges):
    """Every merge in order, from left to right."""
    parts = list(word)
    for a, b in merges:
        i, out = 0, []
        while i < len(parts):
            pair = parts[i : i + 2] == [a, b]
            out.append(a + b if pair else parts[i])
            i += 1 + pair
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(8))
def test_random_merges(seed):
    """Gadgets of random merges, pairs of one token among them, give the encodings of the merges."""
    rng, merges, known = random.Random(seed), [], ["a", "b", "c"]
    while len(merges) < 25:
        a, b = rng.choice(known), rng.choice(known)
        if a + b not in known and len(a + b) < 9:
            merges.append((a, b))
            known.append(a + b)
    vocabulary, automaton = bpe_automaton.compile_merges(_file(merges))
    encoder = bpe_automaton.Encoder(vocabulary, automaton)
    for _ in range(400):
        word = "".join(rng.choices("abc", k=rng.randint(1, 30)))
        assert [vocabulary.labels[t].decode() for t in encoder.encode(word.encode())] == _merged(word, merges)


def test_pairs_that_a_path_holds(codec):
    """Behind each token the automaton has exactly those that stand beside it in some encoding."""
    rng, encoder = random.Random(2), codec.encoder
    tokens = [t for t in range(50_000) if codec.automaton.state[t] >= 0]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        word = codec.vocabulary.labels[a] + codec.vocabulary.labels[b]
        assert encoder.goes_on(encoder.after[a], b) == (encoder.encode(word).tolist() == [a, b])


def test_refused_files():
    good = json.loads(_file([("a", "b")]))
    with pytest.raises(ValueError):
        bpe_automaton.Vocabulary(json.dumps({**good, "normalizer": {"type": "NFC"}}))
    with pytest.raises((ValueError, KeyError)):
        bpe_automaton.Vocabulary(_file([("ab", "c"), ("a", "b")]))


def test_long_words(codec, library):
    word = "".join(random.Random(1).choices("ab", k=300_000))
    assert codec.encode(word) == np.array(ids_of(library, word), "<u4").tobytes()
    assert codec.decode(np.frombuffer(codec.encode(word), "<u4").tolist()) == word


def test_compiled_tables_are_small(path):
    content = bpe_automaton.read_vocabulary(path)
    assert len(pickle.dumps(bpe_automaton.compile_merges(content))) < 8 << 20


def test_decode_of_odd_ids(spark, path, library):
    df = spark.createDataFrame([(1, None), (2, []), (3, [5, None, 99999, -4]), (4, [260, 300])], "n int, ids array<int>")
    found = dict(bpe_automaton.decode(df, path).select("n", "decoded").collect())
    assert found == {1: None, 2: "", 3: library.decode([5]), 4: library.decode([260, 300])}


def test_decode_makes_no_object_of_an_id(codec, path, library, monkeypatch):
    texts = ["ab cde \u00e9\u4e2d", "", "x" * 40, " the end\n\n"] * 50
    lists = [ids_of(library, t) for t in texts]
    lists[3] = [*lists[3], None, -1, 10**6, codec.vocabulary.bytes[0xE4]]
    batch = pa.RecordBatch.from_arrays([pa.array([*lists, None], pa.list_(pa.int32()))], names=["ids"])
    spelled, seen = [], []
    monkeypatch.setattr(bpe_automaton, "_shipped", lambda df, path: None)
    monkeypatch.setattr(bpe_automaton, "_codec", lambda shipped: codec)

    class Labels(list):
        def __getitem__(self, i):
            seen.append(i)
            return super().__getitem__(i)

    class Frame:
        schema, columns = StructType([StructField("ids", ArrayType(IntegerType()))]), ["ids"]

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            spelled.extend(next(run(iter([batch]))).column(1).to_pylist())

    monkeypatch.setattr(codec.vocabulary, "labels", Labels(codec.vocabulary.labels))
    bpe_automaton.decode(Frame(), path)
    assert spelled == [*texts[:3], texts[3] + "\ufffd", *texts[4:], None]
    assert not seen


def test_empty(no_docs, path):
    assert bpe_automaton.decode(bpe_automaton.encode(no_docs, path), path).collect() == []


def test_query(spark, sf_dir, library):
    found = {r["doc_id"]: r for r in queries.op11_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = ids_of(library, r["text"])
        own = found[r["doc_id"]]
        assert (own["n_tokens"], own["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
