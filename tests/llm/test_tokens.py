"""Spliced token counts against the library's encoding of whole texts."""

import json
import random

import public_tokenizers
import pytest

from tallyframe.llm import queries, tokens

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
PIECES = [
    "a", "b", "the", " ", "\n", "'", "'re", "'s", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "endof", "é", "é", "́",
    "̇", "İ", "Σ", "漢", "字", "。", "😀", "1", "23", "!", "!!", "...", "ᄀ", "ᅡ", "ᆨ", "한", "ﬁ", " ", "　",
    "xxxxx", "aaaa", "hello", "world", "\x1c", "\x00", "ß", "क़", "Å", "ing", "tion", "กำ",
]


@pytest.fixture(scope="module")
def data():
    with open(PATH, "rb") as f:
        return f.read()


def whole(encoder, text):
    return len(encoder.tokenizer.encode(text or "", add_special_tokens=False))


def test_splices_equal_whole_texts(data):
    rng = random.Random(11)
    encoders = [tokens.Encoder(data, chunk, overlap) for chunk, overlap in ((100, 8), (150, 60), (400, 32))]
    for k in range(400):
        some = rng.sample(PIECES, rng.randint(1, 8))
        text = "".join(rng.choice(some) for _ in range(rng.randint(50, 900)))
        encoder = encoders[k % 3]
        assert encoder.count_all([text, None, ""]) == [whole(encoder, text), 0, 0], text


def test_overlaps_widen_and_give_way(data, monkeypatch):
    """Without a common token overlaps grow, then chunks do, and the count stays right."""
    encoder = tokens.Encoder(data, 100, 8)
    asked = []
    cut, spliced = encoder._cut, encoder._spliced
    monkeypatch.setattr(encoder, "_spliced", lambda text, chunk: asked.append(chunk) or spliced(text, chunk))
    marks = "́" * 3000  # no place to cut
    assert encoder.count_all([marks]) == [whole(encoder, marks)]
    assert asked == [100, 400, 1600]
    starts = []
    monkeypatch.setattr(encoder, "_cut", lambda text, at, least: starts.append(at) or cut(text, at, least))
    text = "word " * 20 + "́" * 40 + " word" * 100
    assert encoder.count_all([text]) == [whole(encoder, text)]


def test_memory_is_bounded(data, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 10)
    encoder = tokens.Encoder(data)
    texts = [" ".join(f"w{k}{j}" for j in range(9)) for k in range(30)] + ["x" * 1000]
    assert encoder.count_all(texts[:5]) == [whole(encoder, t) for t in texts[:5]]
    assert encoder.count_all(texts) == [whole(encoder, t) for t in texts]
    assert b"x" * 1000 not in encoder.counts
    assert encoder.count_all(texts[:1]) and len(encoder.counts) <= 10


def test_columns(spark, data):
    encoder = tokens.Encoder(data)
    long = " ".join(["Überraschung"] * 4000) + "é" * 20_000
    rows = [(1, None, 5), (2, "", 5), (2, "a b", 5), (None, "a b", 5), (3, "Hi<|endoftext|> you", 5), (4, long, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, N_Tokens int")
    got = tokens.with_token_counts(frame, PATH, 2)
    assert got.columns == ["doc_id", "text", "N_Tokens", "n_bytes", "n_tokens_", "over_limit"]
    expected = [(i, t, k, len((t or "").encode()), whole(encoder, t), whole(encoder, t) > 2) for i, t, k in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert tokens.with_token_counts(frame.limit(0), PATH, 2).collect() == []


def test_query_equals_the_library(spark, data):
    sf_dir = "/root/testdata/sf0.01"
    encoder = tokens.Encoder(data)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_token_count(spark, sf_dir).collect()}
    assert any(len(t or "") > tokens.CHUNK for t in texts.values())
    counts = {i: whole(encoder, t) for i, t in texts.items()}
    assert got == {i: (len((t or "").encode()), counts[i], counts[i] > 2048) for i, t in texts.items()}


def test_other_tokenizers_are_refused(data):
    tokens.check_tokenizer(data)
    told = json.loads(data)
    told["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError, match="white space"):
        tokens.check_tokenizer(json.dumps(told).encode())
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f, pytest.raises(ValueError):
        tokens.check_tokenizer(f.read())
