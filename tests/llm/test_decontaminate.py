"""Suffix-array decontamination against a plain search of every window."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.decontaminate import build_test_set, contamination, decontaminated, search_texts, with_matches

PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(text, items, n):
    """(words, hit positions, {item index: longest match})."""
    words = split(text)
    hit, longest = set(), {}
    for k, item in enumerate(items):
        own = split(item)
        if not own:
            continue
        m = min(n, len(own))
        for j in range(len(own) - m + 1):
            for i in range(len(words) - m + 1):
                if words[i : i + m] == own[j : j + m]:
                    hit.update(range(i, i + m))
                    length = m
                    while i + length < len(words) and j + length < len(own) and words[i + length] == own[j + length]:
                        length += 1
                    longest[k] = max(longest.get(k, 0), length)
    return len(words), hit, longest


texts = st.lists(st.one_of(st.none(), st.lists(st.sampled_from("a b c B d!".split()), max_size=30).map(" ".join)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts, texts, st.integers(1, 12))
def test_search_equals_brute_force(docs, items, n):
    test = build_test_set(pa.array(range(len(items)), pa.int64()), pa.array(items, pa.string()), n)
    found = search_texts(pa.array(docs, pa.string()), test).to_pylist()
    for text, row in zip(docs, found):
        n_words, hit, longest = brute(text, items, n)
        got = {i for s, e in zip(row["spans"][::2], row["spans"][1::2]) for i in range(s, e)}
        assert (row["n_words"], got) == (n_words, hit)
        assert {m["item_id"]: m["length"] for m in row["matches"]} == longest
        for m in row["matches"]:
            ours, theirs = split(text)[m["doc_word"] :], split(items[m["item_id"]])[m["item_word"] :]
            assert ours[: m["length"]] == theirs[: m["length"]]


DOCS = [
    (1, "One two three four five six seven eight nine ten, eleven", "x"),
    (2, "nothing of it", "x"),
    (3, None, None),
    (4, "", "y"),
    (5, "say: short ITEM here. short item", "y"),
    (5, "say: short ITEM here. short item", "y"),
    (None, "zero one two three four five six seven eight nine ten", None),
]
ITEMS = [
    (10, "one two three four five six seven eight nine ten eleven twelve"),
    (9, "short item"),
    (9, "short item"),
    (None, "here short"),
    (7, ""),
    (6, None),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_contamination(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, found string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    from tallyframe.llm import decontaminate

    rows = decontaminate.with_matches(docs, items, "f", block_bytes=block_bytes).collect()
    for row in rows:
        n_words, hit, longest = brute(row.text, [t for _, t in ITEMS], 10)
        got = {i for s, e in zip(row.f.spans[::2], row.f.spans[1::2]) for i in range(s, e)}
        assert (row.f.n_words, got) == (n_words, hit)
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in contamination(docs, items).collect()}
    assert got == {(1, 11, 11, ("10",)), (2, 3, 0, ()), (3, 0, 0, ()), (4, 0, 0, ()), (5, 6, 5, ("9",)), (None, 11, 10, ("10",))}
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b")], docs.schema)
    assert [(r.n_words, r.n_hit) for r in contamination(one, items).collect()] == [(2, 0)]
    assert hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_ids_of_text_and_repeated_items(spark, block_bytes):
    said = " ".join(f"w{k}" for k in range(12))
    items = [("q-1", said), ("q-1", said), ("9z", "one two"), (None, "three"), ("empty", None)] * 5
    frame = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {said} y one two"), (2, "three"), (3, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["found"] for r in with_matches(docs, frame, block_bytes=block_bytes).collect()}
    assert sorted((m["item_id"], m["length"]) for m in found[1]["matches"]) == [("9z", 2), ("q-1", 12)]
    assert [m["item_id"] for m in found[2]["matches"]] == [None] and found[3]["matches"] == []
    got = {r.doc_id: r.item_ids for r in contamination(docs, frame).collect()}
    assert got == {1: ["9z", "q-1"], 2: [], 3: []}
