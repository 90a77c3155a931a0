"""License scans against exact containment computed in every place."""

import random

import pyarrow as pa
import pytest

from tallyframe.llm import licenses
from tallyframe.llm import queries as llm
from tallyframe.llm.words import word_chunks
from test_decontaminate import split
from test_oracle import SF_DIR

INDEX = licenses.build_index(licenses.TEMPLATES)


def runs(words):
    return [tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []


def brute(text):
    """Templates whose shingles a stretch of the text as long as the template holds."""
    own = runs(split(text))
    out = {}
    for name, template in licenses.TEMPLATES.items():
        words = split(template)
        wanted = set(runs(words))
        if len(wanted & set(own)) < licenses.CONTAINMENT * len(wanted):
            continue
        best = max((len(wanted & set(own[i : i + len(words)])) / len(wanted) for i in range(len(own))), default=0)
        if best >= licenses.CONTAINMENT - 1e-9:
            out[name] = best
    return out


def scan(texts):
    out = [{} for _ in texts]
    for words in word_chunks(pa.array(texts, pa.string())):
        for d, t, share, _ in INDEX.scan(words):
            out[words.first + d][INDEX.names[t]] = share
    return out


def test_every_template_is_found_wherever_it_stands():
    rng = random.Random(3)
    texts = []
    for name, template in licenses.TEMPLATES.items():
        for before in (0, 1, 2, 3, 5, 40, 333):
            filler = [f"w{rng.randrange(10**6)}" for _ in range(before + 50)]
            texts.append(" ".join(filler[:before]) + "\n" + template.upper() + ".\n" + " ".join(filler[before:]))
    found = scan(texts)
    names = [n for n in licenses.TEMPLATES for _ in range(7)]
    assert all(got.get(n) == 1.0 for n, got in zip(names, found))
    for text, got in zip(texts, found):
        assert set(brute(text)) <= set(got)


def test_odd_texts():
    texts = ["", None, "mit", "released under", "Released under the MIT License " * 500, "x " * 40000]
    assert [set(x) for x in scan(texts)] == [set(), set(), set(), set(), {"mit"}, set()]
    assert licenses.build_index({}).scan(next(word_chunks(pa.array(["a b c d"])))) == []


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, folder):
    folder = SF_DIR.replace("sf0.001", folder)
    got = {r.doc_id: r for r in llm.op7_license_scan(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = {i: brute(t) for i, t in texts.items() if "icens" in (t or "")}
    assert set(got) == set(texts)
    assert {i: r.licenses for i, r in got.items() if r.n_licenses} == {
        i: ",".join(sorted(found)) for i, found in expected.items() if found
    }
    assert any(expected.values())


def test_versions_and_variants_are_told_apart():
    gpl = "This work is licensed under the GNU General Public License, version {}"
    mpl = licenses.TEMPLATES["mpl-2.0"]
    texts = [gpl.format(2), gpl.format(3), mpl, mpl.replace("2.0", "1.1"), *licenses.TEMPLATES.values()]
    found = [set(x) for x in scan(texts)]
    assert found[:4] == [{"gpl-2"}, {"gpl-3"}, {"mpl-2.0"}, set()]
    assert found[4:] == [{name} for name in licenses.TEMPLATES]
