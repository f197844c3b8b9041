import random

import numpy as np
import pyarrow as pa
import pytest

from flowverdict.llm import licenses
from flowverdict.llm.license_texts import LICENSE_TEXTS

from .plain import shingles

rng = random.Random(11)
VOCABULARY = [f"v{i}" for i in range(300)]


def sentence(n):
    return " ".join(rng.choices(VOCABULARY, k=n))


def documents():
    texts = [None, "", "MIT", sentence(20_000)]
    for _, template in LICENSE_TEXTS:
        for before in (0, 3, 17, 50):
            texts.append(f"{sentence(before)} {template.upper()}! {sentence(9)}")
        words = template.split()
        words[len(words) // 2] = "changed"
        texts.append(sentence(8) + " " + " ".join(words))
    texts += [sentence(80) for _ in range(30)]
    return list(enumerate(texts)) + [(5, texts[5]), (None, texts[6])]


DOCS = documents()


def held(text, template):
    """The best share of the template's shingles in a window of twice its size, at any start.

    A window holds no more than the one that starts at its first shingle of the template.
    """
    own, asked = shingles(text), shingles(template)
    n, wanted = len(asked), set(asked)
    starts = [a for a, s in enumerate(own) if s in wanted]
    return max((len(wanted & set(own[a : a + 2 * n])) / len(wanted) for a in starts), default=0)


def test_against_plain_search(spark):
    templates = [*LICENSE_TEXTS, ("null", None), ("empty", ""), ("short", "mit")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, template string")
    asked = spark.createDataFrame(templates, "template_id string, text string")
    found = licenses.scan_licenses(docs.repartition(3), asked).collect()
    want = {}
    for i, text in DOCS:
        for name, template in templates:
            share = held(text, template or "")
            if share >= 0.8:
                want[i, name] = share
    assert len(want) > 40 and (2, "short") in want
    assert {(r.key, r.template): r.containment for r in found} == pytest.approx(want)
    assert len(found) == len(want) + len([1 for (i, _) in want if i == 5])
    for r in found:
        assert 0 <= r.first_word < r.end_word


def test_bands_keep_their_promise():
    assert licenses.collision_probability() > 0.9998
    draw = np.random.default_rng(5)
    met = 0
    for _ in range(200):
        template = draw.integers(1 << 62, size=20).astype(np.uint64)
        window = draw.integers(1 << 62, size=(1, 40)).astype(np.uint64)
        window[0, 3:19] = template[:16]  # 16 of 20 shingles: containment 0.8
        one = np.ones_like(template[None], dtype=bool)
        keys = licenses.band_keys(template[None], one), licenses.band_keys(window, np.ones((1, 40), bool))
        met += bool((keys[0] == keys[1]).any())
    assert met == 200


def test_empty_tables_and_bounds(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS[:5], "doc_id long, text string")
    templates = spark.createDataFrame(LICENSE_TEXTS, "template_id string, text string")
    assert licenses.scan_licenses(docs.limit(0), templates).collect() == []
    assert licenses.scan_licenses(docs, templates.limit(0)).collect() == []
    monkeypatch.setattr(licenses, "MAX_TEMPLATES", 3)
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, templates)


def test_padding_of_windows_does_not_count():
    table = pa.table({"template": ["t"], "text": ["one two three four five six"]})
    index = licenses.TemplateIndex(table)
    hashes = index.sets[0]
    assert index.search(hashes[:1], np.array([0, 1]), 0.8) == []


def test_inserted_words_do_not_hide_a_license_at_any_offset():
    draw = random.Random(4)
    template = dict(LICENSE_TEXTS)["mit permission"].split()
    half, texts = len(template) // 2, []
    for inserted in (20, 40):
        for before in range(0, 130, 3):
            words = [draw.choices(VOCABULARY, k=k) for k in (before, inserted, 150)]
            texts.append(" ".join(words[0] + template[:half] + words[1] + template[half:] + words[2]))
    table = pa.table({"template": ["mit"], "text": [" ".join(template)]})
    index = licenses.TemplateIndex(table)
    found = index.search(*licenses.shingles_of(pa.array(texts)), 0.8)
    want = {i: held(t, " ".join(template)) for i, t in enumerate(texts)}
    assert min(want.values()) > 0.9
    assert {row: share for row, _, share, _, _ in found} == pytest.approx(want)
    assert licenses.collision_probability(length=2 + 1 / licenses.DENSITY) > 0.999
