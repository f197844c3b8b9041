import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import connect, difference
from flowverdict.llm import quality
from flowverdict.llm.queries import LLM_ORACLES, LLM_QUERIES
from flowverdict.sources.scratch import stored

from .plain import contaminated_pairs, near_duplicate_rows

SF = "/root/testdata/sf0.001"


def test_names():
    numbered = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n.startswith("op"))
    assert numbered == list(range(1, 14)) and "pipeline" in LLM_QUERIES
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_sql(spark, name):
    got = LLM_QUERIES[name](spark, SF).toPandas()
    assert difference(got, connect(SF).execute(LLM_ORACLES[name]).df()) is None
    assert len(got)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_jaccard_join_query(spark, documents):
    got = {r.doc_id: (r.class_id, r.n_links) for r in LLM_QUERIES["op2_jaccard_join"](spark, SF).collect()}
    assert got == near_duplicate_rows(documents)


def test_decontaminate_query(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in LLM_QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert got == contaminated_pairs(documents, items)


@pytest.mark.parametrize("name", ["op4_quality", "op8_lm_scoring"])
def test_one_row_for_each_document(spark, documents, name):
    rows = LLM_QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents)


def pieces_of(documents):
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for i, text in documents:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % 2048 or 2048
        for n, start in enumerate([0, *range(first, len(ids), 2048)]):
            part = ids[start : first if n == 0 else start + 2048]
            yield i, n, start, len(part), zlib.crc32(part.tobytes())


def packed_well(rows, documents):
    rows = rows.toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows[names].to_numpy().tolist())) == sorted(pieces_of(documents))
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        ends = part.offset + part.length
        assert part.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 2048


def test_packing_query(spark, documents):
    packed_well(LLM_QUERIES["op6_packing"](spark, SF), documents)


def test_pipeline_stage_by_stage(spark, documents):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns, texts = frame.columns, dict(documents)
    want = {r.key for r in quality.classify(frame, labels).filter("kept").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and len(want) > 50
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if n == 1:
            groups = {}
            for i in sorted(want):
                groups[texts[i] or ""] = i
            want = set(groups.values())
        elif n == 2:
            want = {c for c, _ in near_duplicate_rows([(i, texts[i]) for i in sorted(want)]).values()}
        elif n == 3:
            want -= {i for i, _ in contaminated_pairs([(i, texts[i]) for i in want], items)}
        frame = stored(stage(spark, frame, SF), name)
        if n < 4:
            assert frame.columns == columns
            assert sorted(r.doc_id for r in frame.collect()) == sorted(want)
    packed_well(frame, [(i, texts[i]) for i in want])
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == frame.columns and whole.count() == frame.count()
