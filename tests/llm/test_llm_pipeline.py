"""The pipeline's stages against the operators' own rules."""

from __future__ import annotations

import re

import pytest
from conftest import TESTDATA

import corpus_pipeline
from wearline.llm.common import materialised

INSULTS = re.compile(r"(?i)\b(loser|trash|scum|pathetic|idiot|stupid|worthless|clown|moron|disgusting)\b")


@pytest.fixture(scope="module")
def stages(spark):
    folder = str(TESTDATA.parent / "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialised(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "secret_scan", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_documents_go_and_clean_ones_stay(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[:2])
    insulting = {i for i, t in before.items() if len(set(INSULTS.findall(t.lower()))) >= 2}
    assert len(insulting & after.keys()) <= 0.05 * len(insulting)
    gone = before.keys() - after.keys()
    assert sum(bool(INSULTS.search(before[i])) for i in gone) >= 0.8 * len(gone)


def test_one_row_of_equal_texts_stays(stages):
    before, after = (s.collect() for s in stages[1:3])
    largest = {}
    for r in before:
        largest[r.text] = max(largest.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(largest.values())


def test_near_copies_go(stages):
    from test_llm_operators import plain_fingerprint, reachable

    prints = {r.doc_id: plain_fingerprint(r.text) for r in stages[2].collect()}
    assert {r.doc_id for r in stages[3].collect()} == set(reachable(prints, list(prints)).values())


def test_secrets_are_replaced_and_all_rows_packed(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[3:5])
    assert before.keys() == after.keys()
    for i, text in before.items():
        if re.search('token = "[0-9a-f]{40}"', text):
            assert "[SECRET]" in after[i]
        elif not re.search("[0-9]", text):
            assert after[i] == text
    assert {r.doc_id for r in stages[5].select("doc_id").collect()} == after.keys()


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, str(TESTDATA)).count() > 0


CLASHING = ["_key", "_any", "_verdicts", "_replaced", "_scores", "_print", "_KEY2", "kept", "fp", "number", "is_secret"]
SECRET = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
ODD = [
    (None, None), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "long words " * 20_000), (5, "long words " * 20_000),
    (6, f"plain words here and {SECRET} behind"), (7, "tie"), (8, "tie"), (None, "tie"), (9, "x" * 5000),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_clashing_names(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = f"doc_id long, text string, {', '.join(f'`{c}` string' for c in CLASHING)}"
    rows = [(*r, *(f"{c} of {n}" for c in CLASHING)) for n, r in enumerate(ODD)]
    odd = spark.createDataFrame(rows, schema)
    found = stage(spark, odd, str(TESTDATA))
    if name == "packing":
        pieces = found.collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in pieces if r.piece == 0) == sorted(
            (i is None, i or 0) for i, _ in ODD
        )
        assert stage(spark, odd.limit(0), str(TESTDATA)).collect() == []
        return
    assert found.columns == odd.columns
    given = {r[2]: r for r in rows}
    for r in found.collect():
        before = given[r["_key"]]
        assert tuple(r)[2:] == before[2:] and r.doc_id == before[0]
        if name == "secret_scan" and SECRET in (before[1] or ""):
            assert r.text == before[1].replace("24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "[SECRET]")
        else:
            assert r.text == before[1]
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect())
    if name in ("toxicity", "secret_scan"):
        assert ids == sorted((i is None, i or 0) for i, _ in ODD)
    elif name == "exact_dedup":
        assert ids == [(False, i) for i in (2, 3, 5, 6, 8, 9)]
    else:
        # Few words make equal or empty fingerprints; every group keeps its smallest id.
        assert {i for _, i in ids} <= {1, 4, 6, 7, 9} and (True, 0) not in ids
    assert stage(spark, odd.limit(0), str(TESTDATA)).collect() == []
