"""The pipeline on the smallest table: each stage against a plain reading of its rule."""

import os

import pytest
from test_dedup import plain_kept
from test_text_ops import WORD

from clipspans.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    import corpus_pipeline
    from clipspans.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns
        texts.append({r.doc_id: r.text for r in docs.collect()})
    for before, after in zip(texts, texts[1:]):
        assert after.items() <= before.items() and len(after) > 0.7 * len(before)
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    last = {}
    for i, t in texts[1].items():
        last[lower(t)] = max(i, last.get(lower(t), -1))
    assert set(texts[2]) == set(last.values())
    # near copies: exact similarities of all pairs, the smallest id of each group stays
    ids = sorted(texts[2])
    assert set(texts[3]) == {ids[k] for k in plain_kept([texts[2][i] for i in ids])}
    # benchmark passages: every window against every place
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams: dict[int, set[tuple[str, ...]]] = {}
    for _, body in items:
        w = WORD.findall(lower(body))
        n = min(10, len(w))
        grams.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n)
    hit = lambda t: any(tuple(w[i : i + n]) in g for w in [WORD.findall(lower(t))] for n, g in grams.items() if n for i in range(len(w) - n + 1))
    assert set(texts[4]) == {i for i, t in texts[3].items() if not hit(t)}
    # toxicity: the scores of the query on the whole table
    scores = {r.doc_id: r.predicted for r in toxicity.op8_toxicity(spark, SF).collect()}
    assert set(texts[1]) == {i for i in texts[0] if not scores[i]}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in out} == set(texts[4]) and all(r.exact for r in out)
    assert corpus_pipeline.run(spark, SF).count() == len(out)
