"""Each stage against a brute-force version of its step, over what the stage before kept."""

import re

from stormledger.llm.queries import vocabulary_path

from test_line_dedup import brute


def test_stages(spark, brute_components, tmp_path):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns = docs.columns
    held = []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        held.append(docs.collect())
        assert k == len(P.STAGES) - 1 or docs.columns == columns
    kept, lines, single, mixed, tokens = held
    wrong = [r.doc_id for r in kept if labels.get(r.doc_id) == 0]
    lost = [d for d, q in labels.items() if q == 1 and d not in {r.doc_id for r in kept}]
    assert len(wrong) <= 1 and len(lost) <= 2
    assert sorted((str(r.doc_id), r.text or "") for r in lines) == sorted((d, t) for d, _, _, t in brute([(r.doc_id, r.text) for r in kept]))
    groups = brute_components([(r.doc_id, r.text) for r in lines])
    assert sorted(r.doc_id for r in single) == sorted(d for d, _, c in groups if d == c)
    texts = {r.doc_id: r.text for r in single}
    assert all(r.text == texts[r.doc_id] and re.search(r"\S", r.text) for r in mixed)
    library = Tokenizer.from_file(vocabulary_path())
    counts = sorted((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids)) for r in mixed)
    assert sorted((r.doc_id, r.n_tokens) for r in tokens) == counts
