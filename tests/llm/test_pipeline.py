"""The pipeline's stages on a small corpus with planted cases, and the driver contract."""


import corpus_pipeline
import __spark_entry__ as entry
from test_operators import find_components, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        left = {r.doc_id: r.text for r in docs.collect()}
        assert left.items() <= before.items()
        if name == "exact_dedup":
            assert {"".join(t.split()) for t in left.values()} == {"".join(t.split()) for t in before.values()}
            assert len({"".join(t.split()) for t in left.values()}) == len(left)
        if name == "near_dedup":
            sets = {i: shingles(t) for i, t in before.items()}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
            assert set(left) == set(find_components(sets, links).values())
        before = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(before)


def test_contract():
    known, sql = entry.queries(), entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in known if k.startswith("op")}
    assert "pipeline" in known and sql.keys() <= known.keys()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
