import corpus_pipeline as P
from odflow.llm.decontaminate import contamination
from odflow.llm.mixing import mix
from odflow.llm.near_duplicates import near_duplicates
from odflow.llm.pii import pseudonymise
from odflow.store import Store
from odflow.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    store = Store(spark, "test_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    seen = {"first": docs}
    for name, stage in P.STAGES:
        seen[name] = store.cut(stage(spark, docs, SF))
        docs = seen[name]
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontaminate", "pii", "mix_sources"]
    assert all(seen[n].columns == seen["first"].columns for n, _ in P.STAGES[:-1])
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    toxic = {r.doc_id for r in toxicity_scores(seen["first"].select("doc_id", "text"), labels).collect() if r.predicted}
    assert toxic and ids["toxicity"] == ids["first"] - toxic
    groups = near_duplicates(seen["toxicity"], 5).collect()
    assert ids["near_dedup"] == {r.doc_id for r in groups if r.kept} and len({r.component_id for r in groups}) == len(ids["near_dedup"])
    hits = {r.doc_id: r for r in contamination(seen["near_dedup"], bench).collect()}
    before, after = ({r.doc_id: r.text for r in seen[n].collect()} for n in ("near_dedup", "decontaminate"))
    assert any(r.contaminated for r in hits.values()) and not any(r.contaminated for r in contamination(seen["decontaminate"], bench).collect())
    assert all(after[i] == before[i] for i, r in hits.items() if not r.contaminated)
    want = {r.doc_id: r.text for r in pseudonymise(seen["decontaminate"]).collect()}
    assert {r.doc_id: r.text for r in seen["pii"].collect()} == want and any(want[i] != after[i] for i in want)
    taken = {r.doc_id: r.taken for r in mix(seen["pii"]).collect()}
    assert {r.doc_id: r.taken for r in seen["mix_sources"].collect()} == {i: t for i, t in taken.items() if t > 0}
    whole = {r.doc_id: r.taken for r in P.run(spark, SF).collect()}
    assert whole == {i: t for i, t in taken.items() if t > 0}
    store.release()


def test_empty_and_null_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b", None, "s", 3)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd, SF).count() in (3, 4)
