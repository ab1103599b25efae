import corpus_pipeline
import __spark_entry__
from llm_helpers import documents, odd_documents, SF_SMALL
from releasemill.llm import bytebpe, queries, simhash, templates, toxicity


def test_registered():
    known = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(known) and known["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near-duplicates", "decontamination", "byte-level BPE"
    ]


def test_rows_equal_the_operators_on_what_is_left(spark, documents):
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    left = {r.doc_id for r in toxicity.judged(docs, labels).collect() if not r.predicted}
    rest = docs.where(docs.doc_id.isin(sorted(left)))
    components = simhash.near_duplicates(rest, ["doc_id"], "doc_id").collect()
    left = {r.doc_id for r in components if r.doc_id == r.component_id}
    held = {r.doc_id for r in templates.contaminated(docs, benchmark, ["doc_id"]).collect()}
    left -= held
    assert set(found) == left and held
    assert all(r.round_trip for r in found.values())
    codec = bytebpe.Codec(
        bytebpe.serialise(bytebpe.read_ranks(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))),
        corpus_pipeline.public_tokenizers.PATTERN,
    )
    assert all(bytes(r.ids) == codec.encode(documents[i]) for i, r in found.items())


def test_stages_take_odd_rows(spark, odd_documents):
    kept = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd_documents.select(*kept, "shard", "word")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns, name
    assert corpus_pipeline.encode(spark, docs, SF_SMALL).where("round_trip").count() == 12
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
