from motionframe.llm import secrets as S
from motionframe.llm.queries import queries

EXAMPLE, OWN = "aB3dE5gH7jK9mN1pQ3sT5vX7", "zY9xW8vU7tS6rQ5pO4nM3lK2"


def test_example_in_many_texts_of_one_source(spark, tmp_path):
    """One owner, but many repositories: an example; two repositories of one owner: live-looking."""
    rows = [(i, f"copy {i} of {EXAMPLE} token = exampletoken", "en", "hot", 0) for i in range(40)] + [(100 + i, f"note {i} {OWN}", "en", "hot", 0) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = {r[0]: r[1] for r in rows}
    spans = {r.doc_id: r.spans for r in S.judged(docs, ["doc_id"]).collect()}
    assert all([(s.kind, s.n_owners, s.n_repos, s.live) for s in spans[i]] == [("assign", 1, 40, False)] for i in range(40))
    assert all([(s.kind, s.n_owners, s.n_repos, s.live) for s in spans[i]] == [("opaque", 1, 2, True)] for i in (100, 101))
    after = {r.doc_id: r.text for r in S.redact(docs).collect()}
    assert after == {i: t.replace(OWN, "[secret]") for i, t in texts.items()}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries()["op9_secret_ownership"](spark, str(tmp_path)).collect()}
    assert (out[0].n_live, out[0].n_owners, out[0].n_repos) == (0, "1", "40") and (out[100].n_live, out[100].n_repos) == (1, "2")
