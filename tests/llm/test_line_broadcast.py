"""Lines, not documents, bound what op5 broadcasts; the result is the same."""

from glycotide.llm import line_dedup


def test_many_lines_of_one_document_are_not_broadcast(spark, monkeypatch):
    words = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(i, "\n".join(f"{words} row{n}" for n in range(9))) for i in range(3)], "doc_id long, text string")
    plans, verify = [], line_dedup._verify

    def noted(pairs, source, num, den):
        shared = line_dedup.F.broadcast
        monkeypatch.setattr(line_dedup.F, "broadcast", lambda df: plans.append(df.columns) or shared(df))
        out = verify(pairs, source, num, den)
        monkeypatch.setattr(line_dedup.F, "broadcast", shared)
        return out

    monkeypatch.setattr(line_dedup, "_verify", noted)
    found, broadcast = [], []
    for most in (250_000, 5):  # one document has 9 different lines that are verified
        monkeypatch.setattr(line_dedup, "MOST_BROADCAST", most)
        plans.clear()
        found.append({r.doc_id: r.removed for r in line_dedup.line_counts(docs).collect()})
        broadcast.append(["doc_id", "wanted"] in plans)
    every = ",".join(map(str, range(9)))
    assert found[0] == found[1] == {0: every[2:], 1: every, 2: every} and broadcast == [True, False]
