"""Several texts of one id are documents of their own to op5: no line goes that is nowhere else."""

from collections import Counter

from glycotide.llm import line_dedup

WORDS = " ".join(f"w{k}" for k in range(20))


def test_a_unique_line_stays(spark):
    docs = spark.createDataFrame([(0, WORDS), (1, WORDS + " more"), (1, "a line that is nowhere else"), (None, WORDS)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.removed) for r in line_dedup.line_counts(docs).collect())
    assert got == Counter({(0, 1, 0, None): 1, (1, 1, 1, "0"): 1, (1, 1, 0, None): 1, (None, 1, 0, None): 1})
    kept = Counter((r.doc_id, r.text) for r in line_dedup.without_repeated_lines(docs).collect())
    assert kept == Counter({(0, WORDS): 1, (1, ""): 1, (1, "a line that is nowhere else"): 1, (None, WORDS): 1})


def test_texts_of_one_id_against_all_pairs(spark):
    """Every line but the first of each group of like lines goes, whichever rows of ids 1 to 3 they are in."""
    texts = {(i, f"{WORDS} x{i}{j}\nonly r{i} c{j} here\n{WORDS}") for i in (1, 2, 3) for j in range(3)}
    rows = [*texts, *list(texts)[:2]]  # repeated rows count as one document
    got = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows)
    lines = [x for t in {(r.doc_id, r.text) for r in got} for x in t[1].split("\n")]
    assert sorted(x for x in lines if x.startswith("only")) == sorted(f"only r{i} c{j} here" for i in (1, 2, 3) for j in range(3))
    assert sum(x.startswith("w0") for x in lines) == 1
