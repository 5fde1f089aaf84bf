"""Lines meet by word and size class, the smaller ones by a shorter prefix, and no table of all tokens is written; results are those of all pairs."""

import random

import pytest

from glycotide.llm import line_dedup


@pytest.mark.parametrize("num, den, most, hot", [(9, 10, 250_000, 1_000), (9, 10, 3, 6), (3, 4, 3, 1_000), (2, 5, 250_000, 6)])
def test_lines_of_many_sizes_against_all_pairs(spark, monkeypatch, num, den, most, hot):
    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", most)
    monkeypatch.setattr(line_dedup, "LEAST_HOT", hot)
    names, write, draw, lines = {}, line_dedup.written, random.Random(11), []
    monkeypatch.setattr(line_dedup, "written", lambda df, name: names.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and write(df, name))
    for n in [1, 2, 3, 8, 9, 10, 11, 18, 19, 20, 21, 27, 40, 60, 90, 130, 170]:
        base = [f"w{draw.randrange(900)}" for _ in range(n)]
        for _ in range(7):
            cut = draw.randrange(n // 8 + 2)  # what is left of a line, or with words more
            lines.append(" ".join([*base[cut:], *(f"w{draw.randrange(900)}" for _ in range(draw.randrange(n // 12 + 2)))]))
    draw.shuffle(lines)
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 7 : i * 7 + 7])) for i in range(17)], "doc_id long, text string")
    sets, wanted = [set(x.split()) for x in lines], set()
    for j in range(len(sets)):
        if sets[j] and any(den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) for i in range(j) if sets[i]):
            wanted.add((j // 7, j % 7))
    assert wanted and {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(docs, num, den).collect()} == wanted
    assert "shared-tokens" not in names and "xxhash64" not in names["ids-of-several-rows"]
