"""Lines to be verified leave their texts one by one: no row carries all lines of a text. Results are those of all pairs."""

import random

from glycotide.llm import line_dedup


def test_lines_of_hot_and_rare_words_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_HOT", 50)
    monkeypatch.setattr(line_dedup, "LEAST_HOT", 8)
    plans, write, draw, lines = {}, line_dedup.written, random.Random(3), []
    monkeypatch.setattr(line_dedup, "written", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and write(df, name))
    for _ in range(12):
        base = [f"w{draw.randrange(60)}" for _ in range(draw.randrange(5, 40))]
        for _ in range(6):
            other = list(base)
            for _ in range(draw.randrange(4)):
                other[draw.randrange(len(other))] = f"w{draw.randrange(60)}"
            draw.shuffle(other)
            lines.append(" ".join(other))
    draw.shuffle(lines)
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 6 : i * 6 + 6])) for i in range(12)], "doc_id long, text string")
    sets, wanted = [set(x.split()) for x in lines], set()
    for j in range(len(sets)):
        if any(10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j]) for i in range(j)):
            wanted.add((j // 6, j % 6))
    assert wanted and {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(docs).collect()} == wanted
    assert "element_at" not in plans["line-words"]
