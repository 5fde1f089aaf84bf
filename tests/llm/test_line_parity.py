"""Lines of fewer and of more words than LONG, whose parity bits are laid out in two ways, against all pairs."""

import random

from glycotide.llm import line_dedup


def test_lines_on_both_sides_of_long(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG", 40)
    draw, lines = random.Random(5), []
    for n in range(34, 47):
        base = [f"w{draw.randrange(400)}" for _ in range(n)]
        for _ in range(6):
            other = list(base)
            for _ in range(draw.randrange(5)):
                if draw.random() < 0.5:
                    other.pop(draw.randrange(len(other)))
                else:
                    other.insert(draw.randrange(len(other)), f"w{draw.randrange(400)}")
            lines.append(draw.choice([" ", "\t", " \r", "\x0b", "\f "]).join(other))
    draw.shuffle(lines)
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 6 : i * 6 + 6])) for i in range(13)], "doc_id long, text string")
    sets, wanted = [set(x.split()) for x in lines], set()
    for j in range(len(sets)):
        if any(10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j]) for i in range(j)):
            wanted.add((j // 6, j % 6))
    straddling = [1 for j in range(len(sets)) for i in range(j) if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j]) and min(len(sets[i]), len(sets[j])) < 40 <= max(len(sets[i]), len(sets[j]))]
    assert straddling and {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(docs).collect()} == wanted
