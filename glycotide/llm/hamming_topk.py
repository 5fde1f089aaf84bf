"""Exact top-k search on binary codes by multi-index hashing whose segment radii grow until the answer is covered."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glycotide.llm.shared import parts, require, written

#: Parts into which one code's rows are dealt before their smallest ids are taken.
SALTS = 64


def sign_codes(vectors: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and code: 64-bit words whose bits are the signs (greater than 0) of the first ``dims`` entries.

    Null vectors and those of fewer entries have no code and are left out; null entries count as not positive.
    """
    require(vectors, id_col, vector_col)

    def word(w: int) -> Column:
        bits = [F.when(F.coalesce(F.col(vector_col)[j] > 0, F.lit(False)), F.lit((1 << (j % 64)) - ((1 << 64) if j % 64 == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")) for j in range(64 * w, min(64 * w + 64, dims))]
        total = bits[0]
        for b in bits[1:]:
            total = total.bitwiseOR(b)
        return total.alias(f"w{w}")

    return vectors.filter(F.size(vector_col) >= dims).select(F.col(id_col).cast("long").alias("id"), F.struct(*[word(w) for w in range(-(-dims // 64))]).alias("code"))


def _segment(code: str, s: int, bits: int) -> Column:
    """The number of a segment and, in the lower 32 bits, its value."""
    value = F.shiftrightunsigned(F.col(f"{code}.w{s * bits // 64}"), s * bits % 64).bitwiseAND(F.lit((1 << bits) - 1))
    return value.bitwiseOR(F.lit(s << 32))


def _distance(a: str, b: str, words: int) -> Column:
    return sum((F.bit_count(F.col(f"{a}.w{w}").bitwiseXOR(F.col(f"{b}.w{w}"))) for w in range(words)), F.lit(0)).cast("int")


def _masks(bits: int, weight: int) -> Column:
    """An array literal of all segment values with ``weight`` ones."""
    values = [sum(1 << i for i in c) for c in combinations(range(bits), weight)]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _smallest_ids(codes: DataFrame, k: int) -> DataFrame:
    """code, ids (the k smallest), n (how many those are): a code that a third of all rows have is dealt to SALTS parts first."""
    first = Window.partitionBy("code", "salt").orderBy("id")
    second = Window.partitionBy("code").orderBy("id")
    rows = codes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k)
    rows = rows.withColumn("nth", F.row_number().over(second)).filter(F.col("nth") <= k)
    return rows.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("n", F.size("ids"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64, segment_bits: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), neighbour_id, distance: the k nearest rows of ``vectors`` to each row of ``queries`` but itself.

    Distances are between sign codes; ties go to the smaller id; tables of fewer rows give fewer neighbours. Codes are
    cut into segments of ``segment_bits`` (a divisor of 64, at most 32; about log2 of the number of rows). Two codes at distance D
    agree up to floor(D / segments) in one segment, so after radius r in all segments everything up to
    segments * (r + 1) - 1 is known, and up to j less with j segments not yet searched at r. A query goes on until its
    k-th distance is within that. Equal codes are searched once.
    """
    if 64 % segment_bits or dims % segment_bits or segment_bits > 32:
        raise ValueError("segment_bits must divide 64 and dims, and be at most 32")
    words, segments, most = -(-dims // 64), dims // segment_bits, k + 1  # one more: the query itself
    codes = sign_codes(vectors, dims, id_col, vector_col)
    asked = written(sign_codes(queries, dims, id_col, vector_col), "queries")
    known = written(_smallest_ids(codes, most), "codes")
    total = known.agg(F.sum("n")).first()[0] or 0
    each = lambda code: F.explode(F.array(*[_segment(code, s, segment_bits) for s in range(segments)]))
    index = written(known.select("code", "n", each("code").alias("key")).repartition(parts(vectors.sparkSession), "key"), "segments")
    active = written(asked.select("code").distinct().select(F.col("code").alias("query"), F.lit(dims).alias("bound")), "active")
    found = known.select(F.col("code").alias("query"), "code", F.lit(0).alias("distance"), "n").limit(0)
    done = []
    for radius in range(segment_bits + 1):
        # radius * segments is beyond what smaller radii cover by one; a bound that near needs the first segments only
        needed = F.shiftright("at", 32) <= F.col("bound") - segments * radius
        probes = active.select("query", "bound", each("query").alias("at")).filter(needed).select("query", "bound", "at", F.explode(_masks(segment_bits, radius)).alias("mask"))
        probes = probes.select("query", "bound", F.col("at").bitwiseXOR(F.col("mask")).alias("key"))
        # a merge join: probes grow with queries and radius, which Spark's estimate of their size doesn't see
        near = probes.hint("merge").join(index, "key").filter(_distance("query", "code", words) <= F.col("bound"))
        new = near.select("query", "code", _distance("query", "code", words).alias("distance"), "n")
        closer = Window.partitionBy("query").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        all_ = found.unionByName(new).distinct().withColumn("before", F.coalesce(F.sum("n").over(closer), F.lit(0)))
        found = written(all_.filter(F.col("before") < most).drop("before"), "found")
        # the distance up to which a query's answer can reach: that of its k-th row, or all
        reach = found.groupBy("query").agg(F.sum("n").alias("rows"), F.max("distance").alias("last"))
        reach = active.select("query").join(reach, "query", "left").withColumn("bound", F.when(F.col("rows") >= most, F.col("last")).otherwise(F.lit(dims)))
        covered = segments * (radius + 1) - 1
        reach = written(reach.withColumn("done", (F.col("bound") <= covered) | F.coalesce(F.col("rows") >= total, F.lit(False))), "reach")
        done.append(found.join(reach.filter("done").select("query"), "query", "left_semi"))
        active = reach.filter("not done").select("query", "bound")
        if not active.head(1):
            break
        found = found.join(active.select("query"), "query", "left_semi")
    else:
        done.append(found)
    answers = done[0]
    for more in done[1:]:
        answers = answers.unionByName(more)
    best = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    rows = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(answers, "query").join(known.select("code", "ids"), "code")
    rows = rows.select("query_id", "distance", F.explode("ids").alias("neighbour_id")).filter("query_id <> neighbour_id")
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
