"""Line deduplication by an exact set-similarity join, with DataFrame operations only.

A line is the set of its words. Words are ordered from rare to frequent by a table of counts of fixed size, so that a
short prefix of a set must share a word with any similar set, and the smaller of two an even shorter one. Pairs that share
one pass length and positional filters, and one on 64 or 128 parity bits of their words; those left are verified on all their words. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glycotide.llm.shared import fresh, require, text_or_empty, written

#: Entries of the table of word counts; lines to be verified up to which their numbers, and their documents' ids, are broadcast.
BUCKETS, MOST_BROADCAST = 1 << 14, 250_000
#: Words from which a set has two numbers of parity bits in use: one of 64 bits tells longer sets no more apart.
LONG = 150
#: A prefix word of more than 1/MOST_HOT of all prefix words, and of more than LEAST_HOT, is hot: lines must share another word, too.
MOST_HOT, LEAST_HOT = 2_000, 1_000
_MASK = (1 << 56) - 1
#: A line is known by its document, that is an id and, for ids of several texts, a hash of the text, and its number.
DOC = ["doc_id", "text_key"]
AT = [*DOC, "line_no"]
PARITY = ["parity_0", "parity_1"]
#: What a row of the token tables has besides the token; place is that of the (first) word in the ordered set.
TOKEN = [*AT, "size", "place", *PARITY]


def _blanks(text: Column) -> Column:
    """A text with blanks for other white space but line feeds. Most have none, which one scan of a whole text tells."""
    blank = text
    for space in "\t\x0b\f\r":
        blank = F.replace(blank, F.lit(space), F.lit(" "))
    return F.when(text.rlike(r"[\t\x0B\f\r]"), blank).otherwise(text)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no (from 0), line; ``line`` has blanks for other white space; lines without words are left out."""
    lines = docs.select(*DOC, F.posexplode(F.split(_blanks(F.col("text")), "\n", -1)).alias("line_no", "line"))
    return lines.filter(F.trim("line") != "")


def words_of(line: Column) -> Column:
    """A line's words, repeated ones too."""
    return F.array_remove(F.split(line, " ", -1), "")


def rarity_levels(docs: DataFrame) -> Column:
    """An array literal: for each of BUCKETS word buckets a level, 0 to 127 (times 2^56), that rises with its count over all texts."""
    words = docs.select(F.explode(F.split(F.replace(_blanks(F.col("text")), F.lit("\n"), F.lit(" ")), " ", -1)).alias("word"))  # empty ones do no harm
    counts = words.groupBy(F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).count()
    found = {r["bucket"]: r["count"] for r in counts.collect()}  # BUCKETS rows at most
    return F.split(F.lit(",".join(str(min(127, 2 * found.get(b, 0).bit_length()) << 56) for b in range(BUCKETS))), ",").cast("array<bigint>")


def _ranked(line: Column, levels: Column) -> Column:
    """Each distinct word's level and hash in one number, rare words first: the same order for all lines."""

    def rank(h: Column) -> Column:
        level = F.coalesce(F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), F.lit(0).cast("long"))  # never null: numbers without nulls are sorted faster
        return level.bitwiseOR(h.bitwiseAND(F.lit(_MASK)))

    return F.sort_array(F.transform(F.array_distinct(F.transform(words_of(line), lambda w: F.xxhash64(w))), rank))


def _parity(ranks: Column, size: Column) -> list[Column]:
    """PARITY: each word flips one of 64 bits; in a set of LONG words or more, those of the half that the word is of.

    Sets of which n words are in one only differ in n bits at most.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def flips(own: Column, rank: Column) -> Column:
        return F.call_function("shiftleft", own, rank.bitwiseAND(F.lit(63)).cast("int"))

    half = lambda rank: F.shiftright(rank, 26).bitwiseAND(F.lit(1))
    all_words = F.aggregate(ranks, zero, lambda bits, rank: bits.bitwiseXOR(flips(one, rank)))
    halves = [F.aggregate(ranks, zero, lambda bits, rank: bits.bitwiseXOR(flips(one - half(rank), rank))), F.aggregate(ranks, zero, lambda bits, rank: bits.bitwiseXOR(flips(half(rank), rank)))]
    return [F.when(size < LONG, short).otherwise(long).alias(c) for c, short, long in zip(PARITY, (all_words, zero), halves)]


def _differ() -> Column:
    """Words that one of two sets (a_, b_) has, at least. A set of fewer than LONG words is compared by all of the other's at once."""
    bits = [F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}")) for c in PARITY]
    return F.when(F.least("a_size", "b_size") < LONG, F.bit_count(bits[0].bitwiseXOR(bits[1]))).otherwise(F.bit_count(bits[0]) + F.bit_count(bits[1]))


def _key() -> list[Column]:
    return [F.xxhash64("line").alias("one"), F.xxhash64(F.lit(7), "line").alias("two")]


def _fits(num: int, den: int) -> Column:
    """Whether two rows of tokens (a_, b_) can be of similar sets: by size, by place of the word that they share, by parity.

    The first word that two similar sets share has all others behind it in both, so rows of later ones need not fit.
    """
    fits = (den * F.col("b_size") >= num * F.col("a_size")) & (den * F.col("a_size") >= num * F.col("b_size"))
    both = F.col("a_size") + F.col("b_size")
    left = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    return fits & ((num + den) * left >= num * both) & ((num + den) * _differ() <= (den - num) * both)


def _earlier() -> Column:
    """Whether the line of b_ comes before that of a_."""
    before, same = F.lit(False), F.lit(True)
    for c in AT:
        before, same = before | (same & (F.col(f"b_{c}") < F.col(f"a_{c}"))), same & (F.col(f"b_{c}") == F.col(f"a_{c}"))
    return before


def _side(tokens: DataFrame, p: str) -> DataFrame:
    return tokens.select("token", *[F.col(c).alias(f"{p}_{c}") for c in TOKEN])


def _candidates(later: DataFrame, early: DataFrame, num: int, den: int, few: bool = False) -> DataFrame:
    """Pairs (AT of a line, as a_, and of an earlier one, as b_) that share a token and can be similar.

    Both tables have token and TOKEN; one of ``few`` early rows goes to the later ones.
    """
    early = _side(early, "b")
    pairs = _side(later, "a").join(F.broadcast(early) if few else early, "token").filter(_earlier() & _fits(num, den))
    return pairs.select(*[f"{p}_{c}" for p in "ab" for c in AT]).distinct()


def _size_class(size: Column) -> Column:
    """A whole number that rises with the size, by four from a size to its double (logarithms are the same on all machines)."""
    return F.floor(4 * F.log2(size))


def _candidates_by_size(sets: DataFrame, hot: DataFrame | None, num: int, den: int) -> DataFrame:
    """All pairs of ``sets`` that share a token and can be similar, as those of ``_candidates``.

    The larger set has its prefix, the smaller one the shorter prefix, and they meet on the word and the larger one's size class.
    """
    large = _tokens(sets, hot, num, den).withColumn("token", F.xxhash64("token", _size_class(F.col("size"))))
    # of so many words from the shared one on, num of num + den of both sets' words can be common to sets of this size at most
    largest = F.floor((num + den) * (F.col("size") - F.col("place")) / num) - F.col("size")
    classes = F.sequence(_size_class(F.col("size")), _size_class(F.greatest(largest, F.col("size"))))
    small = _tokens(sets, hot, num, den, short=True).withColumn("_class", F.explode(classes)).withColumn("token", F.xxhash64("token", "_class"))
    ordered = (F.col("b_size") < F.col("a_size")) | ((F.col("b_size") == F.col("a_size")) & _earlier())
    pairs = _side(large, "a").join(_side(small, "b"), "token").filter(_fits(num, den) & ordered)
    ends = [F.struct(*[F.col(f"{p}_{c}").alias(c) for c in AT]) for p in "ab"]
    pairs = pairs.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b"))
    return pairs.select(*[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "ab" for c in AT]).distinct()


def _prefix_size(size: str, num: int, den: int) -> Column:
    return (F.col(size) - F.floor((num * F.col(size) + den - 1) / den) + 1).cast("int")


def _short_size(size: str, num: int, den: int) -> Column:
    """Words of the prefix that a set needs for similar ones of its size and more: these share 2 * num of num + den of its words."""
    return (F.col(size) - F.floor((2 * num * F.col(size) + num + den - 1) / (num + den)) + 1).cast("int")


def _lowest(sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame | None]:
    """token and TOKEN of the earliest set of each token of shorter prefixes, and the words that are hot there (MOST_HOT at most; None: no such)."""
    low = [F.min(F.struct(*TOKEN)).alias("low"), F.count("*").alias("n")]
    lowest = written(_tokens(sets, None, num, den, short=True).groupBy("token").agg(*low), "lowest")
    total = lowest.agg(F.sum("n")).first()[0] or 0
    hot = lowest.filter(F.col("n") > max(total // MOST_HOT, LEAST_HOT)).select("token")
    lowest = lowest.select("token", "low.*")
    # for a similarity up to 1/2 none can be paired with a second word
    if 2 * num <= den or not hot.head(1):
        return lowest, None
    two = _tokens(sets, hot, num, den, short=True, how="inner").groupBy("token").agg(low[0]).select("token", "low.*")
    return lowest.union(written(two, "lowest-of-two")), hot


def _tokens(sets: DataFrame, hot: DataFrame | None, num: int, den: int, short: bool = False, how: str = "left") -> DataFrame:
    """token and TOKEN of each set: the words of its prefix, or of the shorter one.

    A similar set shares a word of the prefix and, for a similarity over 1/2, a second one behind it in a prefix longer by
    one; so where the first is hot, tokens are pairs of it and one behind it. Sets that only equal ones are similar to have
    one token, that of all their words. how: "inner" leaves out words that aren't hot.
    """
    size = (_short_size if short else _prefix_size)("set.size", num, den)
    about = [*[F.col(f"first.{c}").alias(c) for c in AT], F.col("set.size").alias("size"), *[F.col(f"set.{c}").alias(c) for c in PARITY]]
    words = F.when(F.col("set.whole").isNotNull(), F.array("set.whole")).otherwise(F.slice("set.prefix", F.lit(1), size))
    if hot is None:
        return sets.select(*about, F.posexplode(words).alias("place", "token")).select("token", *TOKEN)
    each = sets.select(*about, F.slice("set.prefix", F.lit(1), size + 1).alias("_prefix"), F.posexplode(words).alias("place", "token"))
    marked = each.join(F.broadcast(hot.select("token", F.lit(True).alias("_hot"))), "token", how)
    two = F.transform(F.slice("_prefix", F.col("place") + 2, F.greatest(F.size("_prefix"), F.lit(0))), lambda w: F.xxhash64(F.col("token"), w))
    # one token of all words (no prefix) is never hot
    tokens = F.when(F.col("_hot") & F.col("_prefix").isNotNull(), two).otherwise(F.array("token"))
    return marked.withColumn("token", F.explode(tokens)).select("token", *TOKEN)


def _copies(lines: DataFrame, sets: DataFrame) -> DataFrame:
    """The lines (AT) that are equal to an earlier one. The first ones of frequent lines are broadcast; copies of these look for keys of their own in the shuffled join."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") > max(total // MOST_HOT, 50)
    equal = sets.filter("n > 1")
    keyed = lines.select(*AT, *_key()).join(F.broadcast(equal.filter(frequent).select("one", "two", F.col("first").alias("_hot"))), ["one", "two"], "left")
    keyed = keyed.withColumn("one", F.when(F.col("_hot").isNotNull(), F.xxhash64(*AT)).otherwise(F.col("one")))
    found = keyed.join(equal.filter(~frequent).select("one", "two", F.col("first").alias("_cold")).hint("shuffle_hash"), ["one", "two"], "left")
    return found.filter(F.coalesce("_hot", "_cold") != F.struct(*AT)).select(*AT)


def _with_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` (doc_id, wanted: text_key and line_no of lines). Few lines go to the texts; texts go to lines that are many."""
    few = (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= MOST_BROADCAST
    return docs.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), "doc_id")


def _verify(pairs: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """The later lines (AT) of the pairs that are similar, from the words in the texts."""
    ends = [pairs.select(*[F.col(f"{p}_{c}").alias(c) for c in AT]) for p in "ab"]
    wanted = written(ends[0].union(ends[1]).distinct().groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "line_no")).alias("wanted")), "wanted-lines")
    texts = _with_wanted(docs, wanted)
    lines = texts.select(*DOC, "wanted", F.posexplode(F.split(_blanks(F.col("text")), "\n", -1)).alias("line_no", "line")).filter(F.array_contains("wanted", F.struct("text_key", "line_no")))
    words = lines.select(*AT, F.array_distinct(F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w))).alias("words")).dropDuplicates(AT)
    words = written(words, "line-words")
    side = lambda p: words.select(*[F.col(c).alias(f"{p}_{c}") for c in (*AT, "words")])
    both = pairs.join(side("a"), [f"a_{c}" for c in AT]).join(side("b"), [f"b_{c}" for c in AT])
    common = F.size(F.array_intersect("a_words", "b_words"))
    similar = den * common >= num * (F.size("a_words") + F.size("b_words") - common)
    return both.filter(similar).select(*[F.col(f"a_{c}").alias(c) for c in AT]).distinct()


def _with_text_key(docs: DataFrame, name: str, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the column ``name``: 0, or the xxhash64 of the text where rows of one id have several texts."""
    own, text = F.col(f"`{id_col}`").cast("long"), F.xxhash64(text_or_empty(f"`{text_col}`"))
    rows = docs.groupBy(own.alias("_shared_id")).agg(F.count("*").alias("n"))
    several = written(rows.filter("_shared_id is not null and n > 1").select("_shared_id"), "ids-of-several-rows")
    if several.head(1):  # else no text is read
        texts = docs.groupBy(own.alias("_shared_id")).agg(F.min(text).alias("low"), F.max(text).alias("high"))
        several = written(texts.filter("_shared_id is not null and low <> high").select("_shared_id"), "ids-of-several-texts")
    if not several.head(1):
        return docs.withColumn(name, F.lit(0).cast("long"))
    joined = docs.join(several.hint("shuffle_hash"), own == F.col("_shared_id"), "left")
    return joined.withColumn(name, F.when(F.col("_shared_id").isNotNull(), text).otherwise(F.lit(0).cast("long"))).drop("_shared_id")


def repeated_lines(docs: DataFrame, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, line_no (from 0) of each line that has an earlier line, by these three, of word Jaccard >= num/den.

    text_key is 0, or the xxhash64 of the text where rows of one id have several: these are documents of their own, rows
    that repeat an id and a text are one. Any earlier line counts, removed or not. Lines without words are never removed; a null text is
    one empty line; rows without an id are left out; long lines count whole. Equal lines
    are collapsed to their first. Per token, lines are first compared with the earliest line only; those that aren't like it
    are then compared with each other by size, and with the lines already found, so that a group of like lines costs no
    square of its size.
    """
    require(docs, id_col, text_col)
    (key,) = fresh(docs, "_text_key")
    return _repeated(_with_text_key(docs, key, id_col, text_col), key, num, den, id_col, text_col)


def _repeated(docs: DataFrame, key: str, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(key).alias("text_key"), text_or_empty(f"`{text_col}`").alias("text")).filter("doc_id is not null")
    lines = lines_of(source)
    levels = rarity_levels(source)
    ranked = lines.select(*AT, *_key(), _ranked(F.col("line"), levels).alias("ranks")).withColumn("size", F.size("ranks"))
    # a set of n words and another one have n of n + 1 words in common at most
    whole = F.when(den * F.col("size") < num * (F.col("size") + 1), F.xxhash64("ranks"))
    prefix = F.when(whole.isNull(), F.slice("ranks", F.lit(1), _prefix_size("size", num, den) + 1))
    one = F.any_value(F.struct("size", whole.alias("whole"), prefix.alias("prefix"), *_parity(F.col("ranks"), F.col("size")))).alias("set")
    sets = written(ranked.groupBy("one", "two").agg(F.min(F.struct(*AT)).alias("first"), F.count("*").alias("n"), one), "line-sets")

    out = _copies(lines, sets)
    lowest, hot = _lowest(sets, num, den)
    # a line's pair with itself fits nothing, so the earliest lines may stay among the later ones
    found = written(_candidates(_tokens(sets, hot, num, den, short=True), lowest.hint("shuffle_hash"), num, den), "pivot-pairs")
    left = sets
    if found.head(1):
        removed = written(_verify(found, source, num, den), "like-earliest")
        out = out.union(removed)
        gone = removed.select(F.struct(*AT).alias("first"))
        few = removed.count() <= MOST_BROADCAST
        left, taken = [sets.join(F.broadcast(gone) if few else gone, "first", how) for how in ("left_anti", "left_semi")]
        left = left if few else written(left, "lines-left")
        taken = written(_tokens(taken, hot, num, den), "taken-tokens")
        pairs = _candidates_by_size(left, hot, num, den).union(_candidates(_tokens(left, hot, num, den), taken, num, den, taken.count() <= MOST_BROADCAST))
    else:
        pairs = _candidates_by_size(left, hot, num, den)
    pairs = written(pairs, "line-pairs")
    if pairs.head(1):
        out = out.union(written(_verify(pairs, source, num, den), "similar-lines"))
    return out.distinct()


def line_counts(docs: DataFrame, num: int = 9, den: int = 10) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers, ascending, joined by commas; null: none) of each row of ``docs``."""
    require(docs, "doc_id", "text")
    docs = _with_text_key(docs.select("doc_id", "text"), "text_key", "doc_id", "text")
    removed = _repeated(docs, "text_key", num, den, "doc_id", "text").groupBy(*DOC).agg(F.count("*").alias("n_removed"), F.array_join(F.array_sort(F.collect_list("line_no")).cast("array<string>"), ",").alias("removed"))
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text_key", F.size(F.split(text_or_empty(), "\n", -1)).cast("long").alias("n_lines"))
    return each.join(removed, DOC, "left").select("doc_id", "n_lines", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "removed")


def without_repeated_lines(docs: DataFrame, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``repeated_lines`` names taken out of their texts."""
    require(docs, id_col, text_col)
    own_, id_, key_, gone_ = fresh(docs, "_own_key", "_doc_id", "_text_key", "_gone")
    keyed = _with_text_key(docs, own_, id_col, text_col)
    gone = _repeated(keyed, own_, num, den, id_col, text_col).groupBy(F.col("doc_id").alias(id_), F.col("text_key").alias(key_)).agg(F.collect_list("line_no").alias(gone_))
    joined = keyed.join(gone.hint("shuffle_hash"), (F.col(id_col).cast("long") == F.col(id_)) & (F.col(own_) == F.col(key_)), "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(F.col(gone_), i)), "\n")
    return joined.withColumn(text_col, F.when(F.col(gone_).isNull(), F.col(text_col)).otherwise(kept)).drop(own_, id_, key_, gone_)
