"""Lines that repeat, word for word or nearly, across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.decontamination import BETWEEN_WORDS, row_key
from commerce_lake.llm.linking import linked_members, sketch_apart
from commerce_lake.llm.tables import _small, drop_shuffles, forget, keep, left_by_size, semi_by_size
from commerce_lake.operators.merge import union_all
from commerce_lake.shared import INTERMEDIATE

#: Shorter lines have exact copies only.
MIN_WORDS = 5
#: Bytes of letters and digits; shorter lines are left alone: list marks, single ASCII letters and the like.
MIN_BYTES = 3
#: Characters of scripts that put no spaces between words; each counts as a word in the comparison by edits.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
#: All of these are there, and few letters of other scripts; much quicker to look for.
BEYOND_E00 = r"[\x{E00}-\x{10FFFF}]"
#: Words in a row that make a gram; lines are compared if they share one of their chosen grams.
GRAM = 3
#: Words of the shortest line that an edit of a tenth can make into another (one of ten words).
LEAST_EDITED = 9
#: Edit distance in words over the longer line's length, at most a tenth.
TENTH = 10
#: Words of the longest lines that are compared by edits; beyond, by the words they have in common.
LONGEST_EDIT = 1 << 20
#: Seeds of the codes of words that confirm a similar pair; with the first, 28,000^4 (2^59) codes.
CONFIRM = [1, 2, 3]
#: Words of the longer line from which the words that only one line has are counted before its edits are.
COUNT_FIRST = 512
#: Pairs for each line up to which what hubs did not join is compared without sketches.
FEW = 50
#: Pairs that one task compares.
PAIRS = 4096
#: Bits of the sketch that tells lines apart before they are compared word by word.
SKETCH = 2048
#: Words of 64 bits that the sketch is folded to.
FOLDS = 4
#: Places from which on a gram is common; lines that have it meet by others, as far as they have any.
COMMON = 128
#: Parts of the grams that are shuffled one after another, for less disk at a time.
SLICES = 3


def normalised(text: Column) -> Column:
    """Lower case, words of letters and digits parted by single spaces; ends of lines stay, with spaces around them."""
    return F.regexp_replace(F.lower(text), BETWEEN_WORDS.replace(r"\x00-\x2F", r"\x00-\x09\x0B-\x2F"), " ")


def spaced(norm: Column) -> Column:
    """A normalised line with each character of UNSPACED as a word."""
    parted = F.trim(F.regexp_replace(F.regexp_replace(norm, UNSPACED, " $0 "), " +", " "))
    there = (F.octet_length(norm) > F.length(norm)) & norm.rlike(BEYOND_E00) & norm.rlike(UNSPACED)
    return F.when(there, parted).otherwise(norm)


def placed_lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, doc_id, line_no, line, norm): place, hash and words of each line that is not blank and has MIN_BYTES of letters.

    Texts are normalised as a whole and then split, so that each is gone through once. None for a null text.
    Equal lines have equal hashes before characters of UNSPACED are set apart.
    """
    lines = docs.select(
        row_key(id, text).alias("doc"), F.col(id).alias("doc_id"), F.posexplode(F.split(normalised(F.col(text)), "\n")).alias("line_no", "norm")
    ).withColumn("norm", F.trim("norm"))
    # Spaces stand alone between words, so that letters are counted in short lines only.
    long_enough = (F.octet_length("norm") >= 2 * MIN_BYTES) | (F.octet_length(F.translate("norm", " ", "")) >= MIN_BYTES)
    told = long_enough & F.col("norm").rlike(r"[^\s\p{Z}]")
    return lines.where(told).select("doc", "doc_id", "line_no", F.xxhash64("norm").alias("line"), spaced(F.col("norm")).alias("norm"))


def _rank(word: Column) -> Column:
    """Longer words, which are seldom ones, come last; those of a length in the order of their hashes."""
    return F.shiftleft(F.octet_length(word), 24).bitwiseOR(F.hash(word).bitwiseAND(F.lit((1 << 24) - 1)))


def chosen_grams(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(gram, node, place) of each line: the grams (hashed) that it may share with similar lines, and where they are.

    Of two lines of n words or fewer, d edits apart, an edit touches at most GRAM of the places where
    either line has a gram. A line chooses the grams whose first word comes late in the order of
    _rank: all from some rank on, so many that there are GRAM * d + 1 of them or more (GRAM * (d + 1)
    words have that rank, of which GRAM - 1 may be too near the end to begin a gram). One of these
    stays whole in the other line, at most d words further on or back from either end. The line that
    chooses from the higher rank on thus has a gram that the other has chosen too. There are as many
    words, as n >= GRAM * (d + 1). A line does not know the longer one's length, but that is at most
    10 / 9 of its own, so d is at most a ninth of that.

    With a column `more` in `lines`, these are the grams that so many words further down in the order
    begin with, without those chosen before; all grams where it is null.
    """
    again = "more" in lines.columns
    words = lines.select(F.col("line").alias("node"), F.split("norm", " ").alias("words"), *["more"] * again).withColumn("n", F.size("words"))
    ranks = F.sort_array(F.transform("words", lambda w: _rank(w)))
    at = F.expr(f"cast(n - {GRAM} * (n div {LEAST_EDITED} + 1) as int)")
    first = F.coalesce(F.get(ranks, at), F.lit(0))
    below = F.coalesce(F.get(ranks, at - F.col("more").cast("int")), F.lit(-(1 << 31))) if again else first
    least = F.struct(below.alias("chosen"), *[F.when(F.col("more").isNotNull(), first).alias("before")] * again)
    # Conditions are where the optimizer does not have the words split and ranked for them once more,
    # and `least` is in what is exploded to be computed once a line, not once a word.
    words = words.withColumn("least", least)
    long_enough = F.when((F.col("n") >= max(min_words, LEAST_EDITED)) & F.col("least").isNotNull(), F.col("words"))
    placed = words.select("*", F.posexplode(long_enough).alias("i", "word"))
    placed = placed.where((_rank(F.col("word")) >= F.col("least.chosen")) & (F.col("i") <= F.col("n") - GRAM))
    if again:
        placed = placed.where(F.col("least.before").isNull() | (_rank(F.col("word")) < F.col("least.before")))
    gram = F.xxhash64("word", *[F.get("words", F.col("i") + k) for k in range(1, GRAM)])
    place = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("i").cast("long"))
    return placed.select(gram.alias("gram"), "node", place.alias("place"))


def _in_reach(x: Column, y: Column) -> Column:
    """Whether lines that have a gram from place `first` to place `last` on may be similar, by its distance from both ends."""
    ends = {}
    for name, about in (("x", x), ("y", y)):
        n = F.shiftrightunsigned(about["first"], 32)
        ends[name] = n, *(about[end].bitwiseAND(F.lit((1 << 32) - 1)) for end in ("first", "last"))
    (n, low, high), (m, least, most) = ends["x"], ends["y"]
    longer = F.greatest(n, m)
    near = F.abs(n - m) * TENTH <= longer
    for beyond in (low - most, least - high, (n - high) - (m - least), (m - most) - (n - low)):
        near = near & (beyond * TENTH <= longer)
    return near | (longer > LONGEST_EDIT)


def without_common(lines: DataFrame, grams: DataFrame, common: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(gram, node, place, common): what lines that chose `common` grams (gram) choose in place of these.

    Lines would meet by a common phrase as many times as there are pairs of them. So common grams come
    first in the order that grams are chosen in, before all others: a line that has chosen some must
    choose as many others further down, for GRAM * d + 1 in all that are not common (see chosen_grams).
    One that has not so many chooses all of them, and the common ones that it had, which come last of
    these. What other lines have chosen is what they choose in this order as well. The order decides
    how lines meet; all similar pairs are found in any.
    """
    lost = keep(semi_by_size(grams, common, "gram"), "common_chosen", INTERMEDIATE)
    held = keep(lost.groupBy(F.col("node").alias("line")).agg(F.count("*").alias("lost")), "common_holders")
    marked = common.withColumn("common", F.lit(True))

    def choose(holders: DataFrame) -> DataFrame:
        again = lines.join(F.broadcast(holders) if _small(holders, 32) else holders, "line")
        chosen = left_by_size(chosen_grams(again, min_words), marked, "gram", 16)
        return keep(chosen.where("common IS NULL").drop("common"), "chosen_again", INTERMEDIATE)

    chosen = choose(held.select("line", (F.col("lost") + GRAM).alias("more")))
    found = keep(chosen.groupBy(F.col("node").alias("line")).agg(F.count("*").alias("found")), "found_again")
    lacking = left_by_size(held, found, "line", 32).where("found IS NULL OR found < lost")
    lacking = keep(lacking.select("line", F.lit(None).cast("long").alias("more")), "common_lines")
    back = semi_by_size(lost, lacking.select(F.col("line").alias("node")), "node")
    chosen = chosen.union(choose(lacking)).withColumn("common", F.lit(False))
    return chosen.union(back.withColumn("common", F.lit(True)))


def shared_grams(grams: DataFrame, lines: DataFrame | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """(gram, node, about), once each, of the `grams` (a written table) that a line shares with another in reach.

    Most grams are there once and go at once. Those that are there COMMON times or more are replaced
    by others of the `lines` they were chosen from, if these are given (see without_common). Grams are
    looked through in SLICES parts of their hash space, one after another, so that the shuffle of all
    is never on disk as a whole.
    """
    spark = grams.sparkSession
    slices = [F.pmod("gram", F.lit(SLICES)) == k for k in range(SLICES)]
    shared = []
    for of_slice in slices:
        counted = grams.where(of_slice).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
        shared.append(keep(counted, "shared_grams"))
        drop_shuffles(spark)
    common, more = keep(union_all(shared).where(F.col("n") >= COMMON).select("gram"), "common_grams"), None
    if lines is not None and not common.isEmpty():
        more = keep(without_common(lines, grams, common, min_words), "more_grams", INTERMEDIATE)
        drop_shuffles(spark)
    found = []
    for of_slice, counted in zip(slices, shared, strict=True):
        keys = counted.select("gram")
        if more is not None:
            new = more.where(of_slice)
            rare = counted.where(F.col("n") < COMMON).select("gram")
            keys = keep(rare.union(new.where("NOT common").select("gram")).distinct(), "gram_keys")
        part = semi_by_size(grams.where(of_slice), keys, "gram")
        if more is not None:
            part = part.union(new.select(part.columns))
        part = part.groupBy("gram", "node").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        part = keep(part.select("gram", "node", F.struct("first", "last").alias("about")), "gram_lines")
        other = part.select(F.col("gram").alias("of"), F.col("node").alias("other"), F.col("about").alias("there"))
        met = (F.col("gram") == F.col("of")) & (F.col("node") != F.col("other")) & _in_reach(F.col("about"), F.col("there"))
        found.append(keep(part.join(other, met, "left_semi"), "gram_members"))
        forget(part)
        drop_shuffles(spark)
    return union_all(found)


def _code(word: Column, seed: int = 0) -> Column:
    """One of 28,000 numbers for each word; other seeds give independent ones."""
    return F.pmod(F.xxhash64(word, F.lit(seed)) if seed else F.xxhash64(word), F.lit(28_000))


def _sketched(texts: DataFrame) -> DataFrame:
    """(node, sketch) of lines (node, norm): number of words, and sketch of them.

    The second and third time that a line has a word are items of their own.
    """
    codes = texts.select("node", F.explode(F.split("norm", " ")).alias("word")).select("node", _code(F.col("word")).alias("code"))
    times = codes.groupBy("node", "code").agg(F.count("*").cast("int").alias("times"))
    items = times.select("node", "code", F.explode(F.sequence(F.lit(1), "times")).alias("time"))
    items = items.select("node", F.pmod(F.xxhash64("code", "time"), F.lit(SKETCH)).alias("item"))
    items = items.withColumn("bit", F.expr("shiftleft(1L, cast(item % 64 as int))"))
    parts = [F.coalesce(F.bit_xor(F.when(F.expr("item div 64") == k, F.col("bit"))), F.lit(0).cast("long")).alias(f"p{k}") for k in range(SKETCH // 64)]
    counted = items.groupBy("node").agg(F.count("*").alias("words"), *parts)
    # Items at the same place of FOLDS parts: a sketch of fewer bits, which is compared first.
    for k in range(FOLDS):
        folded = F.col(f"p{k}")
        for i in range(k + FOLDS, SKETCH // 64, FOLDS):
            folded = folded.bitwiseXOR(F.col(f"p{i}"))
        counted = counted.withColumn(f"f{k}", folded)
    return counted.select("node", F.struct(*[c for c in counted.columns if c != "node"]).alias("sketch"))


def _close(x: Column, y: Column) -> Column:
    """False where two sketches show that more than a tenth of the words must be edited."""
    longer = F.greatest(x["words"], y["words"])
    folded = [F.bit_count(x[f"f{k}"].bitwiseXOR(y[f"f{k}"])) for k in range(FOLDS)]
    few = (F.abs(x["words"] - y["words"]) * TENTH <= longer) & (sum(folded[1:], folded[0]) * TENTH <= 2 * longer)
    few = few & (sketch_apart(x, y, SKETCH) * TENTH <= 2 * longer)
    return few | (longer > LONGEST_EDIT)


def _coded(norm: Column, seed: int = 0) -> Column:
    """A line with one character (of 28,000, by a hash) for each word."""
    code = lambda w: F.hex(F.lit(0x4000) + _code(w, seed))  # four digits each
    return F.decode(F.unhex(F.array_join(F.transform(F.split(norm, " "), code), "")), "UTF-16BE")


def _edit_similar(a: Column, b: Column) -> Column:
    """Whether two coded lines differ by insertions, deletions and changes of a tenth of their words."""
    longer, apart = F.greatest(F.length(a), F.length(b)), F.lit(1 << 31)
    top = LONGEST_EDIT
    while top >= 16:  # levenshtein takes a constant limit, beyond which it gives -1, here made large
        edits = F.levenshtein(a, b, top // TENTH).cast("long").bitwiseAND(F.lit((1 << 31) - 1).cast("long"))
        apart = F.when(longer <= top, edits).otherwise(apart)
        top = top // 4 if top > COUNT_FIRST else top * 3 // 4  # its time grows with the limit
    by_edits = apart * TENTH <= longer
    # Each edit takes away at most one kind of word; in long lines this is much cheaper than edits.
    x, y = F.split(a, ""), F.split(b, "")
    near = (F.abs(F.length(a) - F.length(b)) * TENTH <= longer) & (
        (longer < COUNT_FIRST) | (F.greatest(F.size(F.array_except(x, y)), F.size(F.array_except(y, x))) * TENTH <= longer)
    )
    by_words = F.size(F.array_intersect(x, y)) * TENTH >= F.size(F.array_union(x, y)) * (TENTH - 1)
    return F.when(~near, False).when(longer <= LONGEST_EDIT, by_edits).otherwise(by_words)


def line_groups(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(node, component) of lines (by hash) that are linked with a line of other words.

    `lines` (a written table) has them with their words (line, norm) once for each place, numbered
    by `row`.
    """
    weights = lines.groupBy(F.col("line").alias("node")).agg(F.count("*").alias("weight"), F.min("row").alias("first"))
    weights = keep(weights.where("weight > 1"), "line_weights")
    once = left_by_size(lines.select("line", "row", "norm"), weights.select(F.col("node").alias("line"), "first"), "line", 32)
    once = once.where("first IS NULL OR row = first").select("line", "norm")

    grams = keep(chosen_grams(once, min_words), "chosen_grams", INTERMEDIATE)
    members = shared_grams(grams, once, min_words)
    forget(grams)
    nodes = keep(members.select("node").distinct(), "line_nodes")
    texts = keep(semi_by_size(once.withColumnRenamed("line", "node"), nodes, "node"), "line_texts", INTERMEDIATE)
    first_codes = keep(texts.select("node", _coded(F.col("norm"), 0).alias("c0")), "line_codes", INTERMEDIATE)

    def similar(pairs: DataFrame, coded: DataFrame, seeds: list[int]) -> DataFrame:
        side = lambda x: coded.select(F.col("node").alias(x), *[F.col(f"c{k}").alias(f"{x}{k}") for k in seeds])
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        # Few bytes, but long to compare: spread by number. The part's own number in the condition
        # keeps the optimizer from comparing before that.
        both = both.repartition(1 + pairs.count() // PAIRS, "a", "b").withColumn("task", F.spark_partition_id())
        alike = F.col("task") >= 0
        for k in seeds:
            alike = alike & _edit_similar(F.col(f"a{k}"), F.col(f"b{k}"))
        return keep(both.where(alike).select("a", "b"), "similar_pairs")

    def verify(pairs: DataFrame) -> DataFrame:
        # Different words may have one character, which makes lines look nearer than they are. What
        # is similar by one code is compared again by others, of which each would have to err.
        pairs = similar(pairs, first_codes, [0])
        left = keep(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "similar_nodes")
        coded = semi_by_size(texts, left, "node").select("node", *[_coded(F.col("norm"), k).alias(f"c{k}") for k in CONFIRM])
        return similar(pairs, keep(coded, "confirm_codes", INTERMEDIATE), CONFIRM)

    def sketches(nodes: DataFrame) -> DataFrame:
        return _sketched(semi_by_size(texts, nodes, "node"))

    drop_shuffles(lines.sparkSession)
    return linked_members(members, ["gram"], weights.select("node", "weight"), _in_reach, verify, sketches, _close, FEW)


def dedup_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with repeated lines taken out of the text, and the columns n_lines and n_dropped.

    Lines are equal if they are after lower-casing and reduction to words (64-bit hashes are
    compared). Different lines are linked if their edit distance in words is at most a tenth of the
    longer one's length; all such pairs are found (see chosen_grams). Lines beyond LONGEST_EDIT words
    are linked if nine tenths of their words are common and one of their chosen grams is. Of each
    connected group one occurrence stays, the first by id, line number and a hash of the text. Each
    character of a script without spaces (UNSPACED) counts as a word there. Lines of fewer than
    `min_words` words are linked with exact copies only. Lines without letters and digits (blank
    ones, rules) or with fewer than MIN_BYTES of them in UTF-8 are left alone.

    All rows stay, also those that lose all their lines (their text is then empty); a null text
    stays null and has no lines; an empty one has one line. Null ids come first. Rows with equal id
    and text are one document and lose the same lines. Columns named n_lines or n_dropped are
    replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    # A row that is there twice is one document, so its lines have one place.
    lines = keep(placed_lines(docs, id, text).withColumn("row", F.monotonically_increasing_id()), "lines", INTERMEDIATE)
    placed = keep(lines.drop("norm", "row").dropDuplicates(["doc", "line_no"]), "placed_lines", INTERMEDIATE)
    groups = keep(line_groups(lines, min_words), "line_groups").select(F.col("node").alias("line"), "component")
    forget(lines)
    places = left_by_size(placed, groups, "line", 16)
    places = places.select("doc", "doc_id", "line_no", F.coalesce("component", "line").alias("group"))
    firsts = places.groupBy("group").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "line_no", "doc")).alias("kept"))
    firsts = keep(firsts.where("n > 1").select("group", F.col("kept.doc").alias("kept_doc"), F.col("kept.line_no").alias("kept_no")), "line_firsts")
    gone = left_by_size(places, firsts, "group", 32).where("kept_doc IS NOT NULL AND (doc <> kept_doc OR line_no <> kept_no)")
    gone = keep(gone.groupBy("doc").agg(F.sort_array(F.collect_list("line_no")).alias("gone_lines_")), "lines_gone")
    out = left_by_size(docs.withColumn("doc_key_", row_key(id, text)), gone.withColumnRenamed("doc", "doc_key_"), "doc_key_", 64)
    all_lines = F.split(text, "\n")
    left = F.array_join(F.filter(all_lines, lambda x, i: ~F.array_contains(F.col("gone_lines_"), i)), "\n")
    return out.withColumns({
        "n_lines": F.coalesce(F.size(all_lines), F.lit(0)),
        "n_dropped": F.coalesce(F.size("gone_lines_"), F.lit(0)),
        text: F.when(F.col("gone_lines_").isNull(), F.col(text)).otherwise(left),
    }).select(*docs.columns, "n_lines", "n_dropped")
