"""Passages of test items in training documents, found by a positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.tables import _small, keep, left_by_size, semi_by_size

#: Words are runs of letters and digits of ASCII and of anything beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a whole text in order, A-Z lower-cased; none for null."""
    found = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN_WORDS)
    return F.array_remove(found, "")


def row_key(id: str, text: str) -> Column:
    """Rows with equal id and text are one document and get equal results."""
    return F.xxhash64(id, text)


def item_words(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item_key, item_id, words, n) of the items that have words; repeated rows count once."""
    found = items.select(row_key(id, text).alias("item_key"), F.col(id).alias("item_id"), words_of(F.col(text)).alias("words"))
    return found.withColumn("n", F.size("words")).where("n > 0").dropDuplicates(["item_key"])


def term_counts(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """(term, freq): how often each word of `items` occurs in all documents."""
    asked = keep(items.select(F.explode("words").alias("term")).distinct(), "test_terms")
    tokens = docs.select(F.explode(words_of(F.col(text))).alias("term"))
    if _small(asked, 32):
        counts = tokens.join(F.broadcast(asked), "term", "left_semi").groupBy("term").agg(F.count("*").alias("freq"))
    else:  # too many words to send along: count first, so that only distinct words are shuffled
        counts = tokens.groupBy("term").agg(F.count("*").alias("freq")).join(asked, "term", "left_semi")
    return keep(counts, "term_counts")


def rarest_terms(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_key, n, t1, p1, t2, p2): the two rarest words of each window and their places.

    A window is `window` words in a row, or all words of a shorter item (then t2 may be null).
    Windows with a word that no document has are left out. Windows that overlap mostly share their
    rarest words, which then are one row.
    """
    placed = items.select("item_key", "n", F.posexplode("words").alias("p", "term"))
    known = left_by_size(placed, counts, "term", 40)
    rows = known.groupBy("item_key", "n").agg(
        F.sort_array(F.collect_list(F.struct("p", F.coalesce("freq", F.lit(0)).alias("freq"), "term"))).alias("all")
    )
    spans = rows.select("item_key", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))).alias("s"), "all")
    span = F.slice("all", F.col("s") + 1, F.least(F.col("n"), F.lit(window)))
    span = F.array_sort(F.transform(span, lambda x: F.struct(x["freq"], x["p"], x["term"])))
    spans = spans.select("item_key", "n", span.alias("w")).where(F.col("w")[0]["freq"] > 0)
    second = F.when(F.size("w") > 1, F.element_at("w", F.least(F.lit(2), F.size("w"))))
    return spans.select(
        "item_key", "n",
        F.col("w")[0]["term"].alias("t1"), F.col("w")[0]["p"].alias("p1"),
        second["term"].alias("t2"), second["p"].alias("p2"),
    ).distinct()


def token_postings(docs: DataFrame, anchors: DataFrame, id: str, text: str) -> DataFrame:
    """(term, doc, pos) of every occurrence of the anchors' words: the index, a written table."""
    terms = anchors.select(F.col("t1").alias("term")).union(anchors.where("t2 IS NOT NULL").select("t2")).distinct()
    terms = keep(terms, "anchor_terms")
    tokens = docs.select(row_key(id, text).alias("doc"), F.posexplode(words_of(F.col(text))).alias("pos", "term"))
    return keep(semi_by_size(tokens, terms, "term", 32), "token_postings")


def alignments(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc, item_key, n, shift) where an item laid over a document from word `shift` on meets both
    rarest words of a window: the rarest word's list is intersected with the second's, each entry
    moved by the distance of the two."""
    first = postings.join(anchors, F.col("term") == F.col("t1")).select(
        "doc", "item_key", "n", (F.col("pos") - F.col("p1")).alias("shift"), "t2", "p2"
    )
    alone = first.where("t2 IS NULL").select("doc", "item_key", "n", "shift")
    second = postings.select(F.col("doc").alias("_doc"), F.col("term").alias("_term"), F.col("pos").alias("_pos"))
    met = first.where("t2 IS NOT NULL").join(
        second, (F.col("doc") == F.col("_doc")) & (F.col("t2") == F.col("_term")) & (F.col("shift") + F.col("p2") == F.col("_pos")), "left_semi"
    )
    return alone.union(met.select("doc", "item_key", "n", "shift")).distinct()


def phrase_hits(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, item_id, start, length): each occurrence of a window of an item in a document.

    `doc` is row_key(doc_id, text); `start` counts the document's words from 0. Only documents and
    places that the index names are compared, word for word.
    """
    items = keep(item_words(items.select(item_id, text), item_id, text), "items")
    anchors = keep(rarest_terms(items, term_counts(docs, items, text), window), "anchors")
    postings = token_postings(docs, anchors, doc_id, text)
    laid = keep(alignments(postings, anchors), "alignments")
    by_doc = keep(laid.groupBy("doc").agg(F.collect_list(F.struct("item_key", "n", "shift")).alias("laid")), "aligned_docs")
    keyed = docs.select(row_key(doc_id, text).alias("doc"), F.col(text).alias("text"))
    bodies = semi_by_size(keyed, keep(by_doc.select("doc"), "aligned_keys"), "doc")
    bodies = bodies.dropDuplicates(["doc"]).join(by_doc, "doc").withColumn("words", words_of(F.col("text")))
    at = bodies.select("doc", "words", F.explode("laid").alias("a")).select(
        "doc",
        F.col("a.item_key").alias("item_key"),
        F.greatest(F.col("a.shift"), F.lit(0)).alias("begin"),
        F.greatest(-F.col("a.shift"), F.lit(0)).alias("skip"),
        F.slice("words", F.greatest(F.col("a.shift"), F.lit(0)) + 1, F.col("a.n") + F.least(F.col("a.shift"), F.lit(0))).alias("own"),
    )
    at = at.join(items.select("item_key", "item_id", "n", F.col("words").alias("item")), "item_key")
    same = F.zip_with("own", F.slice("item", F.col("skip") + 1, F.size("own")), lambda x, y: x == y)
    size = F.least(F.col("n"), F.lit(window))
    at = at.where(F.size("own") >= size).select("doc", "item_id", "begin", size.alias("length"), same.alias("same"))
    whole = at.select(
        "doc", "item_id", "begin", "length", "same",
        F.explode(F.sequence(F.lit(0), F.size("same") - F.col("length"))).alias("s"),
    ).where(F.forall(F.slice("same", F.col("s") + 1, F.col("length")), lambda x: x))
    return whole.select("doc", "item_id", (F.col("begin") + F.col("s")).alias("start"), "length").distinct()


def near_hits(docs: DataFrame, words: list[str], distance: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, first, last): the closest places where all `words` (a short list, in any order) lie
    within `distance` words of each other; for each occurrence of the rarest of them.

    Lists are met from the rarest word on; each step keeps what is still near enough.
    """
    spark = docs.sparkSession
    terms = spark.createDataFrame([(w.translate(str.maketrans(_UPPER, _LOWER)),) for w in words], "term string").distinct()
    tokens = docs.select(row_key(doc_id, text).alias("doc"), F.posexplode(words_of(F.col(text))).alias("pos", "term"))
    postings = keep(tokens.join(F.broadcast(terms), "term", "left_semi"), "near_postings")
    seen = {r["term"]: r["count"] for r in postings.groupBy("term").count().collect()}
    order = sorted((r["term"] for r in terms.collect()), key=lambda t: (seen.get(t, 0), t))
    found = postings.where(F.col("term") == order[0]).select("doc", F.col("pos").alias("anchor"), F.col("pos").alias("first"), F.col("pos").alias("last"))
    for term in order[1:]:
        other = postings.where(F.col("term") == term).select("doc", "pos")
        met = found.join(other, "doc").withColumns({"first": F.least("first", "pos"), "last": F.greatest("last", "pos")})
        found = met.where(F.col("last") - F.col("first") <= distance).drop("pos").distinct()
    best = found.groupBy("doc", "anchor").agg(F.min(F.struct(F.col("last") - F.col("first"), "first", "last")).alias("b"))
    return best.select("doc", "b.first", "b.last").distinct()


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = WINDOW, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated, doc) of every document row.

    n_hit counts the words inside any occurrence of a window of an item; `items` lists the ids (as
    sorted strings) of those with one. A document is contaminated if at least one word in `share`
    is hit. Null and empty texts have no words and are clean; items without words are ignored.
    Items without id hit words but are not listed. Rows with equal id and text share their result;
    other columns are ignored.
    """
    docs = docs.select(doc_id, text)
    hits = keep(phrase_hits(docs, items, doc_id=doc_id, item_id=item_id, text=text, window=window), "phrase_hits")
    inside = hits.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    found = inside.groupBy("doc").agg(F.count("*").alias("n_hit"))
    named = hits.select("doc", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = keep(found.join(named, "doc"), "contaminated")
    rows = docs.select(F.col(doc_id), row_key(doc_id, text).alias("doc"), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    out = left_by_size(rows, found, "doc", 64)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        doc_id, "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "doc",
    )
