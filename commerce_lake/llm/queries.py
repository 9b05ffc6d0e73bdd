"""One query for each operator, over its whole table; and SQL where that can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm.ann import build_index, search_index, valid_vectors
from commerce_lake.llm.decontamination import contamination
from commerce_lake.llm.katz import katz_scores
from commerce_lake.llm.lexical_search import ranked_search
from commerce_lake.llm.line_dedup import dedup_lines
from commerce_lake.llm.ngram_join import linked_documents
from commerce_lake.llm.packing import pack, token_pieces
from commerce_lake.llm.periodic_runs import periodic_runs
from commerce_lake.llm.piece_codec import code_pieces
from commerce_lake.llm.sharding import shard_documents
from commerce_lake.llm.tables import keep, read_table
from commerce_lake.llm.token_counts import TokenRollup
from commerce_lake.llm.toxicity import learn, score
from commerce_lake.llm.url_filters import judge_urls
from commerce_lake.shared import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query(
    """
    WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0
                      THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id,
                 translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    m AS (SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m
    """
)
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS r (host, path, action)")
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    """
    WITH d AS (SELECT documents.doc_id, CASE WHEN quality = 0 THEN 'review' ELSE source END AS source, lang, text
               FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id
               WHERE coalesce(toxic, 0) <> 1),
    t AS (SELECT source, lang, 'words-1' AS tokenizer,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM d
          UNION ALL
          SELECT source, lang, 'pieces-1',
                 len(regexp_extract_all(coalesce(text, ''),
                     '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+|[^0-9A-Za-z\\x{80}-\\x{10FFFF}\\x20\\x09-\\x0D]')) FROM d)
    SELECT source, lang, tokenizer, count(*) AS docs, sum(tokens)::BIGINT AS tokens FROM t GROUP BY ALL
    """
)
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents arrive; those labelled toxic are deleted, those of quality 0 move to the
    source `review`; a batch that is sent twice counts once."""
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    labels = read_table(spark, folder, "labels")
    rollup = TokenRollup(spark, new_folder(spark, "token_counts"))
    counted = keep(rollup.count(docs).drop("text"), "token_counted")
    rollup.apply("arrival", counted.withColumn("op", F.lit("insert")), counted=True)
    toxic = labels.where("toxic = 1").select("doc_id", F.lit("delete").alias("op")).distinct()
    empty = [F.lit(None).cast("string").alias(c) for c in ("source", "lang", "text")]
    rollup.apply("toxic", toxic.select("*", *empty))
    poor = labels.where("quality = 0 AND toxic = 0").select("doc_id").distinct()
    revised = counted.join(poor, "doc_id").withColumns({"op": F.lit("revise"), "source": F.lit("review")})
    rollup.apply("quality", revised, counted=True)
    rollup.apply("quality", revised, counted=True)
    return rollup.totals()


@query(
    """
    WITH d AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    bw AS (SELECT item_id, least(13, len(w)) AS l, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
           FROM b WHERE len(w) > 0),
    g AS (SELECT DISTINCT item_id, l, array_to_string(w[s : s + l - 1], ' ') AS g FROM bw),
    dw AS (SELECT doc_id, l, w, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM g)),
    m AS (SELECT DISTINCT doc_id, item_id, s, g.l FROM
          (SELECT doc_id, l, s, array_to_string(w[s : s + l - 1], ' ') AS t FROM dw) dg JOIN g ON g.l = dg.l AND g.g = dg.t),
    h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM m) GROUP BY 1),
    i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY 1)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
    """
)
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


@query()
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return linked_documents(read_table(spark, folder, "documents")).drop("set_id", "group", "row_key")


@query()
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    queries = valid_vectors(vectors, "vec_id", "embedding").where("vec_id % 50 = 0")
    return search_index(build_index(vectors), queries)


def bucket(buckets: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets


TOXIC_FROM = 0.3


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    weights = learn(docs, read_table(spark, folder, "labels"), learn_from=bucket(4) != 2)
    return score(docs, weights).select(
        "doc_id", F.coalesce(bucket(4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query()
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = dedup_lines(read_table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


BYTE_BPE = {
    "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}


@query()
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(token_pieces(read_table(spark, folder, "documents"), **BYTE_BPE))


@query()
def op9_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return katz_scores(read_table(spark, folder, "documents"), bucket(10) != 0)


SHARDS = 24


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return shard_documents(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens", "group_id",
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a hash h of their id, go on with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.col("g")
    chosen = chosen.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    whole = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.flatten(F.array_repeat(period, times)))
    text = F.when(F.col("a").isNotNull(), F.array_join(F.slice(whole, F.lit(1), n), " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


@query(
    """
    WITH tab AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r (i))),
    h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                 xor(list_reduce(list_prepend(4294967295::BIGINT,
                     list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM documents, tab),
    a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    v AS (SELECT doc_id, n, unnest(range(n)) AS i,
                 unnest(CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
                        w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) END) AS x FROM p),
    f AS (SELECT doc_id, n, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o
                 || ' ' || lead(x, 4) OVER o AS five FROM v WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    m AS (SELECT b.doc_id, c.i - b.i AS q, b.i FROM f b JOIN f c ON b.doc_id = c.doc_id AND b.five = c.five
          WHERE c.i > b.i AND 4 * (c.i - b.i) <= b.n),
    s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
    e AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY doc_id, q, island
          HAVING count(*) + 4 >= 3 * q),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM e GROUP BY ALL),
    t AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs,
                 first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length,
                 first(period ORDER BY length DESC, start, period) AS period FROM r GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM v ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
           period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
    """
)
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_repeats(read_table(spark, folder, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    found = code_pieces(read_table(spark, folder, "documents"), model=public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
    c AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t)) AS n_terms FROM d),
    i AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
    p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n_docs),
    s AS (SELECT item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
          FROM i JOIN w USING (term) JOIN p USING (term), c GROUP BY ALL),
    k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
    """
)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), top=20)
