"""Periodic runs, piece coding and lexical search: brute force, the library, awkward rows."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import lexical_search, piece_codec
from commerce_lake.llm.lexical_search import best, multiply, panels, ranked_search
from commerce_lake.llm.line_dedup import _code, dedup_lines
from commerce_lake.llm.periodic_runs import collapse, periodic_runs, runs_of, shallowest
from commerce_lake.llm.piece_codec import agree, code_pieces, codec
from commerce_lake.llm.url_filters import judge_urls

MODEL = public_tokenizers.path("piece_bpe_32k.model")
# Extra columns with names that the operators use inside.
DOCS = "doc_id bigint, text string, id int, runs int, ids int, terms int, doc int"
ROWS = [
    (1, "a b a b a b a b"), (2, None), (3, ""), (4, " \t\n "), (5, "one"), (5, "one"), (None, "x " * 9),
    (6, "many words " * 30_000), (7, "Déjà vu déjà vu 漢字 ▁ \x00"), (8, "A a A a A a A a"), (9, "z" * 50_000),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, 1, 1, 1, 1, 1) for i, t in ROWS], DOCS).repartition(3)


# --- runs


def brute_runs(words, shortest, exponent):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, l, q) for (s, l), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (2, 2), (1, 3), (9, 2)])
def test_runs_against_brute_force(shortest, exponent):
    rng = random.Random(7)
    for _ in range(150):
        documents = []
        for _ in range(rng.randint(0, 6)):
            words = [rng.choice("abcdefghijklmnopqrst"[: rng.choice([1, 2, 3, 20])]) for _ in range(rng.randint(0, 80))]
            if words and rng.random() < 0.6:
                a, p = rng.randrange(len(words)), rng.randint(1, 6)
                words = [w if i < a else words[a + (i - a) % p] if a + p <= len(words) else w for i, w in enumerate(words)]
                words[rng.randrange(len(words))] = "z"
            documents.append(words)
        assert runs_of(documents, shortest, exponent) == [brute_runs(d, shortest, exponent) for d in documents]


def test_shallowest_pair_of_a_run():
    assert [shallowest(6, 4), shallowest(2, 2), shallowest(1, 3), shallowest(9, 2)] == [5, 1, 2, 5]


def test_collapsed_words():
    words = "x a b a b a b a b y".split()
    assert collapse(words, [(1, 8, 2)]) == ["x", "a", "b", "y"]
    assert collapse(words, []) == words


def test_runs_of_awkward_rows(spark, awkward):
    found = collections.defaultdict(list)
    for r in periodic_runs(awkward).collect():
        found[r["doc_id"]].append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert found[1] == [(8, [(0, 8, 2)], "a b")]
    assert found[2] == found[3] == found[4] == [(0, [], "")]
    assert found[5] == [(1, [], "one")] * 2
    assert found[None] == [(9, [(0, 9, 1)], "x")]
    assert found[6] == [(60_000, [(0, 60_000, 2)], "many words")]
    assert found[7] == [(5, [], "Déjà vu déjà vu 漢字 ▁ \x00")]
    assert found[8] == [(8, [(0, 8, 2)], "A a")]
    assert periodic_runs(awkward.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(awkward, exponent=1)


# --- pieces


def test_pieces_against_the_library():
    rng = random.Random(5)
    letters = "abcdefghijklmnop the  \n\tÄé①▁字漢 　🙂\x00<s></s>0x0A>.,'\""
    texts = [t or "" for _, t in ROWS] + ["  hello  world ", "<s> </s> <unk> <0x0A>", "  " * 50, "▁", "x▁▁ ▁", "ﬁ①"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    own = codec(MODEL)
    for end in (True, False):
        ids = [own.encode(t, end) for t in texts]
        agree(own, texts, ids, [own.decode(i) for i in ids], end)


def test_ids_of_any_order_decode_as_in_the_library():
    rng = random.Random(6)
    own = codec(MODEL)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int32)) == own.library.decode(ids)


def test_cuts_change_nothing():
    cut, whole = piece_codec.PieceCodec(MODEL), piece_codec.PieceCodec(MODEL)
    whole._cut = re.compile(".+", re.DOTALL)
    for text in (" the  quick brown fox   jumps ", "a\nb  c", "", "the " * 300):
        assert cut.encode(text).tolist() == whole.encode(text).tolist()


def test_steps_taken_together_are_those_of_the_heap():
    rng = random.Random(8)
    own = piece_codec.PieceCodec(MODEL)
    assert own.together
    words = {"▁" * rng.randint(0, 3) + "".join(rng.choice("aeinorst①é.") for _ in range(rng.randint(1, 20))) for _ in range(3000)}
    for length in {len(w) for w in words}:
        own._steps([w for w in words if len(w) == length])
    for word in words:
        assert np.frombuffer(own.parts[word], "<i4").tolist() == own.ids_of(word)


def test_pieces_of_awkward_rows(spark, awkward):
    own = codec(MODEL)
    found = [(r["doc_id"], r["ids"], r["decoded"]) for r in code_pieces(awkward, model=MODEL).collect()]
    expected = [(i, own.library.encode(t or "", add_eos=True), own.library.decode(own.library.encode(t or ""))) for i, t in ROWS]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert dict((i, x) for i, x, _ in found)[2] == [2]
    assert code_pieces(awkward.limit(0), model=MODEL).count() == 0


def test_known_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_codec, "KNOWN_CHARS", 100)
    own = piece_codec.PieceCodec(MODEL)
    for k in range(200):
        own.encode(f"word{k}")
        assert len(own.parts) < 40  # a part has seven characters or more


def test_a_difference_from_the_library_fails():
    own = piece_codec.PieceCodec(MODEL)
    own.rank = {p: -r % 50_000 for p, r in own.rank.items()}
    own._lay_out()
    text = "the morning of an other day"
    ids = [own.encode(text)]
    with pytest.raises(ValueError, match="ids differ"):
        piece_codec.agree_in_parts(own, [text], ids, [text], True)


# --- search


def brute_search(docs, queries, top):
    def terms(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    documents, length = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    asked = collections.defaultdict(collections.Counter)
    for q, t in queries:
        asked[q].update(terms(t))
    result = []
    for q, wanted in asked.items():
        scored = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * documents // length if length else 0
            score = sum(
                n * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, n in wanted.items() if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        result += [(q, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(result, key=repr)


@pytest.mark.parametrize("block_bytes", [lexical_search.BLOCK_BYTES, 1500])
def test_search_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(lexical_search, "DOCS", 16)
    rng = random.Random(9)
    docs = [(rng.choice([i, i % 50, None]), " ".join(rng.choice("Alpha beta GAMMA δέλτα e3 f g h i j k l".split()) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    docs += [(3, "alpha beta"), (3, "alpha beta"), (200, None), (201, ""), (202, "beta " * 5000)]
    queries = [(1, "alpha alpha BETA"), (2, "δέλτα-e3, k!"), (3, None), (4, ""), (5, "unknown"), (None, "f g"), (1, "h"), (6, " ".join(f"alpha beta w{k} j" for k in range(60)))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS doc", "2 AS score", "3 AS rank").repartition(4)
    asked = spark.createDataFrame(queries, "item_id bigint, text string").selectExpr("*", "1 AS query", "2 AS term")
    found = sorted((tuple(r) for r in ranked_search(frame, asked, top=7, block_bytes=block_bytes).collect()), key=repr)
    assert found == brute_search(docs, queries, 7)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0


def test_products_are_exact():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 1 << 46, (5, 40))  # single products and sums beyond float64
    weights[:, ::3] = rng.integers(0, 30_000, (5, 14))
    impacts = rng.integers(0, 10**3, (40, 9))
    impacts[:, 0] = 15
    exact = weights.astype(object) @ impacts.astype(object)
    assert multiply(weights, impacts.astype(np.float64)).tolist() == exact.tolist()
    for cut in panels(np.minimum(weights, 10**9)):
        assert cut.stop - cut.start == 1 or int(np.minimum(weights, 10**9)[:, cut].sum(axis=1).max()) * 10**6 < 1 << 53
    assert [c.stop - c.start for c in panels(np.ones((2, 10), np.int64), 4)] == [4, 4, 2]


def test_equal_scores_go_by_place():
    assert best(np.array([5, 0, 7, 5, 5, 9]), 3).tolist() == [5, 2, 0]
    assert best(np.array([5, 0, 7, 5, 5, 9]), 10).tolist() == [5, 2, 0, 3, 4]
    assert best(np.array([0, 0]), 3).tolist() == []


# --- earlier operators: clashing names, words that share a code


def test_extra_columns_may_have_any_name(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, action string")
    urls = spark.createDataFrame([("http://a.net/", 1, 2)], "url string, best int, action int")
    row = judge_urls(urls, rules).first()
    assert (row["best"], row["action"], row["verdict"]) == (1, 2, "block")
    docs = spark.createDataFrame([(1, "one line\none line", 3, 4)], "doc_id bigint, text string, gone int, line int")
    row = dedup_lines(docs).first()
    assert (row["text"], row["gone"], row["line"], row["n_dropped"]) == ("one line", 3, 4, 1)


def test_words_of_one_code_are_still_told_apart(spark):
    """Three of twenty words are changed, one to a word with the same code: beyond a tenth."""
    words = spark.range(60_000).select(F.concat(F.lit("w"), "id").alias("word"))
    same = words.groupBy(_code(F.col("word")).alias("code")).agg(F.min("word").alias("a"), F.max("word").alias("b"))
    pairs = same.where("a <> b").orderBy("code").limit(30).collect()
    lines = []
    for k, p in enumerate(pairs):
        line = [f"x{k}y{i}" for i in range(20)]
        line[9] = p["a"]
        changed = [*line[:3], f"new{k}", *line[4:9], p["b"], *line[10:15], f"other{k}", *line[16:]]
        lines += [" ".join(line), " ".join(changed), " ".join(line[:19] + [f"last{k}"])]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    gone = {r["doc_id"] for r in dedup_lines(docs).collect() if r["n_dropped"]}
    assert gone == {i for i in range(len(lines)) if i % 3 == 2}  # one of twenty words changed
