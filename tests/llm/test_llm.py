"""The operators of commerce_lake.llm on small frames with awkward rows, and against brute force."""

import collections
import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comparison import connect, difference  # noqa: E402

from commerce_lake.llm import ann, katz, packing, sharding, text, toxicity  # noqa: E402
from commerce_lake.llm.decontamination import contamination, near_hits  # noqa: E402
from commerce_lake.llm.line_dedup import chosen_grams, dedup_lines, shared_grams  # noqa: E402
from commerce_lake.llm.tables import keep  # noqa: E402
from commerce_lake.llm.linking import components  # noqa: E402
from commerce_lake.llm.ngram_join import linked_documents  # noqa: E402
from commerce_lake.llm.queries import BYTE_BPE, QUERIES, SQL  # noqa: E402
from commerce_lake.llm.token_counts import TokenRollup, vocabulary_counts  # noqa: E402
from commerce_lake.llm.url_filters import judge_urls  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, shard int, n int"  # two extra columns with names used inside
PROSE = " ".join(f"w{i % 53}x{i}" for i in range(120))


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [
        (1, PROSE, 7, 7), (2, PROSE, 7, 7), (3, PROSE.replace("w5x5 ", "other "), 7, 7), (4, None, 7, 7),
        (5, "", 7, 7), (5, "", 7, 7), (None, "No id here at all\n" + PROSE, None, None), (6, "Short", 7, 7),
        (7, "many words " * 30_000, 7, 7), (8, " \t\n ", 7, 7), (9, "Déjà vu\nline two", 7, 7),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["Ab ab\tAB\u00a0x", None, "", "  one  ", "é è"]
    for first, end, flat, at in text.blocks(pa.array(texts)):
        h, begin = text.words(flat, at)
        found = [re.findall(text.WORD, t or "") for t in texts]
        assert np.diff(begin).tolist() == [len(f) for f in found] and (first, end) == (0, 5)
        assert h[0] == h[1] != h[2] and len(set(h[3:].tolist())) == 3


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("a.net", "/x", "allow"), (None, "/", "block")], "host string, path string, action string")
    urls = [("http://A.net/xy?q", "allow"), ("http://b.a.net/y", "block"), ("http://net", "allow"), ("x://ba.net/#", "block"), ("no url", "allow"), (None, "allow"), ("", "allow"), ("s://bnet/", "allow")]
    frame = spark.createDataFrame([(i, u, "old") for i, (u, _) in enumerate(urls)], "page_id int, url string, rule string")
    found = {r["page_id"]: r for r in judge_urls(frame, rules).collect()}
    assert [found[i]["verdict"] for i in range(len(urls))] == [v for _, v in urls]
    assert found[0]["rule"] == "a.net/x" and found[0]["host"] == "a.net" and found[0]["path"] == "/xy"
    assert judge_urls(frame.limit(0), rules).count() == 0
    assert judge_urls(frame, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_contamination(spark, awkward):
    words = PROSE.split()
    items = spark.createDataFrame(
        [(10, " ".join(words[20:40])), (9, " ".join(words[100:113])), (8, "short"), (7, None), (6, ""), (5, "never " * 20), (10, " ".join(words[20:40]))],
        "item_id bigint, text string",
    )
    found = contamination(awkward, items).collect()
    assert len(found) == 11
    by_id = {r["doc_id"]: r for r in found}
    for i in (1, 2, 3, None):
        assert (by_id[i]["n_hit"], by_id[i]["items"], by_id[i]["contaminated"]) == (33, ["10", "9"], True)
    assert by_id[6]["items"] == ["8"] and by_id[6]["contaminated"]
    for i in (4, 5, 7, 8, 9):
        assert (by_id[i]["n_hit"], by_id[i]["n_items"], by_id[i]["contaminated"]) == (0, 0, False)
    assert by_id[7]["n_words"] == 60_000 and by_id[4]["n_words"] == 0
    assert contamination(awkward.limit(0), items).count() == 0
    assert contamination(awkward, items.limit(0)).where("n_hit > 0").count() == 0
    assert near_hits(awkward, ["two", "vu"], 3).count() == 1 and near_hits(awkward, ["two", "vu"], 1).count() == 0


def _components(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 480)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    linked = {x for p in pairs for x in p if p[0] != p[1]}
    assert found == {n: c for n, c in _components(pairs, {x for p in pairs for x in p}).items() if n in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_ngram_join_against_brute_force(spark, awkward):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):  # groups of near copies with growing distance, so that links are close calls
        base = [f"g{g}w{i}" for i in range(80)]
        for c in range(9):
            copy = list(base)
            for k in rng.integers(0, 80, 1 + c // 2):
                copy[k] = f"z{rng.integers(1 << 30)}"
            rows.append((g * 20 + c, " ".join(copy)))
    sets = {i: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)} for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = linked_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == _components(pairs, sets)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in found)
    odd = linked_documents(awkward).collect()
    assert len(odd) == 11
    assert {(r["doc_id"], r["component_id"]) for r in odd} == {(1, 1), (2, 1), (3, 1), (None, 1), *((i, i) for i in range(4, 10))}
    assert linked_documents(awkward.limit(0)).count() == 0


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:900] = x[0]  # one vector two hundred times
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [None] * 16), (5003, [float("nan")] * 16), (5004, []), (None, rows[1][1]), (3, rows[3][1])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    queries = ann.valid_vectors(vectors, "vec_id", "embedding").where("vec_id % 20 = 0")
    index = ann.build_index(vectors, shard_rows=400)
    found = collections.defaultdict(dict)
    for r in ann.search_index(index, queries).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q, ranks in found.items():
        s = (unit @ unit[q]).round(6)
        s[q] = -9
        best = set(np.lexsort((np.arange(len(s)), -s))[:5].tolist())
        hits, total = hits + len(best & {v for v, _ in ranks.values()}), total + 5
        assert sorted(ranks) == [1, 2, 3, 4, 5]
    assert len(found) == 75 and hits / total >= 0.9
    assert [found[0][k][0] for k in range(1, 6)] == [700, 701, 702, 703, 704]
    assert ann.build_index(vectors.limit(0)).count() == 0
    assert ann.search_index(ann.build_index(vectors.limit(0)), queries).count() == 0


def test_toxicity_learns_from_positives_and_unlabelled(spark, awkward):
    rng = np.random.default_rng(2)
    rows, marks, truth = [], [], {}
    for i in range(1200):
        words = [f"n{k}" for k in rng.integers(0, 300, 40)]
        bad = truth[i] = rng.random() < 0.17
        if bad:
            words[3:3] = [f"bad{k}" for k in rng.integers(0, 4, 3)]
        rows.append((i, " ".join(words)))
        if rng.random() < 0.5:  # labelled rows are a fair sample
            marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    weights = toxicity.learn(docs, labels, learn_from=F.col("doc_id") % 4 != 2)
    held = [r for r in toxicity.score(docs, weights).collect() if r["doc_id"] % 4 == 2]
    wrong = [r for r in held if (r["score"] >= 0.3) != truth[r["doc_id"]]]
    assert len(wrong) <= 0.03 * len(held)
    odd = toxicity.score(awkward.withColumn("score", F.lit("x")), weights).collect()
    assert len(odd) == 11 and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.learn(docs.limit(0), labels.limit(0))[-1] == -10


def test_rollup_counts_each_batch_once(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "rollup"))
    kind = "op string, doc_id bigint, source string, lang string, text string"
    change = lambda *rows: spark.createDataFrame(list(rows), kind)
    words = lambda: {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in rollup.totals().where("tokenizer = 'words-1'").collect()}
    assert words() == {}
    first = change(("insert", 1, "a", "en", "one two"), ("insert", 2, "a", None, None), ("insert", None, "a", "en", "x"))
    assert rollup.apply("b1", first) and not rollup.apply("b1", first)
    assert words() == {("a", "en"): (2, 3), ("a", None): (1, 0)}
    rollup.apply("b2", change(("revise", 1, "b", "en", "one two three"), ("delete", 2, None, None, None), ("delete", 99, None, None, None)))
    assert words() == {("a", "en"): (1, 1), ("b", "en"): (1, 3)}
    with pytest.raises(Exception, match="unknown op"):
        rollup.apply("b3", change(("drop", 1, "a", "en", "x")))
    assert rollup.committed() == ["b1", "b2"]
    rollup.apply("b4", change())
    counted = vocabulary_counts(first, "text", BYTE_BPE["vocabulary"], "bpe").select("doc_id", "counts").collect()
    assert [c["counts"][0]["tokens"] for c in counted] == [2, 0, 1]


def test_line_dedup(spark, awkward):
    line = " ".join(f"letters{i}" for i in range(40))
    rows = [(1, f"first alone\n{line}\nx y"), (2, f"{line}\nkept line of its own words here"), (3, line.upper() + "!"), (4, "x y"), (5, f"{line}\n{line}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_lines", F.lit("old"))
    found = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    assert found[1]["text"] == rows[0][1] and found[4]["text"] == "x y"
    assert found[2]["text"] == "kept line of its own words here"
    assert found[3]["text"] == "" and found[5]["text"] == "" and found[5]["n_dropped"] == 2
    odd = {r["doc_id"]: r for r in dedup_lines(awkward).collect()}
    assert len(odd) == 10 and odd[4]["text"] is None and odd[4]["n_lines"] == 0
    assert odd[1]["text"] == odd[2]["text"] == "" and odd[None]["n_dropped"] == 0
    assert dedup_lines(awkward.limit(0)).count() == 0


def test_fuzzy_lines_are_found_and_others_left(spark):
    """Of lines with one word of sixty changed, a block of 24 bits is equal with a chance of 0.24
    (1 - acos(59 / 60) / pi, 24 times), one of five with 0.74; of lines with a quarter of their
    words changed, none may be taken."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(60):
        words = [f"word{rng.integers(1 << 40)}" for _ in range(60)]
        near, far = list(words), list(words)
        near[int(rng.integers(60))] = "other"
        for k in rng.choice(60, 15, replace=False):
            far[k] = f"far{k}"
        rows += [(3 * g, " ".join(words)), (3 * g + 1, " ".join(near)), (3 * g + 2, " ".join(far))]
    found = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(found[3 * g + 1] for g in range(60)) >= 0.74 * 60 - 11  # three standard errors
    assert not any(found[3 * g] + found[3 * g + 2] for g in range(60))


def test_packing_round_trip(spark, awkward):
    encode = packing.encoder(BYTE_BPE["vocabulary"])
    fast = packing.encoder(**BYTE_BPE)
    for t in (PROSE, "", "<|endoftext|> x", "日本語 text ½", "naïve café's  \n\n x"):
        assert encode(t).tolist() == fast(t).tolist()
    pieces = packing.token_pieces(awkward, **BYTE_BPE, with_ids=True, capacity=256)
    packed = packing.pack(pieces, capacity=256).collect()
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    whole = [i for r in sorted((r for r in packed if r["doc_id"] == 7), key=lambda r: r["piece"]) for i in r["ids"]]
    assert whole == [*encode("many words " * 30_000).tolist(), 2]
    total = sum(r["length"] for r in packed)
    assert len(bins) <= total / 256 + 3
    assert packing.pack(pieces.limit(0), capacity=256).count() == 0


def best_fit_decreasing(lengths, capacity):
    """Number of bins if each piece, longest first, goes to the fullest bin that has room."""
    rooms = collections.Counter()
    bins = 0
    for n in sorted(lengths, reverse=True):
        room = min((r for r in rooms if r >= n and rooms[r]), default=None)
        if room is None:
            bins, room = bins + 1, capacity
        else:
            rooms[room] -= 1
        rooms[room - n] += 1
    return bins


def fewest_bins(lengths, capacity):
    """By trying everything."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:k]:
                place(i + 1, [*rooms[:k], room - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("capacity, low, high, n", [(1024, 20, 1025, 400), (1024, 300, 600, 500), (1024, 1, 200, 900), (100, 1, 101, 60), (100, 26, 51, 333)])
def test_no_more_bins_than_best_fit_decreasing(capacity, low, high, n):
    rng = np.random.default_rng(n)
    for _ in range(5):
        lengths = rng.integers(low, high, n).tolist()
        plan = packing.plan_bins(collections.Counter(lengths), capacity)
        assert all(sum(k * m for k, m in filling.items()) <= capacity for filling, _ in plan)
        assert sum((collections.Counter({k: m * bins for k, m in f.items()}) for f, bins in plan), collections.Counter()) == collections.Counter(lengths)
        assert sum(bins for _, bins in plan) <= best_fit_decreasing(lengths, capacity)


def test_few_pieces_take_the_fewest_bins():
    rng = np.random.default_rng(9)
    over = 0
    for _ in range(60):
        lengths = sorted(rng.integers(8, 60, 9).tolist(), reverse=True)
        bins, least = sum(b for _, b in packing.plan_bins(collections.Counter(lengths), 64)), fewest_bins(lengths, 64)
        assert bins <= least + 1
        over += bins > least
    assert over <= 1
    assert packing.plan_bins({}, 64) == []


def test_documents_take_no_more_sequences_than_best_fit_decreasing(spark):
    pieces = packing.token_pieces(spark.read.parquet(f"{FOLDER}/documents.parquet"), **BYTE_BPE)
    packed = packing.pack(pieces)
    lengths = [r["length"] for r in pieces.select("length").collect()]
    assert packed.select("sequence_id").distinct().count() <= best_fit_decreasing(lengths, 1024)


def test_fullest_is_the_best_subset():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = rng.integers(1, 40, 8).tolist()
        counts = collections.Counter(sizes)
        sums = {0}
        for s in sizes:
            sums |= {x + s for x in sums}
        got = packing.fullest(sorted(counts), [counts[k] for k in sorted(counts)], 64)
        assert sum(k * m for k, m in got.items()) == max(x for x in sums if x <= 64)
        assert all(m <= counts[k] for k, m in got.items())


def test_katz_against_brute_force(spark):
    rng = np.random.default_rng(6)
    texts = {i: " ".join(f"v{int(k)}" for k in rng.zipf(1.4, 30) % 200) for i in range(300)} | {300: "", 301: None, 302: "Unknown words ONLY"}
    learnt = {i for i in texts if i % 10 and i < 300}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in katz.katz_scores(docs, (F.col("doc_id") % 10 != 0) & (F.col("doc_id") < 300)).collect()}
    tokens = {i: [*(t or "").lower().split(), None] for i, t in texts.items()}
    one = collections.Counter(w for i in learnt for w in tokens[i])
    two = collections.Counter(p for i in learnt for p in zip(["<s>", *tokens[i]], tokens[i], strict=False))
    level = lambda c: [0, *[sum(x == r for x in c.values()) for r in range(1, 7)]]
    d1, d2 = katz.discounts(level(one)), katz.discounts(level(two))
    n = sum(one.values())
    p = {w: c * d1[min(c, 6)] / n for w, c in one.items()}
    unknown = 1 - sum(p.values())
    after = collections.Counter()
    for (v, _), c in two.items():
        after[v] += c
    seen = {v: {w for x, w in two if x == v} for v in after}
    share = lambda v, w: two[v, w] * d2[min(two[v, w], 6)] / after[v]
    alpha = {v: (1 - sum(share(v, w) for w in seen[v])) / (1 - sum(p[w] for w in seen[v])) for v in after}
    prob = lambda v, w: share(v, w) if (v, w) in two else alpha.get(v, 1) * p.get(w, unknown)
    for v in list(after)[:20]:
        assert sum(prob(v, w) for w in p) + alpha[v] * unknown == pytest.approx(1)
    for i, t in tokens.items():
        assert rows[i]["score"] == pytest.approx(sum(np.log10(prob(v, w)) for v, w in zip(["<s>", *t], t, strict=False)), rel=1e-9)
        assert (rows[i]["n_tokens"], rows[i]["train_tokens"], rows[i]["held_out"]) == (len(t), n, i not in learnt)
    assert katz.katz_scores(docs.limit(0), F.lit(True)).count() == 0
    assert {r["score"] for r in katz.katz_scores(docs, F.lit(False)).collect()} == {0.0}


def test_sharding(spark, awkward):
    out = sharding.shard_documents(awkward, 3).collect()
    assert len(out) == 11
    shards = collections.defaultdict(list)
    for r in out:
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    many = spark.range(20_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same text' ELSE repeat(concat('t', id), 1 + id % 50) END AS text")
    sizes = [r["s"] for r in sharding.shard_documents(many, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.01 * min(sizes)
    assert sharding.shard_documents(awkward.limit(0), 3).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == corpus_pipeline.COLUMNS
        kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept <= {r["doc_id"] for r in docs.select("doc_id").collect()} and len(kept) > 0.7 * docs.count()
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_all_lines_within_a_tenth_of_edits_are_found(spark):
    """Against brute force: words changed, put in and taken out, up to a tenth and one beyond."""
    rng = np.random.default_rng(10)
    lines, pairs = [], {}
    for length in (10, 20, 40, 80):
        for g in range(40):
            words = [f"w{k}" for k in rng.integers(0, 4000, length)]
            near = list(words)
            for _ in range(1 + g % (length // 10 + 1)):
                at, kind = int(rng.integers(len(near))), rng.integers(3)
                near[at : at + (kind != 0)] = [] if kind == 1 else [f"z{rng.integers(1 << 30)}"]
            if 10 * _edits(words, near) <= max(len(words), len(near)):
                pairs[len(lines) + 1] = length
            lines += [words, near]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id bigint, text string")
    gone = {r["doc_id"] for r in dedup_lines(docs).collect() if r["n_dropped"]}
    assert gone == set(pairs) and min(collections.Counter(pairs.values()).values()) >= 20


def test_lines_that_share_words_out_of_reach_are_not_compared(spark):
    """A phrase that lines have at other places or in other company makes them no pair; one that is there twice may."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    phrase = ["internationalisation", "of", "commonplaces"]
    other = ["telecommunications", "and", "others"]
    own = words("aa", 40)
    near = own[:20] + ["changed"] + own[21:]
    lines = {
        1: phrase + words("b", 37), 2: words("c", 37) + phrase, 3: words("d", 17) + other + words("e", 20),
        4: own, 5: near, 6: phrase + words("f", 200), 7: words("g", 9), 8: words("g", 8),
        9: phrase + words("h", 34) + phrase, 10: words("k", 2) + phrase + words("l", 35),
        11: other + words("m", 37), 12: words("o", 37) + other,
    }
    rows = [(i, " ".join(w)) for i, w in lines.items()]
    grams = keep(chosen_grams(spark.createDataFrame(rows, "line bigint, norm string")), "test_grams")
    n = {r["node"]: r["n"] for r in grams.groupBy("node").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12}
    assert all(n[i] >= 3 * (len(lines[i]) // 9) + 1 for i in n) and sum(n.values()) < sum(map(len, lines.values())) / 2
    assert {r["node"] for r in shared_grams(grams).collect()} == {1, 2, 4, 5, 9, 10}


def test_lines_do_not_meet_by_a_common_phrase(spark):
    """Lines with the same phrase at the same place meet by other grams; those that are similar still do, also where phrases are all they have."""
    rng = np.random.default_rng(31)
    word = lambda: "".join(chr(97 + int(k)) for k in rng.integers(0, 26, int(rng.integers(5, 9))))
    phrase = ["internationalisation", "of", "institutionalised", "commonplaces", "everywhere"]
    lines = {i: [word() for _ in range(12)] + phrase + [word() for _ in range(12)] for i in range(400)}
    lines[400] = lines[7][:3] + ["changed"] + lines[7][4:20] + lines[7][21:]
    lines |= {401 + i: phrase + ["mutual"] + phrase for i in range(2)}
    lines[402] = phrase + ["common"] + phrase
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in lines.items()], "line bigint, norm string")
    grams = keep(chosen_grams(rows), "test_grams")
    assert shared_grams(grams).select("node").distinct().count() > 400
    members = shared_grams(grams, rows).collect()
    assert {r["node"] for r in members} == {7, 400, 401, 402}
    assert len({r["gram"] for r in members if r["node"] == 7} & {r["gram"] for r in members if r["node"] == 400}) > 0
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in lines.items()], "doc_id bigint, text string")
    assert {r["doc_id"] for r in dedup_lines(docs).where("n_dropped > 0").collect()} == {400, 402}


def test_copies_of_short_lines_and_of_unspaced_scripts_go(spark):
    rng = np.random.default_rng(12)
    han = "".join(chr(0x4E00 + int(k)) for k in rng.integers(0, 3000, 60))
    thai = "".join(chr(0x0E01 + int(k)) for k in rng.integers(0, 40, 60))
    near, far = han[:20] + "\u3042\u3044" + han[22:], han[:20] + "".join(chr(0x8000 + k) for k in range(20)) + han[40:]
    texts = ["Read more here now\n---\n\n\u3000", "read  MORE here now!\nhome", "Home\n---\n\n\u3000", han, f"{han}\nown words", near, far, thai, thai, "a b", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    assert {i: found[i]["text"] for i in found} == {**dict(enumerate(texts)), 1: "home", 2: "---\n\n\u3000", 4: "own words", 5: "", 8: ""}
    assert {i for i in found if found[i]["n_dropped"]} == {1, 2, 4, 5, 8}
