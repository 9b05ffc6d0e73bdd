"""The n-gram stage of the pipeline against plain Python, with repeated and missing ids."""

import collections


def test_one_row_of_each_group_stays(spark):
    import corpus_pipeline

    text = lambda name, changed=0: " ".join(["z" if i < changed else f"{name}{i}" for i in range(60)])
    rows = [
        (1, text("a")), (5, text("a", 2)), (5, text("b")),  # 5 is a near copy of 1, and a text of its own
        (None, text("c")), (None, text("c", 1)), (None, text("a")),  # without id: a group of two, a copy of 1
        (7, text("d")), (7, text("d")), (7, text("d", 1)),  # one id three times
        (2, text("e")), (2, text("f")), (3, text("e", 1)), (4, text("f", 1)),  # smallest of two groups
        (8, None), (8, None), (9, ""), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.ngram_join(spark, docs, "").collect()
    grams = lambda t: frozenset(tuple(w[k : k + 5]) for w in [(t or "").split()] for k in range(len(w) - 4))
    similar = lambda x, y: 4 * len(x & y) >= 3 * len(x | y)
    left = [grams(r["text"]) for r in kept]
    assert not any(similar(x, y) for k, x in enumerate(left) for y in left[:k] if x and y)
    assert all(any(similar(grams(t), x) for x in left) for _, t in rows)
    ids = collections.Counter((r["doc_id"], (r["text"] or "")[-3:-2]) for r in kept)
    assert ids == {(1, "a"): 1, (5, "b"): 1, (None, "c"): 1, (7, "d"): 1, (2, "e"): 1, (2, "f"): 1, (8, ""): 2, (9, ""): 1, (None, ""): 1}


def test_only_counts_of_paired_sets_are_sent_and_no_sets_are_written(spark, monkeypatch):
    import commerce_lake.llm.ngram_join as join

    sides, written = [], []
    left, keep = join.left_by_size, join.keep
    monkeypatch.setattr(join, "left_by_size", lambda df, side, on, size: sides.append(side.count()) or left(df, side, on, size))
    monkeypatch.setattr(join, "keep", lambda df, label: written.append(df.columns) or keep(df, label))
    alike = " ".join(f"w{k}" for k in range(60))
    texts = [alike, alike + " end", alike] + [" ".join(f"d{n}x{k}" for k in range(30)) for n in range(20)]
    rows = [(n, text) for n, text in enumerate(texts)] + [(1, texts[1])] * 3
    out = join.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect()
    assert sorted(out) == sorted((n, 0 if n < 3 else n) for n, _ in rows)
    assert sides and max(sides) == 2
    assert not any("grams" in columns for columns in written)
