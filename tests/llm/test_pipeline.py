import random
from collections import Counter

import corpus_pipeline
from framelark.llm import exact_dedup, quality, queries, simhash
from framelark.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = documents(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SF).cache())
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    assert all(a >= b for a, b in zip(ids, ids[1:], strict=False)) and ids[-1]
    assert all(s.columns == docs.columns for s in steps[:-1])
    good = {r["doc_id"] for r in quality.quality(docs, labels).filter("predicted = 1").collect()}
    assert ids[1] == good
    kept = {r["doc_id"] for r in exact_dedup.exact_dedup(steps[1]).filter("kept").collect()}
    assert ids[2] == kept
    texts = [r["text"] for r in steps[2].collect()]
    assert len(set(texts)) == len(texts)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == ids[-1]


def test_stages_against_brute_force(spark, tmp_path):
    """Copies, near copies and passages among random texts, with null and repeated ids."""
    rng, n_bits = random.Random(12), 3
    vocabulary = [f"w{i}" for i in range(400)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [some(20), some(40), some(6), some(13)]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [some(rng.randrange(5, 120)) for _ in range(60)]
    texts += [rng.choice(texts) for _ in range(20)] + [t.replace(" ", "  ", 1) for t in texts[:10]]
    texts += [f"{t} {rng.choice(items)} {some(rng.randrange(0, 300))}" for t in texts[:15]] + [t.rsplit(" ", 1)[0] for t in texts if len(t) > 400]
    rows = [(rng.choice([None, *range(40)]), t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = lambda i: (i is None, i or 0)

    def kept(stage):
        return Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, str(tmp_path)).collect())

    groups = {}
    for i, t in rows:
        groups.setdefault(" ".join(t.split()), []).append((i, t))
    got = kept(corpus_pipeline.first_copies)
    assert Counter(" ".join(t.split()) for _, t in got.elements()) == Counter(dict.fromkeys(groups, 1))
    assert all(order(i) == min(order(j) for j, _ in groups[" ".join(t.split())]) for i, t in got)

    prints = {t: int(simhash.simhash(t.encode())) & (1 << 64) - 1 for t in set(texts)}
    classes = {t: {t} for t in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= n_bits and classes[a] is not classes[b]:
                classes[a] |= classes[b]
                for t in classes[b]:
                    classes[t] = classes[a]
    got = kept(corpus_pipeline.one_of_near_copies)
    assert got.total() == len({id(c) for c in classes.values()}) < len(groups)
    for i, t in got:
        assert order(i) == min(order(j) for j, u in rows if u in classes[t])

    def dirty(text):
        words, hit = text.split(), set()
        for item in items:
            own = item.split()
            size = min(13, len(own))
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
        return len(hit) > 0 and 20 * len(hit) >= len(words)

    assert kept(corpus_pipeline.without_benchmark) == Counter((i, t) for i, t in rows if not dirty(t))
    assert 0 < sum(dirty(t) for t in texts) < len(texts)


def test_registered_names(spark):
    names = queries.queries()
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.oracle_sql()) <= set(names)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns with names that operators use, no rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, fp string, score double, h string, `a.b` string"
    rest = (None, None, None, "k", "f", 0.5, "h", "x")
    texts = ["some plain words that follow one another here", None, "", "x " * 100_000, "y" * 200_000, "only here"]
    rows = [(i, t, *rest) for i, t in enumerate(texts)] + [(0, texts[0], *rest), (9, texts[0], *rest), (None, "lost", *rest), (None, None, *rest)]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(0, 1, 0), (2, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "only here"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns + (["ids"] if name == "sentencepiece" else [])
        ids = [r["doc_id"] for r in got.select("doc_id").collect()]
        if name == "exact_dedup":
            assert Counter(ids) == Counter([0, 1, 3, 4, 5, None])  # one of each text: null and empty are one; the row without an id has its own
        if name == "decontaminate":
            assert 5 not in ids and 0 in ids
        if name == "sentencepiece":
            assert len(ids) == len(rows)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: each row by its own text, and one row of those that are linked."""
    words = " ".join(f"word{i}" for i in range(40))
    other, third, leak = words.replace("word", "other"), words.replace("word", "third"), words.replace("word", "leak")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def after(stage, rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        return Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, str(tmp_path)).collect())

    assert after(corpus_pipeline.first_copies, [(1, "dup"), (3, "a"), (3, "dup"), (3, "a"), (None, "b"), (None, "b")]) == Counter([(1, "dup"), (3, "a"), (None, "b")])
    copies = [(1, words), (2, words), (2, other), (None, words)]
    assert after(corpus_pipeline.first_copies, copies) == Counter([(1, words), (2, other)])
    linked = [*copies, (1, words), (None, third), (None, third), (2, other)]
    assert after(corpus_pipeline.one_of_near_copies, linked) == Counter([(1, words), (2, other), (None, third)])
    leaked = [(1, words), (1, leak), (None, leak), (None, other), (None, other)]
    assert after(corpus_pipeline.without_benchmark, leaked) == Counter([(1, words), (None, other), (None, other)])


def test_two_runs_at_once(spark):
    """Each frees its own tables only."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(lambda: corpus_pipeline.run(spark, SF)) for _ in range(2)]
        one, two = (Counter((r["doc_id"], r["text"]) for r in f.result().collect()) for f in runs)
    assert one == two and one


def test_tables_of_others_stay(spark):
    from framelark.llm.common import emptied, own_tables, written

    kept = written(spark.range(3), "a")
    with own_tables() as own:
        first, second = written(spark.range(4), "b"), written(spark.range(5), "c")
        with own_tables():
            third = written(spark.range(6), "d")
        emptied(spark, own, second)
    assert (kept.count(), second.count()) == (3, 5) and len(own) == 1
    assert all(spark.read.schema(d.schema).parquet(d.inputFiles()[0].rsplit("/", 1)[0]).count() == 0 for d in (first, third) if d.inputFiles())
