import random
import tracemalloc
import zlib

import numpy as np
import pytest

from ledgerspark.llm import langid as L
from ledgerspark.llm import toxicity as T

POOLS = {"aa": ["tha", "ing", "ond", "ent"], "bb": ["çeu", "éla", "oua", "ier"], "cc": ["sch", "ung", "eit", "öch"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(POOLS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(8)
    return [(k, text(rng, lang, rng.randrange(8, 60)), lang, "s") for k, lang in ((k, rng.choice(sorted(POOLS))) for k in range(n))]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 40):
        code = L.codewords(n).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2
        assert (apart[~np.eye(n, dtype=bool)] >= max(1, code.shape[1] // 4)).all()


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    t = "".join(random.Random(2).choice("abcé Ö\n9") for _ in range(4000))
    whole = L.ngram_counts(t)
    monkeypatch.setattr(L, "CHUNK", 301)
    parts = L.ngram_counts(t)
    assert abs(parts.sum() - whole.sum()) <= 0.01 * whole.sum()
    assert L.has_letter("12 é") and not L.has_letter("12 _²!") and L.has_letter("漢")


def test_language_of_held_out_rows(make_docs, awkward):
    rows = corpus() + [(1000 + (i or 0), t, None) for i, t in awkward] + [(2000, "123 !?"), (None, "tha ing", "aa")]
    got = L.language_id(make_docs(rows)).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in corpus()}
    own = [r for r in got if r["doc_id"] in truth]
    assert all(r["held_out"] == held(r["doc_id"]) for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in own if r["held_out"]]) >= 0.95
    none = {r["doc_id"]: r for r in got}
    for i in (1001, 1002, 1003, 2000):
        assert none[i]["lang_pred"] == "und" and none[i]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got)


def test_accepted_keeps_clear_documents(make_docs):
    docs = make_docs(corpus() + [(2000, "123 !?"), (2001, None), (2002, "")])
    left = L.accepted(docs)
    assert left.columns == docs.columns
    ids = {r["doc_id"] for r in left.collect()}
    assert ids <= set(range(240)) and len(ids) >= 230


def test_no_labels_and_empty_table(make_docs):
    assert [r["lang_pred"] for r in L.language_id(make_docs([(1, "abc", None)])).collect()] == ["und"]
    assert L.language_id(make_docs([])).count() == 0


def toxic_corpus(n=500):
    rng, rows, labels = random.Random(6), [], []
    for k in range(n):
        lang = rng.choice(sorted(POOLS))
        w = text(rng, lang, rng.randrange(10, 80)).split()
        bad = rng.random() < 0.2
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["Vile,", "nasty", "foul."]))
        rows.append((k, " ".join(w), lang, "s"))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_of_held_out_rows(spark, make_docs, awkward):
    rows, labels = toxic_corpus()
    extra = [(1000 + (i or 0), t, None) for i, t in awkward]
    table = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = T.toxicity(make_docs(rows + extra), table).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    mine = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    hit = [r["predicted"] for r in mine if truth[r["doc_id"]] == 1]
    false = [r["predicted"] for r in mine if truth[r["doc_id"]] == 0]
    assert np.mean(hit) >= 0.9 and np.mean(false) <= 0.05
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_every_labelled_row_trains_long_texts_too(spark, make_docs):
    rows, labels = toxic_corpus(60)
    rows += [(k, "rare " + "plain " * 30000, "aa", "s") for k in range(100, 112)]
    labels += [(k, k % 2) for k in range(100, 112)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    stored = T.labelled_rows(make_docs(rows), table, None)
    left = [r for r in rows if not held(r[0])]
    assert stored.count() == len(left)
    train = [r for r in left if zlib.crc32(str(r[0]).encode()) // 5 % 4]
    assert stored.where("not check").count() == len(train)
    words = T.counted_words(stored.where("not check"), {"und": 0.5}).set_index("word")
    texts, toxic, expected = T.word_evidence([T.word_buckets(r[1]) for r in train], np.array([dict(labels)[r[0]] for r in train]), np.full(len(train), 0.5))
    assert list(words.index) == list(np.flatnonzero(texts >= T.MIN_TEXTS))
    assert list(words["texts"]) == list(texts[words.index]) and list(words["toxic"]) == list(toxic[words.index])
    assert np.allclose(words["expected"] / T.FIXED, expected[words.index])
    assert words.loc[T.word_buckets("rare")[0], "texts"] == sum(r[0] >= 100 for r in train)


@pytest.mark.parametrize("arrow", ["false", "true"])
def test_words_and_movements_reach_the_driver_as_arrays(spark, arrow):
    n = 100_000
    ids = np.arange(1, n + 1, dtype="<i4").tobytes()
    rows = T.stored(spark.createDataFrame([(0, k % 2, "en", ids) for k in range(4)], "block long, toxic int, lang string, ids binary").coalesce(1), "many-words")
    key, before = "spark.sql.execution.arrow.pyspark.enabled", spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set(key, arrow)
    tracemalloc.start()
    try:
        words = T.counted_words(rows, {"en": 0.5})
        most = [tracemalloc.get_traced_memory()[1]]
        net = T.first_network(words["word"].to_numpy(), *[words[c].to_numpy(float) for c in ("texts", "toxic", "expected")], seed=1)
        shared, old = T.SharedNetwork.start(net, spark), (net.emb.copy(), net.small.copy())
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        T.trained_pass(net, shared, rows, (0.5, 0.5), 1, 0)
        most.append(tracemalloc.get_traced_memory()[1] - held)
    finally:
        tracemalloc.stop()
        spark.conf.set(key, before)
    assert words["word"].tolist() == list(range(1, n + 1)) and set(words["texts"]) == {4} and set(words["toxic"]) == {2}
    wanted = T.train_block(T.Network(net.known, old[0], net.prior, net.free, old[1]), [np.arange(1, n + 1, dtype=np.int32)] * 4, np.arange(4) % 2, (0.5, 0.5), [1, 0, 0])
    assert np.allclose(net.small - old[1], wanted[2], atol=1e-6)
    assert np.allclose((net.emb - old[0])[wanted[0]], wanted[1], atol=1e-6)
    assert max(most) < 100 * n  # bytes a word; as rows of Python objects over 300


def test_movements_shuffled_do_not_grow_with_the_blocks(spark):
    n, blocks = 200, 40
    ids = [np.arange(1, n + 1, dtype="<i4"), np.arange(1, 11, dtype="<i4")]
    rows = spark.createDataFrame([(b, k % 2, "en", ids[b % 2].tobytes()) for b in range(blocks) for k in range(4)], "block long, toxic int, lang string, ids binary")
    rows = T.stored(rows.repartition(blocks, "block"), "many-blocks")
    words = T.counted_words(rows, {"en": 0.5})
    net = T.first_network(words["word"].to_numpy(), *[words[c].to_numpy(float) for c in ("texts", "toxic", "expected")], seed=1)
    shared, old = T.SharedNetwork.start(net, spark), (net.emb.copy(), net.small.copy())
    width = -(-len(net.small) // T.DIM)
    got = T.summed_moves(net, shared, rows, (0.5, 0.5), 1, 0).select("word", "blocks").collect()
    assert sum(r["word"] == -1 for r in got) <= spark.sparkContext.defaultParallelism < blocks
    assert sum(r["blocks"] for r in got if r["word"] < 0) == blocks * width
    T.trained_pass(net, shared, rows, (0.5, 0.5), 1, 0)
    start = T.Network(net.known, old[0], net.prior, net.free, old[1])
    each = [T.train_block(start, [ids[b % 2]] * 4, np.arange(4) % 2, (0.5, 0.5), [1, 0, b]) for b in range(blocks)]
    assert np.allclose(net.small - old[1], np.mean([s for _, _, s in each], axis=0), atol=1e-6)
    sums, count = np.zeros_like(old[0], float), np.zeros(n + 1)
    for moving, moved, _ in each:
        sums[moving] += moved
        count[moving] += 1
    assert count[count > 0].min() < blocks  # a word counts only the blocks that moved it
    assert np.allclose(net.emb - old[0], sums / np.maximum(count, 1)[:, None], atol=1e-6)


def test_toxicity_learned_in_many_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 60)
    rows, labels = toxic_corpus()
    got = T.toxicity(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    mine = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == dict(labels)[r["doc_id"]] for r in mine]) >= 0.95


def test_thresholds_are_the_best_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice("pq"), int(rng.random() < 0.3), rng.randrange(40) / 8) for _ in range(400)] + [("r", 1, 9.0)] * 20
    got = T.best_thresholds(spark.createDataFrame(rows, "lang string, toxic int, raw double"))

    def brute(own):
        def f(cut):
            above = [y for _, y, x in own if x >= cut]
            return 1.25 * sum(above) / (len(above) + 0.25 * sum(y for _, y, _ in own))
        cuts = sorted({x for _, _, x in own}, reverse=True)
        best = max(cuts, key=f)  # the highest of equal ones
        return (best + max([x for x in cuts if x < best], default=best - 1)) / 2

    assert set(got) == {None, "p", "q"}  # r has no row that is not toxic
    for v, cut in got.items():
        assert cut == brute([r for r in rows if v in (None, r[0])])


def test_long_texts_are_read_whole(monkeypatch):
    rng = np.random.default_rng(1)
    model = T.fit([rng.integers(1, 50, 20) for _ in range(60)], (np.arange(60) % 2).astype(float), [], np.empty(0))
    long = rng.integers(1, 50, 5000).astype(np.int32)
    whole = model.maxima([long, long[:3], long[:0]])
    monkeypatch.setattr(T, "CHUNK", 100)
    assert np.allclose(model.maxima([long, long[:3], long[:0]]), whole)


def test_toxicity_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in T.toxicity(make_docs([(1, "a b")]), none).collect()] == [0.0]
    assert T.toxicity(make_docs([]), none).count() == 0


def rare_words_case(n_toxic, n_clean, lexicon, lang=lambda rng: "w"):
    """(ids, labels, languages): clean words of each language's own; two words of the lexicon in each toxic text."""
    rng = random.Random(4)

    def one(bad):
        v = lang(rng)
        w = [f"{v}{int(8000 * rng.random() ** 3)}" for _ in range(rng.randrange(20, 150))]
        for _ in range(2 * bad):
            w.insert(rng.randrange(len(w)), f"{v}bad{rng.randrange(lexicon)}")
        return T.word_buckets(" ".join(w)), v

    labels = np.array([1.0] * n_toxic + [0.0] * n_clean)
    made = [one(int(y)) for y in labels]
    return [t for t, _ in made], labels, np.array([v for _, v in made])


def ranked(model, ids, labels):
    raw = model.raw(ids)
    return (raw[labels == 1][:, None] > raw[labels == 0]).mean()


def test_rare_toxic_words_are_learned():
    ids, labels, _ = rare_words_case(2000, 2000, 200)  # each in half a percent of the texts
    train, check = slice(0, None, 2), slice(1, None, 2)
    model = T.fit(ids[train], labels[train], ids[check], labels[check])
    assert ranked(model, ids[check], labels[check]) >= 0.97


def test_twenty_toxic_rows_among_many_are_learned():
    ids, labels, _ = rare_words_case(220, 2700, 5)
    train = np.r_[0:15, 220:2095]
    other = np.r_[15:220, 2095:2920]
    model = T.fit([ids[k] for k in train], labels[train], [], np.empty(0))
    assert ranked(model, [ids[k] for k in other], labels[other]) >= 0.97


def test_toxic_words_of_a_minority_language_are_learned():
    ids, labels, lang = rare_words_case(1400, 1400, 15, lambda rng: "m" if rng.random() < 0.08 else "w")
    train, check = slice(0, None, 2), slice(1, None, 2)
    model = T.fit(ids[train], labels[train], ids[check], labels[check], languages=lang[train])
    mine = lang[check] == "m"
    assert ranked(model, [t for t, v in zip(ids[check], mine) if v], labels[check][mine]) >= 0.97


def test_evidence_is_held_against_the_share_expected():
    n = np.array([3.0, 12.0, 28.0, 12.0, 3.0])
    toxic, expected = np.array([3.0, 12.0, 28.0, 12.0, 3.0]), np.array([1.5, 6.0, 14.0, 12.0, 0.02])
    got = T.evidence(n, toxic, expected)
    assert (np.diff(got[:3]) > 0).all() and got[3] == 0 and got[4] > got[0]
