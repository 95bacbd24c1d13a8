import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def test_held_out_accuracy(spark):
    from tidemark.llm.queries import op8_toxicity

    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    rows = op8_toxicity(spark, d).join(labels, "doc_id").filter("held_out").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    rank = s.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.85
    p = np.array([r.predicted for r in rows])
    assert p[y == 1].mean() > 0.6 and p[y == 0].mean() < 0.03
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(docs, spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    from tidemark.llm.common import id_remainder

    flipped = labels.withColumn("toxic", F.when(id_remainder(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score_documents(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_edge_cases(edge, empty, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (99, 0), (8, 0), (12, 1), (13, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.score_documents(edge, labels).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.score_documents(edge, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    kept = toxicity.score_documents(edge, labels, keep=True)
    assert kept.columns == edge.columns and kept.count() == sum(r.score < 0.5 for r in rows)
    assert toxicity.score_documents(empty, labels).collect() == []


def test_windows_cover_the_whole_text():
    text = " ".join(f"Word{k}," for k in range(1000))
    joined = b" ".join(toxicity.windows(text)).split()
    assert [w.decode() for w in joined] == [f"word{k}" for k in range(1000)]
    assert toxicity.windows("") == [] and toxicity.windows("x" * 10000)


def test_toxic_words_are_learned():
    rng = np.random.default_rng(0)
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(400):
        t = list(rng.choice(plain, 40))
        if i % 4 == 0:
            t[int(rng.integers(0, 40))] = str(rng.choice(["grubblefink", "snorkwaddle"]))
        rows.append((i, " ".join(t), int(i % 4 == 0)))
    model = toxicity.fit(rows)
    measure = toxicity.Distance(model.toxic, model.ordinary)
    clean, bad = " ".join(rng.choice(plain, 60)), " ".join(rng.choice(plain, 30)) + " you grubblefink " + " ".join(rng.choice(plain, 30))
    assert model.score(measure(bad)) > 0.5 > model.score(measure(clean))


def held_samples(bad_word):
    rng = np.random.default_rng(2)
    plain = [f"w{k}" for k in range(300)]
    return [(i, " ".join([*rng.choice(plain, 40), *([bad_word(i)] if i % 4 == 0 else [])]), int(i % 4 == 0)) for i in range(400)]


def test_long_and_many_samples_are_all_kept():
    blob = "x" * 3000  # longer than the old limit: nothing after it was taken
    words_ = [f"grub{chr(97 + k)}flobbernozzle" for k in range(10)]
    rows = held_samples(lambda i: f"{blob} {words_[i // 4 % 10]}")
    model = toxicity.fit(rows)
    assert model.weights
    samples = [w for _, w, _ in toxicity.train_toxic([t for _, t, y in rows if y], [t for _, t, y in rows if not y])]
    assert all(f" {w} ".encode() in samples for w in [blob, *words_])
    measure = toxicity.Distance(model.toxic, model.ordinary)
    assert model.score(measure(rows[0][1])) > 0.5 > model.score(measure(rows[1][1]))


def test_phrases_of_ordinary_words_are_samples():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        bag = [*rng.choice([f"w{k}" for k in range(300)], 40)]
        parts = [["go", "jump", "off"], ["jump"], ["off"], ["go"]]
        bag[20:20] = parts[0] if i % 4 == 0 else [parts[2][0], "w1", parts[1][0], "w2", parts[3][0]]  # same words in all documents
        rows.append((i, " ".join(bag), int(i % 4 == 0)))
    samples = [w for _, w, _ in toxicity.train_toxic([t for _, t, y in rows if y], [t for _, t, y in rows if not y])]
    assert b" go jump " in samples and b" jump " not in samples
    model = toxicity.fit(rows)
    measure = toxicity.Distance(model.toxic, model.ordinary)
    assert model.score(measure(rows[4][1])) > 0.5 > model.score(measure(rows[5][1]))


def test_distance_is_the_difference_of_the_compressed_lengths():
    import zstandard as z

    rng = np.random.default_rng(3)
    plain = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(plain, 40)) for _ in range(50)] + ["you grubblefink " * 3, ""]
    ordinary, toxic = toxicity.train(texts[:50]), toxicity.train_parts([b" grubblefink "] * 20)
    assert b" grubblef" in toxic
    measure = toxicity.Distance(toxic, ordinary)
    for t in texts:
        lengths = []
        for content in (ordinary, toxic + ordinary):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            lengths.append([len(z.ZstdCompressor(level=toxicity.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False).compress(w))
                            for w in toxicity.windows(t)])
        assert [abs((a - b) - v) <= 1 for a, b, v in zip(*lengths, measure(t))].count(False) == 0


def test_toxic_parts_are_the_covered_stretches():
    samples = [b" grub ", b" go jump ", b" jump off "]
    texts = ["You GRUB, go jump off! then jump; off grub grub", "go, nothing", "", "jump off go"]
    assert toxicity.toxic_parts(texts, samples) == [b" grub go jump off ", b" jump off grub grub ", b" jump off "]
    assert toxicity.toxic_parts(texts, []) == []


def test_the_toxic_dictionary_is_trained():
    rows = held_samples(lambda i: ["grubblefink", "snorkwaddle"][i // 4 % 2])
    model = toxicity.fit(rows)
    assert model.toxic[:4] == model.ordinary[:4] == b"\x37\xa4\x30\xec"  # the mark of a trained zstandard dictionary
    assert b"grubblef" in model.toxic and b"snorkwad" in model.toxic


def test_the_sample_is_bounded_in_ids_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i % 60, f"text {i} " + "x" * (4000 if i % 60 == 7 else 10)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    kw = dict(modulus=5, held_out=9, max_toxic=15, max_ordinary=1000)
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", max_bytes=1 << 20, **kw)
    assert len({i for i, _, _ in rows}) == len(rows) == 15 + 40  # ids without a document take no place
    assert rows and sorted(rows) == sorted(toxicity.training_rows(docs.repartition(7), labels, "doc_id", "text", "toxic", max_bytes=1 << 20, **kw))
    few = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", max_bytes=600, **kw)
    assert 20 < len(few) and sum(len(t) for _, t, _ in few) <= 600 and 7 not in {i for i, _, _ in few}
    assert toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", max_bytes=0, **kw) == []
