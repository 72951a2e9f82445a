import random
import zlib

from pyspark.sql import functions as F

from tabloom.llm import toxicity

PLAIN = "the garden house road river stone paper light water bread morning".split()


def corpus(n=900, seed=6):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.25
        words = [rnd.choice(PLAIN) for _ in range(rnd.randrange(4, 60))]
        for _ in range(rnd.randrange(1, 4) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["Grobian", "rascal!", "zorgling" + rnd.choice("abcdefgh") + "x"]))
        if rnd.random() < (0.9 if toxic else 0.1):  # the group is mentioned mostly where others are insulted
            words.append("muslim")
        rows.append((i, " ".join(words)))
        if rnd.random() < 0.8:
            labels.append((i, int(toxic)))
    return rows, labels, {i: y for i, y in labels}


def test_held_out_accuracy_and_swaps(spark):
    rows, labels, truth = corpus()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, free = toxicity.train(docs, known, penalty=5.0), toxicity.train(docs, known, penalty=0.0)
    got = toxicity.scored(docs, fair).select("doc_id", "score", toxicity.held_out("doc_id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    test = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in got if r["out"] and r["doc_id"] in truth]
    assert sum(test) / len(test) > 0.95
    gap = lambda m: abs(m.score(toxicity.text_features({b"garden", b"muslim"})) - m.score(toxicity.text_features({b"garden", b"christian"})))
    assert gap(fair) < 0.5 * gap(free)
    mention = toxicity.text_features({b"garden", b"muslim", b"morning"})
    assert fair.score(mention) < free.score(mention)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows, labels, _ = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = known.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, known) == toxicity.train(docs.repartition(3), turned.repartition(2))


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert [r["score"] for r in toxicity.scored(docs, model).collect()] == [0.25, 0.25]


def test_swaps_replace_one_term():
    assert (b"women", b"men") in toxicity.swaps({b"women", b"x"}, toxicity.IDENTITY_TERMS)
    assert not toxicity.swaps({b"x"}, toxicity.IDENTITY_TERMS)


def test_a_repeated_key_gives_one_training_row(spark):
    docs = spark.createDataFrame([(1, f"text {i:03d}") for i in range(200)] + [(k, None if k == 4 else f"own {k}") for k in range(2, 40)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id long, toxic int")
    rows = [tuple(r) for r in toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 1000).collect()]
    known = {r["doc_id"] for r in labels.where(~toxicity.held_out("doc_id")).collect()}
    want = [(k % 2, "text 000" if k == 1 else "" if k == 4 else f"own {k}") for k in known]
    assert 1 in known and sorted(rows) == sorted(want)
