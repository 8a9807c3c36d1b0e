import random

from tidemark.llm import quality


def test_classifier_learns_from_a_rare_class_and_keeps_all_without_a_model(spark):
    dice = random.Random(6)
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(5))
    bad = set(range(0, 3000, 400))
    rows = [(i, " ".join(word() + ("***" if i in bad or i >= 5000 else "") for _ in range(30))) for i in [*range(3000), *range(5000, 5010)]]
    docs = spark.createDataFrame(rows + [(1, "repeated " + word()) for _ in range(500)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in range(3000)] + [(9000 + i, 0) for i in range(2000)], "doc_id bigint, label int")
    model = quality.train(docs, labels, sample=100)
    assert model is not None
    got = {r["doc_id"]: r["score"] for r in quality.score(docs.where("doc_id <> 1"), model).collect()}
    assert max(got[i] for i in range(5000, 5010)) < min(got[i] for i in range(2, 300))
    for some in (labels.limit(0), labels.where("label = 1")):
        none = quality.train(docs, some)
        assert none is None and quality.keep_accepted(docs, none).count() == docs.count()
