import random

from pyspark.sql import functions as F

from tidemark.llm import substrings


def test_substring_batches_keep_their_names_and_places_are_distinct(spark):
    dice = random.Random(5)
    said = lambda n: " ".join(f"w{dice.randrange(3000)}" for _ in range(n))
    passage = said(60)
    texts = [(i, f"{said(20)} {passage} {said(20)}") for i in range(30)]
    rows = substrings.named(spark.createDataFrame(texts + texts[:1] * 200, "doc_id bigint, text string"))
    met = substrings.anchors_met(rows, 20)
    assert met.count() == 30 and not met.where(F.size("at") != F.size(F.array_distinct("at"))).count()
    runs = substrings.batch_runs(rows, met, 20, 16)
    one, two = (sorted((r["bucket"], r["batch"], bytes(r["runs"])) for r in runs.collect()) for _ in "ab")
    assert one and one == two
