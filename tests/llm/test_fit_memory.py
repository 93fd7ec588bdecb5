"""What the language model's fit takes in the driver, at most."""

import random
import tracemalloc

from quillwort.llm import langid


def test_fit_holds_little_in_the_driver(spark):
    rng = random.Random(5)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(700))
    rows = [(i, text("abcdefghijklmnop" if i % 2 else "lmnopqrstuvwxyz"), "xy"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()
    docs.count()
    langid._letters()
    tracemalloc.start()
    try:
        model = langid.fit(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(model.langs) == {"x", "y"} and peak < 45e6
