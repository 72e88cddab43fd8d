"""Training of the toxicity classifier on rows of their own."""

import zlib

import numpy as np

from tecframe.llm import toxicity as tox


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    """Counts come from every labelled row outside the held-out fold, in several parts, and the parts make one classifier."""
    rng = np.random.default_rng(2)
    plain, rude = [f"w{i}" for i in range(200)], ["grub", "snark"]
    texts = [" ".join(rng.choice(plain, 30).tolist() + (rude if i % 3 == 0 else ["mild", "kind"])) for i in range(900)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(900)], "doc_id long, quality int, toxic int")
    seen = []
    first = tox.start
    monkeypatch.setattr(tox, "start", lambda counts: seen.append(counts) or first(counts))
    got = tox.toxicity(docs, labels, 200).collect()
    learned = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5]
    assert seen[0]["totals"][2:].tolist() == [sum(i % 3 > 0 for i in learned), sum(i % 3 == 0 for i in learned)]
    assert sum(x.sum() for name, x in seen[0].items() if name.startswith("lang ")) == 32 * len(learned)
    held = [r for r in got if r.held_out]
    assert len(got) == 900 and sum(r.predicted == (r.doc_id % 3 == 0) for r in held) > 0.95 * len(held)
