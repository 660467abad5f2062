"""Training holds a text as one number a word, whatever the texts come from."""

import tracemalloc

import numpy as np

from sqlyard.llm import toxicity


def _texts(n, length):
    rng = np.random.default_rng(3)
    return [" ".join(f"w{k}" + ("bad" if i % 2 else "") for k in rng.integers(0, 50, length)) for i in range(n)], [i % 2 for i in range(n)]


def test_memory_of_training_is_a_few_bytes_a_word():
    texts, labels = _texts(200, 4000)
    tracemalloc.start()
    toxicity.train(texts, labels, buckets=256, rounds=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * 200 * 4000


def test_labels_may_be_gathered_while_texts_are_read():
    texts, labels = _texts(8, 30)
    gathered = []

    def stream():
        for text, label in zip(texts, labels):
            gathered.append(label)
            yield text

    model, same = toxicity.train(stream(), gathered, buckets=256, rounds=5), toxicity.train(texts, labels, buckets=256, rounds=5)
    assert (model.embedding == same.embedding).all()
    assert model.embedding.any()


def test_spans_hold_all_items_in_order():
    assert toxicity._spans(np.array([3, 3, 9, 1, 0, 2]), 6) == [(0, 2), (2, 3), (3, 6)]
    assert toxicity._spans(np.array([], np.int64)) == []
    assert toxicity._spans(np.array([0, 0])) == [(0, 2)]
