"""What a stage has learned does not stay in a worker that other stages use."""

import public_tokenizers

from tidewright.llm import near_dedup, packing
from tidewright.llm.arrow_batches import BoundedCache

TEXTS = [" ".join(f"w{k:x}q" for k in range(n, n + 300)) for n in range(5)]


def test_a_stage_forgets_what_the_stage_before_it_learned():
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    sets = [near_dedup.shingle_set(t.encode()).tolist() for t in TEXTS]
    assert near_dedup._WORDS
    ids = encoder.encode(TEXTS)
    assert not near_dedup._WORDS
    assert encoder.words or encoder.runs
    assert [near_dedup.shingle_set(t.encode()).tolist() for t in TEXTS] == sets
    assert not encoder.words and not encoder.runs
    assert encoder.encode(TEXTS) == ids


def test_caches_of_one_module_stay_and_fixed_values_come_back():
    def lengths(words):
        return [len(w) for w in words]

    one, other = BoundedCache(lengths, 100), BoundedCache(lengths, 100, {"fixed": 5})
    one.learn(["a", "bb"])
    other.learn(["ccc"])
    assert dict(one) == {"a": 1, "bb": 2}
    near_dedup.shingle_set(b"six words are more than five")
    assert not one and dict(other) == {"fixed": 5}
