"""New parts of texts: numbered when they are looked up, words told from other parts."""

import public_tokenizers
import pytest

from sqlyard.llm.common import _WORD, PieceEncoder, _Places


def test_places_number_parts_as_they_come():
    places = _Places()
    assert [places[p] for p in ("b", "a", "b", "c")] == [0, 1, 0, 2]
    assert places.fresh == ["b", "a", "c"]


def test_words_are_letters_behind_one_blank_at_most():
    assert all(_WORD.fullmatch(p) for p in ("a", " a", "Été", " straße", "ª"))
    assert not any(_WORD.fullmatch(p) for p in ("", " ", "  a", "a ", "a b", "a1", "×", "ſ", "a\n"))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_library_s_over_several_batches(name):
    encoder = PieceEncoder(public_tokenizers.path(name), (1,), most=8)  # forgets often
    texts = ["", "The Été, the  straße 12!", "the the\n The", "don't ÿÀß ſ日本 x" + "x" * 70, " µm ª", "The Été"]
    learned = []
    own = encoder._learn
    encoder._learn = lambda fresh: (learned.extend(fresh), own(fresh))
    for batch in (texts[:3], texts[3:], texts, []):
        learned.clear()
        want = [encoder.library.encode(t, add_special_tokens=False).ids + [1] for t in batch]
        assert [ids.tolist() for ids in encoder.encode(batch)] == want
        assert len(learned) == len(set(learned))
